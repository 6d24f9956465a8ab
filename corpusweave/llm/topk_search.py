"""Exact top-k search by inner product: branch and bound over a vertical layout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm.common import cut_lineage, table, tidied
from corpusweave.llm.vectors import BLOCK, QUERIES, best, exact, grid, integers, long_scores, ranked, same_width, usable

#: Dimensions that are accumulated at once.
DIMENSIONS = 16
#: Candidates, and queries, that are worked on at once in a cell.
COLUMNS, ROWS = 8_192, 64
#: Candidates that all queries are scored against first, for a floor under their k-th score; the lowest by a hash of the id.
SEEDS = 2_048
#: Share of pairs alive below which single pairs are followed instead of whole columns.
SPARSE = 1 / 16
_NONE = -(1 << 63)


class Columns:
    """Candidates dimension by dimension, heaviest dimensions first, with the norm of what is left after each block of dimensions."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, width: int = DIMENSIONS):
        mass = np.square(x).sum(0)
        self.order = np.argsort(-mass, kind="stable")
        self.x, self.ids = np.ascontiguousarray(x.T[self.order]), ids
        self.blocks = [slice(a, min(a + width, len(x.T))) for a in range(0, len(x.T), width)] or [slice(0, 0)]
        self.rest = remaining(self.x, self.blocks)


def remaining(vertical: np.ndarray, blocks: list[slice]) -> list[np.ndarray]:
    """For each block of dimensions, the norms of all dimensions after it."""
    return [np.sqrt(np.square(vertical[b.stop :]).sum(0)) for b in blocks]


def _survivors(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, c: Columns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query place, candidate place and score of all pairs that reach the query's floor.

    Block by block of dimensions: a pair whose score so far and whose remaining norms (by Cauchy and Schwarz) can't reach the
    floor is dead. Columns without a live pair are left out of the layout; once few pairs live, only those are followed.
    """
    q_rest = remaining(q.T, c.blocks)
    cols = np.arange(c.x.shape[1])
    x = c.x
    sums = np.zeros((len(q), len(cols)))
    for k, b in enumerate(c.blocks):
        sums += q[:, b] @ x[b]
        reach = sums + np.outer(q_rest[k], c.rest[k][cols]) * (1 + 1e-9)
        alive = (reach >= floor[:, None]) & (q_ids[:, None] != c.ids[cols])
        if alive.mean() < SPARSE:
            row, at = np.nonzero(alive)
            return _follow(q, q_rest, floor, c, k, row, cols[at], sums[row, at])
        some = alive.any(0)
        if some.mean() < 0.75:
            cols, x, sums, alive = cols[some], x[:, some], sums[:, some], alive[:, some]
    row, at = np.nonzero(alive)
    return row, cols[at], sums[row, at]


def _follow(q: np.ndarray, q_rest: list[np.ndarray], floor: np.ndarray, c: Columns, k: int, row: np.ndarray, col: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Single pairs through the blocks of dimensions after the k-th."""
    for j in range(k + 1, len(c.blocks)):
        b = c.blocks[j]
        score = score + np.einsum("di,di->i", q.T[b][:, row], c.x[b][:, col])
        on = score + q_rest[j][row] * c.rest[j][col] * (1 + 1e-9) >= floor[row]
        row, col, score = row[on], col[on], score[on]
    return row, col, score


def search(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query place, candidate id and score of each query's k best candidates other than itself (those below its floor may lack)."""
    q, x = same_width(q, x)
    found = [np.zeros(0, np.int64)] * 3
    fits = exact(q, x)
    for a in range(0, len(q), ROWS):
        rows = slice(a, a + ROWS)
        have = [np.zeros(0, np.int64)] * 3
        low = floor[rows].astype(np.float64)
        for part in (slice(z, z + COLUMNS) for z in range(0, len(x), COLUMNS)):
            if fits:
                c = Columns(x[part], ids[part])
                row, col, score = _survivors(q[rows][:, c.order], q_ids[rows], low, c)
            else:
                scores = long_scores(q[rows], x[part])
                row, col = np.nonzero(q_ids[rows][:, None] != ids[part])
                score = scores[row, col]
            have = [np.concatenate(z) for z in zip(have, (row, ids[part][col], score.astype(np.int64)), strict=True)]
            top = best(have[0], have[2], have[1], k)
            have = [z[top] for z in have]
            count = np.bincount(have[0], minlength=len(low))
            last = np.cumsum(count)[count == k] - 1
            low[count == k] = np.maximum(low[count == k], have[2][last])
        found = [np.concatenate(z) for z in zip(found, (have[0] + a, have[1], have[2]), strict=True)]
    return tuple(found)


def _with_floor(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Queries with their k-th best score among a bounded sample of candidates: no worse score can be among the k best of all."""
    rows = candidates.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEEDS).toArrow()
    seeds = queries.sparkSession.sparkContext.broadcast((integers(rows["v"]), rows["vec_id"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = integers(batch.column("v"))
            floor = np.full(len(q), _NONE)
            of, _, score = search(q, batch.column("vec_id").to_numpy(), *seeds.value, k, floor)
            full = np.flatnonzero(np.bincount(of, minlength=len(q)) == k)
            floor[full] = score[np.searchsorted(of, full, "right") - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], names=[*batch.schema.names, "floor"])

    return queries.mapInArrow(tidied(run), f"{_ddl(queries)}, floor long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, most_queries: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k other rows with the highest integer inner products for each row that `is_query` (a condition
    on vec_id) holds for; all, if fewer. Components count as floor(256 * x). Ties go to the smaller id.

    Queries meet all candidates in a grid of bounded cells; in each, candidates are searched by branch and bound over dimension blocks.
    Rows without id, without vector, or with a null or non-finite component take no part. Repeated rows count once (see `usable`). Vectors
    of different lengths: missing components count as 0. Scores that no long holds: the nearest that one holds. Empty table: no rows.
    """
    rows = cut_lineage(usable(vectors, id_col, vector_col))
    queries = _with_floor(rows.where(is_query), rows, k)
    q, c = grid(queries, rows, (), block, most_queries)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left["vec_id"].to_numpy()
        of, vec_id, score = search(integers(left["v"]), ids, integers(right["v"]), right["vec_id"].to_numpy(), k, left["floor"].to_numpy())
        return pa.table({"query_id": ids[of], "vec_id": vec_id, "score": score}, pa.schema([(n, pa.int64()) for n in ("query_id", "vec_id", "score")]))

    found = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(cell, "query_id long, vec_id long, score long")
    return ranked(found, ["query_id"], k, "vec_id").select("query_id", "rank", "vec_id", "score")


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest scores of every fiftieth vector against all others."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM e AS q JOIN e AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
