"""What the vector operators share: the rows that take part, exact integer scores, and the grid of bounded cells in which queries meet candidates."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusweave.llm.common import partitions

#: Most candidate rows and query rows of a cell; with few rows a cell has fewer candidates, so that all tasks get some.
BLOCK = 65_536
QUERIES = 16_384
LEAST = 2_048
#: Largest integer up to which doubles are exact.
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def usable(vectors: DataFrame, id_col: str, vector_col: str, *others: Column) -> DataFrame:
    """vec_id, v and the other columns of rows that have all of them and whose vector holds finite numbers only, one row an id.

    Of repeated rows one counts; of rows that share an id but differ, the smallest by the other columns, then by the vector.
    An id that very many rows share is cut to one row a task before the shuffle.
    """
    kind = vectors.schema[vector_col].dataType.simpleString()
    v = F.col(f"`{vector_col}`")
    v = v if kind in ("array<float>", "array<double>") else v.cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), *others, v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.dropna().where(finite)
    names = [c for c in rows.columns if c != "vec_id"]
    return rows.groupBy("vec_id").agg(F.min(F.struct(*names)).alias("row")).select("vec_id", *(F.col(f"row.{c}").alias(c) for c in names))


def integers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """floor(256 * x) of each component, as doubles, a row a vector. Shorter vectors are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(sizes.max(initial=0))
    with np.errstate(over="ignore"):
        flat = np.nan_to_num(np.floor(flat * 256))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all partial sums of inner products of these rows are exact in doubles."""
    return a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < _EXACT


def long_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of vectors too large for doubles, by Python's integers, held within the range of a long."""
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T if a.shape[1] else np.zeros((len(a), len(b)), object), 2 - _LONG, _LONG).astype(np.int64)


def best(of: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each `of`: higher scores first, then smaller ids. Scores are integers."""
    order = np.lexsort((ids, -score, of))
    first = np.flatnonzero(np.diff(of[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    return order[place < k]


def grid(queries: DataFrame, candidates: DataFrame, keys: Sequence[str] = (), block: int = BLOCK, most_queries: int = QUERIES) -> tuple[DataFrame, DataFrame]:
    """Both sides with the numbers of a cell, `qb` and `cb`: each query meets each candidate of equal keys in exactly one cell.

    Queries are dealt to blocks by a hash of their id and repeated for each block of candidates, and the other way round, so a cell
    holds about `block` candidates and `most_queries` queries at most, however many rows share a key.
    """
    p = partitions(queries.sparkSession)
    queries = queries.select(*(F.col(c).alias(c) for c in queries.columns))  # as the candidates may be the same rows
    blocks = lambda n, most: F.greatest(F.lit(1), F.ceil(n / most)).cast("int")
    n_q = queries.groupBy(*keys).agg(blocks(F.count(F.lit(1)), most_queries).alias("q_blocks"))
    few = lambda n: F.least(F.lit(p), blocks(n, LEAST))
    n_c = candidates.groupBy(*keys).agg(F.greatest(blocks(F.count(F.lit(1)), block), few(F.count(F.lit(1)))).alias("c_blocks"))
    if keys:
        sizes = n_q.join(n_c, list(keys))
        q, c = queries.join(sizes, list(keys)), candidates.join(sizes, list(keys))
    else:
        sizes = {**n_q.first().asDict(), **n_c.first().asDict()}
        q, c = (df.withColumns({name: F.lit(n) for name, n in sizes.items()}) for df in (queries, candidates))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = q.withColumn("qb", own("q_blocks")).withColumn("cb", all_of("c_blocks")).drop("q_blocks", "c_blocks")
    c = c.withColumn("cb", own("c_blocks")).withColumn("qb", all_of("q_blocks")).drop("q_blocks", "c_blocks")
    return q, c


def ranked(found: DataFrame, by: Sequence[str], k: int, id_col: str) -> DataFrame:
    """The k best rows of each key with their rank: higher scores first, ties by smaller id."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), id_col)
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
