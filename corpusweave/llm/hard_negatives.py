"""Hard-negative mining: dual-tree search of anchors against candidates by integer inner products."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm.common import cut_lineage, table
from corpusweave.llm.vectors import BLOCK, QUERIES, exact, grid, integers, long_scores, ranked, same_width, usable

#: Most rows of a leaf of the tree over anchors, and of the one over candidates.
ANCHOR_LEAF, LEAF = 32, 128
#: Stands for no score; all scores are greater.
_NONE = -(1 << 63) + 1


class Tree:
    """Balls over vectors: a node is cut across the line through two far rows, at the widest gap in the middle half of its rows, until it has few. So
    the tree is never deep, and equal vectors are cut too."""

    def __init__(self, x: np.ndarray, leaf: int):
        self.order = np.arange(len(x))
        self.lo, self.hi, self.left, self.right = [0], [len(x)], [-1], [-1]
        node = 0
        while node < len(self.lo):
            lo, hi = self.lo[node], self.hi[node]
            if hi - lo > leaf:
                rows = self.order[lo:hi]
                own = x[rows]
                far = own[np.argmax(np.square(own - own.mean(0)).sum(1))]
                along = own @ (own[np.argmax(np.square(own - far).sum(1))] - far)
                place = np.argsort(along, kind="stable")
                gaps = np.diff(along[place])[len(rows) // 4 : 3 * len(rows) // 4]
                half = len(rows) // 4 + int(np.argmax(gaps)) + 1 if gaps.any() else len(rows) // 2
                self.order[lo:hi] = rows[place]
                self.left[node], self.right[node] = len(self.lo), len(self.lo) + 1
                for a, b in ((lo, lo + half), (lo + half, hi)):
                    self.lo.append(a), self.hi.append(b), self.left.append(-1), self.right.append(-1)
            node += 1
        self.lo, self.hi, self.left, self.right = (np.array(z) for z in (self.lo, self.hi, self.left, self.right))
        self.x = x[self.order]
        self.center = np.stack([self.x[a:b].mean(0) if b > a else np.zeros(x.shape[1]) for a, b in zip(self.lo, self.hi, strict=True)])
        self.radius = np.array([np.sqrt(np.square(self.x[a:b] - m).sum(1).max(initial=0)) for a, b, m in zip(self.lo, self.hi, self.center, strict=True)])
        self.norm = np.sqrt(np.square(self.center).sum(1))

    def rows(self, node: int) -> slice:
        return slice(self.lo[node], self.hi[node])


def intervals(a: Tree, node: int, b: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that a row of the node may have with one of each of the other tree's nodes."""
    middle = b.center[nodes] @ a.center[node]
    spread = a.norm[node] * b.radius[nodes] + a.radius[node] * (b.norm[nodes] + b.radius[nodes])
    spread = spread * (1 + 1e-9) + np.abs(middle) * 1e-9 + 0.5  # rounding
    return middle - spread, middle + spread


def dual(a: Tree, b: Tree, low: np.ndarray, high: np.ndarray, leaf: Callable[[slice, slice], None]) -> None:
    """Calls `leaf` with the rows of all pairs of leaves that may hold a score from the least `low` to the greatest `high` of a pair's anchors.

    A node pair that can't is left out, and with it all anchors below it at once. Of a leaf of anchors the most promising candidates come
    first; `leaf` may raise `low` meanwhile.
    """

    def visit(node: int, nodes: np.ndarray) -> None:
        rows = a.rows(node)
        least, most = intervals(a, node, b, nodes)
        on = (most >= low[rows].min()) & (least <= high[rows].max())
        nodes, most = nodes[on], most[on]
        if not len(nodes):
            return
        inner = b.left[nodes] >= 0
        if a.left[node] >= 0 or inner.any():
            below = np.concatenate([nodes[~inner], b.left[nodes[inner]], b.right[nodes[inner]]])
            for n in (a.left[node], a.right[node]) if a.left[node] >= 0 else (node,):
                visit(n, below)
            return
        for k in np.argsort(-most, kind="stable"):
            if most[k] < low[rows].min():
                break
            leaf(rows, b.rows(nodes[k]))

    if len(a.x) and len(b.x):
        visit(0, np.zeros(1, np.int64))


def _merge(scores: np.ndarray, ids: np.ndarray, new: np.ndarray, new_ids: np.ndarray) -> None:
    """Puts the best of what a row has and what is new into the row: higher scores first, then smaller ids."""
    k = scores.shape[-1]
    s, i = np.concatenate([scores, new], -1), np.concatenate([ids, np.broadcast_to(new_ids, new.shape)], -1)
    top = np.lexsort((i, -s), -1)[..., :k]
    scores[...], ids[...] = np.take_along_axis(s, top, -1), np.take_along_axis(i, top, -1)


class Scorer:
    """Integer scores of rows of two trees."""

    def __init__(self, anchors: np.ndarray, candidates: np.ndarray):
        x, y = same_width(anchors, candidates)
        self.exact = exact(x, y)
        self.a, self.b = Tree(x, ANCHOR_LEAF), Tree(y, LEAF)
        if not self.exact:  # bounds in doubles prove nothing then
            for tree in (self.a, self.b):
                tree.center[:], tree.norm[:], tree.radius[:] = 0, 1, np.inf

    def __call__(self, rows: slice, cols: slice) -> np.ndarray:
        if self.exact:
            return (self.a.x[rows] @ self.b.x[cols].T).astype(np.int64)
        return long_scores(self.a.x[rows], self.b.x[cols])


def nearest(x: np.ndarray, x_ids: np.ndarray, y: np.ndarray, y_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, candidate id and score of each row's k best candidates other than itself."""
    score = Scorer(x, y)
    own, ids = x_ids[score.a.order], y_ids[score.b.order]
    best, best_ids = np.full((len(x), k), _NONE), np.zeros((len(x), k), np.int64)
    low, high = np.full(len(x), -np.inf), np.full(len(x), np.inf)

    def leaf(rows: slice, cols: slice) -> None:
        s = score(rows, cols)
        s[own[rows][:, None] == ids[cols]] = _NONE
        some = (s >= low[rows][:, None]).any(0)
        if not some.any():
            return
        _merge(best[rows], best_ids[rows], s[:, some], ids[cols][some])
        low[rows] = np.where(best[rows, -1] == _NONE, -np.inf, best[rows, -1].astype(float))

    dual(score.a, score.b, low, high, leaf)
    row, at = np.nonzero(best > _NONE)
    return score.a.order[row], best_ids[row, at], best[row, at]


def in_windows(
    x: np.ndarray, x_labels: np.ndarray, lo: np.ndarray, hi: np.ndarray, y: np.ndarray, y_ids: np.ndarray, y_labels: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, window, candidate id and score of the k best candidates of another label in each window `lo` to `hi` (rows x windows) of scores."""
    score = Scorer(x, y)
    lo, hi, labels, ids, others = lo[score.a.order], hi[score.a.order], x_labels[score.a.order], y_ids[score.b.order], y_labels[score.b.order]
    best, best_ids = np.full((*lo.shape, k), _NONE), np.zeros((*lo.shape, k), np.int64)
    some = lo <= hi
    least = np.where(some, lo.astype(float), np.inf)
    low, high = least.min(1), np.where(some, hi.astype(float), -np.inf).max(1)

    def leaf(rows: slice, cols: slice) -> None:
        s = score(rows, cols)
        fits = (labels[rows][:, None] != others[cols])[:, None] & (s[:, None] >= lo[rows][..., None]) & (s[:, None] <= hi[rows][..., None])
        fits &= s[:, None] >= best[rows, :, -1:]
        some = fits.any((0, 1))
        if some.any():
            _merge(best[rows], best_ids[rows], np.where(fits, s[:, None], _NONE)[..., some], ids[cols][some])
            low[rows] = np.maximum(least[rows], best[rows, :, -1].astype(float)).min(1)

    dual(score.a, score.b, low, high, leaf)
    row, window, at = np.nonzero(best > _NONE)
    return score.a.order[row], window, best_ids[row, window, at], best[row, window, at]


def _positives(rows: DataFrame, anchors: DataFrame, k: int, block: int, most_queries: int) -> DataFrame:
    """vec_id of the anchor, rank, positive_id, score: the k best other rows of the anchor's label."""
    q, c = grid(anchors, rows, ["label"], block, most_queries)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left["vec_id"].to_numpy()
        of, found, score = nearest(integers(left["v"]), ids, integers(right["v"]), right["vec_id"].to_numpy(), k)
        return pa.table({"vec_id": ids[of], "positive_id": found, "score": score})

    keys = ["label", "qb", "cb"]
    return ranked(q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(cell, "vec_id long, positive_id long, score long"), ["vec_id"], k, "positive_id")


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90),
    id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, block: int = BLOCK, most_anchors: int = QUERIES,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    An anchor is a row that `is_anchor` (a condition on vec_id) holds for; its positives are its best other rows of the same label. For each
    positive, the best rows of another label whose score is between `window` per cent of the positive's, both included. Scores are integer
    inner products of floor(256 * x); higher ones come first, ties by smaller id. `label` is the label of a row (default: the column label).

    Anchors meet candidates in a grid of bounded cells (for positives, those of their label), and in each a tree over anchors and one over candidates are
    descended together. Rows without id, label or vector, or with a null or non-finite component take no part. Repeated rows count once; of
    rows that share an id but differ, the smallest by label, then by vector. Vectors of different lengths: missing components count as 0.
    Scores that no long holds: the nearest that one holds. No positive, a negative positive's score or an empty window: no rows. Empty table: no rows.
    """
    label = F.col("label") if label is None else label
    rows = cut_lineage(usable(vectors, id_col, vector_col, label.cast("long").alias("label")))
    anchors = rows.where(is_anchor)
    found = _positives(rows, anchors, positives, block, most_anchors)
    found = found.groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "score"))).alias("positives"))  # at most `positives` of each
    q, c = grid(cut_lineage(anchors.join(found, "vec_id")), rows, (), block, most_anchors)

    def bounds(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # 100 * s between window per cent of the score, in integers; whole floors, so that nothing leaves the range of a long.
        part = lambda p, up: np.array([-(-p * int(s) // 100) if up else p * int(s) // 100 for s in score], np.int64)
        return part(window[0], True), part(window[1], False)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = left["positives"].combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        there = np.arange(positives) < sizes[:, None]
        lo, hi, p_id, p_score = (np.full(there.shape, fill) for fill in (1, 0, 0, 0))
        p_id[there], p_score[there] = flat.field("positive_id").to_numpy(), flat.field("score").to_numpy()
        lo[there], hi[there] = bounds(p_score[there])
        ids = left["vec_id"].to_numpy()
        of, w, n_id, score = in_windows(integers(left["v"]), left["label"].to_numpy(), lo, hi, integers(right["v"]), right["vec_id"].to_numpy(), right["label"].to_numpy(), negatives)
        return pa.table({"anchor_id": ids[of], "positive_id": p_id[of, w], "positive_score": p_score[of, w], "negative_id": n_id, "score": score})

    names = "anchor_id long, positive_id long, positive_score long, negative_id long, score long"
    out = ranked(q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(cell, names), ["anchor_id", "positive_id"], negatives, "negative_id")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every hundredth vector; every seventh has the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


ORACLE_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score FROM e AS a JOIN e AS c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same WHERE 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
