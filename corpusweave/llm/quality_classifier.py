"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated output."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm.boosting import sigmoid
from corpusweave.llm.common import by_slices, byte_table, id_text, mix, slices, span_hashes, table, text_bytes, tidied
from corpusweave.llm.labels import fold, training_sample

#: Labelled rows that the network is fitted on, about, at most.
FIT_ROWS = 20_000
#: Buckets of words and of word shapes, and the size of their vectors: what the corpus statistics hold is bounded by these.
WORDS, SHAPES, SIZE = 1 << 13, 1 << 10, 32
CONTEXT = 2
_MEMBER, _LOWER = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Upper-case, lower-case (and all beyond ASCII) and digits are one class each; any other character is its own.
_CLASS = np.array([1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 or b >= 128 else 3 if 48 <= b <= 57 else b for b in range(256)], np.uint8)


def index_vectors(n: int, salt: int) -> np.ndarray:
    """Sparse ternary index vectors, four entries each, from a hash of the bucket."""
    out = np.zeros((n, SIZE), np.int16)
    rows = np.arange(n, dtype=np.uint64)
    for k in range(4):
        h = mix(rows * np.uint64(8) + np.uint64(k) + (np.uint64(salt) << np.uint64(40)))
        np.add.at(out, (np.arange(n), (h % np.uint64(SIZE)).astype(np.int64)), np.where(h >> np.uint64(63), 1, -1).astype(np.int16))
    return out


_WORD_INDEX, _SHAPE_INDEX = index_vectors(WORDS, 1), index_vectors(SHAPES, 2)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Word bucket, shape bucket and text of each word. The shape is the run of character classes, and whether the word
    repeats the one before."""
    raw, text_start = text_bytes(column)
    inside = _MEMBER[raw]
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(text_start, start, "right") - 1
    h = span_hashes(_LOWER[raw], start, end)
    kind = _CLASS[raw]
    new = inside.copy()
    new[1:] &= (kind[1:] != kind[:-1]) | ~inside[:-1]
    rank = np.concatenate([[0], np.cumsum(new)])
    shape = span_hashes(kind[new], rank[start], rank[end])
    again = np.zeros(len(h), np.uint64)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    return (h % np.uint64(WORDS)).astype(np.int64), (mix(shape + again) % np.uint64(SHAPES)).astype(np.int64), doc, len(text_start) - 1


def context_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """For each bucket (words, then shapes) the sum of its neighbours' index vectors over all whole documents.

    Each task sums its own texts; the tasks' sums, of fixed size, are summed bucket by bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SIZE, WORDS + SHAPES), np.int64)
        for part in slices(batches):
            word, shape, doc, _ = tokens(part.column(0))
            own = _WORD_INDEX[word] + _SHAPE_INDEX[shape]
            near = np.zeros_like(own)
            for step in range(1, CONTEXT + 1):
                same = (doc[step:] == doc[:-step])[:, None]
                near[:-step] += own[step:] * same
                near[step:] += own[:-step] * same
            for d in range(SIZE):
                total[d, :WORDS] += np.bincount(word, near[:, d], WORDS).astype(np.int64)
                total[d, WORDS:] += np.bincount(shape, near[:, d], SHAPES).astype(np.int64)
        at = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(row[at]) for row in total)], ["at", *(f"d{i}" for i in range(SIZE))])

    dims = [f"d{i}" for i in range(SIZE)]
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(tidied(run), ", ".join(f"{c} long" for c in ["at", *dims]))
    rows = rows.groupBy("at").agg(*(F.sum(c).alias(c) for c in dims)).toArrow()  # a row a bucket
    out = np.zeros((WORDS + SHAPES, SIZE))
    out[rows["at"].to_numpy()] = np.stack([rows[c].to_numpy() for c in dims], axis=1)
    return out


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Context vectors of unit length; what the buckets of a kind have in common is taken out first."""
    out = context.copy()
    for part in (out[:WORDS], out[WORDS:]):
        length = np.linalg.norm(part, axis=1, keepdims=True)
        np.divide(part, length, out=part, where=length > 0)
        part -= (part * length).sum(0) / max(length.sum(), 1)
        length = np.linalg.norm(part, axis=1, keepdims=True)
        np.divide(part, length, out=part, where=length > 0)
    return out.astype(np.float32)


#: Pooled word vectors, pooled shape vectors, pooled index vectors of shapes.
POOLED = 3 * SIZE


def pool(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Means over each text's words; zeros for a text without words."""
    word, shape, doc, n = tokens(column)
    first = np.searchsorted(doc, np.arange(n + 1))
    count = np.diff(first)
    some = np.flatnonzero(count)
    out = np.zeros((n, POOLED), np.float32)
    if len(word):
        for k, rows in enumerate((vectors[word], vectors[WORDS + shape], _SHAPE_INDEX[shape].astype(np.float32))):
            out[some, k * SIZE : (k + 1) * SIZE] = np.add.reduceat(rows, first[some], axis=0) / count[some, None]
    return out


@dataclass
class Network:
    """Two layers over standardised inputs; the temperature makes its probabilities honest on rows not fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return (np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2)[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x).astype(float) / self.temperature)


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, rate: float = 0.01, l2: float = 1e-4, seed: int = 0) -> Network:
    """Adam on log loss; every fifth row is held back for the temperature. One class only: a constant."""
    x, y = x.astype(np.float64), y.astype(np.float64)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, used = order[::5], np.setdiff1d(order, order[::5])
    d = x.shape[1]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    weights = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), np.zeros((hidden, 1)), np.array([np.log(share / (1 - share))])]
    net = Network(x.mean(0) if len(x) else np.zeros(d), x.std(0) + 1e-3 if len(x) else np.ones(d), weights)
    if len(np.unique(y)) < 2 or len(used) < 2:
        return net
    z = (x - net.mean) / net.scale
    m, v, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        turn = rng.permutation(used)
        for i in range(0, len(turn), 128):
            at = turn[i : i + 128]
            hid = np.tanh(z[at] @ weights[0] + weights[1])
            err = (sigmoid((hid @ weights[2] + weights[3])[:, 0]) - y[at])[:, None] / len(at)
            back = err @ weights[2].T * (1 - hid**2)
            grads = [z[at].T @ back + l2 * weights[0], back.sum(0), hid.T @ err + l2 * weights[2], err.sum(0)]
            t += 1
            step = rate * (1 - epoch / epochs)
            for k, g in enumerate(grads):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                weights[k] -= step * m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    raw, label = net.raw(x[held]), y[held]
    grid = np.exp(np.linspace(np.log(0.5), np.log(10), 80))
    loss = [np.logaddexp(0, -raw / c).dot(label) + np.logaddexp(0, raw / c).dot(1 - label) for c in grid]
    net.temperature = float(grid[int(np.argmin(loss))])
    return net


@dataclass
class Quality:
    vectors: np.ndarray
    network: Network


def train(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, folds: int = 5, held: int = 0, label: str = "quality") -> Quality:
    """Word vectors from all documents, then a network from labelled rows whose fold isn't held out. Of documents that share a labelled id
    one is learned from."""
    docs = id_text(docs)
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(context_vectors(docs)))
    sample = training_sample(labels, label, fold(folds) != held, most)  # of bounded size
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        x = pool(part.column(1), vectors.value)
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in x], pa.binary()), part.column(2)], ["doc_id", "x", "y"])

    rows = texts.mapInArrow(by_slices(run), "doc_id long, x binary, y int").groupBy("doc_id").agg(F.min("x").alias("x"), F.max("y").alias("y")).toArrow().sort_by([("doc_id", "ascending"), ("x", "ascending")])
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(-1, POOLED)
    return Quality(vectors.value, fit(x, np.minimum(rows["y"].to_numpy(), 1)))


def score(docs: DataFrame, model: Quality, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Probability of good quality of every whole document, one row for each input row.

    Null or empty text, or white space alone: the score of a zero vector. Null id and repeated rows: kept. Empty input: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        p = shared.value.network.probability(pool(part.column(1), shared.value.vectors))
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(p)], ["doc_id", "score"])

    docs = id_text(docs, id_col, text_col)
    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(by_slices(run), "doc_id long, score double")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from labels outside fold 0 of 5."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: SQL can't express it; held-out accuracy is tested.
ORACLE_SQL = None
