"""What the corpus operators share: input shape, bounded Arrow slices, byte-level words.

Every operator selects its own columns first, so extra columns of the input, whatever their names, never clash.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: UTF-8 bytes of text that are worked on at once (one longer text makes a slice of its own).
SLICE_BYTES = 500_000
#: Odd multiplier of the rolling word hash modulo 2**64, and its inverse.
_MUL = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MUL, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows of long texts in each Arrow batch than Spark's default, which both the JVM and the Python worker hold."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def tidied(run: Callable) -> Callable:
    """The task function, which gives memory that its worker no longer needs back to the system in the end."""

    def with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            import ctypes

            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return with_end


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that an operator reads, under fixed names."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def unused(name: str, columns: list[str]) -> str:
    """A column name like the given one that none of the columns has, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; one of our own only where that is unset in local mode, as in tests. On a cluster
    it must be set, as a folder of one machine's would lose data."""
    jsc = spark.sparkContext._jsc.sc()
    if not jsc.getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not named:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            import tempfile

            named = os.path.join(tempfile.gettempdir(), "corpusweave-checkpoints")
        spark.sparkContext.setCheckpointDir(named)
    return jsc.getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: it survives the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], text_col: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in runs of at most `most` text bytes, so that memory follows the longest text at worst."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(text_lengths(batch.column(batch.schema.get_field_index(text_col))))
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def text_lengths(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text; 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def by_slices(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], text_col: str = "text") -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            out = fn(part)
            if out is not None and out.num_rows:
                yield out

    return tidied(run)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a NUL after each, as bytes, and the start of each text (one more for the end). Null: empty."""
    texts = [(x or "").encode("utf-8", "surrogatepass") for x in column.to_pylist()]
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts)), out=starts[1:])
    return np.frombuffer(b"\0".join(texts) + b"\0", np.uint8), starts


def byte_table(is_word: Callable[[int], bool], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Which of the 256 bytes belong to words, and what each stands for (A-Z as a-z if lower). NUL separates."""
    member = np.array([b != 0 and is_word(b) for b in range(256)])
    value = np.arange(256, dtype=np.uint8)
    if lower:
        value[65:91] += 32
    return member, value


#: Words `[^\x20\x09-\x0D]+`. A NUL inside a text is a word character, which callers treat apart (`has_nul`).
SPACED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased texts: digits, letters and all beyond ASCII.
ALNUM = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


class Words:
    """Words of many texts at once, as spans of one byte buffer and 64-bit hashes.

    data: bytes after lower-casing; start, end: of each word; doc: index of its text; hash: of its bytes.
    first: index of each text's first word, one more for the end.
    """

    def __init__(self, column: pa.Array, kind: tuple[np.ndarray, np.ndarray] = SPACED):
        member, value = kind
        raw, self.text_start = text_bytes(column)
        inside = member[raw]
        if kind is SPACED and (nul := np.flatnonzero(raw == 0)).size > len(self.text_start) - 1:
            inside[nul] = True
            inside[self.text_start[1:] - 1] = False
        self.data = value[raw]
        edge = np.diff(inside.view(np.int8), prepend=0, append=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.doc = np.searchsorted(self.text_start, self.start, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(self.text_start)))
        self.hash = span_hashes(self.data, self.start, self.end)

    def text(self, i: int, j: int) -> bytes:
        """Words i to j (exclusive) joined by single spaces."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[i:j], self.end[i:j], strict=True))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 65536)
        for k, base in enumerate((_MUL, _INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes, the same wherever the span stands: differences of one prefix sum."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive word hashes; len(h) - n + 1 of them (none if fewer words)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(_MUL) + h[k : k + m])
    return out
