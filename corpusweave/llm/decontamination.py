"""Benchmark decontamination: Wu-Manber multi-pattern search over words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm.common import ALNUM, Words, cut_lineage, id_text, mix, slices, small_batches, table, tidied, unused

WINDOW = 10
#: UTF-8 bytes of benchmark text whose test strings are broadcast with their search tables; those of a larger benchmark stay distributed.
BLOCK_BYTES = 4_000_000
#: Of a distributed benchmark, entries of each length's shift table and bits of the filter over suffix and prefix blocks, at every size.
SHIFTS, FILTER_BITS = 1 << 20, 1 << 26
#: Parts that the rows of one test string, or of one text, are joined in.
SALT = 8
#: Rows of an Arrow batch that tasks put out.
ROWS = 4096
#: Window ends that one cursor covers; cursors of many texts step together.
STRIDE = 512
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _pair(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the two-word blocks that end at `last`."""
    return mix(h[last - 1] * _MUL + h[last])


def _stops(shift: np.ndarray, m: int, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Last words of the places at which the shift table stops, and the hashes of the suffix and prefix block there."""
    h, mask = words.hash, np.uint64(len(shift) - 1)
    lo, hi = words.first[:-1] + m - 1, words.first[1:]
    some = lo < hi
    lo, hi = lo[some], hi[some]
    pieces = (hi - lo + STRIDE - 1) // STRIDE
    begin = np.repeat(lo, pieces) + STRIDE * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    end = np.minimum(begin + STRIDE, np.repeat(hi, pieces))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    while len(begin):
        block = h[begin] if m == 1 else _pair(h, begin)
        step = shift[block & mask].astype(np.int64)
        zero = step == 0
        if zero.any():
            found.append((begin[zero], block[zero]))
        begin = begin + np.maximum(step, 1)
        on = begin < end
        begin, end = begin[on], end[on]
    last, block = map(np.concatenate, zip(*found, strict=True))
    return last, block, h[last] if m == 1 else _pair(h, last - m + 2)


@dataclass
class Group:
    """Test strings of one length m, in words: the shift table over block hashes, and buckets by the suffix block's hash."""

    m: int
    shift: np.ndarray  # by block hash modulo its size
    suffix: np.ndarray  # sorted hashes of last blocks
    prefix: np.ndarray  # of first blocks, in the same order
    number: np.ndarray  # of the test string, in the same order


class WuManber:
    """Finds every occurrence of many word sequences in many texts."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int = WINDOW):
        items = list(items)
        words = Words(pa.array([t for _, t in items], pa.string()), ALNUM)
        texts: dict[bytes, int] = {}
        self.owners: list[set[str]] = []  # ids of the items that hold a test string
        spans: dict[int, list[tuple[int, int]]] = {}
        for k, (name, _) in enumerate(items):
            a, b = words.first[k], words.first[k + 1]
            m = min(window, b - a)
            for i in range(a, b - m + 1 if m else a):
                number = texts.setdefault(words.text(i, i + m), len(texts))
                if number == len(self.owners):
                    self.owners.append(set())
                    spans.setdefault(m, []).append((i, number))
                if name is not None:
                    self.owners[number].add(str(name))
        self.texts = list(texts)
        self.groups = [self._group(int(m), *map(np.array, zip(*at, strict=True)), words.hash) for m, at in sorted(spans.items())]

    @staticmethod
    def _group(m: int, start: np.ndarray, number: np.ndarray, h: np.ndarray) -> Group:
        if m == 1:
            suffix = prefix = h[start]
        else:
            suffix, prefix = _pair(h, start + m - 1), _pair(h, start + 1)
        size = 1 << max(12, int(2 * m * len(start)).bit_length())
        shift = np.full(size, max(m - 1, 1), np.uint8 if m < 255 else np.int32)
        for back in range(m - 2, -1, -1):  # the smallest shift is written last
            shift[_pair(h, start + m - 1 - back) & np.uint64(size - 1)] = back
        if m == 1:
            shift[h[start] & np.uint64(size - 1)] = 0
        order = np.argsort(suffix, kind="stable")
        return Group(m, shift, suffix[order], prefix[order], number[order])

    def find(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """(first word, length, test string's number) of every occurrence."""
        for g in self.groups:
            for last, number in self._candidates(g, words):
                first = last - g.m + 1
                if words.text(first, last + 1) == self.texts[number]:
                    yield first, g.m, number

    def _candidates(self, g: Group, words: Words) -> Iterator[tuple[int, int]]:
        last, block, prefix = _stops(g.shift, g.m, words)
        left, right = np.searchsorted(g.suffix, block, "left"), np.searchsorted(g.suffix, block, "right")
        n = right - left
        which = np.repeat(np.arange(len(last)), n)
        slot = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + left[which]
        last = last[which]
        same = g.prefix[slot] == prefix[which]
        yield from zip(last[same].tolist(), g.number[slot[same]].tolist(), strict=True)


@dataclass
class Patterns:
    """Test strings of a benchmark of any size, as rows. Only tables of fixed size are broadcast: shift tables by length, and a filter over the
    hashes of suffix and prefix blocks. Places that pass both meet the test strings in a join on the blocks' hashes and the words."""

    strings: DataFrame  # m, suffix, prefix, words
    owners: DataFrame  # words, id
    tables: Broadcast  # (shift table by m, filter)

    @classmethod
    def of(cls, items: DataFrame, window: int) -> Patterns:
        """items: id string, text."""

        def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray, np.ndarray]]:
            for part in slices(batches):
                words = Words(part.column(1), ALNUM)
                n = np.diff(words.first)
                m = np.minimum(n, window)
                count = np.where(m > 0, n - m + 1, 0)
                start = np.repeat(words.first[:-1] - np.cumsum(count) + count, count) + np.arange(count.sum())
                yield part, words, start, np.repeat(m, count)

        def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, words, start, m in spans(batches):
                suffix, prefix = _ends(words.hash, start, m)
                bit = _bits(suffix, prefix)
                for k in range(0, len(start), ROWS):
                    at = slice(k, k + ROWS)
                    text = [words.text(i, i + n) for i, n in zip(start[at].tolist(), m[at].tolist(), strict=True)]
                    ids = part.column(0).take(pa.array(words.doc[start[at]]))
                    yield pa.RecordBatch.from_arrays([pa.array(m[at].astype(np.int32)), pa.array(suffix[at].view(np.int64)), pa.array(prefix[at].view(np.int64)), pa.array(text, pa.binary()), pa.array(bit[at]), ids], names)

        def shifts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            least: dict[int, np.ndarray] = {}
            for _, words, start, m in spans(batches):
                for n in np.unique(m).tolist():
                    t = least.setdefault(n, np.full(SHIFTS, max(n - 1, 1), np.int32))
                    i = start[m == n]
                    for back in range(max(n - 1, 1)):
                        block = words.hash[i] if n == 1 else _pair(words.hash, i + n - 1 - back)
                        at = (block & np.uint64(SHIFTS - 1)).astype(np.int64)
                        t[at] = np.minimum(t[at], back)
            for n, t in least.items():
                at = np.flatnonzero(t < max(n - 1, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), pa.array(at.astype(np.int32)), pa.array(t[at])], ["m", "at", "shift"])

        names = ["m", "suffix", "prefix", "words", "bit", "id"]
        held = cut_lineage(items.select("id", "text").mapInArrow(tidied(strings), "m int, suffix long, prefix long, words binary, bit long, id string").distinct())
        one = held.select("m", "suffix", "prefix", "words", "bit").distinct()
        rows = items.select("id", "text").mapInArrow(tidied(shifts), "m int, at int, shift int").groupBy("m", "at").agg(F.min("shift").alias("shift")).toArrow()  # at most SHIFTS a length
        tables: dict[int, np.ndarray] = {}
        m, at, shift = (rows[c].to_numpy() for c in ("m", "at", "shift"))
        for n in sorted(r.m for r in one.select("m").distinct().collect()):  # at most `window` lengths
            tables[n] = np.full(SHIFTS, max(n - 1, 1), np.uint8 if n < 256 else np.int32)
            tables[n][at[m == n]] = shift[m == n]
        bits = one.select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, int(bit & 63))").alias("bit"))
        found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most FILTER_BITS / 64 rows
        filled = np.zeros(FILTER_BITS // 64, np.int64)
        filled[found["word"].to_numpy()] = found["bits"].to_numpy()
        return cls(one.drop("bit"), held.where("id IS NOT NULL").select("words", "id").distinct(), items.sparkSession.sparkContext.broadcast((tables, filled)))

    def places(self, docs: DataFrame) -> DataFrame:
        """key, first and m of every occurrence, with the words. docs: key, text; rows of equal keys have equal texts."""
        tables = self.tables

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shifts, sieve = tables.value
            for part in slices(batches):
                words = Words(part.column(1), ALNUM)
                for m, shift in shifts.items():
                    last, suffix, prefix = _stops(shift, m, words)
                    bit = _bits(suffix, prefix)
                    may = (sieve[bit >> 6] >> (bit & 63)) & 1 == 1
                    last, suffix, prefix = last[may], suffix[may], prefix[may]
                    for k in range(0, len(last), ROWS):
                        at = slice(k, k + ROWS)
                        first = last[at] - m + 1
                        doc = words.doc[first]
                        keys = part.column(0).take(pa.array(doc))
                        yield pa.RecordBatch.from_arrays(
                            [keys, pa.array(first - words.first[doc]), pa.array(np.full(len(first), m, np.int32)), pa.array(suffix[at].view(np.int64)), pa.array(prefix[at].view(np.int64)), pa.array([words.text(i, i + m) for i in first.tolist()], pa.binary())],
                            ["key", "first", "m", "suffix", "prefix", "words"],
                        )

        seen = docs.mapInArrow(tidied(run), "key string, first long, m int, suffix long, prefix long, words binary").distinct()
        salted = self.strings.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        return seen.withColumn("salt", F.pmod(F.hash("key", "first"), F.lit(SALT))).join(salted, ["m", "suffix", "prefix", "words", "salt"]).select("key", "first", "m", "words")

    def hits(self, docs: DataFrame) -> DataFrame:
        """key, n_hit and items of the texts that hold a test string."""
        at = cut_lineage(self.places(docs))
        n = at.select("key", F.explode(F.sequence("first", F.col("first") + F.col("m") - 1)).alias("at")).distinct().groupBy("key").agg(F.count("at").alias("n_hit"))
        salted = self.owners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        held = at.select("key", "words").distinct().withColumn("salt", F.pmod(F.hash("key"), F.lit(SALT))).join(salted, ["words", "salt"]).select("key", "id").distinct()
        items = held.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("items"))
        return n.join(items, "key", "left").select("key", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _bits(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Of the filter, the bit of each pair of blocks."""
    return (mix(suffix * _MUL + prefix) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _ends(h: np.ndarray, start: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the suffix and prefix blocks of strings of m words."""
    suffix, prefix = h[start], h[start]
    long = m > 1
    suffix[long], prefix[long] = _pair(h, start[long] + m[long] - 1), _pair(h, start[long] + 1)
    return suffix, prefix


def matchers(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Broadcast | Patterns:
    """What documents are searched with: broadcast search tables of a benchmark of up to block_bytes, else test strings as rows."""
    spark = benchmark.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    if total > block_bytes:
        return Patterns.of(items, window)
    return spark.sparkContext.broadcast(WuManber([(r.id, r.text) for r in items.collect()], window))


#: A word of ALNUM before lower-casing.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>"


def _hits(batch: pa.RecordBatch, text_col: str, search: WuManber) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list[set[str]]]]:
    """Slices of a batch, and for each of their texts the number of words, of hit words, and the items."""
    at = batch.schema.get_field_index(text_col)
    for p in slices([batch], text_col):
        w = Words(p.column(at), ALNUM)
        edge, own = np.zeros(len(w.hash) + 1, np.int32), [set() for _ in range(p.num_rows)]
        for first, m, number in search.find(w):
            edge[first] += 1
            edge[first + m] -= 1
            own[w.doc[first]] |= search.owners[number]
        hit = np.concatenate([[0], np.cumsum(np.cumsum(edge)[:-1] > 0)])
        yield p, np.diff(w.first), hit[w.first[1:]] - hit[w.first[:-1]], own


def scan(docs: DataFrame, found: Broadcast | Patterns, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of every document, those inside an occurrence of a test string, and the items it came from, as strings in order.

    Overlapping occurrences count a word once. Null or empty text: no words, no hits. Null id and repeated rows: kept, one
    row each. An item without words or text has no test string; one without an id marks words but is not listed; repeated
    item ids are listed once. Empty documents: no rows; empty benchmark: no hits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, n_words, n_hit, items in _hits(batch, "text", found.value):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words), pa.array(n_hit), pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["doc_id", "n_words", "n_hit", "items"]
                )

    docs = id_text(docs, id_col, text_col)
    if isinstance(found, Patterns):
        keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2("text", 256).alias("key"), "text")
        salt = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
        rows = keyed.select("doc_id", "key", F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words"), F.pmod(F.hash("doc_id"), F.lit(SALT)).alias("salt"))
        out = rows.join(found.hits(keyed.select("key", "text").where("text IS NOT NULL")).withColumn("salt", salt), ["key", "salt"], "left")
        return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(tidied(run), SCHEMA)


def drop_contaminated(docs: DataFrame, found: Broadcast | Patterns, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, in whose text no test string occurs. Null and empty texts hold none and stay."""
    small_batches(docs.sparkSession)
    if isinstance(found, Patterns):
        key = unused("key", docs.columns)
        held = found.places(docs.select(F.sha2(text_col, 256).alias("key"), F.col(text_col).alias("text")).where("text IS NOT NULL")).select(F.col("key").alias(key)).distinct()
        return docs.withColumn(key, F.sha2(text_col, 256)).join(held, key, "left_anti").drop(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, n_hit, _ in _hits(batch, text_col, found.value):
                yield part.filter(pa.array(n_hit == 0))

    return docs.mapInArrow(tidied(run), docs.schema)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    hits = scan(table(spark, sf_dir, "documents"), matchers(table(spark, sf_dir, "benchmark")))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, coalesce({_WORDS}, []) AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS t
      FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(k) WHERE len(w) > 0),
m AS (SELECT DISTINCT m FROM p),
s AS (SELECT doc_id, k, m.m, array_to_string(w[k : k + m.m - 1], ' ') AS t FROM d, m, unnest(range(1, len(w) - m.m + 2)) AS u(k)),
o AS (SELECT s.doc_id, s.k, s.m, p.item_id FROM s JOIN p ON s.t = p.t AND s.m = p.m),
h AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM (SELECT DISTINCT doc_id, k, m FROM o), unnest(range(0, m)) AS u(j) GROUP BY doc_id),
n AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM o GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""
