"""Best-fit-decreasing packing of tokenised documents into fixed windows."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusweave.llm.common import cut_lineage, id_text, slices, table, tidied

WINDOW = 1024
END_ID = 0
#: Texts are cut where the byte-level pre-tokeniser can't join: before white space that follows anything else, and
#: between a run of letters and punctuation.
_UNIT = re.compile(r"[ \n]*+[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]++(?=[.,!&%$*|])|[ \n]*+[^ \n]++|[ \n]+$")
#: White space other than blank and line feed: such texts are encoded whole.
_OTHER_SPACE = re.compile("[\t\r\f\v\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Encoded units that a worker remembers from task to task (about 200 bytes each; those not met lately go first), and those encoded as one
#: string.
_REMEMBER = 400_000
_AT_ONCE = 200
#: UTF-8 bytes of texts that are encoded in one go.
ENCODED_BYTES = 2_000_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes. A unit that was seen before isn't encoded again."""

    def __init__(self, path: str, remember: int = _REMEMBER):
        self.remember = remember
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or "(?!)")  # texts with such a string are encoded whole
        self.seen: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocab = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)  # each character of a byte-level token is a byte
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[str]) -> None:
        """Encodes units that begin with white space and end without as one string, cut again by the bytes of its tokens."""
        joined = [u for u in units if u[0] in " \n" and u[-1] not in " \n"]
        alone = [u for u in units if u[0] not in " \n" or u[-1] in " \n"]
        self.seen.update(zip(alone, self._encode(alone), strict=True))
        for i in range(0, len(joined), _AT_ONCE):
            part = joined[i : i + _AT_ONCE]
            text = "".join(part)
            if self.added.search(text):
                self.seen.update(zip(part, self._encode(part), strict=True))
                continue
            (ids,) = self._encode([text])
            upto = np.cumsum(self.bytes_of[np.frombuffer(ids, "<u4")])
            ends = np.cumsum([len(u.encode()) for u in part])
            cuts = np.searchsorted(upto, ends)
            if not np.array_equal(upto[cuts], ends):
                self.seen.update(zip(part, self._encode(part), strict=True))
                continue
            at = 0
            for unit, end in zip(part, (4 * cuts + 4).tolist(), strict=True):
                self.seen[unit] = ids[at:end]
                at = end

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.seen) > self.remember // 2:
            self.old, self.seen = self.seen, {}
        out: list = [None] * len(texts)
        whole, open_texts, new = [], [], set()
        for k, text in enumerate(texts):
            if _OTHER_SPACE.search(text) or self.added.search(text):
                whole.append(k)
                continue
            units = _UNIT.findall(text)
            ids = list(map(self.seen.get, units))
            if None in ids:
                at, missing = -1, []
                try:
                    while True:
                        at = ids.index(None, at + 1)
                        missing.append(at)
                except ValueError:
                    pass
                new.update(map(units.__getitem__, missing))
                open_texts.append((k, units, ids, missing))
            else:
                out[k] = b"".join(ids)
        self.seen.update((u, ids) for u in new if (ids := self.old.get(u)) is not None)
        self._learn([u for u in new if u not in self.seen])
        for k, units, ids, missing in open_texts:
            for at in missing:
                ids[at] = self.seen[units[at]]
            out[k] = b"".join(ids)
        for k, ids in zip(whole, self._encode([texts[k] for k in whole]), strict=True):
            out[k] = ids
        return out


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def shared_encoder(path: str, remember: int = _REMEMBER) -> Encoder:
    """This worker's encoder, which remembers the units of its earlier tasks."""
    if (path, remember) not in _ENCODERS:
        _ENCODERS[path, remember] = Encoder(path, remember)
    return _ENCODERS[path, remember]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"


def pieces(docs: DataFrame, encoder: Callable[[], Callable[[list[str]], list[bytes]]], window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Full windows of every document's ids and the rest; nth counts a partition's pieces of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        part = TaskContext.get().partitionId()
        count = np.zeros(window + 1, np.int64)
        tail = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, most=ENCODED_BYTES):
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += tail
                total = len(ids) // 4
                for start in range(0, total, window):
                    cut = ids[4 * start : 4 * (start + window)]
                    n = len(cut) // 4
                    out.append((doc, start, n, zlib.crc32(cut), total, part, count[n], *([np.frombuffer(cut, "<u4")] if with_ids else ())))
                    count[n] += 1
            types = [pa.int64()] * 5 + [pa.int32(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    docs = id_text(docs)
    schema = PIECES + ", ids array<bigint>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(tidied(run), schema)


class OpenWindows:
    """Segment tree over remaining capacities: the tightest one with an open window, in logarithmic time."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += n
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= least that has an open window."""
        at = least + self.leaves
        if self.count[at]:
            return least
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def plan(lengths: Mapping[int, int], window: int = WINDOW) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing over a histogram of lengths: (number of windows, their [(length, pieces of it)] in order).

    Pieces of equal length are interchangeable, and windows with equal content too, so a run of equal pieces is placed
    at once just as one by one: each fills the tightest open window that takes it until nothing more of that length fits.
    The work depends on the distinct lengths, at most `window`, and not on how many pieces there are.
    """
    tree = OpenWindows(window)
    opened: dict[int, list[tuple[int, tuple]]] = {}

    def put(capacity: int, n: int, content: tuple) -> None:
        if n:
            opened.setdefault(capacity, []).append((n, content))
            tree.add(capacity, n)

    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, n, content = window, left, ()
            else:
                n, content = opened[capacity].pop()
                tree.add(capacity, -n)
            each = capacity // length
            full = min(n, left // each)
            put(capacity - each * length, full, (content, (length, each)))
            n, left = n - full, left - full * each
            if left and left < each and n:
                put(capacity - left * length, 1, (content, (length, left)))
                n, left = n - 1, 0
            if content:  # unless they were new
                put(capacity, n, content)
    out = []
    for stack in opened.values():
        for n, content in stack:
            parts = []
            while content:
                content, last = content
                parts.append(last)
            out.append((n, parts[::-1]))
    return out


class Places:
    """Where the k-th piece of each length goes: runs of ranks with their first sequence and offset."""

    def __init__(self, lengths: Mapping[int, int], window: int = WINDOW):
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        first = 0
        for n, parts in plan(lengths, window):
            offset = 0
            for length, each in parts:
                rank = used.get(length, 0)
                runs.setdefault(length, []).append((rank, each, first, offset))
                used[length] = rank + n * each
                offset += length * each
            first += n
        self.sequences = first
        self.runs = {k: [np.array(c) for c in zip(*v, strict=True)] for k, v in runs.items()}

    def __call__(self, length: int, rank: int) -> tuple[int, int]:
        ranks, each, first, offset = self.runs[length]
        i = bisect_right(ranks, rank) - 1
        window, k = divmod(rank - int(ranks[i]), int(each[i]))
        return int(first[i]) + window, int(offset[i]) + k * length

    def many(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for n in np.unique(length).tolist():
            at = np.flatnonzero(length == n)
            ranks, each, first, start = self.runs[n]
            i = np.searchsorted(ranks, rank[at], "right") - 1
            window, k = np.divmod(rank[at] - ranks[i], each[i])
            sequence[at], offset[at] = first[i] + window, start[i] + k * n
        return sequence, offset


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False, remember: int = _REMEMBER) -> DataFrame:
    """Packs every document's ids, whole texts, into sequences of at most `window` ids with little padding.

    One best-fit-decreasing packing over all pieces: only the histogram of their lengths (at most `window` rows) comes to the
    driver, and the plan made from it goes to the tasks; a piece finds its place by its rank among the pieces of its length,
    which is its partition's offset (a join) plus its number there. A length that all pieces share is thus no hot key.

    A worker remembers the ids of at most `remember` units, about 200 bytes each; more of them save time and alter no result.
    Null or empty text: the end id alone. Null id: kept as null. Repeated rows: each is packed. Empty input: no rows.
    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id (gapless from 0), offset, and ids if with_ids.
    """
    path = path or tokenizer_path()
    found = cut_lineage(pieces(docs, lambda: shared_encoder(path, remember), window, end_id, with_ids))
    counts = found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    lengths = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `window` rows
    places = docs.sparkSession.sparkContext.broadcast(Places(lengths, window))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = found.join(offsets, ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else []), (F.col("before") + F.col("nth")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places.value.many(b.column("length").to_numpy(), b.column("rank").to_numpy())
            keep = [n for n in b.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 ids."""
    return pack(table(spark, sf_dir, "documents"), remember=1_000_000)


#: SQL has no tokeniser; brute force and round trips are in the tests.
ORACLE_SQL = None
