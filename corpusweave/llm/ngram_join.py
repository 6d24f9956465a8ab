"""N-gram Jaccard join: exact components of documents whose word-shingle sets are similar, by a prefix-tree join.

1. Every text becomes its set of distinct shingles, as 64-bit hashes; equal sets are one class from then on.
2. All sets are ordered alike, rare shingles first, by counts from a sketch of fixed size over the whole corpus. Any order is
   right; this one keeps what many documents share out of the prefixes.
3. Two sets that are similar enough share a shingle of their prefixes (a shorter one for the smaller set). Classes with a shingle in
   common choose a leader; a leader's classes, in blocks of bounded size, are joined in a prefix tree that holds the ordered sets
   from their frequent end, where copies agree. A walk shares the overlap so far among all sets below a node and leaves
   subtrees whose lengths can't reach the threshold any more, or whose sets are all linked to the probe already.
4. Of all pairs that share a prefix shingle only those in different components are left; these are joined in the same way.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusweave.llm.common import SPACED, Words, cut_lineage, id_text, mix, partitions, slices, table, tidied, unused, window_hashes
from corpusweave.llm.components import components


@dataclass(frozen=True)
class Join:
    """Shingles of `words` words; a link is 100 * intersection >= percent * union. The rest bounds memory, not results.

    common: prefixes are so long that similar sets have at least this many shingles of theirs in common (or all they need).
    hot: of a shingle that so many texts have, rows are salted.
    """

    words: int = 4
    percent: int = 85
    common: int = 8
    hot: int = 8192
    sketch_bits: int = 24
    block_sets: int = 256
    block_shingles: int = 1_000_000
    filter_bits: int = 26

    def least_overlap(self, a, b):
        """The intersection that sets of these sizes need at least."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def probe_prefix(self, n):
        """Prefix within which a set meets every similar set of at most its size."""
        return n - (-(-self.percent * n // 100)) + self.common

    def index_prefix(self, n):
        """Prefix within which a set meets every similar set of at least its size."""
        return n - (-(-2 * self.percent * n // (100 + self.percent))) + self.common


_FEW = np.zeros(0, np.uint64)


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer than n words the whole sequence; none without words."""
    words = Words(column, SPACED)
    whole = window_hashes(words.hash, n)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(whole[a : b - n + 1]))
        else:
            out.append(window_hashes(words.hash[a:b], b - a) if b > a else _FEW)
    return out


def signature(shingles: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), "<i8").tolist())


_BLOCK = 1 << 14


def _sets_and_counts(docs: DataFrame, how: Join, bits: int) -> DataFrame:
    """A row of each document (kind 0: its text's hash, signature and size) and of each part of each task's sketch (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << bits, np.uint32)
        for part in slices(batches):
            sets = shingle_sets(part.column(1), how.words)
            sigs = [signature(s) if len(s) else (None, None) for s in sets]
            np.add.at(count, (np.concatenate([_FEW, *sets]) >> np.uint64(64 - bits)).astype(np.int64), 1)
            n = part.num_rows
            yield _rows([np.zeros(n, np.int32), part.column(0), part.column(2), [a for a, _ in sigs], [b for _, b in sigs], [len(s) for s in sets], [None] * n])
        task = TaskContext.get().partitionId()
        size = min(_BLOCK, len(count))
        parts = [p for p in enumerate(np.minimum(count, 255).astype(np.uint8).reshape(-1, size)) if p[1].any()]
        k = len(parts)
        yield _rows([np.ones(k, np.int32), [None] * k, [None] * k, [i for i, _ in parts], [task] * k, [None] * k, [_packed(p) for _, p in parts]])

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(tidied(run), "kind int, doc_id long, text_hash long, s1 long, s2 long, n long, counts binary")


def _packed(counters: np.ndarray) -> bytes:
    """Byte counters as compressed bit planes: most counters are small, so all but the lowest planes vanish."""
    return zlib.compress(np.packbits(np.unpackbits(counters.reshape(-1, 1), axis=1).T).tobytes(), 1)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    """The byte counters of _packed, or sums as _add_sketches passes them on."""
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    if len(raw) > size:
        return raw.view(np.uint32).astype(np.uint64)
    return np.packbits(np.unpackbits(raw).reshape(8, size).T, axis=1).reshape(-1).astype(np.uint64)


def _rows(columns: list) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "doc_id", "text_hash", "s1", "s2", "n", "counts"])


def _add_sketches(parts: DataFrame, tasks: int, size: int) -> DataFrame:
    """Sums the tasks' sketches (a byte a counter) part by part, up to 32 at a time, so that no group grows with the input."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(_unpacked(c, size) for c in group["counts"].to_pylist())
        counts = zlib.compress(np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1)
        return pa.table({"at": group["at"].slice(0, 1), "task": group["task"].slice(0, 1), "counts": pa.array([counts], pa.binary())})

    parts = parts.select(F.col("s1").alias("at"), F.col("s2").alias("task"), "counts")
    while True:
        parts = parts.withColumn("task", F.floor(F.col("task") / 32)).groupBy("at", "task").applyInArrow(add, "at long, task long, counts binary")
        tasks = -(-tasks // 32)
        if tasks <= 1:
            return parts


@dataclass
class Order:
    """Places shingles by how often their bucket of the sketch was met (on a logarithmic scale), then by hash."""

    level: np.ndarray
    bits: int
    hot: int

    def salts(self, shingles: np.ndarray, by: int) -> np.ndarray:
        """0 for most shingles. The rows of one that very many texts hold are dealt over as many salts, from 1 on, as keep each group
        bounded; `by` tells a class from others."""
        over = self.level[(shingles >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.int64) - self.hot
        return np.where(over < 0, 0, 1 + by % (1 << np.maximum(over // 8 + 1, 0)))

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """The sorted hashes, rare first."""
        return shingles[np.argsort(self.level[(shingles >> np.uint64(64 - self.bits)).astype(np.int64)], kind="stable")]


def _order(parts: DataFrame, tasks: int, bits: int, hot: int) -> Order:
    """hot: a shingle in so many texts at least, and in 64 times as many as a counter counts on average, is hot."""
    level, total = np.zeros(1 << bits, np.uint8), 0
    size = min(_BLOCK, 1 << bits)
    for row in _add_sketches(parts, tasks, size).coalesce(8).toLocalIterator():  # 2**bits counters in all
        c = np.frombuffer(zlib.decompress(row.counts), np.uint32)
        total += int(c.sum(dtype=np.uint64))
        level[row.at * size : (row.at + 1) * size] = np.minimum(8 * np.log2(1.0 + c), 255)
    return Order(level, bits, min(int(8 * np.log2(1.0 + max(hot, 64 * total / (1 << bits)))), 255))


def _postings(docs: DataFrame, how: Join, order) -> DataFrame:
    """The prefix of each class: token, its salt and place in one number, class and size. A task tells each class once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for part in slices(batches):
            tokens, sigs, size = [], [], []
            for s in shingle_sets(part.column(1), how.words):
                if len(s) and (sig := signature(s)) not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(sig)
                    tokens.append(order.value(s)[: how.probe_prefix(len(s))])
                    sigs.append(sig)
                    size.append(len(s))
            if sigs:
                k = [len(t) for t in tokens]
                place = np.concatenate([np.arange(x) for x in k])
                sig = np.repeat(np.array(sigs), k, axis=0)
                salt = np.concatenate([order.value.salts(t, s[0]) for t, s in zip(tokens, sigs, strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(salt << 32 | place), pa.array(sig[:, 0]), pa.array(sig[:, 1]), pa.array(np.repeat(size, k).astype(np.int32))],
                    ["token", "at", "s1", "s2", "n"],
                )

    return docs.mapInArrow(tidied(run), "token long, at long, s1 long, s2 long, n int")


_SHARED = ["token", "salt", "s1", "s2", "n", "place", "l1", "l2", "ln"]


def _shared(postings: DataFrame, n: int) -> DataFrame:
    """Postings, each class once, of tokens that more than one class has, beside the row of the token's leader: the class
    with the fewest rarer shingles, as the text has that others are copies of. Each salt of a hot token has a leader of its own.

    The rows stream by in order of token, salt and place; only the last one and its leader are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((6, 0), np.int64)  # the last row, whose group may go on
        leader = np.zeros(6, np.int64)  # the first row of its group
        on = False  # whether it isn't the first of its group
        for batch in batches:
            token, at, s1, s2, size = (batch.column(c).to_numpy().astype(np.int64) for c in range(5))
            rows = np.concatenate([held, np.stack([token, at >> 32, s1, s2, size, at & 0xFFFFFFFF])], axis=1)
            rows = rows[:, np.concatenate([[True], (rows[:4, 1:] != rows[:4, :-1]).any(0)])]
            first = np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(0)])
            lead = rows[:, np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]
            if on:
                lead[:, (rows[:2] == leader[:2, None]).all(0)] = leader[:, None]
                first[0] = False
            alone = first & np.concatenate([first[1:], [False]])
            tell = ~alone | (rows[1] > 0)  # other salts have the token too
            tell[-1] = False  # told with the next rows
            out = np.concatenate([rows, lead[2:5]])[:, tell]
            held, leader, on = rows[:, -1:], lead[:, -1].copy(), not first[-1]
            if out.shape[1]:
                yield _shared_rows(out)
        if on or held[1].any():
            yield _shared_rows(np.concatenate([held, leader[2:5, None]]))

    rows = postings.repartition(n, "token", F.shiftright("at", 32)).sortWithinPartitions("token", "at", "s1", "s2")
    return rows.mapInArrow(tidied(run), "token long, salt int, s1 long, s2 long, n int, place int, l1 long, l2 long, ln int")


def _shared_rows(x: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32) if k in (1, 4, 5, 8) else c) for k, c in enumerate(x)], _SHARED)


@dataclass
class Node:
    """A run of tokens, then branches by their first token. below: the sets under it, with sizes from lo to hi."""

    run: np.ndarray
    branches: dict[int, Node] = field(default_factory=dict)
    ends: list[int] = field(default_factory=list)
    below: list[int] = field(default_factory=list)
    lo: int = 1 << 60
    hi: int = 0

    def over(self, k: int, n: int) -> None:
        self.below.append(k)
        self.lo, self.hi = min(self.lo, n), max(self.hi, n)


class PrefixTree:
    """Ordered sets in a path-compressed trie, joined with probes by overlap."""

    def __init__(self, how: Join):
        self.how, self.root, self.parent = how, Node(_FEW), []

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def insert(self, k: int, tokens: np.ndarray) -> None:
        n, node, at = len(tokens), self.root, 0
        node.over(k, n)
        while at < n:
            child = node.branches.get(int(tokens[at]))
            if child is None:
                child = node.branches[int(tokens[at])] = Node(tokens[at:])
                child.over(k, n)
                node, at = child, n
                break
            m = min(len(child.run), n - at)
            differ = np.flatnonzero(child.run[:m] != tokens[at : at + m])
            same = int(differ[0]) if len(differ) else m
            if same < len(child.run):  # the run is split
                upper = Node(child.run[:same], {int(child.run[same]): child}, [], child.below[:], child.lo, child.hi)
                child.run = child.run[same:]
                node.branches[int(upper.run[0])] = child = upper
            child.over(k, n)
            node, at = child, at + same
        node.ends.append(k)

    def links(self, tokens: np.ndarray, own: int | None) -> Iterator[int]:
        """Stored sets that are similar to the probe. own: its number; sets of its component are then passed over."""
        how, n = self.how, len(tokens)
        order = np.argsort(tokens, kind="stable")
        values = tokens[order]
        stack = [(self.root, 0, 0, 0)]  # node, tokens before it, overlap so far, tokens of the probe that are used up
        while stack:
            node, depth, overlap, used = stack.pop()
            if own is not None:
                root = self.find(own)
                if all(self.find(k) == root for k in node.below):
                    continue
            if len(node.run):
                at = np.minimum(np.searchsorted(values, node.run), n - 1)
                hit = order[at[values[at] == node.run]]
                if len(hit):
                    overlap, used = overlap + len(hit), int(hit.max()) + 1
                depth += len(node.run)
            for k in node.ends:
                if overlap >= how.least_overlap(n, depth):
                    yield k
            # Below: at most what is left of either set can still be added.
            if overlap + node.hi - depth >= how.least_overlap(n, node.hi) and overlap + n - used >= how.least_overlap(n, node.lo):
                stack.extend((child, depth, overlap, used) for child in node.branches.values())

    def join(self, sets: list[np.ndarray]) -> None:
        """Links all sets with each other; what they are linked with afterwards is find()."""
        for k, tokens in enumerate(sets):
            self.parent.append(k)
            for other in self.links(tokens, k):
                a, b = self.find(k), self.find(other)
                self.parent[max(a, b)] = min(a, b)
            self.insert(k, tokens)


def _join_blocks(rows: DataFrame, how: Join, n: int, all_pairs: bool) -> DataFrame:
    """Links within each block (b1, b2, salt): of all its sets, or of the leader (sorted first) with the others."""

    def links(key: tuple, block: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
        uniq = {(a, b): s for a, b, s in block}
        sigs = list(uniq)
        sets = [np.frombuffer(uniq[s], np.uint64)[::-1] for s in sigs]  # frequent first
        tree = PrefixTree(how)
        if all_pairs:
            tree.join(sets)
            for k, sig in enumerate(sigs):
                if (root := tree.find(k)) != k:
                    yield *sigs[root], *sig
            return
        lead = sigs.index((key[0], key[1]))
        for k, s in enumerate(sets):
            if k != lead:
                tree.insert(k, s)
        for k in tree.links(sets[lead], None):
            yield *sigs[lead], *sigs[k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, out = None, [], []

        def told() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["u1", "u2", "v1", "v2"])

        for batch in batches:
            for b1, b2, salt, s1, s2, data in zip(*(batch.column(c).to_pylist() for c in ("b1", "b2", "salt", "s1", "s2", "shingles")), strict=True):
                if key != (b1, b2, salt):
                    if len(block) > 1:
                        out.extend(links(key, block))
                    key, block = (b1, b2, salt), []
                block.append((s1, s2, data))
            if out:
                yield told()
        if len(block) > 1:
            out.extend(links(key, block))
        yield told()

    rows = rows.repartition(n, "b1", "b2", "salt").sortWithinPartitions("b1", "b2", "salt")
    found = rows.mapInArrow(tidied(run), "u1 long, u2 long, v1 long, v2 long")
    return found.select(F.struct(F.col("u1").alias("s1"), F.col("u2").alias("s2")).alias("u"), F.struct(F.col("v1").alias("s1"), F.col("v2").alias("s2")).alias("v"))


def _id_filter(ids: DataFrame, bits: int, expected: int) -> np.ndarray:
    """A bit for each hash of an id that is there, in a field of bounded size; more ids than bits only make it less sharp."""
    bits = min(bits, max(10, (8 * expected).bit_length()))
    size = min(1 << 13, 1 << bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, bool)
        for b in batches:
            seen[_bit(b.column(0), bits)] = True
        parts = [(i, np.packbits(p).tobytes()) for i, p in enumerate(seen.reshape(-1, size)) if p.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int64()), pa.array([p for _, p in parts], pa.binary())], ["at", "bits"])

    out = np.zeros(((1 << bits) // size, size // 8), np.uint8)
    for row in ids.where("id IS NOT NULL").coalesce(32).mapInArrow(tidied(run), "at long, bits binary").toLocalIterator():
        out[row.at] |= np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def _bit(column: pa.Array, bits: int) -> np.ndarray:
    return (mix(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _ordered_sets(docs: DataFrame, how: Join, order, wanted) -> DataFrame:
    """s1, s2 and the ordered shingles of the documents whose ids pass the filter (those without id always do)."""
    bits = len(wanted.value).bit_length() + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            at = _bit(batch.column(0), bits)
            keep = (wanted.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool) | batch.column(0).is_null().to_numpy(zero_copy_only=False)
            for part in slices([batch.filter(pa.array(keep))]):
                out = {}
                for s in shingle_sets(part.column(1), how.words):
                    if len(s) and (sig := signature(s)) not in seen:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(sig)
                        out[sig] = order.value(s).tobytes()
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64()), pa.array(list(out.values()), pa.binary())], ["s1", "s2", "shingles"])

    return docs.mapInArrow(tidied(run), "s1 long, s2 long, shingles binary")


def _verify(docs: DataFrame, pairs: DataFrame, classes: DataFrame, how: Join, order, n: int, all_pairs: bool) -> DataFrame:
    """Links among pairs (l1, l2: leader; s1, s2, n: member), in blocks of bounded size that each hold their leader."""
    spark = docs.sparkSession
    per = pairs.groupBy("l1", "l2").agg(F.greatest(F.ceil(F.count(F.lit(1)) / how.block_sets), F.ceil(F.sum("n") / how.block_shingles)).cast("int").alias("blocks"))
    members = pairs.join(per, ["l1", "l2"]).select("s1", "s2", F.col("l1").alias("b1"), F.col("l2").alias("b2"), F.pmod(F.xxhash64("s1", "s2"), F.col("blocks")).cast("int").alias("salt"))
    leaders = per.select(F.col("l1").alias("s1"), F.col("l2").alias("s2"), F.col("l1").alias("b1"), F.col("l2").alias("b2"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"))
    places = cut_lineage(members.union(leaders))
    needed = cut_lineage(places.select("s1", "s2").distinct().join(classes, ["s1", "s2"]).select(F.col("least_id").alias("id")))
    wanted = spark.sparkContext.broadcast(_id_filter(needed, how.filter_bits, needed.count()))
    sets = _ordered_sets(docs, how, order, wanted)
    return _join_blocks(sets.join(places, ["s1", "s2"]), how, n, all_pairs)


def _verify_some(docs: DataFrame, pairs: DataFrame, classes: DataFrame, how: Join, order, n: int) -> DataFrame | None:
    """Links of each leader with its members; None if there are no pairs, so that no text is read again."""
    pairs = cut_lineage(pairs)
    return None if pairs.isEmpty() else cut_lineage(_verify(docs, pairs, classes, how, order, n, False))


def _listed(place: np.ndarray, token: np.ndarray, held_by: np.ndarray, n: int, how: Join) -> list[tuple[int, int]]:
    """Of a set's open tokens, in order of place: the tokens that a similar set may meet it at, each with the largest size of such a set.

    If a similar set leaves it b misses, the first `common` tokens that both share (or all they need) stand among the first b + common places. The
    least held of these is what both meet at. At each token the set has so many tokens there that are held as much or more: the last of the
    least `common` places of those says from which b on it may be the one. So a token that nearly all sets hold is met at by no more sets than
    could be similar, unless rarer ones are few.
    """
    need = min(how.common, -(-how.percent * n // 100))
    least, out, heap = -(-how.percent * n // 100), [], []
    for k in np.lexsort((token, held_by))[::-1].tolist():  # most held first
        heapq.heappush(heap, -int(place[k]))
        if len(heap) > need:
            heapq.heappop(heap)
        if len(heap) == need:
            b = max(0, max(int(place[k]), -heap[0]) - how.common + 1, int(place[k]) - k)  # place - k tokens before it are in no other component
            largest = (n - b) * (100 + how.percent) // how.percent - n
            if largest >= least:
                out.append((int(token[k]), largest))
    return out


def _open(shared: DataFrame, part_of: DataFrame, how: Join) -> DataFrame:
    """A row of each class that may be similar to one of another component: its open tokens, those that several components have, by
    place, and those of them at which a similar set may meet it (see `_listed`), by exact counts. A hot token counts as open, and as the most held.

    What stands in a prefix and isn't open is in no set of another component, so a token behind more misses than a similar set may have can't help.
    """
    sig = F.struct("s1", "s2")
    named = shared.select("token", "salt", "s1", "s2", "n", "place", sig.alias("node")).join(part_of, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node")
    group = Window.partitionBy("token", "salt")  # of bounded size, as hot tokens are salted
    opened = (
        named.select("*", F.min("component").over(group).alias("a"), F.max("component").over(group).alias("b"), F.count(F.lit(1)).over(group).alias("held_by"))
        .where("a <> b OR salt > 0").withColumn("held_by", F.when(F.col("salt") > 0, F.lit(1 << 40)).otherwise(F.col("held_by")))
    )
    least = f"least({how.common}, cast(ceil({how.percent}L * n / 100) AS int))"
    found = (
        opened.groupBy("s1", "s2", "n", "component").agg(F.sort_array(F.collect_list(F.struct("place", "token", "held_by"))).alias("all"))
        .withColumn("all", F.expr(f"filter(all, (x, i) -> x.place - i <= n - ceil({how.percent}L * n / 100))")).where(f"size(all) >= {least}")
        .select("s1", "s2", F.col("n").cast("long").alias("n"), "component", F.expr("transform(all, x -> cast(x.place AS bigint))").alias("place"), "all.token", "all.held_by")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("token", pa.int64()), ("largest", pa.int64())]))
        for batch in batches:
            lists = [batch.column(k) for k in (4, 5, 6)]
            rows = zip(batch.column(2).to_pylist(), *([x.values.to_numpy() for x in col] for col in lists), strict=True)
            met = [[{"token": t, "largest": m} for t, m in _listed(place, token, held_by, n, how)] for n, place, token, held_by in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(met, kind)], names=[*batch.schema.names[:6], "met"])

    ids = "component struct<s1:bigint,s2:bigint>"
    return cut_lineage(found.mapInArrow(tidied(run), f"s1 long, s2 long, n long, {ids}, place array<bigint>, token array<bigint>, met array<struct<token:bigint,largest:bigint>>"))


def _pairs(opened: DataFrame, how: Join) -> DataFrame:
    """Pairs of open classes of different components (l1, l2: the smaller set; s1, s2) that meet at a token and whose sizes fit each other's there.

    Sets are dealt by token and by classes of their own and the other's size, and components meet before sets do: neither sets of one component nor
    sets whose sizes can't fit are paired first and left out then.
    """
    class_of = lambda c: F.floor(F.log(c.cast("double")) / float(np.log(1.05))).cast("int")
    span = lambda a, b: F.explode(F.sequence(class_of(a), class_of(b)))
    n, largest = F.col("n"), F.col("largest")
    met = opened.select("s1", "s2", "n", "component", F.explode("met").alias("r")).select("s1", "s2", "n", "component", "r.*")
    x = met.where(largest >= n).withColumn("kx", class_of(n)).withColumn("ky", span(n, largest))
    y = met.withColumn("ky", class_of(n)).withColumn("kx", span(F.ceil(F.lit(how.percent) * n / 100), F.least(largest, n)))
    key = ["token", "kx", "ky"]
    side = lambda df, a: df.select(*key, *(F.col(c).alias(f"{a}_{c}") for c in ("component", "s1", "s2", "n", "largest")))
    x, y = side(x, "x"), side(y, "y")
    parts = x.select(*key, "x_component").distinct().join(y.select(*key, "y_component").distinct(), key).where("x_component <> y_component")
    both = parts.join(x, [*key, "x_component"]).join(y, [*key, "y_component"])
    smaller = "(x_n < y_n OR x_n = y_n AND (x_s1 < y_s1 OR x_s1 = y_s1 AND x_s2 < y_s2))"
    fits = both.where(f"x_n <= y_largest AND y_n <= x_largest AND {smaller}")
    return fits.select(F.col("x_s1").alias("l1"), F.col("x_s2").alias("l2"), F.col("y_s1").alias("s1"), F.col("y_s2").alias("s2")).distinct()


def _candidates(opened: DataFrame, how: Join) -> DataFrame:
    """Pairs of open classes (l1, l2: the smaller set; s1, s2, n) of different components that share as much of their prefixes as similar sets do."""
    need = _need(how.percent, "x.n", "y.n")
    own = opened.select(F.col("s1").alias("l1"), F.col("s2").alias("l2"), F.struct("n", "place", "token").alias("x"))
    other = opened.select("s1", "s2", F.struct("n", "place", "token").alias("y"))
    prefix = lambda t: f"slice({t}.token, 1, size(filter({t}.place, p -> p < {t}.n - {need} + {how.common})))"
    return _pairs(opened, how).join(own, ["l1", "l2"]).join(other, ["s1", "s2"]).where(f"size(array_intersect({prefix('x')}, {prefix('y')})) >= least({how.common}L, {need})").select("l1", "l2", "s1", "s2", F.col("y.n").alias("n"))


def _need(percent: int, a: str, b: str) -> str:
    """SQL: the intersection that sets of sizes a and b need at least."""
    return f"ceil({percent}L * ({a} + {b}) / {100 + percent})"


def _rows_by_component(docs: DataFrame, how: Join, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, n, component (a class; null without words) and component_id of every input row."""
    spark = docs.sparkSession
    docs = id_text(docs, id_col, text_col)
    docs = docs.select(docs.doc_id.cast("long").alias("doc_id"), "text")
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(how.sketch_bits, max(10, (chars // 64).bit_length()))
    n = max(partitions(spark), 1)
    first = cut_lineage(_sets_and_counts(docs, how, bits))
    sized = first.where("kind = 0")
    order = spark.sparkContext.broadcast(_order(first.where("kind = 1"), first.rdd.getNumPartitions(), bits, how.hot))  # 2**bits bytes
    classes = sized.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("least_id"))

    p = how.percent
    shared = cut_lineage(_shared(_postings(docs, how, order), n))
    # What this leaves out, because a token's leader was another class, the pairs below bring back.
    chosen = (
        shared.where(f"(s1 <> l1 OR s2 <> l2) AND 100L * least(n, ln) >= {p}L * greatest(n, ln)")
        .groupBy("s1", "s2", "n", "l1", "l2", "ln").agg(F.count(F.lit(1)).alias("c"))
        .where(f"c >= least({how.common}L, {_need(p, 'n', 'ln')})")
        .groupBy("s1", "s2", "n").agg(F.max_by(F.struct("l1", "l2"), F.struct("c", "l1", "l2")).alias("l"))
        .select("s1", "s2", "n", "l.l1", "l.l2")
    )
    links = cut_lineage(_verify(docs, cut_lineage(chosen), classes, how, order, n, True))
    part_of = components(links)
    # What the blocks left open: pairs with prefix tokens in common whose components differ.
    more = _verify_some(docs, _candidates(_open(shared, part_of, how), how), classes, how, order, n)
    if more is not None:
        part_of = components(part_of.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
    named = classes.withColumn("node", F.struct("s1", "s2")).join(part_of, "node", "left").select("s1", "s2", "least_id", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = cut_lineage(named.join(least, "component").select("s1", "s2", "component", "component_id"))
    columns = ["doc_id", "text_hash", "n", "component", "component_id"]
    without = sized.where("n = 0").withColumn("component", F.lit(None).cast(named.schema["component"].dataType)).withColumn("component_id", F.col("doc_id"))
    return sized.where("n > 0").join(named, ["s1", "s2"]).select(*columns).union(without.select(*columns))


def jaccard_components(docs: DataFrame, how: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every document, one row for each input row.

    Null or empty text, or white space alone: no shingles, linked with nothing, a component of its own. Fewer words than a shingle: the
    whole sequence is the only shingle. Repeated rows and equal texts: one class, and so one component. Null id: takes part
    in links; its component is named by the others, or null if there are none. Empty input: no rows.
    """
    return _rows_by_component(docs, how, id_col, text_col).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_first(docs: DataFrame, how: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the document with the smallest id, with all its columns.

    Rows with the same id and text: one of them. Rows with the same id whose texts differ: each goes by its own component; if they are in one
    whose smallest id they bear, one of them stays. Documents without words are all kept, and so are those without an id, which nothing
    tells apart. Extra columns may have any names.
    """
    rows = _rows_by_component(docs, how, id_col, text_col).where("n > 0 AND doc_id = component_id")
    per = rows.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    chosen = cut_lineage(per.groupBy("component").agg(F.min(F.struct("text_hash", "doc_id", "rows")).alias("r")).select("r.*"))
    names: list[str] = []
    for _ in range(3):
        names.append(unused("kept", [*docs.columns, *names]))
    key, text_hash, mark = names
    own = docs.withColumn(key, F.col(id_col).cast("long")).withColumn(text_hash, F.xxhash64(text_col))
    ones = chosen.select(F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash)).distinct().withColumn(mark, F.lit(True))
    kept = own.join(ones, [key, text_hash], "left").where(F.col(mark) | F.col(key).isNull() | F.col(text_col).isNull() | ~F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
    if not chosen.where("rows > 1").isEmpty():
        kept = kept.withColumn(mark, F.struct(key, text_hash, F.when(F.col(mark).isNull(), F.monotonically_increasing_id()))).dropDuplicates([mark])
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents: 4-word shingles, Jaccard similarity of at least 0.85."""
    return jaccard_components(table(spark, sf_dir, "documents"))


#: Components need recursion over all links; brute force is in the tests.
ORACLE_SQL = None
