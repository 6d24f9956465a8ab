"""Filter interaction audit: what each filter removes, in every order of the filters, and what it would remove alone."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import permutations

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm.common import partitions, small_batches, table

#: UTF-8 bytes of distinct texts that a task holds to find copies among its own rows, before the rest is shuffled; and of texts that a partition is
#: meant to get then.
HELD_BYTES = 64_000_000
_CAPITALS = bytes(range(65, 91))
_INNER = bytes(range(128, 192))  # bytes of a code point after its first
_SYMBOLS = re.compile(rb"[#$%&*|]")
FILTERS = "ABCDE"
COPY = 1 << 4
#: A row: part, mask of failed filters, how many such rows. An entry of a chain: a text, its least id, and the rows with that id.
Rows = dict[tuple[int | None, str, int], int]


def failed(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # at 0x20 and 0x09-0x0D
    points = len(text) - len(text.translate(None, _INNER)) if not text.isascii() else 0
    points = len(text) - points
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * capitals > 2 * points) << 2 | bool(_SYMBOLS.search(text)) << 3


class Chains:
    """Texts by fingerprint. Texts of one fingerprint form a chain; each is kept whole, with its least id and the rows that have that id."""

    def __init__(self):
        self.chains: dict[int, list[list]] = {}
        self.held = 0

    def add(self, print_: int, text: bytes, doc_id: int, rows: Rows) -> Rows:
        """Takes in rows of a text and an id; gives out those that turn out not to have the least id, as copies."""
        chain = self.chains.setdefault(print_, [])
        entry = next((e for e in chain if e[0] == text), None)
        if entry is None:
            chain.append([text, doc_id, dict(rows)])
            self.held += len(text) + 200
            return {}
        if doc_id > entry[1]:
            return _as_copies(rows)
        if doc_id < entry[1]:
            out, entry[1], entry[2] = _as_copies(entry[2]), doc_id, dict(rows)
            return out
        for k, n in rows.items():
            entry[2][k] = entry[2].get(k, 0) + n
        return {}

    def drain(self) -> Iterator[tuple[int, bytes, int, Rows]]:
        for print_, chain in self.chains.items():
            yield from ((print_, *entry) for entry in chain)
        self.chains, self.held = {}, 0


def _as_copies(rows: Rows) -> Rows:
    return {(i, part, mask | COPY): n for (i, part, mask), n in rows.items()}


def _local(held_bytes: int) -> Callable[[Iterable], Iterator]:
    """Rows to (None, settled rows) and ((fingerprint, id), (text, rows)) of the least ids that a task has seen of each text."""

    def run(docs: Iterable) -> Iterator:
        seen = Chains()
        out = lambda: (((p, i), (t, rows)) for p, t, i, rows in seen.drain())
        for doc_id, text, print_, part in docs:
            text = bytes(text)
            rows = {(doc_id, part, failed(text)): 1}
            settled = rows if doc_id is None else seen.add(print_, text, doc_id, rows)
            if settled:
                yield None, settled
            if seen.held > held_bytes:
                yield from out()
        yield from out()

    return run


def _least(sorted_rows: Iterable) -> Iterator[Rows]:
    """Rows sorted by fingerprint and id, settled: only the chain of one fingerprint is held at a time."""
    chains, at = Chains(), None
    for (print_, doc_id), (text, rows) in sorted_rows:
        if print_ != at:
            yield from (entry[3] for entry in chains.drain())
            at = print_
        settled = chains.add(print_, text, doc_id, rows)
        if settled:
            yield settled
    yield from (entry[3] for entry in chains.drain())


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", held_bytes: int = HELD_BYTES) -> DataFrame:
    """doc_id, part, mask (bit k: fails the k-th of the filters A to E), n: how many rows are so.

    Each task finds copies among its own rows first, so that of a text that very many rows hold a task sends one on. Those are routed by the
    xxhash64 of the text and sorted by it, and one chain of texts of one fingerprint is held at a time; texts are compared whole.
    Null text: empty, so null and empty texts are copies of each other. Null part: empty string. Null id: no id is smaller, nor is it smaller than any, so
    such rows are never copies and make none. Repeated rows (of one id and text) are no copies of each other. Empty table: no rows.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long"), text.cast("binary"), F.xxhash64(text), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")))
    local: RDD = rows.rdd.mapPartitions(_local(held_bytes))
    # An RDD's partitions aren't sized while it runs, so their number follows the bytes of all texts.
    n = max(partitions(docs.sparkSession), (docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // held_bytes + 1)
    # Settled rows have no text any more: they stay with their task's output, the others are dealt out by fingerprint.
    routed = local.filter(lambda x: x[0] is not None).repartitionAndSortWithinPartitions(n, lambda key: key[0] % n)
    settled = local.filter(lambda x: x[0] is None).values().union(routed.mapPartitions(_least))
    flat = settled.flatMap(lambda found: ((*key, n) for key, n in found.items()))
    return docs.sparkSession.createDataFrame(flat, "doc_id long, part string, mask int, n long")


def _orders(names: str = FILTERS) -> list[str]:
    return ["".join(p) for p in permutations(names)]


def report(counts: np.ndarray, names: str = FILTERS) -> Iterator[tuple]:
    """For each order and step of the filters: filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    counts: rows, good rows, toxic rows x masks.
    """
    mask = np.arange(counts.shape[1])
    n = counts[0]
    orders = _orders(names)
    first = {(f, before): int(n[(mask >> f & 1 == 1) & (mask & before == 0)].sum()) for f in range(len(names)) for before in range(len(mask)) if not before >> f & 1}
    befores = [[sum(1 << names.index(c) for c in order[:k]) for k in range(len(names) + 1)] for order in orders]
    shapley = [sum(first[f, b[order.index(names[f])]] for order, b in zip(orders, befores, strict=True)) for f in range(len(names))]
    for order, before in zip(orders, befores, strict=True):
        for step, letter in enumerate(order):
            f = names.index(letter)
            fails, still = mask >> f & 1 == 1, mask & before[step] == 0
            yield (
                order, step + 1, int(n[mask & before[step + 1] == 0].sum()), first[f, before[step]], int(n[fails & ~still].sum()), int(n[1 << f]),
                int(counts[1, fails & still].sum()), int(counts[2, fails & still].sum()), shapley[f],
            )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", held_bytes: int = HELD_BYTES) -> DataFrame:
    """What each of five filters does to the documents of each part, in all orders of the filters: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    Documents become counts by mask (see `masks`, also for nulls, copies and repeated rows), as vectors that are merged in the tasks first and then by part,
    so a part with most of the rows is one vector a task. Only those vectors are turned into orders. Of repeated labels of an id the greatest
    holds; rows without label or id are neither good nor toxic. No documents: no rows.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*(F.max((F.col(c) == 1).cast("int")).alias(c) for c in ("quality", "toxic")))
    known = masks(docs, id_col, text_col, part_col, held_bytes).join(marks, "doc_id", "left")
    rows = known.select("part", "mask", "n", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("quality", "toxic"))).groupBy("part", "mask", "quality", "toxic").agg(F.sum("n").alias("n"))
    size = 1 << len(FILTERS)

    def count(counts: np.ndarray, row: Sequence) -> np.ndarray:
        mask, n, good, toxic = row
        counts[:, mask] += np.array([n, n * good, n * toxic])
        return counts

    pairs = rows.rdd.map(lambda r: (r.part, (r.mask, r.n, r.quality, r.toxic)))
    merged = pairs.combineByKey(lambda row: count(np.zeros((3, size), np.int64), row), count, lambda a, b: a + b, partitions(docs.sparkSession))
    longs = ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return docs.sparkSession.createDataFrame(merged.flatMap(lambda x: ((x[0], *row) for row in report(x[1]))), f"part string, filter_order string, step int, {longs}")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents, by source."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part, ((len(w) < 200)::INTEGER + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INTEGER
             + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INTEGER + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
             + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INTEGER) AS mask FROM d),
l AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.x || b1.x || c1.x || d1.x || e1.x AS filter_order, [a.bit, b1.bit, c1.bit, d1.bit, e1.bit] AS bits FROM b AS a, b AS b1, b AS c1, b AS d1, b AS e1
      WHERE len(list_distinct([a.x, b1.x, c1.x, d1.x, e1.x])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::INTEGER AS before FROM o, range(1, 6) AS u(step)),
r AS (SELECT part, filter_order, step::INTEGER AS step, bit,
             sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM s, c GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""
