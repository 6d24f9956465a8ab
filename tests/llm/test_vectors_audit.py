"""Top-k search, hard negatives and the filter audit against brute force, with nulls, ties, repeated rows, odd vectors and tiny cells."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusweave.llm import filter_audit, hard_negatives, topk_search, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score int, qb string, rank int, row int"


def some_vectors(n=400, d=20, seed=3):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 1) * (4 if k % 7 == 0 else 1) for k in range(d)], r.randrange(3)) for i in range(n)]
    hot = [0.5] * d
    rows += [(n + i, hot, i % 2) for i in range(120)]  # copies
    rows += [rows[10], rows[10], (n + 500, None, 1), (None, hot, 1), (n + 600, [1.0, None], 1), (n + 700, [float("nan")] * d, 1)]
    rows += [(n + 800, [float("inf")] * d, 2), (n + 900, [], 1), (n + 1000, [3.0], None), (n + 1100, [2.0, -1.0], 2), (n + 1200, [0.0] * d, 0)]
    return rows


def valid(rows, need_label=False):
    out = {}
    for i, v, label in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or (need_label and label is None):
            continue
        out[i] = ([math.floor(256 * float(np.float32(x))) for x in v], label)
    return out


def inner(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def frame_of(spark, rows, kind="float"):
    return spark.createDataFrame([(*x, "a", 1, "b", 2, 3) for x in rows], SCHEMA.replace("float", kind)).repartition(3)


@pytest.mark.parametrize(("block", "queries"), [(65_536, 16_384), (50, 7)])
def test_top_k(spark, block, queries):
    rows = some_vectors()
    have = valid(rows)
    want = set()
    for q, (v, _) in have.items():
        if q % 10 == 0:
            order = sorted((-inner(v, w), i) for i, (w, _) in have.items() if i != q)[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(order)}
    got = topk_search.top_k(frame_of(spark, rows), F.col("vec_id") % 10 == 0, block=block, most_queries=queries).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_top_k_prunes_and_stays_exact():
    r = np.random.default_rng(1)
    x = np.floor(r.normal(0, 40, (3000, 64)) * np.where(np.arange(64) < 8, 5, 0.5))
    ids = np.arange(3000)
    of, found, score = topk_search.search(x[:130], ids[:130], x, ids, 4, np.full(130, -(1 << 63)))
    s = x[:130] @ x.T
    s[ids[:130], ids[:130]] = -np.inf
    want = {(q, i, int(s[q, i])) for q in range(130) for i in np.lexsort((ids, -s[q]))[:4]}
    assert set(zip(of.tolist(), found.tolist(), score.tolist(), strict=True)) == want


def test_few_large_and_no_vectors(spark):
    big = [(0, [1e30, 1.0], 1), (50, [1e30, -1.0], 1), (51, [-1e30, 0.0], 2), (52, [1.0, 1.0], 2)]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk_search.top_k(frame_of(spark, big, "double"), F.col("vec_id") % 50 == 0).collect()}
    assert got[0, 1] == (50, (1 << 63) - 1) and got[0, 3] == (51, 3 - (1 << 63)) and len(got) == 6
    assert hard_negatives.mine(frame_of(spark, big, "double"), F.col("vec_id") % 50 == 0).count() == 0
    none = frame_of(spark, [])
    assert topk_search.top_k(none, F.col("vec_id") % 50 == 0).count() == 0 and hard_negatives.mine(none, F.col("vec_id") % 50 == 0).count() == 0
    one = frame_of(spark, big[:1])
    assert topk_search.top_k(one, F.col("vec_id") % 50 == 0).count() == 0 and hard_negatives.mine(one, F.col("vec_id") % 50 == 0).count() == 0


def test_large_integers_are_exact():
    a, b = np.array([[2.0**40 + 1, 3]]), np.array([[2.0**20, 5], [2.0**60, 0]])
    assert not vectors.exact(a, b)
    assert vectors.long_scores(a, b).tolist() == [[(2**40 + 1) * 2**20 + 15, 2**63 - 1]]


@pytest.mark.parametrize(("block", "anchors"), [(65_536, 16_384), (60, 9)])
def test_hard_negatives(spark, block, anchors):
    rows = some_vectors(seed=5)
    have = valid(rows, need_label=True)
    want = set()
    for a, (v, label) in have.items():
        if a % 9 == 0:
            order = sorted((-inner(v, w), i) for i, (w, y) in have.items() if i != a and y == label)[:5]
            for s, p in order:
                fits = sorted((-x, i) for i, (w, y) in have.items() if y != label and 30 * -s <= 100 * (x := inner(v, w)) <= 90 * -s)[:10]
                want |= {(a, p, k + 1, i, -s, -x) for k, (x, i) in enumerate(fits)}
    got = hard_negatives.mine(frame_of(spark, rows), F.col("vec_id") % 9 == 0, block=block, most_anchors=anchors).collect()
    assert len(got) == len(want) > 1000 and {tuple(r) for r in got} == want


def test_trees_leave_pairs_out():
    r = np.random.default_rng(2)
    centers = r.normal(0, 100, (20, 16))
    x = np.floor(centers[r.integers(0, 20, 4000)] + r.normal(0, 2, (4000, 16)))
    a, b = hard_negatives.Tree(x[:200], 16), hard_negatives.Tree(x, 64)
    assert sorted(b.order) == list(range(4000))
    pairs = []
    s = a.x @ b.x.T
    low = np.sort(s, 1)[:, -5].copy()
    hard_negatives.dual(a, b, low, np.full(200, np.inf), lambda rows, cols: pairs.append((rows, cols)))
    seen = np.zeros_like(s, bool)
    for rows, cols in pairs:
        seen[rows, cols] = True
    assert seen[s >= low[:, None]].all() and seen.mean() < 0.5


def audit_by_hand(docs, labels):
    low = {}
    for i, t, _ in docs:
        if i is not None:
            low[t or ""] = min(low.get(t or "", i), i)
    marks = {}
    for i, q, t in labels:
        have = marks.get(i, (0, 0))
        marks[i] = (max(have[0], int(q == 1)), max(have[1], int(t == 1)))
    rows = []
    for i, t, part in docs:
        t = t or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        bad = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > low[t],
        }
        rows.append((part or "", {f for f in bad if bad[f]}, marks.get(i, (0, 0)) if i is not None else (0, 0)))
    out = []
    for part in {p for p, _, _ in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        removed = {}
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                removed[order, f] = [(bad, m) for bad, m in own if f in bad and not bad & set(order[:k])]
        shapley = Counter()
        for (_, f), gone in removed.items():
            shapley[f] += len(gone)
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                gone = removed[order, f]
                out.append(
                    (part, "".join(order), k + 1, sum(not bad & set(order[: k + 1]) for bad, _ in own), len(gone), sum(f in bad for bad, _ in own) - len(gone),
                     sum(bad == {f} for bad, _ in own), sum(m[0] for _, m in gone), sum(m[1] for _, m in gone), shapley[f])
                )
    return out


@pytest.mark.parametrize("held", [64_000_000, 300])
def test_filter_audit(spark, odd_texts, held):
    r = random.Random(7)
    docs = [(i, t, r.choice(["x", "y", None])) for i, t in odd_texts]
    long = " ".join(f"w{k}" for k in range(250))
    docs += [(100 + k, r.choice([long, long.upper(), long + " #", "short", "É" * 40, f"{long} {k}", "a " * 300]), r.choice(["x", "y", "z"])) for k in range(150)]
    docs += [docs[-1], (40, long, "x"), (40, long, "y"), (40, long, "x")]
    labels = [(100 + k, r.choice([0, 1, None]), r.choice([0, 1, None])) for k in range(120)] + [(100, 1, 1), (None, 1, 1), (40, 1, 0)]
    frame = spark.createDataFrame([(i, t, p, 1, "m", 2) for i, t, p in docs], "doc_id long, text string, source string, mask int, part string, n int").repartition(5)
    marks = spark.createDataFrame([(*x, "q") for x in labels], "doc_id long, quality int, toxic int, source string")
    got = sorted(tuple(x) for x in filter_audit.audit(frame, marks, held_bytes=held).collect())
    assert got == sorted(audit_by_hand(docs, labels))
    assert filter_audit.audit(frame.limit(0), marks).count() == 0


def test_chains_keep_different_texts_of_one_fingerprint():
    c = filter_audit.Chains()
    rows = lambda i: {(i, "p", 0): 1}
    assert c.add(1, b"a", 5, rows(5)) == {} and c.add(1, b"b", 3, rows(3)) == {}
    assert c.add(1, b"a", 2, rows(2)) == {(5, "p", 16): 1} and c.add(1, b"b", 9, rows(9)) == {(9, "p", 16): 1}
    assert sorted((t, i) for _, t, i, _ in c.drain()) == [(b"a", 2), (b"b", 3)]
