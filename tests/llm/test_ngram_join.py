from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from corpusweave.llm import ngram_join
from corpusweave.llm.components import components
from corpusweave.llm.ngram_join import Join, PrefixTree, jaccard_components, keep_first

from .conftest import WORDS


def brute(rows, n=4, percent=85):
    """Counter of (doc_id, n_shingles, component_id)."""
    import re

    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def near_copies(seed, n=60):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        if out and rng.random() < 0.7:
            w = rng.choice(out).split(" ")
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            out.append(" ".join(w))
        else:
            out.append(" ".join(rng.choice(WORDS).upper() if rng.random() < 0.1 else rng.choice(WORDS) for _ in range(rng.choice([1, 3, 5, 30, 80]))))
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("how", [Join(), Join(words=2, percent=60, block_sets=3, sketch_bits=10)])
def test_same_as_brute_force(frame, seed, how):
    rows = near_copies(seed)
    assert got(jaccard_components(frame(rows), how)) == brute(rows, how.words, how.percent)


def with_passage(seed, n=70):
    """Near copies of longer texts, most of which hold one passage that takes up much of them, and a sentence that all have."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(400))
    passage, out = [word() for _ in range(90)], []
    for _ in range(n):
        if out and rng.random() < 0.5:
            w = list(rng.choice(out))
            for _ in range(rng.randrange(8)):
                w[rng.randrange(len(w))] = word()
        else:
            w = [word() for _ in range(rng.choice([5, 20, 30, 60]))] + passage[: rng.choice([0, 60, 90, 90])]
        out.append(w)
    return [(i, " ".join([*w, "they all end alike here"])) for i, w in enumerate(out)]


@pytest.mark.parametrize("how", [Join(hot=2), Join(hot=2, common=2, block_sets=4, sketch_bits=10), Join(words=5, percent=80, common=16), Join(words=2, percent=70)])
def test_common_passages_same_as_brute_force(frame, how):
    rows = with_passage(how.words)
    assert got(jaccard_components(frame(rows), how)) == brute(rows, how.words, how.percent)


def test_hot_tokens_are_dealt_over_salts():
    level = np.zeros(1 << 10, np.uint8)
    level[5] = 120
    order = ngram_join.Order(level, 10, 104)
    shingles = np.array([5 << 54, 6 << 54], np.uint64)
    found = {tuple(order.salts(shingles, k).tolist()) for k in range(-20, 20)}
    assert found == {(1 + k, 0) for k in range(8)}


def test_sketch_parts_round_trip():
    rng = np.random.default_rng(1)
    for size in (1 << 10, 1 << 14):
        c = rng.integers(0, 256, size).astype(np.uint8)
        assert (ngram_join._unpacked(ngram_join._packed(c), size) == c).all()


def test_keep_first_goes_by_row(spark):
    a, b = " ".join(WORDS), " ".join(reversed(WORDS))
    near = " ".join([*WORDS * 3, "end"])
    rows = [(1, a, "x", 1), (5, b, "y", 2), (5, a, "z", 3), (7, near, "n", 4), (7, " ".join(WORDS * 3), "m", 5), (8, b, "w", 6), (9, None, "v", 7), (9, None, "v", 8), (None, a, "u", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _kept_id string, _row int").withColumn("kept", F.lit(1))
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    out = sorted(r._row for r in kept.collect())
    assert len([k for k in out if k in (4, 5)]) == 1 and [k for k in out if k not in (4, 5)] == [1, 2, 7, 8, 9]
    again = keep_first(docs.union(docs).where("_row < 4"))
    assert sorted((r.doc_id, r._kept_id) for r in again.collect()) == [(1, "x"), (5, "y")]


def test_odd_rows(frame, odd_texts):
    assert got(jaccard_components(frame(odd_texts))) == brute(odd_texts)
    kept = keep_first(frame(odd_texts))
    assert kept.columns == frame(odd_texts).columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=repr)
    assert ids == sorted([1, 3, 4, 5, 6, 8, 9, 10, 11, 12, None, None], key=repr)  # all without an id


def test_empty(frame, spark):
    assert jaccard_components(frame([(1, "x")]).limit(0)).collect() == []
    assert keep_first(frame([(1, "x")]).limit(0)).collect() == []


def test_prefixes_lose_no_pair():
    how = Join()
    for a in range(1, 80):
        for b in range(a, 80):
            o = how.least_overlap(a, b)
            if o <= a:  # sets that share o of their shingles share one of any prefixes of these lengths
                assert how.probe_prefix(b) >= b - o + 1 and how.index_prefix(a) >= a - o + 1


def test_tree_finds_all_links():
    rng = np.random.default_rng(0)
    how = Join(percent=60)
    base = rng.integers(0, 60, (40, 12))
    sets = [np.unique(np.concatenate([b, base[k // 3][:9]])).astype(np.uint64) for k, b in enumerate(base)]
    tree = PrefixTree(how)
    for k, s in enumerate(sets):
        tree.parent.append(k)
        tree.insert(k, s)
    for s in sets:
        want = {k for k, o in enumerate(sets) if 100 * len(np.intersect1d(s, o)) >= 60 * len(np.union1d(s, o))}
        assert set(tree.links(s, None)) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (139, 200)]
    for few in (0, 1000):
        out = dict(components(spark.createDataFrame(edges, "u long, v long"), few=few).collect())
        assert out == {**{i: 0 for i in range(31)}, **{k: 100 for k in [*range(100, 140), 200]}}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(ngram_join.op1_ngram_jaccard(spark, SF)) == brute(docs)


def templated(n, inserted=3, length=84, seed=4):
    """Texts of one template with inserted words, each of which three texts share: none alike enough, but all with most shingles in common."""
    rng = random.Random(seed)
    template = [f"t{k}" for k in range(length + 3)]
    words = [f"w{k // 3}" for k in range(n * inserted)]
    rng.shuffle(words)
    out = []
    for i in range(n):
        w = list(template)
        for word, at in zip(words[i * inserted :], rng.sample(range(4, length - 4, 5), inserted), strict=False):
            w.insert(at, word)
        out.append((i, " ".join(w)))
    return out


def test_templated_texts_are_not_all_paired(spark, frame, monkeypatch):
    made = []
    plain = ngram_join._pairs
    monkeypatch.setattr(ngram_join, "_pairs", lambda opened, how: made.append(plain(opened, how).count()) or plain(opened, how))
    for n in (150, 300, 600):
        rows = templated(n)
        assert got(jaccard_components(frame(rows))) == brute(rows)
    assert made[2] < 3 * max(made[0], 600), made
    for inserted in (1, 2, 4):
        rows = templated(120, inserted)
        assert got(jaccard_components(frame(rows))) == brute(rows)


def test_listed_tokens_meet():
    """Of all pairs of random sets that are similar, the two meet at a token that both list for each other's size."""
    rng, how, met = random.Random(1), Join(common=3), 0
    for _ in range(300):
        pool = sorted(rng.sample(range(1000), 60))
        held = {t: rng.randrange(1, 9) for t in range(1000)}
        a = sorted(rng.sample(pool, rng.randrange(3, 50)))
        b = sorted(set(a) - set(rng.sample(a, len(a) // 12)) | set(rng.sample(range(1000), rng.randrange(3))))
        if 100 * len({*a} & {*b}) < how.percent * len({*a} | {*b}):
            continue
        listed = []
        for s in (a, b):
            least = -(-how.percent * len(s) // 100)
            top = [(k, t) for k, t in enumerate(s) if t in a and t in b][: len(s)]  # open are at least those that both hold
            top = [(k, t) for i, (k, t) in enumerate(top) if k - i <= len(s) - least and k < len(s) - least + how.common]
            place, token = (np.array(x) for x in zip(*top, strict=True))
            listed.append(dict(ngram_join._listed(place, token, np.array([held[t] for t in token]), len(s), how)))
        assert any(listed[0][t] >= len(b) and listed[1].get(t, 0) >= len(a) for t in listed[0])
        met += 1
    assert met > 50
