from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF

from corpusweave.llm import decontamination, pii, quality_rules, sharding

from .conftest import WORDS


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# Quality rules


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines, dup = [], 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.append(line)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def test_quality_counts(spark, frame, odd_texts):
    rng = random.Random(5)
    texts = [(k, "\n".join(" ".join(rng.choice(WORDS[:4] + ["#", "|"]) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(8)))) for k in range(150)]
    for rows in (documents(spark), odd_texts, texts):
        out = quality_rules.clean_lines(frame(rows)).collect()
        have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
        assert have == Counter((i, *brute_quality(t)) for i, t in rows)
        assert not any(r.kept and r.base_failed for r in out)


def test_quality_verdict():
    prose = "The reader sees a line of plain words that ends as lines should."
    good = "\n".join(" ".join(random.Random(k).sample(WORDS, 12)).capitalize() + "." for k in range(10))
    assert quality_rules.assess(good)["kept"]
    bad = {
        "navigation": "Home | News | About | Contact | Help", "symbols": "buy $$$ now %%% best *** price", "punctuation": "WIN!! BIG!! PRIZES!! TODAY!! FREE!!",
        "furniture": "Click here to subscribe",
    }
    for fault, line in bad.items():
        assert quality_rules.line_fault(line, set()) == fault
        mixed = quality_rules.assess(good + "\n" + line)
        assert mixed["kept"] and mixed["cleaned"] == good
        assert not quality_rules.assess("\n".join(f"{line} {WORDS[k]}" for k in range(10)) + "\n" + prose)["kept"]
    assert quality_rules.line_fault(prose, {prose}) == "repeat"


def test_quality_empty(frame):
    assert quality_rules.clean_lines(frame([(1, "x")]).limit(0)).collect() == []


def test_quality_labels(spark):
    sf = SF.replace("0.001", "0.01")
    out = quality_rules.op2_line_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in out}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n.get((0, True), 0) <= 0.05 * n[0, False]


# Benchmark decontamination


def brute_hits(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, found = words(text), set(), set()
    for name, t in items:
        x = words(t)
        m = min(10, len(x))
        for i in range(len(x) - m + 1 if m else 0):
            for k in range(len(w) - m + 1):
                if w[k : k + m] == x[i : i + m]:
                    hit.update(range(k, k + m))
                    found.add(name)
    return len(w), len(hit), sorted(str(n) for n in found if n is not None)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_hits(spark, frame, odd_texts, block_bytes):
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice(WORDS[:8]) for _ in range(n))
    items = [(k, say(rng.choice([1, 2, 5, 9, 10, 11, 25]))) for k in range(12)] + [(None, say(10)), (99, None), (98, ""), (3, say(12)), (97, "été 漢字 ÉTÉ")]
    rows = [(k, "; ".join([say(rng.randrange(40)), rng.choice(items)[1] or "", say(5)]).title()) for k in range(60)] + odd_texts
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.matchers(bench, block_bytes=block_bytes)
    assert isinstance(found, decontamination.Patterns) == (block_bytes == 300)
    out = decontamination.scan(frame(rows), found).collect()
    hits = {t: brute_hits(t, items) for t in {t for _, t in rows}}
    want = Counter((i, n, h, tuple(x)) for i, t in rows for n, h, x in [hits[t]])
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in out) == want
    kept = decontamination.drop_contaminated(frame(rows), found)
    assert kept.columns == frame(rows).columns
    assert Counter(r.text for r in kept.collect()) == Counter(t for _, t in rows if not hits[t][1])


def test_large_benchmark(spark, frame):
    """Beyond block_bytes a benchmark is met in a join, with the same result; what is broadcast doesn't grow with it."""
    rng = random.Random(7)
    say = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))
    items = [(f"i{k}", say(rng.choice([4, 10, 60, 400]))) for k in range(1500)]
    held = [t for _, t in items]
    rows = [(k, f"{say(30)} {held[k % 40] if k % 3 else ''} {say(20)}") for k in range(300)] + [(k, rows_text) for k, rows_text in enumerate([held[0]] * 200)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    small, large = decontamination.matchers(bench), decontamination.matchers(bench, block_bytes=1000)
    assert not isinstance(small, decontamination.Patterns) and isinstance(large, decontamination.Patterns)
    got = [Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontamination.scan(frame(rows), m).collect()) for m in (small, large)]
    assert got[0] == got[1] and sum(n for (_, _, hit, _), n in got[0].items() if hit) >= 400
    shifts, sieve = large.tables.value
    assert set(shifts) == {4, 10} and all(t.nbytes == decontamination.SHIFTS for t in shifts.values()) and sieve.nbytes * 8 == decontamination.FILTER_BITS


def test_hits_of_nothing(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in decontamination.scan(frame([(1, "a b")]), decontamination.matchers(none)).collect()] == [(2, 0)]
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontamination.scan(frame([(1, "a")]).limit(0), decontamination.matchers(bench)).collect() == []


# Personal data

BASE = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def brute_pii(text):
    out = []
    for kind, p in BASE:
        for m in p.finditer(text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.fixture(scope="module")
def pii_model(spark):
    return pii.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_base_spans(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("0123 45.-+()@ab.@1٣é") for _ in range(rng.randrange(50))) for _ in range(4000)]
    for t in [*texts, *(t for _, t in documents(spark)), "001.002.3.4", "a@b.c@d.e", "x@y", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8"]:
        assert pii.base_spans(t) == brute_pii(t), t


def test_pii_rows(frame, odd_texts, pii_model):
    rows = [*odd_texts, (20, "Mail a.b@c.org or ring +1 (359) 555-5478; 10.0.0.1, 4111111111111111."), (21, "😀 x@y.zz")]
    out = pii.find(frame(rows), pii_model).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[20].redacted == "Mail [EMAIL] or ring [PHONE]; [IP], [CARD]."
    assert [(s.kind, s.start, s.end) for s in by[21].spans] == [("email", 2, 8)]
    assert by[3].redacted is None and by[4].redacted == "" and by[1].spans == []
    again = pii.redact_rows(frame(rows), pii_model)
    assert again.schema == frame(rows).schema and Counter(r.text for r in again.collect()) == Counter(r.redacted for r in out)
    assert pii.find(frame(rows).limit(0), pii_model).collect() == []


def test_added_spans(pii_model):
    for t, kind in [
        ("write to john.doe (at) mail (dot) com please", "email"), ("call (359) 555-5478 now", "phone"), ("tel 359-555-5478", "phone"), ("server 10 . 2 . 33 . 4 here", "ip"), ("card 4041.8949.7460.8795 x", "card"),
    ]:
        assert [s[0] for s in pii_model.spans([t])[0]] == [kind], t
    for t in ["on 2024-05-01 at noon", "version 2.0 and 3.1.4", "at the end. The dot", "ISBN 978-3-1234-5678-9", "no 1234567", "from 1990-2010"]:
        assert pii_model.spans([t]) == [[]], t


def test_pii_query(spark):
    out = {r.doc_id: r for r in pii.op9_pii(spark, SF).collect()}
    for i, t in documents(spark):
        want = brute_pii(t)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert out[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and set(filter(None, listed.split(","))) <= set(out[i].spans.split(","))
        assert [out[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]


# Sharding


@pytest.mark.parametrize("shards", [1, 4, 16])
def test_shards(spark, frame, odd_texts, shards):
    for rows in (documents(spark), odd_texts, [(1, "same")] * 200, [(1, None)]):
        out = sharding.shard_by_bytes(frame(rows), shards).collect()
        sized = lambda t: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((i, *sized(t)) for i, t in rows)
        total, by = sum(r["size"] for r in out), {}
        for r in out:
            by.setdefault(r.shard, []).append(r)
        key = lambda r: -1 if r.doc_id is None else r.doc_id
        last = -2
        for s in sorted(by):
            own = sorted(by[s], key=lambda r: r.slot)
            assert [r.slot for r in own] == list(range(len(own)))
            assert key(own[0]) >= last and [key(r) for r in own] == sorted(map(key, own))
            last = key(own[-1])
        most = max(r["size"] for r in out)
        for s in range(shards):
            assert abs(sum(r["size"] for r in by.get(s, [])) - total / shards) <= most + 1
    assert sharding.shard_by_bytes(frame([(1, "x")]).limit(0)).collect() == []
