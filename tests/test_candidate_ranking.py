"""candidate_ranking against plain Python over all pairs."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal

from conftest import SF

from corpusweave import catalogue
from corpusweave.functions.text import STOP_TOKENS
from corpusweave.operators import score

CLUED = [(20, "Alpha beta gamma delta, epsilon zeta"), (1, "gamma alpha; beta delta epsilon zeta"), (2, "zeta"), (3, "nothing here"), (4, "ZETA"), (5, None), (45, "")]


def norm(x):
    return " ".join((x or "").split()).lower()


def tokens(x):
    return {t for t in re.findall(r"[0-9A-Za-zÀ-ž.]+", norm(x)) if len(t) >= 2 and t not in STOP_TOKENS}


def rounded(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.001"), ROUND_HALF_UP))


def clues(x):
    return [c for c in (re.sub("^[ ,;:]+|[ ,;:]+$", "", " ".join(p.split())) for p in re.split(r"[,;\n\r\t]+", x)) if c]


def points(a, b):
    same = norm(a) == norm(b)
    out = 5.0 * same + 4.0 * same + min(5.0, 1.25 * len(tokens(a) & tokens(b)))
    for c in clues(a):
        out += 3.0 * (norm(c) == norm(b)) + min(2.0, 0.75 * len(tokens(c) & tokens(b)))
    return out


def brute(rows):
    out = []
    for i, a in rows:
        found = sorted((-points(a, b), j) for j, b in rows if i != j and tokens(a) & tokens(b))
        for k, (s, j) in enumerate(found):
            s = -s
            margin = s + found[k + 1][0] if k + 1 < len(found) else None
            alone = len(found) == 1
            sure = k == 0 and (alone or (s >= 6 and margin >= 1.5))
            confidence = min(0.99, 0.55 + 0.04 * s) if alone else min(0.99, 0.45 + 0.05 * s + 0.08 * margin) if sure else None
            out.append((i, j, s, k + 1, margin, sure, confidence and rounded(confidence)))
    return sorted(out)


COLUMNS = ["item_id", "other", "score", "rank", "margin", "recommended", "confidence"]


def test_clues_and_tokens_of_all_items(spark):
    ranked = score.rank_candidates(*catalogue.text_candidates(spark.createDataFrame(CLUED, "id long, text string")))
    got = sorted((r.source_id, r.item_id, r.score, r["rank"], r.margin, r.recommended, r.confidence) for r in ranked.collect())
    want = brute(CLUED)
    assert got == want
    assert any(r[5] and r[4] is not None for r in want)  # a first of several that is recommended
    assert {(20, 1), (1, 20)} <= {r[:2] for r in want}  # items of different buckets of 20


def test_query(spark):
    import duckdb

    import __spark_entry__

    rows = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = sorted(tuple(r[c] for c in COLUMNS) for r in __spark_entry__.queries()["candidate_ranking"](spark, SF).collect())
    assert got == brute(rows)
    assert any(a % 20 != b % 20 for a, b, *_ in got) and max(r[2] for r in got) > 4
