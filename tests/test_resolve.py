"""Resolution of values against plain Python over all items."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusweave.operators import resolve


def brute(value, keys):
    """Targets of a value with plain words, among keys {(kind, key): items}."""
    meant = lambda x: keys.get(("code", x), set()) | keys.get(("text", x.lower()), set())
    for kind, key in (("code", value), ("text", value.lower())):
        if len(keys.get((kind, key), ())) == 1:
            return set(keys[kind, key])
    sets = [m for c in (p.strip() for p in value.split(",")) if c and (m := meant(c))]
    if value.count(",") and len(sets) >= 2:
        both = set.intersection(*sets)
        if len(both) == 1:
            return both
        alone = [next(iter(s)) for s in sets if len(s) == 1]
        if len(alone) >= 2 and len(set(alone)) == 1:
            return set(alone)
    return set()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clues_same_as_brute_force(spark, seed):
    rng = random.Random(seed)
    names, kinds = [f"n{chr(97 + k)}x" for k in range(9)], [f"k{chr(97 + k)}y" for k in range(4)]
    items = [(i, rng.choice(names), rng.choice(kinds), f"c{chr(97 + i % 26)}{chr(97 + i // 26)}z" if rng.random() < 0.3 else rng.choice(kinds)) for i in range(60)]
    keys = {}
    for i, a, b, code in items:
        for k in (("text", a), ("text", b), ("code", code), ("text", code)):
            keys.setdefault(k, set()).add(i)
    pool = [*names, *kinds, *(c for *_, c in items), "nothing"]
    asked = [(i, "includes", 0, "*", ", ".join(rng.choice(pool).upper() if rng.random() < 0.2 else rng.choice(pool) for _ in range(rng.choice([1, 2, 2, 3, 4])))) for i in range(300)]
    asked += [(1000 + i, *rest) for i, *rest in asked[:50]] + [(2000, "includes", 0, "*", None), (2001, "includes", 0, "*", "")]
    found = spark.createDataFrame([("*", kind, key, i) for (kind, key), members in keys.items() for i in members], "scope string, kind string, key string, item_id long")
    out = resolve.resolve_values(spark.createDataFrame(asked, "source_id long, relation string, pos int, scope string, raw_value string"), found)
    got = {}
    for r in out.collect():
        got.setdefault(r.source_id, set()).add(r.target_id)
    assert got == {i: t for i, _, _, _, v in asked if v and (t := brute(v, keys))}
    assert len(got) > 20


def test_no_more_rows_than_the_rarest_clue_has(spark):
    """A key that all items share is never opened if a clue beside it is rare."""
    items = spark.range(2000).select(F.col("id"), F.lit("everyone").alias("name_sk"), F.concat(F.lit("c"), "id").alias("name_en"), *(F.lit(None).cast("string").alias(c) for c in ("item_code", "item_uri", "item_uri_raw")))
    keys = resolve.item_keys(items, ["name_sk", "name_en"])
    raw = items.select(F.col("id").alias("source_id"), F.lit("includes").alias("relation"), F.lit(0).alias("pos"), F.lit("*").alias("scope"), F.concat(F.lit("everyone; "), "name_en").alias("raw_value"))
    out = resolve.resolve_values(raw, keys)
    assert out.where("source_id = target_id").count() == 2000 == out.count()
