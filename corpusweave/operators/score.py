"""Scores of candidate items for a free-text value, and what may be recommended by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusweave.functions.scalars import nonblank, strip
from corpusweave.functions.text import CODELIST_STOP_TOKENS, DETAIL_TOKENS, normalize_text, split_clues, text_norms, text_tokens, tokenize, without_details, words
from corpusweave.functions.uris import family_parent, family_tokens, normalize_uri, normalized_tail, uri_family

_CODELIST_FIELDS = ["codelist_name_sk", "codelist_name_en", "codelist_label_sk", "codelist_label_en"]


def profiles(items: DataFrame) -> DataFrame:
    """What scoring needs of each item, worked out once an item and not once a candidate pair. The family is that of its list's
    pattern, or else of its URI."""
    from corpusweave.operators.resolve import TEXT_FIELDS

    family = uri_family(F.coalesce(nonblank("codelist_uri_pattern"), F.col("item_uri")))
    return items.select(
        "id", F.array_compact(F.array(normalize_uri("item_uri"), normalize_uri("item_uri_raw"))).alias("uris"),
        F.array_distinct(F.array_compact(F.array(nonblank("item_code"), normalized_tail("item_uri"), normalized_tail("item_uri_raw")))).alias("codes"),
        text_norms(*TEXT_FIELDS).alias("norms"), text_tokens(*TEXT_FIELDS).alias("tokens"), text_tokens(*_CODELIST_FIELDS, stop=CODELIST_STOP_TOKENS).alias("list_tokens"),
        family.alias("family"), family_tokens(family).alias("family_tokens"), family_parent(family).alias("family_parent"),
    )


def _common(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(F.size(F.array_intersect(a, b)), F.lit(0))


def _least(most: float, each: float, n: Column) -> Column:
    return F.least(F.lit(most), F.lit(each) * n)


def score(raw: str = "raw_value", s: str = "s", c: str = "c") -> Column:
    """Points of candidate c for the value of source s (both structs as in profiles)."""
    f = lambda side, name: F.col(f"{side}.{name}")
    has = lambda array, x: F.coalesce(F.array_contains(array, x), F.lit(False))
    clues = split_clues(raw)
    tail = normalized_tail(raw)
    plain = lambda side: without_details(f(side, "list_tokens"))
    lists = _common(plain(s), plain(c))
    details = lambda side: F.arrays_overlap(f(side, "list_tokens"), words(DETAIL_TOKENS))
    families = _common(without_details(f(s, "family_tokens")), without_details(f(c, "family_tokens")))
    points = [
        F.when(has(f(c, "uris"), normalize_uri(raw)), 10.0),
        F.when(has(f(c, "codes"), nonblank(raw)), 6.0),
        F.when(has(f(c, "codes"), tail) & (tail != strip(raw)), 5.0),
        F.when(has(f(c, "norms"), normalize_text(raw)), 5.0),
        F.aggregate(clues, F.lit(0.0), lambda a, x: a + F.when(has(f(c, "norms"), normalize_text(x)), 3.0).otherwise(0.0)),
        F.aggregate(clues, F.lit(0.0), lambda a, x: a + _least(2, 0.75, _common(tokenize(x), f(c, "tokens")))),
        _least(8, 4.0, _common(f(s, "norms"), f(c, "norms"))),
        _least(5, 1.25, _common(f(s, "tokens"), f(c, "tokens"))),
        _least(4, 1.25, lists),
        F.when(details(s) & ~details(c) & (lists > 0), F.when(lists >= 2, 4.0).otherwise(2.5)),
        _least(3, 1.5, families),
        F.when(f(s, "family_parent") == f(c, "family"), 4.0),
    ]
    return sum((F.coalesce(p, F.lit(0.0)) for p in points), F.lit(0.0))


def signals(raw: str = "raw_value", s: str = "s", c: str = "c") -> Column:
    """What the points of score() are for, as labels with the words that count."""
    f = lambda side, name: F.col(f"{side}.{name}")
    has = lambda array, x: F.coalesce(F.array_contains(array, x), F.lit(False))
    some = lambda label, words_, most: F.when(F.size(words_) > 0, F.concat(F.lit(f"{label}:"), F.array_join(F.slice(F.array_sort(words_), 1, most), ",")))
    each = lambda *labels: F.array_compact(F.array(*labels))
    both = lambda a, b: F.coalesce(F.array_intersect(a, b), F.array().cast("array<string>"))
    tail = normalized_tail(raw)
    lists = both(without_details(f(s, "list_tokens")), without_details(f(c, "list_tokens")))
    details = lambda side: F.arrays_overlap(f(side, "list_tokens"), words(DETAIL_TOKENS))
    # The labels.
    whole = each(
        F.when(has(f(c, "uris"), normalize_uri(raw)), "uri_exact"), F.when(has(f(c, "codes"), nonblank(raw)), "code_exact"),
        F.when(has(f(c, "codes"), tail) & (tail != strip(raw)), "uri_tail_exact"), F.when(has(f(c, "norms"), normalize_text(raw)), "text_exact"),
    )
    clues = F.flatten(F.transform(split_clues(raw), lambda x: each(F.when(has(f(c, "norms"), normalize_text(x)), F.concat(F.lit("clue_text:"), x)), some("clue_tokens", both(tokenize(x), f(c, "tokens")), 4))))
    rest = each(
        some("source_text_exact", both(f(s, "norms"), f(c, "norms")), 2), some("source_token_overlap", both(f(s, "tokens"), f(c, "tokens")), 4), some("codelist_token_overlap", lists, 4),
        F.when(details(s) & ~details(c) & (F.size(lists) > 0), "codelist_parent_name_match"),
        some("family_token_overlap", both(without_details(f(s, "family_tokens")), without_details(f(c, "family_tokens"))), 4),
        F.when(f(s, "family_parent") == f(c, "family"), F.concat(F.lit("family_parent_match:"), f(s, "family"), F.lit("->"), f(c, "family"))),
    )
    return F.concat(whole, clues, rest)


def rank(df: DataFrame, keys: list[str], score_col: str = "score", id_col: str = "item_id") -> DataFrame:
    """rank, margin over the next, recommended and confidence. A lone candidate is always recommended; the first of several from 6
    points and a margin of 1.5 on."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), id_col)
    out = df.withColumn("score", F.round(score_col, 3)).withColumn("rank", F.row_number().over(w)).withColumn("margin", F.round(F.col("score") - F.lead("score").over(w), 3))
    out = out.withColumn("n_candidates", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    alone, s, m = F.col("n_candidates") == 1, F.col("score"), F.col("margin")
    sure = (F.col("rank") == 1) & (alone | ((s >= 6) & (m >= 1.5)))
    confidence = F.when(alone, F.least(F.lit(0.99), 0.55 + 0.04 * s)).when(sure, F.least(F.lit(0.99), 0.45 + 0.05 * s + 0.08 * m))
    return out.withColumn("recommended", F.coalesce(sure, F.lit(False))).withColumn("confidence", F.round(confidence, 3))


def rank_candidates(candidates: DataFrame, items: DataFrame, with_signals: bool = False) -> DataFrame:
    """candidates: source_id, relation, pos, raw_value, item_id. with_signals adds what the points are for."""
    p = profiles(items)
    as_struct = lambda name, key: p.select(F.col("id").alias(key), F.struct(*(x for x in p.columns if x != "id")).alias(name))
    scored = candidates.join(as_struct("s", "source_id"), "source_id").join(as_struct("c", "item_id"), "item_id").withColumn("score", score())
    if with_signals:
        scored = scored.withColumn("signals", signals())
    return rank(scored.drop("s", "c"), ["source_id", "relation", "pos"])
