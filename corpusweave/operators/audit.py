"""URI patterns of item lists, and the audit of item URIs against them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.scalars import let, nonblank
from corpusweave.functions.text import html_unescape, normalize_text
from corpusweave.functions.uris import classify_base, kind_rank, normalize_uri, uri_base, uri_tail
from corpusweave.operators.dedup import best_per_key

# Where the registry's pages have their title and labels.
TITLE = r"(?is)znalosti o:</b></font><br>\s*(?:<font[^>]*><b>(.*?)</b></font>)?"
_LABEL = r"(?is)skos:prefLabel.*?<div>&nbsp;.*?>\s*([^<]+)\s*</div>"


def base_counts(items: DataFrame, key: str, uri: str) -> DataFrame:
    return items.select(key, normalize_uri(uri).alias("_u")).where("_u IS NOT NULL").groupBy(key, uri_base("_u").alias("base")).agg(F.count(F.lit(1)).alias("n"))


def choose_best_base(items: DataFrame, key: str, uri: str) -> DataFrame:
    """Of each key's bases: the best kind, then the most frequent, shortest, first in order."""
    counted = base_counts(items, key, uri).withColumn("c", classify_base("base")).withColumn("kind", F.col("c.kind"))
    return best_per_key(counted, key, [kind_rank("kind"), F.desc("n"), F.length("base"), F.col("base")]).select(key, "base", "kind", F.col("c.label").alias("label"), "n")


def infer_pattern(items: DataFrame, key: str, code: str, uri: str) -> DataFrame:
    """Of each key: rows, rows without code or URI, with an invalid one, distinct bases, and the chosen base with its label.

    Without any valid URI the base is null, which fails the list; several bases are worth a warning.
    """
    counts = items.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(nonblank(code).isNull()).alias("missing_code"), F.count_if(nonblank(uri).isNull()).alias("missing_uri"),
        F.count_if(nonblank(uri).isNotNull() & normalize_uri(uri).isNull()).alias("invalid"), F.countDistinct(uri_base(normalize_uri(uri))).alias("bases"),
    )
    return counts.join(choose_best_base(items, key, uri).select(key, "base", "label"), key, "left")


def audit_category(pattern: Column | str, code: Column | str, uri: Column | str) -> Column:
    """skipped, invalid, ok, missing_tail, base_mismatch, tail_mismatch or mismatch."""
    p, k, raw = F.col(pattern) if isinstance(pattern, str) else pattern, nonblank(code), nonblank(uri)
    trim = lambda x: F.regexp_replace(x, "/+$", "")
    side = lambda x: F.struct(x.alias("uri"), uri_tail(x).alias("tail"), uri_base(x).alias("base"))

    def category(x: Column) -> Column:
        now, want = x["now"], x["want"]
        same_tail, same_base = now["tail"] == want["tail"], now["base"] == want["base"]
        return (
            F.when(x["k"].isNull() | x["raw"].isNull(), "skipped").when(now["uri"].isNull(), "invalid").when(now["uri"] == want["uri"], "ok")
            .when(trim(now["uri"]) == trim(x["p"]), "missing_tail").when(same_tail & ~same_base, "base_mismatch").when(~same_tail & same_base, "tail_mismatch").otherwise("mismatch")
        )

    return let(F.struct(k.alias("k"), raw.alias("raw"), p.alias("p"), let(normalize_uri(raw), side).alias("now"), let(F.concat(p, k), side).alias("want")), category)


def inspect_page(body: Column | str, status: Column | str, title_pattern: str = TITLE, unescape: Callable[[Column], Column] = html_unescape) -> Column:
    """Title, labels and flags of a dereferenced page; ok if it has a title, whatever else. unescape: how the title's entities are resolved."""
    b = F.col(body) if isinstance(body, str) else body
    title = F.nullif(unescape(F.regexp_extract(b, title_pattern, 1)), F.lit(""))
    labels = F.regexp_extract_all(b, F.lit(_LABEL), F.lit(1))
    return F.struct(
        title.alias("title"), labels.alias("pref_labels"), F.contains(b, F.lit("rdf:type")).alias("has_rdf_type"), F.contains(b, F.lit("skos:prefLabel")).alias("has_pref_label"),
        (title.isNotNull() & (F.coalesce(F.col(status) if isinstance(status, str) else status, F.lit(0)) < 400)).alias("ok"),
    )


def page_texts(page: Column) -> Column:
    """Folded title and labels."""
    return F.array_distinct(F.array_compact(F.transform(F.array_append(page["pref_labels"], page["title"]), normalize_text)))


def audit(items: DataFrame, patterns: DataFrame, pages: DataFrame | None = None, key: str = "codelist_code", code: str = "item_code", uri: str = "item_uri", label: str = "name", strict: bool = False) -> DataFrame:
    """A row for each item whose URI isn't as its list's pattern says: category, expected URI, level and message.

    pages (url, status, body): what dereferencing found, if it was done. A mismatch that the expected URI's page supports, having the
    item's label (of an array, any) where the present one's page hasn't, says so. strict makes errors of warnings and so blocks the list.
    """
    out = items.join(patterns.select(key, F.col("base").alias("pattern")), key).withColumn("category", audit_category("pattern", code, uri)).where("category NOT IN ('skipped', 'ok')")
    out = out.withColumn("expected_uri", F.concat("pattern", nonblank(code))).withColumn("normalized_uri", normalize_uri(uri))
    supported = F.lit(False)
    if pages is not None:
        seen = pages.select("url", inspect_page("body", "status").alias("p")).select("url", F.col("p.ok").alias("ok"), page_texts(F.col("p")).alias("texts"))
        side = lambda c, to: seen.select(F.col("url").alias(c), F.col("ok").alias(f"{to}_ok"), F.col("texts").alias(f"{to}_texts"))
        out = out.join(side("expected_uri", "want"), "expected_uri", "left").join(side("normalized_uri", "now"), "normalized_uri", "left")
        labels = F.col(label) if items.schema[label].dataType.typeName() == "array" else F.array(label)
        out = out.withColumn("labels", F.array_compact(F.transform(labels, lambda x: F.nullif(normalize_text(x), F.lit("")))))
        has = lambda to: F.coalesce(F.col(f"{to}_ok") & F.arrays_overlap(f"{to}_texts", "labels"), F.lit(False))
        supported = has("want") & ~has("now")
    message = F.concat_ws(" ", F.lit("Item"), code, F.lit("has URI"), uri, F.lit("where"), "expected_uri", F.lit("was expected:"), "category")
    return out.select(
        key, code, uri, "expected_uri", "category", supported.alias("supported_by_page"), F.lit("error" if strict else "warning").alias("level"),
        F.when(supported, F.concat(message, F.lit(" (the expected page has the item's label)"))).otherwise(message).alias("message"),
    )


def to_visit(audited: DataFrame, key: str = "codelist_code", uri: str = "item_uri") -> DataFrame:
    """code, stage and request: the present and the expected address of each item whose URI is well-formed but not the expected one."""
    off = audited.where("category IN ('base_mismatch', 'tail_mismatch', 'mismatch')")
    sides = F.array(*(F.struct(F.lit(stage).alias("stage"), c.alias("request")) for stage, c in (("deref_current", normalize_uri(uri)), ("deref_expected", F.col("expected_uri")))))
    return off.select(F.col(key).alias("code"), F.explode(sides).alias("x")).select("code", "x.stage", "x.request").where("request IS NOT NULL").distinct()


def blocked(audited: DataFrame, key: str = "codelist_code") -> DataFrame:
    """Lists that strict auditing keeps from publication."""
    return audited.groupBy(key).agg(F.bool_or(F.col("level") == "error").alias("validation_blocked"))
