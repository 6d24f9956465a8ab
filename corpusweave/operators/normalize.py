"""Raw headers and items to the normalised tables codelists, items and relations_raw."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.scalars import iso_date, nonblank, owner_uuid, sanitize_ico, unique_nonempty
from corpusweave.functions.temporal import effective_bounds, flag_in_force, language_columns, whole_number_in_force
from corpusweave.functions.uris import identity, normalize_uri
from corpusweave.operators.dedup import last_wins

# Where code lists without a URI of their own are.
CODELIST_ROOT = "https://data.gov.sk/set/codelist/"
# Relations between items and the raw fields that hold them.
RELATIONS = {"includes": "codelistItemIncludes", "includesAlso": "codelistItemIncludesAlso", "excludes": "codelistItemExcludes"}
_TEXTS = {"name": "Names", "label": "Labels", "note": "Notes"}
_ITEM_TEXTS = _TEXTS | {"abbreviated_name": "AbbreviatedNames", "additional_content": "AdditionalContents"}


def repair_identity(items: DataFrame, code: str = "itemCode", uri: str = "itemUri") -> DataFrame:
    """Items with a URI in place of their code get both; originals and a flag stay beside."""
    return (
        items.withColumn("_id", identity(code, uri))
        .withColumn("originalItemCode", F.when(F.col("_id.recovered"), F.col(code)))
        .withColumn("itemUriRecoveredFromItemCode", F.col("_id.recovered"))
        .withColumn(code, F.when(F.col("_id.recovered"), F.col("_id.code")).otherwise(F.col(code)))
        .withColumn(uri, F.when(F.col("_id.recovered"), F.col("_id.uri")).otherwise(F.col(uri)))
        .drop("_id")
    )


def normalize_codelists(headers: DataFrame, patterns: DataFrame, publishers: DataFrame, last_item: DataFrame, ontology: DataFrame) -> DataFrame:
    """headers: one detail row for each code. patterns: code, base, label. publishers: code, ico. last_item: code, last_valid_from.
    ontology: code and its class arrays. Rows without a start date can't be published and are left to `undated`."""
    start, end = nonblank("effectiveFrom"), nonblank("effectiveTo")
    out = (
        headers.join(patterns.select("code", F.col("base").alias("uri_pattern"), F.col("label").alias("item_prefix")), "code", "left")
        .join(publishers, "code", "left").join(last_item, "code", "left").join(ontology, "code", "left")
    )
    return out.where(iso_date("validFrom").isNotNull()).select(
        "code", F.coalesce(nonblank("uri"), F.concat(F.lit(CODELIST_ROOT), "code")).alias("uri"),
        iso_date("validFrom").alias("valid_from"), iso_date(F.coalesce(start, nonblank("validFrom"))).alias("effective_from"), iso_date(end).alias("effective_to"),
        F.coalesce("last_valid_from", iso_date("validFrom")).alias("last_modified"), F.col("ico").alias("publisher_ico"), "uri_pattern", "item_prefix",
        *(F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("item_type_uris", "item_type_qnames")),
        unique_nonempty("codelistSource").alias("source_values"),
        *(c for name, field in _TEXTS.items() for c in language_columns(name, f"codelist{field}")),
    )


def undated(headers: DataFrame) -> DataFrame:
    return headers.where(iso_date("validFrom").isNull()).select("code", F.lit("error").alias("level"), F.lit("Missing or invalid date for validFrom").alias("message"))


def last_modified(items: DataFrame) -> DataFrame:
    """The latest start of each list's items."""
    return items.groupBy("code").agg(F.max(iso_date("validFrom")).alias("last_valid_from"))


def normalize_items(items: DataFrame, codelists: DataFrame) -> DataFrame:
    """One row for each item id: where lists share an id, the one processed last (by code, then input place) holds it.

    Rows without a whole-number id or a code are left out.
    """
    lists = codelists.select(
        F.col("code"), F.col("uri").alias("codelist_uri"), F.col("uri_pattern").alias("codelist_uri_pattern"), "item_type_uris", "item_type_qnames",
        *(F.col(f"{n}_{t}").alias(f"codelist_{n}_{t}") for n in ("name", "label") for t in ("sk", "en")),
    )
    start, end = effective_bounds("codelistItemValidities", "validFrom")
    out = items.where(F.col("id").isNotNull() & nonblank("itemCode").isNotNull()).join(lists, "code").select(
        "id", "pos", F.col("code").alias("codelist_code"), "codelist_uri", "codelist_uri_pattern", *(f"codelist_{n}_{t}" for n in ("name", "label") for t in ("sk", "en")),
        nonblank("itemCode").alias("item_code"), F.concat("codelist_uri_pattern", nonblank("itemCode")).alias("item_uri"),
        F.col("itemUri").alias("item_uri_raw"), normalize_uri("itemUri").alias("item_uri_raw_normalized"), iso_date("validFrom").alias("valid_from"),
        iso_date(start).alias("effective_from"), iso_date(end).alias("effective_to"),
        whole_number_in_force("codelistItemLogicalOrders").alias("logical_order"), flag_in_force("codelistItemLegislativeValidities").alias("legislative_validity"),
        "item_type_uris", "item_type_qnames", *(c for name, field in _ITEM_TEXTS.items() for c in language_columns(name, f"codelistItem{field}")),
    )
    return last_wins(out, "id", F.col("codelist_code"), F.col("pos")).drop("pos")


def relations_raw(items: DataFrame) -> DataFrame:
    """source_id, relation, pos, raw_value: the distinct non-blank values of each relation, in order."""
    stacked = items.select(F.col("id").alias("source_id"), F.explode(F.array(*(F.struct(F.lit(r).alias("relation"), unique_nonempty(F.transform(f, lambda x: x["value"])).alias("v")) for r, f in RELATIONS.items()))).alias("x"))
    return stacked.select("source_id", "x.relation", F.posexplode("x.v").alias("pos", "raw_value"))


def owners(headers: DataFrame) -> DataFrame:
    """code and uuid: the last UUID of the manager in force, if there is one."""
    from corpusweave.functions.temporal import current_or_latest

    value = lambda c: current_or_latest(F.transform(c, lambda x: F.struct(F.lit(None).cast("string").alias("language"), x["value"].alias("value"), x["effectiveFrom"].alias("effectiveFrom"), x["effectiveTo"].alias("effectiveTo"))))["value"]
    return headers.select("code", owner_uuid(F.coalesce(value("mainCodelistManagers"), value("codelistManagers"))).alias("uuid"))


def publisher_icos(headers: DataFrame, ci: DataFrame) -> DataFrame:
    """code, ico and what failed: the manager in force's last UUID, looked up among the configuration items."""
    from corpusweave.functions.scalars import ci_attribute

    found = ci.select("uuid", F.lit(True).alias("known"), sanitize_ico(ci_attribute("attributes", "EA_Profil_PO_ico")).alias("ico"))
    return owners(headers).join(found, "uuid", "left").select(
        "code", "ico", F.when(F.col("uuid").isNull(), "no owner").when(F.col("known").isNull(), "owner not found").when(F.col("ico").isNull(), "owner without a number").alias("failure")
    )
