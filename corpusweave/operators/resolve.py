"""Resolution of free-text relation values to items, by equi-joins against an inverted table of item keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.scalars import nonblank, normalize_ico, strip
from corpusweave.functions.text import explicit_refs, normalize_text, split_clues
from corpusweave.functions.uris import external_identifier, external_kind, normalize_uri, normalized_tail, slashed, uri_tail

# The item fields that free text may name an item by.
TEXT_FIELDS = ["item_code", *(f"{n}_{t}" for n in ("name", "label", "note", "abbreviated_name", "additional_content") for t in ("sk", "en"))]
EVERYWHERE = "*"
_KEY = ["source_id", "relation", "pos"]
#: A cascade's probes in order of preference.
_URI, _CODE, _TAIL, _TEXT = 1, 2, 3, 4


def item_keys(items: DataFrame, texts: list[str] | None = None, scope: Column | None = None) -> DataFrame:
    """scope, kind, key, item_id: every key by which an item may be named, each once."""
    keys = [(F.lit("uri"), normalize_uri("item_uri")), (F.lit("uri"), normalize_uri("item_uri_raw")), (F.lit("code"), nonblank("item_code"))]
    keys += [(F.lit("code"), normalized_tail(c)) for c in ("item_uri", "item_uri_raw")] + [(F.lit("text"), normalize_text(c)) for c in texts or TEXT_FIELDS]
    all_keys = F.array(*(F.struct(kind.alias("kind"), key.alias("key")) for kind, key in keys))
    return (
        items.select((scope if scope is not None else F.lit(EVERYWHERE)).alias("scope"), F.col("id").alias("item_id"), F.explode(all_keys).alias("k"))
        .select("scope", "k.kind", "k.key", "item_id").where("key IS NOT NULL").distinct()
    )


def key_sizes(keys: DataFrame) -> DataFrame:
    """scope, kind, key, n (items that have it) and alone (one of them). A key that very many share, such as '01', shrinks to one row
    before any join."""
    return keys.groupBy("scope", "kind", "key").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("alone"))


def _probes(value: str) -> Column:
    p = lambda prio, kind, key: F.struct(F.lit(prio).alias("prio"), F.lit(kind).alias("kind"), key.alias("key"))
    return F.array(p(_URI, "uri", normalize_uri(value)), p(_CODE, "code", nonblank(value)), p(_TAIL, "code", normalized_tail(value)), p(_TEXT, "text", normalize_text(value)))


def resolve_values(raw: DataFrame, keys: DataFrame) -> DataFrame:
    """source_id, relation, pos, target_id, ord of what each value (source_id, relation, pos, scope, raw_value) names.

    First the whole value: as URI, code, URI tail, text; the first that one item alone has. Else, of two clues or more between commas
    and the like, the one item that all can mean, or that each of two or more means alone. Else every URI or code inside
    the text that one item alone has. Equal values of a scope are worked out once.
    """
    value, key = ["scope", "raw_value"], ["scope", "kind", "key"]
    values = raw.select(*value).where("raw_value IS NOT NULL").distinct()
    sized = key_sizes(keys)
    one = sized.where("n = 1").select(*key, F.col("alone").alias("item_id"))
    probe = values.select(*value, F.explode(_probes("raw_value")).alias("p")).select(*value, "p.prio", "p.kind", "p.key").where("key IS NOT NULL")
    whole = probe.join(one, key).groupBy(*value).agg(F.min_by("item_id", "prio").alias("target_id"))
    refs = values.select(*value, F.posexplode(explicit_refs("raw_value")).alias("rpos", "ref"))
    probe = refs.select(*value, "rpos", F.explode(F.array(F.struct(F.lit(1).alias("prio"), F.lit("uri").alias("kind"), normalize_uri("ref").alias("key")), F.struct(F.lit(2).alias("prio"), F.lit("code").alias("kind"), F.coalesce(normalized_tail("ref"), "ref").alias("key")))).alias("p"))
    refs = (
        probe.select(*value, "rpos", "p.*").where("key IS NOT NULL").join(one, key)
        .groupBy(*value, "rpos").agg(F.min_by("item_id", "prio").alias("target_id")).groupBy(*value, "target_id").agg(F.min("rpos").alias("ord"))
    )
    stage = lambda k, df: df.select(*value, F.struct(F.lit(k).alias("stage"), "target_id", (F.col("ord") if k == 2 else F.lit(0)).alias("ord")).alias("t"))
    found = stage(0, whole).unionByName(stage(1, _by_clues(values, keys, sized))).unionByName(stage(2, refs)).groupBy(*value).agg(F.min("t.stage").alias("first"), F.collect_list("t").alias("t"))
    found = found.select(*value, F.explode(F.filter("t", lambda x: x["stage"] == F.col("first"))).alias("t")).select(*value, "t.target_id", "t.ord")
    return raw.select(*_KEY, *value).join(found, value).select(*_KEY, "target_id", "ord")


def _by_clues(values: DataFrame, keys: DataFrame, sized: DataFrame) -> DataFrame:
    """scope, raw_value and target_id of the values whose clues together mean one item.

    A clue means every item that has one of its keys; clues that mean none don't count. Only the items of a value's rarest clue are looked
    at, and those with the same asked keys as one: where two share all of them, neither is the one item.
    """
    value, key = ["scope", "raw_value"], ["scope", "kind", "key"]
    clues = values.select(*value, split_clues("raw_value").alias("c")).where(F.size("c") >= 2).select(*value, F.posexplode("c").alias("cpos", "clue"))
    found = clues.select(*value, "cpos", F.explode(_probes("clue")).alias("p")).select(*value, "cpos", "p.kind", "p.key").where("key IS NOT NULL").distinct().join(sized, key)
    per_clue = found.groupBy(*value, "cpos").agg(
        F.sum("n").alias("most"), F.collect_list(F.struct("kind", "key")).alias("keys"), F.when((F.max("n") == 1) & (F.min("alone") == F.max("alone")), F.min("alone")).alias("alone")
    )
    evidence = per_clue.groupBy(*value).agg(
        F.count(F.lit(1)).alias("clues"), F.count("alone").alias("single"), F.min("alone").alias("least"), F.max("alone").alias("most_alone"),
        F.collect_list("keys").alias("all"), F.min_by("keys", F.struct("most", "cpos")).alias("rarest"),
    ).where("clues >= 2")
    same = (
        keys.join(found.select(*key).distinct(), key, "left_semi").groupBy("scope", "item_id").agg(F.sort_array(F.collect_list(F.struct("kind", "key"))).alias("has"))
        .groupBy("scope", "has").agg(F.count(F.lit(1)).alias("items"), F.min("item_id").alias("item_id"))
    )
    holders = same.select("*", F.explode("has").alias("k")).select("scope", "k.kind", "k.key", "has", "items", "item_id")
    common = (
        evidence.select(*value, "all", F.explode("rarest").alias("k")).select(*value, "all", "k.kind", "k.key").join(holders, key)
        .where(F.forall("all", lambda c: F.arrays_overlap(c, "has"))).select(*value, "item_id", "items").distinct()
        .groupBy(*value).agg(F.sum("items").alias("items"), F.min("item_id").alias("common")).where("items = 1")
    )
    agreed = F.when((F.col("least") == F.col("most_alone")) & (F.col("single") >= 2), F.col("least"))
    return evidence.join(common, value, "left").select(*value, F.coalesce("common", agreed).alias("target_id")).where("target_id IS NOT NULL")


def resolve_configured(raw: DataFrame, items: DataFrame, hierarchy: dict[str, str], predicates: dict | None = None) -> dict[str, DataFrame]:
    """edges, external_edges and no_match (with reason) of relations whose source list has a configured parent.

    raw: source_id, relation, pos, raw_value. Every value lands in exactly one of the three.
    """
    spark = raw.sparkSession
    config = F.broadcast(spark.createDataFrame([*hierarchy.items()] or [(None, None)], "codelist_code string, parent string"))  # one row a configured list
    named = raw.join(items.select(F.col("id").alias("source_id"), "codelist_code"), "source_id").join(config, "codelist_code", "left")
    external = F.col("parent").rlike("(?i)^https?://")
    out = named.where(external).withColumn("identifier", external_identifier("raw_value", "parent"))
    edges_out = out.where("identifier IS NOT NULL").select(
        *_KEY, external_kind("parent").alias("kind"), "identifier", F.concat(slashed("parent"), "identifier").alias("uri"), slashed("parent").alias("uri_base"), "raw_value", F.lit("configured_parent").alias("matched_via")
    )
    edges_out = edges_out.groupBy("source_id", "relation", "uri").agg(*(F.min_by(c, "pos").alias(c) for c in ("kind", "identifier", "uri_base", "raw_value", "matched_via")), F.min("pos").alias("ord"))
    if predicates is not None:
        edges_out = with_external_predicate(edges_out, predicates)
    inner = named.where(~external).withColumn("scope", F.col("parent"))
    keys = item_keys(items.join(config.select(F.col("parent").alias("codelist_code")).distinct(), "codelist_code", "left_semi"), scope=F.col("codelist_code"))
    found = resolve_values(inner.select(*_KEY, "scope", "raw_value"), keys)
    count = found.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("ord", "target_id"))).alias("t"))
    one = count.where("n = 1").select(*_KEY, F.col("t")[0]["target_id"].alias("target_id"))
    edges = one.groupBy("source_id", "relation", "target_id").agg(F.min("pos").alias("ord"))
    no_ids = F.array().cast("array<bigint>")
    failed = inner.join(count, _KEY, "left").where("n IS NULL OR n > 1").select(
        *_KEY, "raw_value", "parent", F.when(F.col("n") > 1, "multiple_matches_in_configured_parent").otherwise("no_match_in_configured_parent").alias("reason"),
        F.coalesce(F.transform("t", lambda x: x["target_id"]), no_ids).alias("candidates"),
    )
    other = lambda df, reason: df.select(*_KEY, "raw_value", "parent", F.lit(reason).alias("reason"), no_ids.alias("candidates"))
    failed = failed.unionByName(other(out.where("identifier IS NULL"), "external_identifier_not_found")).unionByName(other(named.where("parent IS NULL"), "no_parent_config"))
    return {"edges": edges, "external_edges": edges_out, "no_match": failed}


def with_external_predicate(edges: DataFrame, predicates: dict[str, str | dict[str, str]]) -> DataFrame:
    """The predicate of the longest configured base that begins each edge's URI: the relation's own, else the base's default, else null.

    A URI meets bases by its beginnings of the lengths that bases have, in an equi-join: each URI becomes as many rows as there are such lengths that it
    reaches, however many bases there are.
    """
    spark = edges.sparkSession
    own = lambda v: {"default": v} if isinstance(v, str) else v
    known = spark.createDataFrame([(b, [*own(v).items()]) for b, v in predicates.items()] or [(None, None)], "base string, by array<struct<rel:string,predicate:string>>")
    by = F.map_from_entries("by")
    known = F.broadcast(known.where("base IS NOT NULL").select("base", by.alias("by")))  # one row a configured base
    lengths = sorted({len(b) for b in predicates})
    beginnings = F.transform(F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("uri")), lambda n: F.substring("uri", F.lit(1), n))
    key = ["source_id", "relation", "uri"]
    met = edges.select(*key, F.explode(beginnings).alias("base")).join(known, "base")
    best = met.groupBy(*key).agg(F.max_by("by", F.length("base")).alias("by"))
    predicate = F.coalesce(F.try_element_at("by", F.col("relation")), F.try_element_at("by", F.lit("default")))
    return edges.join(best.select(*key, predicate.alias("predicate")), key, "left")


def organisations(ci: DataFrame, number: Column) -> DataFrame:
    """Numbers that exactly one organisation (PO) has, if that has an ICO. ci: uuid, type, attributes."""
    from corpusweave.functions.scalars import ci_attribute

    # The attributes of an organisation.
    hits = ci.select("uuid", F.coalesce(nonblank("type"), F.lit("PO")).alias("citype"), number.alias("number"), ci_attribute("attributes", "Gen_Profil_nazov", "Gen_Profil_anglicky_nazov").alias("name"), ci_attribute("attributes", "EA_Profil_PO_ico").alias("ico"))
    return hits.where("number IS NOT NULL AND citype = 'PO'").groupBy("number").agg(F.count(F.lit(1)).alias("n"), *(F.min(c).alias(c) for c in ("uuid", "citype", "name", "ico"))).where("n = 1 AND ico IS NOT NULL")


def lookup_organisations(raw: DataFrame, ci: DataFrame | Callable[[DataFrame], DataFrame], attribute: str) -> DataFrame:
    """Values of up to eight digits that exactly one organisation's attribute has, as external targets; without a URI none. Of the
    configuration items only organisations (PO) take part. Instead of a table, ci may be a search: given the distinct numbers, it returns its hits
    (number, uuid, type, attributes), and a number with one hit counts."""
    from corpusweave.functions.scalars import ci_attribute, looks_like_ico

    wanted = raw.where(looks_like_ico("raw_value")).select(*_KEY, "raw_value", normalize_ico("raw_value").alias("number"))
    if callable(ci):
        one = organisations(ci(wanted.select("number").where("number IS NOT NULL").distinct()), F.col("number"))
    else:
        one = organisations(ci, normalize_ico(ci_attribute("attributes", attribute)))
    return wanted.join(one, "number").select(*_KEY, "raw_value", F.lit("legal_subject").alias("kind"), F.col("ico").alias("identifier"), "name", "citype", "uuid", F.lit("ico_lookup").alias("matched_via"), F.lit(attribute).alias("matched_attribute"))


def resolve_globally(raw: DataFrame, items: DataFrame, ci: DataFrame | Callable[[DataFrame], DataFrame] | None = None, attribute: str = "Gen_Profil_kod_metais", pick_top: bool = False) -> dict[str, DataFrame]:
    """edges, external_edges, no_match and ambiguous over all items: all targets of a value count; values without any are looked up
    as organisations, and then scored against what their text may mean. pick_top also accepts recommended candidates."""
    from corpusweave.operators.score import rank_candidates

    spark = raw.sparkSession
    keys = item_keys(items)
    scoped = raw.withColumn("scope", F.lit(EVERYWHERE))
    found = resolve_values(scoped.select(*_KEY, "scope", "raw_value"), keys)
    left = scoped.join(found.select(*_KEY).distinct(), _KEY, "left_anti")
    external = spark.createDataFrame([], "source_id long, relation string, pos int, raw_value string, kind string, identifier string, name string, citype string, uuid string, matched_via string, matched_attribute string")
    if ci is not None:
        external = lookup_organisations(left, ci, attribute)
        left = left.join(external, _KEY, "left_anti")
    possible = (
        left.select(*_KEY, "raw_value", "scope", F.explode(F.array_union(F.array(strip("raw_value")), split_clues("raw_value"))).alias("clue"))
        .select(*_KEY, "raw_value", "scope", F.explode(_probes("clue")).alias("p")).select(*_KEY, "raw_value", "scope", "p.kind", "p.key").where("key IS NOT NULL")
        .join(keys, ["scope", "kind", "key"])
    )
    ranked = rank_candidates(possible.select(*_KEY, "raw_value", "item_id").distinct(), items, with_signals=True)
    kinds = possible.groupBy(*_KEY).agg(*(F.countDistinct(F.when(F.col("kind") == k, F.col("item_id"))).alias(k) for k in ("code", "uri", "text")))
    top = ranked.where("rank = 1").join(kinds, _KEY)
    reason = F.when(F.col("code") > 1, "ambiguous_code").when(F.col("uri") > 1, "ambiguous_uri").when(F.col("text") > 1, "ambiguous_text").otherwise("ambiguous_match")
    ambiguous = top.select(*_KEY, "raw_value", reason.alias("reason"), F.col("item_id").alias("top_id"), "score", "margin", "recommended", "confidence", "n_candidates", "signals")
    no_match = left.join(top.select(*_KEY), _KEY, "left_anti").select(*_KEY, "raw_value", F.lit("no_match").alias("reason"))
    edges = found.select("source_id", "relation", "target_id", F.struct("pos", "ord").alias("ord"))
    if pick_top:
        edges = edges.unionByName(ambiguous.where("recommended").select("source_id", "relation", F.col("top_id").alias("target_id"), F.struct("pos", F.lit(0).alias("ord")).alias("ord")))
    edges = edges.groupBy("source_id", "relation", "target_id").agg(F.min("ord").alias("ord"))
    return {"edges": edges, "external_edges": external, "no_match": no_match, "ambiguous": ambiguous}


def emitted(edges: DataFrame, items: DataFrame, target: str | None = "target_id") -> DataFrame:
    """Edges whose source, and target if they have one, are among the items."""
    ids = items.select(F.col("id"))
    out = edges.join(ids, edges.source_id == ids.id, "left_semi")
    return out.join(ids, out[target] == ids.id, "left_semi") if target else out


__all__ = ["item_keys", "key_sizes", "resolve_values", "resolve_configured", "resolve_globally", "lookup_organisations", "with_external_predicate", "emitted", "uri_tail"]
