"""The whole registry run: bronze tables in, silver and gold tables out. All code lists are worked on at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.scalars import nonblank, truthy
from corpusweave.operators import audit, dedup, normalize, reports, resolve, triples
from corpusweave.sources.bronze import failures, integration_status
from corpusweave.sources.config import Config


@dataclass(frozen=True)
class Bronze:
    """headers, details (one row a code), items (with code and pos), ci, ontology (code and class arrays); or None: pages (url, status, body), or a function
    that asks for them (code, stage, request), integration (code, url, status, reason, body) and requests (code, stage, url, status, reason) as they
    were answered, notes (code, level, message) of what went wrong before, quarantine of what is no row, and a search of organisations by number."""

    headers: DataFrame
    details: DataFrame
    items: DataFrame
    ci: DataFrame
    ontology: DataFrame
    pages: DataFrame | Callable[[DataFrame], DataFrame] | None = None
    integration: DataFrame | None = None
    requests: DataFrame | None = None
    notes: DataFrame | None = None
    quarantine: DataFrame | None = None
    organisations: Callable[[DataFrame], DataFrame] | None = None


@dataclass(frozen=True)
class Options:
    """mode: 'configured' resolves relations within configured parents, 'global' among all items, with scores."""

    mode: str = "configured"
    strict_uri_audit: bool = False
    pick_top: bool = False


def settled(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder that spark.checkpoint.dir names (one of our own only where that is unset), so that
    later steps neither repeat this one nor depend on the executors that ran it. On a cluster it must be named."""
    import os
    import tempfile

    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "corpusweave-checkpoints"))
    return df.checkpoint(eager=True)


def selected_headers(headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The header in force of each code with a base header, and the duplicates found on the way."""
    base = headers.where(nonblank("code").isNotNull() & truthy("base")).withColumn("code", nonblank("code"))
    order = dedup.registry_order("codelistState", "effectiveTo", "validFrom", "temporal", "id", "pos")
    row = F.struct("id", "code", "codelistState", "temporal", "base", "validFrom", "effectiveFrom", "effectiveTo")
    canonical = dedup.current_header("codelistState", "temporal", "base", "effectiveTo")
    return dedup.best_per_key(base, "code", order), dedup.duplicate_issues(base, "code", canonical, _order_key("codelistState"), row)


def selected_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of each list's items with one code the best; rows without a code are passed on."""
    fixed = normalize.repair_identity(items)
    order = dedup.registry_order("codelistItemState", "effectiveTo", "validFrom", "temporal", "id", "pos")
    blank = nonblank("itemCode").isNull()
    best = dedup.best_per_key(fixed.where(~blank), ["code", "itemCode"], order).unionByName(fixed.where(blank))
    key = F.struct("code", "itemCode").alias("key")
    issues = dedup.duplicate_issues(
        fixed.where(~blank).withColumn("key", key), "key", dedup.current_item("codelistItemState", "temporal", "published"), _order_key("codelistItemState"),
        F.struct("id", "itemCode", "itemUri", "codelistItemState", "validFrom", "effectiveTo"), dedup.ITEM_REASONS,
    )
    return best, issues.select("key.code", "key.itemCode", "kind", "reason", "selected", "candidates")


def without_ignored(lists: DataFrame, ignore: list[str], key: str = "code") -> DataFrame:
    """The lists that the configuration doesn't keep from publication. Its codes are few, so they go into the filter."""
    return lists.where(F.col(key).isNull() | ~F.col(key).isin(*ignore)) if ignore else lists


def _order_key(state: str):
    """The registry order as one struct that sorts ascending."""
    from corpusweave.functions.scalars import iso_timestamp, state_rank

    to = F.unix_micros(iso_timestamp("effectiveTo"))
    return F.struct(state_rank(state), F.when(to.isNull(), F.lit(-(1 << 63))).otherwise(-to), -F.coalesce(F.unix_micros(iso_timestamp("validFrom")), F.lit(0)), truthy("temporal").cast("int"), F.coalesce(-F.col("id"), F.lit((1 << 63) - 1)), "pos")


def run(bronze: Bronze, config: Config = Config(), options: Options = Options()) -> dict[str, DataFrame]:
    """codelists, items, edges, external_edges, no_match, (ambiguous,) triples, issues, header_issues, item_issues, codes, summary, http_log, (quarantine).

    A list fails without a start date, a base header or a valid item URI, or if strict auditing finds anything; ignored lists take part
    in the resolution but aren't published.
    """
    headers, header_issues = selected_headers(bronze.headers)
    details = settled(bronze.details.join(headers.select("code"), "code", "left_semi").where(truthy("base")))
    items, item_issues = selected_items(bronze.items.join(details.select("code"), "code", "left_semi"))
    items = settled(items)
    patterns = settled(audit.infer_pattern(items, "code", "itemCode", "itemUri"))
    named = items.withColumn("names", F.map_values(_names()))  # in all languages
    judge = lambda pages: audit.audit(named, patterns, pages, "code", "itemCode", "itemUri", "names", options.strict_uri_audit)
    if callable(bronze.pages):
        bronze = replace(bronze, pages=bronze.pages(audit.to_visit(judge(None), "code", "itemUri")))
    audited = judge(None if bronze.pages is None else bronze.pages.select("url", "status", "body").dropDuplicates(["url"]))
    said = lambda df, message: df.select("code", F.lit("error").alias("level"), F.lit(message).alias("message"))
    issues = audited.select("code", "level", "message").unionByName(normalize.undated(details)).unionByName(said(patterns.where("base IS NULL"), "No valid item URI to infer the pattern from"))
    issues = issues.unionByName(patterns.where("bases > 1").select("code", F.lit("warning").alias("level"), F.concat(F.lit("Several URI bases: "), F.col("bases").cast("string")).alias("message")))
    integration = None
    if bronze.integration is not None:
        integration = settled(integration_status(bronze.integration.join(details.select("code"), "code", "left_semi")))
        issues = issues.unionByName(integration.where("message IS NOT NULL").select("code", F.lit("warning").alias("level"), "message"))
    if bronze.notes is not None:
        issues = issues.unionByName(bronze.notes.join(headers.select("code"), "code", "left_semi"))
    issues = settled(issues)
    failed = issues.where("level = 'error'").select("code").distinct()
    owners = normalize.publisher_icos(details, bronze.ci)
    issues = issues.unionByName(owners.where("failure IS NOT NULL").select("code", F.lit("warning").alias("level"), F.col("failure").alias("message")))
    whole = normalize.normalize_codelists(details, patterns.where("base IS NOT NULL"), owners.select("code", "ico"), normalize.last_modified(items), bronze.ontology).join(failed, "code", "left_anti")
    whole = settled(whole)
    all_items = settled(normalize.normalize_items(items, whole))
    raw = normalize.relations_raw(items.join(all_items.select("id", F.col("codelist_code").alias("code")), ["id", "code"], "left_semi"))
    raw = settled(raw)
    if options.mode == "configured":
        found = resolve.resolve_configured(raw, all_items, config.hierarchy, config.external)
    else:
        found = resolve.resolve_globally(raw, all_items, bronze.organisations or bronze.ci, pick_top=options.pick_top)
        found["external_edges"] = found["external_edges"].withColumn("uri", F.concat(F.lit(triples.PUBLISHERS), "identifier")).withColumn("predicate", F.lit(None).cast("string"))
    found = {name: settled(df) for name, df in found.items()}
    lists = without_ignored(whole, [*config.ignore])
    emitted = all_items.join(lists.select(F.col("code").alias("codelist_code")), "codelist_code", "left_semi")
    edges, external = resolve.emitted(found["edges"], emitted), resolve.emitted(found["external_edges"], emitted, None)
    graph, unpublished = triples.graph(lists, emitted, edges, external, config.relations)
    graph = settled(graph)
    issues = issues.unionByName(unpublished)
    made = graph.select("code").distinct().withColumn("ttl_created", F.lit(True))
    tried = details.select("code") if bronze.notes is None else details.select("code").union(bronze.notes.join(headers, "code", "left_semi").where("level = 'error'").select("code")).distinct()
    processed = tried.join(made, "code", "left").select("code", F.coalesce("ttl_created", F.lit(False)).alias("ttl_created"))
    if integration is not None:
        processed = processed.join(integration.groupBy("code").agg(F.bool_and("ok").alias("integration_ok")), "code", "left").withColumn("integration_ok", F.coalesce("integration_ok", F.lit(True)))
    else:
        processed = processed.withColumn("integration_ok", F.lit(True))
    codes = reports.per_code(processed, issues, header_issues.select("code", "kind"), item_issues.select("code", "kind"))
    prefixes = triples.list_prefixes(lists, triples.neighbours(edges, emitted))
    return {**found, "prefixes": prefixes, "codelists": lists, "items": emitted, "edges": edges, "external_edges": external, "triples": graph, "issues": issues, "header_issues": header_issues, "item_issues": item_issues, "codes": codes, "summary": reports.summary(codes), "http_log": http_log(bronze)} | ({} if bronze.quarantine is None else {"quarantine": bronze.quarantine})


def http_log(bronze: Bronze) -> DataFrame:
    """Server errors of all that was asked for: code, stage, url, status, reason. A page belongs to no list."""
    asked = []
    if bronze.requests is not None:
        asked.append(bronze.requests)
    if bronze.integration is not None:
        asked.append(bronze.integration.withColumn("stage", F.lit("integration")))
    if bronze.pages is not None:
        unsaid = {"code": F.lit(None).cast("string"), "stage": F.lit("deref"), "reason": F.lit(None).cast("string")}
        asked.append(bronze.pages.withColumns({c: v for c, v in unsaid.items() if c not in bronze.pages.columns}))
    none = bronze.headers.sparkSession.createDataFrame([], "code string, stage string, url string, status int, reason string")
    return reduce(DataFrame.unionByName, map(failures, asked), none)


def _names():
    from corpusweave.functions.temporal import language_values

    return language_values("codelistItemNames")


def write(tables: dict[str, DataFrame], path: str) -> None:
    """Tables as Parquet, the graph as Turtle, reports (of lists, server errors and relations) as JSON."""
    for name in ("codelists", "items", "edges", "external_edges", "no_match", "ambiguous", "header_issues", "item_issues", "issues", "quarantine"):
        if name in tables:
            tables[name].write.mode("overwrite").parquet(f"{path}/{name}")
    triples.write_turtle(tables["triples"], f"{path}/ttl", tables["prefixes"])
    reports.write_reports(tables["codes"], f"{path}/reports")
    reports.write_http_5xx(tables["http_log"], f"{path}/reports/http_5xx")
    reports.write_hierarchy_issues(tables, f"{path}/reports/hierarchy")
