"""Issue reports as aggregates of issue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_code(processed: DataFrame, issues: DataFrame, header_dups: DataFrame, item_dups: DataFrame) -> DataFrame:
    """processed: code, ttl_created, integration_ok. issues: code, level, message. *_dups: code, kind. One row a code, with flags
    for whether it belongs into the report of warnings, of errors, or neither."""
    said = issues.groupBy("code").agg(
        F.array_sort(F.collect_list(F.when(F.col("level") == "warning", F.col("message")))).alias("warnings"),
        F.array_sort(F.collect_list(F.when(F.col("level") == "error", F.col("message")))).alias("errors"),
    )
    kinds = lambda df, n: df.groupBy("code").agg(F.count_if(F.col("kind") == "shadow").alias(f"{n}_shadows"), F.count_if(F.col("kind") == "conflict").alias(f"{n}_conflicts"))
    out = processed.join(said, "code", "left").join(kinds(header_dups, "header"), "code", "left").join(kinds(item_dups, "item"), "code", "left")
    none = F.array().cast("array<string>")
    out = out.withColumns({c: F.coalesce(c, none) for c in ("warnings", "errors")} | {c: F.coalesce(c, F.lit(0)) for c in ("header_shadows", "header_conflicts", "item_shadows", "item_conflicts")})
    return out.withColumn("in_warnings", (F.size("warnings") > 0) | ~F.col("integration_ok") | (F.col("header_shadows") + F.col("item_shadows") > 0)).withColumn(
        "in_errors", (F.size("errors") > 0) | (F.col("header_conflicts") + F.col("item_conflicts") > 0)
    )


def summary(codes: DataFrame) -> DataFrame:
    """The counts of both summaries, in one row."""
    return codes.agg(
        F.count(F.lit(1)).alias("totalProcessed"), F.count_if("ttl_created").alias("ttlCreated"), F.count_if(~F.col("ttl_created")).alias("ttlFailed"),
        F.count_if(F.size("warnings") > 0).alias("withWarnings"), F.count_if(F.size("errors") > 0).alias("withErrors"), F.count_if(~F.col("integration_ok")).alias("integrationFailures"),
        F.sum("header_shadows").alias("duplicateHeaderShadows"), F.sum("item_shadows").alias("duplicateItemShadows"),
        F.sum("header_conflicts").alias("duplicateHeaderConflicts"), F.sum("item_conflicts").alias("duplicateItemConflicts"),
    )


def http_5xx(log: DataFrame) -> DataFrame:
    """log: code, url, status."""
    return log.where("status BETWEEN 500 AND 599").agg(F.count(F.lit(1)).alias("total5xx"), F.countDistinct("url").alias("uniqueUrls"), F.countDistinct("code").alias("affectedCodelists"))


def write_http_5xx(log: DataFrame, path: str) -> None:
    """Entries (code, stage, url, status, reason) and their counts, as JSON."""
    entries = log.where("status BETWEEN 500 AND 599")
    entries.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/entries")
    http_5xx(log).write.mode("overwrite").json(f"{path}/summary")


def hierarchy_issues(found: DataFrame) -> DataFrame:
    """One row for each source item with what wasn't resolved, by relation and place. found: source_id, relation, pos and more."""
    issue = F.struct("relation", "pos", *(c for c in found.columns if c not in ("source_id", "relation", "pos")))
    return found.groupBy("source_id").agg(F.sort_array(F.collect_list(F.struct(F.struct("relation", "pos").alias("k"), issue.alias("v")))).alias("x")).select("source_id", F.transform("x", lambda e: e["v"]).alias("issues"))


def write_hierarchy_issues(tables: dict[str, DataFrame], path: str) -> None:
    """What wasn't resolved and what was ambiguous, a JSON line for each source item."""
    for name in ("no_match", "ambiguous"):
        if name in tables:
            hierarchy_issues(tables[name]).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")


def write_reports(codes: DataFrame, path: str) -> None:
    """A JSON line for each code, under warnings and errors; nulls are kept."""
    for name in ("warnings", "errors"):
        codes.where(f"in_{name}").write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")
    summary(codes).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/summary")
