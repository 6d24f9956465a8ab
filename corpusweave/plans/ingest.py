"""A registry run from nothing but an address: what is asked for, in which order, and what becomes of it."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.functions.scalars import nonblank, truthy
from corpusweave.operators.normalize import owners
from corpusweave.plans.registry import Bronze, selected_headers, settled
from corpusweave.sources import bronze, live

_ISSUE = ["code", "level", "message"]


def _said(df: DataFrame, level: str, message) -> DataFrame:
    return df.select("code", F.lit(level).alias("level"), message.alias("message"))


def visit(spark: SparkSession, store: str, max_age_seconds: int, how: live.Asking) -> Callable[[DataFrame], DataFrame]:
    """A function that asks for addresses (code, stage, request) and returns code, stage, url, status, reason, body, attempt, cached."""

    def get(requests: DataFrame) -> DataFrame:
        found = settled(live.Answers(spark, f"{store}/pages", max_age_seconds, how).get(requests))
        return found.where("final").select("code", "stage", "url", "status", "reason", "body", "attempt", "cached")

    return get


def ingest(spark: SparkSession, root: str, store: str, ontology: DataFrame, max_age_seconds: int = 86_400, how: live.Asking = live.Asking(), per_page: int = 10_000, streams: int = 4) -> Bronze:
    """Headers (all pages), then for each list in force its header in detail, integration document and, if it is a base list, all pages of its items, then the
    owners; item pages and organisations are asked for later in the run, when it is known which. Raw answers are kept under `store` and used again while they
    are fresh.

    A run without headers is an error. A list whose header or items couldn't be had whole gets an error, so that it isn't published in part.
    What an answer holds that is no row is a warning, and in Bronze.quarantine.
    """
    root = root.rstrip("/")
    kept = lambda name: live.Answers(spark, f"{store}/{name}", max_age_seconds, how)
    none = F.lit(None).cast("string").alias("code")

    lists = settled(kept("headers").get_list(bronze.headers_request(root, per_page), "codelists", streams).withColumn("code", none))
    if not (bad := live.unanswered(lists, "headers")).isEmpty():
        raise ConnectionError(f"no headers: {bad.first().asDict()}")
    header_docs = live.documents(lists)
    headers = settled(bronze.rows_of(header_docs, "codelists", bronze.HEADER))
    chosen = selected_headers(headers)[0].select("code", F.col("id").cast("string").alias("id"))

    urls = bronze.request_urls(root)
    asked = {"json_header": chosen.where("id IS NOT NULL").select("code", urls[1].alias("request")), "integration": chosen.select("code", urls[0].alias("request"))}
    got = {"headers": lists, **{stage: settled(kept(stage).get(requests)) for stage, requests in asked.items()}}
    answered = live.documents(got["json_header"], "code").select("code", F.from_json("body", bronze.DETAIL).alias("d"))
    whole = answered.where("d IS NOT NULL").select(F.col("code").alias("asked"), "d.*")
    details = settled(whole.withColumnRenamed("code", "answered").withColumnRenamed("asked", "code"))
    base = details.where(truthy("base"))

    got["json_items"] = settled(kept("json_items").get(base.select("code", bronze.items_request(root, per_page=per_page).alias("request")), "codelistsItems"))
    item_docs = live.documents(got["json_items"], "code")
    items = bronze.rows_of(item_docs, "codelistsItems", bronze.ITEM)

    owned = owners(base).where("uuid IS NOT NULL").select("code", F.concat(F.lit(f"{root}/api/cmdb/read/ci/"), "uuid").alias("request"))
    got["owner"] = settled(kept("ci").get(owned))
    ci_docs = live.documents(got["owner"], "code").dropDuplicates(["file"])
    ci = bronze.rows_of(ci_docs, "configurationItemSet", bronze.CI).drop("code", "pos").dropDuplicates(["uuid"])

    dropped = reduce(DataFrame.unionByName, (bronze.quarantine(docs, field).select("code" if "code" in docs.columns else none, "file", "place", "pos", "reason", "value") for docs, field in ((header_docs, "codelists"), (item_docs, "codelistsItems"), (ci_docs, "configurationItemSet"))))
    dropped = settled(dropped)
    missing = reduce(DataFrame.unionByName, (live.unanswered(got[stage], stage) for stage in ("json_header", "json_items")))
    other = details.where((nonblank("answered").isNotNull()) & (nonblank("answered") != F.col("code")))
    lost = dropped.where("code IS NOT NULL").groupBy("code").agg(F.count(F.lit(1)).cast("string").alias("n"))
    notes = [
        _said(missing, "error", F.format_string("%s not answered: HTTP %d from %s", "stage", "status", "url")),
        _said(other, "warning", F.concat(F.lit("the header asked for is of another list, "), "answered")),
        _said(details.where(~truthy("base")), "warning", F.lit("no base list, so it isn't normalised")),
        _said(lost, "warning", F.concat("n", F.lit(" elements of its answers are no rows"))),
    ]
    integration = got["integration"].where("final").select("code", "url", "status", "reason", F.coalesce("body", F.lit("")).alias("body"))
    requests = reduce(DataFrame.unionByName, (live.log(answers, stage) for stage, answers in got.items() if stage != "integration"))
    return Bronze(
        headers, details.drop("answered"), items, ci, ontology, visit(spark, store, max_age_seconds, how), integration, requests, settled(reduce(DataFrame.unionByName, notes)), dropped,
        partial(live.search_organisations, url=f"{root}/api/cmdb/read/cilistfiltered?lang=sk", how=how),
    )
