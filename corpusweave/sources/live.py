"""Live ingestion: paged and single documents asked for over HTTP by all executors, with retries, a cache of raw answers, and a log of every request.

Answers are kept as they came (see ANSWER), an attempt a row; rows, quarantine and reports are all derived from that table, so a run is
repeatable without asking again.
"""

from __future__ import annotations

import datetime
import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from corpusweave.sources.bronze import exists, fetch

#: One attempt: of which request (its address, `{page}` where the page number goes) and stream of pages; `final` if it wasn't asked again,
#: `done` if it ended its stream well.
ATTEMPT = "request string, stream int, streams int, url string, page int, attempt int, status int, reason string, body string, final boolean, done boolean"
ANSWER = f"{ATTEMPT}, modified timestamp, run string"
_NAMES = [c.split()[0] for c in ATTEMPT.split(", ")]
Fetch = Callable[..., tuple[int, str, str]]


@dataclass(frozen=True)
class Asking:
    """How to ask. Connection failures (status 0), 429 and server errors are asked again, `wait` seconds later, then twice as long."""

    fetch: Fetch = fetch
    timeout: float = 60
    tries: int = 3
    wait: float = 1.0
    per_host: int = 8  # tasks that ask one host at a time, at most

    def attempts(self, url: str, *data: bytes) -> Iterator[tuple[int, int, str, str, bool]]:
        """attempt, status, reason, body, final."""
        for k in range(self.tries):
            status, reason, body = self.fetch(url, self.timeout, *data)
            final = (0 < status < 500 and status != 429) or k == self.tries - 1
            yield k + 1, status, reason, body, final
            if final:
                return
            time.sleep(self.wait * 2**k)


def count_rows(body: str, field: str) -> int:
    """Elements of a page: of its array field, or of the whole document if it is an array. -1: no such thing."""
    try:
        doc = json.loads(body)
    except ValueError:
        return -1
    rows = doc.get(field, []) if isinstance(doc, dict) else doc
    return len(rows) if isinstance(rows, list) else -1


def pages(how: Asking, request: str, field: str, stream: int = 0, streams: int = 1) -> Iterator[tuple]:
    """Attempts of the pages stream + 1, stream + 1 + streams, ... until a page without rows.

    A short page isn't taken for the last, as a server may give fewer rows a page than it was asked for; a page like the one before it ends the stream
    too, as of a server that doesn't know pages. A page that fails or isn't what was expected ends it badly.
    """
    page, before = stream + 1, None
    while True:
        url = request.replace("{page}", str(page))
        for attempt, status, reason, body, final in how.attempts(url):
            n = count_rows(body, field) if 200 <= status < 300 else -1
            again = before is not None and body == before
            done = final and (n == 0 or (n > 0 and again))
            yield request, stream, streams, url, page, attempt, status, reason, None if again else body, final, done
        if n <= 0 or done or "{page}" not in request:
            return
        page, before = page + streams, body


def single(how: Asking, request: str) -> Iterator[tuple]:
    """Attempts of one address."""
    for attempt, status, reason, body, final in how.attempts(request):
        yield request, 0, 1, request, 1, attempt, status, reason, body, final, final and 200 <= status < 400


class Pages(DataSource):
    """Attempts of one paged list, asked for by several streams of pages at once, a partition each.

    Use: spark.dataSource.register(Pages); spark.read.format("registry_pages").option("request", "http://.../list?page={page}").option("field",
    "rows").load(). Options: request, field, streams (4), timeout, tries, wait. Write the result and read that, as `ask_cached` does.
    """

    how = Asking()

    @classmethod
    def name(cls) -> str:
        return "registry_pages"

    def schema(self) -> str:
        return ATTEMPT

    def reader(self, schema) -> DataSourceReader:
        o, h = self.options, type(self).how
        how = Asking(h.fetch, float(o.get("timeout", h.timeout)), int(o.get("tries", h.tries)), float(o.get("wait", h.wait)))
        return _PageReader(how, o["request"], o.get("field", ""), int(o.get("streams", 4)))


class _Stream(InputPartition):
    def __init__(self, stream: int):
        self.stream = stream


class _PageReader(DataSourceReader):
    def __init__(self, how: Asking, request: str, field: str, streams: int):
        self.how, self.request, self.field, self.streams = how, request, field, streams if "{page}" in request else 1

    def partitions(self) -> list[InputPartition]:
        return [_Stream(k) for k in range(self.streams)]

    def read(self, partition: _Stream) -> Iterator[tuple]:
        return pages(self.how, self.request, self.field, partition.stream, self.streams)


def ask(requests: DataFrame, how: Asking, field: str | None = None) -> DataFrame:
    """Attempts of the addresses in `requests` (column request), page by page if there is a field to count. At most `per_host` tasks
    ask one host at a time."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for request in pdf["request"]:
                for row in single(how, request) if field is None else pages(how, request, field):
                    yield pd.DataFrame([row], columns=_NAMES)  # a page at a time, as it may be large

    host = F.coalesce(F.try_parse_url("request", F.lit("HOST")), F.lit(""))
    dealt = requests.select("request", host.alias("host"), F.pmod(F.xxhash64("request"), F.lit(how.per_host)).alias("turn")).repartition("host", "turn")
    return dealt.select("request").mapInPandas(run, ATTEMPT)


class Answers:
    """A table of raw answers in a shared folder, of which those no older than `max_age_seconds` are used again."""

    def __init__(self, spark: SparkSession, path: str, max_age_seconds: int = 86_400, how: Asking = Asking()):
        self.spark, self.path, self.max_age, self.how = spark, path, max_age_seconds, how
        self.now = F.lit(datetime.datetime.now(datetime.UTC))

    def known(self) -> DataFrame:
        return self.spark.read.schema(ANSWER).parquet(self.path) if exists(self.spark, self.path) else self.spark.createDataFrame([], ANSWER)

    def _whole(self) -> DataFrame:
        """request and run of the newest whole and fresh answers; a list of which a page is missing isn't whole."""
        runs = self.known().groupBy("request", "run").agg(F.count_if("done").alias("done"), F.max("streams").alias("streams"), F.max("modified").alias("modified"))
        fresh = runs.where((F.col("done") == F.col("streams")) & (F.col("modified") >= self.now - F.make_dt_interval(secs=F.lit(self.max_age))))
        newest = F.row_number().over(Window.partitionBy("request").orderBy(F.desc("modified"), "run"))
        return fresh.withColumn("n", newest).where("n = 1").select("request", "run")

    def _add(self, attempts: DataFrame) -> str:
        run = uuid4().hex
        attempts.select("*", self.now.alias("modified"), F.lit(run).alias("run")).write.mode("append").parquet(self.path)
        return run

    def _of(self, wanted: DataFrame, whole: DataFrame, run: str | None) -> DataFrame:
        new = wanted.select("request").distinct().join(whole, "request", "left_anti").withColumn("run", F.lit(run).cast("string"))
        used = whole.withColumn("cached", F.lit(True)).unionByName(new.withColumn("cached", F.lit(False)))
        return wanted.join(used, "request").join(self.known(), ["request", "run"]).drop("run")

    def get(self, requests: DataFrame, field: str | None = None) -> DataFrame:
        """`requests` (request and more columns) with the attempts that answer each, and whether they were in the cache. Each address is asked
        once. Requests without an address are left out."""
        from corpusweave.plans.registry import settled

        wanted = requests.where("request IS NOT NULL")
        whole = settled(wanted.select("request").distinct().join(self._whole(), "request"))
        run = self._add(ask(wanted.select("request").distinct().join(whole, "request", "left_anti"), self.how, field))
        return self._of(wanted, whole, run)

    def get_list(self, request: str, field: str, streams: int = 4) -> DataFrame:
        """The attempts that answer one paged list."""
        source = type("AskedPages", (Pages,), {"how": self.how})
        self.spark.dataSource.register(source)
        wanted = self.spark.createDataFrame([(request,)], "request string")
        whole = wanted.join(self._whole(), "request")
        run = None
        if whole.isEmpty():
            h = self.how
            options = {"request": request, "field": field, "streams": streams, "timeout": h.timeout, "tries": h.tries, "wait": h.wait}
            run = self._add(self.spark.read.format("registry_pages").options(**options).load())
            whole = whole.limit(0)
        return self._of(wanted, whole, run)


def documents(answers: DataFrame, *names: str) -> DataFrame:
    """file (the address), place (its number among the pages), body and the named columns of good answers. A page that a server gave twice counts once."""
    good = answers.where("final AND status BETWEEN 200 AND 299 AND body IS NOT NULL")
    first = F.row_number().over(Window.partitionBy("request", F.sha2("body", 256)).orderBy("page"))
    return good.withColumn("n", first).where("n = 1").select(F.col("url").alias("file"), F.col("page").alias("place"), "body", *names)


def log(answers: DataFrame, stage: str) -> DataFrame:
    """code, stage, url, status, reason, attempt, cached of all attempts. answers: with a column code."""
    return answers.select("code", F.lit(stage).alias("stage"), "url", "status", "reason", "attempt", "cached")


def unanswered(answers: DataFrame, stage: str) -> DataFrame:
    """code, stage, url, status, reason of the requests that weren't answered whole. answers: with a column code."""
    bad = answers.where("final").groupBy("code", "request").agg(
        (F.count_if("done") < F.max("streams")).alias("bad"), F.max_by(F.struct("url", "status", "reason"), F.struct(~F.col("done"), F.col("status").between(200, 299).cast("int") * -1, "page")).alias("last")
    )
    return bad.where("bad").select("code", F.lit(stage).alias("stage"), "last.url", "last.status", "last.reason")


# The filtered search of organisations.
ORGANISATION = "number string, uuid string, type string, attributes array<struct<name:string,value:string>>"


def organisation_query(attribute: str, number: str) -> bytes:
    wanted = {"name": attribute, "filterValue": [{"equality": "EQUAL", "value": number}]}
    return json.dumps({"filter": {"type": ["PO"], "attributes": [wanted], "metaAttributes": {"state": ["DRAFT"]}}, "page": 1, "perpage": 100}).encode()


def found_organisations(body: str) -> list[tuple]:
    """uuid, type and attributes of a search's hits; what isn't an object is left out, and an answer that isn't JSON has none."""
    try:
        doc = json.loads(body)
    except ValueError:
        return []
    rows = doc.get("configurationItemSet") if isinstance(doc, dict) else doc
    text = lambda x: None if x is None else str(x)
    # An attribute may also stand at the top of an item.
    pairs = lambda r: [*((a.get("name"), text(a.get("value"))) for a in r.get("attributes") or [] if isinstance(a, dict)), *((k, text(v)) for k, v in r.items() if isinstance(v, str | int | float))]
    return [(text(r.get("uuid")), text(r.get("type")), pairs(r)) for r in rows if isinstance(r, dict)] if isinstance(rows, list) else []


def _search(how: Asking, url: str, attribute: str, number: str) -> Iterator[tuple]:
    for _, status, _, body, final in how.attempts(url, organisation_query(attribute, number)):
        if final and 200 <= status < 300:
            yield from ((number, *hit) for hit in found_organisations(body))


class Organisations(DataSource):
    """Organisations by number, where only the numbers that a query's filter names are asked for: number = '...' or number IN (...).

    Options: url (of the search), attribute, per_task (20), timeout, tries, wait. A scan without such a filter is an error, as the whole register can't be
    asked for. Filters reach the source with spark.sql.python.filterPushdown.enabled; load anew for each query, as Spark keeps the filters of a DataFrame's
    last scan for one without any. For many numbers in a table use `search_organisations`.
    """

    how = Asking()

    @classmethod
    def name(cls) -> str:
        return "registry_organisations"

    def schema(self) -> str:
        return ORGANISATION

    def reader(self, schema) -> DataSourceReader:
        o, h = self.options, type(self).how
        how = Asking(h.fetch, float(o.get("timeout", h.timeout)), int(o.get("tries", h.tries)), float(o.get("wait", h.wait)))
        return _OrganisationReader(how, o["url"], o.get("attribute", "Gen_Profil_kod_metais"), int(o.get("per_task", 20)))


class _Numbers(InputPartition):
    def __init__(self, numbers: list[str]):
        self.numbers = numbers


class _OrganisationReader(DataSourceReader):
    def __init__(self, how: Asking, url: str, attribute: str, per_task: int):
        self.how, self.url, self.attribute, self.per_task, self.numbers = how, url, attribute, per_task, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("number",):
                asked = {str(v) for v in (f.value if isinstance(f, In) else [f.value]) if v is not None}
                self.numbers = asked if self.numbers is None else self.numbers & asked
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.numbers is None:
            raise ValueError("only organisations with given numbers can be asked for: filter by number = or number IN, with spark.sql.python.filterPushdown.enabled")
        numbers = sorted(self.numbers)
        return [_Numbers(numbers[i : i + self.per_task]) for i in range(0, len(numbers), self.per_task)] or [_Numbers([])]

    def read(self, partition: _Numbers) -> Iterator[tuple]:
        for number in partition.numbers:
            yield from _search(self.how, self.url, self.attribute, number)


def search_organisations(numbers: DataFrame, url: str, attribute: str = "Gen_Profil_kod_metais", how: Asking = Asking()) -> DataFrame:
    """The hits (see ORGANISATION) of each distinct number of a table's column `number`, searched for by at most `per_host` tasks. Null numbers aren't
    searched for; a search that fails has no hits."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            found = [hit for number in pdf["number"] for hit in _search(how, url, attribute, number)]
            yield pd.DataFrame([(n, u, t, [{"name": k, "value": v} for k, v in pairs]) for n, u, t, pairs in found], columns=["number", "uuid", "type", "attributes"])

    return numbers.select("number").where("number IS NOT NULL").distinct().repartition(how.per_host).mapInPandas(run, ORGANISATION)
