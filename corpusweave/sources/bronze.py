"""Readers of raw registry documents, and the ingestion that fills them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.functions.temporal import ENTRIES

_MANAGERS = "array<struct<value:string,effectiveFrom:string,effectiveTo:string>>"
_PERIODS = "array<struct<language:string,value:string,effectiveFrom:string,effectiveTo:string>>"
_RELATION = "array<struct<value:string>>"
HEADER = "id bigint, code string, codelistState string, temporal string, base string, validFrom string, effectiveFrom string, effectiveTo string, locked string, lockedBy string"
DETAIL = f"code string, uri string, base string, validFrom string, effectiveFrom string, effectiveTo string, codelistNames {ENTRIES}, codelistLabels {ENTRIES}, codelistNotes {ENTRIES}, codelistSource array<string>, mainCodelistManagers {_MANAGERS}, codelistManagers {_MANAGERS}"
CI = "uuid string, type string, attributes array<struct<name:string,value:string>>"
ITEM = (
    "id bigint, itemCode string, itemUri string, codelistItemState string, temporal string, published boolean, validFrom string, effectiveTo string, "
    + ", ".join(f"codelistItem{n} {ENTRIES}" for n in ("Names", "Labels", "Notes", "AbbreviatedNames", "AdditionalContents"))
    + ", "
    + ", ".join(f"codelistItem{n} {_PERIODS}" for n in ("Validities", "LogicalOrders", "LegislativeValidities"))
    + ", "
    + ", ".join(f"codelistItem{n} {_RELATION}" for n in ("Includes", "IncludesAlso", "Excludes"))
)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """file, place and body of the JSON documents in a folder. Spark passes over files without a byte."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("file"), F.lit(1).alias("place"), F.regexp_replace(F.col("content").cast("string"), "^\ufeff", "").alias("body"))


def elements(docs: DataFrame, field: str) -> DataFrame:
    """Every element of an array field (or of the whole document, if it is an array): the columns of docs but body, then pos, value (JSON) and
    reason, which is null for objects and else says why it is no row.

    A document without the field, or with an object there, counts as an array of one. A document that isn't JSON is one element without pos.
    docs: file, place, body and more.
    """
    others = [c for c in docs.columns if c != "body"]
    names = ", ".join(f"d.`{c}`" for c in others)
    parsed = docs.withColumn("v", F.expr("try_parse_json(body)"))
    found = docs.sparkSession.sql(
        f"""SELECT {names}, x.pos, to_json(x.value) AS value, CASE WHEN schema_of_variant(x.value) NOT LIKE 'OBJECT%' THEN 'not an object' END AS reason
        FROM (SELECT *, coalesce(try_variant_get(v, '$.{field}'), v) AS a FROM {{parsed}} WHERE v IS NOT NULL) d,
        LATERAL variant_explode(CASE WHEN schema_of_variant(d.a) LIKE 'ARRAY%' THEN d.a ELSE parse_json(concat('[', to_json(d.a), ']')) END) x""",
        parsed=parsed,
    )
    broken = parsed.where("v IS NULL").select(*others, F.lit(None).cast("int").alias("pos"), F.coalesce("body", F.lit("")).alias("value"), F.lit("not JSON").alias("reason"))
    return found.unionByName(broken)


def rows_of(docs: DataFrame, field: str, schema: str) -> DataFrame:
    """The objects of an array field, with the columns of docs but body, and pos. What `elements` gives a reason for is left out (see `quarantine`); a
    malformed field is null. Of several places (pages), the rows of later ones have greater pos."""
    others = [c for c in docs.columns if c not in ("body", "place")]
    pos = (F.col("place").cast("long") - 1) * (1 << 31) + F.col("pos")
    rows = elements(docs, field).where("reason IS NULL")
    return rows.select(*others, pos.alias("pos"), F.from_json("value", schema).alias("r")).select(*others, "pos", "r.*")


def quarantine(docs: DataFrame, field: str) -> DataFrame:
    """The elements that are no rows: the columns of docs but body, pos, value and reason. Each element of the input is either here or in `rows_of`."""
    return elements(docs, field).where("reason IS NOT NULL")


def read_rows(spark: SparkSession, path: str, field: str, schema: str) -> DataFrame:
    """The objects of an array field (or of the whole document, if it is an array) in JSON documents, with file and pos.

    What isn't an object is left out; a single object counts as an array of one; a malformed field is null.
    """
    return rows_of(documents(spark, path), field, schema)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path, "codelists", HEADER)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items; the code is the file's name."""
    return read_rows(spark, path, "codelistsItems", ITEM).withColumn("code", F.regexp_extract("file", r"([^/]+)\.[^./]*$", 1))


def read_ci(spark: SparkSession, path: str) -> DataFrame:
    """Configuration items, from lists or from documents that hold them as configurationItemSet."""
    return read_rows(spark, path, "configurationItemSet", CI).drop("file", "pos")


def exists(spark: SparkSession, path: str) -> bool:
    """If there is such a file or folder, in whatever file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def request_urls(root: str, code: str = "code", codelist_id: str = "id") -> list:
    """The three addresses of a list: integration XML, header and items (the first page; `items_request` is for all)."""
    root = root.rstrip("/")
    return [
        F.format_string(f"{root}/api/integration/read/codelist/%s", F.col(code)).alias("xml_url"),
        F.format_string(f"{root}/api/codelist-repo/codelists/codelistheaders/%s", F.col(codelist_id).cast("string")).alias("header_url"),
        F.format_string(f"{root}/api/codelist-repo/codelists/codelistheaders/%s/codelistitems?language=sk&pageNumber=1&perPage=10000&sortBy=itemCode&ascending=true&lang=sk", F.col(code)).alias("items_url"),
    ]


def items_request(root: str, code: str = "code", per_page: int = 10_000):
    """The address of a list's items, with {page} where the page number goes."""
    tail = f"/codelistitems?language=sk&pageNumber={{page}}&perPage={per_page}&sortBy=itemCode&ascending=true&lang=sk"
    return F.concat(F.lit(f"{root.rstrip('/')}/api/codelist-repo/codelists/codelistheaders/"), F.col(code), F.lit(tail))


def headers_request(root: str, per_page: int = 10_000) -> str:
    return f"{root.rstrip('/')}/api/codelist-repo/codelists/codelistheaders?language=sk&pageNumber={{page}}&perPage={per_page}"


def fresh(files: DataFrame, seconds: int, now=None) -> DataFrame:
    """Rows whose modified time is at most so many seconds ago."""
    now = F.current_timestamp() if now is None else now
    return files.where(F.col("modified") >= now - F.make_dt_interval(secs=F.lit(seconds)))


def fetch(url: str, timeout: float, data: bytes | None = None) -> tuple[int, str, str]:
    """status, reason, body; a failed connection is status 0. With data it is posted as JSON."""
    import urllib.error
    import urllib.request

    try:
        ask = urllib.request.Request(url, data, {"Content-Type": "application/json"} if data is not None else {})  # noqa: S310
        with urllib.request.urlopen(ask, timeout=timeout) as r:  # noqa: S310
            return r.status, r.reason, r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, str(e.reason), e.read().decode("utf-8", "replace")
    except (OSError, ValueError) as e:
        return 0, f"{type(e).__name__}: {e}", ""


def failures(responses: DataFrame) -> DataFrame:
    """code, stage, url, status and reason of server errors. responses: those columns and more."""
    return responses.where("status BETWEEN 500 AND 599").select("code", "stage", "url", "status", "reason")


def probes(answers: DataFrame) -> DataFrame:
    """url and what came of asking for it, in words: the status and the length of the page, or why there is none."""
    said = F.when(F.col("status") == 0, F.col("reason")).otherwise(F.format_string("HTTP %d, %d chars", "status", F.length(F.coalesce("body", F.lit("")))))
    return answers.select("url", said.alias("probe"))


def integration_status(responses: DataFrame) -> DataFrame:
    """code, ok, xml_parsed and message (null if all is well) of each list's integration answer. responses: code, url, status, reason, body."""
    ok = F.col("status").between(200, 399)
    parsed = integration_rows(responses, "x string")
    failed = F.format_string("no integration document: HTTP %d from %s, so header and items are used alone", "status", "url")
    message = F.when(~F.coalesce(ok, F.lit(False)), failed).when(~F.col("xmlParsed"), F.lit("the integration document isn't XML"))
    return parsed.select("code", F.coalesce(ok, F.lit(False)).alias("ok"), F.col("xmlParsed").alias("xml_parsed"), message.alias("message"))


def integration_rows(responses: DataFrame, schema: str) -> DataFrame:
    """Fields of integration XML bodies; a body that can't be parsed is a warning, with xmlParsed false."""
    parsed = responses.withColumn("x", F.from_xml("body", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return parsed.withColumn("xmlParsed", F.col("x").isNotNull() & F.col("x._bad").isNull() & (F.col("status") == 200))
