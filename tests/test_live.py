"""Live ingestion against a stub server: paging, retries, cache, log, quarantine, and a whole run from an address."""

from __future__ import annotations

import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from corpusweave.sources import bronze, live

DEF = "http://data.gov.sk/def/"
UUID = "00000000-0000-0000-0000-00000000000"
HOW = live.Asking(timeout=20, tries=3, wait=0.01)


def names(text):
    return [{"language": "sk", "value": text}]


class Registry(BaseHTTPRequestHandler):
    """Lists A (long), B (one), G (its items fail), H (its third page fails), W (not base), O (answers for another list)."""

    asked: Counter = Counter()
    posted: list = []
    cap = 10_000  # rows that a page has at most, whatever is asked for
    long = 25_000  # items of A; H has as many and a fifth more

    def log_message(self, *_):
        pass

    def say(self, status, doc):
        body = (doc if isinstance(doc, str) else json.dumps(doc)).encode()
        self.send_response(status)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def do_POST(self):
        doc = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        (wanted,) = doc["filter"]["attributes"]
        number = wanted["filterValue"][0]["value"]
        type(self).posted.append(number)
        org = lambda k: {"uuid": f"{UUID}{k}", "type": "PO", "attributes": [{"name": "EA_Profil_PO_ico", "value": number}, {"name": "Gen_Profil_nazov", "value": f"Org {number}"}]}
        hits = {"00000001": [org(1)], "00000002": [org(1), org(2)], "00000003": []}
        self.say(*((500, "down") if number == "00000005" else (200, {"configurationItemSet": hits.get(number, [org(9), "no object"])})))

    def do_GET(self):
        url, query = urlparse(self.path), {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        seen = self.asked[self.path] = self.asked[self.path] + 1
        page, per = int(query.get("pageNumber", 1)), min(int(query.get("perPage", 1)), self.cap)
        cut = lambda rows: rows[(page - 1) * per : page * per]
        *_, last = url.path.split("/")
        if last == "codelistheaders":
            rows = [{"id": k, "code": c, "codelistState": "PUBLISHED", "temporal": False, "base": True} for k, c in enumerate("ABGHWO")] + [7, {"id": 99, "code": "A", "codelistState": "UPDATING", "base": True}]
            return self.say(200, {"codelists": cut(rows)})
        if last == "codelistitems":
            code = url.path.split("/")[-2]
            if code == "G" or (code == "H" and page == 3):
                return self.say(503, "down")
            if code == "A" and page == 2 and seen == 1:
                return self.say(500, "once")
            item = lambda i: {"id": i, "itemCode": f"a{i}", "itemUri": f"{DEF}a/a{i}", "codelistItemState": "PUBLISHED", "validFrom": "2021-01-01", "codelistItemNames": names(f"Name {i}")}
            rows = {"A": [item(i) for i in range(self.long)], "H": [item(i) for i in range(30_000, 30_000 + self.long * 6 // 5)]}.get(code) or [
                {**item(100_000), "itemUri": f"{DEF}b/b1", "itemCode": "b1", "codelistItemIncludes": [{"value": "00000001"}, {"value": "2"}, {"value": "a7"}]}, {**item(100_001), "itemCode": "b2", "itemUri": f"{self.root()}/moved/b2"}, None,
                *({**item(k), "itemCode": f"b{k}", "itemUri": f"{self.root()}/page/b{k}"} for k in (100_003, 100_004)),
            ]
            return self.say(200, {"codelistsItems": cut(rows)})
        if "codelistheaders" in url.path:
            code = "ABGHWO"[int(last)]
            return self.say(200, {"code": "Z" if code == "O" else code, "base": code != "W", "validFrom": "2020-01-01", "codelistNames": names(f"List {code}"), "mainCodelistManagers": [{"value": f"x {UUID}1"}]})
        if "ci" in url.path.split("/"):
            return self.say(200, {"uuid": last, "type": "PO", "attributes": [{"name": "EA_Profil_PO_ico", "value": "12 345 678"}]})
        if "integration" in url.path:
            return self.say(404 if last == "A" else 200, f"<r><x>{last}</x></r>")
        return self.say(*((502, "") if "moved" in url.path else (200, "znalosti o:</b></font><br> <font x><b>Name 100001</b></font>")))

    def root(self):
        return f"http://127.0.0.1:{self.server.server_address[1]}"


@pytest.fixture
def registry():
    class Own(Registry):
        asked: Counter = Counter()
        posted: list = []

    server = ThreadingHTTPServer(("127.0.0.1", 0), Own)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_address[1]}", Own
    server.shutdown()


@pytest.mark.parametrize(("per_page", "cap"), [(10_000, 10_000), (10_000, 3_000), (25_000, 25_000)])
def test_no_item_of_a_long_list_is_lost(spark, tmp_path, registry, per_page, cap):
    root, served = registry
    served.cap = cap
    answers = live.Answers(spark, str(tmp_path / "a"), how=HOW)
    asked = spark.createDataFrame([("A",), ("B",), ("G",), ("H",)], "code string").select("code", bronze.items_request(root, per_page=per_page).alias("request"))
    got = answers.get(asked, "codelistsItems").cache()
    rows = bronze.rows_of(live.documents(got, "code"), "codelistsItems", bronze.ITEM)
    a = rows.where("code = 'A'").orderBy("pos").select("id").collect()
    assert [r.id for r in a] == list(range(25_000))
    assert rows.where("code = 'B'").count() == 4 and bronze.quarantine(live.documents(got, "code"), "codelistsItems").where("code = 'B'").select("pos", "reason", "value").collect() == [(2, "not an object", "null")]
    bad = {r.code: r.status for r in live.unanswered(got, "json_items").collect()}
    assert bad == {"G": 503, "H": 503}
    log = live.log(got, "json_items")
    assert log.where("code = 'G'").count() == 3 and log.where("status BETWEEN 500 AND 599 AND code = 'A'").count() == 1
    before = sum(served.asked.values())
    again = live.Answers(spark, str(tmp_path / "a"), how=HOW).get(asked, "codelistsItems").cache()
    assert {r.code for r in again.where("cached").select("code").distinct().collect()} == {"A", "B"}
    assert all("/A/" not in p or n <= 2 for p, n in served.asked.items()) and sum(served.asked.values()) > before  # only what failed was asked for again
    assert bronze.rows_of(live.documents(again, "code"), "codelistsItems", bronze.ITEM).where("code = 'A'").count() == 25_000
    stale = live.Answers(spark, str(tmp_path / "a"), -1, HOW).get(asked.where("code = 'B'"), "codelistsItems")
    assert [r.cached for r in stale.select("cached").distinct().collect()] == [False]


def _same(url, timeout, data=None):
    """A server without pages."""
    return 200, "OK", json.dumps([{"id": 1}, {"id": 2}])


def _down(url, timeout, data=None):
    return (0, "refused", "") if "down" in url else (200, "OK", url)


def test_pages_end(spark, tmp_path):
    got = live.Answers(spark, str(tmp_path / "a"), how=live.Asking(_same)).get_list("http://x/?p={page}", "rows", 3)
    assert bronze.rows_of(live.documents(got), "rows", "id int").count() == 2 and live.unanswered(got.withColumn("code", F.lit("c")), "s").isEmpty()
    again = live.Answers(spark, str(tmp_path / "a"), how=live.Asking(_down)).get_list("http://x/?p={page}", "rows", 3)
    assert again.where("NOT cached").isEmpty() and again.count() == got.count()


def test_answers_are_kept(spark, tmp_path):
    asked = spark.createDataFrame([("A", "http://a"), ("B", "http://down"), ("C", "http://a"), ("D", None)], "code string, request string")
    get = lambda age: {r.code: (r.status, r.body, r.cached) for r in live.Answers(spark, str(tmp_path / "a"), age, live.Asking(_down, wait=0)).get(asked).where("final").collect()}
    assert get(100) == {"A": (200, "http://a", False), "B": (0, "", False), "C": (200, "http://a", False)}
    assert get(100) == {"A": (200, "http://a", True), "B": (0, "", False), "C": (200, "http://a", True)}
    assert get(-1)["A"] == (200, "http://a", False)
    answers = live.Answers(spark, str(tmp_path / "a"), 100, live.Asking(_down, wait=0)).get(asked)
    assert {(r.url, r.probe) for r in bronze.probes(answers).collect()} == {("http://a", "HTTP 200, 8 chars"), ("http://down", "refused")}


def test_every_element_is_a_row_or_in_quarantine(spark, tmp_path):
    docs = {"a": {"rows": [{"id": 1}, 5, None, {"id": "x"}, [], "{}"]}, "b": [{"id": 2}, "s"], "c": {"id": 3}, "d": {"rows": {"id": 4}}, "e": {"rows": 7}, "f": {"rows": []}, "g": "text", "h": None}
    for name, doc in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    (tmp_path / "i.json").write_text('{"rows": [')
    (tmp_path / "j.json").write_text(" ")
    found = bronze.documents(spark, str(tmp_path)).withColumn("file", F.regexp_extract("file", r"(\w)\.json$", 1))
    rows, rest = bronze.rows_of(found, "rows", "id int").collect(), bronze.quarantine(found, "rows").collect()
    assert sorted((r.file, r.pos, r.id) for r in rows) == [("a", 0, 1), ("a", 3, None), ("b", 0, 2), ("c", 0, 3), ("d", 0, 4)]
    assert sorted((r.file, -1 if r.pos is None else r.pos, r.reason) for r in rest) == [
        ("a", 1, "not an object"), ("a", 2, "not an object"), ("a", 4, "not an object"), ("a", 5, "not an object"), ("b", 1, "not an object"), ("e", 0, "not an object"),
        ("g", 0, "not an object"), ("h", 0, "not an object"), ("i", -1, "not JSON"), ("j", -1, "not JSON"),
    ]


def test_only_wanted_organisations_are_asked_for(spark, registry):
    root, served = registry
    url = f"{root}/api/cmdb/read/cilistfiltered?lang=sk"
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(type("Asked", (live.Organisations,), {"how": HOW}))
    every = lambda: spark.read.format("registry_organisations").options(url=url, per_task=2, wait=0.01).load()
    some = every().where(F.col("number").isin(*(f"0000000{k}" for k in range(1, 5))) & (F.col("uuid") != f"{UUID}2"))
    assert sorted((r.number, r.uuid[-1]) for r in some.collect()) == [("00000001", "1"), ("00000002", "1"), ("00000004", "9")]
    assert sorted(served.posted) == [f"0000000{k}" for k in range(1, 5)]
    with pytest.raises(Exception, match="given numbers"):
        every().collect()
    served.posted.clear()
    from corpusweave.operators.resolve import lookup_organisations

    raw = spark.createDataFrame([(k, "includes", 0, v) for k, v in enumerate(["1", "00000001", "2", "3", "5", "123456789", "text", None])], "source_id long, relation string, pos int, raw_value string")
    got = lookup_organisations(raw, lambda numbers: live.search_organisations(numbers, url, how=HOW), "Gen_Profil_kod_metais").collect()
    assert sorted((r.source_id, r.identifier, r.name, r.matched_via) for r in got) == [(0, "00000001", "Org 00000001", "ico_lookup"), (1, "00000001", "Org 00000001", "ico_lookup")]
    assert Counter(served.posted) == Counter({"00000001": 1, "00000002": 1, "00000003": 1, "00000005": 3})


def test_run_from_an_address(spark, tmp_path, registry):
    from corpusweave.operators import ontology
    from corpusweave.plans.__main__ import main
    from corpusweave.plans.ingest import ingest

    root, served = registry
    served.long = 2_500
    main(["--data-root", str(tmp_path), "--out", str(tmp_path / "out"), "--fetch", root, "--tries", "2", "--per-page", "1000", "--mode", "global"])
    table = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    assert {r.code: r.publisher_ico for r in table("codelists").collect()} == {"A": "12345678", "B": "12345678", "O": "12345678"}
    assert table("items").where("codelist_code = 'A'").count() == 2_500
    said = {(r.code, r.level, r.message) for r in table("issues").collect()}
    assert {(c, x) for c, x, m in said if "not answered" in m} == {("G", "error"), ("H", "error")}
    assert any(c == "W" and "no base list" in m for c, _, m in said) and any(c == "O" and m.endswith(" Z") for c, _, m in said) and any(c == "B" and "no rows" in m for c, _, m in said)
    assert any(c == "A" and "HTTP 404" in m for c, _, m in said)
    assert [(r.source_id, r.identifier) for r in table("external_edges").collect()] == [(100_000, "00000001")] and set(served.posted) == {"00000001", "00000002"}
    assert sorted((r.code or "", r.value) for r in table("quarantine").collect()) == [("", "7"), ("B", "null"), ("O", "null")]
    log = [(r.code, r.stage, r.status) for r in spark.read.json(str(tmp_path / "out" / "reports" / "http_5xx" / "entries")).collect()]
    assert {("G", "json_items", 503), ("H", "json_items", 503), ("A", "json_items", 500)} <= set(log) and any(s.startswith("deref") and c == "B" for c, s, _ in log)
    assert Counter(log)["G", "json_items", 503] == 2
    summary = spark.read.json(str(tmp_path / "out" / "reports" / "summary")).first()
    assert (summary.totalProcessed, summary.ttlCreated, summary.integrationFailures) == (6 - 1, 3, 1)
    before = Counter(served.asked)
    read = ingest(spark, root, str(tmp_path / "answers"), ontology.class_map(ontology.no_triples(spark)), how=HOW, per_page=1000)
    assert read.items.where("code = 'A'").count() == 2_500
    assert {p.split("/codelistheaders/")[1].split("/")[0] for p, n in served.asked.items() if n > before[p] and "/codelistitems" in p} == {"G", "H"}
