"""Operators of the registry engine on small raw records, and the whole plan."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corpusweave.functions.temporal import ENTRIES
from corpusweave.operators import dedup, normalize, ontology, resolve, score, triples
from corpusweave.plans import registry
from corpusweave.sources import bronze, config

DEF = "https://data.gov.sk/def/"
ITEM_COLUMNS = "id long, codelist_code string, item_code string, item_uri string, item_uri_raw string, codelist_uri_pattern string, " + ", ".join(
    f"{c} string" for c in [*(x for x in resolve.TEXT_FIELDS if x != "item_code"), "codelist_name_sk", "codelist_name_en", "codelist_label_sk", "codelist_label_en"]
)


def items(spark, *rows):
    names = [x.split()[0] for x in ITEM_COLUMNS.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ITEM_COLUMNS)


def parent_items(spark):
    return items(
        spark, {"id": 1, "codelist_code": "S", "item_code": "s"}, {"id": 2, "codelist_code": "T", "item_code": "t"}, {"id": 3, "codelist_code": "E", "item_code": "e"},
        *({"id": i, "codelist_code": "P", "item_code": c, "name_sk": n, "item_uri": f"{DEF}p/{c}"} for i, c, n in [(10, "A1", "Alfa"), (11, "B2", "Beta"), (12, "C3", "Alfa")]),
    )


def raw(spark, *rows):
    return spark.createDataFrame([(s, "includes", k, v) for k, (s, v) in enumerate(rows)], "source_id long, relation string, pos int, raw_value string")


def test_configured_resolution(spark):
    values = ["A1", "beta", "Alfa", "A1, Alfa", "A1 B2", "zzz", f"{DEF}p/B2", "A1, A1", "x; y", "pozri http://e/C3"]
    asked = raw(spark, *((1, v) for v in values), (2, "A1"), (3, "a b"), (3, "abc"), (3, "ICO"))
    out = resolve.resolve_configured(asked, parent_items(spark), {"S": "P", "E": "http://ex/"}, {"http://ex/": {"includes": "skos:broader"}})
    edges = {r.target_id: r.ord for r in out["edges"].collect()}
    assert edges == {10: 0, 11: 1, 12: 9}
    bad = {(r.source_id, r.raw_value): (r.reason, r.candidates) for r in out["no_match"].collect()}
    assert bad == {
        (1, "Alfa"): ("no_match_in_configured_parent", []), (1, "A1 B2"): ("multiple_matches_in_configured_parent", [10, 11]), (1, "zzz"): ("no_match_in_configured_parent", []), (1, "x; y"): ("no_match_in_configured_parent", []),
        (2, "A1"): ("no_parent_config", []), (3, "a b"): ("external_identifier_not_found", []),
    }
    assert {(r.identifier, r.uri, r.predicate) for r in out["external_edges"].collect()} == {("abc", "http://ex/abc", "skos:broader"), ("ICO", "http://ex/ICO", "skos:broader")}


def test_clues_that_each_mean_one_item(spark):
    # Two clues mean item 10 alone; a third that means another leaves it to the references inside the text.
    keys = resolve.item_keys(parent_items(spark), scope=F.lit("*"))
    asked = raw(spark, (1, "A1, http://e/A1, t")).withColumn("scope", F.lit("*"))
    assert [r.target_id for r in resolve.resolve_values(asked, keys).collect()] == [10]
    asked = raw(spark, (1, "A1, http://e/A1, nothing")).withColumn("scope", F.lit("*"))
    assert [r.target_id for r in resolve.resolve_values(asked, keys).collect()] == [10]


def test_score_worked_example(spark):
    rows = items(
        spark, {"id": 1, "codelist_code": "D", "item_code": "01.1", "codelist_uri_pattern": f"{DEF}x-detail/"},
        {"id": 2, "codelist_code": "X", "item_code": "01", "codelist_uri_pattern": f"{DEF}x/", "item_uri": f"{DEF}x/01"},
    )
    asked = spark.createDataFrame([(1, "includes", 0, "01", 2)], "source_id long, relation string, pos int, raw_value string, item_id long")
    r = score.rank_candidates(asked, rows).first()
    assert (r.score, r.confidence, r.recommended, r["rank"]) == (20.25, 0.99, True, 1)
    r = score.rank_candidates(asked, rows, with_signals=True).first()
    assert r.signals == ["code_exact", "text_exact", "clue_text:01", "clue_tokens:01", "family_token_overlap:x", "family_parent_match:x-detail->x"]
    rows = items(spark, {"id": 1, "codelist_code": "D", "item_code": "a", "item_uri": f"{DEF}x-detail/a"}, {"id": 2, "codelist_code": "X", "item_code": "b", "item_uri": f"{DEF}x/b"})
    r = score.rank_candidates(asked.withColumn("raw_value", F.lit("?")), rows, with_signals=True).first()
    assert (r.score, r.signals) == (5.5, ["family_token_overlap:x", "family_parent_match:x-detail->x"])  # families of URIs, where there is no pattern


def test_global_resolution(spark):
    code = "Gen_Profil_kod_metais"
    ci = spark.createDataFrame([("u1", "PO", [(code, "00151742"), ("EA_Profil_PO_ico", "00151742"), ("Gen_Profil_nazov", "Office")]), ("u4", "ISVS", [(code, "00151742")]), ("u2", "PO", [(code, "7")]), ("u3", "PO", [(code, "0007")])], "uuid string, type string, attributes array<struct<name:string,value:string>>")
    asked = raw(spark, (1, "A1 B2"), (1, "Alfa"), (1, "nothing"), (1, "151742"), (1, "7"))
    out = resolve.resolve_globally(asked, parent_items(spark), ci, pick_top=True)
    assert {r.target_id for r in out["edges"].collect()} == {10, 11}
    a = out["ambiguous"].first()
    assert (a.raw_value, a.reason, a.top_id, a.n_candidates, a.recommended) == ("Alfa", "ambiguous_text", 10, 2, False)
    assert a.signals == ["text_exact", "clue_text:Alfa", "clue_tokens:alfa"]
    assert {r.raw_value for r in out["no_match"].collect()} == {"nothing", "7"}
    assert [(r.identifier, r.name) for r in out["external_edges"].collect()] == [("00151742", "Office")]


HEADERS = "code string, id long, codelistState string, effectiveTo string, validFrom string, temporal string, base string, pos int, effectiveFrom string"


def headers(spark, *rows):
    return spark.createDataFrame([("C", i, s, e, v, "false", "true", k, None) for k, (i, s, e, v) in enumerate(rows)], HEADERS)


def test_ranked_headers(spark):
    rows = [(1, "PUBLISHED", "2030-01-01", "2020-01-01"), (2, "PUBLISHED", None, "2010-01-01"), (3, "UPDATING", None, "2024-01-01")]
    best, issues = registry.selected_headers(headers(spark, *rows))
    assert [r.id for r in best.collect()] == [2]
    (x,) = issues.collect()
    assert (x.kind, x.selected.id, [c.id for c in x.candidates]) == ("shadow", 2, [2, 1, 3])
    best, issues = registry.selected_headers(headers(spark, *rows, (4, "PUBLISHED", None, "2010-01-01")))
    assert [r.id for r in best.collect()] == [4] and issues.first().kind == "conflict"
    best, _ = registry.selected_headers(headers(spark, (1, "PUBLISHED", None, "1960-01-01"), (2, "PUBLISHED", None, None)))
    assert [r.id for r in best.collect()] == [2]  # no start ranks as 1970
    assert registry.selected_headers(headers(spark, *rows).limit(0))[0].collect() == []


def test_last_wins(spark):
    df = spark.createDataFrame([(1, "A", 0), (1, "B", 0), (1, "B", 1), (2, None, 0)], "id long, code string, pos int")
    assert sorted(tuple(r) for r in dedup.last_wins(df, "id", F.col("code"), F.col("pos")).collect()) == [(1, "B", 1), (2, None, 0)]


RDF = """<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:dct="http://purl.org/dc/terms/" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#">
<rdf:Description rdf:about="https://e/x/Kind"><dct:source rdf:resource="https://e/set/codelist/CL000001"/><rdfs:label xml:lang="en">Kind &amp; co</rdfs:label></rdf:Description>
<rdf:Description rdf:about="https://e/x/Kind"><rdf:type rdf:resource="http://www.w3.org/2002/07/owl#Class"/><rdfs:seeAlso rdf:nodeID="b1"/></rdf:Description>
<rdf:Description rdf:nodeID="b1"><rdfs:label>blank</rdfs:label></rdf:Description>
<owl:Class rdf:about="https://e/x/Other"><dct:source rdf:resource="https://e/set/codelist/CL000001/"/></owl:Class>
<rdf:Description rdf:about="https://e/x/prop"><dct:source rdf:resource="https://e/set/codelist/CL000002"/></rdf:Description></rdf:RDF>"""


def test_ontology(spark, tmp_path):
    (tmp_path / "egov.rdf").write_text(RDF, encoding="utf-8")
    t = ontology.read_rdf_xml(spark, [str(tmp_path / "egov.rdf")])
    assert t.count() == 8
    (r,) = ontology.class_map(t).collect()
    assert (r.code, r.item_type_uris, r.item_type_qnames, r.ontologies) == ("CL000001", ["https://e/x/Kind", "https://e/x/Other"], ["egov:Kind", "egov:Other"], ["egov"])
    nodes = {n["@id"]: n for n in (json.loads(r.node) for r in ontology.jsonld_nodes(t).collect())}
    assert nodes["https://e/x/Kind"] == {"@id": "https://e/x/Kind", "@type": "owl:Class", "label": {"@language": "en", "@value": "Kind & co"}, "rdfs:seeAlso": {"@id": "_:egov-b1"}, "source": "https://e/set/codelist/CL000001"}
    ontology.write_jsonld(t, str(tmp_path / "out"))
    d = json.loads((tmp_path / "out" / "egov.jsonld").read_text())
    assert d["@context"] == ontology.context("egov") and {n["@id"] for n in d["@graph"]} == nodes.keys()
    assert ontology.context("egov")["@vocab"].endswith("/egov/") and len(ontology.context("egov")) == 15


def test_config(tmp_path):
    c = config.parse({
        "hierarchy": {" A ": " B ", "C": "http://ex"}, "relationPredicates": {"Includes": {"predicate": "dct:isPartOf"}}, "excludesPredicate": "skos:related",
        "externalPredicates": {"http://ex": {"codelistItemIncludes": "skos:broader", "default": "rdfs:seeAlso"}, "http://ex/deep": "dct:relation"}, "ignore": {"X": {}},
    })
    assert c.hierarchy == {"A": "B", "C": "http://ex/"} and list(c.ignore) == ["X"]
    assert c.relations["includes"] == {"predicate": "dct:isPartOf", "inversePredicate": "skos:narrower"}
    assert config.predicate(c, "codelistItemExcludes") == "skos:related" and config.predicate(c, "includesAlso") is None
    assert config.external_predicate(c, "http://ex/1", "includes") == "skos:broader" and config.external_predicate(c, "http://ex/1", "excludes") == "rdfs:seeAlso"
    assert config.external_predicate(c, "http://ex/deep/1", "includes") == "dct:relation" and config.external_predicate(c, "http://other/", "includes") is None
    assert config.load(tmp_path / "none.json") == config.Config() and config.relation_key("foo") == "foo"
    for bad in ({"relationPredicates": {"includes": "a:b", "Includes": "c:d"}}, {"ignore": []}, [], {"externalPredicates": {"http://x": {"includes": "a:b", "include": "c:d"}}}):
        with pytest.raises(ValueError, match="twice|object"):
            config.parse(bad)


def test_predicates():
    assert triples.iri("skos:related") == "http://www.w3.org/2004/02/skos/core#related" and triples.iri(" ") == "http://purl.org/dc/terms/relation"
    assert triples.iri("egov:excludes") == "https://data.gov.sk/def/ontology/egov/excludes"
    with pytest.raises(ValueError, match="foo:x"):
        triples.iri("foo:x")


def test_sources(spark, tmp_path):
    got = spark.createDataFrame([("http://a", 200, "OK", "<r><a>8</a></r>"), ("http://bad", 500, "down", "")], "url string, status int, reason string, body string")
    parsed = {r.url: (r.xmlParsed, r.x and r.x.a) for r in bronze.integration_rows(got, "a int").collect()}
    assert parsed["http://a"] == (True, 8) and parsed["http://bad"][0] is False
    (tmp_path / "CL1.json").write_text(json.dumps({"codelistsItems": [{"id": 1, "itemCode": "a"}, "junk", None, {"id": 2, "published": False}]}))
    (tmp_path / "CL2.json").write_text(json.dumps({"codelistsItems": {"id": 3, "itemCode": "only"}}))
    rows = sorted((r.code, r.pos, r.id, r.itemCode, r.published) for r in bronze.read_items(spark, str(tmp_path)).collect())
    assert rows == [("CL1", 0, 1, "a", None), ("CL1", 3, 2, None, False), ("CL2", 0, 3, "only", None)]


def names(text):
    return [{"language": "sk", "value": text, "effectiveFrom": None, "effectiveTo": None}]


def raw_bronze(spark, **changes):
    heads = [("A", "PUBLISHED", "true"), ("A", "UPDATING", "true"), ("B", "PUBLISHED", "true"), ("N", "PUBLISHED", "false"), ("X", "PUBLISHED", "true"), ("U", "PUBLISHED", "true")]
    h = spark.createDataFrame([(k, c, s, "false", b, "2020-01-01", None, None, k) for k, (c, s, b) in enumerate(heads)], "id long, code string, codelistState string, temporal string, base string, validFrom string, effectiveFrom string, effectiveTo string, pos int")
    manager = [{"value": "x 00000000-0000-0000-0000-000000000001", "effectiveFrom": None, "effectiveTo": None}]
    fields = [f.split(" ")[0] for f in bronze.DETAIL.replace(f" {ENTRIES}", " e").replace(bronze._MANAGERS, "m").split(", ")]
    d = spark.createDataFrame([tuple({"code": c, "base": "true", "validFrom": None if c == "U" else "2020-01-01", "codelistNames": names(f"List {c}"), "codelistSource": ["src", "src", " "], "mainCodelistManagers": manager if c == "A" else None}.get(f) for f in fields) for c in "ABXU"], bronze.DETAIL)
    i_fields = [f.split(" ")[0] for f in bronze.ITEM.replace(ENTRIES, "e").split(", ") if " " in f]
    rel = lambda *v: [{"value": x} for x in v]
    made = [
        ("A", {"id": 1, "itemCode": "a1", "itemUri": f"{DEF}a/a1", "codelistItemIncludes": rel("b1", "nothing"), "codelistItemNames": names("Prvá")}),
        ("A", {"id": 2, "itemCode": "a1", "itemUri": f"{DEF}a/a1", "codelistItemState": "UPDATING"}),
        ("A", {"id": 3, "itemCode": f"{DEF}a/a2", "itemUri": None}), ("A", {"id": 4, "itemCode": "a3", "itemUri": f"{DEF}z/a3"}), ("A", {"id": None, "itemCode": "a4"}),
        ("B", {"id": 10, "itemCode": "b1", "itemUri": f"{DEF}b/b1", "codelistItemNames": names("Beta")}), ("X", {"id": 20, "itemCode": "x1", "itemUri": f"{DEF}x/x1"}), ("U", {"id": 30, "itemCode": "u1", "itemUri": f"{DEF}u/u1"}),
    ]
    rows = [tuple({"codelistItemState": "PUBLISHED", "temporal": "false", "validFrom": "2021-02-03", **r}.get(f) for f in i_fields) + (k, c) for k, (c, r) in enumerate(made)]
    i = spark.createDataFrame(rows, f"{bronze.ITEM}, pos int, code string")
    ci = spark.createDataFrame([("00000000-0000-0000-0000-000000000001", "PO", [("EA_Profil_PO_ico", "12 345 678")])], "uuid string, type string, attributes array<struct<name:string,value:string>>")
    onto = spark.createDataFrame([("B", ["https://e/Kind"], ["egov:Kind"], ["egov"])], "code string, item_type_uris array<string>, item_type_qnames array<string>, ontologies array<string>")
    return registry.Bronze(**({"headers": h, "details": d, "items": i, "ci": ci, "ontology": onto} | changes))


def test_plan(spark, tmp_path):
    c = config.Config(hierarchy={"A": "B"}, ignore={"X": {}})
    out = registry.run(raw_bronze(spark), c)
    assert {r.code: (r.publisher_ico, r.name_sk, r.source_values, r.uri_pattern) for r in out["codelists"].collect()} == {"A": ("12345678", "List A", ["src"], f"{DEF}a/"), "B": (None, "List B", ["src"], f"{DEF}b/")}
    assert {r.id: (r.item_code, r.item_uri) for r in out["items"].collect()} == {1: ("a1", f"{DEF}a/a1"), 3: ("a2", f"{DEF}a/a2"), 4: ("a3", f"{DEF}a/a3"), 10: ("b1", f"{DEF}b/b1")}
    assert [(r.source_id, r.target_id) for r in out["edges"].collect()] == [(1, 10)]
    assert [(r.raw_value, r.reason) for r in out["no_match"].collect()] == [("nothing", "no_match_in_configured_parent")]
    lines = [r.line for r in triples.ntriples(out["triples"]).collect()]
    assert len(lines) == len(set(lines))
    for want in (
        f"<{DEF}a/a1> <http://www.w3.org/2004/02/skos/core#broader> <{DEF}b/b1> .", f"<{DEF}b/b1> <http://www.w3.org/2004/02/skos/core#narrower> <{DEF}a/a1> .",
        f'<{DEF}a/a1> <http://www.w3.org/2004/02/skos/core#prefLabel> "Prvá"@sk .', f"<{DEF}b/b1> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <https://e/Kind> .",
        "<https://data.gov.sk/set/codelist/A/2020-01-01> <http://purl.org/dc/terms/publisher> <https://data.gov.sk/id/legal-subject/12345678> .",
        '<https://data.gov.sk/set/codelist/A/2020-01-01> <http://purl.org/dc/terms/modified> "2021-02-03"^^<http://www.w3.org/2001/XMLSchema#date> .',
    ):
        assert want in lines, want
    issues = {(r.code, r.level) for r in out["issues"].collect()}
    assert issues == {("A", "warning"), ("B", "warning"), ("X", "warning"), ("U", "warning"), ("U", "error")}
    assert {r.code for r in out["header_issues"].collect()} == {"A"} and [(r.code, r.itemCode, r.kind) for r in out["item_issues"].collect()] == [("A", "a1", "shadow")]
    s = out["summary"].first()
    assert (s.totalProcessed, s.ttlCreated, s.withErrors, s.duplicateHeaderShadows, s.duplicateItemShadows) == (4, 2, 1, 1, 1)
    registry.write(out, str(tmp_path / "out"))
    assert sorted(f.name for f in (tmp_path / "out" / "ttl").iterdir()) == ["A.ttl", "B.ttl"]
    strict = registry.run(raw_bronze(spark), c, registry.Options(strict_uri_audit=True))
    assert {r.code for r in strict["codelists"].collect()} == {"B"}  # an item of A isn't where its list's pattern says
    everywhere = registry.run(raw_bronze(spark), c, registry.Options(mode="global"))
    assert [(r.source_id, r.target_id) for r in everywhere["edges"].collect()] == [(1, 10)]


def test_plan_reports_what_was_asked_for(spark, tmp_path):
    b = raw_bronze(spark)
    answer = [("A", "http://r/A", 503, "down", ""), ("B", "http://r/B", 200, "OK", "<r><x>1</x></r>"), ("X", "http://r/X", 200, "OK", "<r><x>")]
    page = "znalosti o:</b></font><br> <font x><b>Tretia</b></font>"
    items_ = b.items.withColumn("codelistItemNames", F.when(F.col("id") == 4, F.array(F.struct(*(F.lit(v).cast("string").alias(k) for k, v in names("TRETIA")[0].items())))).otherwise(F.col("codelistItemNames")))
    pages = spark.createDataFrame([(f"{DEF}a/a3", 200, page), (f"{DEF}z/a3", 502, "")], "url string, status int, body string")
    asked = spark.createDataFrame([("B", "json_items", "http://r/B/items", 500, "oops"), ("B", "json_header", "http://r/B/header", 200, "OK")], "code string, stage string, url string, status int, reason string")
    out = registry.run(raw_bronze(spark, items=items_, integration=spark.createDataFrame(answer, "code string, url string, status int, reason string, body string"), pages=pages, requests=asked), config.Config(hierarchy={"A": "B"}))
    said = {(r.code, r.message) for r in out["issues"].collect()}
    assert ("A", "no integration document: HTTP 503 from http://r/A, so header and items are used alone") in said and ("X", "the integration document isn't XML") in said
    assert any(c == "A" and "the expected page has the item's label" in m for c, m in said)
    assert out["summary"].first().integrationFailures == 1
    assert {r.code: r.integration_ok for r in out["codes"].collect()} == {"A": False, "B": True, "X": True, "U": True}
    assert {(r.code, r.stage, r.status) for r in out["http_log"].collect()} == {("A", "integration", 503), ("B", "json_items", 500), (None, "deref", 502)}
    registry.write(out, str(tmp_path / "out"))
    read = lambda name: [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out" / "reports" / name)).collect()]
    assert read("http_5xx/summary") == [{"total5xx": 3, "uniqueUrls": 3, "affectedCodelists": 2}] and len(read("http_5xx/entries")) == 3
    (r,) = read("hierarchy/no_match")
    assert r["source_id"] == 1 and [x["raw_value"] for x in r["issues"]] == ["nothing"]


def test_command_line(spark, tmp_path):
    from corpusweave.plans.__main__ import main

    def put(name, value):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(value if isinstance(value, str) else json.dumps(value))

    put("headers/h.json", {"codelists": [{"id": 1, "code": "A", "codelistState": "PUBLISHED", "temporal": False, "base": True}]})
    put("details/A.json", {"code": "A", "base": True, "validFrom": "2020-01-01", "codelistNames": names("List"), "mainCodelistManagers": [{"value": "x 00000000-0000-0000-0000-000000000001"}]})
    put("items/A.json", {"codelistsItems": [{"id": 1, "itemCode": "a1", "itemUri": f"{DEF}a/a1", "codelistItemState": "PUBLISHED", "validFrom": "2021-01-01", "codelistItemNames": names("Prvá")}]})
    put("ci/c.json", {"configurationItemSet": [{"uuid": "00000000-0000-0000-0000-000000000001", "type": "PO", "attributes": [{"name": "EA_Profil_PO_ico", "value": "12345678"}]}]})
    put("integration/i.json", {"code": "A", "url": "http://r/A", "status": 404, "reason": "no", "body": ""})
    for k in range(2):
        main(["--data-root", str(tmp_path), "--out", str(tmp_path / "out")])
        ttl = (tmp_path / "out" / "ttl" / "A.ttl").read_text()
        assert "@prefix skos: <http://www.w3.org/2004/02/skos/core#> ." in ttl and 'skos:prefLabel "Prvá"@sk' in ttl and f"@prefix a: <{DEF}a/> ." in ttl and "\na:a1 " in ttl and "12345678" in ttl
        assert ("dct:source" in ttl, (tmp_path / "out" / "jsonld" / "egov.jsonld").exists()) == (False, k == 1)
        assert spark.read.json(str(tmp_path / "out" / "reports" / "summary")).first().integrationFailures == 1
        put("ontology/egov.rdf", RDF)  # for the second run


def test_audit_with_pages(spark):
    page = lambda t: f"znalosti o:</b></font><br> <font x><b>{t}</b></font>"
    pages = spark.createDataFrame([(f"{DEF}a/a3", 200, page("Tretia")), (f"{DEF}z/a3", 404, "")], "url string, status int, body string")
    rows = spark.createDataFrame([("A", "a3", f"{DEF}z/a3", "tretia")], "code string, itemCode string, itemUri string, name string")
    patterns = spark.createDataFrame([("A", f"{DEF}a/")], "code string, base string")
    from corpusweave.operators.audit import audit, blocked

    got = audit(rows, patterns, pages, "code", "itemCode", "itemUri", "name", strict=True)
    r = got.first()
    assert (r.category, r.supported_by_page, r.level, r.expected_uri) == ("base_mismatch", True, "error", f"{DEF}a/a3")
    assert blocked(got, "code").first().validation_blocked


def test_no_rows(spark):
    b = raw_bronze(spark)
    empty = registry.Bronze(*(getattr(b, f).limit(0) for f in ("headers", "details", "items", "ci", "ontology")))
    out = registry.run(empty, config.Config(hierarchy={"A": "B"}))
    assert out["triples"].collect() == [] and out["summary"].first().totalProcessed == 0


def test_missing_item_date_fails_the_list(spark):
    lists = spark.createDataFrame([("A",)], "code string").selectExpr("code", "'http://l/A' AS uri", "date'2020-01-01' AS valid_from", "null AS last_modified", "'p' AS uri_pattern", "'x' AS publisher_ico", "null AS effective_from", "null AS effective_to", "array() AS source_values", *(f"'' AS {n}_{t}" for n in ("name", "label", "note") for t in ("sk", "en")))
    i = lists.selectExpr("1L AS id", "'A' AS codelist_code", "'http://l/A/1' AS item_uri", "'1' AS item_code", "date(null) AS valid_from", "date(null) AS effective_from", "date(null) AS effective_to", "1L AS logical_order", "true AS legislative_validity", "array('') AS item_type_uris", *(f"'' AS {n}_{t}" for n in ("name", "label", "note") for t in ("sk", "en")))
    edges = lists.selectExpr("1L AS source_id", "'includes' AS relation", "1L AS target_id").limit(0)
    graph, errors = triples.graph(lists, i, edges, None, config.DEFAULT_PREDICATES)
    assert graph.collect() == [] and [r.code for r in errors.collect()] == ["A"]


def test_streaming(spark, tmp_path):
    from corpusweave.streaming.dedup import best_per_window, first_within

    src = str(tmp_path / "in")
    df = spark.createDataFrame([("k", 2, "2024-01-01 00:00:00"), ("k", 1, "2024-01-01 00:10:00"), ("j", 5, "2024-01-01 00:20:00"), ("z", 9, "2024-01-02 00:00:00")], "key string, rank int, t string").selectExpr("key", "rank", "to_timestamp(t) AS ts")
    df.write.parquet(src)
    for name, make in (("best", lambda s: best_per_window(s, "key", F.col("rank"), F.struct("rank"), "ts")), ("first", lambda s: first_within(s, ["key"], "ts"))):
        q = make(spark.readStream.schema(df.schema).parquet(src)).writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert {(r.key, r.row["rank"], r.n) for r in spark.table("best").collect()} == {("k", 1, 2), ("j", 5, 1)}
    assert sorted(r.key for r in spark.table("first").collect()) == ["j", "k", "z"]


def test_relations_and_owners(spark):
    b = raw_bronze(spark)
    got = [(r.source_id, r.relation, r.pos, r.raw_value) for r in normalize.relations_raw(b.items.where("id IS NOT NULL")).collect()]
    assert sorted(got) == [(1, "includes", 0, "b1"), (1, "includes", 1, "nothing")]
    owners = {r.code: (r.ico, r.failure) for r in normalize.publisher_icos(b.details, b.ci).collect()}
    assert owners["A"] == ("12345678", None) and owners["B"] == (None, "no owner")
