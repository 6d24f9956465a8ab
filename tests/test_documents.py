"""Documents as files: all or nothing, Turtle with prefixes of lists, JSON-LD that expands to the same triples; and the longest configured base."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusweave.operators import ontology, resolve, triples
from corpusweave.sources.documents import FOOT, HEAD, LINE, write_documents

TRIPLE = "graph string, s string, p string, o string, o_kind string, o_lang string, o_dtype string"


def found(path):
    return {f.name: f.read_text() for f in path.iterdir()}


def test_all_or_nothing(spark, tmp_path):
    path = tmp_path / "out"
    rows = spark.createDataFrame([("a", LINE, "2"), ("a", LINE, "1"), ("b/ü", LINE, "x"), ("a", HEAD, "["), ("a", FOOT, "]"), ("c", HEAD, "{}")], "name string, part int, text string").repartition(4)
    write_documents(rows, str(path), ".x", ",")
    want = {"a.x": "[1,2]", "b%2F%C3%BC.x": "x", "c.x": "{}"}
    assert found(path) == want
    (path / "other.y").write_text("stays")
    bad = rows.withColumn("text", F.when(F.col("name") == "c", F.raise_error(F.lit("no"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="no"):
        write_documents(bad, str(path), ".x", ",")
    assert found(path) == want | {"other.y": "stays"}
    scattered = rows.where("name = 'a'").repartition(3, "text").write.format("text_documents").mode("overwrite").options(path=str(path), ending=".x")
    with pytest.raises(Exception, match="one document"):
        scattered.save()
    assert found(path) == want | {"other.y": "stays"}
    write_documents(rows.where("name = 'a'"), f"file://{path}", ".x", "")
    assert found(path) == {"a.x": "[12]", "other.y": "stays"}
    write_documents(rows.limit(0), str(path), ".x")
    assert found(path) == {"other.y": "stays"}


def aliases_by_hand(lists, taken=()):
    used, out = set(taken), {}
    for other, preferred in lists:
        safe = "".join(c if c.isalnum() or c == "_" else "_" for c in other).strip("_").lower() or "items"
        alias, k = preferred, 2
        if alias in used:
            alias = f"{preferred}_{'ns_' + safe if safe[0].isdigit() else safe}"
        while alias in used:
            alias, k = f"{preferred}_{k}", k + 1
        out[other] = alias
        used.add(alias)
    return out


def test_prefix_aliases(spark):
    rng = random.Random(2)
    docs = {f"d{k}": [(f"{rng.choice('ABC')}{i if rng.random() < 0.7 else ''}", rng.choice(["a", "b", "a_2", "a_a3", "skos"])) for i in range(rng.randrange(1, 12))] for k in range(30)}
    docs = {d: [*dict(lists).items()] for d, lists in docs.items()}
    rows = [(d, other, preferred, k) for d, lists in docs.items() for k, (other, preferred) in enumerate(lists)]
    rng.shuffle(rows)
    got = {}
    for r in triples.prefix_aliases(spark.createDataFrame(rows, "code string, other string, preferred string, rank int"), ("skos",)).collect():
        got.setdefault(r.code, {})[r.other] = r.alias
    assert got == {d: aliases_by_hand(lists, ("skos",)) for d, lists in docs.items()}


def test_turtle_of_lists(spark, tmp_path):
    lists = spark.createDataFrame([("A", "x", "http://l/a/"), ("B", "x", "http://l/b/"), ("C", None, "http://l/c#")], "code string, item_prefix string, uri_pattern string")
    near = spark.createDataFrame([("A", ["B", "C"])], "code string, neighbours array<string>")
    prefixes = triples.list_prefixes(lists, near)
    assert {r.code: r.prefixes for r in prefixes.collect()} == {"A": {"http://l/a/": "x", "http://l/b/": "x_b"}, "B": {"http://l/b/": "x"}}
    broader = triples.iri("skos:broader")
    rows = [("A", f"http://l/a/{k}", broader, "http://l/b/1", "iri", None, None) for k in range(40)] + [("C", "http://l/c#1", broader, "http://l/c#2", "iri", None, None)]
    t = spark.createDataFrame(rows, TRIPLE.replace("graph", "code"))
    triples.write_turtle(t, str(tmp_path), prefixes, per_file=20)
    files = found(tmp_path)
    assert files.keys() == {"A.ttl", "A.1.ttl", "C.ttl"}
    assert all("@prefix x: <http://l/a/> .\n" in files[f] and "@prefix x_b: <http://l/b/> .\n" in files[f] and files[f].startswith("@prefix rdf: ") and files[f].endswith(" .\n") for f in ("A.ttl", "A.1.ttl"))
    lines = {x for f in ("A.ttl", "A.1.ttl") for x in files[f].splitlines() if not x.startswith("@")}
    assert lines == {f"x:{k} skos:broader x_b:1 ." for k in range(40)}
    assert "<http://l/c#1> skos:broader <http://l/c#2> ." in files["C.ttl"]
    triples.write_turtle(t.where("code = 'C'"), str(tmp_path))
    assert found(tmp_path).keys() == {"C.ttl"}  # a list that isn't published any more leaves no file


def expanded(doc):
    """Triples of a JSON-LD document whose context has a vocabulary, prefixes and terms."""
    terms = doc["@context"]

    def iri(name, vocab):
        if name.startswith("_:"):
            return name
        if vocab and name in terms:
            t = terms[name]
            return iri(t["@id"] if isinstance(t, dict) else t, True)
        prefix, colon, local = name.partition(":")
        if colon and not local.startswith("//") and isinstance(terms.get(prefix), str):
            return terms[prefix] + local
        return name if colon else terms["@vocab"] + name if vocab else name

    out = set()
    for node in doc["@graph"]:
        s = iri(node["@id"], False)
        for key, values in node.items():
            if key == "@id":
                continue
            for v in values if isinstance(values, list) else [values]:
                ref = lambda x: ("bnode" if x.startswith("_:") else "iri", None, None)
                if key == "@type":
                    o = iri(v, True)
                    out.add((s, triples.PREFIXES["rdf"] + "type", o, *ref(o)))
                    continue
                p, coerced = iri(key, True), isinstance(terms.get(key), dict)
                if isinstance(v, str) and coerced or isinstance(v, dict) and "@id" in v:
                    o = iri(v if isinstance(v, str) else v["@id"], False)
                    out.add((s, p, o, *ref(o)))
                elif isinstance(v, str):
                    out.add((s, p, v, "literal", None, None))
                else:
                    out.add((s, p, v["@value"], "literal", v.get("@language"), iri(v["@type"], True) if "@type" in v else None))
    return out


def test_jsonld_expands_to_the_same_triples(spark, tmp_path):
    rng = random.Random(3)
    own, p = "https://data.gov.sk/def/ontology/egov/", triples.PREFIXES
    iris = [own + x for x in ("Kind", "label", "a:b", "@x", "", "deep/er")] + [p["rdfs"] + "label", p["owl"] + "Class", p["dct"] + "source", "http://x/y", "urn:z", p["skos"], p["skos"] + "//x", "mailto:a", "https://data.gov.sk/def/ontology/kdp/xmlElementName", p["rdfs"] + "isDefinedBy"]
    predicates = [*iris, p["rdf"] + "type", p["skos"] + "note", p["rdfs"] + "description", "http://www.w3.org/ns/adms#identifier"]
    rows = set()
    for _ in range(600):
        s = rng.choice([*iris, "_:g-1", "_:g.2"])
        o = rng.choice([("iri", None, None), ("literal", None, None), ("literal", "sk", None), ("literal", None, p["xsd"] + "date"), ("literal", None, own + "Type"), ("bnode", None, None)])
        value = rng.choice(iris) if o[0] == "iri" else rng.choice(["_:g-1", "_:g.2"]) if o[0] == "bnode" else rng.choice(["", "x", 'q"\\\n', "http://x/y", "é"])
        rows.add(("egov", s, rng.choice(predicates), value, *o))
    ontology.write_jsonld(spark.createDataFrame(sorted(rows, key=repr), TRIPLE), str(tmp_path))
    text = (tmp_path / "egov.jsonld").read_text()
    assert expanded(json.loads(text)) == {r[1:] for r in rows}
    assert '"@type":"Kind"' in text or '"@type":["' in text


def test_longest_base_by_equi_join(spark):
    rng = random.Random(6)
    bases = {"http://" + "/".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) + rng.choice(["", "/"]): rng.choice(["p", {"includes": "q"}, {"includes": "r", "default": "s"}]) for _ in range(300)}
    bases |= {f"http://other/{k}/": "t" for k in range(10_000)}
    uris = ["http://" + "/".join(rng.choice("abcd") for _ in range(rng.randrange(1, 8))) for _ in range(300)] + ["http://other/77/x", "http://none", ""]
    edges = spark.createDataFrame([(k, rng.choice(["includes", "excludes"]), u) for k, u in enumerate(uris)], "source_id long, relation string, uri string")
    got = resolve.with_external_predicate(edges, bases)

    def want(uri, relation):
        best = max((b for b in bases if uri.startswith(b)), key=len, default=None)
        p = bases.get(best)
        return p.get(relation, p.get("default")) if isinstance(p, dict) else p

    rows = {r.source_id: r.predicate for r in got.collect()}
    assert rows == {r.source_id: want(r.uri, r.relation) for r in edges.collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert resolve.with_external_predicate(edges, {}).where("predicate IS NOT NULL").count() == 0
