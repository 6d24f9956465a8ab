"""Ontology files (RDF/XML) to triples, the code-to-class map, and JSON-LD."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusweave.operators.triples import PREFIXES
from corpusweave.sources.rdfxml import Reader

# The ontologies, whose names are also their prefixes.
ONTOLOGIES = ["egov", "fin", "pper", "leg", "loca", "lsub"]
_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("graph", "s", "p", "o", "o_kind", "o_lang", "o_dtype")])


#: Triples that a task hands on at once.
_AT_ONCE = 10_000


def read_rdf_xml(spark: SparkSession, paths: list[str], base: str = "") -> DataFrame:
    """graph (file name without ending), s, p, o, o_kind, o_lang, o_dtype of RDF/XML files. A file is read by one task, node by node; what that holds besides the
    file's bytes is bounded by its largest top-level node."""
    files = spark.read.format("binaryFile").load(paths).select(F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1).alias("graph"), "content")

    def run(batches):
        from itertools import batched

        import pandas as pd

        for pdf in batches:
            for graph, content in zip(pdf["graph"], pdf["content"], strict=True):
                for some in batched(Reader(graph, base).read(bytes(content)), _AT_ONCE):
                    yield pd.DataFrame([(graph, *t) for t in some], columns=_SCHEMA.names, dtype=object)

    return files.mapInPandas(run, _SCHEMA).dropDuplicates()


def class_map(triples: DataFrame, marker: str = "CL") -> DataFrame:
    """code, item_type_uris, item_type_qnames, ontologies: the OWL classes whose dct:source ends in a code.

    That a subject is a class may be said in another part of its graph, so it is looked for in the whole graph.
    """
    classes = triples.where((F.col("p") == PREFIXES["rdf"] + "type") & (F.col("o") == PREFIXES["owl"] + "Class")).select("graph", "s")
    tail = F.element_at(F.split(F.regexp_replace("o", "/+$", ""), "/"), -1)
    hits = triples.where(F.col("p") == PREFIXES["dct"] + "source").join(classes, ["graph", "s"], "left_semi").select("graph", "s", tail.alias("code")).where(F.contains("code", F.lit(marker)))
    qname = F.concat("graph", F.lit(":"), F.element_at(F.split(F.regexp_replace("s", "/+$", ""), "/"), -1))
    ordered = lambda c, n: F.array_sort(F.collect_set(c)).alias(n)
    return hits.groupBy("code").agg(ordered(F.col("s"), "item_type_uris"), ordered(qname, "item_type_qnames"), ordered(F.col("graph"), "ontologies"))


def context(ontology: str) -> dict:
    """The JSON-LD context of an ontology."""
    # Names and terms of the context.
    return {
        "@vocab": f"https://data.gov.sk/def/ontology/{ontology}/",
        **{p: PREFIXES[p] for p in ("rdf", "rdfs", "owl", "dct", "skos")},
        "kdp": "https://data.gov.sk/def/ontology/kdp/",
        "adms": "http://www.w3.org/ns/adms#",
        "label": "rdfs:label",
        "description": "rdfs:description",
        "note": "skos:note",
        "isDefinedBy": {"@id": "rdfs:isDefinedBy", "@type": "@id"},
        "xmlElementName": "kdp:xmlElementName",
        "identifierKDP": {"@id": "adms:identifier", "@type": "@id"},
        "source": {"@id": "dct:source", "@type": "@id"},
    }


_COERCED = [t for t, v in context("").items() if isinstance(v, dict)]
_TERMS = {t: v["@id"] if isinstance(v, dict) else v for t, v in context("").items() if ":" in (v["@id"] if isinstance(v, dict) else v) and not (v if isinstance(v, str) else "").startswith("http")}
_NAMESPACES = {t: v for t, v in context("").items() if isinstance(v, str) and v.startswith("http") and not t.startswith("@")}


def _full(name: str) -> str:
    prefix, local = name.split(":", 1)
    return _NAMESPACES[prefix] + local


def _prefixed(c: Column) -> Column:
    """An IRI by the context's prefixes, else as it is; null if it can't be written in full either, as its scheme is a prefix."""
    names = [F.when(c.startswith(ns) & (F.length(c) > len(ns)) & ~F.substring(c, len(ns) + 1, 2).eqNullSafe("//"), F.concat(F.lit(f"{p}:"), F.substring(c, F.lit(len(ns) + 1), F.length(c)))) for p, ns in _NAMESPACES.items()]
    return F.coalesce(*names, c)


def _by_vocabulary(c: Column, graph: Column) -> Column:
    """An IRI of the ontology's own vocabulary as its local name, if that is no term and can't be taken for something else; else by prefix."""
    vocab = F.concat(F.lit(context("\0")["@vocab"].split("\0")[0]), graph, F.lit(context("\0")["@vocab"].split("\0")[1]))
    local = F.substring(c, F.length(vocab) + 1, F.length(c))
    plain = F.startswith(c, vocab) & (F.length(local) > 0) & ~F.contains(local, F.lit(":")) & ~F.startswith(local, F.lit("@")) & ~local.isin(*context(""))
    return F.when(plain, local).otherwise(_prefixed(c))


def jsonld_nodes(triples: DataFrame) -> DataFrame:
    """graph, s and the node object of each subject as JSON, compacted by the ontology's context.

    A predicate becomes the context's term for it (a term that stands for references only with references), a name of the ontology's own vocabulary, or a prefixed
    name; types become @type; values plain strings, references, language or type objects; one value stands without an array.
    """
    p, o, graph = F.col("p"), F.col("o"), F.col("graph")
    a_type = (p == PREFIXES["rdf"] + "type") & (F.col("o_kind") != "literal")
    term = F.coalesce(*(F.when((p == _full(name)) & ((F.col("o_kind") != "literal") if t in _COERCED else F.lit(True)), t) for t, name in _TERMS.items()))
    key = F.when(a_type, "@type").otherwise(F.coalesce(term, _by_vocabulary(p, graph)))
    text = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    reference = F.when(F.col("o_kind") == "iri", _prefixed(o)).otherwise(o)
    literal = (
        F.when(F.col("o_lang").isNotNull(), F.to_json(F.struct(F.col("o_lang").alias("@language"), o.alias("@value"))))
        .when(F.col("o_dtype").isNotNull() & (F.col("o_dtype") != PREFIXES["xsd"] + "string"), F.to_json(F.struct(_by_vocabulary(F.col("o_dtype"), graph).alias("@type"), o.alias("@value"))))
        .otherwise(text(o))
    )
    value = (
        F.when(F.col("o_kind") == "literal", literal).when(a_type, text(F.when(F.col("o_kind") == "iri", _by_vocabulary(o, graph)).otherwise(o)))
        .when(F.coalesce(term.isin(*_COERCED), F.lit(False)), text(reference)).otherwise(F.to_json(F.struct(reference.alias("@id"))))
    )
    per = triples.groupBy("graph", "s", key.alias("key")).agg(F.array_sort(F.collect_set(value)).alias("v"))
    values = F.when(F.size("v") == 1, F.col("v")[0]).otherwise(F.concat(F.lit("["), F.array_join("v", ","), F.lit("]")))
    body = F.array_join(F.array_sort(F.collect_list(F.concat(text(F.col("key")), F.lit(":"), values))), ",")
    subject = text(F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(_prefixed(F.col("s"))))
    return per.groupBy("graph", "s").agg(body.alias("body")).select("graph", "s", F.concat(F.lit('{"@id":'), subject, F.lit(","), "body", F.lit("}")).alias("node"))


def _head() -> Column:
    import json

    template, name = json.dumps(context("\0")), json.dumps("\0")[1:-1]
    return F.concat(F.lit('{"@context":'), F.replace(F.lit(template), F.lit(name), F.col("graph")), F.lit(',"@graph":['))


def write_jsonld(triples: DataFrame, path: str) -> None:
    """A document `<graph>.jsonld` for each graph: the ontology's context and all its node objects, node by node, so that a graph may be of any size."""
    from corpusweave.sources.documents import FOOT, HEAD, LINE, write_documents

    graphs = triples.select("graph").distinct()
    row = lambda df, part, text: df.select(F.col("graph").alias("name"), F.lit(part).alias("part"), text.alias("text"))
    rows = row(graphs, HEAD, _head()).union(row(jsonld_nodes(triples), LINE, F.col("node"))).union(row(graphs, FOOT, F.lit("]}")))
    write_documents(rows, path, ".jsonld", ",\n")


def no_triples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _SCHEMA)
