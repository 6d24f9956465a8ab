"""Triples of the published graph, as rows, and their serialisations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.text import safe_prefix, ttl_escape

# Namespaces of the published graph.
PREFIXES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "owl": "http://www.w3.org/2002/07/owl#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "dct": "http://purl.org/dc/terms/",
    "dcat": "http://www.w3.org/ns/dcat#",
    "prov": "http://www.w3.org/ns/prov#",
    "egov": "https://data.gov.sk/def/ontology/egov/",
    "pper": "https://data.gov.sk/def/ontology/physical-person/",
    "leg": "https://data.gov.sk/def/ontology/legislation/",
    "fin": "https://data.gov.sk/def/ontology/finance/",
    "lsub": "https://data.gov.sk/def/ontology/legal-subject/",
    "loca": "https://data.gov.sk/def/ontology/location/",
}
# Resources that every code list refers to.
CODE_LIST = "http://publications.europa.eu/resource/authority/dataset-type/CODE_LIST"
THEME = "http://publications.europa.eu/resource/authority/data-theme/GOVE"
SOURCE_SYSTEM = "https://data.gov.sk/id/egov/isvs/63"
PUBLISHERS = "https://data.gov.sk/id/legal-subject/"

COLUMNS = ["s", "p", "o", "o_kind", "o_lang", "o_dtype"]


def iri(qname: str) -> str:
    """The IRI of a prefixed name; a full IRI stays; blank means dct:relation."""
    name = (qname or "").strip() or "dct:relation"
    if name.startswith(("http://", "https://")):
        return name
    prefix, _, local = name.partition(":")
    if prefix not in PREFIXES or not local:
        raise ValueError(f"Unknown predicate prefix: {qname}")
    return PREFIXES[prefix] + local


def _o(p: str | Column, o: Column, kind: str, lang: str | None = None, dtype: str | None = None, s: Column | None = None) -> Column:
    """One predicate and object, dropped later if the object is null."""
    return F.struct(
        (s if s is not None else F.col("s")).alias("s"), (F.lit(iri(p)) if isinstance(p, str) else p).alias("p"), o.cast("string").alias("o"),
        F.lit(kind).alias("o_kind"), F.lit(lang).cast("string").alias("o_lang"), F.lit(iri(dtype) if dtype else None).cast("string").alias("o_dtype"),
    )


def ref(p, o: Column, s: Column | None = None) -> Column:
    return _o(p, o, "iri", s=s)


def text(p, o: Column, lang: str | None = None, dtype: str | None = None, s: Column | None = None) -> Column:
    return _o(p, F.nullif(o.cast("string"), F.lit("")), "literal", lang, dtype, s)


def constant(p, o: str, s: Column | None = None) -> Column:
    return ref(p, F.lit(iri(o)), s)


def unpivot(df: DataFrame, triples: list[Column], key: str = "code") -> DataFrame:
    return df.select(key, F.explode(F.array(*triples)).alias("t")).select(key, "t.*").where("s IS NOT NULL AND p IS NOT NULL AND o IS NOT NULL")


def _validity(s: Column, start: Column, end: Column) -> list[Column]:
    """A period of time as a blank node, named by its subject so that it is the same in every run."""
    node = F.concat(F.lit("_:"), F.sha2(F.concat(s, F.lit("|timeValidity")), 256))
    some = start.isNotNull() | end.isNotNull()
    at = lambda c: F.when(some, c)
    return [
        _o("egov:timeValidity", at(node), "bnode", s=s), ref("rdf:type", at(F.lit(iri("dct:PeriodOfTime"))), node),
        text("dcat:startDate", start, dtype="xsd:date", s=node), text("dcat:endDate", end, dtype="xsd:date", s=node),
    ]


def _texts(s: Column, title: str) -> list[Column]:
    return [text(p, F.col(f"{name}_{t}"), t, s=s) for name, p in (("name", title), ("label", "rdfs:label"), ("note", "skos:note")) for t in ("sk", "en")]


def codelist_triples(codelists: DataFrame) -> DataFrame:
    root, version = F.col("uri"), F.concat("uri", F.lit("/"), F.col("valid_from").cast("string"))
    both = lambda s: [constant("rdf:type", "dcat:Dataset", s), constant("rdf:type", "skos:ConceptScheme", s)]
    out = [
        *both(root), ref("dct:type", F.lit(CODE_LIST), root), ref("dcat:theme", F.lit(THEME), root), ref("dcat:hasVersion", version, root), ref("dcat:hasCurrentVersion", version, root),
        text("egov:uriPattern", F.concat("uri_pattern", F.lit("*")), s=root), *_texts(root, "dct:title"),
        *both(version), ref("dcat:isVersionOf", root, version), ref("prov:wasDerivedFrom", F.lit(SOURCE_SYSTEM), version), text("dcat:version", F.col("valid_from"), dtype="xsd:string", s=version),
        ref("dcat:distribution", F.concat(version, F.lit(".rdf")), version), text("dct:issued", F.col("valid_from"), dtype="xsd:date", s=version), text("dct:modified", F.col("last_modified"), dtype="xsd:date", s=version),
        ref("dct:publisher", F.concat(F.lit(PUBLISHERS), "publisher_ico"), version), *_texts(version, "dct:title"), *_validity(version, F.col("effective_from"), F.col("effective_to")),
    ]
    sources = codelists.select("code", F.col("uri").alias("s"), F.explode("source_values").alias("v"))
    return unpivot(codelists, out).unionByName(unpivot(sources, [text("dct:source", F.col("v"))]))


def item_triples(items: DataFrame, codelists: DataFrame) -> DataFrame:
    lists = codelists.select("code", F.col("uri").alias("root"), F.concat("uri", F.lit("/"), F.col("valid_from").cast("string")).alias("version"))
    rows = items.withColumnRenamed("codelist_code", "code").join(lists, "code").withColumn("s", F.col("item_uri"))
    s = F.col("s")
    out = [
        constant("rdf:type", "skos:Concept"), text("skos:notation", F.col("item_code")), ref("skos:topConceptOf", F.col("root")), ref("skos:inScheme", F.col("version")), *_texts(s, "skos:prefLabel"),
        text("dct:issued", F.coalesce("valid_from", "effective_from"), dtype="xsd:date"), *_validity(s, F.col("effective_from"), F.col("effective_to")),
        text("egov:logicalOrder", F.col("logical_order"), dtype="xsd:integer"), text("leg:legallyRecognized", F.col("legislative_validity"), dtype="xsd:boolean"),
    ]
    types = rows.select("code", "s", F.explode("item_type_uris").alias("v"))
    return unpivot(rows, out).unionByName(unpivot(types, [ref("rdf:type", F.col("v"))]))


def edge_triples(edges: DataFrame, external: DataFrame, items: DataFrame, relations: dict[str, dict[str, str]]) -> DataFrame:
    """Forward and inverse triples of edges whose ends are both there, and external ones (by their own predicate, else the forward one)."""
    end = lambda to: items.select(F.col("id").alias(f"{to}_id"), F.col("codelist_code").alias(f"{to}_code"), F.col("item_uri").alias(f"{to}_uri"))
    pick = lambda key: F.coalesce(*(F.when(F.col("relation") == r, F.lit(iri(p[key]))) for r, p in relations.items() if p.get(key)), F.lit(None).cast("string"))
    ends = edges.join(end("source"), "source_id").join(end("target"), "target_id")
    forward = unpivot(ends, [ref(pick("predicate"), F.col("target_uri"), F.col("source_uri"))], "source_code").withColumnRenamed("source_code", "code")
    inverse = unpivot(ends, [ref(pick("inversePredicate"), F.col("source_uri"), F.col("target_uri"))], "target_code").withColumnRenamed("target_code", "code")
    out = forward.unionByName(inverse)
    if external is not None:
        own = external.join(end("source"), "source_id").withColumn("q", predicate_iri("predicate"))
        out = out.unionByName(unpivot(own, [ref(F.coalesce("q", pick("predicate")), F.col("uri"), F.col("source_uri"))], "source_code").withColumnRenamed("source_code", "code"))
    return out


def predicate_iri(c: str) -> Column:
    """A column of prefixed names as IRIs; full IRIs stay; unknown prefixes are null."""
    prefix, local = F.regexp_extract(c, "^([^:]*):(.*)$", 1), F.regexp_extract(c, "^([^:]*):(.*)$", 2)
    known = F.create_map(*(F.lit(x) for kv in PREFIXES.items() for x in kv))
    return F.when(F.col(c).rlike("^https?://"), F.col(c)).otherwise(F.concat(F.try_element_at(known, prefix), local))


def graph(codelists: DataFrame, items: DataFrame, edges: DataFrame, external: DataFrame | None, relations: dict[str, dict[str, str]]) -> tuple[DataFrame, DataFrame]:
    """The distinct triples of each code list, and the lists that fail: one with an item that has no date at all isn't published."""
    failed = items.where(F.coalesce("valid_from", "effective_from").isNull()).select(F.col("codelist_code").alias("code")).distinct()
    all_triples = codelist_triples(codelists).unionByName(item_triples(items, codelists)).unionByName(edge_triples(edges, external, items, relations))
    errors = failed.select("code", F.lit("error").alias("level"), F.lit("Missing or invalid date for item").alias("message"))
    return all_triples.join(failed, "code", "left_anti").dropDuplicates(["code", *COLUMNS]), errors


def _term(kind: str, value: str) -> Column:
    literal = F.concat(F.lit('"'), ttl_escape(value), F.lit('"'), F.coalesce(F.concat(F.lit("@"), "o_lang"), F.concat(F.lit("^^<"), "o_dtype", F.lit(">")), F.lit("")))
    return F.when(F.col(kind) == "iri", F.concat(F.lit("<"), value, F.lit(">"))).when(F.col(kind) == "bnode", F.col(value)).otherwise(literal)


def _subject() -> Column:
    return F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(F.concat(F.lit("<"), "s", F.lit(">")))


def ntriples(triples: DataFrame) -> DataFrame:
    return triples.select(*(c for c in triples.columns if c == "code"), F.concat(_subject(), F.lit(" <"), "p", F.lit("> "), _term("o_kind", "o"), F.lit(" .")).alias("line"))


def short(c: str, own: Column | None = None) -> Column:
    """An IRI as a prefixed name, if it is in one of the namespaces and the rest is plain; else in angle brackets. own: a map of more namespaces that end in
    a slash to prefixes, by which names go first."""
    local = lambda ns: F.substring(c, F.lit(len(ns) + 1), F.length(c))
    names = [F.when(F.col(c).startswith(ns) & local(ns).rlike("^[A-Za-z][A-Za-z0-9_-]*$"), F.concat(F.lit(f"{p}:"), local(ns))) for p, ns in PREFIXES.items()]
    if own is not None:
        tail = F.regexp_extract(c, "[^/]*$", 0)
        base = F.substring(c, F.lit(1), F.length(c) - F.length(tail))
        names.insert(0, F.when(tail.rlike("^[A-Za-z0-9_](?:[A-Za-z0-9_-]*)$"), F.concat(F.try_element_at(own, base), F.lit(":"), tail)))
    return F.coalesce(*names, F.concat(F.lit("<"), c, F.lit(">")))


def turtle_blocks(triples: DataFrame, keys: list[str] | None = None, prefixed: bool = False, own: str | None = None) -> DataFrame:
    """A Turtle block for each subject: predicates and objects in order. One subject's triples are gathered, not a graph's. prefixed: names of
    the known namespaces, and of those in the map column `own`, are prefixed, which asks for their lines above."""
    extra = F.col(own) if own else None
    object_ = F.when(F.col("o_kind") == "iri", short("o", extra)).otherwise(_term("o_kind", "o")) if prefixed else _term("o_kind", "o")
    po = F.concat(short("p") if prefixed else F.concat(F.lit("<"), "p", F.lit(">")), F.lit(" "), object_)
    subject = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(short("s", extra)) if prefixed and own else _subject()
    keys = keys if keys is not None else [c for c in triples.columns if c == "code"]
    return triples.groupBy(*keys, subject.alias("subject")).agg(F.array_join(F.array_sort(F.collect_list(po)), " ;\n    ").alias("body")).select(*keys, "subject", F.concat("subject", F.lit(" "), "body", F.lit(" .")).alias("block"))


def prefix_lines() -> str:
    return "\n".join(f"@prefix {p}: <{ns}> ." for p, ns in PREFIXES.items())


def prefix_aliases(wanted: DataFrame, taken: tuple[str, ...] = ()) -> DataFrame:
    """code, other, alias: a prefix for each list that a document names, free of those that came before in the same document.

    wanted: code (the document), other, preferred (a safe name), rank (order within the document, without ties). A list gets its preferred name; if that is
    taken, the preferred name and its own code; if that is taken too, the preferred name and the first free number from 2. A document's lists are few beside
    its triples, so they are folded in one row.
    """
    fallback = lambda x: F.concat(x["preferred"], F.lit("_"), safe_prefix(x["other"]))
    numbered = lambda x, used: F.filter(F.transform(F.sequence(F.lit(2), F.size(used) + 3), lambda i: F.concat(x["preferred"], F.lit("_"), i.cast("string"))), lambda a: ~F.array_contains(used, a))[0]

    def step(acc: Column, x: Column) -> Column:
        used = acc["used"]
        alias = F.when(~F.array_contains(used, x["preferred"]), x["preferred"]).when(~F.array_contains(used, fallback(x)), fallback(x)).otherwise(numbered(x, used))
        return F.struct(F.array_append(used, alias).alias("used"), F.array_append(acc["out"], F.struct(x["other"].alias("other"), alias.alias("alias"))).alias("out"))

    start = F.struct(F.array(*map(F.lit, taken)).cast("array<string>").alias("used"), F.array().cast("array<struct<other:string,alias:string>>").alias("out"))
    lists = F.sort_array(F.collect_list(F.struct("rank", F.col("other").cast("string").alias("other"), F.col("preferred").cast("string").alias("preferred"))))
    folded = wanted.groupBy("code").agg(lists.alias("lists")).select("code", F.aggregate("lists", start, step)["out"].alias("out"))
    return folded.select("code", F.explode("out").alias("x")).select("code", "x.other", "x.alias")


def list_prefixes(codelists: DataFrame, near: DataFrame) -> DataFrame:
    """code, prefixes: of each list's document the item namespaces of the list itself and then of the lists that its edges lead to or come from, in order of their
    codes, as a map to prefixes. codelists: code, item_prefix, uri_pattern; near: code, neighbours."""
    others = near.select("code", F.explode("neighbours").alias("other")).where("code <> other").select("code", "other", F.lit(1).alias("later"))
    both = codelists.select("code", F.col("code").alias("other"), F.lit(0).alias("later")).unionByName(others)
    named = codelists.select(F.col("code").alias("other"), safe_prefix(F.coalesce(F.nullif("item_prefix", F.lit("")), "code")).alias("preferred"), "uri_pattern")
    wanted = both.join(named, "other").select("code", "other", "preferred", "uri_pattern", F.struct("later", "other").alias("rank"))
    aliases = prefix_aliases(wanted, (*PREFIXES, "codelist")).join(named.select("other", "uri_pattern"), "other")
    by_namespace = aliases.where("uri_pattern LIKE '%/'").groupBy("code", "uri_pattern").agg(F.min("alias").alias("alias"))  # lists may share a namespace
    return by_namespace.groupBy("code").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("uri_pattern", "alias")))).alias("prefixes"))


def write_turtle(triples: DataFrame, path: str, prefixes: DataFrame | None = None, per_file: int = 500_000) -> None:
    """A Turtle file `<code>.ttl` for each list that has triples, with its prefixes; a large list has one more, `<code>.1.ttl` and so on, for every `per_file`
    triples, about. All are put in place at once when the whole write has succeeded; files of lists that have no triples any more go.

    prefixes: code and a map of further namespaces to prefixes (see `list_prefixes`).
    """
    from corpusweave.sources.documents import FOOT, HEAD, LINE, write_documents

    none = F.create_map().cast("map<string,string>")
    own = prefixes.select("code", "prefixes") if prefixes is not None else triples.select("code").distinct().withColumn("prefixes", none)
    files = triples.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / per_file).cast("int").alias("files")).join(own, "code", "left").withColumn("prefixes", F.coalesce("prefixes", none))
    name = F.when(F.col("file") == 0, F.col("code")).otherwise(F.concat("code", F.lit("."), F.col("file").cast("string"))).alias("name")
    blocks = turtle_blocks(triples.join(files, "code").withColumn("file", F.pmod(F.xxhash64("s"), F.col("files")).cast("int")), ["code", "file"], True, "prefixes")
    lines = F.array_join(F.transform(F.map_entries("prefixes"), lambda e: F.concat(F.lit("@prefix "), e["value"], F.lit(": <"), e["key"], F.lit("> .\n"))), "")
    heads = files.select("code", F.explode(F.sequence(F.lit(0), F.col("files") - 1)).alias("file"), F.concat(F.lit(prefix_lines() + "\n"), lines).alias("text"))
    row = lambda df, part, text: df.select(name, F.lit(part).alias("part"), text)
    rows = row(heads, HEAD, F.col("text")).union(row(blocks, LINE, F.col("block").alias("text"))).union(row(heads, FOOT, F.lit("\n").alias("text")))
    write_documents(rows, path, ".ttl")


def neighbours(edges: DataFrame, items: DataFrame) -> DataFrame:
    """code and the other lists that its edges lead to or come from."""
    end = lambda to: items.select(F.col("id").alias(f"{to}_id"), F.col("codelist_code").alias(f"{to}_code"))
    pairs = edges.join(end("source"), "source_id").join(end("target"), "target_id").where("source_code <> target_code")
    both = pairs.select(F.col("source_code").alias("code"), F.col("target_code").alias("other")).union(pairs.select("target_code", "source_code"))
    return both.groupBy("code").agg(F.array_sort(F.collect_set("other")).alias("neighbours"))
