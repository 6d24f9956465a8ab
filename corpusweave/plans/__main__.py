"""python -m corpusweave.plans: a registry run over raw documents in folders, fetched before if asked for."""

from __future__ import annotations

import argparse


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--data-root", required=True, help="folder with headers, details, items, ci (JSON), ontology (RDF/XML) and, if there, pages and integration (JSON lines)")
    p.add_argument("--out", required=True)
    p.add_argument("--config")
    p.add_argument("--mode", choices=["configured", "global"], default="configured")
    p.add_argument("--pick-top-hierarchy-match", action="store_true")
    p.add_argument("--strict-uri-audit", action="store_true")
    p.add_argument("--fetch", metavar="ROOT", help="address of the registry: all documents are asked for there instead of read (but for ontologies)")
    p.add_argument("--store", help="shared folder of raw answers (default: answers under the data root)")
    p.add_argument("--timeout", type=float, default=60)
    p.add_argument("--tries", type=int, default=3)
    p.add_argument("--requests-at-once", type=int, default=8, help="to one host")
    p.add_argument("--per-page", type=int, default=10_000)
    p.add_argument("--cache-max-age-seconds", type=int, default=86_400, help="fetched documents are asked for again when older than this")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from corpusweave.operators import ontology
    from corpusweave.plans.ingest import ingest
    from corpusweave.plans.registry import Bronze, Options, run, write
    from corpusweave.sources import bronze, config, live

    o = options(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    root = o.data_root
    optional = lambda name, schema: spark.read.schema(schema).json(f"{root}/{name}") if bronze.exists(spark, f"{root}/{name}") else None
    if bronze.exists(spark, f"{root}/ontology"):
        triples = ontology.read_rdf_xml(spark, [f"{root}/ontology"])
    else:
        print(f"warning: no ontologies in {root}/ontology; items get no further types")
        triples = ontology.no_triples(spark)
    classes = ontology.class_map(triples)
    if o.fetch:
        how = live.Asking(timeout=o.timeout, tries=o.tries, per_host=o.requests_at_once)
        read = ingest(spark, o.fetch, o.store or f"{root}/answers", classes, o.cache_max_age_seconds, how, o.per_page)
    else:
        headers = bronze.read_headers(spark, f"{root}/headers")
        details = spark.read.schema(bronze.DETAIL).option("multiLine", True).json(f"{root}/details").where(F.col("code").isNotNull())
        pages, integration = optional("pages", "url string, status int, body string"), optional("integration", "code string, url string, status int, reason string, body string")
        read = Bronze(headers, details, bronze.read_items(spark, f"{root}/items"), bronze.read_ci(spark, f"{root}/ci"), classes, pages, integration)
    tables = run(read, config.load(o.config), Options(o.mode, o.strict_uri_audit, o.pick_top_hierarchy_match))
    write(tables, o.out)
    ontology.write_jsonld(triples, f"{o.out}/jsonld")
    classes.write.mode("overwrite").json(f"{o.out}/ontology_map")


if __name__ == "__main__":
    main()
