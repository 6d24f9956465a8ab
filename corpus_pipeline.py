"""The corpus pipeline: toxic documents go, one document of each similar group stays, contaminated documents go,
personal data is redacted, and what is left is packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm import decontamination, ngram_join, packing, pii, toxicity
from corpusweave.llm.common import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model learned from their labels."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more, the one with the smallest id."""
    return ngram_join.keep_first(docs, ngram_join.Join(words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.drop_contaminated(docs, decontamination.matchers(table(spark, sf_dir, "benchmark")))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with placeholders for personal data."""
    out = pii.redact_rows(docs, pii.train(docs))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("packing", pack),
]

#: The tokeniser and the trained stages can't be written in SQL; each stage has a brute-force test.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written in the shared folder and read again, and deleted once the next one is there
    (the last one when the session ends)."""
    from uuid import uuid4

    from corpusweave.llm.common import checkpoint_dir

    place = f"{checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    path = lambda k: spark._jvm.org.apache.hadoop.fs.Path(f"{place}/{k}" if k is not None else place)
    files = path(None).getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(path(None))
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{place}/{k}")
            docs = spark.read.parquet(f"{place}/{k}")
            if k:
                files.delete(path(k - 1), True)
    return docs
