"""Labelled training rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(folds: int, doc_id: Column | None = None) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    return F.crc32(F.coalesce((F.col("doc_id") if doc_id is None else doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def training_sample(labels: DataFrame, label: str, rows: Column, most: int) -> DataFrame:
    """doc_id and y of about `most` labelled rows at most, those lowest by a hash of the id, so that the same rows always give
    the same sample. Rows without id or label are left out; of repeated rows the greatest label holds."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(rows & F.col("doc_id").isNotNull() & F.col("y").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1 << 20)) < int((1 << 20) * most / n))
    return known
