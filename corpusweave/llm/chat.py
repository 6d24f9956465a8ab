"""Chat formatting: conversations that were logged again and again while they grew collapse to the longest, which is rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusweave.llm.common import cut_lineage, partitions, table

_SUMS = ("h0", "h1", "h2")


def _running(df: DataFrame, values: list[str]) -> DataFrame:
    """Running sums of the values within each conversation: inside a partition first, then the partitions' totals before it, so that a
    conversation of any length is dealt over as many tasks as its rows fill."""
    inside = Window.partitionBy("part", "conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("part", "conv").agg(*(F.sum(v).alias(v) for v in values))
    offsets = totals.select("part", "conv", *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"before_{v}") for v in values))
    out = df.withColumns({f"upto_{v}": F.sum(v).over(inside) for v in values}).join(offsets, ["part", "conv"])
    return out.select(*df.columns, *((F.col(f"upto_{v}") + F.col(f"before_{v}")).alias(f"sum_{v}") for v in values))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, conv, position (from 1), turn, role, text, and the rolling hash (three sums of 40 bits) of the turns up to there.

    Each turn adds a hash of its place, role and text; equal prefixes have equal sums, others don't (120 bits).
    """
    clean = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.concat(F.lit("i"), F.col("conv_id").cast("string")), F.lit("none")).alias("conv"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    placed = cut_lineage(clean.repartitionByRange(partitions(turns.sparkSession), "conv", "turn", "role", "text").withColumn("part", F.spark_partition_id()).withColumn("one", F.lit(1)))
    placed = _running(placed, ["one"]).withColumnRenamed("sum_one", "position").drop("one")
    hashed = placed.withColumns({h: F.xxhash64(F.lit(h), "position", "role", "text").bitwiseAND((1 << 40) - 1) for h in _SUMS})
    return _running(hashed, list(_SUMS)).select("conv_id", "conv", "position", "turn", "role", "text", *(f"sum_{h}" for h in _SUMS))


def collapse(turns: DataFrame) -> DataFrame:
    """The turns, with positions, of conversations that are no beginning of a longer one; of equal ones the smallest id's.

    Turns are ordered by turn, then role and text; repeated rows count once. Null role or text: empty. Null turn: first. Null ids: one
    conversation of its own. Empty input: no rows. Prefixes and whole conversations are made distinct before they meet, so a
    first turn that a third of all conversations share is one row in the anti-join.
    """
    key = ["position", *(f"sum_{h}" for h in _SUMS)]
    hashed = cut_lineage(prefix_hashes(turns))
    lengths = hashed.groupBy("conv").agg(F.max("position").alias("n"))
    sized = hashed.select("conv_id", "conv", *key).join(lengths, "conv")
    whole = sized.where("position = n").groupBy(*key).agg(F.min(F.struct(F.col("conv_id").isNull().alias("null"), "conv_id", "conv")).alias("first"))
    prefixes = sized.where("position < n").select(*key).distinct()
    kept = whole.join(prefixes, key, "left_anti").select("first.conv")
    return hashed.join(kept, "conv", "left_semi").select("conv_id", "position", "role", "text")


def render(turns: DataFrame) -> DataFrame:
    """Each turn in the chat template; a conversation is its turns' texts in order of position."""
    said = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    return turns.select("conv_id", "position", "role", said.alias("rendered"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered turns of all maximal conversations."""
    return render(collapse(table(spark, sf_dir, "conversations"))).select("conv_id", F.col("position").cast("long").alias("position"), "role", F.md5("rendered").alias("md5"), F.length("rendered").cast("long").alias("n_chars"))


ORACLE_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS position FROM t),
c AS (SELECT conv_id, string_agg(role || chr(1) || text, chr(2) ORDER BY position) || chr(2) AS whole, count(*) AS n FROM p GROUP BY conv_id),
k AS (SELECT min(conv_id) AS conv_id FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS d WHERE d.n > c.n AND starts_with(d.whole, c.whole)) GROUP BY whole)
SELECT conv_id, position, role, md5(r) AS md5, length(r) AS n_chars FROM (SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS r FROM p) WHERE conv_id IN (SELECT conv_id FROM k)
"""
