"""Balanced contiguous shards from global byte-size prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusweave.llm.common import cut_lineage, id_text, partitions, table


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cuts the rows, ordered by id, into `shards` runs of nearly equal bytes.

    A row's size is the UTF-8 bytes of its text plus 1. Each range partition's total is summed first; the totals'
    prefix sums (one row a partition) give every partition its global offset, and running sums inside a partition do
    the rest, so no task sees more than its own partition. A row goes to the shard in whose target interval its middle byte
    falls: shard sizes differ from the target by at most half of the longest row at either end.

    Null text: empty, size 1. Null id: first. Repeated rows: each keeps a place of its own (ties are dealt by text
    checksum, then input place). Empty input: no rows. Fewer rows than shards: some shards stay empty.
    Returns doc_id, size, text_crc32, shard, slot; slots of a shard are gapless from 0 in id order.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = id_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    # The range bounds come from a sample; the checkpoint fixes which row got which partition, whatever is run again.
    ranged = cut_lineage(
        sized.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(partitions(docs.sparkSession), "doc_id", "text_crc32", "tie")
        .withColumn("part", F.spark_partition_id())
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy("part")
        .agg(F.sum("size").alias("part_size"), F.count(F.lit(1)).alias("part_rows"))
        .select(
            "part",
            F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("size_before"),
            F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("part_size").over(Window.partitionBy()).alias("all_size"),
        )
    )
    inside = Window.partitionBy("part").orderBy("doc_id", "text_crc32", "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.withColumn("upto", F.sum("size").over(inside))
        .withColumn("row", F.row_number().over(Window.partitionBy("part").orderBy("doc_id", "text_crc32", "tie")))
        .join(F.broadcast(totals), "part")  # one row a partition
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("rows_before") + F.col("row") - 1).alias("at"),
            F.expr(f"least({shards - 1}, ((size_before + upto) * 2 - size) * {shards} div (2 * all_size))").cast("int").alias("shard"),
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first_at"))
    return placed.join(F.broadcast(firsts), "shard").select(  # one row a shard
        "doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first_at")).alias("slot")
    )


def op10_byte_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 shards of documents under the law `bytes`."""
    return shard_by_bytes(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


#: CRC-32 byte by byte, as DuckDB has none: `tab` holds the remainders of the 256 bytes.
ORACLE_SQL = """
WITH r AS (SELECT list_transform(range(256), lambda i: list_reduce(range(1, 9), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS tab),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
      xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)::BIGINT AS text_crc32
      FROM documents, r),
o AS (SELECT *, row_number() OVER w - 1 AS place, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS whole FROM d WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32)),
s AS (SELECT *, least(15, ((upto * 2 - size) * 16) // (2 * whole))::INTEGER AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM s
"""
