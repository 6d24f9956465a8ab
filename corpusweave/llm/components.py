"""Connected components of a graph that no single machine holds: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.llm.common import cut_lineage


#: So many edges are few enough for one task, which needs no shuffle; more are dealt over the cluster.
FEW_EDGES = 100_000


def _checksum(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftrightunsigned(h, 24)), F.bit_xor(h)).first())


def _ends(first: str, second: str, edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """A row of each of the pairs for every edge; unlike a union, it leaves one partition one."""
    return edges.select(F.explode(F.array(*(F.struct(F.col(a).alias(first), F.col(b).alias(second)) for a, b in pairs))).alias("e")).select("e.*")


def components(edges: DataFrame, u: str = "u", v: str = "v", few: int = FEW_EDGES) -> DataFrame:
    """node, component: the least node that each node of an edge can reach. Nodes are of any ordered type, structs included.

    Each step replaces a node's edges by edges to its least neighbour, so that all edges point to the roots in the end; the number
    of rows never grows. A hub's rows are met by a join that adaptive execution splits, and its minimum is taken map-side.
    Up to `few` edges, which are counted, the steps run as one task each. Self-loops and null ends are left out; no edges: no rows.
    """
    e = edges.select(F.greatest(u, v).alias("u") if _atomic(edges, u) else _pick(u, v, ">=").alias("u"), F.least(u, v).alias("v") if _atomic(edges, u) else _pick(u, v, "<").alias("v"))
    e = cut_lineage(e.where(F.col("u") != F.col("v")).distinct())
    before = None
    while (now := _checksum(e)) != before:
        before = now
        if now[0] <= few:
            e = e.coalesce(1)
        # Large star: every neighbour greater than a node gets the least of that node's neighbours and itself.
        both = _ends("u", "v", e, ("u", "v"), ("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.when(F.col("m") < F.col("u"), F.col("m")).otherwise(F.col("u")).alias("m"))
        e = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its lesser neighbours get the least of those.
        moved = e.join(e.groupBy("u").agg(F.min("v").alias("m")), "u")
        e = cut_lineage(moved.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")).distinct())
    return _ends("node", "component", e.coalesce(1) if now[0] <= few else e, ("u", "v"), ("v", "v")).distinct()


def _atomic(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() != "struct"


def _pick(u: str, v: str, how: str):
    first = F.col(u) >= F.col(v) if how == ">=" else F.col(u) < F.col(v)
    return F.when(first, F.col(u)).otherwise(F.col(v))
