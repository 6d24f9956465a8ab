"""Graphs as tables of edges or triples: what is reached from where, cycles, and comparison whatever blank nodes are called.

Settled tables keep the size that was guessed from the files they come from, and what a small file says may be many times as large. So joins with them say that
both sides are sorted; by that guess, all nodes would be broadcast and held by every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of each sum of hashes, so that sums of very many stay within a long.
_BITS = (1 << 40) - 1
#: Triples of a partition in which they are made distinct.
_ROWS = 150_000


def closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """node, ancestor, depth: all that is reached upwards from each node, with the fewest steps. A node on a cycle reaches itself.

    Paths are doubled: with all pairs of up to n steps known, those of exactly n steps, followed by a known one, give all of up to twice as many, so the number of
    rounds is the logarithm of the longest way. A way has one place n steps from its start, so in a tree each pair is found once, and only pairs that weren't known are
    settled in the shared folder. Rows with a null end are no edges; repeated edges count once; an edge from a node to itself is a cycle of one.
    """
    from corpusweave.plans.registry import settled

    known = found = settled(edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).cast("long").alias("depth")).where("node IS NOT NULL AND ancestor IS NOT NULL").distinct())
    steps = 1
    while True:
        furthest = found.where(F.col("depth") == steps)
        if furthest.isEmpty():  # every way of more steps has a place this far from its start
            return known
        upper = known.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("above"), F.col("depth").alias("more"))
        longer = furthest.join(upper.hint("merge"), "ancestor").select("node", F.col("above").alias("ancestor"), (F.lit(steps).cast("long") + F.col("more")).alias("depth"))
        found = settled(longer.groupBy("node", "ancestor").agg(F.min("depth").alias("depth")).join(known.select("node", "ancestor").hint("merge"), ["node", "ancestor"], "left_anti"))
        known, steps = known.union(found), 2 * steps


def cycles(reached: DataFrame) -> DataFrame:
    """node, cycle, length: the nodes that reach themselves, the least node of those that they reach and that reach them, and the fewest steps around.
    reached: as `closure` gives it."""
    on = reached.where("node = ancestor").select("node", F.col("depth").alias("length"))
    back = reached.select(F.col("ancestor").alias("node"), F.col("node").alias("ancestor"))
    mutual = reached.select("node", "ancestor").join(back, ["node", "ancestor"], "left_semi").groupBy("node").agg(F.min("ancestor").alias("cycle"))
    return on.join(mutual, "node").select("node", "cycle", "length")


def _sum(h: Column) -> list[Column]:
    """Two order-free sums of a 64-bit hash."""
    return [F.sum(h.bitwiseAND(_BITS)), F.sum(F.shiftrightunsigned(h, 24))]


def _distinct(triples: DataFrame, graph: str) -> DataFrame:
    """Each triple of a graph once, settled. Rows are dealt by all that they hold into as many partitions as their number asks for, so that what a task keeps of
    them doesn't grow with the input."""
    from corpusweave.plans.registry import settled

    t = triples.select(F.col(graph).alias("graph"), "s", "p", "o", "o_kind", "o_lang", "o_dtype")
    return settled(t.repartition(t.count() // _ROWS + 1, *t.columns).distinct())


def _colours(t: DataFrame) -> DataFrame:
    """The colours of distinct triples' blank nodes."""
    from corpusweave.plans.registry import settled

    blank = lambda c: F.startswith(F.col(c), F.lit("_:"))
    fixed = F.xxhash64(F.lit("o"), "o", "o_kind", F.coalesce("o_lang", F.lit("")), F.coalesce("o_dtype", F.lit("")))
    out = t.where(blank("s")).select("graph", F.col("s").alias("node"), F.xxhash64(F.lit("out"), "p").alias("by"), F.when(F.col("o_kind") == "bnode", F.col("o")).alias("other"), F.when(F.col("o_kind") != "bnode", fixed).alias("end"))
    into = t.where(F.col("o_kind") == "bnode").select("graph", F.col("o").alias("node"), F.xxhash64(F.lit("in"), "p").alias("by"), F.when(blank("s"), F.col("s")).alias("other"), F.when(~blank("s"), F.xxhash64(F.lit("s"), "s")).alias("end"))
    ends = out.unionByName(into)
    a, b = _sum(F.when(F.col("other").isNull(), F.xxhash64("by", "end")))
    now = settled(ends.groupBy("graph", "node").agg(F.coalesce(a, F.lit(0)).alias("a"), F.coalesce(b, F.lit(0)).alias("b")).withColumn("colour", F.lit(0).cast("long")))
    links = settled(ends.where("other IS NOT NULL").select("graph", "node", "by", "other"))
    kinds = 0
    while True:
        far = now.select("graph", F.col("node").alias("other"), F.col("colour").alias("far"))
        a, b = _sum(F.xxhash64("by", "far"))
        seen = links.join(far.hint("merge"), ["graph", "other"]).groupBy("graph", "node").agg(a.alias("more_a"), b.alias("more_b"))
        all_of = lambda c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0))
        new = settled(now.join(seen.hint("merge"), ["graph", "node"], "left").select("graph", "node", "a", "b", F.xxhash64("colour", all_of("a"), all_of("b")).alias("colour")))
        told_apart = new.select("graph", "colour").distinct().count()
        if told_apart == kinds:
            return (now if kinds else new).select("graph", "node", "colour")
        now, kinds = new, told_apart


def colours(triples: DataFrame, graph: str = "graph") -> DataFrame:
    """graph, node, colour of the blank nodes: a hash of all that is said of a node and by it, to any distance, that doesn't depend on names.

    Each round hashes a node's colour with its triples' predicates, other ends and directions, as sums, so that a node with very many triples is summed in the
    tasks first. What doesn't change, the sums over ends that aren't blank, is worked out once; only links between blank nodes are followed each round. It ends when a
    round tells no more nodes apart than the last.
    """
    return _colours(_distinct(triples, graph))


def graph_hashes(triples: DataFrame, graph: str = "graph") -> DataFrame:
    """graph, triples, h0, h1, alike: the number of a graph's distinct triples, and hashes that are equal for graphs that differ in the names of blank nodes and
    the order of triples only, and else differ (but for chance, of 80 bits).

    alike: how many blank nodes have the colour of another one. Nodes that say the same count as equal; only graphs in which such nodes refer to each other in
    different ways, as two rings of three and one of six, can't be told apart.
    triples: graph, s, p, o, o_kind, o_lang, o_dtype.
    """
    t = _distinct(triples, graph)
    named = _colours(t)
    side = lambda c: named.select("graph", F.col("node").alias(c), F.col("colour").alias(f"{c}_colour")).hint("merge")
    end = lambda c: F.coalesce(F.col(f"{c}_colour").cast("string"), F.col(c))
    h = F.xxhash64(end("s"), F.col("s_colour").isNull(), "p", end("o"), "o_kind", F.coalesce("o_lang", F.lit("")), F.coalesce("o_dtype", F.lit("")))
    to = t.join(side("s"), ["graph", "s"], "left").join(side("o").withColumn("o_kind", F.lit("bnode")).hint("merge"), ["graph", "o", "o_kind"], "left").withColumn("h", h)
    a, b = _sum(F.col("h"))
    sums = to.groupBy("graph").agg(F.count(F.lit(1)).alias("triples"), a.alias("h0"), b.alias("h1"))
    alike = named.groupBy("graph", "colour").agg(F.count(F.lit(1)).alias("n")).groupBy("graph").agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("alike"))
    return sums.join(alike, "graph", "left").select("graph", "triples", "h0", "h1", F.coalesce("alike", F.lit(0)).alias("alike"))
