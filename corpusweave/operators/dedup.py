"""Ranked choice of one row per key, and the classification of what it leaves out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusweave.functions.scalars import col, iso_timestamp, nonblank, state_rank, truthy

_MIN = -(1 << 63)
# What a report says of duplicates.
HEADER_REASONS = {"conflict": "multiple current published non-temporal base headers", "shadow": "one canonical base header plus non-canonical shadow variants"}
ITEM_REASONS = {"conflict": "multiple current published non-temporal items", "shadow": "one canonical item plus non-canonical shadow variants"}


def registry_order(state: str, effective_to: str, valid_from: str, temporal: str, row_id: str, pos: str | None = None) -> list[Column]:
    """Preferred first: better state, no end or a later one, later start (none counts as 1970), not temporal, greater id, input place."""
    to = F.unix_micros(iso_timestamp(effective_to))
    start = F.coalesce(F.unix_micros(iso_timestamp(valid_from)), F.lit(0))
    order = [state_rank(state), F.when(to.isNull(), F.lit(_MIN)).otherwise(-to), -start, truthy(temporal).cast("int"), F.desc_nulls_last(row_id)]
    return order + ([F.col(pos)] if pos else [])


def best_per_key(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Catalyst keeps one row a key and task before the shuffle, so a hot key is no burden.

    Null keys form a key of their own; ties beyond `order` are arbitrary, so orders end in something unique.
    """
    keys = [key] if isinstance(key, str) else key
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def select_best(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """As above for rows with a key; rows without one are passed on as they are."""
    blank = nonblank(key).isNull()
    return best_per_key(df.where(~blank), key, order).unionByName(df.where(blank))


def duplicate_issues(df: DataFrame, key: str, canonical: Column, order_key: Column, row: Column, reasons: dict[str, str] = HEADER_REASONS) -> DataFrame:
    """Of each key with several rows: whether more than one is canonical (conflict) or not (shadow), and the rows in order.

    order_key: a struct that sorts as the ranking does. Only rows of keys with several are gathered; those of one key must fit a task, as
    the report lists them all.
    """
    several = df.groupBy(F.col(key).alias("_several")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_several")
    rows = df.join(several, F.col(key).eqNullSafe(F.col("_several")), "left_semi")
    got = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(canonical).alias("n_canonical"), F.array_sort(F.collect_list(F.struct(order_key.alias("k"), row.alias("row")))).alias("all")
    )
    kind = F.when(F.col("n_canonical") > 1, "conflict").otherwise("shadow")
    return got.select(
        key, kind.alias("kind"), F.when(kind == "conflict", reasons["conflict"]).otherwise(reasons["shadow"]).alias("reason"),
        F.col("all")[0]["row"].alias("selected"), F.transform("all", lambda x: x["row"]).alias("candidates"),
    )


def last_wins(df: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """The last row of each key in the given order, as repeated assignment leaves it."""
    return best_per_key(df, key, [_reverse(c) for c in order])


def _reverse(c: Column) -> Column:
    return c.desc_nulls_last()


def current_header(state: str, temporal: str, base: str, effective_to: str) -> Column:
    return (nonblank(state) == "PUBLISHED") & ~truthy(temporal) & truthy(base) & nonblank(effective_to).isNull()


def current_item(state: str, temporal: str, published: str) -> Column:
    """A null `published` passes, false doesn't."""
    return (nonblank(state) == "PUBLISHED") & ~truthy(temporal) & ~F.coalesce(~col(published).cast("boolean"), F.lit(False))
