"""Values in force, from arrays of {language, value, effectiveFrom, effectiveTo}. No shuffle: all within a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusweave.functions.scalars import col, iso_timestamp, maybe_int, nonblank, parse_bool, strip

ENTRIES = "array<struct<language:string,value:string,effectiveFrom:string,effectiveTo:string>>"
_FIRST = -(1 << 63)


def current_or_latest(entries: Column | str) -> Column:
    """The open entry (without an end) that began last; among all if none is open. Of ties the first in the array; null if empty."""
    rows = F.filter(F.coalesce(col(entries), F.array().cast(ENTRIES)) if isinstance(entries, str) else entries, lambda x: x.isNotNull())
    now = F.filter(rows, lambda x: F.coalesce(x["effectiveTo"], F.lit("")).isin("", "null"))
    use = F.when(F.size(now) > 0, now).otherwise(rows)
    keyed = F.transform(use, lambda x, i: F.struct(F.coalesce(F.unix_micros(iso_timestamp(x["effectiveFrom"])), F.lit(_FIRST)).alias("k"), (-i).alias("p"), x.alias("row")))
    return F.array_max(keyed)["row"]


def current_per_language(entries: Column | str) -> Column:
    """The entry in force for each language as written, by language."""
    rows = F.filter(col(entries), lambda x: x.isNotNull())
    tags = F.array_sort(F.array_distinct(F.transform(rows, lambda x: F.coalesce(x["language"], F.lit("")))))
    return F.transform(tags, lambda t: current_or_latest(F.filter(rows, lambda x: F.coalesce(x["language"], F.lit("")) == t)))


def language_values(entries: Column | str) -> Column:
    """Map of lower-case language ('und' if blank) to text; blank texts go; of spellings of one language the last holds."""
    chosen = F.transform(
        current_per_language(entries),
        lambda x: F.struct(F.coalesce(F.nullif(F.lower(strip(x["language"])), F.lit("")), F.lit("und")).alias("k"), nonblank(x["value"]).alias("v")),
    )
    chosen = F.filter(chosen, lambda x: x["v"].isNotNull())
    last = F.filter(chosen, lambda x, i: ~F.exists(F.slice(chosen, i + 2, F.size(chosen)), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)


def language_columns(prefix: str, entries: Column | str, languages: tuple[str, ...] = ("sk", "en")) -> list[Column]:
    values = language_values(entries)
    return [F.try_element_at(values, F.lit(t)).alias(f"{prefix}_{t}") for t in languages]


def effective_bounds(validities: Column | str, valid_from: Column | str) -> tuple[Column, Column]:
    """Start and end of the validity in force; the start falls back to the row's own."""
    now = current_or_latest(validities)
    return F.coalesce(nonblank(now["effectiveFrom"]), nonblank(valid_from)), F.nullif(nonblank(now["effectiveTo"]), F.lit("null"))


def whole_number_in_force(entries: Column | str) -> Column:
    return maybe_int(current_or_latest(entries)["value"])


def flag_in_force(entries: Column | str) -> Column:
    return parse_bool(current_or_latest(entries)["value"])
