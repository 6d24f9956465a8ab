"""Scalar coercions and filters as column expressions. Null in, null out, unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The registry's item and header states in order of preference.
STATES = ["PUBLISHED", "READY_TO_PUBLISH", "ISVS_PROCESSING", "UPDATING"]
OTHER_STATE = 99
# Spellings of booleans.
TRUE = ["true", "1", "yes", "y"]
FALSE = ["false", "0", "no", "n"]
_UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once and written once into the plan, however often `use` mentions it. Without it, nested
    functions that mention their argument several times outgrow what the JVM compiles."""
    return F.transform(F.array(value), use)[0]


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def nonblank(c: Column | str) -> Column:
    """Stripped, null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def truthy(c: Column | str) -> Column:
    """A loosely typed flag kept as text: anything but null, '', 0 and a real false. Text 'false' can't be told from false here."""
    t = F.lower(col(c).cast("string"))
    return F.coalesce(~t.isin("", "0", "false"), F.lit(False))


def parse_bool(c: Column | str) -> Column:
    """true/1/yes/y and false/0/no/n in any case, else null."""
    t = F.lower(strip(col(c).cast("string")))
    return F.when(t.isin(*TRUE), True).when(t.isin(*FALSE), False)


def parse_bool_number(c: Column | str) -> Column:
    """A number as a boolean: 0 is false."""
    return col(c) != 0


def maybe_int(c: Column | str) -> Column:
    """A whole number in text, or null: '1.0' is none."""
    t = strip(col(c).cast("string"))
    return F.when(t.rlike(r"^[+-]?\d+$"), t).try_cast("bigint")


def iso_timestamp(c: Column | str) -> Column:
    t = strip(c)
    return F.when(t.rlike(_ISO), F.regexp_replace(t, ",", ".")).try_cast("timestamp")


def iso_date(c: Column | str) -> Column:
    """The date as it is written, whatever the offset."""
    t = strip(c)
    return F.when(t.rlike(_ISO) & iso_timestamp(t).isNotNull(), F.substring(t, 1, 10)).try_cast("date")


def state_rank(c: Column | str) -> Column:
    """Place of a state in the order of preference; 99 for null and others."""
    out = F.lit(OTHER_STATE)
    for i, name in reversed(list(enumerate(STATES))):
        out = F.when(strip(c) == name, i).otherwise(out)
    return out


def as_list(c: Column | str, is_list: bool) -> Column:
    """Null as no elements, a scalar as one."""
    return F.coalesce(col(c), F.array()) if is_list else F.when(col(c).isNull(), F.array()).otherwise(F.array(col(c)))


def unique_nonempty(values: Column | str) -> Column:
    """Stripped values without blanks, each once, in order of first appearance; nulls go."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(col(values), F.array().cast("array<string>")), strip), lambda x: x != ""))


def sanitize_ico(c: Column | str) -> Column:
    """An organisation number: 6 to 10 digits once white space is gone, else null."""
    t = F.regexp_replace(col(c), r"(?U)\s+", "")
    return F.when(t.rlike(r"^\d{6,10}$"), t)


def owner_uuid(c: Column | str) -> Column:
    """The last UUID in a text."""
    return F.try_element_at(F.regexp_extract_all(col(c), F.lit(f"({_UUID})"), F.lit(1)), F.lit(-1))


def normalize_ico(c: Column | str) -> Column:
    """One to eight digits among other characters, padded to eight, else null."""
    d = F.regexp_replace(col(c).cast("string"), r"\D+", "")
    return F.when(F.length(d).between(1, 8), F.lpad(d, 8, "0"))


def looks_like_ico(c: Column | str) -> Column:
    return F.coalesce(strip(col(c).cast("string")).rlike(r"^\d{1,8}$"), F.lit(False))


def ci_attribute(attributes: Column | str, *names: str) -> Column:
    """The first non-null value, in array order, of an attribute with one of the names in any case."""
    wanted = [n.lower() for n in names]
    return F.try_element_at(F.filter(col(attributes), lambda a: F.lower(a["name"]).isin(wanted) & a["value"].isNotNull()), F.lit(1))["value"]
