"""Text functions as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusweave.functions.scalars import col, strip

# Words that say nothing about an item.
STOP_TOKENS = [
    "a", "aj", "alebo", "and", "at", "do", "for", "from", "in", "na", "o", "of", "po", "pod", "pre", "pri", "s", "sa", "so", "the", "to", "u", "v", "vo", "z", "za",
]
# Words that say nothing about a code list, beside those.
CODELIST_STOP_TOKENS = [*STOP_TOKENS, "ciselnik", "číselník", "hodnota", "hodnoty", "kod", "kód", "kody", "kódy", "zoznam", "typ", "trieda"]
# Words that mark a list of details.
DETAIL_TOKENS = ["detail", "detaily", "detailu", "detailov", "podrobnost", "podrobnosti", "podrobny", "podrobný", "podrobne", "podrobné"]
# Patterns of references inside free text.
URI_PATTERN = r"(?i)https?://[^\s,;]+"
CODE_PATTERN = r"\b(?:[A-Z]{1,}[A-Z0-9]*\d[A-Z0-9.]*|\d{2}(?:\.\d{1,2})+|\d{4,})\b"
TOKEN_PATTERN = r"[0-9A-Za-zÀ-ž.]+"


def squeeze(c: Column | str) -> Column:
    """Runs of white space, no-break spaces included, as one blank; none at the ends."""
    return strip(F.regexp_replace(F.regexp_replace(col(c), " ", " "), r"(?U)\s+", " "))


def casefold(c: Column | str) -> Column:
    """Full Unicode case folding, as far as the JVM's Unicode version goes: lower case of the upper case, which spells out ß, ligatures and the
    like, but for the dotless i, which stays, and sigma, which has one lower case. Cherokee folds to its small letters."""
    upper = F.upper(F.translate(col(c), "ıẞ", "\ue000ß"))
    return F.translate(F.lower(F.translate(upper, "Σ", "σ")), "\ue000", "ı")


def normalize_text(c: Column | str) -> Column:
    """Squeezed and case-folded for comparison; blank is null."""
    return F.nullif(casefold(squeeze(c)), F.lit(""))


@F.pandas_udf(StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    """HTML entities resolved and white space squeezed."""
    import html

    return s.map(lambda x: None if x is None else " ".join(html.unescape(x).split()))


def markup_unescape(c: Column | str) -> Column:
    """The four entities that markup itself needs resolved, where they end in a semicolon (of `&amp;lt;` only the first), and ASCII white space squeezed.
    All else stays: other entities, and beginnings of these, as the `&amp` that a cut text ends with, which `html_unescape` reads as HTML does."""
    out = col(c)
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return F.regexp_replace(F.regexp_replace(out, r"[\t\n\f\r ]+", " "), r"^\p{Zs}+|\p{Zs}+$", "")


def words(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def tokenize(c: Column | str, stop: list[str] | None = None) -> Column:
    """Distinct tokens of two characters or more that aren't stop words; none for null."""
    found = F.filter(F.array_distinct(F.regexp_extract_all(normalize_text(c), F.lit(f"({TOKEN_PATTERN})"), F.lit(1))), lambda t: F.length(t) >= 2)
    return F.coalesce(F.array_except(found, words(STOP_TOKENS if stop is None else stop)), F.array().cast("array<string>"))


def without_details(tokens: Column | str) -> Column:
    return F.array_except(col(tokens), words(DETAIL_TOKENS))


def clean_relation_token(c: Column | str) -> Column:
    """A clue without quotes, bullets, a leading 'pozri' and outer punctuation."""
    t = F.regexp_replace(strip(c), "^[\"']+|[\"']+$", "")
    t = F.regexp_replace(t, r"(?U)^[\-•·*]+\s*", "")
    t = F.regexp_replace(t, r"(?iU)^pozri\s+", "")
    return F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", " "), r"^[ ,;:]+|[ ,;:]+$", "")


def split_clues(c: Column | str) -> Column:
    """Clues between commas, semicolons, tabs and line ends; blanks go, repeats stay."""
    return F.filter(F.transform(F.split(col(c), r"[,;\n\r\t]+"), clean_relation_token), lambda x: x != "")


def explicit_refs(c: Column | str) -> Column:
    """URIs, then code-like tokens, each once in order of appearance."""
    found = F.concat(F.regexp_extract_all(col(c), F.lit(f"({URI_PATTERN})"), F.lit(1)), F.regexp_extract_all(col(c), F.lit(f"({CODE_PATTERN})"), F.lit(1)))
    return F.array_distinct(F.filter(F.transform(found, clean_relation_token), lambda x: x != ""))


def ttl_escape(c: Column | str) -> Column:
    """Backslash, quote and line ends escaped as in Turtle strings."""
    out = col(c)
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def safe_prefix(c: Column | str) -> Column:
    """A name for a Turtle prefix."""
    t = F.regexp_replace(F.regexp_replace(F.lower(col(c)), r"(?U)[^\p{L}\p{N}_]", "_"), r"^_+|_+$", "")
    t = F.coalesce(F.nullif(t, F.lit("")), F.lit("items"))
    return F.when(t.rlike(r"^\d"), F.concat(F.lit("ns_"), t)).otherwise(t)


def text_norms(*columns: Column | str) -> Column:
    """Distinct normalised texts of several columns."""
    return F.array_distinct(F.array_compact(F.array(*(normalize_text(c) for c in columns))))


def text_tokens(*columns: Column | str, stop: list[str] | None = None) -> Column:
    """Distinct tokens of several columns."""
    return F.array_distinct(F.flatten(F.array(*(tokenize(c, stop) for c in columns))))
