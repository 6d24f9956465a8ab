"""URI algebra as column expressions. Two normalisers and two tails differ on purpose and must not be merged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusweave.functions.scalars import col, let, nonblank, strip
from corpusweave.functions.text import CODE_PATTERN, STOP_TOKENS, URI_PATTERN, words

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
# Hosts and folders by which URI bases are told apart.
PORTAL_HOST = "data.gov.sk"
DEFINITIONS = "def"
CODELISTS = ["set", "codelist"]
# Kinds of bases in order of preference.
KINDS = ["data_gov_def_simple", "data_gov_set_codelist", "data_gov_def_namespaced", "external_other"]


def part(c: Column | str, i: int) -> Column:
    """Scheme 1, host 2, path 3, query 4, fragment 5; '' where there is none."""
    return F.regexp_extract(col(c), _PARTS, i)


def is_http_uri(c: Column | str) -> Column:
    return F.coalesce(strip(c).rlike(r"(?i)^https?://[^/?#]+"), F.lit(False))


def normalize_uri(c: Column | str) -> Column:
    """Lower-case scheme, single slashes in the path; null unless http(s) with a host. A trailing slash stays."""

    def tidy(t: Column) -> Column:
        out = F.concat(F.lower(part(t, 1)), F.lit("://"), part(t, 2), F.regexp_replace(part(t, 3), "/+", "/"), part(t, 4), part(t, 5))
        return F.when(t.rlike(r"(?i)^https?://[^/?#]+"), F.regexp_replace(F.regexp_replace(out, r"#$", ""), r"\?$", ""))

    return let(strip(c), tidy)


def normalize_http_uri(c: Column | str) -> Column:
    """As above, but without empty path segments, the trailing one included."""

    def tidy(t: Column) -> Column:
        out = F.concat(F.lower(part(t, 1)), F.lit("://"), part(t, 2), F.regexp_replace(F.regexp_replace(part(t, 3), "/+", "/"), "/$", ""), part(t, 4), part(t, 5))
        return F.when(t.rlike(r"(?i)^https?://[^/?#]+"), out)

    return let(strip(c), tidy)


def local_name(c: Column | str) -> Column:
    """What follows the last / or #, trailing ones aside."""
    return F.regexp_extract(F.regexp_replace(col(c), "[/#]+$", ""), "[^/#]*$", 0)


def uri_base(c: Column | str) -> Column:
    """The parent folder's URI, without query and fragment."""

    def base(u: Column) -> Column:
        path = F.regexp_replace(F.regexp_replace(part(u, 3), "/+$", ""), "[^/]*$", "")
        return F.concat(part(u, 1), F.lit("://"), part(u, 2), F.coalesce(F.nullif(path, F.lit("")), F.lit("/")))

    return let(col(c), base)


def uri_tail(c: Column | str) -> Column:
    """The last path segment with any query and fragment."""
    return F.element_at(F.split(F.regexp_replace(col(c), "/+$", ""), "/"), -1)


def normalized_tail(c: Column | str) -> Column:
    """Tail of the normalised URI; null if there is none."""
    return F.nullif(uri_tail(normalize_uri(c)), F.lit(""))


def identity(code: Column | str, uri: Column | str) -> Column:
    """code, uri and whether they were recovered: an http URI in place of the code, without one of its own, is split."""
    k, u = nonblank(code), nonblank(uri)
    moved = u.isNull() & is_http_uri(k)
    return F.struct(
        F.when(moved, local_name(normalize_http_uri(k))).otherwise(k).alias("code"),
        F.when(moved, normalize_http_uri(k)).otherwise(u).alias("uri"),
        F.coalesce(moved, F.lit(False)).alias("recovered"),
    )


def path_parts(c: Column | str) -> Column:
    return F.filter(F.split(part(c, 3), "/"), lambda x: x != "")


def classify_base(c: Column | str) -> Column:
    """kind, base, label (last segment) and path_parts of a URI base."""
    parts, host = path_parts(c), F.lower(part(c, 2))
    n = F.size(parts)
    first = F.try_element_at(parts, F.lit(1))
    inside = host.endswith(PORTAL_HOST)
    kind = (
        F.when(inside & (first == DEFINITIONS) & (n == 2), KINDS[0])
        .when(inside & (first == DEFINITIONS) & (n >= 3), KINDS[2])
        .when(inside & (n == 3) & (F.slice(parts, 1, 2) == F.array(*map(F.lit, CODELISTS))), KINDS[1])
        .otherwise(KINDS[3])
    )
    return F.struct(kind.alias("kind"), col(c).alias("base"), F.try_element_at(parts, F.lit(-1)).alias("label"), parts.alias("path_parts"))


def kind_rank(kind: Column | str) -> Column:
    return F.coalesce(F.array_position(words(KINDS), col(kind)), F.lit(len(KINDS))) - 1


def uri_family(c: Column | str) -> Column:
    """The folder that a URI names (with a trailing slash) or lies in."""
    raw = strip(c)
    parts = F.split(F.regexp_replace(normalize_uri(raw), "/+$", ""), "/")
    at = F.when(raw.endswith("/"), -1).otherwise(-2)
    return F.when(F.size(parts) >= 2, F.nullif(F.try_element_at(parts, at), F.lit("")))


def family_tokens(c: Column | str) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(col(c)), "[-_/]+"), lambda t: (t != "") & ~t.isin(STOP_TOKENS)))


def family_parent(c: Column | str) -> Column:
    return F.when(col(c).endswith("-detail"), F.regexp_replace(col(c), "-detail$", ""))


def slashed(c: Column | str) -> Column:
    """With exactly one trailing slash."""
    return F.concat(F.regexp_replace(strip(c), "/+$", ""), F.lit("/"))


def external_kind(base: Column | str) -> Column:
    return F.when(F.contains(col(base), F.lit("legal-subject")), "legal_subject").otherwise("external_uri")


def external_identifier(raw: Column | str, base: Column | str) -> Column:
    """The identifier under an external base that a text names, or null.

    In this order: the whole text is a URI under the base; one is embedded; for legal subjects one to eight digits, padded; the only
    code-like token; the text itself if it has no white space.
    """


    def named(x: Column) -> Column:
        t, b, whole, first = x["t"], x["b"], x["whole"], x["first"]
        rest = lambda u: F.nullif(F.regexp_replace(F.substring(u, F.length(b) + 1, F.length(u)), "^/+|/+$", ""), F.lit(""))
        codes = F.regexp_extract_all(t, F.lit(f"({CODE_PATTERN})"), F.lit(1))
        digits, plain = F.regexp_replace(t, r"\D+", ""), F.regexp_replace(t, "^[/ ]+|[/ ]+$", "")
        return (
            F.when(whole.startswith(b), rest(whole))
            .when(first.startswith(b), rest(first))
            .when(external_kind(b) == "legal_subject", F.when(F.length(digits).between(1, 8), F.lpad(digits, 8, "0")))
            .when(F.size(codes) == 1, F.try_element_at(codes, F.lit(1)))
            .when((plain != "") & ~plain.rlike(r"(?U)\s") & ~F.contains(plain, F.lit("://")), plain)
        )

    t = strip(raw)
    first = F.try_element_at(F.regexp_extract_all(t, F.lit(f"({URI_PATTERN})"), F.lit(1)), F.lit(1))
    return let(F.struct(t.alias("t"), slashed(base).alias("b"), normalize_uri(t).alias("whole"), normalize_uri(first).alias("first")), named)
