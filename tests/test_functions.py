from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusweave.functions import scalars, temporal, text, uris
from corpusweave.operators.audit import audit_category


def of(spark, fn, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn("x").alias("y")).first().y


CASES = [
    (uris.normalize_uri, "https://data.gov.sk//def//x/1/", "https://data.gov.sk/def/x/1/"), (uris.normalize_uri, "HTTPS://Data.gov.sk/a", "https://Data.gov.sk/a"),
    (uris.normalize_uri, "ftp://x/a", None), (uris.normalize_uri, "x/a", None), (uris.normalize_uri, "http:///a", None), (uris.normalize_uri, None, None),
    (uris.normalize_http_uri, "https://data.gov.sk//def//x/1/", "https://data.gov.sk/def/x/1"),
    (uris.uri_base, "https://data.gov.sk/def/x/1", "https://data.gov.sk/def/x/"), (uris.uri_base, "https://data.gov.sk/def/x/1/", "https://data.gov.sk/def/x/"), (uris.uri_base, "http://h/a?q=1#f", "http://h/"), (uris.uri_base, "http://h", "http://h/"),
    (uris.local_name, "http://e/a#b", "b"), (uris.local_name, "http://e/a/", "a"), (uris.uri_tail, "http://e/a?b=c", "a?b=c"),
    (uris.uri_family, "https://data.gov.sk/def/x-detail/", "x-detail"), (uris.uri_family, "https://data.gov.sk/def/x/1", "x"), (uris.family_parent, "x-detail", "x"), (uris.family_parent, "x", None),
    (scalars.parse_bool, "Yes", True), (scalars.parse_bool, "0", False), (scalars.parse_bool, "x", None), (scalars.parse_bool, None, None),
    (scalars.maybe_int, " 7 ", 7), (scalars.maybe_int, "1.0", None), (scalars.maybe_int, "", None),
    (lambda c: scalars.iso_date(c).cast("string"), "2024-05-01T23:30:00-05:00", "2024-05-01"), (lambda c: scalars.iso_date(c).cast("string"), "2024-05-01T00:00:00Z", "2024-05-01"),
    (scalars.iso_date, "2024-02-30", None), (scalars.iso_date, "2024-1-1", None),
    (scalars.state_rank, "PUBLISHED", 0), (scalars.state_rank, " UPDATING", 3), (scalars.state_rank, None, 99), (scalars.state_rank, "other", 99),
    (scalars.sanitize_ico, "00 151 742", "00151742"), (scalars.sanitize_ico, "12345", None), (scalars.normalize_ico, "123", "00000123"), (scalars.normalize_ico, "35 683 813", "35683813"), (scalars.normalize_ico, "123456789", None),
    (scalars.strip, "  a \t", "a"),
    (text.safe_prefix, "2x", "ns_2x"), (text.safe_prefix, "LoA", "loa"), (text.safe_prefix, "", "items"),
    (text.normalize_text, "  Foo  BAR ", "foo bar"), (text.normalize_text, "Straße", "strasse"), (text.normalize_text, " ", None), (text.casefold, "STRASSE ß", "strasse ss"), (text.html_unescape, " a &amp;\n b&nbsp;c ", "a & b c"),
    (text.clean_relation_token, "- pozri Bratislava ;", "Bratislava"), (text.ttl_escape, 'a"b\\c\nd', 'a\\"b\\\\c\\nd'),
    (lambda c: text.tokenize(c), "A Kód v 01.11", ["kód", "01.11"]), (lambda c: text.tokenize(c, text.CODELIST_STOP_TOKENS), "Číselník typ stavby", ["stavby"]), (text.tokenize, None, []),
    (text.split_clues, "A; B,\nC", ["A", "B", "C"]), (text.split_clues, "A,A", ["A", "A"]), (text.explicit_refs, "viz http://e/x a CL000123, 01.11", ["http://e/x", "CL000123", "01.11"]),
    (text.explicit_refs, "A1 CL000123 01.11.1 1234 ABC 123", ["A1", "CL000123", "01.11.1", "1234"]),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_vectors(spark, k):
    fn, value, want = CASES[k]
    assert of(spark, fn, value) == want


def test_more_vectors(spark):
    subj, ex = F.lit("https://data.gov.sk/id/legal-subject/"), F.lit("http://ex/")
    for base, value, want in [(subj, "35683813", "35683813"), (subj, "ICO: 151742", "00151742"), (subj, "123456789", None), (ex, "abc def CL000123", "CL000123"), (ex, "abc", "abc"), (ex, "a b", None), (ex, "http://ex/q/", "q")]:
        assert of(spark, lambda c, b=base: uris.external_identifier(c, b), value) == want, value
    kinds = [("https://data.gov.sk/def/x/", "data_gov_def_simple", "x"), ("https://data.gov.sk/def/ontology/egov/", "data_gov_def_namespaced", "egov"), ("https://data.gov.sk/set/codelist/CL000001/", "data_gov_set_codelist", "CL000001"), ("http://eidas.europa.eu/LoA/", "external_other", "LoA")]
    for base, kind, label in kinds:
        got = of(spark, uris.classify_base, base)
        assert (got.kind, got.label) == (kind, label)
    x = spark.createDataFrame([("http://eidas.europa.eu/LoA/high", None), ("high", "http://eidas.europa.eu/LoA/high")], "k string, u string").select(uris.identity("k", "u").alias("x")).collect()
    assert [tuple(r.x) for r in x] == [("high", "http://eidas.europa.eu/LoA/high", True), ("high", "http://eidas.europa.eu/LoA/high", False)]
    a, b = "0" * 8 + "-0000-0000-0000-" + "a" * 12, "1" * 8 + "-0000-0000-0000-" + "b" * 12
    assert of(spark, scalars.owner_uuid, f"A:{a} B:{b}") == b and of(spark, scalars.owner_uuid, "none") is None
    assert of(spark, scalars.unique_nonempty, [" a", "b", "a", "", None], "array<string>") == ["a", "b"]
    attrs = [("NAME", None), ("Name", "n"), ("name", "m")]
    assert of(spark, lambda c: scalars.ci_attribute(c, "name"), attrs, "array<struct<name:string,value:string>>") == "n"


def test_values_in_force(spark):
    e = lambda *rows: [dict(zip(("language", "value", "effectiveFrom", "effectiveTo"), r, strict=True)) for r in rows]
    chosen = lambda rows: (of(spark, temporal.current_or_latest, rows, temporal.ENTRIES) or {"value": None})["value"]
    assert chosen(e((None, "a", "2020-01-01", "2021-01-01"), (None, "b", "2019-01-01", None), (None, "c", None, ""))) == "b"
    assert chosen(e((None, "a", "2020-01-01", "2021-01-01"), (None, "b", "2022-01-01", "2023-01-01"))) == "b"
    assert chosen(e((None, "a", "2020-01-01", None), (None, "b", "2020-01-01", "null"))) == "a" and chosen([]) is None
    values = of(spark, temporal.language_values, e(("SK", "x", None, None), ("sk", "y", None, None), ("", "z", None, None), ("en", " ", None, None)), temporal.ENTRIES)
    assert values == {"sk": "y", "und": "z"}
    df = spark.createDataFrame([(e(("sk", "y", None, None)),)], f"x {temporal.ENTRIES}").select(*temporal.language_columns("name", "x"))
    assert tuple(df.first()) == ("y", None) and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_audit_tree(spark):
    cases = {
        "https://data.gov.sk/def/x/1": "ok", "https://data.gov.sk//def///x/1": "ok", None: "skipped", "x/1": "invalid", "https://data.gov.sk/def/x/": "missing_tail", "https://data.gov.sk/def/y/1": "base_mismatch",
        "https://data.gov.sk/def/x/2": "tail_mismatch", "https://data.gov.sk/def/y/2": "mismatch", "https://data.gov.sk/def/x/1/": "mismatch",
    }
    for uri, want in cases.items():
        assert of(spark, lambda c: audit_category(F.lit("https://data.gov.sk/def/x/"), F.lit("1"), c), uri) == want, uri


def test_case_folding(spark):
    points = [c for c in [*range(1, 0x1400), *range(0x1E00, 0x2000), 0x2126, 0x212A, 0x212B, *range(0xFB00, 0xFB18), *range(0xFF21, 0xFF3B), 0x10400] if not 0x13A0 <= c <= 0x13FF]
    texts = [f"a{chr(c)}b {chr(c)}" for c in points] + ["ΣΊΣΥΦΟΣ", "Straße", "STRASSE", "ıİi"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.casefold("t").alias("f")).collect()
    assert [(r.t, r.f) for r in got if r.f != r.t.casefold()] == []
