"""Line-first quality rules: drop failing lines, then documents that lose too much of their text."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpusweave.llm.common import by_slices, id_text, table, window_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
_SYMBOL_WORD = re.compile(r"[^\x20\x09-\x0D]*[#*$%&|<>][^\x20\x09-\x0D]*")
_SEPARATOR = re.compile(r"(?:^|(?<=[\x20\x09-\x0D]))[|<>«»›‹•·/]+(?=$|[\x20\x09-\x0D])")
_SHOUT = re.compile(r"[!?]{2,}(?=$|[\x20\x09-\x0D])")
_STOP = re.compile(r"[.!?…。:;]")
#: Phrases of page furniture, matched in lower-cased lines of few words.
FURNITURE = re.compile(
    r"cookie|all rights reserved|click here|read more|subscribe|terms of (?:use|service)|privacy policy"
    r"|log ?in\b|sign ?(?:in|up)\b|javascript|back to top|skip to (?:main )?content|share this|follow us|next page|previous page"
)
WINDOW = 8


@dataclass(frozen=True)
class LineRules:
    """Thresholds. Shares are of a line's words, but `most_upper` of its letters and `most_lost` of a text's word characters."""

    most_symbol_words: float = 0.2
    most_shouts: float = 0.3
    most_upper: float = 0.6
    upper_words: int = 4
    separators: int = 2
    furniture_words: int = 12
    unpunctuated_words: int = 40
    most_lost: float = 0.5


def line_fault(line: str, seen: set[str], rules: LineRules = LineRules()) -> str | None:
    """The first rule that the line breaks: repeat, navigation, symbols, punctuation, furniture; None if it stays."""
    n = len(WORD.findall(line))
    if not n:
        return None
    if line in seen:
        return "repeat"
    if len(_SEPARATOR.findall(line)) >= rules.separators:
        return "navigation"
    if any(c in line for c in SYMBOLS) and len(_SYMBOL_WORD.findall(line)) > max(1, rules.most_symbol_words * n):
        return "symbols"
    if len(_SHOUT.findall(line)) > max(1, rules.most_shouts * n):
        return "punctuation"
    if n >= rules.upper_words and line != line.lower():
        upper = sum(map(str.isupper, line))
        if upper > rules.most_upper * sum(map(str.isalpha, line)):
            return "punctuation"
    if n >= rules.unpunctuated_words and not _STOP.search(line):
        return "punctuation"
    if n <= rules.furniture_words and FURNITURE.search(line.lower()):
        return "furniture"
    return None


def repeated_words(words: list[str], n: int = WINDOW) -> int:
    """Words that lie in an n-word window which the text holds twice or more, the first included."""
    m = len(words) - n + 1
    if m < 2:
        return 0
    h = window_hashes(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), n)
    order = np.argsort(h)
    again = h[order[1:]] == h[order[:-1]]
    if not again.any():
        return 0
    # Equal windows have equal hashes; only windows of a repeated hash are compared word by word.
    twin = np.zeros(m, bool)
    twin[order[1:][again]] = True
    twin[order[:-1][again]] = True
    at = np.flatnonzero(twin).tolist()
    ids: dict[str, int] = {}
    code = [ids.setdefault(w, len(ids)) for w in words]
    windows = [tuple(code[i : i + n]) for i in at]
    count = Counter(windows)
    edge = np.zeros(len(words) + 1, np.int64)
    for i, w in zip(at, windows, strict=True):
        if count[w] > 1:
            edge[i] += 1
            edge[i + n] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def assess(text: str | None, rules: LineRules = LineRules()) -> dict:
    """Counts, verdict and cleaned text of one document."""
    text = text or ""
    words = WORD.findall(text)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    seen: set[str] = set()
    kept_lines, dup, lost = [], 0, 0
    for line in text.split("\n"):
        fault = line_fault(line, seen, rules)
        if line in seen:
            dup += 1
        elif WORD.search(line):
            seen.add(line)
        if fault:
            lost += len(line) - sum(map(line.count, " \t\v\f\r"))
        else:
            kept_lines.append(line)
    repeat = repeated_words(words)
    failed = len(words) < 20 or 100 * repeat > 30 * len(words)
    return {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": dup,
        "n_repeat_words": repeat,
        "base_failed": failed,
        "lost_chars": lost,
        "kept": not failed and lost <= rules.most_lost * chars,
        "cleaned": "\n".join(kept_lines),
    }


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, lost_chars long, kept boolean, cleaned string"
)


def clean_lines(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Counts, verdict and cleaned text of every document, whole texts, one row for each input row.

    Null or empty text: no words, base_failed, not kept, cleaned ''. Null id and repeated rows: kept as they are.
    Empty input: no rows. with_text=False leaves out the cleaned text.
    """
    names = [x.split()[0] for x in SCHEMA.split(", ")][: None if with_text else -1]
    schema = ", ".join(SCHEMA.split(", ")[: len(names)])

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [assess(x, rules) for x in part.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[k] for r in rows], pa.string() if k == "cleaned" else pa.bool_() if k in ("kept", "base_failed") else pa.int64()) for k in names[1:])], names)

    docs = id_text(docs, id_col, text_col)
    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(by_slices(run), schema)


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    return clean_lines(table(spark, sf_dir, "documents"), with_text=False)


def _sql(rules: LineRules = LineRules()) -> str:
    """All columns in DuckDB SQL, over words, windows of words and lines as rows."""
    words = lambda c: f"regexp_extract_all({c}, '[^\\x20\\x09-\\x0D]+')"
    having = lambda pattern: f"len(list_filter(w, lambda x: regexp_matches(x, '{pattern}')))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT *, {words('text')} AS w FROM d),
p AS (SELECT k, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS win FROM t, unnest(range(1, len(w) - {WINDOW - 2})) AS u(i)),
r AS (SELECT k, count(DISTINCT i + j) AS n_repeat_words FROM (SELECT *, count(*) OVER (PARTITION BY k, win) AS n FROM p), unnest(range({WINDOW})) AS v(j) WHERE n > 1 GROUP BY k),
l AS (SELECT k, i, lines[i] AS line FROM (SELECT k, string_split(text, chr(10)) AS lines FROM d), unnest(range(1, len(lines) + 1)) AS u(i)),
x AS (SELECT *, len(w) AS n, row_number() OVER (PARTITION BY k, line ORDER BY i) > 1 AS again FROM (SELECT *, {words('line')} AS w FROM l) WHERE len(w) > 0),
f AS (SELECT k, again, length(array_to_string(w, '')) AS size, again OR {having('^[|<>«»›‹•·/]+$')} >= {rules.separators}
      OR {having('[#*$%&|<>]')} > greatest(1, {rules.most_symbol_words} * n) OR {having('[!?]{2,}$')} > greatest(1, {rules.most_shouts} * n)
      OR (n >= {rules.upper_words} AND line <> lower(line) AND len(regexp_extract_all(line, '\\p{{Lu}}')) > {rules.most_upper} * len(regexp_extract_all(line, '\\p{{L}}')))
      OR (n >= {rules.unpunctuated_words} AND NOT regexp_matches(line, '{_STOP.pattern}')) OR (n <= {rules.furniture_words} AND regexp_matches(lower(line), '{FURNITURE.pattern}')) AS fault FROM x),
g AS (SELECT k, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(size) FILTER (fault), 0) AS lost_chars FROM f GROUP BY k),
c AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost_chars, 0)::BIGINT AS lost_chars FROM t LEFT JOIN r USING (k) LEFT JOIN g USING (k)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND lost_chars <= {rules.most_lost} * word_chars AS kept FROM b
"""


ORACLE_SQL = _sql()
