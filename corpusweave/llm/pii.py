"""Personal data: high-recall candidate spans, boosted trees over format and context, calibrated thresholds.

Spans of four kinds. The base patterns always count; the method adds spans written in ways that they miss: spelled-out
or bracketed e-mail addresses, spaced or bracketed IP addresses, cards with other separators, phone numbers without +.
"""

from __future__ import annotations

import hashlib
import random
import re
import warnings
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm.boosting import BoostedTrees, fit_platt, sigmoid
from corpusweave.llm.common import by_slices, id_text, small_batches, table

KINDS = ("email", "ip", "card", "phone")
#: Documents, chosen by a hash of their texts, whose spans the trees learn from, about; and of each of these, the spans of a kind and label at most.
FIT_DOCUMENTS, FIT_SPANS = 4000, 40
#: Candidates whose features are held at once.
BLOCK = 20_000
#: Of added spans, the least precision on held-out candidates that a kind's threshold must reach.
PRECISION = 0.98

#: Every base span and every candidate has one of these.
_SOME = re.compile(r"[0-9@]|\b(?:at|AT)\b", re.ASCII)
_AT_WORD = re.compile(r"\b(?:at|AT)\b", re.ASCII)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can't start inside a run of digits: at the run's first digit it would have been found or have failed alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]+", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from each @ in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _HOST.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by start and then kind; per kind leftmost and not overlapping."""
    out = [("email", s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40 and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=_order)


def _order(span: tuple) -> tuple:
    return span[1], KINDS.index(span[0]), span[2]


_AT = r"(?: ?[(\[{<] ?(?:at|AT|@) ?[)\]}>] ?| (?:at|AT) )"
_DOT = r"(?: ?[(\[{<] ?(?:dot|DOT|\.) ?[)\]}>] ?| (?:dot|DOT) |\.)"
_EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-])([A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}})(?:{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,126}}| ?@ ?[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,126}})(?![A-Za-z0-9-])"
)
#: An address may end before any of these after its second label. (Labels and their number are as long as addresses allow.)
_NEXT_LABEL = re.compile(rf"{_DOT}(?=[A-Za-z0-9-])")
#: Forms of the kinds made of digit groups; all lengths are bounded.
FORMS = {
    "ip": re.compile(r"[0-9]{1,3}(?: ?(?:\.|[(\[{] ?(?:\.|dot) ?[)\]}]) ?[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[\x20./ ·_-]{0,3}[0-9]){11,18}"),
    "phone": re.compile(r"(?:00|\+ ?)?[(]?[0-9](?:[\x20()./ -]{0,2}[0-9]){6,14}"),
}
#: Least and most digits of those kinds, and the most characters between two digit groups of any.
DIGITS = {"ip": (4, 12), "card": (12, 19), "phone": (7, 17)}
MOST_GAP = 9
_GROUP = re.compile(r"[0-9]+")
_ALNUM = frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_BEFORE_PHONE = re.compile(r"(?:\+ ?)?[(]?\Z")
_DIGITS_BEFORE = re.compile(r"([0-9]+)([\x20./ ·_()-]{1,3})\Z")
_DIGITS_AFTER = re.compile(r"([\x20./ ·_()-]{1,3})([0-9]+)")
#: Words before a span that speak for a kind.
CUES = {
    "email": re.compile(r"mail|contact|write|kontakt|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|addr|host|server|ping|from", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobile|cell|dial|t[ée]l[ée]fono", re.I),
}


def _email_candidates(text: str) -> Iterator[tuple[int, int]]:
    """From every local part, the longest address and those that end at an earlier label."""
    m = _EMAIL.search(text)
    while m:
        yield m.span()
        for label in _NEXT_LABEL.finditer(text, m.end(1), m.end()):
            if label.start() > m.end(1) and (n := _EMAIL.match(text, m.start(), label.start())) and n.end() == label.start():
                yield m.start(), label.start()
        m = _EMAIL.search(text, m.end(1))


def _number_candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """Every span from one digit group to another that has the form of a kind, each at most 19 groups long."""
    groups = [m.span() for m in _GROUP.finditer(text)]
    for first, (start, _) in enumerate(groups):
        if start and text[start - 1] in _ALNUM:
            continue
        head = _BEFORE_PHONE.search(text, max(0, start - 3), start).start()
        opened = start - (start > 0 and text[start - 1] == "(")
        n, last = 0, start
        for a, end in groups[first : first + 19]:
            n += end - a
            if a - last > MOST_GAP or n > 19:
                break
            last = end
            if n < 4 or text[end : end + 1] in _ALNUM:
                continue
            for kind, (least, most) in DIGITS.items():
                if least <= n <= most:
                    for begin in sorted({head, opened, start}) if kind == "phone" else (start,):
                        if FORMS[kind].fullmatch(text, begin, end):
                            yield kind, begin, end


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Proposed spans, which may overlap each other but no base span."""
    taken = _merged(taken)
    out = []
    if "@" in text or _AT_WORD.search(text):
        out += [("email", s, e) for s, e in _email_candidates(text) if _free(taken, s, e)]
    return out + [c for c in _number_candidates(text) if _free(taken, c[1], c[2])]


def _merged(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Places that the spans take, in order and without overlaps."""
    out = []
    for s, e in sorted(x[1:3] for x in spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _free(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """If no place of a list as from _merged overlaps the span."""
    k = bisect_right(taken, (start, end))
    return (k == 0 or taken[k - 1][1] <= start) and (k == len(taken) or taken[k][0] >= end)


def features(text: str, span: tuple[str, int, int]) -> list[float]:
    """Format and context of one candidate."""
    kind, start, end = span
    s = text[start:end]
    groups = [len(g) for g in re.findall(r"[0-9]+", s)]
    digits = digits_of(s)
    before, after = text[max(0, start - 24) : start], text[end : end + 12]
    parts = [int(g) for g in re.findall(r"[0-9]+", s)[:8] if len(g) < 10]
    hosts = re.split(r"[^A-Za-z0-9]+", s)
    tld = hosts[-1] if hosts else ""
    left, right = _DIGITS_BEFORE.search(before), _DIGITS_AFTER.match(after)
    inner = set(re.findall(r"(?<=[0-9])[^0-9]+(?=[0-9])", s))
    return [
        *(float(kind == k) for k in KINDS),
        len(s), len(digits), len(groups), max(groups, default=0), min(groups, default=0), groups[0] if groups else 0, groups[-1] if groups else 0,
        float(luhn(digits)) if 12 <= len(digits) <= 19 else 0.0,
        max(parts, default=0), float(len(set(digits)) <= 2),
        sum(c in "()" for c in s), s.count("-"), s.count("."), s.count(" "), s.count("/"), float("+" in s), float(s[:2] == "00"), float(s[:1] == "0"),
        float("@" in s), float(bool(re.search(r"[(\[{<] ?(?:at|AT|@|dot|DOT|\.)", s))), float(bool(re.search(r"\b(?:dot|DOT)\b", s))), float(bool(re.search(r" (?:at|AT) ", s))),
        len(tld) if tld.isalpha() else 0, float(any(c.isdigit() for c in s)), float("." in s and kind == "email"),
        float(before[-1:].isalnum()), float(before[-1:] in "$€£#%=\"'"), float(after[:1] in "%€$°\"'"), float(after[:1].isalnum()),
        float(bool(CUES[kind].search(before))), float(bool(re.search(r"version|v\.?$|no\.?$|nr\.?$|#|isbn|license", before.strip(), re.I))),
        len(left[1]) if left else 0, len(right[2]) if right else 0, float(bool(left and left[2] in inner)), float(bool(right and right[1] in inner)), len(inner), float(bool(_NEXT_LABEL.match(after))),
        float(bool(re.match(r"(?:1[89]|20)[0-9][0-9][-./]", s))), float(bool(re.search(r"[-./](?:1[89]|20)[0-9][0-9]$", s))),
    ]


_DATE = re.compile(r"(?:1[89]|20)[0-9]{2}([-./ ])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])([-./ ])(?:0?[1-9]|1[0-2])\2(?:1[89]|20)[0-9]{2}|(?:1[89]|20)[0-9]{2} ?[-/] ?(?:1[89]|20)[0-9]{2}")
_VERSION = re.compile(r"(?:\bversion|\bv\.?|\bisbn|\brelease)[\s:]*$", re.I)


def clearly_other(text: str, span: tuple[str, int, int]) -> bool:
    """If a candidate can't be of its kind: dates, versions, failed Luhn sums, parts of an address beyond 255, endings that are no word."""
    kind, start, end = span
    s, named = text[start:end], bool(_VERSION.search(text, max(0, start - 12), start))
    if kind == "card":
        return not luhn(digits_of(s))
    if kind == "ip":
        return named or any(int(g) > 255 for g in re.findall(r"[0-9]+", s))
    if kind == "phone":
        return named or bool(_DATE.fullmatch(s))
    return not re.search(r"(?<![A-Za-z0-9])[A-Za-z]{2,}\Z", s)


def _rewritings(kind: str, s: str, rng: random.Random) -> list[str]:
    """Other ways in which people write the personal data of a base span."""
    if kind == "email":
        user, host = s.split("@", 1)
        a, d = rng.choice([(" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot "), (" AT ", " DOT "), ("[at]", "[dot]"), (" @ ", ".")])
        if rng.random() < 0.5:  # base addresses may all hold digits, which must not become the mark of one
            user, host = re.sub("[0-9]", "", user) or user, re.sub("[0-9]", "", host)
        return [user + a + host.replace(".", d), f"{user} at {host.replace('.', ' dot ')}"]
    if kind == "ip":
        return [s.replace(".", rng.choice([" . ", "[.]", "(.)", "[dot]", ". "]))]
    digits = digits_of(s)
    if kind == "card":
        sep = rng.choice([".", "/", "  ", " ", " - ", "_"])
        return [sep.join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"00{digits}", f"00 {digits[:-10]} {a} {b} {c}", f"0{a} {b}{c}"])]


def _beside(near: list[tuple[str, str]], s: str, rng: random.Random) -> tuple[str, str, str]:
    before, after = rng.choice(near)
    mix = lambda t: re.sub("[0-9]", lambda _: rng.choice("0123456789"), t)
    return mix(before), s, mix(after)


def observed(text: str) -> list[tuple[str, str, str, str, int]]:
    """(kind, text before, span, text after, label) of a text's base spans (1) and of its candidates that are clearly something else (0), up to
    FIT_SPANS of each kind and label, spread evenly over the text. The other candidates have no label: they may be personal data that the
    base patterns miss."""
    base = base_spans(text)
    groups: dict[tuple[str, int], list] = {}
    for c in base:
        groups.setdefault((c[0], 1), []).append(c)
    for c in candidates(text, base):
        if clearly_other(text, c):
            groups.setdefault((c[0], 0), []).append(c)
    return [
        (k, text[max(0, s - 24) : s], text[s:e], text[e : e + 12], label)
        for (_, label), found in groups.items() for k, s, e in found[:: -(-len(found) // FIT_SPANS)]
    ]


def _examples(rows: list[tuple[str, str, str, str, int]], rng: random.Random) -> Iterator[tuple[str, tuple[str, int, int], int]]:
    """(text, candidate, label) from rows as of `observed`: rewritten personal data in its own context; look-alikes, corrupted data and other
    numbers."""
    def at(before: str, s: str, after: str, kind: str, label: int) -> Iterator[tuple[str, tuple[str, int, int], int]]:
        text = f"{before}{s}{after}"
        for k, i, j in candidates(text, []):
            inside, whole = i >= len(before) and j <= len(before) + len(s), j - i >= len(s) - 1
            if i < len(before) + len(s) and j > len(before):
                yield text, (k, i, j), int(label and k == kind and inside and whole)

    def pick(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def valid_card() -> str:
        head = rng.choice("3456") + pick(14)
        return next(head + c for c in "0123456789" if luhn(head + c))

    contexts, seeds = [("", ""), ("tel ", " "), ("of the ", " and the "), ("on ", ", in "), ("", "."), ("room 12 ", ""), ("", " 24 hours"), ("", " 12/26"), ("", " 123"), ("no. 7 ", " 3 x")], []
    for kind, before, span, after, label in rows:
        if label:
            seeds.append((before, kind, span, after))
        else:
            yield f"{before}{span}{after}", (kind, len(before), len(before) + len(span)), 0
    near, contexts = contexts[5:], contexts + [(b, a) for b, _, _, a in seeds[:400]]
    for i in range(600):
        b, a = contexts[rng.randrange(len(contexts))]
        host = f"{rng.choice(['mail', 'example', 'post', 'uni-x', 'mx.corp'])}{rng.choice(['', '', pick(1)])}.{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es', 'sk', 'info'])}"
        seeds.append((b, "email", f"{rng.choice(['anna', 'bob', 'j.doe', 'mk', 'x_y', 'info'])}{rng.choice(['', '', pick(2)])}@{host}", a))
        seeds.append((b, "ip", ".".join(str(rng.randrange(1, 256)) for _ in range(4)), a))
        seeds.append((b, "card", valid_card(), a))
        seeds.append((b, "phone", f"+{rng.choice(['1', '44', '49', '421'])} ({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{pick(4)}", a))
        for kind, s in (
            ("card", "4" + pick(15)), ("card", " ".join(pick(4) for _ in range(4))), ("ip", " . ".join(str(rng.randrange(200, 999)) for _ in range(4))),
            ("phone", f"{rng.randrange(1900, 2030)}-{pick(2)}-{pick(2)}"), ("phone", f"{pick(2)}.{pick(2)}.{rng.randrange(1900, 2030)}"), ("phone", pick(7)), ("phone", pick(rng.randrange(8, 16))),
            ("phone", f"{pick(3)} {pick(3)} {pick(3)}"), ("phone", f"{pick(2)} {pick(2)} {pick(2)} {pick(2)}"), ("phone", f"978-{pick(1)}-{pick(4)}-{pick(4)}-{pick(1)}"), ("phone", f"{rng.randrange(1900, 2030)}-{rng.randrange(1900, 2030)}"),
            ("phone", f"{pick(4)}-{pick(4)}-{pick(4)}"), ("email", rng.choice(["look at that. The", "was at home.and", "and at the.dot of", "the dot at a dot of the", "is at noon dot"])),
            ("email", f"{rng.choice(['the', 'of', 'him'])} at {rng.choice(['the', 'a', 'noon'])}.{rng.choice(['The', 'And', 'He', 'Then'])}"), ("ip", f"{pick(1)} . {pick(1)} . {pick(4)} . {pick(1)}"),
        ):
            if kind != "card" or not luhn(digits_of(s)):
                yield from at(b, s, a, kind, 0)
    for b, kind, s, a in seeds:
        for t in _rewritings(kind, s, rng):
            yield from at(b, t, a, kind, 1)
            if kind in ("card", "phone"):  # with another number beside it
                yield from at(*_beside(near, t, rng), kind, 1)
        if kind == "card":
            yield from at(*_beside(near, " ".join(digits_of(s)[i : i + 4] for i in range(0, len(digits_of(s)), 4)), rng), kind, 1)


@dataclass
class PiiModel:
    trees: BoostedTrees
    slope: float
    intercept: float
    thresholds: dict[str, float]  # above 1: the kind gets no added spans

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.trees.raw(x) + self.intercept)

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        """All spans of each text with their scores (1 for the base). Of accepted candidates that overlap, the best stays, of equal ones the longest."""
        out, todo, rows, good = [], [], [], []

        def judge() -> None:
            if rows:
                good.extend((k, c, p) for (k, c), p in zip(todo, self.scores(np.array(rows, float)), strict=True) if p >= self.thresholds[c[0]])
            todo.clear()
            rows.clear()

        for k, text in enumerate(texts):
            found = base_spans(text) if _SOME.search(text) else []
            out.append([(*s, 1.0) for s in found])
            if _SOME.search(text):
                for c in candidates(text, found):
                    todo.append((k, c))
                    rows.append(features(text, c))
                    if len(rows) >= BLOCK:
                        judge()
        judge()
        taken = {}
        for k, (kind, s, e), p in sorted(good, key=lambda x: (x[0], -x[2], x[1][1] - x[1][2], x[1][1])):
            if k not in taken:
                taken = {k: _merged([x[:3] for x in out[k]])}
            if _free(taken[k], s, e):
                insort(taken[k], (s, e))
                out[k].append((kind, s, e, min(float(p), 0.999999)))  # 1 marks the base
        return [sorted(x, key=_order) for x in out]


def fit(rows: list[tuple[str, str, str, str, int]], seed: int = 0) -> PiiModel:
    """Trees from two thirds of the examples; calibration and thresholds from the rest. rows: as of `observed`."""
    rng = random.Random(seed)
    made = list(_examples(rows, rng))
    rng.shuffle(made)
    x = np.array([features(t, s) for t, s, _ in made], float)
    y = np.array([label for _, _, label in made], float)
    held = np.arange(len(y)) % 3 == 0
    trees = BoostedTrees().fit(x[~held], y[~held])
    raw = trees.raw(x[held])
    slope, intercept = fit_platt(raw, y[held])
    p = sigmoid(slope * raw + intercept)
    thresholds = {}
    for k, kind in enumerate(KINDS):
        own = x[held][:, k] == 1
        q, label = p[own], y[held][own]
        order = np.argsort(-q, kind="stable")
        precision = np.cumsum(label[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(precision >= PRECISION)
        thresholds[kind] = max(0.5, float(q[order][good[-1]])) if len(good) else 2.0
        if not len(good):
            warnings.warn(f"{kind}: no threshold reaches a precision of {PRECISION} on held-out examples, so no such spans are added to the base", stacklevel=2)
    return PiiModel(trees, slope, intercept, thresholds)


def train(docs: DataFrame, most: int = FIT_DOCUMENTS) -> PiiModel:
    """A model from about `most` of the distinct texts with a digit or @ (a sample by a hash of the text, so the same rows always give the
    same model), whatever their length, and from generated examples. Of the sample's own candidates only those count, as negatives, that
    are clearly something else (clearly_other). To the driver go at most FIT_SPANS short snippets of each kind and label of a text."""
    h = F.xxhash64("text")
    able = docs.where(F.col("text").rlike("[0-9@]")).select("text")
    n = able.agg(F.approx_count_distinct(h)).first()[0]
    part = F.shiftrightunsigned(h, 11) * F.lit(2.0**-53)
    texts = able.where(part < most / max(n, 1)).distinct()

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [r for t in part.column(0).to_pylist() for r in observed(t)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if i == 4 else pa.string()) for i in range(5)], ["kind", "before", "span", "after", "label"])

    small_batches(docs.sparkSession)
    found = texts.mapInArrow(by_slices(run), "kind string, before string, span string, after string, label int").collect()
    return fit(sorted(map(tuple, found)))


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def redact(text: str, spans: list[tuple]) -> str:
    """The text with [EMAIL], [IP], [CARD] or [PHONE] in place of each run of overlapping spans (named by the first)."""
    out, done = [], 0
    for kind, s, e, *_ in spans:
        if s >= done:
            out.append(text[done:s] + f"[{kind.upper()}]")
        done = max(done, e)
    return "".join([*out, text[done:]])


def find(docs: DataFrame, model: PiiModel | None = None, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Spans (code points, end exclusive) of every whole document, and the redacted text if with_text. One row for each input row.

    Null text: no spans, redacted text null. Empty text: no spans. Null id and repeated rows: kept. Empty input: no rows.
    """
    docs = id_text(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(model or train(docs))  # of fixed size

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(1).to_pylist()
        found = model.value.spans([t or "" for t in texts])
        cols = [part.column(0), pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in x] for x in found], _SPAN_TYPE)]
        if with_text:
            cols.append(pa.array([t and redact(t, x) for t, x in zip(texts, found, strict=True)], pa.string()))
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "spans", "redacted"][: len(cols)])

    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(by_slices(run), f"doc_id long, spans {SPANS}" + ", redacted string" * with_text)


def redact_rows(docs: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """The rows with their texts redacted and all other columns as they are. Null and empty texts stay as they are."""
    small_batches(docs.sparkSession)
    model, schema = docs.sparkSession.sparkContext.broadcast(model), docs.schema
    at = docs.columns.index(text_col)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(at).to_pylist()
        new = [t and redact(t, x) for t, x in zip(texts, model.value.spans([t or "" for t in texts]), strict=True)]
        return part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))

    return docs.mapInArrow(by_slices(run, text_col), schema)


def listed(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)


def sha_of(spans: list[tuple]) -> str:
    return hashlib.sha256(listed(spans).encode()).hexdigest()


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = find(table(spark, sf_dir, "documents"), with_text=False)
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))
    base = F.filter("spans", lambda s: s.score == 1.0)

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
    )


#: SQL can't express the trained part; the base patterns have a brute-force version in the tests.
ORACLE_SQL = None
