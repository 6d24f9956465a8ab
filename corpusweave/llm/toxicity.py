"""Toxicity: noisy-channel restoration of disguised words, then a lexicon learned from labels.

Tokens that look disguised (letters mixed with digits or symbols, single characters set apart, long runs of a letter) become a
lattice of the characters that may have been meant; Viterbi decoding under a trigram character model, counted over all
documents, finds the most likely word, and the text is scored with the restored words in it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm.common import by_slices, cut_lineage, id_text, slices, small_batches, table, tidied
from corpusweave.llm.labels import fold, training_sample

#: Labelled rows that the lexicon is learned from, about, at most.
FIT_ROWS = 50_000
#: Letters of a word that the lexicon may hold whole. A longer word has its beginnings as features.
MOST_LETTERS = 40
#: Symbols of the character model: word edge, letters, and one for all else.
ALPHABET = " abcdefghijklmnopqrstuvwxyzàáâäæçèéêëìíîïñòóôöœùúûüß\0"
#: What a written character may stand for besides itself.
MEANT = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l",
    "*": "aeiou", "#": "h", "%": "o", "&": "a", "v": "u", "x": "k", "к": "k", "а": "a", "е": "e", "о": "o", "с": "c", "і": "i",
}
_DISGUISE = "0-9@$!|+(€£*#%&каеосі"
_EDGE = ".,;:!?\"'()[]{}«»“”…|*#%&$-_~"
_LETTER = r"[^\W\d_]"
#: A written word with a disguised character beside a letter, or three of one letter in a row.
_DISGUISED = re.compile(rf"{_LETTER}[{_DISGUISE}]|[{_DISGUISE}]{_LETTER}|({_LETTER})\1\1")
_WRITTEN = re.compile(rf"(?<!\S)\S*?(?:{_LETTER}[{_DISGUISE}]|[{_DISGUISE}]{_LETTER}|({_LETTER})\1\1)\S*")
#: Where a written word may consist of several.
_INNER = re.compile(r"[-_./,;:~|\\…–—]+")
_DRAWN_OUT = re.compile(r"(.)\1{3,}")
#: As many runs of equal characters as a word that the lexicon holds whole may have, and one more.
_RUNS = re.compile(rf"(?:(.)\1*){{1,{MOST_LETTERS + 1}}}")
_BETWEEN = r"(?: [._\-*~/] |[ ._\-*~/])"
_ALONE = r"[\w@$!|+€*](?![^\W_]|[@$])"
_APART = re.compile(rf"(?<![^\W_])(?<![@$]){_ALONE}(?>(?:{_BETWEEN}{_ALONE}){{2,}})")
_NEXT = re.compile(rf"{_BETWEEN}({_ALONE})")
#: Holds wherever _APART does, in a text with single blanks (from its first separator on).
_HINT = re.compile(rf"[ ._\-*~/]{_ALONE}{_BETWEEN}{_ALONE}")
#: Readings kept for each pair of last symbols, and how far below the likeliest reading from its start on a word may lie.
READINGS, MARGIN = 8, 12.0
_INDEX = {c: i for i, c in enumerate(ALPHABET)}
_OTHER = len(ALPHABET) - 1


def _classes() -> np.ndarray:
    """The symbol of every code point of the basic plane after lower-casing."""
    out = np.full(1 << 16, _OTHER, np.uint8)
    for c in range(1 << 16):
        ch = chr(c)
        low = ch.lower()
        if ch.isspace():
            out[c] = 0
        elif low in _INDEX and low != "\0":
            out[c] = _INDEX[low]
    return out


@dataclass
class CharModel:
    """Interpolated trigrams over ALPHABET."""

    counts: np.ndarray  # trigrams
    logp: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = len(ALPHABET)
        c3 = self.counts.reshape(n, n, n).astype(float)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 1) / (c1.sum() + n)
        p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2) / (c3.sum(2, keepdims=True) + 5)
        self.logp = np.log(p3)

    def decode(self, seen: str, best: int = READINGS) -> list[str]:
        """The likeliest intended words for the written one, best first: list Viterbi over (last two symbols), one column for each run of equal
        characters; a run of a letter may stand for one or two of it."""
        logp, runs = self.logp, [m[0] for m in re.finditer(r"(.)\1*", seen)]
        paths: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
        for run in runs:
            c = run[0]
            options = [(c, -0.1)] if c.isalpha() else []
            options += [(m, -1.5 if c.isalpha() else -0.4) for m in MEANT.get(c, "")]
            if not options:
                options = [(c, -0.1)]
            forms = [(m * k, cost - (0.7 * (len(run) - k if len(run) < 3 else 0.3 * k))) for m, cost in options for k in range(1, min(len(run), 2) + 1)]
            new: dict[tuple[int, int], list[tuple[float, str]]] = {}
            for (a, b), found in paths.items():
                for form, cost in forms:
                    x, y, s = a, b, cost
                    for ch in form:
                        z = _INDEX.get(ch, _OTHER)
                        s += logp[x, y, z]
                        x, y = y, z
                    new.setdefault((x, y), []).extend((score + s, text + form) for score, text in found)
            paths = {k: sorted(v, reverse=True)[:best] for k, v in new.items()}
        ends = sorted(((s + logp[a, b, 0], t) for (a, b), found in paths.items() for s, t in found), reverse=True)
        return [t for _, t in ends[:best]]


def count_characters(docs: DataFrame, text_col: str = "text") -> CharModel:
    """Trigram counts over the whole texts of all documents; each task adds up its own before they are summed."""
    n = len(ALPHABET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, total = _classes(), np.zeros(n**3, np.int64)
        for part in slices(batches):
            points = np.frombuffer(" ".join(t or "" for t in part.column(0).to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
            s = kinds[np.minimum(points, (1 << 16) - 1)].astype(np.int64)
            if len(s) > 2:
                total += np.bincount((s[:-2] * n + s[1:-1]) * n + s[2:], minlength=n**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(tidied(run), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # at most n**3 rows
    counts = np.zeros(n**3, np.int64)
    counts[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return CharModel(counts)


class Restorer:
    """Words of a text, lower-cased and without outer punctuation, with restored ones beside the disguised."""

    def __init__(self, model: CharModel, remember: int = 200_000):
        self.model, self.remember, self.seen = model, remember, {}
        self.logp = model.logp.tolist()

    def word(self, written: str) -> list[str]:
        if (out := self.seen.get(written)) is None:
            if len(self.seen) >= self.remember:
                self.seen.clear()
            out = self.seen[written] = self.model.decode(written)
        return out

    def starting(self, seen: str, k: int) -> list[list[tuple[float, str]]]:
        """For each end from k + 1 on, the likeliest words of seen[k:end]: list Viterbi over (last two symbols). A run of equal characters may
        stand for one letter, so the ends reach over MOST_LETTERS runs."""
        logp, out, runs = self.logp, [], 0
        paths: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
        for i in range(k, len(seen)):
            c, again = seen[i], i > k and seen[i] == seen[i - 1]
            runs += not again
            if runs > MOST_LETTERS:
                break
            options = [(m, -1.5 if c.isalpha() else -0.4) for m in MEANT.get(c, "")]
            if c.isalpha() or not options:
                options.append((c, -0.1))
            new = {at: [(score - 0.7, text) for score, text in found] for at, found in paths.items()} if again else {}
            for (a, b), found in paths.items():
                for m, cost in options:
                    z = _INDEX.get(m, _OTHER)
                    cost += logp[a][b][z]
                    new.setdefault((b, z), []).extend((score + cost, text + m) for score, text in found)
            paths = {at: sorted(found, reverse=True)[:READINGS] if len(found) > READINGS else found for at, found in new.items()}
            out.append([(score + logp[a][b][0], text) for (a, b), found in paths.items() for score, text in found])
        return out

    def apart(self, seen: str) -> list[str]:
        """Words that characters set apart may spell: a word edge may stand between any two of them. At every start, every end is tried;
        those words stay with which the rest of the run reads not far less likely than at best."""
        key = "\0" + seen
        if (out := self.seen.get(key)) is None:
            if len(self.seen) >= self.remember:
                self.seen.clear()
            n = len(seen)
            after, kept = [-math.inf] * n + [0.0], {}
            for k in reversed(range(n)):
                found = [(s + after[j], t) for j, words in enumerate(self.starting(seen, k), k + 1) for s, t in words]
                after[k] = max(found)[0]
                kept.update((t, 0) for s, t in found if len(t) >= 3 and s >= after[k] - MARGIN)
            out = self.seen[key] = list(kept)
        return out

    def restored(self, low: str) -> list[str]:
        """Intended words of the disguised tokens of a lower-cased text: of each token and of its parts between hyphens and the like. Where
        more than MOST_LETTERS runs of equal characters follow each other, every reading has more letters than that, so only its beginnings are
        features, and only these are decoded."""
        out = []
        for written in {m[0] for m in _WRITTEN.finditer(low)}:
            s = written.strip("\"'([{<«“”")
            t = s.rstrip(_EDGE)
            forms = {t, *_INNER.split(t)}
            if len(s) == len(t) + 1:  # a last sign may stand for a letter
                forms.add(s)
            for x in forms | {_evenly(x) for x in forms}:
                x = _RUNS.match(_DRAWN_OUT.sub(r"\1\1\1", x))[0] if x else x  # runs say no more beyond three
                if len(x) < 3 or sum(map(str.isalpha, x)) * 3 < len(x):
                    continue
                if _DISGUISED.search(x):
                    out.extend(self.word(x))
                elif x not in forms:
                    out.append(x)
        return out

    def words(self, text: str | None) -> set[str]:
        tokens = (text or "").lower().split()
        out = {w.strip(_EDGE) for w in set(tokens)}
        flat = " ".join(tokens)
        if _HINT.search(flat):
            for m in _APART.finditer(flat):
                letters = _letters(m[0])
                for x in {letters, _evenly(letters)}:
                    out.update(self.apart(_DRAWN_OUT.sub(r"\1\1\1", x)))
        out.update(self.restored(flat))
        return out


def _letters(run: str) -> str:
    """The characters that a match of _APART sets apart."""
    return run[0] + "".join(m[1] for m in _NEXT.finditer(run, 1))


def _evenly(written: str) -> str:
    """The word of which each letter is written equally often, so that double letters stay double: the runs' lengths by their greatest common
    divisor."""
    if len(written) < 2 or written[0] != written[1]:
        return written
    times = math.gcd(*(len(m[0]) for m in re.finditer(r"(.)\1*", written)))
    return written[::times]


#: Lengths of word beginnings that are features beside whole words; a beginning carries a final *.
BEGINNINGS = (4, 5, 6)


def features(words: Iterable[str]) -> set[str]:
    long = {w for w in words if len(w) >= 3}
    return {w for w in long if len(w) <= MOST_LETTERS}.union(*({w[:n] + "*" for w in long if len(w) > n} for n in BEGINNINGS))


@dataclass
class Toxicity:
    """entries: probability that a text with that word or beginning is toxic. floor: of a text without any."""

    chars: CharModel
    entries: dict[str, float]
    floor: float

    def scorer(self):
        restorer = Restorer(self.chars)
        whole = {k: v for k, v in self.entries.items() if not k.endswith("*")}
        begin = [(n, {k[:-1]: v for k, v in self.entries.items() if k.endswith("*") and len(k) == n + 1}) for n in BEGINNINGS]

        def score(text: str | None) -> float:
            words = restorer.words(text)
            best = max((whole[w] for w in whole.keys() & words), default=self.floor)
            for n, known in begin:
                if known:
                    best = max(best, *(known[w] for w in known.keys() & {w[:n] for w in words if len(w) > n}), self.floor)
            return best

        return score


def _joined(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Texts and labels of the sample, whose size is bounded."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("text", "y")


def train(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, folds: int = 3, held: int = 1, label: str = "toxic") -> Toxicity:
    """Counts characters over all documents, then learns which words mark toxic texts from labelled rows whose fold isn't held out.

    First, documents with each word or beginning are counted by label; equal toxic texts count once. Then each toxic text is put down to
    its strongest candidate alone, so that of words that merely stand in copies of a toxic text one stays at most. Words stay that
    explain two texts or more, and beginnings whose own texts also outweigh the clean ones with them: those that owe their
    count to one word go.
    """
    docs = id_text(docs)
    chars = docs.sparkSession.sparkContext.broadcast(count_characters(docs))
    sample = training_sample(labels, label, fold(folds) != held, most).cache()
    known = sample.groupBy().agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic")).first()
    if not known.toxic:
        return Toxicity(chars.value, {}, 0.0)
    prior = known.toxic / known.n
    texts = _joined(docs, sample).withColumn("k", F.xxhash64("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of features with the clean texts that have them, and of each toxic text with each of its features."""
        restorer, clean, toxic = Restorer(chars.value), Counter(), []

        def told() -> pa.RecordBatch:
            rows = [*((f, n, None) for f, n in clean.items()), *toxic]
            clean.clear()
            toxic.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))], ["feature", "clean", "k"])

        for part in slices(batches):
            for text, y, k in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                found = features(restorer.words(text))
                if y > 0:
                    toxic.extend((f, 0, k) for f in found)
                else:
                    clean.update(found)
            if len(clean) + len(toxic) > 300_000:
                yield told()
        yield told()

    rows = cut_lineage(texts.select("text", "y", "k").mapInArrow(tidied(count), "feature string, clean long, k long"))
    counts = rows.groupBy("feature").agg(F.sum("clean").alias("c"), F.countDistinct("k").alias("t")).where("t >= 2")
    p, n = F.col("t") / (F.col("t") + F.col("c")), F.col("t") + F.col("c")
    z2 = 0.64
    low = (p + z2 / (2 * n) - F.sqrt(z2 * (p * (1 - p) + z2 / (4 * n)) / n)) / (1 + z2 / n)  # Wilson's lower bound at 0.8 deviations
    posterior = (F.col("t") + 0.5 * prior) / (F.col("t") + F.col("c") + 0.5)
    whole = ~F.col("feature").endswith("*")
    strength = F.struct(F.col("t") * F.log(posterior / prior) + F.col("c") * F.log((1 - posterior) / (1 - prior)), whole, F.length("feature"), "feature")
    able = cut_lineage(counts.where(low >= 0.7).select("feature", "c", posterior.alias("posterior"), strength.alias("strength")))
    wins = (
        rows.where("k IS NOT NULL").join(able, "feature").groupBy("k").agg(F.max_by("feature", "strength").alias("feature"))
        .groupBy("feature").agg(F.count(F.lit(1)).alias("wins")).where("wins >= 2")
    )
    best = wins.join(able, "feature").where(whole | (F.col("wins") >= 0.7 * (F.col("wins") + F.col("c")))).select("feature", "posterior").collect()  # at most half as many as toxic texts in the sample
    sample.unpersist()
    kept = {r.feature: r.posterior for r in best}
    return Toxicity(chars.value, kept, prior * 0.1)


def score(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Toxicity (0 to 1) of every whole document, one row for each input row.

    Null or empty text: the floor, well below any threshold. Null id and repeated rows: kept. Empty input: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by FIT_ROWS and the alphabet
    of = {}

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        fn = of.get(0) or of.setdefault(0, shared.value.scorer())
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([fn(t) for t in part.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    docs = id_text(docs, id_col, text_col)
    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(by_slices(run), "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Toxicity, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores below the threshold. Null and empty texts have the floor score and stay."""
    small_batches(docs.sparkSession)
    shared, at, of = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col), {}

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        fn = of.get(0) or of.setdefault(0, shared.value.scorer())
        return part.filter(pa.array([fn(t) < threshold for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(by_slices(run, text_col), docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside fold 1 of 3."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


#: SQL can't express it; held-out accuracy is tested.
ORACLE_SQL = None
