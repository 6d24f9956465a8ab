"""Insults spelled out with blanks or other characters between their letters."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from conftest import SF

from corpusweave.llm import toxicity


@pytest.fixture(scope="module")
def restorer():
    texts = [r[0] or "" for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()]
    n = len(toxicity.ALPHABET)
    s = toxicity._classes()[np.minimum(np.frombuffer(" ".join(texts).encode("utf-32-le"), np.uint32), 65535)].astype(int)
    return toxicity.Restorer(toxicity.CharModel(np.bincount((s[:-2] * n + s[1:-1]) * n + s[2:], minlength=n**3)))


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("you are a m o r o n", "moron"), ("y o u a r e s u c h a n i d i o t", "idiot"), ("such an i  d\ti\no  t", "idiot"), ("i - d - i - o - t", "idiot"), ("an i.d.i.o.t", "idiot"),
        ("w e a l l t h i n k t h a t y o u a r e a t o t a l i d i o t a n d m o r e", "idiot"), (".".join("everybodyknowsverywellthatyouarejustanidiotandnothing"), "idiot"),
    ],
)
def test_spelled_out(restorer, text, word):
    assert word in restorer.words(text)


def test_no_long_words_from_plain_lists(restorer):
    assert not {"idiot", "moron"} & restorer.words("a b c d e and 1 2 3 4 5 6 of c l a s s i c")


@pytest.mark.parametrize("word", ["incomprehensible", "worthlessnesses", "disgusting"])
@pytest.mark.parametrize("times", [3, 9])
def test_long_words_drawn_out(restorer, word, times):
    """A word is as long as it is meant to be, not as it is written."""
    assert word in restorer.words(f"you are {''.join(c * times for c in word)} !")
    if word in restorer.words(" ".join(word)):
        assert word in restorer.words(" ".join(c for x in word for c in x * times))


def test_apart_same_as_all_readings(restorer):
    """The likeliest reading of every beginning is that of plain enumeration."""
    import itertools

    logp, at = restorer.logp, toxicity._INDEX
    for seen in ("1d10t", "x1v$a", "m0r0n", "5h17"):
        options = [[(m, -1.5 if c.isalpha() else -0.4) for m in toxicity.MEANT.get(c, "")] + ([(c, -0.1)] if c.isalpha() else []) for c in seen]
        for n, found in enumerate(restorer.starting(seen, 0), 1):
            every = []
            for reading in itertools.product(*options[:n]):
                a = b = 0
                score = 0.0
                for m, cost in reading:
                    z = at.get(m, toxicity._OTHER)
                    score, a, b = score + cost + logp[a][b][z], b, z
                every.append((score + logp[a][b][0], "".join(m for m, _ in reading)))
            best, word = max(found)
            assert word == max(every)[1] and best == pytest.approx(max(every)[0])


def test_gate_holds_the_pattern():
    rng = random.Random(2)
    for t in [*("".join(rng.choice("ab1*_. -~@$!") for _ in range(rng.randrange(3, 12))) for _ in range(20000)), "i d i o t", "i - d - i"]:
        t = " ".join(t.split())
        assert not toxicity._APART.search(t) or toxicity._HINT.search(t), t
