from __future__ import annotations

import random
from collections import Counter

from conftest import SF

from corpusweave.llm import chat, licenses

SCHEMA = "conv_id long, turn long, role string, text string, part int, one string, position string, conv string"


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b", "c") for r in rows], SCHEMA).repartition(3)


def brute(rows):
    """(conv_id, position, role, text) of conversations that begin no longer one, of equal ones the smallest id's."""
    by = {}
    for c, t, r, x in set(rows):
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    whole = {c: [v[1:] for v in sorted(v)] for c, v in by.items()}
    kept = []
    for c, v in whole.items():
        same = [d for d, w in whole.items() if w == v]
        if not any(len(w) > len(v) and w[: len(v)] == v for w in whole.values()) and c == min(same, key=lambda d: (d is None, d or 0)):
            kept += [(c, i + 1, *t) for i, t in enumerate(v)]
    return Counter(kept)


def test_collapse(spark):
    rng = random.Random(4)
    rows = []
    for c in range(80):
        base = random.Random(c % 7)
        script = [(t, "user" if t % 2 == 0 else "assistant", f"m{base.randrange(3)}") for t in range(8)]
        rows += [(c, *x) for x in script[: rng.randrange(1, 9)]]
    rows += [(100, 0, "user", "hi"), (100, 0, "user", "hi"), (101, 0, None, None), (102, 0, "", ""), (None, 0, "user", "m"), (None, None, "user", "first"), (103, 0, "user", "a"), (103, 0, "user", "b")]
    got = chat.collapse(make(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == brute(rows)
    assert chat.collapse(make(spark, rows).limit(0)).collect() == []
    text = {r.position: r.rendered for r in chat.render(chat.collapse(make(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b")]))).collect()}
    assert text[1] + text[2] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"


def test_chat_query(spark):
    import duckdb

    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    cols = "conv_id, position, role, md5, n_chars"
    want = Counter(duckdb.sql(f"SELECT {cols} FROM ({chat.ORACLE_SQL})").fetchall())
    assert Counter(tuple(r) for r in chat.op3_chat_formatting(spark, SF).select(*cols.split(", ")).collect()) == want


MIT = "\n".join(s[-1] if k == "mit-name" else s[0] for k, s in licenses.SENTENCES.items() if k in ("mit-grant", "mit-notice", "asis"))


def test_license_rules():
    names = lambda t: [n for n, _ in licenses.scan(t)]
    assert names("MIT License\nCopyright (c) 2020 X\n" + MIT.replace("Software, and", "Software,\nand")) == ["MIT", "MIT"]
    assert licenses.scan(MIT) == [("MIT", ["mit-grant", "mit-notice", "asis"])]
    assert names("Some text. Licensed under the Apache License, Version 2.0.\nMore.") == ["Apache-2.0"]
    assert names("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0-only"] and names("LICENSED   under CC BY-NC 4.0") == ["CC-BY-NC-4.0"]
    assert names("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.") == ["GPL-3.0-or-later"]
    assert names("Licensed under the Apache License, Version 1.1.") == names("the licence of poets") == names("") == names(None) == []


def test_license_rows(spark, frame, odd_texts):
    rows = [*odd_texts, (50, "Released under the MIT License.\nx. Licensed under CC BY-NC 4.0. Released under the MIT License.")]
    out = licenses.scan_licenses(frame(rows)).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows)
    assert [(r.licenses, r.sentence_ids) for r in out if r.licenses] == [(["MIT", "CC-BY-NC-4.0"], ["mit-name", "cc-by-nc-4", "mit-name"])]
    assert licenses.scan_licenses(frame(rows).limit(0)).collect() == []


def test_license_query_same_as_plain_search(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    plain = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "All rights reserved": "proprietary"}
    for r in licenses.op6_license_scan(spark, SF).collect():
        assert set(filter(None, r.licenses.split(","))) == {n for s, n in plain.items() if s in texts[r.doc_id]}
