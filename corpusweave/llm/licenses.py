"""License scans: sentences of licences are recognised one by one, and their sequence by ordered rules."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm.common import by_slices, id_text, table

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    "mit-name": ["MIT License", "The MIT License (MIT)", "Released under the MIT License", "Licensed under the MIT License", "This software is released under the MIT License"],
    "mit-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions'],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "asis": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'],
    "apache-2": ["Licensed under the Apache License, Version 2.0", "Apache License, Version 2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License'],
    "apache-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "gpl-3": ["GNU General Public License, version 3", "This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3", "This file is licensed under the GNU General Public License, version 3", "Released under the GNU General Public License, version 3", "This program is licensed under the GNU General Public License, version 3"],
    "gpl-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-asis": [f'THIS SOFTWARE IS PROVIDED BY {who} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED' for who in ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDER AND CONTRIBUTORS", "THE REGENTS AND CONTRIBUTORS", "THE AUTHOR AND CONTRIBUTORS")],
    "isc-grant": [f"Permission to use, copy, modify, {w} distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies" for w in ("and/or", "and")],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "mpl-2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0", "Mozilla Public License, version 2.0"],
    "gpl-2-later": [f"This program is free software{c} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version" for c in ";:"],
    "lgpl-2.1-later": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"],
    "lgpl-3-later": [f"This {w} is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version" for w in ("program", "library")],
    "agpl-3-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "apache-2-text": ["Apache License Version 2.0, January 2004"],
    "gpl-2-text": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "gpl-3-text": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "lgpl-2.1-text": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "lgpl-3-text": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "agpl-3-text": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "cc-by-nc-4": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-4": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc0": ["Licensed under CC0 1.0", "This work is dedicated to the public domain under CC0 1.0"],
    "reserved": ["All rights reserved"],
}
#: A clause with a name in it: how it begins and ends.
NAMED = {"bsd-names": ("Neither the name of", "contributors may be used to endorse or promote products derived from this software without specific prior written permission")}
#: Rules in order: the licence that an ordered run of sentence identifiers stands for; longer runs come first.
RULES = [
    ("MIT", ["mit-name", "mit-grant", "mit-notice", "asis"]), ("MIT", ["mit-grant", "mit-notice", "asis"]), ("MIT", ["mit-grant", "mit-notice"]), ("MIT", ["mit-grant"]), ("MIT", ["mit-name"]),
    ("Apache-2.0", ["apache-2", "apache-copy"]), ("Apache-2.0", ["apache-2"]), ("GPL-3.0-or-later", ["gpl-later"]), ("GPL-3.0-only", ["gpl-3"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-asis"]), ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-asis"]), ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("ISC", ["isc-grant"]), ("Unlicense", ["unlicense"]), ("MPL-2.0", ["mpl-2"]), ("GPL-2.0-or-later", ["gpl-2-later"]), ("LGPL-2.1-or-later", ["lgpl-2.1-later"]), ("LGPL-3.0-or-later", ["lgpl-3-later"]), ("AGPL-3.0-or-later", ["agpl-3-later"]),
    ("Apache-2.0", ["apache-2-text"]), ("GPL-2.0-only", ["gpl-2-text"]), ("GPL-3.0-only", ["gpl-3-text"]), ("LGPL-2.1-only", ["lgpl-2.1-text"]), ("LGPL-3.0-only", ["lgpl-3-text"]), ("AGPL-3.0-only", ["agpl-3-text"]), ("CC-BY-NC-4.0", ["cc-by-nc-4"]), ("CC-BY-4.0", ["cc-by-4"]), ("CC0-1.0", ["cc0"]), ("proprietary", ["reserved"]),
]
# Names of public licences in normalised form, with the versions they come in; {} stands for one of them.
NAMES = {
    "MIT": (r"mit(?: license)?", [""]), "ISC": (r"isc license", [""]), "Zlib": (r"zlib license", [""]), "Unlicense": (r"unlicense", [""]), "0BSD": (r"0bsd|zero clause bsd license", [""]),
    "Apache-{}": (r"apache(?: software)?(?: license)?{}(?: license)?", ["2.0"]), "MPL-{}": (r"(?:mozilla public license|mpl){}", ["1.1", "2.0"]), "EPL-{}": (r"(?:eclipse public license|epl){}", ["1.0", "2.0"]),
    "BSL-{}": (r"boost software license{}", ["1.0"]), "CDDL-{}": (r"(?:common development and distribution license|cddl)(?: cddl)?{}", ["1.0", "1.1"]), "Artistic-{}": (r"artistic license{}", ["1.0", "2.0"]),
    "EUPL-{}": (r"(?:european union public licence|eupl){}", ["1.1", "1.2"]), "BSD-{}-Clause": (r"bsd{} clause(?: license)?|(?:the )?{} clause bsd(?: license)?", ["2", "3"]),
}
# The licences with 'or later' forms, and their versions.
GNU = {"GPL": ("general public license", ["1.0", "2.0", "3.0"]), "LGPL": ("lesser general public license", ["2.1", "3.0"]), "AGPL": ("affero general public license", ["3.0"])}
# The parts of the public licences of Creative Commons, short and in words.
CREATIVE = {"BY": "attribution", "NC": "noncommercial", "SA": "sharealike", "ND": "noderivatives"}
#: What stands before or after a licence's name where it says that something is under that licence.
_BEFORE = r"(?<!not )\b(?:licensed|licenced|released|distributed|redistributed|available|published|provided|covered|is|are|be)(?: \w+)? (?:under|by)|\bsubject to|\bunder the terms|\bsee"
_AFTER = r"licensed|licenced"
_HINT = re.compile(r"licen[sc]e|GPL|\bCC[ -]BY|\bCC0|\bBSD\b|\bMPL\b|\bEU?PL\b|\bCDDL\b|apache|permission|redistribut|copyright notice|software is provided|rights reserved|public domain|free software", re.I)
#: Other sentences that may stand between two of a rule's. The name of a licence counts to the text only next to it.
MOST_BETWEEN = 3
_NEXT_TO = frozenset(["mit-name"])
#: Signs of comments and of indents, then a list's number or bullet, before a line; signs of comments after it.
_PREFIX = re.compile(r"^[ \t]*(?:(?:<!--|/\*+|\*+/?|//+[!/]?|#+|;+|--+|%+|>+|dnl\b|(?i:rem)\b)[ \t]*)?(?:\(?(?:[0-9]{1,2}|[a-z])[.)][ \t]+|[-*•][ \t]+)?", re.M)
_SUFFIX = re.compile(r"[ \t]*(?:\*+/|-->)[ \t]*$", re.M)
_END = re.compile(r"(?<=[.!?])\s+|\n+")


#: A line that names licences by identifiers: one, then any number joined by AND or OR; an exception after WITH is no licence.
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*(\(*[A-Za-z0-9][\w.+-]*\)*(?:[ \t]+(?:AND|OR|WITH|and|or|with)[ \t]+\(*[A-Za-z0-9][\w.+-]*\)*)*)")
_OPERAND = re.compile(r"(?:(?:^|[ \t])(with|and|or)[ \t]+)?\(*([A-Za-z0-9][\w.+-]*)\)*", re.I)


def _spdx(expression: str) -> list[str]:
    return [m[2] for m in _OPERAND.finditer(expression) if (m[1] or "").lower() != "with"]


def normalised(sentence: str) -> str:
    """Lower case, letters and digits only, single blanks; points inside numbers stay."""
    return " ".join(re.sub(r"(?<![0-9])\.|\.(?![0-9])|[^\w.]|_", " ", sentence.lower()).split())


KNOWN = {normalised(s): k for k, forms in SENTENCES.items() for s in forms}


#: All beginnings of known sentences, word by word.
_BEGUN = {" ".join(w[:n]) for w in map(str.split, KNOWN) for n in range(1, len(w) + 1)}
_NAMED = {k: (normalised(a), normalised(b)) for k, (a, b) in NAMED.items()}
_NAMED_LENGTH = 600


def _named(sentence: str) -> tuple[str, bool]:
    """The clause of NAMED that a sentence is, and whether it may become one."""
    for k, (first, last) in _NAMED.items():
        if sentence.startswith(first) and len(sentence) <= _NAMED_LENGTH:
            return (k if sentence.endswith(last) else ""), True
    return "", False


def _names() -> dict[str, str]:
    """Patterns of the names in normalised sentences, by identifier."""
    number = lambda v: rf" ?(?:version |v ?)?{re.escape(v.removesuffix('.0'))}" + (r"(?:\.0)?" if v.endswith(".0") else "") + r"(?![.\d])" if v else ""
    out = {}
    for name, (form, versions) in NAMES.items():
        for v in versions:
            clause = name.startswith("BSD")
            out[name.format(v)] = form.replace("bsd{}", f"bsd {v}").replace("{}", v) if clause else form.replace("{}", number(v))
    for name, (words, versions) in GNU.items():
        for v in versions:
            plain = rf"(?:gnu )?(?:{words}|{name.lower()})(?: {name.lower()})?{number(v)}"
            out[f"{name}-{v}-or-later"] = rf"{plain}(?: license)? or (?:at your option )?(?:any )?(?:later|newer)(?: versions?)?"
            out[f"{name}-{v}-only"] = plain
    for parts in ("BY-NC-SA", "BY-NC-ND", "BY-NC", "BY-SA", "BY-ND", "BY"):
        short, long = (" ".join(f(x) for x in parts.split("-")) for f in (str.lower, CREATIVE.get))
        for v in ("4.0", "3.0", "2.5", "2.0"):
            out[f"CC-{parts}-{v}"] = rf"(?:creative commons )?(?:cc {short}|(?:cc )?{long})(?: license)?{number(v)}(?: (?:international|unported|generic))?(?: license)?"
    out["CC0-1.0"] = rf"(?:creative commons )?cc0{number('1.0')}(?: universal)?"
    return out


_NAMES = _names()
_NUMBERED = list(_NAMES)
_ANY = "|".join(f"(?P<n{k}>{_NAMES[name]})" for k, name in enumerate(_NUMBERED))
_NAME = re.compile(rf"(?:the |a |an )?(?:{_ANY})\b")
_STATED = re.compile(rf"(?:{_BEFORE})(?: (?:the )?(?:terms of|conditions of|terms and conditions of|of))*(?: (?:either|both))? (?=(?:the |a |an |gnu |creative )?\w)")
_LINKED = re.compile(r" (?:and|or|and or)(?: under)? ")
#: Holds in every sentence with a name.
_SOME_NAME = re.compile(r"licen[sc]e|gpl|creative commons|\b(?:cc0?|mpl|epl|eupl|cddl|apache|bsd|0bsd|mit)")
_IS_A_NAME = re.compile(rf"(?:the )?(?:{_ANY})(?: license)?")
_ADJECTIVE = re.compile(rf"\b(?:{_ANY}) (?:{_AFTER})\b")


def notices(sentence: str) -> list[str]:
    """The licences that a normalised sentence says something is under: it is a licence's name, or holds one after words such as 'licensed
    under', with more names joined by 'and' or 'or', or before 'licensed'. A name beside other words is none, nor is one after 'not'."""
    if not _SOME_NAME.search(sentence):
        return []
    which = lambda m: _NUMBERED[int(next(k for k, v in m.groupdict().items() if v is not None)[1:])]
    if (m := _IS_A_NAME.fullmatch(sentence)) and sentence != "mit":
        return [which(m)]
    out = [(m.start(), which(m)) for m in _ADJECTIVE.finditer(sentence) if not sentence.endswith(("not ", "not a "), 0, m.start())]
    for stated in _STATED.finditer(sentence):
        at = stated.end()
        while m := _NAME.match(sentence, at):
            out.append((at, which(m)))
            link = _LINKED.match(sentence, m.end())
            at = link.end() if link else len(sentence)
    return list(dict.fromkeys(name for _, name in sorted(out)))


def sentences(text: str) -> list[str]:
    """The known sentences' identifiers in order of appearance, '' for any other sentence, 'spdx:' and the identifier for each licence of
    an SPDX line, 'name:' and the identifier for each licence that another sentence names as one that holds. A sentence may run over line ends, comment
    signs and full stops inside it: the longest run of pieces that is a known sentence counts."""
    text = _PREFIX.sub("", _SUFFIX.sub("", text))
    text = re.sub(r"(?i)\b(v)\.\s+(?=\d)", r"\1 ", text)  # the point of 'v. 2.0' ends no sentence
    text = re.sub(r"(?m)^(?!.*SPDX)(.*?\b[AL]?GPL[ -]?v?[0-9.]+)\+", r"\1 or later", text)
    text = re.sub(r"(SPDX-License-Identifier:[^\n]*\n)", r"\1\n", text)  # an SPDX line goes on to no other
    flat = re.sub(r"[ \t\r\f\v]*\n(?=[a-z(])", " ", text)
    pieces = []
    for s in _END.split(flat):
        spdx = _SPDX.search(s)
        pieces += [x for x in [normalised(s[: spdx.start()] if spdx else s)] if x]
        pieces += [f"spdx:{name}" for name in (_spdx(spdx[1]) if spdx else [])]  # no normalised sentence holds a colon
    out, at = [], 0
    while at < len(pieces):
        if pieces[at].startswith("spdx:"):
            out.append(pieces[at])
            at += 1
            continue
        found, size, joined = "", 1, ""
        for n, piece in enumerate(pieces[at:], 1) if pieces[at] in _BEGUN or _named(pieces[at])[1] else [(1, pieces[at])]:
            joined = f"{joined} {piece}".lstrip()
            named, more = _named(joined)
            if known := KNOWN.get(joined) or named:
                found, size = known, n
            if joined not in _BEGUN and not more:
                break
        out += [found] if found else [f"name:{name}" for name in notices(pieces[at])] or [""]
        at += size
    return out


def _matched(ids: list[str], at: int, run: list[str]) -> int:
    """Where a rule's sentences end if they begin at a place, with at most MOST_BETWEEN others between two of them; 0: they don't."""
    for k, want in enumerate(run):
        most = 0 if k == 0 or run[k - 1] in _NEXT_TO else MOST_BETWEEN
        between = 0
        while at < len(ids) and not ids[at] and between < most:
            at, between = at + 1, between + 1
        if at >= len(ids) or ids[at] != want:
            return 0
        at += 1
    return at


def scan(text: str | None) -> list[tuple[str, list[str]]]:
    """Licences found, with their sentence identifiers, from left to right without overlaps. A few other sentences may stand between two
    of a rule's, but a copyright line after a licence's name makes the name a find of its own."""
    if not text or not _HINT.search(text):
        return []
    ids, out, at = sentences(text), [], 0
    while at < len(ids):
        if ids[at].startswith(("spdx:", "name:")):
            rule, end = (ids[at][5:], [ids[at]]), at + 1
        else:
            rule, end = next(((r, e) for r in RULES if ids[at] and (e := _matched(ids, at, r[1]))), (None, 0))
        if rule:
            out.append(rule)
        at = end or at + 1
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """licenses (each once, in order of first appearance) and sentence_ids of every whole document; one row for each input row.

    Null or empty text: none. Null id and repeated rows: kept. Empty input: no rows.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan(t) for t in part.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([list(dict.fromkeys(n for n, _ in f)) for f in found], pa.list_(pa.string())), pa.array([[i for _, r in f for i in r] for f in found], pa.list_(pa.string()))],
            ["doc_id", "licenses", "sentence_ids"],
        )

    docs = id_text(docs, id_col, text_col)
    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(by_slices(run), "doc_id long, licenses array<string>, sentence_ids array<string>")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.size("licenses").cast("long").alias("n_licenses"))


#: Sentence splitting and rule matching are tested on forms and planted sentences.
ORACLE_SQL = None
