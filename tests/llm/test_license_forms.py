"""Licences as they stand in files: bullets, comments, wrapped lines."""

from __future__ import annotations

import pytest

from corpusweave.llm import licenses

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """
3. Neither the name of Example Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 */"""
GPL2 = "# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General\n# Public License as published by\n# the Free Software Foundation; either version 2 of the License, or\n# (at your option) any later version.\n"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (BSD, ["BSD-2-Clause"]), (BSD + NAMES, ["BSD-3-Clause"]), (APACHE, ["Apache-2.0"]), (GPL2, ["GPL-2.0-or-later"]),
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy", ["MPL-2.0"]), ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
        ("                                 Apache License\n                           Version 2.0, January 2004\n", ["Apache-2.0"]),
        ("    GNU GENERAL PUBLIC LICENSE\n       Version 3, 29 June 2007\n", ["GPL-3.0-only"]), (BSD.replace("2. Red", "An added line.\n2. Red"), ["BSD-2-Clause"]),
    ],
)
def test_forms(text, want):
    assert [n for n, _ in licenses.scan(text)] == want


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("SPDX-License-Identifier: MIT", ["MIT"]), ("SPDX-License-Identifier: GPL-2.0-or-later OR BSD-3-Clause", ["GPL-2.0-or-later", "BSD-3-Clause"]), ("SPDX-License-Identifier:", []),
        ("SPDX-License-Identifier: (MIT AND (LGPL-2.1+ OR Apache-2.0))", ["MIT", "LGPL-2.1+", "Apache-2.0"]), ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", ["GPL-2.0"]),
    ],
)
@pytest.mark.parametrize("form", ["{}", "# {}\nimport x", "// {}\nint x;", "/* {} */", " * {}\n(c) 2020 A", "Copyright A. {}"])
def test_spdx_lines(line, want, form):
    assert [n for n, _ in licenses.scan(form.format(line))] == want


def test_spdx_line_between_sentences():
    assert [n for n, _ in licenses.scan(f"SPDX-License-Identifier: ISC\n{APACHE}")] == ["ISC", "Apache-2.0"]
