"""Licences that sentences name."""

from __future__ import annotations

import pytest

from corpusweave.llm import licenses

SAID = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"], "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License"], "BSD-2-Clause": ["BSD 2-Clause License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"], "CC-BY-NC-ND-3.0": ["Creative Commons Attribution-NonCommercial-NoDerivatives 3.0 Unported License"],
    "EPL-2.0": ["Eclipse Public License - v 2.0", "Eclipse Public License 2.0"], "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, v. 2.0"], "BSL-1.0": ["Boost Software License - Version 1.0"],
    "GPL-3.0-only": ["GNU General Public License v3.0", "GPL v3", "GNU GPL version 3"], "GPL-2.0-or-later": ["GNU General Public License, version 2 or later", "GPL v2 or any later version", "GPLv2+"],
    "LGPL-2.1-only": ["GNU Lesser General Public License v2.1"], "AGPL-3.0-only": ["GNU Affero General Public License, version 3"], "MIT": ["MIT License"], "ISC": ["ISC License"], "EUPL-1.2": ["EUPL 1.2"],
}
FORMS = ["{}", "{}.", "See the {} for details.", "This project is licensed under the {}.", "The data are made available under the terms of the {}, and come as they are.", "Released under {}", "# This file is distributed under the {}.\nimport x"]


@pytest.mark.parametrize(("name", "said"), [(n, s) for n, forms in SAID.items() for s in forms])
def test_names_in_sentences(name, said):
    for form in FORMS:
        assert [n for n, _ in licenses.scan(f"Some words. {form.format(said)}")] == [name], form


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("This project is MIT licensed.", ["MIT"]), ("Dual licensed under the MIT License or the Apache License 2.0.", ["MIT", "Apache-2.0"]), ("This work is licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]),
        ("It is not licensed under the MIT License.", []), ("Students at MIT wrote about the license of a driver.", []), ("We compare the MIT License with others.", []), ("Apache 2.0 was a helicopter under review", []),
        ("The provided license under Version 2.0 of nothing.", []), ("MIT", []),
    ],
)
def test_what_is_said_of_names(text, want):
    assert [n for n, _ in licenses.scan(text)] == want
