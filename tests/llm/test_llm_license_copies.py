"""License notices side by side, whole and altered, are found one by one."""

import time

import numpy as np
import pyarrow as pa
import pytest

from gistlet.llm import licenses
from gistlet.llm.common import text_bytes


def finds(text, templates=licenses.TEMPLATES):
    data, offs = text_bytes(pa.array([text]))
    return sorted((a, b, name) for _, name, _, a, b in licenses.Scanner(templates, licenses.COVERAGE).rows(data, offs))


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
@pytest.mark.parametrize("copies", [1, 2, 50])
def test_copies_side_by_side_are_counted(name, copies):
    n = len(licenses.words_of(licenses.TEMPLATES[name]))
    assert finds(" ".join([licenses.TEMPLATES[name]] * copies)) == [(i * n, i * n + n, name) for i in range(copies)]


def test_a_line_repeated_often_is_found_each_time():
    began = time.time()
    assert len(finds("Released under the MIT License.\n" * 1000)) == 1000
    assert len(finds((licenses.TEMPLATES["MIT-notice"] + "\n") * 300)) == 300
    assert time.time() - began < 20


def test_words_around_copies_do_not_hide_them():
    text = "the license released under the mit license released under the mit license under the terms"
    assert finds(text) == [(2, 7, "MIT"), (7, 12, "MIT")]


@pytest.mark.parametrize("name", ["Apache-2.0-notice", "GPL-3.0-notice", "MIT-notice"])
def test_altered_copies_side_by_side(name):
    rng = np.random.default_rng(4)
    words = licenses.TEMPLATES[name].split()
    lost = 0
    for _ in range(60):
        parts = []
        for _ in range(2):
            own = [w for w in words if rng.random() > 0.06]
            own[3] = "changed"
            parts.append(" ".join(own))
        # the wording alone, under a name without deciding phrases, which an altered copy may have lost
        lost += len(finds("\n".join(parts), {"wording": licenses.TEMPLATES[name]})) != 2
    assert lost <= 1


COMMON = ["AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0",
          "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense"]


@pytest.mark.parametrize("license", COMMON)
def test_common_licenses_are_found_by_their_own_name(license):
    own = [k for k in licenses.TEMPLATES if k.startswith(license)]
    assert own
    for k in own:
        found = finds(f"Some words before the text. {licenses.TEMPLATES[k]} And more of the software after it.")
        assert [f[2] for f in found] == [k]


@pytest.mark.parametrize("line", [
    "Licensed under the Apache License", "Licensed under the Zlib License", "Licensed under the Artistic License 2.0",
    "Licensed under the Apache License, Version 1.1.", "Released under the BSD License.", "Released under the terms of the license",
    "GNU GPL, version 1", "This work is licensed under the GNU General Public License, version 1.",
    "This work is licensed under a Creative Commons Attribution 3.0 International License.", "Licensed under CC BY 3.0.",
    "Released under the Apache License, not the MIT License", "SPDX-License-Identifier: MIT-0", "SPDX-License-Identifier: BSD-2-Clause-Patent",
    "Attribution 3.0", "This is licensed as the license of the work says", "Licensed under the MIT No Attribution License",
    licenses._gnu("GNU Library General Public License", "2"),
])
def test_no_false_names(line):
    assert finds(line) == [] and finds(f"{line}\n{line}") == []


@pytest.mark.parametrize("line, name", [
    ("Licensed under CC BY 4.0.", "CC-BY-4.0-short"), ("Licensed under CC BY-ND 4.0", "CC-BY-ND-4.0-short"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND-4.0"),
    (licenses._gnu("GNU Lesser General Public License", "3"), "LGPL-3.0-grant"),
    ("Released under the terms of the MIT License", "MIT"),
    ("This work is licensed under the GNU General Public License, version 3 or later", "GPL-3.0"),
])
def test_near_wordings_get_their_own_name(line, name):
    assert [f[2] for f in finds(line)] == [name]


def family(name):
    for kind in ("-notice", "-spdx", "-short", "-long", "-licensed", "-grant"):
        name = name.removesuffix(kind)
    return name


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_each_template_against_all_others(name):
    """A template's wording is found by no template of another license."""
    others = {k: t for k, t in licenses.TEMPLATES.items() if family(k) != family(name)}
    assert finds(licenses.TEMPLATES[name], others) == []


def test_scan_of_short_texts_against_every_window():
    """A short template is found where some window holds its words in order, no more than twice its length apart."""
    rng = np.random.default_rng(5)
    words = ["released", "under", "the", "mit", "license", "terms", "bsd"]
    template = ["released", "under", "the", "mit", "license"]

    def in_order(window):
        at = 0
        for i, w in enumerate(window):
            if w == template[at] and (w != "mit" or window[i + 1:i + 2] == ["license"]):
                at += 1
                if at == len(template):
                    return True
        return False

    found = 0
    for _ in range(2000):
        text = [w for w in template if rng.random() < 0.95]
        for _ in range(rng.integers(0, 4)):
            text.insert(int(rng.integers(0, len(text) + 1)), str(rng.choice(words)))
        want = "bsd" not in text and in_order(text)
        got = finds(" ".join(text), {"MIT": licenses.TEMPLATES["MIT"]})
        if got:
            assert "bsd" not in text[got[0][0]:]
            assert in_order(text)
            found += 1
        else:
            # patience aligns on words that stand once: only repeats can hide an order
            assert not want or len(set(text)) < len(text)
    assert found > 20
