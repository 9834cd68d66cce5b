import pathlib
import pkgutil
import re
import textwrap

import pytest

from terrane.llm import licences


def test_spelling_case_and_claims(spark, odd, none):
    known = licences.known(spark)
    mit = next(t for n, t in licences.KNOWN if n == "MIT")
    shouted = "Copyright 2001 Someone\n(c) Other\n" + mit.upper().replace("SUBLICENSE", "sub licence").replace("sub licence", "sublicense").replace(".", " ;").replace("\n", " \r\n")
    docs = spark.createDataFrame([
        (1, mit), (2, shouted), (3, mit + " more"), (4, "text\nreleased under the mit licence\nCopyright MIT License"),
        (5, "Licensed under CC BY-NC 4.0."), (6, None), (None, "Licensed under CC BY-NC 4.0."),
    ], "doc_id long, text string")
    got = {r.doc_id: (r.whole, r.notices) for r in licences.scan(docs, "doc_id", "text", known).collect()}
    assert got[1][0] == got[2][0] == ["MIT"]
    assert got[3] == ([], [])
    assert got[4] == ([], ["MIT"])
    assert got[5] == got[None] == (["CC-BY-NC-4.0"], ["CC-BY-NC-4.0"])
    assert got[6] == ([], [])
    assert licences.scan(odd, "doc_id", "text", known).count() == odd.count()
    assert licences.scan(none, "doc_id", "text", known).count() == 0
    assert all(r.whole == [] for r in licences.scan(docs, "doc_id", "text", known.limit(0)).collect())


def test_known_texts_have_digests_of_their_own():
    forms = {}
    for name, text in licences.KNOWN:
        whole, _ = licences.digests(text)
        assert whole
        assert forms.setdefault(whole, name) == name


def test_wraps_and_claims_make_no_difference():
    """MIT, ISC and BSD on one line, in other wraps, and behind claims that share their line."""
    usual = {
        "MIT": "COPYRIGHT HOLDERS BE", "ISC": "copyright notice and this permission notice appear", "BSD-3-Clause": "copyright holder nor the names",
    }
    for name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause"):
        body = next(t for n, t in licences.KNOWN if n == name)
        parts = [" ".join(p.split()) for p in body.split("\n\n")]
        expected, _ = licences.digests(body)
        assert "copyright holder" not in body.lower() or "copyright holder" in licences.canonical(body.lower())
        forms = [" ".join(parts), *("\n\n".join(textwrap.fill(p, w) for p in parts) for w in range(20, 130))]
        if name in usual:
            forms.append(" ".join(parts).replace(usual[name].strip(), "\n" + usual[name].strip()))
        forms.append(re.sub(r"(?i) (?=copyright)", "\n", body))
        for form in forms:
            for claim in (
                "", "Copyright (c) 2020 Jane Doe\n\n", "Copyright 2001-2003, 2020 Jane Q. Doe, Acme Inc. All rights reserved. ", "Copyright © Jane Doe ",
                "(c) Jane Doe\n", "Copyright (c) 2020 Jane Doe,\n  John Roe and\n  others\n", "Copyright (C) 2020\nThe Authors.\nAll rights\nreserved.\n\n",
            ):
                assert licences.digests(claim + form)[0] == expected, claim + form


def test_claims_end_with_their_sentence():
    released, _ = licences.digests("Released under the MIT License.")
    assert licences.digests("text\nCopyright 2020 Jane Doe. Released under the MIT License.")[1].count(released) == 1
    assert licences.canonical("(a) one\n(b) two\n(c) three of the list") == "a one b two c three of the list"
    assert licences.canonical("copyright owners keep what they own") == "copyright owners keep what they own"
    assert licences.digests("Copyright 2020 Someone\n(c) Other\nAll rights reserved.") == (None, [])


def test_whole_licences_notices_and_spdx_lines(spark):
    bundled = sorted(x.stem for x in (pathlib.Path(licences.__file__).parent / "known").glob("*.txt"))
    texts = {name: pkgutil.get_data("terrane.llm", f"known/{name}.txt").decode() for name in bundled}
    bsd = "\n".join(re.sub(r"^\d\.", " *", x) for x in next(t for n, t in licences.KNOWN if n == "BSD-3-Clause").split("\n"))
    said = {
        "# SPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0-or-later", "// SPDX-License-Identifier: EPL-2.0": "EPL-2.0",
        "This project is licensed under the Apache License 2.0.": "Apache-2.0", "Licensed under the Mozilla Public License, Version 2.0": "MPL-2.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    }
    rows = [*enumerate([*texts.values(), bsd]), *((100 + i, f"def f():\n{x}\nreturn 1") for i, x in enumerate(said))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.whole, r.notices) for r in licences.scan(docs, "doc_id", "text", licences.known(spark)).collect()}
    assert len(bundled) == 17
    assert [got[i][0] for i in range(len(bundled) + 1)] == [*([x] for x in bundled), ["BSD-3-Clause"]]
    assert [got[100 + i] for i in range(len(said))] == [([], [x]) for x in said.values()]


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "GFDL-1.3", "BSL-1.0", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense"])
def test_wraps_of_whole_licences(name):
    text = pkgutil.get_data("terrane.llm", f"known/{name}.txt").decode()
    parts = re.split(r"\n\s*\n", text.strip())
    expected, _ = licences.digests(text)
    assert licences.digests(" ".join(text.split()))[0] == expected
    for width in (40, 60, 79, 200):
        assert licences.digests("\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False) for p in parts))[0] == expected
