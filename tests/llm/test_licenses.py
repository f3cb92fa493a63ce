from __future__ import annotations

import pytest

from eventloom.llm import licenses


def found(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    return {r.doc_id: ([f.id for f in r.found], r.licenses) for r in licenses.scan(docs).collect()}


def test_sentences_and_ordered_rules(spark):
    grant, copy = licenses.SENTENCES["apache-grant"], licenses.SENTENCES["apache-copy"]
    got = found(
        spark,
        [
            "Text.\nReleased  under the MIT license!\nmore",
            f"{grant} {copy}",
            f"{copy} {grant}",
            f"{grant} Other words here. {copy}",
            f"{grant} Released under the MIT License. {copy}",
            None,
            "",
            "Released under the MIT License. " * 20_000,
        ],
    )
    assert got[0] == (["mit-notice"], ["MIT"])
    assert got[1][1] == got[3][1] == ["Apache-2.0"]
    assert got[2][1] == [] and got[4][1] == ["MIT"]  # order and adjacency count
    assert got[5] == got[6] == ([], [])
    assert len(got[7][0]) == 20_000 and got[7][1] == ["MIT"]


def test_every_sentence_is_recognised(spark):
    got = found(spark, list(licenses.SENTENCES.values()))
    assert [ids for ids, _ in got.values()] == [[name] for name in licenses.SENTENCES]


def test_odd_rows_and_empty_table(odd, none):
    assert licenses.scan(odd).count() == odd.count()
    assert licenses.scan(none).count() == 0


def test_catalogue_size_is_checked(odd):
    with pytest.raises(ValueError):
        licenses.scan(odd, {str(i): f"s {i}" for i in range(licenses.MOST_SENTENCES + 1)}, ())


def test_wrapped_sentences(spark):
    mit = "The above copyright notice and this permission notice shall be included in\nall copies or substantial portions of the Software.\n"
    bsd = (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided "
        "that the following conditions are met:\n\n1. Redistributions of source code.\n\n3. Neither the name of the "
        "copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived "
        "from\n   this software without specific prior written permission.\n"
    )
    gpl = (
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General "
        "Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your "
        "option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT "
        "ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See "
        "the\nGNU General Public License for more details.\n"
    )
    mpl = (
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was "
        "not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.\n"
    )
    apache = "you may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://x\n"
    names = ["MIT", "BSD-3-Clause", "GPL-3.0-or-later", "MPL-2.0", "Apache-2.0"]
    plain = [mit, bsd, gpl, mpl, apache]
    forms = ["", " * ", "# ", "! ", "// "]
    texts = ["".join(f"{form}{line}\n" for line in text.splitlines()) for form in forms for text in plain]
    texts += [text.replace("\n", "\r\n") for text in plain]
    texts += ["Words before\n" + text + "words after" for text in plain]
    got = found(spark, texts)
    assert [got[i][1] for i in range(len(texts))] == [[name] for name in names] * 7
    split = ["Released under\n\nthe MIT License.", "# Released under\n#\n# the MIT License.", "Released under. the MIT License.", "Released under\nthe\nMIT\n! License."]
    assert [ids for ids, _ in found(spark, split).values()] == [[], [], [], ["mit-notice"]]


def test_longest_wrapped_sentence_counts(spark):
    sentences = {"a": "one two", "b": "one two three four", "c": "three four", "d": "five"}
    docs = spark.createDataFrame([(0, "x\none\ntwo\nthree\nfour\nfive\none\ntwo\nthree four"), (1, "one two\nthree\none two\n\nthree\nfour")], "doc_id long, text string")
    got = {r.doc_id: [(f.sentence, f.id) for f in r.found] for r in licenses.scan(docs, sentences, ()).collect()}
    assert got == {0: [(1, "b"), (5, "d"), (6, "b")], 1: [(0, "a"), (2, "a"), (3, "c")]}


BSD = """Copyright (c) someone
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL ..."""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_families_of_licences_are_told_apart(spark):
    texts = {
        BSD.format(""): ["BSD-2-Clause"],
        BSD.format(THIRD): ["BSD-3-Clause"],
        "// SPDX-License-Identifier: GPL-2.0-only\n#include <x>": ["GPL-2.0-only"],
        "# SPDX-License-Identifier: MIT\n": ["MIT"],
        "the word MIT alone\nMIT\n": [],
        " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser"
        " General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or"
        " (at your option) any later version.": ["LGPL-2.1-or-later"],
        "Permission to use, copy, modify, and/or distribute this software for any purpose\nwith or without fee is hereby"
        " granted.": ["0BSD"],
        "Permission to use, copy, modify, and/or distribute this software for any purpose\nwith or without fee is hereby"
        " granted, provided that the above\ncopyright notice and this permission notice appear in all copies.": ["ISC"],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())
    assert len({name for name, _ in licenses.RULES}) >= 40
