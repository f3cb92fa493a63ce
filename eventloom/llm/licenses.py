"""License scans: sentences to known identifiers, identifier sequences to rules.

Native: each text is cut into sentences and lines, these are normalised and looked up
in a catalogue, and the resulting identifier sequence is compared with ordered rules,
all inside one row. Nothing is shuffled and a long document is one row's work.

A sentence may be wrapped: lines that only a line break parts, without sentence
punctuation or a blank line, are looked up joined as well, up to the length of the
longest sentence of the catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licences and notices.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at "
    "https://mozilla.org/MPL/2.0/.",
    "mit-conditions": "The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be "
    "used to endorse or promote products derived from this software without specific prior "
    "written permission.",
    "apache-grant": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl-free": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
    "version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
    "PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
    "your option) any later version.",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License version 2 as published by the Free Software Foundation.",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
    "or (at your option) any later version.",
    "lgpl3-free": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-free": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-as-is": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0-law": "To the extent possible under law, the author(s) have dedicated all copyright and related and "
    "neighboring rights to this software to the public domain worldwide.",
    "cc0-notice": "Licensed under CC0 1.0 Universal.",
    "epl2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl1-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "cddl-terms": "The contents of this file are subject to the terms of the Common Development and Distribution "
    'License (the "License").',
    "zlib-origin": "The origin of this software must not be misrepresented; you must not claim that you wrote the "
    "original software.",
    "zlib-altered": "Altered source versions must be plainly marked as such, and must not be misrepresented as being "
    "the original software.",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
    'software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
    "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
    "third-parties to whom the Software is furnished to do so, all subject to the following:",
    "postgresql-grant": "Permission to use, copy, modify, and distribute this software and its documentation for any "
    "purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice "
    "and this paragraph and the following two paragraphs appear in all copies.",
    "spdx-tag": "SPDX-License-Identifier:",
}
# Identifiers that a tag names on the same line.
TAGGED = (
    "0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause",
    "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0",
    "ECL-2.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "LPPL-1.3c", "MIT", "MIT-0", "MPL-2.0", "MS-PL", "MS-RL", "NCSA", "OFL-1.1", "OSL-3.0", "PostgreSQL",
    "Unlicense", "UPL-1.0", "Vim", "WTFPL", "Zlib",
)
SENTENCES |= {f"tag-{name}": name for name in TAGGED}
#: Licence and the sentences that state it, in their order. A licence may have several rules.
RULES = (
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-conditions",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-grant", "apache-copy")),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-details")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-endorse")),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("MPL-2.0", ("mpl-copy",)),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-law",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("EPL-2.0", ("epl2-terms",)),
    ("EPL-1.0", ("epl1-terms",)),
    ("CDDL-1.0", ("cddl-terms",)),
    ("Zlib", ("zlib-origin", "zlib-altered")),
    ("BSL-1.0", ("bsl-grant",)),
    ("PostgreSQL", ("postgresql-grant",)),
    *((name, ("spdx-tag", f"tag-{name}")) for name in TAGGED),
)
SENTENCE_END = r"[.!?:]+[ \t\r\n\f]+|[\r\n]+"
#: What parts two lines of one sentence: a line break, and not a blank line.
LINE_BREAKS = ("\n", "\r\n", "\r")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A catalogue is looked up inside each row; a larger one must be given in blocks.
MOST_SENTENCES = 2000


def normalized(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), "[^a-z0-9]+", " "))


def normalized_text(sentence: str) -> str:
    kept = (c if "a" <= c <= "z" or "0" <= c <= "9" else " " for c in sentence.lower())
    return " ".join("".join(kept).split())


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def joined(pieces: Column, known: Column, most_words: int, most_chars: int) -> Column:
    """The longest known sentence that begins with the first of ``pieces``: id, length in pieces."""

    def add(state: Column, piece: Column) -> Column:
        words = F.when(piece["words"] == "", state["words"]).otherwise(
            F.ltrim(F.concat(state["words"], F.lit(" "), piece["words"]))
        )
        n = state["n"] + 1
        return F.when(state["open"], let(F.struct(words.alias("words"), F.try_element_at(known, words).alias("id")), lambda x: F.struct(
            x["words"].alias("words"),
            (piece["goes_on"] & (F.length(x["words"]) < most_chars)).alias("open"),
            n.alias("n"),
            F.coalesce(x["id"], state["id"]).alias("id"),
            F.when(x["id"].isNotNull(), n).otherwise(state["length"]).alias("length"),
        ))).otherwise(state)

    nothing = F.struct(
        F.lit("").alias("words"), F.lit(True).alias("open"), F.lit(0).alias("n"),
        F.lit(None).cast("string").alias("id"), F.lit(0).alias("length"),
    )
    # Between two words there may be one empty piece, a line prefix such as "! ".
    return F.aggregate(F.slice(pieces, 1, 2 * most_words), nothing, add, lambda x: F.struct(x["id"], x["length"]))


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES, key: str = "doc_id") -> DataFrame:
    """Per document: ``key``, found (array of (sentence number, identifier)), licenses.

    ``found`` has each recognised sentence in the order of the text, by the number of
    the sentence or line in which it begins; ``licenses`` the names, sorted, of those
    rules whose identifiers follow each other without another recognised sentence
    between. A sentence begins at the start of a line or after another one. Of several
    that begin at one place the longest counts, and none that begins within the lines
    of an earlier one.

    A null or empty text has none of either. Repeated rows give repeated rows; only
    ``key`` and text are read, so other columns can have any name.
    """
    if len(sentences) > MOST_SENTENCES:
        raise ValueError(f"give the catalogue in blocks of {MOST_SENTENCES} sentences")
    texts = {normalized_text(text): name for name, text in sentences.items()}
    known = F.create_map(*(F.lit(x) for pair in texts.items() for x in pair))
    most_words = max((len(text.split()) for text in texts), default=1)
    most_chars = max(map(len, texts), default=0)
    first_words = sorted({text.split(" ")[0] for text in texts})

    def piece(raw: Column, i: Column, breaks: Column) -> Column:
        parted = F.try_element_at(breaks, i + 1)
        words = normalized(raw)
        # An empty piece is a blank line, or before a mark on the same line a line prefix.
        prefix = ~F.contains(parted, F.lit("\n")) & ~F.contains(parted, F.lit("\r"))
        return let(words, lambda w: F.struct(
            w.alias("words"),
            F.coalesce(F.when(w == "", prefix).otherwise(parted.isin(*LINE_BREAKS)), F.lit(False)).alias("goes_on"),
        ))

    def recognised(pieces: Column) -> Column:
        def at(p: Column, i: Column) -> Column:
            begins = p["goes_on"] & F.substring_index(p["words"], " ", 1).isin(first_words)
            alone = F.struct(F.try_element_at(known, p["words"]).alias("id"), F.lit(1).alias("length"))
            longest = F.when(
                begins, joined(F.slice(pieces, i + 1, 2 * most_words), known, most_words, most_chars)
            ).otherwise(alone)
            return let(longest, lambda x: F.struct(i.alias("sentence"), x["id"].alias("id"), x["length"].alias("length")))

        return F.filter(F.transform(pieces, at), lambda s: s["id"].isNotNull())

    def outermost(found: Column) -> Column:
        def begins_within(s: Column, i: Column) -> Column:
            reach = F.least(i, F.lit(2 * most_words))
            return F.exists(
                F.slice(found, i - reach + 1, reach), lambda e: e["sentence"] + e["length"] > s["sentence"]
            )

        kept = F.filter(found, lambda s, i: ~begins_within(s, i))
        return F.transform(kept, lambda s: F.struct(s["sentence"].alias("sentence"), s["id"].alias("id")))

    text = F.coalesce("text", F.lit(""))
    breaks = F.regexp_extract_all(text, F.lit(SENTENCE_END), F.lit(0))
    pieces = let(breaks, lambda b: F.transform(F.split(text, SENTENCE_END), lambda raw, i: piece(raw, i, b)))
    found = docs.select(F.col(key), let(let(pieces, recognised), outermost).alias("found"))
    order = F.concat(F.lit(" "), F.array_join(F.col("found.id"), "  "), F.lit(" "))
    fits = [
        F.when(F.contains(order, F.lit(f" {'  '.join(ids)} ")), F.lit(name)) for name, ids in rules
    ]
    named = F.filter(F.array(*fits), lambda name: name.isNotNull())
    return found.withColumn("licenses", F.array_sort(F.array_distinct(named)))
