"""Licence scans by sentence rules.

A text becomes its sequence of normalised sentences (lower case, letters and digits).  A
sentence ends at its marks and at blank lines; a single line feed is a space and comment marks
before a line's first letter (#, *, //) are nothing, so notices are recognised as published, wrapped at any
width.  Known licence sentences, or the part of one that says which licence it is, have
identifiers.  They are found within the sentences of a text, the longest first where several begin
at one word and none within another; one that holds an end itself ("free software: you can ...")
matches sentences that end there.  A licence rule is an ordered list of identifiers and matches where they
stand in that order, with anything in between.  Of licences that say the same and more, as BSD with
three clauses does of BSD with two, only the fullest is named.

Sentences, identifiers and rules are expressions over one string, so recognition is a projection
without shuffle or Python.  Only texts with one of a few words that every known sentence
has are looked through for them.

Null texts are empty texts: no sentences, no licences.  Repeated rows each give a row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.columns import carried, restored

# Sentences of published licences and of the notices that name them.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions"
)
MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software"
)
BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met"
)
APACHE_NAME = "Licensed under the Apache License, Version 2.0"
APACHE_LIMIT = "you may not use this file except in compliance with the License"
APACHE_COPY = "You may obtain a copy of the License at"
APACHE_TITLE = "Apache License Version 2.0, January 2004"
BSD_SOURCE = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer"
)
BSD_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution"
)
BSD_NAMES = "Neither the name of"
GPL_GRANT = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version"
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies"
)

# The part of a notice of the Free Software Foundation that names the licence, and its versions.
TERMS = "redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation"
LATER = "either version {} of the License, or (at your option) any later version"
ONLY = "version {} of the License only"
ZLIB_TERMS = (
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely"
)
ZLIB_WARRANTY = "This software is provided 'as-is', without any express or implied warranty"
BOOST_GRANT = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    "accompanying documentation covered by this license"
)

# Licences by their SPDX identifier.
SPDX = (
    "0BSD AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 "
    "CC-BY-SA-4.0 CC0-1.0 EPL-1.0 EPL-2.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC "
    "LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 Unlicense Zlib"
).split()

_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}

# Each rule is (licence, its sentences in order).
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", (APACHE_NAME,)),
    ("Apache-2.0", (APACHE_LIMIT, APACHE_COPY)),
    ("Apache-2.0", (APACHE_TITLE,)),
    ("BSD", (BSD_GRANT,)),
    ("BSD-2-Clause", (BSD_GRANT, BSD_SOURCE, BSD_BINARY)),
    ("BSD-3-Clause", (BSD_GRANT, BSD_SOURCE, BSD_BINARY, BSD_NAMES)),
    ("BSL-1.0", ("Distributed under the Boost Software License, Version 1.0",)),
    ("BSL-1.0", (BOOST_GRANT,)),
    ("CC-BY-4.0", ("Licensed under CC BY 4.0",)),
    ("CC-BY-4.0", ("Creative Commons Attribution 4.0 International License",)),
    ("CC-BY-NC-4.0", ("Licensed under CC BY-NC 4.0",)),
    ("CC-BY-NC-4.0", ("Creative Commons Attribution-NonCommercial 4.0 International License",)),
    ("CC-BY-SA-4.0", ("Licensed under CC BY-SA 4.0",)),
    ("CC-BY-SA-4.0", ("Creative Commons Attribution-ShareAlike 4.0 International License",)),
    ("CC0-1.0", ("Released under CC0 1.0",)),
    ("EPL-1.0", ("Eclipse Public License v1.0",)),
    ("EPL-2.0", ("made available under the terms of the Eclipse Public License 2.0",)),
    ("EPL-2.0", ("Eclipse Public License - v 2.0",)),
    ("GPL-3.0", ("This work is licensed under the GNU General Public License, version 3",)),
    ("GPL-2.0", ("GNU General Public License Version 2, June 1991",)),
    ("GPL-3.0", ("GNU General Public License Version 3, 29 June 2007",)),
    ("LGPL-2.1", ("GNU Lesser General Public License Version 2.1, February 1999",)),
    ("LGPL-3.0", ("GNU Lesser General Public License Version 3, 29 June 2007",)),
    ("AGPL-3.0", ("GNU Affero General Public License Version 3, 19 November 2007",)),
    ("GPL-2.0-or-later", (TERMS.format(_GNU["GPL"]), LATER.format("2"))),
    ("GPL-3.0-or-later", (TERMS.format(_GNU["GPL"]), LATER.format("3"))),
    ("GPL-2.0-only", (TERMS.format(_GNU["GPL"]), ONLY.format("2"))),
    ("LGPL-2.1-or-later", (TERMS.format(_GNU["LGPL"]), LATER.format("2.1"))),
    ("LGPL-3.0-or-later", (TERMS.format(_GNU["LGPL"]), LATER.format("3"))),
    ("AGPL-3.0-or-later", (TERMS.format(_GNU["AGPL"]), LATER.format("3"))),
    ("ISC", (ISC_GRANT,)),
    ("MIT", ("under the MIT License",)),
    ("MIT", (MIT_GRANT, MIT_NOTICE)),
    ("MPL-2.0", ("subject to the terms of the Mozilla Public License, v. 2.0",)),
    ("MPL-2.0", ("Mozilla Public License Version 2.0",)),
    ("Unlicense", ("This is free and unencumbered software released into the public domain",)),
    ("Zlib", (ZLIB_WARRANTY, ZLIB_TERMS)),
    *((name, (f"SPDX-License-Identifier: {name}",)) for name in SPDX),
)

#: licences that say all of others: those are not named beside them
FULLER = {"BSD": ("BSD-2-Clause", "BSD-3-Clause"), "BSD-2-Clause": ("BSD-3-Clause",)}

#: every known sentence has one of these
WORDS = ("licen", "permission", "redistribut", "neither", "unencumbered", "warranty", "cc0")

#: stands for the end of a sentence while a text is normalised
_STOP = "\x01"

# What becomes of a text, in order: patterns that the regular expressions of Java, RE2 and Python read alike.
STEPS: tuple[tuple[str, str], ...] = (
    # comment marks before the first letter or digit of a line
    (r"(^|\n)[^\pL\pN\n]+", "\n"),
    # blank lines, then marks before white space or the end, are ends
    (r"\n\n+", _STOP),
    (r"[.!?;:]+([\x09-\x0D\x20]|\z)", _STOP),
    # each word and each end has a space of its own on either side
    (r"[^\pL\pN\x01]+", " "),
    (r" ?\x01[ \x01]*", f" {_STOP} "),
    (" ", "  "),
)


def normalise(text: str) -> str:
    """What ``spaced`` makes of a text, for known sentences."""
    text = text.lower()
    for pattern, put in STEPS:
        python = pattern.replace(r"[^\pL\pN", r"[^\w").replace(r"\z", r"\Z")
        text = re.sub(python, put, text)
    return f" {text.strip(f' {_STOP}')} "


def sentence_ids() -> dict[str, int]:
    """Identifiers of the known sentences, from 1, in order of appearance."""
    known: dict[str, int] = {}
    for _, sentences in RULES:
        for s in sentences:
            known.setdefault(normalise(s), len(known) + 1)
    return known


def known_pattern() -> str:
    """One pattern of all known sentences, longer ones first."""
    return "|".join(sorted(sentence_ids(), key=lambda s: (-len(s), s)))


def rule_patterns() -> list[tuple[str, list[str]]]:
    """Each licence with what the identifiers of a text, spelled <1><2>, must be LIKE: any of them."""
    known = sentence_ids()
    out: dict[str, list[str]] = {}
    for name, sentences in RULES:
        out.setdefault(name, []).append("%" + "%".join(f"<{known[normalise(s)]}>" for s in sentences) + "%")
    return sorted(out.items())


def spaced(text: Column) -> Column:
    """The normalised words of a text with the ends of its sentences."""
    words = F.lower(F.coalesce(text, F.lit("")))
    for pattern, put in STEPS[:-1]:
        words = F.regexp_replace(words, pattern, put)
    words = F.replace(words, F.lit(STEPS[-1][0]), F.lit(STEPS[-1][1]))
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def scan_licences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_sentences, n_known (long), sentence_ids (string) and licences (sorted, comma-joined).

    Columns of those names are replaced.  ``sentence_ids`` lists the identifiers in text order.
    """
    known = F.create_map(*[F.lit(x) for pair in sentence_ids().items() for x in pair])
    names = ("n_sentences", "n_known", "sentence_ids", "licences")
    source, inner, kept = carried(docs, text_col, names)
    words = source.withColumn("words", spaced(F.col("text")))
    likely = F.lit(False)
    for word in WORDS:
        likely = likely | F.contains("words", F.lit(word))
    hits = F.when(likely, F.regexp_extract_all("words", F.lit(known_pattern()), F.lit(0)))
    ids = F.transform(F.coalesce(hits, F.array().cast("array<string>")), lambda s: known[s].cast("string"))
    cut = words.withColumn("ids", ids).withColumn(
        "line", F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    )
    found = {name: _any([F.col("line").like(p) for p in patterns]) for name, patterns in rule_patterns()}
    named = [
        F.when(found[name] & ~_any([found[f] for f in FULLER.get(name, ())]), F.lit(name)) for name in found
    ]
    sentences = F.filter(F.split("words", _STOP), lambda s: F.trim(s) != "")
    return cut.select(
        *restored(inner, kept),
        F.size(sentences).cast("long").alias("n_sentences"),
        F.size("ids").cast("long").alias("n_known"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.when(F.col("line") == "", F.lit(""))
        .otherwise(F.array_join(F.array_sort(F.array_compact(F.array(*named))), ","))
        .alias("licences"),
    )


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out
