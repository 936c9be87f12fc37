"""Licence scans: known licence sentences, and ordered rules over their sequence.

A text is cut into sentences at line ends and after ``.``, ``;``, ``:``, ``!`` and ``?`` before a blank.
A sentence is normalised (lower case, everything but letters, digits, ``+`` and ``.`` within a word as one
blank) and looked up among the known sentences, which gives an identifier. Variable sentences (copyright
lines, SPDX tags) are told by pattern; the names in an SPDX tag are licences of the text. Known sentences that are wrapped over several lines are found
too: where a line begins one, the following lines are added, without their comment marks, until a blank
line; what stands within such a sentence is not reported besides. The identifiers of a text in their order form a sequence;
the ordered rules are tried on it, each a sequence of identifiers with up to ``GAP`` other known
sentences in between; what a rule has used is not used again, so a licence's text does not also count
as the notices it contains.

The sentences are exploded, looked up by a broadcast join with the known ones (a table fixed in this
file), and only sentences found are shuffled.

Defined results: a null or empty text, or one without known sentences, has no licences. Repeated notices in one text give
one licence with a count. Repeated rows (same id and text) each give a row. An empty table gives an empty
result. Other columns are not looked at.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.tables import text_rows

GAP = 3

# Sentences of public licence texts and notices, with our identifiers for them.
SENTENCES = {
    "mit-title": ["MIT License", "The MIT License (MIT)", "The MIT License"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-ref": ["Licensed under the MIT License.", "This project is licensed under the MIT License.", "Released under the MIT License.", "Distributed under the MIT License."],
    "as-is": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "isc-ref": ["Licensed under the ISC License.", "ISC License"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "bsd2-ref": ["Licensed under the BSD 2-Clause License.", "BSD 2-Clause License", "Licensed under the Simplified BSD License."],
    "bsd3-ref": ["Licensed under the BSD 3-Clause License.", "BSD 3-Clause License", "Licensed under the New BSD License."],
    "bsd-ref": ["Licensed under the BSD License."],
    "apache2-title": ["Apache License", "Version 2.0, January 2004"],
    "apache2-notice": ["Licensed under the Apache License, Version 2.0 (the \"License\");"],
    "apache2-use": ["you may not use this file except in compliance with the License."],
    "apache2-copy": ["You may obtain a copy of the License at"],
    "apache2-ref": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License 2.0.", "This project is licensed under the Apache License, Version 2.0.", "Apache License, Version 2.0"],
    "gpl2-ref": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2.", "This program is licensed under the GNU General Public License, version 2."],
    "gpl3-ref": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "This program is licensed under the GNU General Public License, version 3."],
    "gpl-start": ["This program is free software:", "This program is free software;"],
    "gpl3-free": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;"],
    "gpl2-free": ["either version 2 of the License, or (at your option) any later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "lgpl21-ref": ["Licensed under the GNU Lesser General Public License, version 2.1.", "This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "lgpl3-ref": ["Licensed under the GNU Lesser General Public License, version 3.", "This work is licensed under the GNU Lesser General Public License, version 3."],
    "agpl3-ref": ["Licensed under the GNU Affero General Public License, version 3.", "This work is licensed under the GNU Affero General Public License, version 3."],
    "mpl2-ref": ["This Source Code Form is subject to the terms of the Mozilla Public License, v.", "Licensed under the Mozilla Public License, Version 2.0.", "Licensed under the Mozilla Public License 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "public-domain": ["This work is in the public domain.", "Released into the public domain."],
    "cc0-ref": ["Licensed under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "reserved": ["All rights reserved."],
}

# Creative Commons notices by rule: element code, words, versions.
CC_ELEMENTS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")

# Sentences with variable parts, told by pattern on the normalised sentence; their first words.
PATTERNS = {"copyright": r"^copyright( c)? ", "spdx": r"^spdx license identifier "}
PATTERN_WORDS = ("copyright", "spdx")

# In order: licence and the identifiers it needs, one after the other. The first rule that fits takes
# its sentences.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache2-notice", "apache2-use", "apache2-copy")),
    ("Apache-2.0", ("apache2-title", "apache2-title")),
    ("GPL-3.0-or-later", ("gpl-start", "gpl3-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl3-free",)),
    ("GPL-2.0-or-later", ("gpl-start", "gpl-terms", "gpl2-free", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl-terms", "gpl2-free")),
    ("Apache-2.0", ("apache2-notice",)),
    ("Unlicense", ("unlicense",)),
    ("MIT", ("mit-ref",)),
    ("Apache-2.0", ("apache2-ref",)),
    ("BSD-2-Clause", ("bsd2-ref",)),
    ("BSD-3-Clause", ("bsd3-ref",)),
    ("BSD", ("bsd-ref",)),
    ("GPL-2.0-only", ("gpl2-ref",)),
    ("GPL-3.0-only", ("gpl3-ref",)),
    ("LGPL-2.1-only", ("lgpl21-ref",)),
    ("LGPL-3.0-only", ("lgpl3-ref",)),
    ("AGPL-3.0-only", ("agpl3-ref",)),
    ("MPL-2.0", ("mpl2-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("public-domain", ("public-domain",)),
    ("MIT", ("mit-title",)),
    ("ISC", ("isc-ref",)),
    ("all-rights-reserved", ("copyright", "reserved")),
]


def known_sentences() -> list[tuple[str, str]]:
    """(identifier, sentence) of all sentences, those made by rule included."""
    found = [(name, s) for name, sentences in SENTENCES.items() for s in sentences]
    for code, words in CC_ELEMENTS.items():
        for version in CC_VERSIONS:
            name = f"cc-{code.lower()}-{version}"
            found += [
                (name, f"Licensed under CC {code} {version}."),
                (name, f"This work is licensed under CC {code} {version}."),
                (name, f"This work is licensed under a Creative Commons {words} {version} International License."),
                (name, f"Licensed under the Creative Commons {words} {version} International License."),
            ]
    return found


def rules() -> list[tuple[str, tuple[str, ...]]]:
    made = [(f"CC-{code}-{version}", (f"cc-{code.lower()}-{version}",)) for code in CC_ELEMENTS for version in CC_VERSIONS]
    return RULES + made


BLANK_LINE = "\x01"  # stands before a sentence that follows a blank line


def sentences(text: Column) -> Column:
    text = F.regexp_replace(text, r"(?>\r\n|\r|\n){2,}", f"$0{BLANK_LINE}")
    # What is looked back for comes after the first blank, so that most characters are passed over at once.
    return F.split(text, r"[\r\n]+|[ \t](?<=[.;:!?][ \t])(?<!(?i:identifier):[ \t])[ \t]*")


def normalised(sentence: Column) -> Column:
    """Words of letters, digits, ``+`` and inner dots, one blank between them."""
    plain = F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}+.]+", " ")
    return F.trim(F.regexp_replace(plain, r"\.(?:(?= |$)|(?<= \.|^\.))", ""))


def first_words() -> list[str]:
    """Normalised first words of all known sentences: what begins otherwise need not be looked up."""
    return sorted({re.findall(r"[^\W_]+", sentence)[0].lower() for _, sentence in known_sentences()})


def _may_begin(sentence: Column, words: list[str]) -> Column:
    """Whether a sentence as it stands may begin with one of ``words`` once it is normalised; seldom true of others."""
    return sentence.rlike(rf"(?iu)^[^\p{{L}}\p{{N}}]*(?:{'|'.join(words)})")


def _first_of(words: Column) -> Column:
    """The letters and digits a sentence begins with."""
    return F.regexp_extract(F.substring_index(words, " ", 1), r"^[^+.]*", 0)


# One licence, or one with an exception, and others joined to it; in brackets or not.
_TAG_NAME = r"\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*"
_TAG = rf"(?i:SPDX-License-Identifier):[ \t]*({_TAG_NAME}(?:[ \t]+(?:OR|AND|WITH)[ \t]+{_TAG_NAME})*)"


def tagged_licences(text: Column) -> Column:
    """Names in the SPDX tags of a text: those joined by OR or AND one by one, an exception with its licence."""
    tags = F.when(F.lower(text).contains("spdx-license-identifier"), F.regexp_extract_all(text, F.lit(_TAG), F.lit(1)))
    names = F.transform(tags, lambda tag: F.split(F.regexp_replace(F.regexp_replace(tag, r"[()]", ""), r"[ \t]+", " "), " (?:OR|AND) "))
    return F.coalesce(F.flatten(names), F.array().cast("array<string>"))


def _goes_on(words: Column) -> Column:
    """Whether a longer known sentence begins with ``words``."""
    begins = F.array(*[normalised(F.lit(sentence)) for sentence in sorted({sentence for _, sentence in known_sentences()})])
    return F.exists(begins, lambda k: k.startswith(F.concat(words, F.lit(" "))))


def _starts(singles: str) -> Column:
    """The ``singles`` that are the beginning of a longer known sentence."""
    return F.filter(singles, lambda s: _first_of(s["words"]).isin(first_words()) & _goes_on(s["words"]))


def _wrapped(parts: str, starts: str) -> Column:
    """(place, last, words) of what begins in one of the ``starts`` as a known sentence does and goes on in the
    following ``parts`` as one does, once for each of these it might end with."""
    most = 2 * max(len(re.findall(r"\w+", sentence)) for _, sentence in known_sentences())  # a mark may be a part of its own

    def following(single):
        def step(state, part):
            empty = part["words"] == ""
            words = F.when(empty, state["words"]).otherwise(F.concat(state["words"], F.lit(" "), part["words"]))
            one = F.array(F.struct(single["place"].alias("place"), (state["last"] + 1).alias("last"), words.alias("words")))
            found = F.when(empty, state["found"]).otherwise(F.concat(state["found"], one))
            following_too = F.struct(words.alias("words"), (state["last"] + 1).alias("last"), (empty | _goes_on(words)).alias("goes_on"), found.alias("found"))
            ended = F.struct(state["words"].alias("words"), state["last"].alias("last"), F.lit(False).alias("goes_on"), state["found"].alias("found"))
            return F.when(state["goes_on"] & ~part["apart"] & (~empty | part["mark"]), following_too).otherwise(ended)

        none = F.array().cast("array<struct<place:int,last:int,words:string>>")
        start = F.struct(single["words"].alias("words"), single["place"].alias("last"), F.lit(True).alias("goes_on"), none.alias("found"))
        return F.aggregate(F.slice(parts, single["place"] + 2, F.lit(most)), start, step, lambda state: state["found"])

    return F.flatten(F.transform(starts, following))


def licence_sentences(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` without the text, one for each known sentence: ``place`` and ``last`` (numbers of the
    sentence and, if it is wrapped, of its last line), ``sentence`` (its identifier) and ``words`` (normalised)."""
    spark = rows.sparkSession
    # A table fixed in this file, small enough for every executor.
    known = F.from_json(F.lit(json.dumps([{"name": n, "sentence": s} for n, s in known_sentences()])), "array<struct<name:string,sentence:string>>")
    table = spark.range(1).select(F.explode(known).alias("k")).select(F.col("k.name").alias("known"), normalised(F.col("k.sentence")).alias("words")).distinct()
    other = [c for c in rows.columns if c != text]
    part = lambda raw: F.struct(normalised(raw).alias("words"), raw.startswith(BLANK_LINE).alias("apart"), raw.rlike(r"^[ \t]*[;:!]+$").alias("mark"))
    raw = rows.withColumn("__raw", sentences(F.col(text))).drop(text)
    # Only what may begin with a word that matters is normalised, and of texts where a known sentence may go
    # on over several lines the rest.
    begin = [*first_words(), *PATTERN_WORDS]
    places = F.transform("__raw", lambda s, i: F.struct(i.alias("place"), s.alias("raw")))
    some = F.filter(places, lambda p: _may_begin(p["raw"], begin))
    single = lambda p: F.struct(p["place"].alias("place"), p["place"].alias("last"), normalised(p["raw"]).alias("words"))
    parts = raw.withColumn("__singles", F.filter(F.transform(some, single), lambda s: _first_of(s["words"]).isin(begin)))
    parts = parts.withColumn("__starts", _starts("__singles"))
    parts = parts.withColumn("__parts", F.when(F.size("__starts") > 0, F.transform("__raw", part)))
    parts = parts.select(*other, F.inline(F.concat("__singles", _wrapped("__parts", "__starts"))))
    found = parts.join(F.broadcast(table), "words", "left")
    pattern = F.lit(None).cast("string")
    for name, expression in PATTERNS.items():
        pattern = F.when((F.col("place") == F.col("last")) & F.col("words").rlike(expression), F.lit(name)).otherwise(pattern)
    return found.withColumn("sentence", F.coalesce("known", pattern)).where("sentence is not null").select(*other, "place", "last", "sentence", "words")


def _rule_pattern(needs: tuple[str, ...]) -> str:
    """A rule on a sequence written as `` place:identifier;`` after one another."""
    one = [rf" \d+:{name.replace('.', '[.]')};" for name in needs]
    return rf"(?: \d+:[^;]*;){{0,{GAP}}}?".join(one)


def matched(found: str) -> Column:
    """Names of the licences in a sequence of (place, sentence, ...): the rules are applied in order,
    and what one has used is struck out."""
    sequence = F.array_join(F.transform(found, lambda s: F.concat(F.lit(" "), s["place"].cast("string"), F.lit(":"), s["sentence"], F.lit(";"))), "")
    ordered = F.from_json(
        F.lit(json.dumps([{"licence": name, "pattern": _rule_pattern(needs)} for name, needs in rules()])),
        "array<struct<licence:string,pattern:string>>",
    )

    def step(state, rule):
        uses = F.size(F.regexp_extract_all(state["rest"], rule["pattern"], F.lit(0)))
        return F.struct(
            F.regexp_replace(state["rest"], rule["pattern"], F.lit("")).alias("rest"),
            F.concat(state["names"], F.array_repeat(rule["licence"], uses)).alias("names"),
        )

    start = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("names"))
    return F.aggregate(ordered, start, step, lambda state: F.array_sort(state["names"]))


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, licences (names in alphabetical order, one for each use),
    sentences (array of (place, sentence) of all known sentences; null if there are none)."""
    rows = text_rows(docs, key, text)
    found = licence_sentences(rows)
    # What lies within a wrapped sentence goes; repeated rows of one text are one here.
    before = Window.partitionBy("doc_id", "text_hash").orderBy("place", F.desc("last"), "sentence").rowsBetween(Window.unboundedPreceding, -1)
    spans = F.max(F.when(F.col("last") > F.col("place"), F.col("last"))).over(before)
    found = found.withColumn("within", spans).where("within is null or within < last")
    grouped = found.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("place", "sentence"))).alias("sentences"))
    grouped = grouped.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "sentences", matched("sentences").alias("licences"))
    ids = rows.select("doc_id", "text_hash", tagged_licences(F.col("text")).alias("tagged"))
    joined = ids.join(grouped, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    return joined.select("doc_id", F.array_sort(F.concat(F.coalesce("licences", F.array().cast("array<string>")), "tagged")).alias("licences"), "sentences")
