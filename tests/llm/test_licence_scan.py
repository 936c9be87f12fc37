import textwrap

from pyspark.sql import functions as F

from tickloom.llm.licence_scan import SENTENCES, known_sentences, rules, scan_licences

MIT = "\n".join(SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "as-is"))
APACHE = (
    'Copyright (c) 2020 Someone. All rights reserved.\nLicensed under the Apache License, Version 2.0 (the "License"); you may not use '
    "this file except in compliance with the License.  You may obtain a copy of the License at\n\n http://x"
)
CASES = {
    1: (MIT, ["MIT"]),
    2: (MIT.upper().replace(" ", "   "), ["MIT"]),
    3: (APACHE, ["Apache-2.0", "all-rights-reserved"]),
    4: (f"{MIT}\nwords\n{APACHE}\nLicensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", ["Apache-2.0", "CC-BY-NC-4.0", "CC-BY-NC-4.0", "MIT", "all-rights-reserved"]),
    5: ("Licensed under the Apache License, Version 2.0.\nOther text.", ["Apache-2.0"]),
    6: ("We speak of the MIT License. Nothing else", ["MIT"]),
    7: ("the license of this is not known", []),
    8: (None, []),
    9: ("", []),
    10: (SENTENCES["bsd-grant"][0] + "\n" + SENTENCES["bsd-source"][0] + "\n" + SENTENCES["bsd-binary"][0], ["BSD-2-Clause"]),
    11: ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"]),
}
CASES |= {
    12: ("// SPDX-License-Identifier: MIT", ["MIT"]),
    13: ("# spdx-license-identifier: (GPL-2.0-only WITH Classpath-exception-2.0 OR Apache-2.0) AND\tBSD-3-Clause words", ["Apache-2.0", "BSD-3-Clause", "GPL-2.0-only WITH Classpath-exception-2.0"]),
    14: ("SPDX-License-Identifier:\nSPDX-License-Identifier: GPL-2.0-or-later */ x", ["GPL-2.0-or-later"]),
    15: (f"{MIT}\nSPDX-License-Identifier: MIT", ["MIT", "MIT"]),
}
CASES[6] = ("We speak of the MIT License. Nothing else", [])


def test_rules(spark):
    rows = spark.createDataFrame([(i, text) for i, (text, _) in CASES.items()], "doc_id bigint, text string")
    assert {r.doc_id: r.licences for r in scan_licences(rows).collect()} == {i: want for i, (_, want) in CASES.items()}


def test_every_sentence_is_known_and_used(spark):
    rows = spark.createDataFrame([(i, s) for i, (_, s) in enumerate(known_sentences())], "doc_id bigint, text string")
    names = [name for name, _ in known_sentences()]
    for r in scan_licences(rows).collect():
        assert names[r.doc_id] in [s.sentence for s in r.sentences]
    assert {n for _, needs in rules() for n in needs} <= {*names, "copyright", "spdx"}


def test_documents(documents):
    lines = ("Licensed under ", "This work is licensed under ")
    want = {r.doc_id for r in documents.collect() if any(line.startswith(lines) for line in r.text.split("\n"))}
    found = {r.doc_id: r.licences for r in scan_licences(documents).collect() if r.licences}
    assert want <= set(found) and len(found) <= len(want) + documents.count() // 100


def test_a_tag_is_a_sentence(spark):
    rows = spark.createDataFrame([(1, "/* SPDX-License-Identifier: MIT */\nother")], "doc_id bigint, text string")
    (row,) = scan_licences(rows).collect()
    assert [s.sentence for s in row.sentences] == ["spdx"]


def test_odd_rows(odd, none):
    found = scan_licences(odd).collect()
    assert len(found) == odd.count() and not any(r.licences for r in found)
    assert scan_licences(none).count() == 0


BODIES = {
    "MIT": ["mit-grant", "mit-notice", "as-is"],
    "BSD-3-Clause": ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"],
    "BSD-2-Clause": ["bsd-grant", "bsd-source", "bsd-binary"],
    "ISC": ["isc-grant"],
    "Apache-2.0": ["apache2-notice", "apache2-use", "apache2-copy"],
    "GPL-3.0-or-later": ["gpl-start", "gpl3-free", "gpl-hope"],
    "GPL-2.0-or-later": ["gpl-start", "gpl-terms", "gpl2-free", "gpl-hope"],
}


def test_wrapped_texts(spark):
    cases = []
    for name, needs in BODIES.items():
        for width in (40, 72, 80):
            lines = textwrap.wrap(" ".join(SENTENCES[k][0] for k in needs), width)
            for mark in ("", "# ", " * ", "// ", ";; ", "    "):
                for end in ("\n", "\r\n"):
                    cases.append((name, "A title" + end + end.join(mark + line for line in lines) + end + "code()"))
    cases.append(("MIT", "Licensed under the\nMIT License."))  # the title within is not one besides
    cases.append(("", "Licensed under the\n\nISC\n\nLicense. All of it"))  # blank lines end sentences
    rows = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(cases)], "doc_id bigint, text string")
    for r in scan_licences(rows.unionByName(rows)).collect():
        assert ",".join(r.licences) == cases[r.doc_id][0], cases[r.doc_id]


def test_what_may_begin_a_known_sentence_is_normalised(spark):
    """The look at a sentence as it stands passes all whose normalised first word matters, and few others."""
    from tickloom.llm import licence_scan as scan

    marks = ["", "# ", "\x01// ", "..", " .", "(", "«", "̇", "中 ", "a ", "²"]
    words = ["The", "LICENSED", "Re‍leased", "apacKe", "İSC", "i̇sc", "MIT.", "to+", "YOU…", "tö", "bsd2", "៿tHIS", "alſ", "ordinary", ".x", ""]
    rows = spark.createDataFrame([(m + w + " rest of it",) for m in marks for w in words], "raw string")
    begin = [*scan.first_words(), *scan.PATTERN_WORDS]
    raw = F.col("raw")
    got = rows.select("raw", scan._first_of(scan.normalised(raw)).isin(begin).alias("matters"), scan._may_begin(raw, begin).alias("may")).collect()
    assert [r.raw for r in got if r.matters and not r.may] == []
    assert sum(r.matters for r in got) > 30 and not any(r.may for r in got if "ordinary" in r.raw)


def test_only_what_goes_on_as_a_known_sentence_is_followed(spark):
    """A beginning that other lines follow gives none of these; one that ends wrapped gives the parts up to its end."""
    from tickloom.llm import licence_scan as scan

    wrapped = textwrap.wrap(SENTENCES["isc-grant"][0], 40)
    texts = ["\n".join(["Permission"] + [f"another line {i}" for i in range(100)]), "\n".join([*wrapped, *["other words"] * 100])]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").select(scan.sentences(F.col("text")).alias("raw"))
    part = lambda raw: F.struct(scan.normalised(raw).alias("words"), F.lit(False).alias("apart"), F.lit(False).alias("mark"))
    rows = rows.select(F.transform("raw", part).alias("parts"))
    first = F.struct(F.lit(0).alias("place"), F.lit(0).alias("last"), F.col("parts")[0]["words"].alias("words"))
    rows = rows.withColumn("starts", scan._starts(F.array(first)))
    got = [r.found for r in rows.select(scan._wrapped("parts", "starts").alias("found")).collect()]
    assert [len(x) for x in got] == [1, len(wrapped) - 1] and got[1][-1].last == len(wrapped) - 1
