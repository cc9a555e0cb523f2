import pytest

from verdant.llm import licenses as x

NOTICES = [
    ("Released under the MIT License.", "mit"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Licensed under CC BY 4.0.", "cc-by"),
    ("licensed under the APACHE license, version 2.0", "apache-2.0"), ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0"),
    ("# Copyright 2021 Someone. This software is licensed under the MIT License.", "mit"),
    ("This work is licensed under the GNU Lesser General Public License.", "lgpl"),
]
CLEAN = ["He lost his driving license in the general store.", "The software works in version 2.0 and it is free.", "Nothing here.", "license", ""]


@pytest.fixture(scope="module")
def model(spark):
    docs = [(i, f"Line {i} about free software and its terms\nthe public work of number {i} is general") for i in range(60)]
    return x.learn(spark.createDataFrame(docs, "doc_id long, text string"))


def test_lines(spark, model):
    rows = [(i, f"some text\n{line}\nmore text here") for i, (line, _) in enumerate(NOTICES)]
    rows += [(100 + i, line) for i, line in enumerate(CLEAN)] + [(200, None), (201, "\n".join(line for line, _ in NOTICES[:3])), (None, NOTICES[0][0]),
                                                                (0, rows[0][1]), (300, "word " * 200_000 + "\n" + NOTICES[0][0])]
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], "doc_id long, text string, families string, pos int")
    out = x.scan_documents(df, model)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows) - 1                                   # a repeated row counts once
    assert {i: got[i].families for i in range(len(NOTICES))} == {i: f for i, (_, f) in enumerate(NOTICES)}
    assert all(got[100 + i].families == "" and got[100 + i].n_notices == 0 for i in range(len(CLEAN)))
    assert got[200].n_lines == 0 and got[200].families == "" and got[201].families == "cc-by,cc-by-nc,mit" and got[201].n_notices == 3
    assert got[None].families == "mit" and got[300].families == "mit" and got[0].n_lines == 3
    lines = x.scan(df, model).where("doc_id = 300").collect()
    assert [(r.pos, r.family, r.confirmed) for r in lines] == [(1, "mit", True)]
    assert x.scan_documents(df.limit(0), model).count() == 0


def test_plan_is_native(spark, model):
    df = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    for frame in (x.scan(df, model), x.scan_documents(df, model)):
        plan = frame._jdf.queryExecution().toString()
        assert not any(k in plan for k in ("Python", "Pandas", "Arrow"))


def test_known_notices_in_documents(spark):
    """Against a search for the four sentences that the documents hold."""
    from verdant.llm.queries import op9_licenses
    d = "/root/testdata/sf0.01"
    known = {"This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
             "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0"}
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.families for r in op9_licenses(spark, d).collect()}
    assert got == {r.doc_id: ",".join(sorted({f for s, f in known.items() if s in r.text})) for r in docs}


# Notices in words of their own; none is a template or a name within a training frame.
OTHER_WORDINGS = {
    "mit": ["This package ships with an MIT license, so do what you like.", "Unless noted otherwise, our examples use the MIT licence.", "## License\nMIT License (see LICENSE.txt)",
            "// SPDX-License-Identifier: MIT\n// Copyright (c) 2019 Jane Doe", "jQuery plugin, MIT licensed, by Tom", "The library is free for all under an MIT-style license."],
    "apache-2.0": ["Apache License\nVersion 2.0, January 2004", "We ship every module below the Apache 2.0 licence.", "SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception",
                   "Source code here is Apache-2.0.", "Sources (c) Example Inc., Apache License v2.0", "The SDK carries an Apache 2 license.",
                   "Everything in this folder follows the Apache License, Version 2.0, unless a file says otherwise."],
    "gpl-3.0": ["GPLv3 or later", "The plugin is free software, GPL v3+.", "You are welcome to redistribute it according to the GNU GPL version 3 or newer.",
                "This program is free software and comes to you under the GNU\nGeneral Public License, version 3 of which is included with the sources", "GNU General Public License v3.0 only",
                "SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl-2.0": ["Linux kernel module, GPL v2", "SPDX-License-Identifier: GPL-2.0-only", "This driver may be passed on according to the GNU General Public License version 2.",
                "WordPress theme; GPLv2 or later", "The tool is licensed to you by the GNU GPL, version 2"],
    "lgpl": ["The bindings are LGPL-2.1 code.", "Qt parts: GNU Lesser General Public License v3", "Use this library as the GNU LGPL allows.", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "agpl-3.0": ["Server parts: AGPLv3", "SPDX-License-Identifier: AGPL-3.0-only", "Our web service is open source, with the GNU Affero General Public License, version 3, as its licence.", "AGPL 3 applies to this directory"],
    "bsd": ["BSD license (3 clause)", "This code has a BSD-style license.", "SPDX-License-Identifier: BSD-2-Clause", "Three-clause BSD, same as the operating system",
            "New BSD License, copyright 2012 by the developers", "The drivers use a simplified BSD licence."],
    "mpl-2.0": ["The browser parts are MPL 2.0 code.", "SPDX-License-Identifier: MPL-2.0", "Files in this tree follow the Mozilla Public License, version 2.0"],
    "cc-by": ["Photo: Maria K., CC BY 4.0", "Text shared by the museum with a Creative Commons Attribution 3.0 licence", "Map data (c) city council, CC-BY 3.0", "https://creativecommons.org/licenses/by/4.0/"],
    "cc-by-sa": ["CC BY-SA 3.0", "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply", "Image by Lee, CC-BY-SA-4.0, via the commons",
                 "http://creativecommons.org/licenses/by-sa/3.0/"],
    "cc-by-nc": ["Slides: CC BY-NC 3.0", "You may reuse the recordings (Creative Commons Attribution-NonCommercial 2.5).", "CC-BY-NC: no commercial use of these drawings"],
    "cc-by-nd": ["Poster, CC BY-ND 3.0", "The essay has a Creative Commons Attribution-NoDerivs licence.", "see creativecommons.org/licenses/by-nd/4.0"],
    "public-domain": ["The author placed this program in the public domain.", "CC0", "All photographs were dedicated to the public domain by their owner.", "Data set: CC0 1.0 Universal"],
    "isc": ["ISC License\n\nCopyright 2015 Ann", "SPDX-License-Identifier: ISC", "The module is open source, ISC licensed."],
}
NEGATED = ["Not licensed under CC BY 4.0.", "This file is not released under the MIT License.", "The data are no longer available under CC BY-SA 3.0.", "Please note: the logo isn't licensed under the Apache License 2.0.",
           "Our fonts were never distributed under the GNU GPL v3.", "These images are not covered by the BSD license.", "The manual is not published under the Mozilla Public License 2.0.",
           "This work is neither released under the MIT License nor free."]
MENTIONED = ["The student asked what the MIT License means.", "Her talk compared the GNU General Public License with other terms.", "The Apache License became popular among large companies.",
             "Permission to build the bridge was granted by the council.", "She studied at MIT and later in Paris.", "The court discussed the history of the GPL v3 for two days."]


def test_every_wording_has_a_key_and_none_is_a_test_notice(spark):
    names = x.name_rows(spark)
    lines = x._framed(names, x.FRAMES + x.MENTIONS + x.NEGATED).select("line").union(x.template_lines(spark).select("line"))
    assert lines.where(~x.F.col("line").rlike(x.HAS_KEY)).where("line not like '%any later version%'").count() == 0
    known = {" ".join(r.w) for r in lines.select(x.words_of(x.F.col("line")).alias("w")).collect()}
    own = [(n,) for v in OTHER_WORDINGS.values() for n in v]
    assert len(own) >= 60
    same = [r for r in spark.createDataFrame(own, "t string").select("t", x.words_of(x.F.col("t")).alias("w")).collect() if " ".join(r.w) in known]
    assert len(same) <= 8, same                   # bare names, such as "CC0", and identifiers are what they are


def test_other_wordings(spark, model):
    """Notices worded otherwise are found, negated ones never confirmed."""
    rows = [(i, f"A first sentence.\n\n{n}\n\nThe end of the page.", f) for i, (f, n) in enumerate((f, n) for f, v in OTHER_WORDINGS.items() for n in v)]
    rows += [(1000 + i, n, "") for i, n in enumerate(NEGATED)] + [(2000 + i, n, "") for i, n in enumerate(MENTIONED)]
    got = {r.doc_id: r for r in x.scan_documents(spark.createDataFrame(rows, "doc_id long, text string, want string"), model).collect()}
    notices = [r for r in rows if r[0] < 1000]
    missed = [(t.split("\n\n")[1], f, got[i].families, got[i].unconfirmed) for i, t, f in notices if got[i].families != f]
    print(f"recall {1 - len(missed) / len(notices):.3f} of {len(notices)}; missed {missed}")
    wrong = [(t, got[i].families) for i, t, _ in rows if i >= 1000 and got[i].families]
    print("wrong", wrong)
    assert len(missed) <= 0.1 * len(notices), missed
    assert not [w for w in wrong if w[0] in NEGATED], wrong
    assert len(wrong) <= 1, wrong


# Written after the fit's settings had been chosen with the notices above; not used for any choice.
FRESH = [
    ("mit", "Feel free to fork; the code carries the MIT license."), ("mit", "npm package (MIT License) by two students"), ("apache-2.0", "Terms: Apache License 2.0, see NOTICE"),
    ("apache-2.0", "Kafka client, Apache-2.0, 2018"), ("gpl-3.0", "Our firmware is yours to change on GPL-3.0 terms."), ("gpl-3.0", "Legal: GNU GPLv3"),
    ("gpl-2.0", "Driver source, GNU General Public License v2, see COPYING"), ("gpl-2.0", "MODULE_LICENSE(\"GPL v2\")"), ("lgpl", "linked library: LGPL v2.1 or newer"),
    ("agpl-3.0", "You run this server on the conditions of the AGPL-3.0."), ("bsd", "Copyright 2009 Lab X. BSD 2-Clause License."), ("bsd", "kernel code is BSD licensed"),
    ("mpl-2.0", "Legal notice: MPL-2.0"), ("cc-by", "Figure 3 by A. Smith (CC BY 3.0)"), ("cc-by-sa", "Encyclopedia text, CC BY-SA 4.0 International"),
    ("cc-by-nc", "Course notes: Creative Commons Attribution-NonCommercial 4.0"), ("cc-by-nd", "Podcast episodes are CC BY-ND 4.0."), ("public-domain", "The maps have been released into the public domain."),
    ("public-domain", "Sound effects: CC0 1.0"), ("isc", "tiny module, ISC license"),
    ("", "The fonts in this folder are not available under the SIL or the MIT License."), ("", "The drawings aren't shared under CC BY-NC 4.0."),
    ("", "The driver's licence of the teacher was in the car."), ("", "Historians debate why the GNU General Public License spread."),
]


def test_fresh_wordings(spark, model):
    rows = [(i, n, f) for i, (f, n) in enumerate(FRESH)]
    got = {r.doc_id: r for r in x.scan_documents(spark.createDataFrame(rows, "doc_id long, text string, want string"), model).collect()}
    wrong = [(n, f, got[i].families) for i, n, f in rows if got[i].families != f]
    print("fresh", len(rows) - len(wrong), "of", len(rows), wrong)
    assert len(wrong) <= 4, wrong


def test_learns_from_every_text(spark):
    """The one paragraph among thousands that looks like a notice counts in the threshold, wherever it is."""
    odd = "The apache dancers were released under version two of the show"
    rows = [(i, f"The driver showed licence number {i} at gate {i % 7}") for i in range(5000)] + [(5000, f"A page.\n\n{odd}")]
    learned = x.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    line = spark.createDataFrame([(1, 0, odd)], "key long, pos int, line string").select(
        "key", "pos", x.words_of(x.F.col("line")).alias("words"), x.F.array().cast("array<string>").alias("named"))
    seen = x._probabilities(x._matched(line, ["key"], learned.features), ["key"], learned).first()
    assert seen.family == "apache-2.0" and seen.probability > x.MIN_PROBABILITY + 0.05
    assert abs(learned.threshold - seen.probability) < 1e-5
