"""License scans: a trained paragraph classifier confirmed by template comparison, in DataFrame functions only.

A paragraph is a line of the text together with the lines that continue it: a
line of 40 to 160 characters that does not end a sentence is continued by the
next one that is not blank.  Only paragraphs with a key word (``KEYS``: one is
in every notice) are looked at.  Features are the word n-grams (one to three
words; digits apart from letters) of the training wordings, less those of
common words alone, and whether a licensing verb is negated.  The wordings are
the templates, and every name of a family within sentence frames: those that
license, those that only mention the name and those that negate.  A
multinomial logistic regression with an ``unknown`` class, trained with
Spark's own, gives the families' probabilities.  All distinct corpus paragraphs
that share neither three words nor a name with a template are unknown: half of
them are learned from, and the acceptance threshold is calibrated on the other
half.  A prediction is confirmed where the paragraph covers a template
of its family, lies within one, or holds a name of the family whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm.common import cut, prepare

UNKNOWN = "unknown"
#: All corpus lines that the unknown class is learned from weigh together at most this much, beside wordings of weight 1.
CORPUS_WEIGHT = 1000
#: Training rows of one task.
TASK_ROWS = 10_000
#: Weight of a name alone among the training rows, and of the squared weights.
BARE_WEIGHT = 30
REGULARISATION = 0.0003
#: A feature that stands for a negated licensing verb.
NEGATION = "~not"
#: Least probability and least coverage of a template, by three-word shingles.
MIN_PROBABILITY = 0.5
MIN_SIMILARITY = 0.6

# Notices by licence family, lines that are no notice, and common words.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "This project is released under the Apache 2.0 license.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Released under the GNU GPL v3.",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "Released under the GNU GPL v2.",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
    ],
}
# Names by family, as words (digits apart): "&" stands for a version's "v", "version" or nothing.
NAMES = {
    "apache-2.0": ["apache license & 2 0", "apache licence & 2 0", "apache & 2 0", "apache & 2", "apache software license & 2 0", "asl & 2 0",
                   "apache license & 2", "www apache org licenses license 2 0"],
    "mit": ["mit license", "mit licence", "mit x 11 license", "expat license", "mit licensed", "license mit", "licence mit", "under mit",
            "identifier mit", "mit open source license", "opensource org licenses mit", "mit style license", "terms of mit"],
    "gpl-3.0": ["gnu general public license & 3", "gnu general public licence & 3", "general public license & 3", "gnu gpl & 3", "gpl & 3", "gplv 3",
                "general public license gpl & 3", "gnu org licenses gpl 3 0"],
    "gpl-2.0": ["gnu general public license & 2", "gnu general public licence & 2", "general public license & 2", "gnu gpl & 2", "gpl & 2", "gplv 2",
                "general public license gpl & 2", "gnu org licenses gpl 2 0"],
    "lgpl": ["gnu lesser general public license", "lesser general public licence", "lesser general public license", "gnu lgpl", "lgpl & 2 1", "lgpl & 3",
             "lgplv 2 1", "lgplv 3", "lgpl", "library general public license"],
    "agpl-3.0": ["gnu affero general public license", "affero general public licence", "affero general public license", "gnu agpl", "agpl & 3", "agplv 3", "agpl"],
    "bsd": ["bsd 3 clause license", "bsd 2 clause license", "bsd license", "bsd licence", "3 clause bsd", "2 clause bsd", "new bsd license", "simplified bsd license",
            "bsd style license", "modified bsd license", "bsd 3 clause", "bsd 2 clause", "three clause bsd", "two clause bsd", "bsd licensed", "license bsd", "under bsd"],
    "mpl-2.0": ["mozilla public license & 2 0", "mozilla public licence & 2 0", "mpl & 2 0", "mozilla public license", "mplv 2", "mpl & 2", "mozilla org mpl 2 0"],
    "cc-by": ["cc by 4 0", "cc by 3 0", "cc by 2 0", "cc by license", "creative commons attribution 4 0", "creative commons attribution 3 0", "creative commons attribution license",
              "creative commons attribution international", "creativecommons org licenses by 4 0", "creativecommons org licenses by 3 0"],
    "cc-by-sa": ["cc by sa 4 0", "cc by sa 3 0", "cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike",
                 "creativecommons org licenses by sa"],
    "cc-by-nc": ["cc by nc 4 0", "cc by nc 3 0", "cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial",
                 "creativecommons org licenses by nc"],
    "cc-by-nd": ["cc by nd 4 0", "cc by nd 3 0", "cc by nd", "creative commons attribution noderivatives", "creative commons attribution no derivatives",
                 "creative commons attribution noderivs", "creativecommons org licenses by nd"],
    "public-domain": ["cc 0", "cc 0 1 0", "creative commons zero", "the unlicense", "into the public domain", "in the public domain", "public domain dedication",
                      "dedicated to the public domain", "creativecommons org publicdomain zero"],
    "isc": ["isc license", "isc licence", "license isc", "licence isc", "isc licensed", "identifier isc", "under isc", "terms of isc", "opensource org licenses isc"],
}
VERSION_WORDS = ["", "v", "version"]
# Sentences around a name (the "%"): notices, mere mentions, and negated ones.
FRAMES = [
    "%", "license %", "licence %", "spdx license identifier %", "licensed under %", "licensed under the %", "released under the %", "is released under %",
    "distributed under the terms of the %", "this project is licensed under the % see the license file for details", "code is available under the %",
    "this program is distributed under %", "made available under the terms of the %", "copyright 2020 the authors % or later", "is covered by the %",
    "you can use it under the %", "all files in this repository are governed by the %", "% all rights reserved", "published as open source software under the %",
    "dual licensed under the %", "content of this page is licensed %", "you may copy and modify this work under the %", "subject to the terms of the %",
    "full text of the % is in the copying file", "provided under the %", "% http", "text images and data are shared under a %",
]
MENTIONS = [
    "the % is a popular choice", "many projects use the %", "he compared the % with other terms", "a lawyer explained the % to the students", "what is the %",
    "the history of the % began in the last century", "she wrote an article about the %", "some companies avoid the %", "critics of the % say that it is too long",
    "the % was first published by a foundation", "how does the % differ from others", "we discussed the % at the conference", "the % is older than the project",
]
NEGATED = [
    "not licensed under %", "this work is not licensed under the %", "it is not released under the %", "the code is no longer available under the %",
    "this was never distributed under the terms of the %", "is not covered by the %", "the software is not provided under the %", "is neither licensed under the % nor free",
    "unlike the rest this file isn t licensed under the %", "these files are not governed by the %", "was not published under %", "this is not the %", "do not use the %",
    "not under the %", "license not %",
]
# A paragraph without one of these is no notice.
KEYS = ["licen[sc]", "gnu", "l?a?gpl", "mit\\b", "bsd", "apache", "asl\\b", "mozilla", "mpl", "creative", "cc[ -]?(?:by|0|zero)", "spdx", "redistribut",
        "permission", "public[ -]+domain", "copyright[ -]+notice", "isc\\b"]
HAS_KEY = "(?i)\\b(?:" + "|".join(KEYS) + ")|unlicense"
IS_NEGATED = ("(?i)\\b(?:not|never|no longer|neither|isn.?t|aren.?t|wasn.?t|nor)(?:\\s+(?!use\\b)\\w+){0,2}\\s+"
              "(?:(?:re)?licen[sc]ed|released|distributed|available|covered|governed|published|provided|offered|shared|under)\\b")
# A line that the next one continues, past its indent and comment marks.
CONTINUED = "(?m)^([^\\n]{39,159}[^.!?:;\\s])[ \\t]*\\r?\\n[ \\t]*(?:(?:[#*;]+|//+|--)[ \\t]*)?(?=[^\\s#*;/-])"
NOT_LICENSES = [
    "He showed his driving license to the officer.", "The license fee was raised in the general budget.",
    "Permission was granted to enter the building.", "The software was copied from an older version.",
    "She works at MIT as a researcher.", "The public domain of the castle is open to visitors.",
    "All rights reserved.", "Copyright 2020 by the author.", "The Apache people live in the south west.",
    "Version 2.0 of the program was released in May.", "You may use this file for your own work.",
    "The foundation published its general terms.", "Creative people work in the commons.",
    "Source and binary packages are built every night.", "The following conditions are required by law.",
    "Free software is distributed in many copies.", "The bot answered under the terms of its license.",
]
COMMON = ("a an and any are as at be but by can for from has have he his if in is it its may more must no not of on or "
          "other she that the their there they this to under was we were which will with without you your 0 1 2 3 4").split()


def words_of(line: Column) -> Column:
    """Words ``[a-z]+`` and ``[0-9]+`` of a line in lower case, after ``NEGATION`` where a licensing verb is negated."""
    words = F.filter(F.split(F.lower(line), "[^a-z0-9]+|(?<=[a-z])(?=[0-9])|(?<=[0-9])(?=[a-z])"), lambda w: w != "")
    return F.when(line.rlike(IS_NEGATED), F.concat(F.array(F.lit(NEGATION)), words)).otherwise(words)


def paragraphs_of(text: Column) -> Column:
    """The paragraphs of a text: its lines, each with those that continue it."""
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), CONTINUED, "$1 "), "\n")


def _grams(words: Column, n: int) -> Column:
    places = F.sequence(F.lit(1), F.size(words) - (n - 1))
    return F.when(F.size(words) >= n, F.transform(places, lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(
        F.array().cast("array<string>"))


def grams_of(words: Column) -> Column:
    """The distinct n-grams of one to three words."""
    return F.array_distinct(F.concat(*[_grams(words, n) for n in (1, 2, 3)]))


def _has_anchor(gram: Column) -> Column:
    return F.exists(F.split(gram, " "), lambda w: ~w.isin(COMMON))


def _literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small fixed table from literals (no Python data source)."""
    cells = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])
    return spark.range(1).select(F.explode(cells).alias("r")).select("r.*")


def name_rows(spark: SparkSession) -> DataFrame:
    """(family, name): every name of each family, with each word for the version."""
    rows = _literal_rows(spark, [(f, n) for f, names in NAMES.items() for n in names], ["family", "pattern"])
    words = F.explode(F.array(*[F.lit(w) for w in VERSION_WORDS]))
    name = F.trim(F.regexp_replace(F.expr("replace(pattern, '&', word)"), " +", " "))
    return rows.select("family", "pattern", words.alias("word")).select("family", name.alias("name")).distinct()


def _framed(names: DataFrame, frames: list[str]) -> DataFrame:
    """(family, name, line): each name within each frame."""
    frame = F.explode(F.array(*[F.lit(x) for x in frames]))
    return names.select("family", "name", frame.alias("frame")).select("family", "name", F.expr("replace(frame, '%', name)").alias("line"))


def template_lines(spark: SparkSession) -> DataFrame:
    """(template, family, line, words) of each template."""
    rows = [(k, f, line) for k, (f, line) in enumerate((f, line) for f, lines in TEMPLATES.items() for line in lines)]
    return _literal_rows(spark, rows, ["template", "family", "line"]).withColumn("words", words_of(F.col("line")))


@dataclass
class LicenseModel:
    """Families in the order of the weights, the features' table and the acceptance threshold."""

    families: list[str]
    features: DataFrame          # (gram, weights array<double>, three boolean, templates array<int>)
    intercepts: list[float]
    names: dict[str, list[str]]  # whole names by family
    sizes: dict[int, int]        # three-word shingles of each template
    family_of: dict[int, str]
    threshold: float = MIN_PROBABILITY


def _candidates(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """(keys, pos, words): the paragraphs that hold a key word."""
    lines = F.transform(paragraphs_of(F.col(text_col)), lambda line, i: F.struct(i.alias("pos"), line.alias("line")))
    found = F.filter(lines, lambda x: x["line"].rlike(HAS_KEY))
    return (docs.where(F.col(text_col).rlike(HAS_KEY)).select(*keys, F.explode(found).alias("l"))
                .select(*keys, "l.pos", words_of(F.col("l.line")).alias("words")))


def _named(words: Column, names: dict[str, list[str]]) -> Column:
    """The families of which the words hold a name whole, sorted."""
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    return F.filter(F.array(*[F.when(joined.rlike(f" (?:{'|'.join(known)}) "), F.lit(family)) for family, known in sorted(names.items())]),
                    lambda x: x.isNotNull())


def _matched(lines: DataFrame, keys: list[str], features: DataFrame) -> DataFrame:
    """One row per line and feature; ``shingles`` counts the line's distinct three-word shingles."""
    return (lines.withColumn("shingles", F.size(F.array_distinct(_grams(F.col("words"), 3))))
                 .select(*keys, "pos", "shingles", "named", F.explode(grams_of(F.col("words"))).alias("gram"))
                 .join(F.broadcast(features), "gram"))


def _probabilities(matched: DataFrame, keys: list[str], model: LicenseModel) -> DataFrame:
    """(keys, pos, shingles, named, family, probability): the likeliest class of each line; families before unknown in ties."""
    n = len(model.families)
    sums = [F.sum(F.col("weights")[k]).alias(f"z{k}") for k in range(n)]
    scored = matched.groupBy(*keys, "pos", "shingles", "named").agg(*sums)
    z = [F.col(f"z{k}") + F.lit(model.intercepts[k]) for k in range(n)]
    top = F.greatest(*z)
    total = reduce(lambda a, b: a + b, [F.exp(x - top) for x in z])
    family = F.coalesce(*[F.when(x == top, F.lit(name)) for x, name in zip(z, model.families, strict=True)])
    return scored.select(*keys, "pos", "shingles", "named", family.alias("family"), (1 / total).alias("probability"))


def _similarity(matched: DataFrame, keys: list[str], model: LicenseModel) -> DataFrame:
    """(keys, pos, family, similarity): the best template of each family a line shares shingles with.

    Similarity is the shared share of the template's or of the line's shingles, whichever is larger.
    """
    size = F.create_map(*[F.lit(x) for kv in model.sizes.items() for x in kv])
    family = F.create_map(*[F.lit(x) for kv in model.family_of.items() for x in kv])
    shared = (matched.where("three").select(*keys, "pos", "shingles", F.explode("templates").alias("template"))
                     .groupBy(*keys, "pos", "shingles", "template").agg(F.count(F.lit(1)).alias("n")))
    best = F.col("n") / F.least(F.col("shingles"), size[F.col("template")])
    return (shared.select(*keys, "pos", family[F.col("template")].alias("family"), best.alias("similarity"))
                  .groupBy(*keys, "pos", "family").agg(F.max("similarity").alias("similarity")))


def learn(docs: DataFrame, text_col: str = "text", corpus_weight: float = CORPUS_WEIGHT) -> LicenseModel:
    """A model from the fixed wordings and from all paragraphs of all texts that hold a key word but no wording."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    spark = prepare(docs.sparkSession)
    templates, wordings = template_lines(spark), name_rows(spark)
    framed = _framed(wordings, FRAMES)
    grams = (templates.select("template", "family", F.explode(grams_of(F.col("words"))).alias("gram"))
                      .where(_has_anchor(F.col("gram"))))
    sizes = {r["template"]: r["n"] for r in templates.select("template", F.size(F.array_distinct(_grams(F.col("words"), 3))).alias("n")).collect()}
    family_of = {r["template"]: r["family"] for r in templates.select("template", "family").collect()}
    named: dict[str, list[str]] = {}
    for r in wordings.orderBy("family", "name").collect():
        named.setdefault(r["family"], []).append(r["name"])

    # Corpus paragraphs with a key word, without a template's shingle and without a name.
    three = sorted(r["t"] for r in grams.where(F.size(F.split("gram", " ")) == 3).select(F.col("gram").alias("t")).distinct().collect())
    # Written before they are looked at: a condition on the words would else be pushed below them, and split the line for every n-gram.
    lines = _candidates(docs.select(F.col(text_col).alias("text")).where("text is not null"), [], "text").select(F.array_join("words", " ").alias("line"))
    lines = cut(lines.distinct().select(F.monotonically_increasing_id().alias("key"), F.split("line", " ").alias("words"),
                                        (F.pmod(F.crc32(F.col("line").cast("binary")), F.lit(2)) == 1).alias("held")), "licence-candidates")
    corpus = cut(lines.where((F.size(_named(F.col("words"), named)) == 0) & ~F.exists(_grams(F.col("words"), 3), lambda g: g.isin(three))), "licence-corpus")
    unheld = corpus.where(~F.col("held"))
    # Each line weighs the same, and all together no more than ``corpus_weight``, however large the corpus.
    line_weight = min(1.0, corpus_weight / max(1, unheld.count()))

    # Each template whole, its halves, and inside a longer line, and the framed names; negatives: fixed lines,
    # names that are mentioned or negated, and corpus lines.
    w, half = F.col("words"), F.ceil(F.size("words") / 2).cast("int")
    lead, tail = words_of(F.lit("copyright 2020 the authors")), words_of(F.lit("see the file for details"))
    long = F.size("words") >= 12
    forms = F.filter(F.array(w, F.concat(lead, w), F.concat(w, tail), F.when(long, F.slice(w, F.lit(1), half)),
                             F.when(long, F.slice(w, half + 1, F.size("words")))), lambda x: x.isNotNull())
    names = [*sorted(TEMPLATES), UNKNOWN]
    index = F.create_map(*[F.lit(x) for k, f in enumerate(names) for x in (f, float(k))])
    positive = (templates.select(index[F.col("family")].alias("label"), F.explode(forms).alias("words"))
                .union(framed.select(index[F.col("family")], words_of(F.col("line")))))
    negative = (_literal_rows(spark, [(x,) for x in NOT_LICENSES], ["line"]).union(_framed(wordings, MENTIONS + NEGATED).select("line"))
                .select(words_of(F.col("line")).alias("words"), F.lit(1.0).alias("weight")).union(unheld.select("words", F.lit(line_weight))))
    # A bare name is the plainest notice: it weighs as much as its negatives, so that unseen words around it leave it one.
    bare = wordings.select(index[F.col("family")], words_of(F.col("name")), F.lit(float(BARE_WEIGHT)))
    rows = (positive.withColumn("weight", F.lit(1.0)).union(negative.select(F.lit(float(len(names) - 1)), "words", "weight")).union(bare))
    rows = rows.select("label", "weight", F.filter(grams_of(F.col("words")), _has_anchor).alias("grams"))
    # Bounded by the wordings, whatever the corpus holds.
    fixed = positive.select("words").union(_framed(wordings, MENTIONS + NEGATED).select(words_of(F.col("line"))))
    vocabulary = sorted(r["gram"] for r in fixed.select(F.explode(grams_of(F.col("words"))).alias("gram")).where(_has_anchor(F.col("gram"))).distinct().collect())
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features", binary=True).transform(rows)
    # Short sparse rows, passed over many times: as few partitions as their number needs.
    vectors = vectors.select("label", "weight", "features").checkpoint(eager=True)
    vectors = vectors.coalesce(vectors.count() // TASK_ROWS + 1)
    fitted = LogisticRegression(family="multinomial", regParam=REGULARISATION, maxIter=60, standardization=False, weightCol="weight").fit(vectors)
    weights, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray().tolist()

    # One row per n-gram of the fixed wordings, so it is broadcast.
    own = grams.groupBy("gram").agg(F.sort_array(F.collect_set("template")).alias("templates"))
    table = spark.createDataFrame([(g, weights[:, k].tolist()) for k, g in enumerate(vocabulary)], "gram string, weights array<double>", verifySchema=False)
    features = (table.join(own, "gram", "left").withColumn("three", F.size(F.split("gram", " ")) == 3)).checkpoint(eager=True)
    model = LicenseModel(names, features, intercepts, named, sizes, family_of)
    held = corpus.where("held").select("key", F.lit(0).alias("pos"), "words", F.array().cast("array<string>").alias("named"))
    seen = _probabilities(_matched(held, ["key"], features), ["key"], model).where(F.col("family") != UNKNOWN)
    # Six places: the percentile's table of distinct values stays small, however many lines there are.
    worst = seen.agg(F.percentile(F.round("probability", 6), F.lit(0.999)).alias("p")).first()["p"]
    model.threshold = min(0.95, max(MIN_PROBABILITY, worst or 0.0))
    return model


def scan(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_hash, pos, family, probability, similarity, confirmed): the paragraphs taken for licence notices.

    ``pos`` is the paragraph's number from 0.  A paragraph counts if a family
    is likelier than the threshold and than unknown; it is ``confirmed`` if it
    is similar to a template of that family or holds a name of it whole (then
    its similarity is 1).  Null and empty texts have no such paragraphs;
    repeated rows count once; a null id stays null.
    """
    keys = ["id", "text_hash"]
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    lines = _candidates(rows, keys, "text").withColumn("named", _named(F.col("words"), model.names))
    matched = cut(_matched(lines, keys, model.features).distinct(), "licence-lines")
    named = _probabilities(matched, keys, model).where((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold))
    like = _similarity(matched, keys, model)
    same = (named["id"].eqNullSafe(like["id"])) & (named["text_hash"] == like["text_hash"]) & (named["pos"] == like["pos"]) \
        & (named["family"] == like["family"])
    out = named.join(like.select("id", "text_hash", "pos", "family", "similarity"), same, "left")
    similarity = F.when(F.array_contains(named["named"], named["family"]), 1.0).otherwise(F.coalesce("similarity", F.lit(0.0)))
    return (out.select(named["id"].alias(id_col), named["text_hash"], named["pos"], named["family"], "probability", similarity.alias("similarity"))
               .withColumn("confirmed", F.col("similarity") >= MIN_SIMILARITY))


def scan_documents(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_hash, n_lines, n_notices, families, unconfirmed, probability) for each distinct (id, text).

    ``families``: confirmed families, sorted and comma-joined ("" for none);
    ``unconfirmed``: paragraphs with a likely family but no similar template;
    ``probability``: the highest of the confirmed paragraphs, else 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                       F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, "\n"))).alias("n_lines")).distinct()
    sure = F.col("confirmed")
    found = (scan(docs, model, id_col, text_col).withColumnRenamed(id_col, "__id").withColumnRenamed("text_hash", "__hash")
             .groupBy("__id", "__hash").agg(
                 F.count(F.when(sure, 1)).alias("n_notices"), F.array_join(F.sort_array(F.collect_set(F.when(sure, F.col("family")))), ",").alias("families"),
                 F.count(F.when(~sure, 1)).alias("unconfirmed"), F.max(F.when(sure, F.col("probability"))).alias("probability")))
    same = rows["id"].eqNullSafe(found["__id"]) & (rows["text_hash"] == found["__hash"])
    none = F.lit(0).cast("long")
    return rows.join(found, same, "left").select(
        F.col("id").alias(id_col), "text_hash", F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce("n_notices", none).alias("n_notices"), F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("unconfirmed", none).alias("unconfirmed"), F.coalesce("probability", F.lit(0.0)).alias("probability"))
