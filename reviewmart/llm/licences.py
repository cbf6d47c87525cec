"""Licence statements by a trained paragraph classifier, in DataFrame and SQL functions only."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm.common import table
from reviewmart.session import stage

UNKNOWN = "unknown"
#: Statements of each licence family that the classifier learns and compares with.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This software is distributed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Released under the GNU General Public License, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Distributed under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Distributed under the terms of the GNU Affero General Public License.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Proprietary and confidential. Unauthorized copying is strictly prohibited.",
    ),
}
#: Names of each family, as words in a row. They teach the classifier too.
TITLES: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("apache license version 2.0", "apache license 2.0", "apache 2.0 license", "apache-2.0"),
    "mit": ("mit license", "license identifier mit", "spdx-license-identifier mit"),
    "gpl": ("gnu general public license", "gnu gpl", "gpl-3.0-only", "gpl-2.0-or-later"),
    "lgpl": ("gnu lesser general public license", "gnu lgpl", "lgpl-2.1-or-later"),
    "agpl": ("gnu affero general public license", "gnu agpl", "agpl-3.0-only"),
    "bsd": ("bsd license", "bsd 3-clause license", "bsd 2-clause license", "bsd-3-clause"),
    "mpl-2.0": ("mozilla public license", "mpl-2.0"),
    "cc-by": ("cc by 4.0", "creative commons attribution 4.0", "cc-by-4.0"),
    "cc-by-nc": ("cc by-nc 4.0", "creative commons attribution-noncommercial 4.0", "cc-by-nc-4.0"),
    "cc-by-sa": ("cc by-sa 4.0", "creative commons attribution-sharealike 4.0", "cc-by-sa-4.0"),
    "cc0": ("cc0 1.0", "cc0-1.0"),
    "proprietary": ("all rights reserved",),
}
#: Sentences with the same words that state no licence.
NEAR_MISSES = (
    "The driver needs a valid license to drive a car.",
    "The apache helicopter landed in the field and the crew left.",
    "MIT researchers released a new study of the general public.",
    "He was granted permission to use the source of the river.",
    "Version 3 of the form is subject to the terms of the contract.",
    "The commons committee discussed public domain land under the law.",
    "They reserved all rooms for the distribution of the work.",
    "A software program is free to modify any file in binary forms.",
    "The license plate of the car was copied by any person.",
    "The author published a universal creative work in the library.",
    "License fees are discussed in chapter 2.0 of the manual.",
    "You may use the library in compliance with the rules of this project.",
)
#: Corpus lines of least hash that teach the unknown class, unless they resemble a template.
CORPUS_LINES = 600
#: The likeliest family is confirmed where a template of it shares this part of its words.
LEAST_OVERLAP = 0.6
#: Lines found, and their bytes, up to which they are broadcast to all lines; beyond, lines are shuffled.
BROADCAST_FOUND, BROADCAST_BYTES = 100_000, 1 << 24
#: A line break that cuts a sentence: no full stop, colon or semicolon before, and no empty line after.
WRAP = r"([^\s.!?:;])[ \t\r]*\n[ \t]*(?=\S)"


def words_of(line: Column) -> Column:
    """Lower-case runs of letters and digits; a dot or hyphen inside belongs to the word."""
    return F.regexp_extract_all(F.lower(line), F.lit(r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"), F.lit(0))


def grams_of(words: Column) -> Column:
    """Distinct words and pairs of neighbours."""
    pairs = F.when(
        F.size(words) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - 1),
            lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(words, pairs))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line) of all paragraphs; a null text has none, blank ones do not count."""
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.withColumn("line", F.trim("line")).where("line <> ''")


def wrapped_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line) of the sentences that go over several lines, joined by blanks.

    A joined break is marked first, so that a line that was never cut is told apart; the mark
    itself reads as a blank where a text holds it.
    """
    joined = F.regexp_replace(F.translate("text", "\u2028", " "), WRAP, "$1\u2028 ")
    lines = docs.select("doc_id", F.explode(F.split(joined, "\n")).alias("line"))
    lines = lines.where(F.contains("line", F.lit("\u2028")))
    return lines.select("doc_id", F.trim(F.regexp_replace("line", "\u2028", "")).alias("line"))


@dataclass
class LicenceModel:
    families: list[str]
    bias: list[float]
    weights: dict[str, list[float]]
    temperature: float = 1.0
    cues: list[str] = field(default_factory=list)


def _training_rows(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """(family, words, held, stated): templates and near misses, two in three fitted on, and corpus lines."""
    stated = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    stated += [(UNKNOWN, text) for text in NEAR_MISSES]
    stated += [(family, text) for family, texts in TITLES.items() for text in texts]
    rows = [(family, text, i % 3 == 2) for i, (family, text) in enumerate(stated)]
    given = spark.createDataFrame(rows, "family string, line string, held boolean").withColumn("words", words_of(F.col("line")))
    given = given.withColumn("stated", F.lit(True))
    cue_words = sorted({w for texts in TEMPLATES.values() for t in texts for w in re.findall(r"[a-z]{4,}", t.lower())})
    hashed = F.xxhash64("line")
    spread = 1 << 30
    # Lines whose hash is too great are dropped where they lie.
    corpus = (
        lines.select("line")
        .where(F.pmod(hashed, F.lit(spread)) * F.lit(lines.count()) < spread * 20 * CORPUS_LINES)
        .distinct()
        .orderBy(F.pmod(hashed, F.lit(spread)), "line")
        .limit(CORPUS_LINES)
        .withColumn("words", words_of(F.col("line")))
        .where(F.size(F.array_intersect("words", F.array(*map(F.lit, cue_words)))) < 2)
        .select(F.lit(UNKNOWN).alias("family"), "words", (F.pmod(hashed, F.lit(3)) == 2).alias("held"), F.lit(False).alias("stated"))
    )
    return given.select("family", "words", "held", "stated").unionAll(corpus)


def fit(spark: SparkSession, lines: DataFrame) -> LicenceModel:
    """Learn sparse weights of word n-grams; ``lines`` (line) teach what corpus lines look like.

    All statements are fitted; the held third, fitted without, sets the temperature.
    """
    rows = stage(_training_rows(spark, lines), "licence_rows").withColumn("grams", grams_of(F.col("words")))
    families = [*TEMPLATES, UNKNOWN]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    # Some hundred short rows, whatever the corpus: one partition, so a step is one task.
    rows = rows.withColumn("label", number.cast("double")).coalesce(1).sortWithinPartitions("label", "words").cache()

    # N-grams of the statements alone: no other can speak for a family.
    spoken = rows.where("stated").select(F.explode("grams").alias("gram")).distinct()
    vocabulary = sorted(r["gram"] for r in spoken.collect())

    def trained(part: DataFrame) -> LicenceModel:
        counts = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
        counts.setBinary(True)
        weighted = part.withColumn("w", F.when(F.col("family") == UNKNOWN, 0.2).otherwise(1.0))
        regression = LogisticRegression(
            family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=40, weightCol="w", standardization=False
        )
        model = regression.fit(counts.transform(weighted))
        matrix = model.coefficientMatrix.toArray().tolist()
        known = len(matrix)
        weights = {g: [matrix[k][i] for k in range(known)] for i, g in enumerate(counts.vocabulary)}
        return LicenceModel(families[:known], model.interceptVector.tolist(), {g: w for g, w in weights.items() if any(w)})

    try:
        whole = trained(rows)
        held = rows.where("held").select("label", "grams").collect()
        usual = rows.where(F.col("family") == UNKNOWN).select(F.explode(F.array_distinct("words")).alias("word"))
        seen = {r["word"]: r["count"] for r in usual.groupBy("word").count().collect()}
        rough = trained(rows.where("NOT held"))
    finally:
        rows.unpersist()
    whole.temperature = _best_temperature(rough, [(int(r["label"]), r["grams"]) for r in held])
    whole.cues = _cues(whole, seen)
    return whole


def _best_temperature(model: LicenceModel, rows: list[tuple[int, list[str]]]) -> float:
    """The temperature of least log loss on statements that the weights have not seen."""
    logits = [
        [b + sum(model.weights[g][k] for g in grams if g in model.weights) for k, b in enumerate(model.bias)]
        for _, grams in rows
    ]

    def loss(t: float) -> float:
        total = 0.0
        for (label, _), row in zip(rows, logits):
            top = max(row)
            total += math.log(sum(math.exp((x - top) / t) for x in row)) - (row[label] - top) / t
        return total

    return min((0.3 * 1.1**i for i in range(30)), key=loss) if rows else 1.0


def _cues(model: LicenceModel, seen: dict[str, int]) -> list[str]:
    """Words one of which a line must hold to be no unknown. ``seen``: how many of the sampled
    corpus lines hold a word.

    A family beats unknown only if the n-grams that speak for it outweigh the bias. For each
    family the n-grams most usual in the corpus are set aside as long as all of them together
    do not; every line found must then hold one of the others, and so its rarer word. Empty
    where a bias alone could do it.
    """
    unknown, cues = len(model.families) - 1, set()

    def rarer(gram: str) -> str:
        return min(gram.split(" "), key=lambda w: (seen.get(w, 0), w))

    for k in range(unknown):
        gap = model.bias[unknown] - model.bias[k]
        if gap <= 0:
            return []
        speaking = [(g, w[k] - w[unknown]) for g, w in model.weights.items() if w[k] > w[unknown]]
        for gram, gain in sorted(speaking, key=lambda x: (-seen.get(rarer(x[0]), 0), x[1], x[0])):
            if gap - gain > 1e-9:
                gap -= gain
            else:
                gap = 0.0
                cues.add(rarer(gram))
    return sorted(cues)


def classify(lines: DataFrame, model: LicenceModel) -> DataFrame:
    """``lines`` (line) as (line, family, probability, confirmed), each distinct line once a family.

    Lines without a cue are unknown by the model's own weights, and left out; so are those whose
    likeliest class is unknown. Of the families likelier than unknown, those named in the line are
    confirmed; the likeliest also by a template, and it is returned unconfirmed otherwise. The
    weights are a table of the n-grams of the training statements, so its size does not depend
    on the corpus.
    """
    spark = lines.sparkSession
    if model.cues:
        either = "|".join(re.escape(c) for c in model.cues)
        lines = lines.where(F.col("line").rlike(rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{either})(?![\p{{L}}\p{{N}}])"))
    distinct = stage(lines.select("line").distinct().withColumn("words", words_of(F.col("line"))), "lines")
    names = [f"w{k}" for k in range(len(model.families))]
    weights = spark.createDataFrame(
        [(g, *w) for g, w in sorted(model.weights.items())], "gram string, " + ", ".join(f"{n} double" for n in names)
    )
    sums = (
        distinct.select("line", F.explode(grams_of(F.col("words"))).alias("gram"))
        .join(F.broadcast(weights), "gram")
        .groupBy("line")
        .agg(*(F.sum(n).alias(n) for n in names))
    )
    logits = [(F.col(n) + b) / model.temperature for n, b in zip(names, model.bias)]
    each = F.array(*(F.struct(F.lit(f).alias("family"), x.alias("logit")) for f, x in zip(model.families, logits)))
    scored = (
        sums.select("line", each.alias("each"), F.array_max(F.array(*logits)).alias("top"))
        .withColumn("all", F.aggregate("each", F.lit(0.0), lambda s, x: s + F.exp(x.logit - F.col("top"))))
        .withColumn("unknown", F.filter("each", lambda x: x.family == UNKNOWN)[0].logit)
        .select("line", "top", "all", F.explode(F.filter("each", lambda x: x.logit > F.col("unknown"))).alias("one"))
        .select(
            "line",
            "one.family",
            (F.exp(F.col("one.logit") - F.col("top")) / F.col("all")).alias("probability"),
            (F.col("one.logit") == F.col("top")).alias("likeliest"),
        )
    )
    compared = spark.createDataFrame(
        [(f, list(TEMPLATES[f]), [f" {t} " for t in TITLES[f]]) for f in TEMPLATES],
        "family string, texts array<string>, titles array<string>",
    )
    overlap = F.array_max(
        F.transform(
            "texts",
            lambda t: F.size(F.array_intersect(words_of(t), F.col("words"))) / F.size(F.array_distinct(words_of(t))),
        )
    )
    spaced = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    named = F.exists("titles", lambda t: F.contains(spaced, t))
    return (
        scored.join(distinct, "line")
        .join(F.broadcast(compared), "family")
        .withColumn("confirmed", named | (F.col("likeliest") & (overlap >= LEAST_OVERLAP)))
        .where("confirmed OR likeliest")
        .select("line", "family", "probability", "confirmed")
    )


def scan(docs: DataFrame) -> DataFrame:
    """Licence families stated in ``docs`` (doc_id, text; others are ignored).

    Returns one row per distinct doc_id: doc_id, n_lines (lines that are not blank), n_licence
    (confirmed statements; a line that states two families counts for both), n_unconfirmed
    (predicted, but unlike every template and without the name), families (sorted, joined by
    commas; empty without any). Rows of one doc_id count as one document, and so do all null
    ones. Null and empty texts have no lines. Every line is classified, whole, and so is every
    sentence that goes over several lines; what such a sentence states counts where no single
    line of the document states it. Equal lines of all documents are classified once.
    """
    spark = docs.sparkSession
    lines, wrapped = lines_of(docs), wrapped_of(docs)
    model = fit(spark, lines)
    found = stage(classify(lines.select("line").unionAll(wrapped.select("line")), model), "found")

    def counted(rows: DataFrame, joined: bool) -> DataFrame:
        hits = rows.join(F.broadcast(found), "line") if small else rows.join(found, "line")
        return hits.groupBy("doc_id", "family", "confirmed").agg(F.count("*").alias("n")).withColumn("joined", F.lit(joined))

    small = found.count() <= BROADCAST_FOUND and (found.agg(F.sum(F.octet_length("line"))).first()[0] or 0) <= BROADCAST_BYTES
    of_lines = F.sum(F.when(~F.col("joined"), F.col("n")))
    families = (
        counted(lines, False)
        .unionAll(counted(wrapped, True))
        .groupBy("doc_id", "family")
        .agg(
            F.coalesce(
                F.sum(F.when(F.col("confirmed") & ~F.col("joined"), F.col("n"))),
                F.sum(F.when(F.col("confirmed"), F.col("n"))),
                F.lit(0),
            ).alias("stated"),
            F.coalesce(F.sum(F.when(~F.col("confirmed") & ~F.col("joined"), F.col("n"))), F.lit(0)).alias("of_lines"),
            F.coalesce(F.sum(F.when(~F.col("confirmed") & F.col("joined"), F.col("n"))), F.lit(0)).alias("of_joined"),
            of_lines.isNotNull().alias("in_lines"),
        )
    )
    # A sentence that no line hints at counts as unconfirmed by itself.
    unsure = F.when(F.col("in_lines") | (F.col("stated") > 0), F.col("of_lines")).otherwise(F.col("of_joined"))
    hits = families.groupBy("doc_id").agg(
        F.sum("stated").alias("n_licence"),
        F.sum(unsure).alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("stated") > 0, F.col("family")))), ",").alias("families"),
    )
    blank = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    sizes = docs.groupBy("doc_id").agg(F.sum(F.coalesce(F.size(blank), F.lit(0))).cast("long").alias("n_lines"))
    return sizes.join(hits, sizes["doc_id"].eqNullSafe(hits["doc_id"]), "left").select(
        sizes["doc_id"],
        "n_lines",
        F.coalesce("n_licence", F.lit(0)).cast("long").alias("n_licence"),
        F.coalesce("n_unconfirmed", F.lit(0)).cast("long").alias("n_unconfirmed"),
        F.coalesce("families", F.lit("")).alias("families"),
    )


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence statements of all documents."""
    return scan(table(spark, sf_dir, "documents"))


_SQL = """
WITH lines AS (
  SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line FROM documents),
named AS (
  SELECT doc_id, line, CASE line
    WHEN 'Licensed under CC BY-NC 4.0.' THEN 'cc-by-nc'
    WHEN 'Licensed under the Apache License, Version 2.0.' THEN 'apache-2.0'
    WHEN 'All rights reserved.' THEN 'proprietary'
    WHEN 'Released under the MIT License.' THEN 'mit'
    WHEN 'This work is licensed under the GNU General Public License, version 3.' THEN 'gpl' END AS family
  FROM lines WHERE line <> '')
SELECT d.doc_id, count(n.line)::BIGINT AS n_lines, count(n.family)::BIGINT AS n_licence, 0::BIGINT AS n_unconfirmed,
       coalesce(string_agg(DISTINCT n.family, ',' ORDER BY n.family), '') AS families
FROM documents d LEFT JOIN named n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

QUERIES = {"op8_licences": op8_licences}
#: The statements that the given documents hold, spelled out: what a right classifier finds there.
ORACLES = {"op8_licences": _SQL}
