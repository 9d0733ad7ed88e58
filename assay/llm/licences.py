"""License scans: a trained classifier of paragraphs, with an unknown class and template comparison.

Logistic regression over sparse word n-grams is trained here, on notices of each family and on
paragraphs of the corpus itself. Scoring joins the n-grams of a paragraph with the weights, all in
DataFrame functions. A family counts only above a probability calibrated on notices of licenses that
training never saw, and is confirmed by how much of the paragraph its templates contain.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, NGram
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import spread_sample
from assay.session import stage

NONE, UNKNOWN = "none", "unknown"
ORDERS = (1, 2, 3)
VOCABULARY = 4096
REGULARISATION, ROUNDS = 0.00002, 40
PARTS = 4  # partitions of the bounded training set
LEAST_WEIGHT = 0.02  # n-grams that tell classes apart by less are dropped
# Corpus text, in bytes, to take ordinary paragraphs for training from.
TRAINING_BYTES = 1_000_000
# Of notices of unseen licenses, the share that may pass for a known family.
FALSE_FAMILY = 0.02
# A paragraph of no sure class is an unknown license if its templates hold so much of it.
LIKENESS, LIKE_PAIRS = 0.4, 2
CONFIRMED = 0.5  # share of a paragraph's word pairs that its family's templates hold

# Names of each family, and sentences of its notices.
NAMES = {
    "mit": ["MIT License", "MIT license terms", "Expat License"],
    "apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license"],
    "gpl": [
        "GNU General Public License, version 3",
        "GNU General Public License version 2",
        "GNU GPL v3",
        "GPL-3.0 license",
    ],
    "lgpl": ["GNU Lesser General Public License, version 3", "GNU LGPL v2.1", "LGPL-2.1 license"],
    "agpl": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0 license"],
    "bsd": ["BSD 3-Clause License", "BSD 2-Clause License", "BSD license", "New BSD License"],
    "mpl": ["Mozilla Public License, version 2.0", "MPL 2.0"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 License"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 License"],
    "cc-by-nd": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 License"],
    "cc0": ["CC0 1.0", "CC0 1.0 Universal public domain dedication"],
    "isc": ["ISC License"],
}
NOTICES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "The above copyright notice and this permission notice shall be included in all copies",
        "The software is provided as is, without warranty of any kind, express or implied",
    ],
    "apache": [
        "You may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "distributed on an AS IS BASIS, without warranties or conditions of any kind",
    ],
    "gpl": [
        "You can redistribute it and/or modify it under the terms of the GNU General Public License",
        "as published by the Free Software Foundation, either version 3 of the License, or any later version",
    ],
    "lgpl": ["redistribute it under the terms of the GNU Lesser General Public License"],
    "agpl": ["redistribute it under the terms of the GNU Affero General Public License"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "cc0": ["The author has waived all copyright and related rights and dedicated the work to the public domain"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"],
    "proprietary": [
        "All rights reserved.",
        "Copyright, all rights reserved.",
        "No part of this publication may be reproduced without prior written permission of the publisher.",
        "This document is confidential and proprietary.",
        "Unauthorised copying of this file is strictly prohibited.",
    ],
}
FRAMES = (
    "Licensed under {}.",
    "Licensed under the {}.",
    "Released under the {}.",
    "Released under {}.",
    "This work is licensed under the {}.",
    "This work is licensed under {}.",
    "This project is distributed under the terms of the {}.",
    "The code is available under the {}.",
    "Published under {}, see the file LICENSE.",
    "SPDX-License-Identifier: {}",
)
# Licenses of no family here; the second half is kept from training, to calibrate with.
OTHER_NAMES = (
    "Open Harbour Licence", "Example Community License", "Artistic License", "Research Use Agreement",
    "House Content License, version 1", "Academic Free License", "Zeta Source License", "Partner Terms",
    "Open Garden Licence", "Sample Vendor License", "Poetic License", "Evaluation Use Agreement",
    "Local Content License, version 2", "Common Reader License", "Omega Source License", "Member Terms",
)


@dataclass(frozen=True)
class Model:
    """For each class its bias; for each n-gram a weight per class, and the families that use it;
    the least probability of a known family."""

    classes: tuple[str, ...]
    biases: tuple[float, ...]
    weights: dict[str, list[float]]
    families: dict[str, list[str]]
    threshold: float


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"), F.lit(0))


def word_grams(tokens: Column) -> Column:
    """The distinct runs of one to three words."""

    def runs(n: int) -> Column:
        ends = F.sequence(F.lit(1), F.size(tokens) - F.lit(n - 1))
        made = F.transform(ends, lambda i: F.concat_ws(" ", F.slice(tokens, i, F.lit(n))))
        return F.when(F.size(tokens) >= n, made).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*(runs(n) for n in ORDERS)))


def _literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table of fixed values. They are rows, not part of an expression: the driver keeps the text
    of each query's plan, again at each of its changes, and a plan has its expressions written out."""
    return spark.createDataFrame(pa.Table.from_pylist(rows), schema).coalesce(1)


def _notices() -> list[dict]:
    rows = []
    for family, names in NAMES.items():
        rows += [(frame.format(name), family, False) for frame in FRAMES for name in names]
    for family, sentences in NOTICES.items():
        rows += [(s, family, False) for s in sentences for _ in range(6)]
    for k, name in enumerate(OTHER_NAMES):
        held = 2 * k >= len(OTHER_NAMES)
        rows += [(frame.format(name), UNKNOWN, held) for frame in FRAMES]
    return [{"text": t, "class": c, "held": h} for t, c, h in rows]


def _template_grams(spark: SparkSession, notices: DataFrame) -> dict[str, list[str]]:
    known = notices.where((F.col("class") != UNKNOWN))
    grams = known.select("class", F.explode(word_grams(words(F.col("text")))).alias("gram"))
    rows = grams.groupBy("gram").agg(F.sort_array(F.collect_set("class")).alias("classes"))
    return {r.gram: list(r.classes) for r in rows.collect()}  # as many as the fixed texts have


def train(docs: DataFrame, text: str = "text", key: str = "doc_id") -> Model:
    """Learn from the notices above and from a bounded sample of paragraphs of ``docs``."""
    spark = docs.sparkSession
    notices = _literal(spark, _notices(), "text string, class string, held boolean")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    sample = spread_sample(texts, F.concat_ws(" ", "key", "text"), F.octet_length("text"), TRAINING_BYTES)
    lines = sample.select(F.explode(F.split("text", "\n")).alias("text")).where("text <> ''").distinct()
    looks_like_one = r"(?i)licen[sc]|copyright|rights reserved|\bcc\b|permission|warrant|proprietary"
    ordinary = lines.where(~F.rlike("text", F.lit(looks_like_one))).select(
        "text", F.lit(NONE).alias("class"), (F.pmod(F.xxhash64("text"), F.lit(5)) == 0).alias("held")
    )
    examples = stage(
        notices.union(ordinary)
        .union(_literal(spark, [{"text": "", "class": NONE, "held": False}] * 2, "text string, class string, held boolean"))
        .withColumn("words", words(F.col("text")))
        .select("text", "class", "held", word_grams(F.col("words")).alias("grams")),
        "examples",
    )
    learned = examples.where("not held").repartition(PARTS)
    classes = [r[0] for r in learned.select("class").distinct().orderBy("class").collect()]
    label = reduce(
        lambda c, k: c.when(F.col("class") == classes[k], float(k)), range(1, len(classes)),
        F.when(F.col("class") == classes[0], 0.0),
    )
    notice = F.col("class") != NONE
    sums = learned.agg(F.sum(notice.cast("int")).alias("notices"), F.count("*").alias("all")).first()
    # ordinary paragraphs, however many, weigh as much as the notices together
    weight = F.when(notice, 1.0).otherwise(min(1.0, sums.notices / (sums["all"] - sums.notices)))
    counted = CountVectorizer(
        inputCol="grams", outputCol="features", binary=True, minDF=2, vocabSize=VOCABULARY
    ).fit(learned)
    fitted = LogisticRegression(
        family="multinomial", weightCol="weight", regParam=REGULARISATION, maxIter=ROUNDS
    ).fit(counted.transform(learned.withColumn("label", label).withColumn("weight", weight)))
    matrix = fitted.coefficientMatrix.toArray()
    used = [(gram, matrix[:, k]) for k, gram in enumerate(counted.vocabulary)]
    used = [(gram, w) for gram, w in used if w.max() - w.min() >= LEAST_WEIGHT]
    model = Model(
        tuple(classes),
        tuple(float(b) for b in fitted.interceptVector),
        {gram: [float(x) for x in column] for gram, column in used},
        _template_grams(spark, notices),
        0.5,
    )
    strange = examples.where("held").select(F.monotonically_increasing_id().alias("row"), "grams")
    passed = classified(strange, model).agg(
        F.percentile("known_probability", F.lit(1 - FALSE_FAMILY)).alias("at")
    )
    at = passed.first()["at"]
    return replace(model, threshold=max(0.5, min(0.95, at or 0.5)))


def _may_be_notice(lines: DataFrame, model: Model) -> DataFrame:
    """The rows of ``lines``, which have their ``words``, less those that are ordinary for certain, and
    a number for each, ``row``.

    Every n-gram of every paragraph counts. A notice is a row with a probability of ``none`` below one
    half or with enough word pairs of one template. The first asks that another class' lead over
    ``none`` is above ``-log(number of other classes)``; no lead is above the sum of the n-grams' best
    leads. The second asks for as many pairs of all templates together. What either lets through is
    for ``classified`` to decide.
    """
    names = model.classes
    none = names.index(NONE)
    grams = sorted(set(model.weights) | set(model.families))

    def lead(values) -> float:
        return max(x for k, x in enumerate(values) if k != none) - values[none]

    leads = _fixed([lead(model.weights[g]) if g in model.weights else 0.0 for g in grams], "double")
    template_pair = _fixed([g in model.families and g.count(" ") == 1 for g in grams], "boolean")
    made = lines
    for n in ORDERS[1:]:
        made = NGram(n=n, inputCol="words", outputCol=f"runs{n}").transform(made)
    made = made.withColumn("all_runs", F.concat("words", *(f"runs{n}" for n in ORDERS[1:])))
    counter = CountVectorizerModel.from_vocabulary(grams, "all_runs", "features", binary=True)
    # Spark moves no filter below a numbering; it would work out the n-grams again at each mention there
    made = counter.transform(made).select(
        *lines.columns,
        "runs2",
        F.unwrap_udt("features")["indices"].alias("known"),
        F.monotonically_increasing_id().alias("row"),
    )
    best = F.aggregate("known", F.lit(lead(model.biases)), lambda a, i: a + F.get(leads, i))
    alike = F.size(F.filter("known", lambda i: F.get(template_pair, i)))
    # equal hashes of different pairs make this smaller, and let more through
    pairs = F.size(F.array_distinct(F.transform("runs2", lambda x: F.xxhash64(x))))
    slack = 1e-6  # for sums in another order
    return made.where(
        (best > -math.log(len(names) - 1) - slack)
        | ((alike >= LIKE_PAIRS) & (alike >= LIKENESS * pairs - slack))
    ).select("row", *lines.columns)


def _fixed(values: list, kind: str) -> Column:
    """A constant array."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def classified(paragraphs: DataFrame, model: Model) -> DataFrame:
    """``(row, pairs, none_probability, known, known_probability, similarity)`` for rows ``(row, grams)``.

    ``similarity`` is the share of the word pairs that the templates of the likeliest known family
    hold (of the single words, in a paragraph of one word). Only rows with a known n-gram appear.
    """
    names = model.classes
    grams = sorted(set(model.weights) | set(model.families))
    zero = [0.0] * len(names)
    table = _literal(
        paragraphs.sparkSession,
        [{"gram": g, "w": model.weights.get(g, zero), "f": model.families.get(g, [])} for g in grams],
        "gram string, w array<double>, f array<string>",
    )
    each = paragraphs.select(
        "row",
        F.greatest(F.size(F.filter("grams", _is_pair)), F.lit(1)).alias("pairs"),
        F.explode("grams").alias("gram"),
    )
    # at most VOCABULARY rows and those of the fixed notices
    found = each.join(F.broadcast(table), "gram")
    pair = _is_pair(F.col("gram")) | (F.col("pairs") < 2)
    sums = found.groupBy("row", "pairs").agg(
        *(F.sum(F.col("w")[k]).alias(f"w{k}") for k in range(len(names))),
        *(
            F.sum((pair & F.array_contains("f", n)).cast("double")).alias(f"f{k}")
            for k, n in enumerate(names)
        ),
    )
    odds = F.array(*(F.col(f"w{k}") + F.lit(b) for k, b in enumerate(model.biases)))
    top = F.array_max(odds)
    shares = F.transform(odds, lambda x: F.exp(x - top))
    total = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    options = F.array(
        *(
            F.struct(
                (F.get(shares, F.lit(k)) / total).alias("probability"),
                F.lit(n).alias("class"),
                F.least(F.col(f"f{k}") / F.col("pairs"), F.lit(1.0)).alias("similarity"),
            )
            for k, n in enumerate(names)
        )
    )
    ranked = sums.select("row", "pairs", options.alias("options"))
    known = F.array_max(F.filter("options", lambda o: ~o["class"].isin(NONE, UNKNOWN)))
    return ranked.select(
        "row",
        "pairs",
        F.get("options", F.lit(names.index(NONE)))["probability"].alias("none_probability"),
        known["probability"].alias("known_probability"),
        known["similarity"].alias("similarity"),
        known["class"].alias("known"),
    )


def _is_pair(gram: Column) -> Column:
    return F.length(gram) - F.length(F.replace(gram, F.lit(" "))) == 1


def scan(docs: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each paragraph (line) that is a license notice.

    ``(key, paragraph, family, probability, similarity, confirmed, notice)``: the paragraph's number
    in its document from 0; the family, or ``unknown`` where no family reaches the calibrated
    probability but the paragraph reads like a notice; how much of it the family's templates hold, and whether that confirms it. Ordinary
    paragraphs, null and empty texts give no row. Repeated rows give repeated rows; a null key stays
    null; other columns are not read.
    """
    model = model or train(docs, text, key)
    lines = docs.select(
        F.col(key).alias("key"), F.posexplode(F.split(F.col(text), "\n")).alias("paragraph", "notice")
    )
    candidates = stage(
        _may_be_notice(lines.withColumn("words", words(F.col("notice"))), model).select(
            "row",
            "key",
            "paragraph",
            "notice",
            word_grams(F.col("words")).alias("grams"),
        ),
        "paragraphs",
    )
    alike = (F.col("similarity") >= LIKENESS) & (F.col("similarity") * F.col("pairs") >= LIKE_PAIRS)
    found = classified(candidates.select("row", "grams"), model).where(
        (F.col("none_probability") < 0.5) | alike
    )
    known = F.col("known_probability") >= model.threshold
    return (
        candidates.drop("grams")
        .join(found, "row")
        .select(
            F.col("key").alias(key),
            "paragraph",
            F.when(known, F.col("known")).otherwise(UNKNOWN).alias("family"),
            F.when(known, F.col("known_probability"))
            .otherwise(1 - F.col("none_probability"))
            .alias("probability"),
            F.when(known, F.col("similarity")).otherwise(0.0).alias("similarity"),
            (known & (F.col("similarity") >= CONFIRMED)).alias("confirmed"),
            "notice",
        )
    )
