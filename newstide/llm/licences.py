"""Licence notices in texts, by a trained paragraph classifier and template comparison.

The unit is a line of text. Its features are the sparse word n-grams (one and two words) that
occur in it, known by their hashes. A multinomial logistic regression with a sparsity
penalty, trained on variations of public notices and on a bounded sample of ordinary lines,
tells licence families and an ``unknown`` class. Its probabilities are calibrated on examples
held back from training: one temperature, and the least probability that lets next to no
ordinary line pass as a licence. Neighbouring licence lines settle on a family together; those
of one family are one paragraph, which the family's templates have to confirm by shared
three-word shingles.

Scoring is DataFrame work only. A family can only win against the intercept of the unknown
class with enough weight; the n-grams without which none can are the model's anchors. Lines
that hold an anchor have their weighted n-grams exploded, joined with the weights (the model's
size is bounded, so they are broadcast) and summed; all others are unknown. N-grams that ordinary
lines use, too, speak for no licence and get no weight, so that no common word becomes an
anchor, however many lines are sampled.
"""

from __future__ import annotations

import json
import math
import random
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newstide.functions.binding import bound

UNKNOWN = "unknown"
#: n-grams a model may weigh, and ordinary texts and lines it learns from, about
VOCABULARY = 4096
SAMPLE_TEXTS = 600
SAMPLE_LINES = 2500
#: share of the sampled ordinary lines (and number, at least) above which an n-gram gets no weight
COMMON, FEW = 0.002, 3
#: variations made of each template
VARIATIONS = 24
#: shingles a paragraph and a template must share, as a share of the smaller one's
CONFIRMED = 0.6
#: how much a neighbouring line's evidence counts beside a line's own
NEIGHBOUR = 0.75
#: ordinary lines held back that may pass, at most
PASSING = 0.002

# Short public notices by licence family, and sentences that only sound alike.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
        "Released under the GNU GPL version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Content is available under the Creative Commons Attribution License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "public-domain": [
        "This work has been released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work. "
        "CC0 1.0 Universal",
        "This is free and unencumbered software released into the public domain.",
    ],
    "all-rights-reserved": [
        "Copyright 2020 by the authors. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written "
        "permission of the publisher.",
    ],
}
ALIKE = [
    "A valid driving license is required to rent a car.",
    "The minister refused to renew the fishing licence.",
    "Version 2.0 was released in the spring.",
    "The software was released under great pressure.",
    "This work was published in the journal last year.",
    "The general public was not allowed to enter.",
    "Under the terms of the contract the company may withdraw.",
    "He studied at MIT and later taught mathematics.",
    "The Apache people live in the south of the country.",
    "Members of the public asked for a copy of the report.",
    "The rights of the workers were reserved for later talks.",
    "The domain of the function is the set of real numbers.",
]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.][0-9]+)*"), F.lit(0))


def _shingles(own: Column) -> Column:
    """Hashes of three words in a row; of all words of a shorter line."""

    def made(own: Column) -> Column:
        joined = F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(own) - 2, F.lit(1))),
            lambda i: F.xxhash64(F.array_join(F.slice(own, i, 3), " ")),
        )
        return F.when(F.size(own) > 0, F.array_distinct(joined)).otherwise(F.array().cast("array<bigint>"))

    return bound(own, made)


def _grams(own: Column) -> Column:
    """Hashes of the words and word pairs of a line."""
    single = F.transform(own, lambda w: F.xxhash64(w))
    pairs = F.zip_with(
        F.slice(own, 1, F.greatest(F.size(own) - 1, F.lit(0))),
        F.slice(own, 2, F.greatest(F.size(own) - 1, F.lit(0))),
        lambda a, b: F.xxhash64(a, b),
    )
    return F.concat(single, pairs)


def _local(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small table of fixed rows, as one literal of the plan."""
    fields = [part.rsplit(" ", 1) for part in ddl.split(", ")]
    given = json.dumps([dict(zip((name for name, _ in fields), row)) for row in rows])
    kind = ",".join(f"{name}:{kind}" for name, kind in fields)
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(given), f"array<struct<{kind}>>")))


def lines(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``line`` number and ``text`` of every line."""
    own = docs.where("text is not null").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return own.select("row", "doc_id", F.posexplode(F.split("text", "\r?\n")).alias("line", "text"))


def examples() -> list[tuple[str, str]]:
    """(family, text): every template whole, cut short and with words missing or around it."""
    draw, made = random.Random(5), []
    filler = "and the project files were moved there with some other notes of last week for you".split()
    for family, templates in TEMPLATES.items():
        for template in templates:
            own = template.split()
            made += [(family, template)] * 4
            for _ in range(VARIATIONS):
                kept = [w for w in own if draw.random() > 0.08] if len(own) > 8 else own
                if len(kept) > 10:  # a line of a notice set in narrow columns
                    start = draw.randrange(len(kept) - 7)
                    kept = kept[start : start + draw.randrange(7, min(18, len(kept) - start) + 1)]
                before = [draw.choice(filler) for _ in range(draw.choice((0, 0, 1, 3)))]
                after = [draw.choice(filler) for _ in range(draw.choice((0, 0, 1, 3)))]
                made.append((family, " ".join(before + kept + after)))
    made += [(UNKNOWN, text) for text in ALIKE for _ in range(8)]
    made += [(UNKNOWN, " ".join(draw.choice(filler) for _ in range(draw.randrange(3, 15)))) for _ in range(200)]
    return made


@dataclass(frozen=True)
class Model:
    """Sparse weights by n-gram hash, intercepts, temperature and least probability."""

    families: list[str]
    weights: dict[int, list[float]]
    intercepts: list[float]
    anchors: list[int]
    temperature: float = 1.0
    least: float = 0.5


def anchors(weights: dict[int, list[float]], intercepts: list[float], common: dict[int, int]) -> list[int]:
    """N-grams of which a line needs one for any family to be likelier than unknown.

    For each family, n-grams are set aside, the most common of ordinary lines first, as long
    as all that are aside together do not outweigh the intercepts; the others are anchors.
    """
    needed = set()
    for family in range(1, len(intercepts)):
        room = intercepts[0] - intercepts[family]
        gains = {g: w[family] - w[0] for g, w in weights.items() if w[family] > w[0]}
        for gram in sorted(gains, key=lambda g: (-common.get(g, 0), gains[g], g)):
            room -= gains[gram]
            if room < 0:
                room += gains[gram]
                needed.add(gram)
    return sorted(needed)


def _probabilities(margins: list[float], temperature: float) -> list[float]:
    top = max(margins)
    scaled = [math.exp((m - top) / temperature) for m in margins]
    return [s / sum(scaled) for s in scaled]


def _calibrated(held: list[tuple[int, list[float]]], unknown: int) -> tuple[float, float]:
    """The temperature that makes held-back examples likeliest, and the least probability."""

    def loss(temperature: float) -> float:
        return -sum(math.log(max(_probabilities(m, temperature)[label], 1e-12)) for label, m in held)

    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    chances = [_probabilities(m, temperature) for label, m in held if label == unknown]
    best = sorted((max(p for i, p in enumerate(c) if i != unknown) for c in chances), reverse=True)
    allowed = best[min(int(PASSING * len(best)), len(best) - 1)] if best else 0.0
    return temperature, max(0.5, min(allowed, 0.95))


def train(docs: DataFrame) -> Model:
    """A model from the templates and a bounded, hash-chosen sample of the documents' lines.

    Sampled lines that share a shingle with a template are left out of the unknown class.
    """
    spark = docs.sparkSession
    number, scale = docs.count(), 1 << 30
    share = min(scale, scale * SAMPLE_TEXTS // max(1, number))
    sample = docs.where(F.pmod(F.xxhash64("text", F.lit("licence")), F.lit(scale)) < share)
    known = _local(spark, [(t,) for ts in TEMPLATES.values() for t in ts], "text string")
    shingles = [r[0] for r in known.select(F.explode(_shingles(words(F.col("text"))))).distinct().collect()]
    ordinary = lines(sample).select("text").distinct()
    ordinary = ordinary.where(~F.arrays_overlap(_shingles(words(F.col("text"))), F.lit(shingles)))
    ordinary = ordinary.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_LINES)
    made = _local(spark, examples(), "family string, text string")
    rows = made.withColumn("sampled", F.lit(False)).unionByName(
        ordinary.select(F.lit(UNKNOWN).alias("family"), "text", F.lit(True).alias("sampled"))
    )
    families = [UNKNOWN, *TEMPLATES]
    label = F.array_position(F.lit(families), F.col("family")).cast("double") - 1
    grams = F.transform(F.array_distinct(_grams(words(F.col("text")))), lambda g: g.cast("string"))
    held = (F.pmod(F.xxhash64("text"), F.lit(5)) == 0).alias("held")
    rows = rows.select(label.alias("label"), grams.alias("grams"), held, "sampled").coalesce(4).persist()
    names = {"inputCol": "grams", "outputCol": "features", "binary": True}
    every = CountVectorizer(vocabSize=VOCABULARY, minDF=3.0, **names).fit(rows.where("label > 0 and not held")).vocabulary
    seen = rows.where("label = 0").select("sampled", F.explode("grams").alias("gram")).where(F.col("gram").isin(every))
    seen = seen.groupBy("gram").agg(F.count("*").alias("n"), F.count_if("sampled").alias("sampled")).collect()
    allowed = max(FEW, COMMON * rows.where("sampled").count())
    common = {r["gram"] for r in seen if r["sampled"] > allowed}
    vocabulary = CountVectorizerModel.from_vocabulary([g for g in every if g not in common], **names)
    vectors = vocabulary.transform(rows).select("label", "features", "held").persist()
    regression = LogisticRegression(maxIter=60, tol=1e-4, regParam=3e-4, elasticNetParam=0.6, family="multinomial")
    fitted = regression.fit(vectors.where("not held"))
    scored = fitted.transform(vectors.where("held")).select("label", "rawPrediction").collect()
    vectors.unpersist()
    rows.unpersist()
    matrix = fitted.coefficientMatrix.toArray()
    weights = {
        int(gram): [float(x) for x in matrix[:, i]]
        for i, gram in enumerate(vocabulary.vocabulary)
        if matrix[:, i].any()
    }
    held = [(int(r["label"]), list(r["rawPrediction"])) for r in scored]
    intercepts = [float(b) for b in fitted.interceptVector]
    needed = anchors(weights, intercepts, {int(r["gram"]): r["n"] for r in seen})
    return Model(families, weights, intercepts, needed, *_calibrated(held, 0))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """``row``, ``doc_id``, ``line``, ``words``, ``family``, ``probability`` and ``margins`` of licence lines."""
    spark = docs.sparkSession
    own = lines(docs).select("row", "doc_id", "line", words(F.col("text")).alias("words"))
    likely = own.where(F.arrays_overlap(_grams(F.col("words")), F.lit(model.anchors)))
    weighted = F.filter(F.array_distinct(_grams(F.col("words"))), lambda gram: gram.isin(list(model.weights)))
    found = likely.select("*", F.explode(weighted).alias("gram"))
    table = _local(spark, list(model.weights.items()), "gram bigint, w array<double>")
    scored = found.join(F.broadcast(table), "gram")
    sums = [F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(len(model.families))]
    totals = scored.groupBy("row", "line").agg(F.first("doc_id").alias("doc_id"), F.first("words").alias("words"), *sums)
    margins = [(F.col(f"s{i}") + b) / model.temperature for i, b in enumerate(model.intercepts)]
    totals = totals.withColumn("margins", F.array(*margins)).withColumn("top", F.array_max("margins"))
    best = F.array_position("margins", F.col("top")).cast("int")
    chance = 1 / F.aggregate(
        F.transform("margins", lambda m: F.exp(m - F.col("top"))), F.lit(0.0), lambda a, x: a + x
    )
    totals = totals.select("row", "doc_id", "line", "words", "margins", best.alias("best"), chance.alias("probability"))
    family = F.element_at(F.lit(model.families), F.col("best")).alias("family")
    return totals.where((F.col("best") > 1) & (F.col("probability") >= model.least)).select(
        "row", "doc_id", "line", "words", family, "probability", "margins"
    )


def settled(hits: DataFrame, families: list[str]) -> DataFrame:
    """Licence lines with the family that their own margins and their neighbours' speak for.

    A line of a longer notice may fit several families; the lines beside it tell which.
    """
    order, total = Window.partitionBy("row").orderBy("line"), F.col("margins")
    for beside, step in ((F.lag, -1), (F.lead, 1)):
        near = beside("line").over(order) == F.col("line") + step
        other = F.when(near, beside("margins").over(order))
        total = F.coalesce(F.zip_with(total, other, lambda a, b: a + NEIGHBOUR * b), total)
    own = hits.withColumn("total", F.slice(total, 2, len(families)))
    best = F.array_position("total", F.array_max("total")).cast("int") + 1
    return own.withColumn("family", F.element_at(F.lit(families), best)).drop("total", "margins")


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Licence notices: one row per paragraph of neighbouring lines of one predicted family.

    Columns ``doc_id``, ``line`` (of the paragraph's first line, from 0), ``n_lines``,
    ``predicted``, ``probability`` (the least of its lines), ``template`` and ``similarity``
    of the family's closest template, ``confirmed``, and ``family``: the predicted one if
    confirmed, else ``unknown``. Needs ``doc_id`` and ``text``; others are not read. Null and
    empty texts, and lines without a letter, have no notice; a null id stays null; repeated
    rows are found each; equal probabilities go to the first family; an empty table gives an
    empty result.
    """
    model = model or train(docs)
    hits = settled(predicted(docs, model), model.families)
    order = Window.partitionBy("row").orderBy("line")
    runs = hits.withColumn(
        "opens",
        F.coalesce(
            (F.lag("line").over(order) != F.col("line") - 1) | (F.lag("family").over(order) != F.col("family")), F.lit(True)
        ),
    )
    runs = runs.withColumn("run", F.count_if("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    paragraphs = runs.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"), F.first("family").alias("predicted"), F.min("line").alias("line"),
        F.count("*").cast("int").alias("n_lines"), F.min("probability").alias("probability"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("line", "words"))), lambda x: x["words"])).alias("words"),
    )
    rows = [(family, template) for family, own in TEMPLATES.items() for template in own]
    known = _local(docs.sparkSession, rows, "predicted string, template string")
    known = known.withColumn("known", _shingles(words(F.col("template"))))
    both = paragraphs.withColumn("own", _shingles(F.col("words"))).join(F.broadcast(known), "predicted")
    shared = F.size(F.array_intersect("own", "known")) / F.least(F.size("own"), F.size("known"))
    closest = F.max(F.struct(shared.alias("similarity"), "template"))
    columns = ["row", "run", "doc_id", "line", "n_lines", "predicted", "probability"]
    judged = both.groupBy(*columns).agg(closest.alias("closest")).select("*", "closest.*")
    confirmed = F.col("similarity") >= CONFIRMED
    return judged.select(
        "doc_id", "line", "n_lines", "predicted", "probability", "template", "similarity",
        confirmed.alias("confirmed"), F.when(confirmed, F.col("predicted")).otherwise(UNKNOWN).alias("family"),
    )
