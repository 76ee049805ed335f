"""Licence scan: a trained paragraph classifier on word n-grams, confirmed by comparison with templates.

Training uses Spark's own multinomial logistic regression; scoring is array functions inside one row.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import table, temp
from ravelin.llm.quality_rules import bound

UNKNOWN = "unknown"
#: Paragraphs of the corpus that stand for text without a licence in training: one each of at most this many documents.
BACKGROUND_ROWS = 1_500
#: n-grams of two and three words.
SIZES = (2, 3)
#: A family's probability, after calibration, from which a paragraph is given to it.
CONFIDENT = 0.5
#: Least share of a paragraph's known n-grams that the nearest template of its family holds, and of the template that
#: the paragraph holds or of the paragraph that the template holds.
SAME, COVERED = 0.5, 0.3
#: Known pairs of words this far apart or nearer are one stretch: one changed word does not part a notice. A stretch with
#: fewer known n-grams than the shortest template has is left out.
GAP, LEAST = 3, 3
#: Weights of n-grams are looked up in this many small maps.
SHELVES = 64

#: Notices and passages of public licences, by family.
TEMPLATES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "cc-by-nc": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher."],
    "public-domain": ["This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal"],
}


def grams(text: Column) -> Column:
    """Distinct runs of two and three words, in lower case, signs left out."""

    def runs(words: Column) -> Column:
        parts = []
        for size in SIZES:
            joined = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
            if size == 3:
                joined = F.zip_with(joined, F.slice(words, 3, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
            parts.append(F.slice(joined, 1, F.greatest(F.size(words) - size + 1, F.lit(0))))
        return F.array_distinct(F.concat(*parts))

    return bound(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), ""), runs)


def stretches(line: Column, known: list[str]) -> Column:
    """The distinct known n-grams of each stretch of a line where they lie close together.

    Sentences are cut first. Generic pairs such as "of the" elsewhere in the line, and other notices in it, take no part.
    """

    def of_words(words: Column) -> Column:
        pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
        hits = F.filter(F.transform(pairs, lambda g, i: F.struct(i.alias("at"), g.alias("pair"))), lambda x: x["pair"].isin(known))
        triple = lambda at: F.concat_ws(" ", F.get(words, at), F.get(words, at + 1), F.get(words, at + 2))

        def cut(found: Column) -> Column:
            starts = F.filter(found, lambda x, k: (k == 0) | (x["at"] - F.get(found, k - 1)["at"] > GAP))

            def each(firsts: Column) -> Column:
                def grams_from(first: Column, k: Column) -> Column:
                    end = F.coalesce(F.get(firsts, k + 1)["at"], F.lit(2**31 - 1))
                    own = F.filter(found, lambda x: (x["at"] >= first["at"]) & (x["at"] < end))
                    return bound(own, lambda o: F.array_distinct(F.concat(F.transform(o, lambda x: x["pair"]), F.filter(F.transform(o, lambda x: triple(x["at"])), lambda g: g.isin(known)))))

                return F.transform(firsts, grams_from)

            return bound(starts, each)

        return F.filter(bound(hits, cut), lambda g: F.size(g) >= LEAST)

    sentences = F.split(line, r"(?<=[.!?])\s+", -1)
    return F.flatten(F.transform(sentences, lambda t: bound(F.array_remove(F.split(F.lower(t), r"[^\p{L}\p{N}]+", -1), ""), of_words)))


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda p: F.trim(p) != "")


class Model:
    """What scoring needs: classes, intercepts, weights of each n-gram, templates' n-grams; all bounded by TEMPLATES."""

    def __init__(self, classes: list[str], intercepts: list[float], weights: dict[str, list[float]], templates: dict[str, list[list[str]]], temperature: float) -> None:
        self.classes, self.intercepts, self.weights, self.templates, self.temperature = classes, intercepts, weights, templates, temperature


def _template_grams(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, text string").withColumn("grams", grams(F.col("text")))


def _variants(templates: DataFrame) -> DataFrame:
    """Templates whole, and without each fifth of their words in turn: what quoting and editing leave of them."""
    words = F.split("text", " ")
    cut = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: F.array_join(F.filter(words, lambda w, i: (k == 5) | (i % 5 != k) | (F.size(words) < 6)), " "))
    return templates.select("family", F.explode(F.array_distinct(cut)).alias("text"))


def train(docs: DataFrame) -> Model:
    """Fit on the templates' variants and a bounded background of corpus paragraphs, chosen by a hash of document and text.

    The temperature of the softmax is calibrated on variants and background that training did not see.
    """
    spark = docs.sparkSession
    templates = _template_grams(spark)
    listed = [(r["family"], list(r["grams"])) for r in templates.collect()]  # TEMPLATES, as n-grams
    known = sorted({g for _, some in listed for g in some})
    few = docs.where("text is not null").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(BACKGROUND_ROWS)
    lines = few.select(paragraphs(F.col("text")).alias("p")).where(F.size("p") > 0).select(F.element_at("p", (1 + F.pmod(F.xxhash64("p"), F.size("p"))).cast("int")).alias("text"))
    plain = lines.withColumn("held", F.filter(grams(F.col("text")), lambda g: g.isin(known))).where(F.size("held") <= 2).select(F.lit(UNKNOWN).alias("family"), "text")
    noise = spark.createDataFrame([(UNKNOWN, " ".join(g.split()[:2])) for g in known], "family string, text string")  # a single known pair proves nothing
    rows = _variants(templates).unionByName(plain).unionByName(noise)
    classes = [*sorted(TEMPLATES), UNKNOWN]
    index = F.array_position(F.array(*(F.lit(c) for c in classes)), F.col("family")) - 1
    vocabulary = F.array(*(F.lit(g) for g in known))
    vector = bound(grams(F.col("text")), lambda own: F.transform(vocabulary, lambda g: F.array_contains(own, g).cast("double")))
    even = F.when(F.col("family") == UNKNOWN, 1.0).otherwise(4.0)
    data = rows.select(index.cast("double").alias("label"), array_to_vector(vector).alias("features"), even.alias("weight"), (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("held")).cache()
    fitted = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60, weightCol="weight").fit(data)
    part = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60, weightCol="weight").fit(data.where("not held"))
    chosen = part.transform(data.where("held")).select("label", "rawPrediction").collect()  # bounded: templates and BACKGROUND_ROWS
    data.unpersist()
    temperature = _calibrated([(int(r["label"]), list(r["rawPrediction"])) for r in chosen])
    matrix = fitted.coefficientMatrix.toArray()
    weights = {g: [round(float(x), 5) for x in matrix[:, k]] for k, g in enumerate(known)}
    by_family: dict[str, list[list[str]]] = {}
    for family, some in listed:
        by_family.setdefault(family, []).append(some)
    return Model(classes, [float(x) for x in fitted.interceptVector], weights, by_family, temperature)


def _calibrated(rows: list[tuple[int, list[float]]]) -> float:
    """The temperature with the least log loss on held-out rows."""
    import numpy as np

    if not rows:
        return 1.0
    raw, label = np.array([r for _, r in rows]), np.array([k for k, _ in rows])

    def loss(t: float) -> float:
        z = raw / t
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), label]).mean())

    return min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)


def classify_paragraph(known: Column, model: Model) -> Column:
    """(family, probability, likeness) of a paragraph given as its known n-grams."""
    shelves: list[dict[str, list[float]]] = [{} for _ in range(SHELVES)]
    spread = lambda g: sum(g.encode()) % SHELVES
    for g, w in model.weights.items():
        shelves[spread(g)][g] = w
    maps = F.from_json(F.lit(json.dumps(shelves)), "array<map<string,array<double>>>")
    octets = lambda g: F.aggregate(F.split(F.hex(g), "(?<=\\G..)"), F.lit(0), lambda t, h: t + F.coalesce(F.conv(h, 16, 10).cast("int"), F.lit(0)))
    weight = lambda g: F.get(maps, octets(g) % SHELVES)[g]
    zero = F.array(*(F.lit(x) for x in model.intercepts))
    margins = F.aggregate(known, zero, lambda total, g: F.zip_with(total, weight(g), lambda a, b: a + b))
    scaled = bound(margins, lambda m: F.transform(m, lambda x: F.exp((x - F.array_max(m)) / model.temperature)))

    def decide(p: Column) -> Column:
        best = F.array_position(p, F.array_max(p))
        total = F.aggregate(p, F.lit(0.0), lambda t, x: t + x)
        return F.struct(F.element_at(F.array(*(F.lit(c) for c in model.classes)), best.cast("int")).alias("family"), (F.array_max(p) / total).alias("probability"))

    def compared(decided: Column) -> Column:
        likeness = F.lit(0.0)
        for family, templates in model.templates.items():
            sames = []
            for some in templates:
                shared = F.size(F.array_intersect(known, F.array(*(F.lit(g) for g in some))))
                of_own = shared / F.size(known)
                sames.append(F.when(of_own >= SAME, F.greatest(shared / F.lit(float(len(some))), F.when(shared >= 6, of_own).otherwise(0.0))).otherwise(0.0))
            likeness = F.when(decided["family"] == family, F.greatest(*sames, F.lit(0.0))).otherwise(likeness)
        return F.struct(decided["family"].alias("family"), decided["probability"].alias("probability"), likeness.alias("likeness"))

    return bound(bound(scaled, decide), compared)


def scan_licenses(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """`docs` with `licenses`: paragraph number, family, probability and likeness of every paragraph that is a notice.

    Each line is a paragraph, taken as its distinct n-grams of two and three words, and so is each stretch of a line where
    n-grams of templates lie close together: a line may hold notices amid other text, and of several families, each
    listed once. N-grams of the templates carry weights; a paragraph without any is unknown without further work. The class with the greatest probability must be a
    family and reach CONFIDENT after calibration, and a template of that family must confirm it. Nothing is shuffled.

    Null and empty texts have an empty list. Repeated rows and other columns pass through, an empty table gives an empty
    one, a column called licenses is replaced. Without a model one is trained on `docs`.
    """
    model = model or train(docs.select("doc_id", F.col(f"`{text}`").cast("string").alias("text")))
    docs = docs.drop("licenses")
    known = sorted(model.weights)
    held = temp("held")
    lines = paragraphs(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    parts = lambda p: F.concat(F.array(F.filter(grams(p), lambda g: g.isin(known))), stretches(p, known))
    matched = F.flatten(F.transform(lines, lambda p, i: F.transform(F.array_distinct(parts(p)), lambda g: F.struct(i.alias("paragraph"), g.alias("grams")))))
    few = docs.withColumn(held, F.filter(matched, lambda m: F.size(m["grams"]) > 0))
    judged = F.transform(held, lambda m: bound(classify_paragraph(m["grams"], model), lambda d: F.struct(m["paragraph"].cast("int").alias("paragraph"), d["family"].alias("family"), d["probability"].alias("probability"), d["likeness"].alias("likeness"))))
    sure = F.filter(judged, lambda d: (d["family"] != UNKNOWN) & (d["probability"] >= CONFIDENT) & (d["likeness"] >= COVERED))
    same = lambda d, e: (d["paragraph"] == e["paragraph"]) & (d["family"] == e["family"])
    once = bound(sure, lambda found: F.filter(found, lambda d, k: ~F.exists(F.slice(found, F.lit(1), k), lambda e: same(d, e))))
    return few.withColumn("licenses", once).drop(held)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The licence notices of every document: how many, of which families, in which paragraphs."""
    found = scan_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda d: d["family"]))), ",")
    spans = F.array_join(F.transform("licenses", lambda d: F.concat_ws(":", d["paragraph"], d["family"])), ",")
    least = F.array_min(F.transform("licenses", lambda d: d["probability"]))
    return found.select("doc_id", F.size("licenses").alias("n_notices"), families.alias("families"), spans.alias("notices"), least.alias("least_probability"))
