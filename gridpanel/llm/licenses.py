"""Licence scans by a trained paragraph classifier, in DataFrame operations only.

Paragraphs (sentences of lines) are sets of word unigrams and bigrams. A sparse
multinomial logistic regression over the n-grams of licence notices tells the
families from ordinary text; it is fitted on the notices and a bounded sample of
paragraphs. How sure it must be is calibrated on families it has not seen: what it
gives those is the level under which a licence is called unknown. A family counts
only when enough of the paragraph's n-grams stand in that family's notices.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.session import Stored

NEGATIVES = 4_000  # most paragraphs of the corpus that stand for ordinary text
LONGEST = 400  # n-grams of the longest of them; only the sample is cut, every paragraph is judged
COMMON = 0.01  # share of ordinary paragraphs from which an n-gram tells nothing
AGREEMENT = 0.5  # share of a paragraph's n-grams that its family's notices must have
FOLDS = 2

# Public licence notices and the usual short forms.
NOTICES = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.",
        "The MIT License (MIT)", "SPDX-License-Identifier: MIT", "Distributed under the MIT License. See LICENSE for more information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0",
        "This project is licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License version 2.",
        "Released under the GNU GPL v3.", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program."],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License.", "Released under the LGPL, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or any later version."],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL v3.", "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License."],
    "BSD": [
        "Released under the BSD License.", "Licensed under the 3-clause BSD license.", "SPDX-License-Identifier: BSD-3-Clause", "Licensed under the new BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission."],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.", "Released under the MPL 2.0.", "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY": [
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0", "Available under the Creative Commons Attribution License."],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0", "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0", "Available under the Creative Commons Attribution-NonCommercial License."],
    "CC0": [
        "Released into the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0", "This work is dedicated to the public domain under the CC0 license.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": [
        "SPDX-License-Identifier: Unlicense", "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain."]}

_SENTENCE = r"(?<=[.!?]) "


def _words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits; empty strings may stand at the ends."""
    return F.split(F.lower(text), "[^a-z0-9]+")


def grams(text: Column) -> Column:
    """Distinct unigrams and bigrams of the words."""
    words = F.filter(_words(text), lambda w: w != "")
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, pairs))


def paragraphs(df: DataFrame, id_col: str, text_col: str, anchors: list[str] | None = None) -> DataFrame:
    """(row, doc_id, place, part, paragraph, grams, total): sentences with words, by line and place in it.

    With ``anchors`` only those with one of these words; lines without any are
    dropped before they are cut into sentences.
    """
    def told(name: str) -> Column:
        return F.exists(_words(F.col(name)), lambda w: w.isin(anchors)) if anchors is not None else F.col(name) != ""

    lines = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                      F.posexplode(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n")).alias("place", "line")).where(told("line"))
    parts = lines.select("row", "doc_id", "place", F.posexplode(F.split("line", _SENTENCE)).alias("part", "paragraph")).where(told("paragraph"))
    return parts.withColumn("grams", grams(F.col("paragraph"))).withColumn("total", F.size("grams")).where("total > 0")


def _literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of some hundred rows that is part of the plan."""
    return spark.range(0, 1, 1, 1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def notices(spark: SparkSession) -> DataFrame:
    """(family, grams, total) of every sentence of every notice."""
    rows = [{"family": k, "text": t} for k, texts in NOTICES.items() for t in texts]
    table = _literal(spark, rows, "family: string, text: string")
    own = table.select("family", F.explode(F.split("text", _SENTENCE)).alias("paragraph"))
    return own.select("family", "paragraph", grams(F.col("paragraph")).alias("grams")).withColumn("total", F.size("grams"))


def _strings(values: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


class Model:
    """Families, weights per n-gram and class (class 0 is ordinary text), and the level of certainty."""

    def __init__(self, vocabulary: list[str], members: dict[str, int], weights: np.ndarray, intercepts: np.ndarray, level: float):
        self.families = list(NOTICES)
        self.vocabulary, self.members, self.weights, self.intercepts, self.level = vocabulary, members, weights, intercepts, level


def _features(df: DataFrame, vocabulary: list[str]) -> DataFrame:
    counted = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "known").setBinary(True).transform(df)
    known = F.size(F.array_intersect("grams", _strings(vocabulary)))
    return VectorAssembler(inputCols=["known", "strange"], outputCol="features").transform(counted.withColumn("strange", 1 - known / F.col("total")))


def _fitted(train: DataFrame):
    return LogisticRegression(family="multinomial", regParam=0.0002, maxIter=20, standardization=False).fit(train)


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the notices, each also next to ordinary sentences, and on about NEGATIVES paragraphs drawn by hash.

    Paragraphs most of whose n-grams stand in notices are not drawn.
    """
    spark = df.sparkSession
    names = list(NOTICES)
    own = notices(spark).collect()
    members: dict[str, int] = {}
    for row in own:
        for g in row["grams"]:
            members[g] = members.get(g, 0) | (1 << names.index(row["family"]))
    every = _strings(sorted(members))
    count = df.count()
    share = F.lit(min(1.0, NEGATIVES / 20 / max(1, count)) * (1 << 30))
    some = df.where(F.pmod(F.xxhash64(F.lit(3), F.col(id_col), F.col(text_col)), F.lit(1 << 30)) < share)
    plain = paragraphs(some, id_col, text_col).where(F.col("total") <= LONGEST)
    plain = plain.where(F.size(F.array_intersect("grams", every)) < AGREEMENT * F.col("total"))
    ordinary = Stored(plain.select("paragraph", "grams").orderBy(F.xxhash64(F.lit(4), "paragraph"), "paragraph").limit(NEGATIVES).select("grams"))
    plain = [r["grams"] for r in ordinary.df.collect()]
    common = {g for g in members if sum(g in p for p in map(set, plain)) > COMMON * max(1, len(plain))} if plain else set()
    vocabulary = sorted(g for g in members if g not in common)
    rows = [] if plain else [{"label": 0.0, "grams": ["a"]}]
    for i, row in enumerate(own):
        label = float(names.index(row["family"]) + 1)
        rows.append({"label": label, "grams": row["grams"]})
        for k in range(2):  # next to ordinary words
            other = plain[(7 * i + k) % len(plain)] if plain else []
            rows.append({"label": label, "grams": list(dict.fromkeys([*row["grams"], *other[:len(row["grams"]) // (k + 1)]]))})
    # The rows to learn from lie in a file as sparse vectors, so that no plan of the fits holds them.
    train = ordinary.df.select(F.lit(0.0).alias("label"), "grams").unionByName(_literal(spark, rows, "label: double, grams: array<string>"))
    kept = Stored(_features(train.withColumn("total", F.size("grams")), vocabulary).select("label", "features").coalesce(1))
    ordinary.drop()
    train = kept.df.cache()
    seen = []
    for fold in range(FOLDS):
        out = [float(i + 1) for i in range(len(names)) if i % FOLDS == fold]
        part = _fitted(train.where(~F.col("label").isin(out)))
        strangers = part.transform(train.where(F.col("label").isin(out))).select("probability").collect()
        seen += [float(max(r[0].toArray()[1:])) for r in strangers]
    level = float(min(0.95, max(0.5, np.quantile(seen, 0.75))))
    model = _fitted(train)
    train.unpersist()
    kept.drop()
    weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    return Model(vocabulary, members, weights, intercepts, level)


def scan(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, place, part, paragraph, family, probability, agreement of every paragraph that speaks of a licence.

    Only paragraphs with a word that notices have and ordinary text rarely has are
    judged; without one there is nothing to tell them from ordinary text. ``place``
    is the line and ``part`` the sentence in it. ``family`` is ``unknown`` where the classifier is not sure enough of one or too
    few n-grams agree with its notices. Null and empty texts have no paragraphs;
    repeated rows give their paragraphs again; other columns are not read.
    """
    spark = df.sparkSession
    k = len(model.families)
    rows = [{"gram": g, "w": [float(x) for x in (model.weights[:, i] if i is not None else np.zeros(k + 1))],
             "m": [model.members[g] >> f & 1 for f in range(k)], "v": int(i is not None)}
            for g, i in [(g, i) for i, g in enumerate(model.vocabulary)]]
    table = Stored(_literal(spark, rows, "gram: string, w: array<double>, m: array<int>, v: int")).df  # read by the plan, not part of it
    anchors = [g for g in model.vocabulary if " " not in g]
    found = paragraphs(df, id_col, text_col, anchors).select("row", "doc_id", "place", "part", "paragraph", "total", F.explode("grams").alias("gram"))
    found = found.join(F.broadcast(table), "gram").groupBy("row", "doc_id", "place", "part", "paragraph", "total").agg(
        *[F.sum(F.col("w")[c]).alias(f"w{c}") for c in range(k + 1)], *[F.sum(F.col("m")[f]).alias(f"m{f}") for f in range(k)], F.sum("v").alias("known"))
    strange = 1 - F.col("known") / F.col("total")
    logits = F.array(*[F.col(f"w{c}") + F.lit(float(model.weights[c, -1])) * strange + F.lit(float(model.intercepts[c])) for c in range(k + 1)])
    found = found.withColumn("logits", logits).withColumn("raised", F.transform("logits", lambda x: F.exp(x - F.array_max("logits"))))
    found = found.withColumn("sum", F.aggregate("raised", F.lit(0.0).cast("double"), lambda s, x: s + x))
    families = F.slice("raised", F.lit(2), F.lit(k))
    found = found.where(F.get("raised", F.lit(0)) / F.col("sum") < 0.5).withColumn("best", F.array_position(families, F.array_max(families)).cast("int"))
    found = found.withColumn("probability", F.array_max(families) / F.col("sum"))
    found = found.withColumn("agreement", F.get(F.array(*[F.col(f"m{f}") for f in range(k)]), F.col("best") - 1) / F.col("total"))
    named = F.get(_strings(model.families), F.col("best") - 1)
    sure = (F.col("probability") >= F.lit(model.level)) & (F.col("agreement") >= AGREEMENT)
    return found.select("doc_id", "place", "part", "paragraph", F.when(sure, named).otherwise(F.lit("unknown")).alias("family"), "probability", "agreement")
