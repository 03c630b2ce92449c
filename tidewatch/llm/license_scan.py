"""Licence notices in texts by a trained paragraph classifier.

Every line of a text is a paragraph, and so is every run of up to WINDOW lines without a
blank one between that has WINDOW_WORDS words at most: a notice may be wrapped. Comment
marks don't count. Of predictions that overlap the best one stays. A paragraph's distinct one- and two-word runs are hashed
into BUCKETS features, and a sparse multinomial logistic regression gives each licence
family and the class ``unknown`` a probability. A temperature fitted on held-out
paragraphs calibrates the probabilities. Paragraphs of a known family are compared with
the family's templates: the similarity is the largest share of a template's five-word
shingles that the paragraph has, and from CONFIRM on the prediction is confirmed.

Training data are the templates below with words left out and words of the corpus
around them, against at most UNKNOWN_ROWS corpus paragraphs, those with the smallest
hashes, that are like no template. Everything runs on DataFrame expressions; the weights
are a constant of BUCKETS rows at most, so scoring needs no join and no shuffle.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import Steps

# Notices as their licences word them.
TEMPLATES = {
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
}
UNKNOWN = "unknown"
FAMILIES = sorted(TEMPLATES)
CLASSES = [*FAMILIES, UNKNOWN]
BUCKETS = 1 << 13
UNKNOWN_ROWS = 3_000
HASH_BITS = 14
PADDED = 8
SHINGLE = 5
WINDOW = 10
WINDOW_WORDS = 90  # twice the longest template
MARKS = r"^\s*(?:[/*#;%!|>\x22']+|-{2,}|<!--|\(\*|(?i:rem|dnl)\b)*\s*|\s*(?:\*+/|-->|\*\))\s*$"
CONFIRM = 0.8
LEAST = 0.5
TEMPERATURES = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and the marks that licence names use."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+|\.(?=\s|$)"), lambda w: w != "")


def _pairs(tokens: Column) -> Column:
    return F.zip_with(
        F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)),
    )


def buckets(tokens: Column) -> Column:
    single = F.transform(tokens, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)))
    return F.array_distinct(F.concat(single, _pairs(tokens)))


def shingles(tokens: Column) -> Column:
    """Distinct five-word runs; of a shorter paragraph all words as one."""
    last = F.greatest(F.size(tokens) - SHINGLE + 1, F.lit(1))
    return F.when(F.size(tokens) == 0, F.array().cast("array<string>")).otherwise(
        F.array_distinct(
            F.transform(F.sequence(F.lit(1), last), lambda i: F.concat_ws(" ", F.slice(tokens, i, SHINGLE)))
        )
    )


def template_rows(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family in FAMILIES for text in TEMPLATES[family]]
    return spark.createDataFrame(rows, "family string, template string")


def template_shingles(spark: SparkSession) -> dict[str, list[list[str]]]:
    found: dict[str, list[list[str]]] = {family: [] for family in FAMILIES}
    for row in template_rows(spark).select("family", shingles(words(F.col("template"))).alias("s")).collect():
        found[row.family].append(row.s)
    return found


def similarity(own: Column, templates: list[list[str]]) -> Column:
    """Largest share of a template's shingles that ``own`` has."""
    shares = [
        F.size(F.array_intersect(own, F.array(*map(F.lit, t)))) / F.lit(float(len(t))) for t in templates
    ]
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


LINES = r"\r\n|[\n\r\x{85}\x{2028}\x{2029}]"


def paragraphs(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, paragraph (line number from 0) and line; blank lines are left out."""
    lines = F.posexplode(F.split(F.col("text"), LINES)).alias("paragraph", "line")
    return docs.select(*keep, lines).where(F.trim("line") != "")


def windows(docs: DataFrame) -> DataFrame:
    """row (a number of the row), doc_id, paragraph (its first line), lines and tokens of each paragraph."""
    lines = F.split(F.col("text"), LINES)
    listed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", _once(
        "all", F.transform(lines, lambda line: words(F.regexp_replace(line, MARKS, "")))
    ))
    starts = listed.select("row", "doc_id", F.posexplode(
        F.transform(F.sequence(F.lit(1), F.size("all")), lambda i: F.slice("all", i, WINDOW))
    ).alias("paragraph", "ahead")).where(F.size(F.element_at("ahead", 1)) > 0)
    runs = starts.select("row", "doc_id", "paragraph", "ahead", F.explode(
        F.sequence(F.lit(1), F.size("ahead"))
    ).alias("lines"))
    cut = runs.select("row", "doc_id", "paragraph", "lines", F.slice("ahead", 1, F.col("lines")).alias("own"))
    count = F.aggregate("own", F.lit(0), lambda n, line: n + F.size(line))
    one = (F.col("lines") == 1) | (F.forall("own", lambda line: F.size(line) > 0) & (count <= WINDOW_WORDS))
    return cut.where(one).select("row", "doc_id", "paragraph", "lines", _once("tokens", F.flatten("own")))


class Model:
    """Weights of the features that have any, for all classes, and a temperature."""

    def __init__(self, weights: dict[int, list[float]], intercepts: list[float], temperature: float):
        self.weights, self.intercepts, self.temperature = weights, intercepts, temperature

    def slots(self, found: Column) -> Column:
        """Numbers, from 1, of those features of ``found`` that have weights."""
        table = [0] * BUCKETS
        for slot, bucket in enumerate(self.weights, 1):
            table[bucket] = slot
        numbers = _numbers(table, "int")
        met = F.transform(found, lambda b: F.element_at(numbers, (b + 1).cast("int")))
        return F.filter(met, lambda slot: slot > 0)

    def may_be_known(self, slots: Column) -> Column:
        """False only for paragraphs that are ``unknown`` without a closer look.

        Such a paragraph has no feature that speaks more for a family than for
        ``unknown``; with an intercept in favour of ``unknown`` no family can win.
        """
        unknown = len(CLASSES) - 1
        if max(self.intercepts[:unknown]) >= self.intercepts[unknown]:
            return F.lit(True)
        speaks = [int(max(row[:unknown]) > row[unknown]) for row in self.weights.values()]
        if not speaks:
            return F.lit(False)
        table = _numbers(speaks, "int")
        return F.exists(slots, lambda slot: F.element_at(table, slot) == 1)

    def logits(self, slots: Column) -> Column:
        """Array of the logits of all classes."""
        totals = _numbers(self.intercepts, "double")
        if not self.weights:
            return totals
        # One flat constant: the optimizer folds no lambdas, so nested rows would be parsed anew.
        flat = _numbers([w for row in self.weights.values() for w in row], "double")
        size = len(CLASSES)
        return F.aggregate(
            F.transform(slots, lambda slot: F.slice(flat, (slot - 1) * size + 1, size)),
            totals,
            lambda total, row: F.zip_with(total, row, lambda x, y: x + y),
        )


def _numbers(values: list, kind: str) -> Column:
    """Constant array, folded once by the optimizer."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _once(name: str, value: Column) -> Column:
    """A generated column: later filters and projections read it and don't evaluate it again."""
    return F.explode(F.array(value)).alias(name)


def smallest_lines(lines: DataFrame, n: int) -> DataFrame:
    """The ``n`` lines with the smallest hashes, copies included, in order.

    Lines are counted by the first bits of their hashes; only those up to the bits where
    the count reaches ``n`` are shuffled, copies as one row.
    """
    hashed = lines.select("line", F.xxhash64("line").alias("h"))
    first = F.shiftright("h", 64 - HASH_BITS)
    reached, last = 0, None
    # Each value of the bits has a line, so the n smallest values have n lines.
    for row in hashed.groupBy(first.alias("bits")).count().orderBy("bits").limit(n).collect():
        if reached < n:
            reached, last = reached + row["count"], row.bits
    few = hashed.where(first <= F.lit(last) if last is not None else F.lit(False))
    copies = F.explode(F.sequence(F.lit(1), F.least("count", F.lit(n)).cast("int")))
    return few.groupBy("h", "line").count().select("h", "line", copies).orderBy("h", "line").limit(n).select("line")


def _examples(docs: DataFrame, steps: Steps) -> DataFrame:
    """label, tokens and weight of the training paragraphs."""
    spark = docs.sparkSession
    known = template_shingles(spark)
    lines = paragraphs(docs).select("line").where(F.col("line").rlike(r"[\p{L}\p{N}]"))
    sample = steps.save(
        smallest_lines(lines, UNKNOWN_ROWS)
        .withColumn("tokens", words(F.col("line")))
        .withColumn("s", shingles(F.col("tokens"))),
        "sample",
    )
    alike = F.greatest(*[similarity(F.col("s"), known[family]) for family in FAMILIES])
    # A line that has a run of words of a template may be part of a wrapped notice.
    plain = sample.where(alike == 0).select(F.lit(UNKNOWN).alias("label"), F.lit(False).alias("whole"), "tokens")
    templates = template_rows(spark).select("family", words(F.col("template")).alias("t"))
    # Each template as it is, without one word, and with prose before and after it.
    size = F.size("t")
    dropped = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.concat(F.slice("t", 1, i - 1), F.slice("t", i + 1, size)),
    )
    known_rows = templates.select(
        F.col("family").alias("label"), F.posexplode(F.concat(F.array("t"), dropped)).alias("n", "tokens")
    ).select("label", (F.col("n") == 0).alias("whole"), "tokens")
    prose = [
        r.p for r in sample.orderBy(F.xxhash64("line"), "line").limit(PADDED)
        .select(F.slice("tokens", 1, 6).alias("p")).collect()
    ]
    around = [
        F.concat(*order)
        for p in prose
        for order in ((F.col("t"), F.array(*map(F.lit, p))), (F.array(*map(F.lit, p)), F.col("t")))
    ] or [F.col("t")]
    padded = templates.select(
        F.col("family").alias("label"), F.lit(False).alias("whole"), F.explode(F.array(*around)).alias("tokens")
    )
    both = plain.unionByName(known_rows).unionByName(padded)
    return both.select(
        "label", "whole", F.transform(buckets(F.col("tokens")), lambda b: b.cast("string")).alias("features")
    )


def train(docs: DataFrame) -> Model:
    """Model of the templates against the corpus; without a corpus, of the templates alone."""
    steps = Steps(docs.sparkSession, "licence")
    rows = steps.save(_examples(docs, steps), "examples")
    index = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("label")) - 1
    held = (F.pmod(F.xxhash64("features"), F.lit(4)) == 0) & ~F.col("whole")
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    weight = F.element_at(
        F.create_map(*[F.lit(v) for c in counts for v in (c, 1.0 / counts[c])]), F.col("label")
    )
    marked = rows.withColumns(
        {"y": index.cast("double"), "weight": weight * F.lit(float(sum(counts.values())) / len(counts))}
    )
    vectors = CountVectorizer(inputCol="features", outputCol="vector", vocabSize=BUCKETS, binary=True)
    fitted = vectors.fit(rows)
    regression = LogisticRegression(
        featuresCol="vector", labelCol="y", weightCol="weight", family="multinomial",
        regParam=2e-3, elasticNetParam=0.9, maxIter=60, standardization=False,
    )
    # The whole templates are always fitted, which keeps all families in the model. The examples
    # are bounded (templates and UNKNOWN_ROWS lines), so one task fits them without exchanges.
    first = fitted.transform(marked.where(~held)).coalesce(1)
    model = regression.fit(first)
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    missing = [-20.0] * (len(CLASSES) - len(bias))  # of classes without any example
    weights = {
        int(name): [*map(float, matrix[:, j]), *([0.0] * len(missing))]
        for j, name in enumerate(fitted.vocabulary)
        if matrix[:, j].any()
    }
    found = Model(weights, [*map(float, bias), *missing], 1.0)
    found.temperature = _calibrate(marked.where(held), found)
    return found


def _calibrate(rows: DataFrame, model: Model) -> float:
    """The temperature with the smallest weighted log loss on held-out rows."""
    own = model.slots(F.transform("features", lambda b: b.cast("long")))
    scored = rows.select("y", "weight", _once("z", model.logits(own)))
    right = F.element_at("z", F.col("y").cast("int") + 1)
    losses = [(_log_sum(F.col("z"), t) - right / t) * F.col("weight") for t in TEMPERATURES]
    row = scored.agg(*[F.sum(loss) for loss in losses]).first()
    found = [(loss, t) for loss, t in zip(row, TEMPERATURES) if loss is not None]
    return min(found)[1] if found else 1.0


def _log_sum(logits: Column, temperature: float) -> Column:
    """Logarithm of the summed exponentials of the logits."""
    total = F.aggregate(logits, F.lit(0.0), lambda sum_, z: sum_ + F.exp(z / F.lit(temperature)))
    return F.log(total)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per paragraph of a known family: doc_id, paragraph, family, probability,
    similarity, confirmed.

    ``paragraph`` is the number of its first line. Of paragraphs that overlap the one that
    is confirmed, most similar, shortest and most probable stays. Null and empty texts, and
    paragraphs that are ``unknown`` or below LEAST, give no row. Repeated rows give their
    rows as often, null ids are carried along, other columns are ignored. No rows give no
    rows.
    """
    known = template_shingles(docs.sparkSession)
    keys = ["row", "doc_id", "paragraph", "lines"]
    found = windows(docs).select(*keys, "tokens", _once("slots", model.slots(buckets(F.col("tokens")))))
    scored = found.where(model.may_be_known(F.col("slots"))).select(
        *keys, "tokens", _once("z", model.logits(F.col("slots")))
    )
    top = F.array_max("z")
    best = scored.select(
        *keys, "tokens",
        F.element_at(F.array(*map(F.lit, CLASSES)), F.array_position("z", top).cast("int")).alias("family"),
        F.exp(top / F.lit(model.temperature) - _log_sum(F.col("z"), model.temperature)).alias("probability"),
    )
    own = best.where((F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST)).withColumn(
        "s", shingles(F.col("tokens"))
    )
    share = F.coalesce(
        *[F.when(F.col("family") == family, similarity(F.col("s"), known[family])) for family in FAMILIES]
    )
    rated = own.select(*keys, "family", "probability", _once("similarity", share))
    order = F.struct(
        (F.col("similarity") < CONFIRM).alias("open"), (-F.col("similarity")).alias("unlike"), "lines",
        (-F.col("probability")).alias("doubt"), "paragraph", "family",
    )
    listed = rated.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(order)).alias("found"))
    apart = F.aggregate(
        "found", F.slice("found", 1, 0),
        lambda kept, p: F.when(
            F.exists(kept, lambda k: (k.paragraph < p.paragraph + p.lines) & (p.paragraph < k.paragraph + k.lines)),
            kept,
        ).otherwise(F.concat(kept, F.array(p))),
    )
    return listed.select("doc_id", F.explode(apart).alias("p")).select(
        "doc_id", F.col("p.paragraph").cast("long").alias("paragraph"), "p.family",
        (-F.col("p.doubt")).alias("probability"), (-F.col("p.unlike")).alias("similarity"),
        (~F.col("p.open")).alias("confirmed"),
    )
