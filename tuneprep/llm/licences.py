"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are lines. Their word 1- and 2-grams feed a sparse multinomial logistic regression with
one class per licence family and one for anything else (unknown). It is trained on windows of the
templates and on all paragraphs of the documents; an L1 penalty leaves few weights. Every other
paragraph trains the unknown class, the others calibrate its bar. One pass stores the paragraphs as
vectors over the templates' grams; training and prediction go over the distinct vectors and their
numbers. A prediction counts once a template of the family agrees. All of it is DataFrame functions
and Spark's own ML stages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneprep.llm.common import table
from tuneprep.runtime import column, materialize

UNKNOWN = "unknown"
FALSE_RATE = 0.0005
#: Weight of a paragraph of the unknown class, and of all of them together at most.
UNKNOWN_SHARE, UNKNOWN_WEIGHT = 0.2, 400.0
#: The bar is a multiple of this, so that the margins to choose it from are few whatever the data.
_BAR_STEP = 0.001
AGREEMENT = 0.5

#: Notices and key sentences of public licences by family.
TEMPLATES = {
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc0": (
        "Dedicated to the public domain under CC0 1.0.",
        "This work is marked with CC0 1.0 Universal, public domain dedication.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License"
        " as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ),
}

_WINDOW = 12


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams(tokens: Column) -> Column:
    """1- and 2-grams of words, repeats included; the ends of the paragraph count as words."""
    before = F.concat(F.array(F.lit("^")), tokens)
    after = F.concat(tokens, F.array(F.lit("$")))
    return F.concat(tokens, F.zip_with(before, after, lambda x, y: F.concat(x, F.lit(" "), y)))


def paragraphs(docs: DataFrame, text_col: str, *others: Column) -> DataFrame:
    """``place, line`` of every paragraph that has a word, and ``others`` of its document."""
    return docs.select(*others, F.posexplode(F.split(column(text_col), "\n")).alias("place", "line")).filter(
        F.col("line").rlike(r"[\p{L}\p{N}]")
    )


def _template_rows(spark: SparkSession) -> DataFrame:
    rows = [
        F.struct(F.lit(family).alias("family"), F.lit(text).alias("line"))
        for family, texts in TEMPLATES.items()
        for text in texts
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


@dataclass
class Classifier:
    """Fitted regression, the families in order of their classes, and the bar of the unknown class."""

    regression: object
    classes: list[str]
    bar: float

    def predict(self, vectors: DataFrame) -> DataFrame:
        """Add ``family`` (null: unknown) and ``margin`` above the unknown class."""
        return _with_margin(self.regression.transform(vectors), self.classes).withColumn(
            "family", F.when(F.col("margin") > self.bar, F.col("family"))
        )


def _with_margin(scored: DataFrame, classes: list[str]) -> DataFrame:
    """Class 0 is unknown; the best of the others is its score above that."""
    score = vector_to_array("_score")
    best = F.array_max(F.slice("_scores", 2, len(classes)))
    names = F.array(*[F.lit(c) for c in classes])
    kept = [c for c in scored.columns if not c.startswith("_")]
    return (
        scored.select(*kept, score.alias("_scores"))
        .withColumn("_best", best)
        .withColumn("family", F.element_at(names, F.array_position("_scores", F.col("_best")).cast("int")))
        .withColumn("margin", F.col("_best") - F.element_at("_scores", 1))
        .drop("_scores", "_best")
    )


def _template_windows(spark: SparkSession) -> DataFrame:
    """``family, _grams`` of the templates and of their windows."""
    templates = _template_rows(spark)
    span = F.size("_words") - F.lit(_WINDOW - 1)
    starts = F.sequence(F.lit(1), F.greatest(span, F.lit(1)), F.lit(2))
    return (
        templates.withColumn("_words", words(F.col("line")))
        .select("family", F.explode(starts).alias("_at"), "_words")
        .select("family", grams(F.slice("_words", F.col("_at"), F.lit(_WINDOW))).alias("_grams"))
        .union(templates.select("family", grams(words(F.col("line"))).alias("_grams")))
    )


def fit_vectorizer(spark: SparkSession):
    """The grams of the templates: no other gram gets a weight, whatever the documents hold."""
    return CountVectorizer(
        inputCol="_grams", outputCol="counts", binary=True, vocabSize=1 << 15
    ).fit(_template_windows(spark))


def paragraph_vectors(docs: DataFrame, vectorizer, text_col: str, *others: Column) -> DataFrame:
    """Stored paragraphs: ``others, place, trains, counts`` and ``line``, which is null without a word
    pair of a template."""
    templates = _template_rows(docs.sparkSession)
    known = templates.select(_pairs(words(F.col("line"))).alias("pairs")).agg(
        F.array_distinct(F.flatten(F.collect_list("pairs")))
    )
    known = F.array(*[F.lit(pair) for pair in known.first()[0]])  # of a fixed list
    lines = paragraphs(docs, text_col, *others).withColumn("_grams", grams(words(F.col("line"))))
    trains = F.xxhash64("line") % 2 == 0
    narrow = lines.withColumn("trains", trains).withColumn(
        "line", F.when(F.arrays_overlap("_grams", known), F.col("line"))
    )
    return materialize(vectorizer.transform(narrow).drop("_grams"), "licence-paragraphs")


def train(vectors: DataFrame, vectorizer, false_rate: float = FALSE_RATE) -> Classifier:
    """Fit on the templates and on all paragraphs, given as ``counts`` with ``n_train`` and ``n_rest``.

    These are the numbers of paragraphs with that vector that share no word pair with a template:
    ``n_train`` of them train the unknown class, of the ``n_rest`` others at most ``false_rate`` may
    pass the bar, which is never below zero.
    """
    spark = vectors.sparkSession
    classes = [UNKNOWN, *sorted(TEMPLATES)]
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")) - 1
    n = vectors.agg(F.sum("n_train")).first()[0] or 0
    share = min(UNKNOWN_SHARE, UNKNOWN_WEIGHT / n) if n else UNKNOWN_SHARE
    # A paragraph without any known word is unknown, whatever the documents hold.
    blank = spark.range(1).select(
        F.lit(UNKNOWN).alias("family"), F.array().cast("array<string>").alias("_grams")
    )
    fixed = vectorizer.transform(_template_windows(spark).union(blank)).select(
        number.cast("double").alias("label"),
        "counts",
        F.when(F.col("family") == UNKNOWN, F.lit(UNKNOWN_SHARE)).otherwise(F.lit(1.0)).alias("_weight"),
    )
    unknown = vectors.filter("n_train > 0").select(
        F.lit(0.0).alias("label"), "counts", F.col("n_train") * F.lit(share)
    )
    learned = materialize(fixed.union(unknown), "licence-training")
    regression = LogisticRegression(
        featuresCol="counts", labelCol="label", weightCol="_weight", rawPredictionCol="_score",
        probabilityCol="_probability", predictionCol="_prediction", family="multinomial",
        regParam=0.002, elasticNetParam=0.9, maxIter=60,
    ).fit(learned)
    rest = _with_margin(regression.transform(vectors.filter("n_rest > 0")), classes)
    margin = F.ceil(F.greatest(F.col("margin"), F.lit(0.0)) / _BAR_STEP) * _BAR_STEP
    bar = rest.agg(F.percentile(margin, 1 - false_rate, F.col("n_rest"))).first()[0]
    return Classifier(regression, classes, bar or 0.0)


def _pairs(tokens: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    following = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(1)))
    both = F.zip_with(tokens, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.filter(both, lambda g: g.isNotNull()))


def _agreement(tokens: Column, template: Column) -> Column:
    """Share of word pairs that the shorter of paragraph and template has in common with the other."""
    a, b = _pairs(tokens), _pairs(template)
    return F.size(F.array_intersect(a, b)) / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1))


def scan_paragraphs(
    docs: DataFrame, text_col: str, *others: Column, false_rate: float = FALSE_RATE
) -> DataFrame:
    """Predicted paragraphs: ``others, place, line, family, margin, agreement, confirmed``.

    ``line`` is null where no template has a word pair of it: nothing agrees there.
    """
    spark = docs.sparkSession
    vectorizer = fit_vectorizer(spark)
    stored = paragraph_vectors(docs, vectorizer, text_col, *others)
    other = F.col("line").isNull()
    vectors = materialize(
        stored.groupBy("counts").agg(
            F.count_if(other & F.col("trains")).alias("n_train"),
            F.count_if(other & ~F.col("trains")).alias("n_rest"),
        ),
        "licence-vectors",
    )
    model = train(vectors, vectorizer, false_rate)
    predicted = materialize(
        model.predict(vectors).filter(F.col("family").isNotNull()).select("counts", "family", "margin"),
        "licence-predictions",
    )
    # Templates are a fixed list of a few dozen lines.
    templates = (
        _template_rows(spark)
        .groupBy("family")
        .agg(F.collect_list(words(F.col("line"))).alias("_templates"))
    )
    tokens = words(F.col("line"))
    best = F.array_max(F.transform("_templates", lambda t: _agreement(tokens, t)))
    return (
        stored.join(predicted, "counts")
        .join(F.broadcast(templates), "family")
        .withColumn("agreement", F.when(F.col("line").isNull(), 0.0).otherwise(best))
        .withColumn("confirmed", F.col("agreement") >= AGREEMENT)
        .drop("_templates", "counts", "trains")
    )


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_rate: float = FALSE_RATE
) -> DataFrame:
    """One row per document: id, ``families``, ``n_paragraphs``, ``n_unconfirmed``.

    ``families`` lists the confirmed families in order; the counts are of paragraphs whose family a
    template confirms, and of those it does not. Null and empty texts have none. Ids may be null or
    repeat; an empty table gives no rows; other columns are not read. Only the few paragraphs found,
    distinct vectors and narrow keys are shuffled.
    """
    key = F.xxhash64(column(id_col), column(text_col))
    hits = (
        scan_paragraphs(docs, text_col, key.alias("key"), false_rate=false_rate)
        .select("key", "place", "family", "confirmed")
        .distinct()  # a repeated row finds the same again
        .groupBy("key")
        .agg(
            F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
            F.count_if("confirmed").alias("n_paragraphs"),
            F.count_if(~F.col("confirmed")).alias("n_unconfirmed"),
        )
    )
    return (
        docs.select(column(id_col).alias(id_col), key.alias("_key"))
        .join(hits.withColumnRenamed("key", "_key"), "_key", "left")
        .select(
            column(id_col),
            F.coalesce("families", F.array().cast("array<string>")).alias("families"),
            F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"),
            F.coalesce("n_unconfirmed", F.lit(0)).alias("n_unconfirmed"),
        )
    )


def op3_licences(spark, sf_dir):
    """Licence families of every document."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.withColumn("families", F.array_join("families", ","))
