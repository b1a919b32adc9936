"""Licence scans by a trained paragraph classifier (operator 6); built-in functions and MLlib only.

A paragraph is a run of lines with a word (so comment markers alone are no line).  Its
stretches, which are its lines and all runs of adjoining lines that a notice can be wrapped
over, are cut to what lies between the first and last word pair of their likeliest notice,
and classified.  Multinomial logistic regression over sparse
hashed word 1- and 2-grams (MLlib, which runs in the JVM) predicts a licence family or
"unknown".  It is trained on windows of the families' notices and on a bounded sample of
ordinary lines (without licence words); the probability a family needs is calibrated on the
half of that sample and the fifth of those windows that the fit has not seen.  A prediction counts only if the stretch holds
CONFIRMED of the word pairs of one of that family's notices.  Of the stretches that count
the smallest stay, and those of a family that share a line are one.

The sample is the different lines with the smallest hashes, at most SAMPLE.  For each notice
there are anchor words without which a paragraph can't hold CONFIRMED of its pairs; a
paragraph without any, or without CONFIRMED of any notice's pairs, is unknown for certain,
and so are all its stretches; all others are classified.  Classifying is a map; only found
stretches are grouped by document, so the shuffle is small.

Defined results: a null or empty text has no paragraph; a document without a licence has
an empty list; repeated rows are each scanned; an empty table gives an empty result.
Only id and text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalytics.llm.common import cut_lineage, text_or_empty

#: Public licence notices by family.
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "See the License for the specific language governing permissions and limitations under the License",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
        "Licensed under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GNU General Public License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
FAMILIES = ["unknown", *sorted(NOTICES)]
FEATURES = 2**12
#: Ordinary lines for fit and calibration; a documented bound.
SAMPLE = 3000
CONFIRMED = 0.6
#: A sampled line with this share of a notice or one of these words is no example of "unknown".
NOTABLE = 0.2
LICENCE_WORDS = ("licens", "licenc", "spdx", "copyright", "gpl", "creative commons", "redistribut", "warrant")
#: The probability a family needs: this quantile of the held-out ordinary lines, but no
#: more than that quantile of the held-out windows of notices (each for its own family).
ORDINARY, OWN = 0.99, 0.05
#: Least probability a family ever needs.
LEAST = 0.5
WORD = "[a-z0-9]+(?:[.][0-9]+)*"
#: Words too common to tell anything as anchors.
COMMON = {"a", "and", "any", "at", "be", "by", "for", "in", "is", "it", "its", "may", "not", "of", "on", "or", "the", "this", "to", "you"}


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once: as a lambda's variable it is not an
    expression that the optimizer could copy into each of its uses, inside loops too."""
    return F.get(F.transform(F.array(value), use), 0)


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def pairs_of(tokens: Column) -> Column:
    def of(words: Column) -> Column:
        n = F.size(words)
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(2))))
        return F.when(n > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))

    return bound(tokens, of)


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, row, text of every row, written once so that a row keeps its number; the text
    is left out where no notice can be."""
    text = F.when(has_anchor(text_or_empty()), text_or_empty())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    return cut_lineage(rows, "numbered")


def paragraphs(rows: DataFrame) -> DataFrame:
    """doc_id, row, paragraph (its number), text of every paragraph of ``numbered`` rows that can hold a notice."""
    rows = rows.filter(F.col("text").isNotNull())
    # comment words at the start of a line; other markers are no words
    text = F.regexp_replace(F.lower("text"), r"(?m)^[^a-z0-9\n]*(?:rem|dnl)\b", "")
    rows = rows.select("doc_id", "row", F.posexplode(F.split(text, r"\n[^a-z0-9]*\n")).alias("paragraph", "text"))
    rows = rows.filter(has_anchor(F.col("text")))
    return rows.filter(likeliest(pairs_of(tokens_of(F.col("text"))))["share"] >= CONFIRMED)


def stretches(found: DataFrame) -> DataFrame:
    """doc_id, row, paragraph, first, last (lines), tokens of all stretches of ``paragraphs`` that can hold a notice."""
    longest = max(len(words) for family in NOTICES for words in notice_words(family))

    def pieces(lines: Column) -> Column:
        end = F.greatest(F.size(lines) - 1, F.lit(0))
        # all lines but the first and the last are in the notice from end to end
        inner = lambda i, j: F.aggregate(F.slice(lines, i + 2, F.greatest(j - i - 1, F.lit(0))), F.lit(0), lambda n, x: n + F.size(x))
        run = lambda i: F.filter(F.sequence(i, F.least(end, i + longest - 1)), lambda j: inner(i, j) <= longest - 2)
        piece = lambda i, j: F.struct(i.alias("first"), j.alias("last"), F.flatten(F.slice(lines, i + 1, j - i + 1)).alias("tokens"))
        return F.flatten(F.transform(F.sequence(F.lit(0), end), lambda i: F.transform(run(i), lambda j: piece(i, j))))

    lines = F.filter(F.transform(F.split("text", "\n"), tokens_of), lambda x: F.size(x) > 0)
    rows = found.select("doc_id", "row", "paragraph", F.explode(bound(lines, pieces)).alias("piece")).select("doc_id", "row", "paragraph", "piece.*")
    rows = rows.withColumn("best", likeliest(pairs_of(F.col("tokens")))).filter(F.col("best.share") >= CONFIRMED)
    every = F.array(*(F.array(*map(F.lit, p)) for family in sorted(NOTICES) for p in notice_pairs(family)))

    def from_first_pair_to_last(of: Column) -> Column:
        tokens, theirs = of["tokens"], of["theirs"]
        pair = lambda k: F.concat_ws(" ", F.slice(tokens, k, F.lit(2)))
        places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(1))), lambda k: F.array_contains(theirs, pair(k)))
        return bound(places, lambda p: F.slice(tokens, F.array_min(p), F.array_max(p) - F.array_min(p) + 2))

    both = F.struct(F.col("tokens").alias("tokens"), F.element_at(every, F.col("best.notice")).alias("theirs"))
    return rows.select("doc_id", "row", "paragraph", "first", "last", bound(both, from_first_pair_to_last).alias("tokens"))


def notices(spark: SparkSession) -> DataFrame:
    """family, label, tokens of each notice."""
    rows = [F.struct(F.lit(k).alias("family"), F.lit(float(FAMILIES.index(k))).alias("label"), F.lit(x).alias("text")) for k, v in NOTICES.items() for x in v]
    table = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return table.select("family", "label", tokens_of(F.col("text")).alias("tokens"))


def windows(table: DataFrame) -> DataFrame:
    """label, tokens, held: each notice whole and in windows of at least two thirds, so parts
    are known too; a part that its family could not be confirmed by is left out, and a fifth
    of the parts is held out."""
    n = F.size("tokens")
    least = F.greatest(F.lit(1), F.ceil(n * 2 / 3).cast("int"))
    table = table.withColumn("start", F.explode(F.sequence(F.lit(1), n - least + 1)))
    table = table.withColumn("size", F.explode(F.sequence(least, n - F.col("start") + 1)))
    part = F.slice("tokens", F.col("start"), F.col("size"))
    table = table.select("family", "label", part.alias("tokens"), (F.col("size") < n).alias("part"))
    own = F.lit(0.0)
    for family in NOTICES:
        own = F.when(F.col("family") == family, holds(pairs_of(F.col("tokens")), family)).otherwise(own)
    held = F.col("part") & (F.pmod(F.xxhash64("tokens"), F.lit(5)) == 0)
    return table.filter(own >= CONFIRMED).select("label", "tokens", held.alias("held"))


def notice_words(family: str) -> list[list[str]]:
    return [re.findall(WORD, text.lower()) for text in NOTICES[family]]


def notice_pairs(family: str) -> list[list[str]]:
    """The different word pairs of each notice, as constants for the plan."""
    return [sorted({" ".join(p) for p in zip(w, w[1:], strict=False)}) for w in notice_words(family)]


def _shares(pairs: Column, family: str) -> list[Column]:
    """Each notice's share; an SPDX line without the licence's name has none."""
    out = []
    for words, theirs in zip(notice_words(family), notice_pairs(family), strict=True):
        share = F.size(F.array_intersect(F.array(*map(F.lit, theirs)), pairs)) / len(theirs)
        if words[0] == "spdx":
            share = F.when(F.array_contains(pairs, " ".join(words[2:4])), share).otherwise(0.0)
        out.append(share)
    return out


def holds(pairs: Column, family: str) -> Column:
    """The largest share of a notice's word pairs, over the family's notices, among ``pairs``."""
    return F.greatest(*_shares(pairs, family), F.lit(0.0))


def likeliest(pairs: Column) -> Column:
    """share and notice (its place among all, from 1): the notice of which ``pairs`` hold the largest share."""
    every = sorted({p for family in NOTICES for theirs in notice_pairs(family) for p in theirs})

    def best(few: Column) -> Column:
        shares = [x for family in sorted(NOTICES) for x in _shares(few, family)]
        return F.array_max(F.array(*(F.struct(x.alias("share"), F.lit(i).alias("notice")) for i, x in enumerate(shares, 1))))

    # one pass over the pairs, then only those of notices are compared with each
    return bound(F.array_intersect(pairs, F.array(*map(F.lit, every))), best)


def anchors() -> list[str]:
    """Words one of which is in every paragraph that can be confirmed: for each notice
    enough that the pairs without any of them are less than CONFIRMED of its pairs."""
    chosen: set[str] = set()
    for family in sorted(NOTICES):
        for theirs in notice_pairs(family):
            left = [p for p in theirs if not chosen & set(p.split())]
            while len(left) >= CONFIRMED * len(theirs):
                count = Counter(w for p in left for w in p.split() if w not in COMMON)
                # long words and numbers first: short words are in too many others
                chosen.add(max(sorted(count), key=lambda w: (min(len(w), 4 if w[0].isdigit() else 6), count[w])))
                left = [p for p in left if not chosen & set(p.split())]
    return sorted(chosen)


def has_anchor(text: Column) -> Column:
    return bound(F.lower(text), lambda lowered: reduce(or_, (F.contains(lowered, F.lit(w)) for w in anchors())))


def ordinary(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """label, tokens, half: a bounded sample of different lines that are no part of a notice."""
    lines = docs.select(F.explode(F.split(text_or_empty(), "\n")).alias("line")).filter(F.trim("line") != "")
    lines = lines.filter(~bound(F.lower("line"), lambda lowered: reduce(or_, (F.contains(lowered, F.lit(w)) for w in LICENCE_WORDS))))
    lines = lines.select("line", F.xxhash64("line").alias("h"))
    # hashes alone are dealt out: a line that a third of the documents share is one of the sample
    wanted = cut_lineage(lines.select("h").distinct().orderBy("h").limit(sample), "ordinary-hashes")
    lines = lines.join(F.broadcast(wanted), "h", "left_semi").groupBy("h").agg(F.min("line").alias("line"))
    rows = lines.select(tokens_of(F.col("line")).alias("tokens"), "h")
    rows = rows.filter(likeliest(pairs_of(F.col("tokens")))["share"] < NOTABLE)
    return rows.select(F.lit(0.0).alias("label"), "tokens", F.pmod(F.xxhash64("h"), F.lit(2)).alias("half"))


def fit(docs: DataFrame, sample: int = SAMPLE):
    """(fitted pipeline, least probability of a family)."""
    spark = docs.sparkSession
    known = cut_lineage(ordinary(docs, sample), "ordinary")
    parts = cut_lineage(windows(notices(spark)).coalesce(1), "notice-windows")
    rows = parts.filter("not held").drop("held").unionByName(known.filter("half = 0").drop("half"))
    # a paragraph without words keeps the unknown class in the fit when the sample is empty
    rows = rows.unionByName(spark.range(1).select(F.lit(0.0).alias("label"), F.array(F.lit("")).alias("tokens")))
    steps = [
        NGram(n=2, inputCol="tokens", outputCol="pairs"),
        HashingTF(numFeatures=FEATURES, inputCol="tokens", outputCol="ones", binary=True),
        HashingTF(numFeatures=FEATURES, inputCol="pairs", outputCol="twos", binary=True),
        VectorAssembler(inputCols=["ones", "twos"], outputCol="features"),
        LogisticRegression(family="multinomial", regParam=0.003, maxIter=40),
    ]
    model = Pipeline(stages=steps).fit(cut_lineage(rows.coalesce(1), "licence-training"))
    chances = vector_to_array("probability")
    quantile = lambda frame, p, q: model.transform(frame).agg(F.percentile(p, F.lit(q)).alias("p")).first()["p"]
    worst = quantile(known.filter("half = 1"), 1 - chances[0], ORDINARY) or 0.0
    return model, max(LEAST, min(worst, quantile(parts.filter("held"), F.get(chances, F.col("label").cast("int")), OWN)))


def found_paragraphs(docs: DataFrame, rows: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, row, paragraph, first, last, family, probability, share of every confirmed
    prediction in ``rows``, the ``numbered`` rows of ``docs``."""
    model, least = fit(docs, sample)
    # written: each of the model's steps would work the tokens out again
    pieces = cut_lineage(stretches(paragraphs(rows)).filter(F.size("tokens") > 0), "stretches")
    scored = model.transform(pieces).filter(F.col("prediction") > 0)
    scored = scored.select("doc_id", "row", "paragraph", "first", "last", pairs_of(F.col("tokens")).alias("pairs"), "prediction", vector_to_array("probability").alias("chances"))
    at = F.col("prediction").cast("int")
    share = F.lit(0.0)
    for i, family in enumerate(FAMILIES[1:], 1):
        share = F.when(at == i, holds(F.col("pairs"), family)).otherwise(share)
    scored = scored.withColumns({"probability": F.get("chances", at), "share": share})
    families = F.array(*map(F.lit, FAMILIES))
    return scored.filter((F.col("probability") >= least) & (F.col("share") >= CONFIRMED)).select(
        "doc_id", "row", "paragraph", "first", "last", F.get(families, at).alias("family"), "probability", "share"
    )


def passages(found: DataFrame) -> DataFrame:
    """row, family of each passage: the smallest stretches of a family, joined where they share a line."""
    of = Window.partitionBy("row", "paragraph", "family")
    inside = F.min("last").over(of.orderBy(F.desc("first"), "last").rowsBetween(Window.unboundedPreceding, -1))
    least = found.withColumn("inside", inside).filter("inside is null or last < inside")
    before = F.lag("last").over(of.orderBy("first"))
    return least.withColumn("before", before).filter("before is null or first > before").select("row", "family")


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_licences (passages), licences (families, sorted) for every row."""
    rows = numbered(docs)
    hits = passages(found_paragraphs(docs, rows, sample)).groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("family")).alias("families"))
    hits = cut_lineage(hits, "licences")
    out = rows.select("doc_id", "row").join(hits, "row", "left")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_licences"), F.coalesce("families", F.array().cast("array<string>")).alias("licences"))
