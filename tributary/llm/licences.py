"""License scans: a trained paragraph classifier, confirmed by templates, scored as DataFrame operations.

A multinomial logistic regression over sparse word n-grams is fitted on notices of each family
(and cut, mixed and padded variants of them) against prose.  An n-gram is a feature only if it holds a key word: a
word of the notices that prose hardly uses.  A paragraph without a key word therefore scores as
prose, and one expression over the text finds the paragraphs worth scoring.  Probabilities are
calibrated on variants held out; what looks like a license but like no family is ``unknown``.
A prediction is confirmed if enough of a notice's word n-grams stand in the paragraph.

A paragraph is a line, or a block of lines between blank ones: notices are often wrapped, and none of
their lines then holds enough of them.  Comment marks count as white space in blocks.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import cut

# Wording of common licence notices, by family.
NOTICES: dict[str, list[str]] = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation.",
    ],
    "bsd": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: redistributions of source code must retain the above copyright notice.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This content is available under the Creative Commons Attribution-ShareAlike License, CC BY-SA 4.0.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
}
# Notices that name no family above: they train the class ``unknown``.
OTHER_NOTICES = [
    "All rights reserved. No part of this publication may be reproduced without written permission of the publisher.",
    "This document is provided under the terms of the Example Vendor License Agreement.",
    "Licensed under a proprietary license; contact the owner for license terms.",
    "Distributed under the terms of the project license, see COPYING for the copyright notice.",
    "Licensed to the customer under the license agreement named in the contract.",
    "This software is licensed under the terms agreed with the licensor.",
    "Licensed under a license of the owner.",
    "Released under a custom license by its authors.",
    "Copyright by the authors. License terms are available on request.",
]
# Prose that shares words with notices: it trains the class ``none`` beside the corpus' own paragraphs.
PROSE = [
    "She lost her driving license on the way to work and asked for permission to leave early.",
    "The software was slow and the version on the old machine could not open the file.",
    "The general asked the public for patience, and the foundation gave money to the school.",
    "They had the right to use the copy that the library kept in the source section.",
    "The city gave the restaurant a licence to sell wine under strict conditions.",
    "He was granted a place and would distribute the notice to any person in the room.",
    "The common attribution of the painting to the master is subject to doubt.",
]
NONE, UNKNOWN = "none", "unknown"
GRAMS = 3
SAMPLE_PARAGRAPHS = 2_000  # paragraphs of the corpus that train the class ``none`` at most
NOTICE_RUN = 5  # words of a notice in a row that rule a line out as prose
MAX_BACKGROUND = 0.02  # share of prose paragraphs in which a key word may occur
MIN_PROBABILITY = 0.5
MIN_CONFIRMED = 0.6
#: What may stand before the text of a line, and in a line that counts as blank: white space, comment marks, rules.
MARKS = r"(?md)^[ \t\x0B\f\r/*#;%!<>=+_~|-]*+(?:(?:rem|dnl)(?![a-z0-9]))?[ \t\x0B\f\r/*#;%!<>=+_~|-]*+"
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"


@dataclass
class Model:
    classes: list[str]
    weights: dict[str, list[float]]  # n-gram -> weight for each class
    bias: list[float]
    temperature: float
    keys: list[str]


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def grams_of(words: list[str]) -> list[str]:
    return [" ".join(words[i:i + n]) for n in range(1, GRAMS + 1) for i in range(len(words) - n + 1)]


def _variants(text: str, filler: list[list[str]], r: random.Random, n: int) -> list[list[str]]:
    """Word lists of a notice: whole, cut at either end, with a few words lost, and within prose."""
    words, out = words_of(text), []
    for i in range(n):
        own = list(words)
        if i % 4 == 1 and len(own) > 8:
            lo = r.randrange(0, len(own) // 4 + 1)
            own = own[lo: len(own) - r.randrange(0, len(own) // 4 + 1)]
        if i % 4 == 2:
            own = [w for w in own if r.random() > 0.05] or list(words)
        if i % 4 == 3 and filler:
            own = r.choice(filler)[:20] + own + r.choice(filler)[:20]
        out.append(own)
    return out


def train(prose: list[str], steps: int = 300, rate: float = 0.5, decay: float = 1e-4, variants: int = 16,
          counted: tuple[int, dict[str, int]] | None = None) -> Model:
    """Fits and calibrates the classifier; ``prose`` holds paragraphs of the corpus (a bounded sample).

    ``counted``: how many paragraphs of prose the corpus has, and in how many of them each word of the notices
    stands; without it both are taken from ``prose``.
    """
    r = random.Random(5)
    background = [words_of(p) for p in [*prose, *PROSE]]
    classes = [*NOTICES, UNKNOWN, NONE]
    notices = [(c, t) for c, texts in NOTICES.items() for t in texts] + [(UNKNOWN, t) for t in OTHER_NOTICES]
    counts: dict[str, int] = dict(counted[1]) if counted else {}
    for p in background if counted is None else map(words_of, PROSE):
        for w in set(p):
            counts[w] = counts.get(w, 0) + 1
    notice_words = {w for _, t in notices for w in words_of(t)}
    limit = max(MAX_BACKGROUND * (counted[0] + len(PROSE) if counted else len(background)), 2)
    keys = sorted(w for w in notice_words if counts.get(w, 0) <= limit and not w.isdigit() and len(w) > 2)
    rows = [(classes.index(c), own, i % 4 == 0 and i > 0) for c, t in notices
            for i, own in enumerate(_variants(t, background, r, variants))]
    rows += [(len(classes) - 1, p, i % 3 == 0) for i, p in enumerate(background)]
    known, index = set(keys), {}
    encoded = []
    for y, own, held in rows:
        grams = {g for g in grams_of(own) if not known.isdisjoint(g.split(" "))}
        encoded.append((y, [index.setdefault(g, len(index)) for g in sorted(grams)], held))
    fit = [e for e in encoded if not e[2]]
    row = np.repeat(np.arange(len(fit)), [len(e[1]) for e in fit])
    column = np.array([i for e in fit for i in e[1]], int)
    y = np.eye(len(classes))[[e[0] for e in fit]]
    share = (1 / np.maximum(y.sum(0), 1))[y.argmax(1)][:, None]
    share /= share.sum()
    w, b = np.zeros((len(index), len(classes))), np.zeros(len(classes))
    sw, sb = np.full_like(w, 1e-10), np.full_like(b, 1e-10)
    for _ in range(steps):
        z = np.tile(b, (len(fit), 1))
        np.add.at(z, row, w[column])
        p = np.exp(z - z.max(1, keepdims=True))
        error = (p / p.sum(1, keepdims=True) - y) * share
        g = decay * w
        np.add.at(g, column, error[row])
        gb = error.sum(0)
        sw += g * g
        sb += gb * gb
        w -= rate * g / np.sqrt(sw)
        b -= rate * gb / np.sqrt(sb)
    held = [e for e in encoded if e[2]]
    z = np.array([b + w[e[1]].sum(0) for e in held])
    t = np.array([e[0] for e in held])

    def loss(temperature):
        s = z / temperature
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(t)), t]).mean())

    temperature = min((0.5 * 1.2**k for k in range(20)), key=loss)
    return Model(classes, {g: w[i].tolist() for g, i in index.items()}, b.tolist(), temperature, keys)


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph, body): the lines of every text; a null text has none."""
    return docs.where(F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("paragraph", "body"))


def blocks(texts: DataFrame) -> DataFrame:
    """(doc, doc_id, paragraph, lines, low): the runs of two and more non-blank lines of the lower-case texts
    (doc, doc_id, low), without comment marks; ``paragraph`` is the first line's number."""
    rows = texts.withColumn("low", F.regexp_replace("low", MARKS, "")).withColumn("all", F.split("low", "\n", -1))
    first = F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: (F.get("all", i) != "") & (
        (i == 0) | (F.get("all", i - 1) == "")))
    bodies = F.split(F.regexp_replace("low", r"\A\n+|\n+\z", ""), r"\n\n+", -1)
    rows = rows.select("doc", "doc_id", F.explode(F.arrays_zip(first.alias("first"), bodies.alias("body"))).alias("b"))
    rows = rows.where(F.col("b.first").isNotNull()).select("doc", "doc_id", F.col("b.first").alias("paragraph"), F.size(F.split("b.body", "\n", -1)).alias("lines"),
                       F.col("b.body").alias("low"))
    return rows.where("lines > 1")


def _run_pattern(texts: list[str]) -> str:
    """One expression for any of the texts; those that begin alike share their beginning."""
    tree: dict[str, list[str]] = {}
    for t in texts:
        tree.setdefault(t[:1], []).append(t[1:])
    parts = [(r"[^a-z0-9]+" if c == " " else re.escape(c)) + _run_pattern(rest) if c else r"\b" for c, rest in tree.items()]
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


def prose(lines: DataFrame) -> DataFrame:
    """(body, low): those of ``lines`` (body) that are taken for prose.

    Lines that say license or copyright, and those with ``NOTICE_RUN`` words of a notice in a row, are none.
    """
    texts = [words_of(t) for t in [*(t for texts in NOTICES.values() for t in texts), *OTHER_NOTICES]]
    runs = sorted({tuple(w[i:i + NOTICE_RUN]) for w in texts for i in range(len(w) - NOTICE_RUN + 1)})
    rows = lines.select("body", F.lower("body").alias("low"))
    return rows.where(F.col("low").rlike(r"\S") & ~F.col("low").rlike("licen[cs]|copyright|rights reserved")
                      & ~F.col("low").rlike(r"\b" + _run_pattern([" ".join(r) for r in runs])))


def train_on(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Fits the classifier with at most ``SAMPLE_PARAGRAPHS`` whole lines, drawn by a hash over all
    lines; those that are no prose are left out of them.

    How often the words of the notices stand in prose is counted over all its lines.
    """
    rows = paragraphs(docs, key, text).where(F.col("body").rlike(r"\S"))
    notice_words = sorted({w for t in [*(t for texts in NOTICES.values() for t in texts), *OTHER_NOTICES] for w in words_of(t)})
    # a null beside the words counts the line itself; one row for each word of the notices at most
    words = prose(rows).select(F.explode(F.concat(F.array(F.lit(None).cast("string")), F.array_distinct(
        F.regexp_extract_all("low", F.lit(WORD), F.lit(0))))).alias("w")).where(F.col("w").isNull() | F.col("w").isin(notice_words))
    counts = {r[0]: r[1] for r in words.groupBy("w").count().collect()}
    few = rows.select("body", F.xxhash64("doc_id", "paragraph", "body").alias("h")).orderBy("h", "body").limit(SAMPLE_PARAGRAPHS)
    # the training sample only: its rows are bounded
    return train([r[0] for r in prose(few).collect()], counted=(counts.pop(None, 0), counts))


def _grams(words: Column) -> Column:
    """The distinct runs of 1 to ``GRAMS`` words of an array."""
    def runs(k: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - k + 1, F.lit(1)))
        return F.when(F.size(words) >= k, F.transform(starts, lambda i: F.array_join(F.slice(words, i, k), " "))).otherwise(
            F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*(runs(k) for k in range(1, GRAMS + 1))))


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph, lines, license, probability, similarity, confirmed) of every paragraph that is a
    license notice; ``license`` is a family, or ``unknown``.  ``paragraph`` is the number of its first line.

    Every line is judged, and every block of ``lines`` > 1 lines.  A block is left out if one of its lines says
    as much: the same license with the same similarity or a greater one.

    ``similarity`` is the largest share of a notice of that family (its distinct word n-grams) that stands in the paragraph;
    a family is ``confirmed`` from ``MIN_CONFIRMED`` on, ``unknown`` never.  Null and empty texts have no
    notice; repeated rows give their notices again; extra columns are left out.
    """
    spark = docs.sparkSession
    number = len(model.classes)
    key_word = r"\b(?:" + "|".join(map(re.escape, model.keys)) + r")\b"
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.lower(text).alias("low"))
    texts = texts.where(F.col("low").rlike(key_word)).withColumn("doc", F.monotonically_increasing_id())
    # stored, since ``doc`` must be the same for lines and blocks
    texts = cut(texts, "texts")
    single = texts.select("doc", "doc_id", F.posexplode(F.split("low", "\n", -1)).alias("paragraph", "low")).withColumn("lines", F.lit(1))
    found = single.unionByName(blocks(texts)).where(F.col("low").rlike(key_word))
    found = found.withColumn("id", F.monotonically_increasing_id()).withColumn(
        "words", F.regexp_extract_all("low", F.lit(WORD), F.lit(0))).select("doc", "doc_id", "paragraph", "lines", "id", "words")
    found = cut(found, "paragraphs")
    # the n-grams of the notices above: a table whose size does not depend on the corpus
    weights = spark.createDataFrame([(g, w) for g, w in model.weights.items()], "gram string, w array<double>")
    grams = found.select("id", F.explode(_grams(F.col("words"))).alias("gram"))
    sums = grams.join(F.broadcast(weights), "gram").groupBy("id").agg(
        *(F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(number)))
    scores = F.array(*((F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.lit(model.bias[i])) / F.lit(model.temperature)
                       for i in range(number)))
    places = ["doc", "doc_id", "paragraph", "lines"]
    scored = found.select("id", *places).join(sums, "id", "left").withColumn("z", scores)
    scored = scored.withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z")))).withColumn(
        "total", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    families = F.array(*map(F.lit, model.classes))
    best = F.array_position(F.col("e"), F.array_max("e")).cast("int")
    predicted = scored.select("id", *places, F.get(families, best - 1).alias("predicted"),
                              (F.array_max("e") / F.col("total")).alias("probability")).where(F.col("predicted") != NONE)
    labelled = predicted.withColumn("license", F.when(F.col("probability") >= MIN_PROBABILITY, F.col("predicted")).otherwise(UNKNOWN))
    notices = spark.createDataFrame([(c, i, g) for c, texts in NOTICES.items() for i, t in enumerate(texts)
                                     for g in sorted(set(grams_of(words_of(t))))], "license string, notice int, gram string")
    sizes = notices.groupBy("license", "notice").agg(F.count("*").alias("n"))
    shared = (labelled.select("id", "license").join(grams, "id").join(F.broadcast(notices), ["license", "gram"])
              .groupBy("id", "license", "notice").agg(F.count("*").alias("both")).join(F.broadcast(sizes), ["license", "notice"])
              .groupBy("id").agg(F.max(F.col("both") / F.col("n")).alias("similarity")))
    out = cut(labelled.join(shared, "id", "left").withColumn("similarity", F.coalesce("similarity", F.lit(0.0))), "notices")
    of_block, of_line = out.where("lines > 1").alias("b"), out.where("lines = 1").alias("l")
    said = of_block.join(of_line, (F.col("b.doc") == F.col("l.doc")) & (F.col("b.license") == F.col("l.license"))
                         & (F.col("l.paragraph") >= F.col("b.paragraph")) & (F.col("l.paragraph") < F.col("b.paragraph") + F.col("b.lines"))
                         & (F.col("l.similarity") >= F.col("b.similarity")), "left_anti")
    return out.where("lines = 1").unionByName(said.select(*out.columns)).select(
        "doc_id", "paragraph", "lines", "license", "probability", "similarity",
        ((F.col("license") != UNKNOWN) & (F.col("similarity") >= MIN_CONFIRMED)).alias("confirmed"))
