"""Licence notices: a trained paragraph classifier, confirmed by comparison with its family's templates.

The main path is DataFrame functions only. The classifier is a sparse multinomial logistic regression on word 1- and
2-grams, trained in numpy on the driver from the templates below and a bounded sample of the corpus.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.frames import bounded_sample

UNKNOWN = "unknown"
# fixed values: notices by which public licences are named or begin
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ],
    "mit": [
        "Released under the MIT License", "This project is licensed under the terms of the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "lgpl-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3"],
    "bsd-3-clause": [
        "Released under the 3-Clause BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc-by-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"],
    "cc-by-sa-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "Licensed under CC BY-SA 4.0"],
    "cc-by-nc-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "Licensed under CC BY-NC 4.0"],
    "cc0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "Licensed under CC0 1.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "proprietary": ["All rights reserved", "Unauthorized copying of this file, via any medium, is strictly prohibited"],
}
# fixed values: English words without content
STOP = set("a all an and any are as at be by for from has have in into is it may not of on or provided should that the this "
           "to under use with you".split())
WORD = r"[^a-z0-9.-]+"
EDGE = r"(^|\s)[.-]+|[.-]+(?=\s|$)"  # points and dashes at a word's edge


def tokens(text: str) -> list[str]:
    """What ``token_column`` gives, for training."""
    return re.sub(EDGE, " ", re.sub(WORD, " ", text.lower())).split()


def token_column(text: Column) -> Column:
    clean = F.regexp_replace(F.regexp_replace(F.lower(text), WORD, " "), EDGE, " ")
    return F.array_remove(F.split(clean, r"\s+"), "")


def grams(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


@dataclass
class Classifier:
    """weights: n-gram -> a weight for each class; the last class is the unknown one."""

    classes: list[str]
    weights: dict[str, np.ndarray]
    bias: np.ndarray
    least: float  # calibrated probability below which a paragraph is unknown
    common: set[str]  # words that say nothing of a licence by themselves

    def anchors(self) -> list[str]:
        """Words of which a paragraph holds one at least if it can be given a licence at all.

        A licence needs its weights to exceed those of the unknown class by a known gap. For each licence, the n-grams
        of least excess that cannot bridge the gap even all together may be overlooked; every other one that speaks for
        the licence is represented by its longest word that is not common.
        """
        found = set()
        odds = np.log(self.least / (1 - self.least))
        for c in range(len(self.classes) - 1):
            gap = self.bias[-1] - self.bias[c] + odds
            excess = sorted((float(w[c] - w[-1]), g) for g, w in self.weights.items() if w[c] > w[-1])
            for e, g in excess:
                gap -= e
                if gap <= 0:
                    found.add(max((w for w in g.split(" ") if w not in self.common), key=lambda w: (len(w), w)))
        return sorted(found)


def fit(sample: list[str], variants: int = 40, l1: float = 2e-4, steps: int = 300, seed: int = 5,
        false_rate: float = 0.001) -> Classifier:
    """Train on varied templates, sampled paragraphs and paragraphs with stray template words.

    The sample may hold notices: paragraphs that contain a template are not taken as unknown. ``least`` is calibrated on
    held-out rows: at most ``false_rate`` of the unknown ones reach it with a licence.
    """
    rng = random.Random(seed)
    exact = [" ".join(tokens(t)) for ts in TEMPLATES.values() for t in ts]
    plain = [t for p in sample if (t := tokens(p)) and not any(e in " ".join(t) for e in exact)] or \
        [["the", "of", "and", "in", "to"]]
    classes = [*TEMPLATES, UNKNOWN]
    rows: list[tuple[set[str], int]] = []
    for c, family in enumerate(TEMPLATES):
        for t in TEMPLATES[family]:
            words = tokens(t)
            for k in range(variants):
                kept = [w for w in words if k == 0 or rng.random() > 0.08 or len(words) < 5]
                around = rng.choice(plain)[:rng.choice([0, 0, 3, 8])] if k else []
                kept = [*around, *kept, *(rng.choice(plain)[:rng.choice([0, 0, 4])] if k else [])]
                rows.append((grams(kept), c))
    pool = [w for e in exact for w in e.split()]
    for k in range(6 * variants * len(classes)):
        words = list(plain[k % len(plain)])
        for _ in range(rng.choice([0, 1, 1, 2])):
            words.insert(rng.randint(0, len(words)), rng.choice(pool))
        rows.append((grams(words), len(classes) - 1))
    seen = Counter(w for p in plain for w in set(p))
    common = {w for w, n in seen.items() if n >= max(4, 0.002 * len(plain))} | STOP
    common |= {w for e in exact for w in e.split() if len(w) == 1 or not re.search("[a-z]", w)}
    names = sorted({g for ts in TEMPLATES.values() for t in ts for g in grams(tokens(t)) if not set(g.split(" ")) <= common})
    at = {g: i for i, g in enumerate(names)}
    rng.shuffle(rows)
    x = np.zeros((len(rows), len(names)))
    for i, (gs, _) in enumerate(rows):
        x[i, [at[g] for g in gs if g in at]] = 1
    y = np.array([c for _, c in rows])
    test = np.arange(len(rows)) % 4 == 0
    target = np.eye(len(classes))[y]
    w, b = np.zeros((len(names), len(classes))), np.zeros(len(classes))
    b[-1] = 4.0
    xt, tt = x[~test], target[~test]
    rate = 8.0
    for _ in range(steps):  # proximal gradient: the l1 term sets most weights to zero
        p = softmax(xt @ w + b)
        slope = (p - tt) / len(xt)
        w -= rate * (xt.T @ slope)
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * l1)
        b -= rate * slope.sum(0)
    p = softmax(x[test] @ w + b)
    unknown = np.sort(p[y[test] == len(classes) - 1][:, :-1].max(1))
    least = float(max(0.5, unknown[min(len(unknown) - 1, int(np.ceil(len(unknown) * (1 - false_rate))))]))
    used = np.flatnonzero(np.abs(w).sum(1) > 0)
    return Classifier(classes, {names[i]: w[i] for i in used}, b, min(least, 0.95), common)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = 2000,
                  confirm: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """(notices, documents).

    ``notices`` has a row for each paragraph (line) with an anchor word: ``key``, ``paragraph`` (from 0),
    ``family`` (``unknown`` below the calibrated probability, or if no template of the family agrees), ``probability``
    and ``similarity``: the largest share of a template's words that the paragraph has. ``documents`` has a row for each
    document: ``key``, ``n_paragraphs``, ``n_notices``, ``n_unknown`` and ``licences`` (families in order, by comma).

    Paragraphs without any anchor word cannot be given a licence and are not listed. A null text has no
    paragraphs, an empty one has one. Rows that share an id are counted together in ``documents``; a null id is an id
    of its own. The classifier trains on ``sample`` paragraphs at most. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text"))
    trained = docs.where("length(__text) > 0").select(F.split("__text", "\n").alias("ps"), F.xxhash64("__text").alias("h")) \
        .select(F.substring(F.element_at("ps", (F.pmod("h", F.size("ps")) + 1).cast("int")), 1, 4000).alias("p"), "h")
    trained = bounded_sample(trained, sample, F.col("h"), F.col("p")).collect()
    model = fit([r.p for r in trained])
    anchors = model.anchors()
    # before any splitting; inside exists() the text is folded once, not once for each anchor
    holds = lambda c: F.exists(
        F.array(F.lower(c)), lambda t: reduce(or_, (F.contains(t, F.lit(a)) for a in anchors)))
    lines = docs.where(holds("__text")).select("__id", F.posexplode(F.split("__text", "\n")).alias("__at", "__line"))
    found = lines.where(holds("__line")).withColumn("__words", token_column(F.col("__line"))) \
        .where(F.arrays_overlap("__words", F.array(*(F.lit(a) for a in anchors)))) \
        .select("__id", "__at", "__words", F.xxhash64("__line").alias("__hash"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("__words") - 1),
                        lambda i: F.concat_ws(" ", F.element_at("__words", i), F.element_at("__words", i + 1)))
    gram_list = F.array_distinct(F.when(F.size("__words") > 1, F.concat("__words", pairs)).otherwise(F.col("__words")))
    # a row for each weighted n-gram: bounded by the templates
    table = spark.createDataFrame([(g, [float(v) for v in w]) for g, w in sorted(model.weights.items())],
                                  "__gram string, __w array<double>")
    sums = [F.sum(F.col("__w")[c]).alias(f"__z{c}") for c in range(len(model.classes))]
    scored = found.select("__id", "__at", "__hash", "__words", F.explode(gram_list).alias("__gram")) \
        .join(F.broadcast(table), "__gram", "left") \
        .groupBy("__id", "__at", "__hash", "__words").agg(*sums)
    z = F.array(*(F.coalesce(F.col(f"__z{c}"), F.lit(0.0)) + float(model.bias[c]) for c in range(len(model.classes))))
    top = F.array_max("__z")
    total = F.aggregate("__z", F.lit(0.0), lambda s, v: s + F.exp(v - F.array_max("__z")))
    names = F.array(*(F.lit(c) for c in model.classes))
    judged = scored.withColumn("__z", z).select(
        "__id", "__at", "__words", F.element_at(names, F.array_position("__z", top).cast("int")).alias("__best"),
        (1 / total).alias("probability"))
    like = [F.when(F.col("__best") == family, F.greatest(F.lit(0.0), *(
        F.size(F.array_intersect("__words", F.array(*(F.lit(w) for w in sorted(set(tokens(t))))))) / len(set(tokens(t)))
        for t in ts))) for family, ts in TEMPLATES.items()]
    judged = judged.withColumn("similarity", F.coalesce(*like, F.lit(0.0)))
    sure = (F.col("probability") >= model.least) & (F.col("similarity") >= confirm) & (F.col("__best") != UNKNOWN)
    notices = judged.select(F.col("__id").alias(key), F.col("__at").alias("paragraph"),
                            F.when(sure, F.col("__best")).otherwise(UNKNOWN).alias("family"), "probability", "similarity")
    known = F.col("family") != UNKNOWN
    per = notices.groupBy(F.col(key).alias("__n")).agg(
        F.count_if(known).alias("n_notices"), F.count_if(~known).alias("n_unknown"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(known, F.col("family"))))).alias("licences"))
    count = docs.groupBy(F.col("__id").alias(key)).agg(
        F.sum(F.coalesce(F.length("__text") - F.length(F.replace("__text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")).alias("n_paragraphs"))
    documents = count.join(per, F.col(key).eqNullSafe(F.col("__n")), "left").select(
        key, "n_paragraphs", F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
        F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"), F.coalesce("licences", F.lit("")).alias("licences"))
    return notices, documents
