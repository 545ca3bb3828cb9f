"""License scans: a trained paragraph classifier with template comparison, in
DataFrame operations.

A text is one sequence of lower-cased words between blanks and signs, whatever its line breaks, so a
hard-wrapped notice stays whole; the end of a sentence and a blank line are a word of
their own (``|``). Overlapping segments of ``SEGMENT`` words are classified. Their features are the
distinct one- and two-word sequences. A multinomial logistic regression (with L1
shrinkage, so that few weights remain) gives each licence family, or none of
them, a probability, calibrated by one temperature fitted on validation segments. The
class ``none`` is trained on segments of the corpus and on mutilated notices; the
threshold is the probability that keeps false alarms among validation segments at
``FALSE_ALARMS``, whatever it is. A prediction is confirmed if the segment contains at least
``CONTAINED`` of the three-word sequences of one of the family's templates; a template that is a
sentence includes where it begins and ends, so its words inside another sentence don't count.

The model is small (its features come from the templates alone) and is fitted on the driver; scoring
keeps the weighted features of each segment and joins them with the table of weights. A segment
without any weighted feature is ``none``. Every weighted feature has an anchor, the one of
its words that is rarest in ordinary text (features of common words alone have no weight); a
segment without any anchor has no weighted feature and needs no join. Null and empty texts
have no segments. Repeated rows, and rows without an id, each have their own result.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutique.llm.common import held_out, written

SEGMENT, STRIDE = 64, 48
#: Segments of the corpus that train the class "none".
MAX_NEGATIVES = 3000
FALSE_ALARMS = 0.001
CONTAINED = 0.6
SHRINK = 2e-4
#: Share of ordinary segments from which a word is common.
COMMON = 0.02
SEED = 3

# Short notices of licence families.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "SPDX-License-Identifier: Apache-2.0", "Apache License Version 2.0, January 2004",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT", "The MIT License (MIT)",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only",
                "GNU General Public License version 3 as published by the Free Software Foundation", "SPDX-License-Identifier: GPL-3.0-or-later",
                "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only",
                "GNU General Public License version 2 as published by the Free Software Foundation",
                "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "LGPL": ["Licensed under the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-only",
             "GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0",
                "Licensed under the Mozilla Public License, version 2.0."],
    "BSD": ["Licensed under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "SPDX-License-Identifier: CC-BY-4.0"],
    "CC0": ["Released under CC0 1.0 Universal.", "Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "Proprietary and confidential. Unauthorized copying is prohibited."],
}
NONE = "none"
FAMILIES = sorted(TEMPLATES)

#: The word for the end of a sentence, and where it stands (for Spark and Python).
STOP = "|"
STOPS = r"[.!?;:]+(?=\s|$)|\n[ \t]*\n"
#: What separates words besides blanks: every ASCII sign and some common others.
SIGNS = "".join(chr(c) for c in range(128) if not (chr(c).isalnum() or chr(c) in " |")) + "\u00a0\u00a9\u00ab\u00ae\u00bb\u2013\u2014\u2018\u2019\u201c\u201d\u2026"
_BLANKED = str.maketrans(SIGNS, " " * len(SIGNS))


def word_list(text: str) -> list[str]:
    return [w for w in re.sub(STOPS, f" {STOP} ", text.lower()).translate(_BLANKED).split(" ") if w]


def template_words(text: str) -> list[str]:
    """Words of a template; one that is a sentence begins after a stop."""
    return [STOP] * text.endswith(".") + word_list(text)


def grams(words: list[str], size: int) -> set[str]:
    return {" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}


def features(words: list[str]) -> set[str]:
    return grams(words, 1) - {STOP} | grams(words, 2)


def training_rows(negatives: list[list[str]]) -> list[tuple[list[str], str]]:
    """(words, family): notices alone, with names and years, within other words,
    with small losses; and segments of no family."""
    rng = random.Random(SEED)
    other = [w for t in negatives for w in t] or ["lorem", "ipsum", "dolor", "amet"]
    some = lambda k: [rng.choice(other) for _ in range(k)]
    rows = []
    for family, texts in TEMPLATES.items():
        for t in texts:
            for i in range(30):
                words = template_words(t)
                if i % 3 == 1 and len(words) > 6:
                    del words[rng.randrange(1, len(words))]
                if i % 4:
                    words = [*some(rng.randrange(40)), *words[words[0] == STOP and i % 4 == 2:], *some(rng.randrange(40))]
                if i % 5 == 0:
                    words = ["copyright", "c", str(rng.randrange(1990, 2026)), *some(2), *words]
                rows.append((words[:SEGMENT + 24], family))
    pieces = [w for texts in TEMPLATES.values() for t in texts for w in template_words(t)]
    rows += [(t, NONE) for t in negatives]
    for _ in range(1200):  # words of notices, out of their order and company
        k = rng.randrange(1, 4)
        mixed = [rng.choice(pieces) for _ in range(k)] + some(rng.randrange(3, 60))
        rng.shuffle(mixed)
        rows.append((mixed, NONE))
    for _ in range(600):  # pieces of notices inside sentences
        whole = template_words(rng.choice([t for texts in TEMPLATES.values() for t in texts]))
        at = rng.randrange(len(whole))
        rows.append(([*some(rng.randrange(3, 30)), *whole[at:at + rng.randrange(2, 4)], *some(rng.randrange(3, 30))], NONE))
    return rows


def common_words(negatives: list[list[str]]) -> set[str]:
    """Words of more than ``COMMON`` of the ordinary segments, and the stop."""
    seen = Counter(w for t in negatives for w in set(t))
    return {w for w, n in seen.items() if n > max(5, COMMON * len(negatives))} | {STOP}


def fit(rows: list[tuple[list[str], str]], negatives: list[list[str]], steps: int = 400) -> dict:
    """Proximal gradient with momentum for the L1-shrunk softmax regression, then
    its temperature and threshold on every fourth row. Features of common words only
    are left out."""
    labels = [NONE, *FAMILIES]
    common = common_words(negatives)
    vocabulary = sorted(g for g in {g for texts in TEMPLATES.values() for t in texts for g in features(template_words(t))}
                        if set(g.split(" ")) - common)
    index = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(rows), len(vocabulary) + 1), np.float32)
    x[:, -1] = 1
    for i, (t, _) in enumerate(rows):
        x[i, [index[g] for g in features(t) if g in index]] = 1
    y = np.array([labels.index(f) for _, f in rows])
    hot = np.eye(len(labels), dtype=np.float32)[y]
    check = np.arange(len(rows)) % 4 == 3
    a, b = x[~check], hot[~check]
    w = v = np.zeros((x.shape[1], len(labels)), np.float32)
    rate, t = 4.0 / max(1.0, float(a.sum(axis=1).mean())), 1.0
    for _ in range(steps):
        p = _softmax(a @ v)
        new = v - rate * (a.T @ (p - b)) / len(a)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * SHRINK, 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    z = x[check] @ w
    loss = [-np.log(np.maximum(_softmax(z * s)[np.arange(len(z)), y[check]], 1e-12)).mean() for s in SCALES]
    w = w * SCALES[int(np.argmin(loss))]
    false = np.sort(_softmax(x[check] @ w)[y[check] == 0, 1:].max(axis=1))
    return {"labels": labels, "weights": {g: [round(float(c), 6) for c in w[i]] for g, i in index.items() if np.abs(w[i]).max() > 1e-3},
            "bias": [round(float(c), 6) for c in w[-1]], "threshold": float(false[int((1 - FALSE_ALARMS) * (len(false) - 1))])}


#: Inverse temperatures tried in the calibration.
SCALES = [2 ** (k / 4) for k in range(-8, 9)]


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def anchors(model: dict, negatives: list[list[str]]) -> list[str]:
    """One word of each weighted feature, the rarest in ordinary text."""
    seen = Counter(w for t in negatives for w in set(t))
    return sorted({min((w for w in g.split(" ") if w != STOP), key=lambda w: (seen[w], w)) for g in model["weights"]})


def corpus_negatives(docs: DataFrame) -> list[list[str]]:
    """Ordinary segments of a hash sample of the learning fold."""
    ids = (docs.where(F.col("text").isNotNull() & ~held_out()).select("doc_id")
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_NEGATIVES).distinct())
    some = segments(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")).select("words")
    # Few parts, so that few tasks send their first rows to the driver.
    rows = some.repartition(4).orderBy(F.xxhash64("words"), "words").limit(MAX_NEGATIVES).collect()
    known = {g for texts in TEMPLATES.values() for t in texts for g in grams(template_words(t), 3)}
    # A segment that contains a notice is no example of "none".
    return [r["words"] for r in rows if not grams(r["words"], 3) & known]


def train(docs: DataFrame) -> dict:
    negatives = corpus_negatives(docs)
    model = fit(training_rows(negatives), negatives)
    return model | {"anchors": anchors(model, negatives)}


def _runs(words: str, size: int):
    return F.when(F.size(words) >= size, F.transform(
        F.sequence(F.lit(0), F.size(words) - size),
        lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def _hash_of(spark: SparkSession, rows: list[tuple], schema: str, gram: str) -> DataFrame:
    """A table of grams with the hash that :func:`_runs` gives them."""
    df = spark.createDataFrame(rows, schema)
    parts = F.split(gram, " ")
    n = F.size(parts)
    h = F.when(n == 1, F.xxhash64(F.get(parts, F.lit(0)))).when(n == 2, F.xxhash64(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).otherwise(
        F.xxhash64(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2))))
    return df.withColumn("g", h).drop(gram)


def _words(text: str):
    """The words of a text, as :func:`word_list` has them, after a first stop."""
    marked = F.regexp_replace(F.lower(F.col(text)), STOPS, f" {STOP} ")
    # Split at single blanks: far cheaper here than at a pattern.
    parts = F.split(F.translate(marked, SIGNS, " " * len(SIGNS)), " ")
    return F.concat(F.array(F.lit(STOP)), F.array_remove(parts, ""))


def text_hashes() -> list:
    """What stands for a text: 96 bits of hashes."""
    return [F.xxhash64("text").alias("t"), F.coalesce(F.crc32("text"), F.lit(-1)).alias("u")]


def segments(docs: DataFrame) -> DataFrame:
    """t and u (the text's hashes), part (number of the first word) and words of
    every segment; equal texts give equal segments. A text without words has none."""
    # Exploded as one element, so that the words are computed once, not for each of their uses.
    words = docs.select(*text_hashes(), F.explode(F.array(_words("text"))).alias("all")).where(F.size("all") > 1)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("all") - (SEGMENT - STRIDE) - 1), F.lit(STRIDE))
    cut = F.transform(starts, lambda at: F.struct(at.alias("part"), F.slice("all", at + 1, SEGMENT).alias("words")))
    return words.select("t", "u", F.explode(cut).alias("s")).select("t", "u", "s.part", "s.words")


def _common(hashes: DataFrame, runs):
    """Of the runs of a segment, those that the table ``hashes`` (g) has."""
    known = sorted(r["g"] for r in hashes.select("g").distinct().collect())
    return F.array_intersect(runs, F.lit(known) if known else F.array().cast("array<bigint>"))


def classify(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """t, u, part, family, probability, contained of the segments that a family
    is predicted for, once for equal texts."""
    spark = docs.sparkSession
    model = model or train(docs)
    labels = model["labels"]
    weights = _hash_of(spark, [(g, *w) for g, w in sorted(model["weights"].items())] or [("", *[0.0] * len(labels))],
                       "gram string, " + ", ".join(f"w{k} double" for k in range(len(labels))), "gram")
    # Templates, as the three-word sequences that a segment must contain.
    rows = []
    for family in FAMILIES:
        for k, t in enumerate(TEMPLATES[family]):
            words = template_words(t)
            gs = sorted(grams(words, 3) or grams(words, 2) or grams(words, 1))
            rows += [(family, k, len(gs), g) for g in gs]
    templates = _hash_of(spark, rows, "family string, template int, size int, gram string", "gram")
    marked = (segments(docs).where(F.arrays_overlap("words", F.array(*[F.lit(a) for a in model["anchors"]])))
              if model["anchors"] else segments(docs.limit(0)))
    # Only the grams that a weight or a template asks for go on, and those of equal texts once.
    parts = marked.select(
        "t", "u", "part", _common(weights, F.concat(_runs("words", 1), _runs("words", 2))).alias("asked"),
        _common(templates, F.concat(_runs("words", 1), _runs("words", 2), _runs("words", 3))).alias("held"))
    parts = written(parts.where(F.size("asked") > 0).distinct(), "segments")
    summed = (parts.select("t", "u", "part", F.explode("asked").alias("g")).join(F.broadcast(weights), "g")
              .groupBy("t", "u", "part").agg(
        *[(F.sum(F.col(f"w{k}").cast("decimal(20,6)")).cast("double") + F.lit(model["bias"][k])).alias(f"z{k}") for k in range(len(labels))]))
    top = F.greatest(*[F.col(f"z{k}") for k in range(len(labels))])
    total = sum((F.exp(F.col(f"z{k}") - F.col("top")) for k in range(1, len(labels))), F.exp(F.col("z0") - F.col("top")))
    best = F.greatest(*[F.struct(F.col(f"z{k}").alias("z"), F.lit(labels[k]).alias("family")) for k in range(1, len(labels))])
    predicted = (summed.withColumn("top", top).withColumn("total", total).withColumn("best", best)
                 .select("t", "u", "part", F.col("best.family").alias("family"),
                         F.round(F.exp(F.col("best.z") - F.col("top")) / F.col("total"), 6).alias("probability"))
                 .where(F.col("probability") >= model["threshold"]))
    predicted = written(predicted, "predicted")
    held = (parts.join(predicted, ["t", "u", "part"])
            .select("t", "u", "part", "family", F.explode("held").alias("g"))
            .join(F.broadcast(templates), ["family", "g"])
            .groupBy("t", "u", "part", "family", "template")
            .agg((F.count_distinct("g") / F.max("size")).alias("contained"))
            .groupBy("t", "u", "part").agg(F.max("contained").alias("contained")))
    return predicted.join(held, ["t", "u", "part"], "left").withColumn("contained", F.coalesce("contained", F.lit(0.0)))


def license_scan(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, n_paragraphs (lines that aren't blank), n_licensed and n_unconfirmed (segments), families
    (confirmed, joined by commas) and probability (the highest confirmed) of each row."""
    hits = classify(docs, model)
    ok = F.col("contained") >= CONTAINED
    by_text = hits.groupBy("t", "u").agg(
        F.count_if(ok).alias("n_licensed"), F.count_if(~ok).alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(ok, F.col("family")))), ",").alias("families"),
        F.max(F.when(ok, F.col("probability"))).alias("probability"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_hashes(),
                      F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x) != "")).cast("long").alias("n_paragraphs"))
    joined = own.join(by_text, ["t", "u"], "left")
    return joined.select("doc_id", "n_paragraphs", F.coalesce("n_licensed", F.lit(0)).cast("long").alias("n_licensed"),
                         F.coalesce("families", F.lit("")).alias("families"),
                         F.coalesce("n_unconfirmed", F.lit(0)).cast("long").alias("n_unconfirmed"), "probability")
