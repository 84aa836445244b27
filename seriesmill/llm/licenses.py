"""Licence statements by a trained paragraph classifier.

A paragraph is a line, or the lines that a wrapped text has been cut into: a line of 30 to 120 characters that
ends no sentence goes on in the next one, and so does one that ends within a hyphenated word. Its features are word n-grams of one to three words; a softmax regression with an L1
penalty gives few of them a weight for each licence family and for the class ``unknown``; n-grams of words that are
common in the corpus alone have none. It learns from
statements built of the names and frames below, from paragraphs of common licences, from statements with made-up
names, prose on licences, and lines of the corpus, BACKGROUND at most. A third of the different texts among these
is held out to calibrate the probabilities by a temperature.

A prediction is confirmed if the paragraph holds most of a template's 3-word sequences, or a template
holds most of the paragraph's. Paragraphs without any cover word can't be predicted and aren't classified: all
weights of n-grams without a cover word together don't bring a family's odds up to those of ``unknown``.

Texts are handled by DataFrame operations alone; numpy fits the weights, on the driver, from the bounded
examples. Each different paragraph is classified once, however often it occurs.

Defined cases: null and empty texts have no paragraphs. Rows that repeat both doc_id and text get the same
result each; null ids are like others. Other columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.llm.common import documents_only, fixed_rows, small, stored

UNKNOWN = "unknown"
#: Lines of the corpus that are learned from, at most: those with the least hashes.
BACKGROUND = 1500
LONGEST = 3
#: Probability from which a family is named, and share of 3-word sequences that confirms it.
SURE, CONFIRMED = 0.5, 0.5
#: Words that one in so many lines of the corpus holds are common: n-grams of such words alone are no features.
COMMON = 100

# Names of licences and frames of statements. Fixed values.
NAMES = {
    "agpl": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0"],
    "apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0", "Apache 2.0"],
    "bsd": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "New BSD License"],
    "cc-by": ["CC BY 4.0", "CC BY 3.0", "Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License, version 2", "GNU GPL v3", "GPL-3.0", "GPLv2"],
    "lgpl": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License, version 2.1", "LGPL-3.0"],
    "epl": ["Eclipse Public License 2.0", "Eclipse Public License, version 1.0", "EPL-2.0"],
    "isc": ["ISC License", "ISC licence"],
    "mit": ["MIT License", "MIT licence", "Expat MIT License"],
    "mpl": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "public-domain": ["CC0 1.0 Universal", "CC0 1.0", "Unlicense"],
}
FRAMES = [
    "{}", "Licensed under {}.", "Licensed under the {}.", "Released under {}.", "Released under the {}.",
    "This work is licensed under the {}.", "This work is licensed under a {}.", "This file is distributed under the {}.",
    "This software is available under the terms of the {}.", "You may use this under the {} or any later version.",
    "SPDX-License-Identifier: {}",
]
BODIES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.",
        "In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "You should have received a copy of the GNU Lesser General Public License along with this library",
    ],
    "agpl": ["You should have received a copy of the GNU Affero General Public License along with this program."],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain.", "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
}
OTHERS = [
    "Acme Public License 1.0", "Foo Bar License, version 2", "Community Source License", "House Rules License 4.0", "XYZ-1.0",
    "Example Corp End User Agreement", "General Terms", "Version 3 Terms", "International Trade Agreement",
]
PROSE = [
    "He lost his driving licence in the park.", "The committee will license new taxis next year.", "Released under water, the float rose.",
    "Permission to land was granted.", "The general public is invited.", "All rights and duties of the club", "version 2.0 was released",
    "A licence tells you what you may do with a text.", "Many projects choose a license late.", "Which license is best for a library?",
    "The court read the license of the software aloud.", "Source code was copied without permission.", "The software is slow.",
    "She asked for a copy of the license agreement.", "The library lends books and software.", "Copies are sold at the door.",
    "In no event were more than ten people present.", "The warranty of the car has ended.", "Unless required by the teacher, hats are off.",
    "the public library is open", "free of charge for members", "source and binary stars", "This work is done.", "4.0 percent", "by 3.0 points",
]

_WORD = "[a-z0-9]+(?:[.+-][a-z0-9]+)*"
_PARTS = T.ArrayType(T.StringType())


def ngrams(text: str) -> set[str]:
    words = re.findall(_WORD, text.lower())
    return {" ".join(words[i : i + n]) for n in range(1, LONGEST + 1) for i in range(len(words) - n + 1)}


#: The breaks of a wrapped text, the second kind within a word, and what takes their place.
_BREAKS = [
    (r"(?m)^([^\n]{29,119}(?:[^\s.!?-]|\b[vV]\.))[ \t\r]*\n(?=[^\n]*[A-Za-z0-9])", "$1 "),
    (r"([A-Za-z0-9]-)\r?\n[ \t]*(?:[#*/;%]+[ \t]+)?(?=[A-Za-z0-9])", "$1"),
]


def _unwrapped(text: Column) -> Column:
    for pattern, made in _BREAKS:
        text = F.regexp_replace(text, pattern, made)
    return text


def _word_column(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(_WORD), F.lit(0))


def _sequences(words: Column, n: int) -> Column:
    """The distinct sequences of n words."""
    starts = F.sequence(F.lit(1), F.size(words) - n + 1)
    made = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.array_distinct(F.when(F.size(words) >= n, made).otherwise(F.array().cast(_PARTS)))


#: Words of a part of a body that is learned from, and from one to the next; parts go on to the body's end.
PART_WORDS, PART_STEP = 12, 4


def body_parts() -> list[tuple[str, str]]:
    """(family, part) of the paragraphs of licences longer than a part.

    Parts of PART_STEP words backwards are ``unknown``: single words of licences don't make one.
    """
    made = []
    for family, bodies in BODIES.items():
        for words in (body.split() for body in bodies if len(body.split()) > PART_WORDS):
            starts = range(0, len(words) - PART_STEP, PART_STEP)
            made += [(family, " ".join(words[i : i + PART_WORDS])) for i in starts]
            made += [(UNKNOWN, " ".join(reversed(words[i : i + PART_STEP]))) for i in starts]
    return made


def statements() -> list[tuple[str, str]]:
    """(family, statement) learned from, beside lines of the corpus."""
    made = [(family, frame.format(name)) for family, names in NAMES.items() for name in names for frame in FRAMES]
    made += [(family, body) for family, bodies in BODIES.items() for body in bodies for _ in range(6)]
    made += [(UNKNOWN, frame.format(name)) for name in OTHERS for frame in FRAMES]
    return made + [(UNKNOWN, line) for line in PROSE for _ in range(4)]


@dataclass(frozen=True)
class Model:
    classes: list[str]
    bias: list[float]
    #: Weights of an n-gram by class; n-grams without any weight are left out.
    weights: dict[str, list[float]]
    cover: list[str]

    def probabilities(self, text: str) -> dict[str, float]:
        """The same as the columns compute, for tests and single texts."""
        odds = np.array(self.bias) + sum((np.array(self.weights[g]) for g in ngrams(text) if g in self.weights), np.zeros(len(self.bias)))
        share = np.exp(odds - odds.max())
        return dict(zip(self.classes, (share / share.sum()).tolist(), strict=True))


def lines_with(background: list[str]) -> dict[str, int]:
    """How many of the lines hold a word."""
    return Counter(word for line in background for word in set(re.findall(_WORD, line.lower())))


def train(background: list[str], rounds: int = 250, penalty: float = 1e-4, rate: float = 2.0) -> Model:
    """Softmax regression with an L1 penalty by proximal gradient steps; each third example calibrates."""
    # a line with three words of a licence in a row may be a piece of one, so it says nothing of other texts
    of_bodies = {g for bodies in BODIES.values() for body in bodies for g in ngrams(body) if g.count(" ") == LONGEST - 1}
    background = [line for line in background if of_bodies.isdisjoint(ngrams(line))]
    examples = statements() + body_parts() + [(UNKNOWN, line) for line in background]
    classes = sorted({family for family, _ in examples})
    grams = [ngrams(text) for _, text in examples]
    times = lines_with(background)
    common = {word for word, n in times.items() if n * COMMON >= len(background)}
    said = set().union(*(g for g, (family, _) in zip(grams, examples, strict=True) if family != UNKNOWN))
    vocabulary = sorted(g for g in said if not common.issuperset(g.split(" ")))
    place = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(examples), len(vocabulary)), np.float32)
    for row, found in zip(x, grams, strict=True):
        row[[place[g] for g in found if g in place]] = 1
    y = np.eye(len(classes), dtype=np.float32)[[classes.index(family) for family, _ in examples]]
    # copies of a statement are all held out or none
    place_of = {text: i for i, text in enumerate(dict.fromkeys(text for _, text in examples))}
    held = np.array([place_of[text] % 3 == 2 for _, text in examples])

    def fitted(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights, bias = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
        for _ in range(rounds):
            odds = x @ weights + bias
            share = np.exp(odds - odds.max(axis=1, keepdims=True))
            error = (share / share.sum(axis=1, keepdims=True) - y) / len(x)
            weights -= rate * (x.T @ error)
            bias -= rate * error.sum(axis=0)
            weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * penalty, 0)
        return weights, bias

    weights, bias = fitted(x[~held], y[~held])
    odds = x[held] @ weights + bias

    def loss(temperature: float) -> float:
        z = odds / temperature
        top = z.max(axis=1)
        return float((top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - (z * y[held]).sum(axis=1)).mean())

    temperature = min(np.geomspace(0.1, 3, 60), key=loss)
    weights, bias = fitted(x, y)
    weights, bias = weights / temperature, bias / temperature
    kept = np.flatnonzero(np.abs(weights).max(axis=1) > 1e-4)
    weighted = {vocabulary[i]: weights[i].tolist() for i in kept}
    return Model(classes, bias.tolist(), weighted, cover_words(classes, bias, weighted, background))


def cover_words(classes: list[str], bias: np.ndarray, weights: dict[str, list[float]], background: list[str]) -> list[str]:
    """Words of which a text has one at least if a family's odds reach those of ``unknown``.

    What an n-gram adds to a family's lead is put down to its word that is rarest in the corpus lines. The
    commonest words are left out as long as all that is put down to them leaves every family behind.
    """
    times = lines_with(background)
    unknown = classes.index(UNKNOWN)
    gains: dict[str, np.ndarray] = {}
    for gram, values in weights.items():
        gain = np.maximum(np.array(values) - values[unknown], 0)
        if gain.any():
            word = min(gram.split(" "), key=lambda w: (times.get(w, 0), w))
            gains[word] = gains.get(word, 0) + gain
    lead = np.delete(np.array(bias, float) - bias[unknown], unknown)
    cover = []
    for word in sorted(gains, key=lambda w: (-times.get(w, 0), gains[w].max(), w)):
        more = lead + np.delete(gains[word], unknown)
        if times.get(word, 0) and (more < -1e-6).all():
            lead = more
        else:
            cover.append(word)
    if (lead >= 0).any():
        raise ValueError("a text without any n-gram would have a family")
    return cover


def fit(docs: DataFrame, text: str = "text") -> Model:
    """The model, with lines of the corpus that say nothing of licences as examples of ``unknown``."""
    lines = documents_only(docs, text).select(F.explode(F.split(F.col(f"`{text}`"), "\n")).alias("line"))
    names = "licen[cs]|copyright|rights reserved|public domain|redistribut|permission|spdx|cc by|cc0|gnu|mozilla"
    order = F.xxhash64("line")
    fitting = F.length("line").between(1, 2000) & ~F.lower("line").rlike(names)
    # the hashes first, so that the lines themselves aren't shuffled
    hashes = lines.where(fitting).select(order.alias("h")).distinct().orderBy("h").limit(BACKGROUND).collect()
    if not hashes:
        return train([])
    rows = lines.where(order <= hashes[-1]["h"]).where(fitting).distinct().orderBy(order, "line").limit(BACKGROUND)
    return train(sorted(r["line"] for r in rows.collect()))


def paragraphs(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, hash, line_no, line) of the paragraphs that hold a cover word, stored."""
    rows = documents_only(docs, id_column, text).toDF("id", "text").where("text IS NOT NULL")
    pattern = r"(?<![a-z0-9])(?:" + "|".join(re.escape(w) for w in sorted(model.cover)) + r")(?![a-z0-9])"
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("text", _unwrapped(F.col("text")))
    rows = rows.where(F.lower("text").rlike(pattern))
    lines = rows.select("id", "hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return stored(lines.where(F.lower("line").rlike(pattern)).distinct(), "paragraphs")


def classify(lines: DataFrame, model: Model) -> DataFrame:
    """(line, family, probability, confirmed) of the different lines given."""
    spark = lines.sparkSession
    different = lines.select("line").distinct().withColumn("words", _word_column(F.col("line")))
    grams = F.array_distinct(F.concat(*(_sequences(F.col("words"), n) for n in range(1, LONGEST + 1))))
    different = stored(different.select("line", grams.alias("grams"), _sequences(F.col("words"), 3).alias("threes")), "lines")
    # as many rows as the training vocabulary has weighted n-grams
    weights = fixed_rows(
        spark, [{"gram": g, "weights": w} for g, w in model.weights.items()], "gram:string,weights:array<double>"
    )
    sums = (
        different.select("line", F.explode("grams").alias("gram"))
        .join(F.broadcast(weights), "gram")
        .groupBy("line")
        .agg(*(F.sum(F.col("weights")[i]).alias(f"w{i}") for i in range(len(model.classes))))
    )
    odds = F.array(*(F.coalesce(f"w{i}", F.lit(0.0)) + b for i, b in enumerate(model.bias)))
    scored = different.join(sums, "line", "left").select("line", "threes", odds.alias("odds"))
    top = F.array_max("odds")
    total = F.aggregate("odds", F.lit(0.0), lambda t, o: t + F.exp(o - F.array_max("odds")))
    named = F.element_at(F.array(*map(F.lit, model.classes)), F.array_position("odds", top).cast("int"))
    scored = scored.select("line", "threes", named.alias("predicted"), (F.lit(1.0) / total).alias("probability"))
    # the fixed statements, a few hundred rows
    templates = [
        {"predicted": f, "template": sorted(g for g in ngrams(t) if g.count(" ") == 2)}
        for f, t in sorted(set(statements())) if f != UNKNOWN
    ]
    known = fixed_rows(spark, [t for t in templates if t["template"]], "predicted:string,template:array<string>")
    both = F.size(F.array_intersect("threes", "template"))
    share = both / F.greatest(F.least(F.size("threes"), F.size("template")), F.lit(1))
    best = (
        scored.join(F.broadcast(known), "predicted").groupBy("line").agg(F.max(share).alias("share"))
    )
    family = F.when((F.col("predicted") != UNKNOWN) & (F.col("probability") >= SURE), F.col("predicted")).otherwise(UNKNOWN)
    return scored.join(best, "line", "left").select(
        "line", family.alias("family"), "probability",
        (F.coalesce("share", F.lit(0.0)) >= CONFIRMED).alias("confirmed"),
    )


def license_scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: families (sorted, confirmed or not), n_paragraphs, n_confirmed, n_unknown.

    ``n_unknown`` counts paragraphs with a cover word that no family was named for.
    """
    model = fit(docs, text)
    lines = paragraphs(docs, model, id_column, text)
    classes = stored(classify(lines, model), "classes")
    named = F.col("family") != UNKNOWN
    found = lines.join(small(classes), "line").groupBy("id", "hash").agg(
        F.array_sort(F.collect_set(F.when(named, F.col("family")))).alias("families"),
        F.count(F.when(named, 1)).alias("n_paragraphs"),
        F.count(F.when(named & F.col("confirmed"), 1)).alias("n_confirmed"),
        F.count(F.when(~named, 1)).alias("n_unknown"),
    )
    found = stored(found, "found")
    rows = documents_only(docs, id_column, text).toDF("id", "text").select("id", F.xxhash64("text").alias("hash"))
    joined = rows.join(found, rows["id"].eqNullSafe(found["id"]) & (rows["hash"] == found["hash"]), "left")
    return joined.select(
        rows["id"].alias(id_column),
        F.coalesce("families", F.array().cast(_PARTS)).alias("families"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_paragraphs", "n_confirmed", "n_unknown")),
    )
