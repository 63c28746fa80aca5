"""License scan with a trained paragraph classifier (operator 1), built-in functions and Spark ML only.

A paragraph is a run of adjacent lines: two lines belong together where a word
triple of a license template runs over the break, so a wrapped notice is one
paragraph and two notices on neighbouring lines are two.  A blank line ends a
paragraph.  Its features are counts of word pairs and triples that occur in
license templates, a vocabulary bounded by the templates; pairs of two
frequent words (``FREQUENT``) are left out.  A sparse multinomial logistic
regression separates the license families, license language that names no
family (``unknown``) and ordinary text (``none``).  It is trained on variants of
the templates with words left out and on parts of long templates, on short
templates without the words that set their family apart (unknown), and on
lines of a bounded sample of about ``NEGATIVE_DOCS`` documents.  A temperature
fitted on held-out examples calibrates the probabilities; a paragraph whose
best family stays below ``SURE`` is unknown.  Predictions are confirmed when
enough of the pairs and triples of one of the family's templates are found in
the paragraph.

A paragraph without any pair or triple of the vocabulary has the score of an
empty one, so only lines with some are scored; the join with the vocabulary
finds them.  The families known are the keys of ``TEMPLATES``.

Defined results: one row per paragraph that is not ``none``; null, empty and
blank texts give none.  Repeated rows give their rows each.  A null doc_id is
kept.  Other columns are ignored.  A very long text is scanned whole, its lines
in one task.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm import shared

# Notices by which works commonly state their license, and paragraphs of public license texts.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Apache-2.0 licensed.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
        "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
        "Derivative Works in Source or Object form.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "The MIT License (MIT)",
        "MIT licensed.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Released under the GPL, version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
        "for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Released under the LGPL, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
        "License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "Released under the AGPL, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation.",
        "See the GNU Affero General Public License for more details. You should have received a copy of the GNU "
        "Affero General Public License along with this program.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "This code is distributed under the 2-clause BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
        "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION).",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
        "Licensed under the Eclipse Public License, version 1.0.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "SPDX-License-Identifier: ISC",
        "Released under the ISC License.",
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:",
        "Released under the zlib License.",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "The text is available under the Creative Commons Attribution License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "The text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "The text is available under the Creative Commons Attribution-NonCommercial License.",
    ],
    "public-domain": [
        "This work is dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: CC0-1.0",
        "SPDX-License-Identifier: Unlicense",
    ],
}
# Frequent words; a pair of two of them says nothing about licenses.
FREQUENT = ["a", "an", "and", "any", "are", "as", "at", "be", "by", "can", "for", "from", "if", "in", "is", "it", "its",
            "may", "not", "of", "on", "or", "that", "the", "this", "to", "under", "was", "will", "with", "you"]
UNKNOWN_TEMPLATES = [
    "All rights reserved.",
    "Copyright. All rights reserved.",
    "Licensed under the terms of the license agreement.",
    "Released under a custom license, see the license file.",
]
NONE, UNKNOWN = "none", "unknown"
VARIANTS = 24
NOTICE_WORDS = 25  # a template of more words is text of a license; its parts are examples too
PART_WORDS = 15
NEGATIVE_DOCS = 1000
SURE = 0.5
CONFIRMED = 0.6
TEMPERATURES = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]


def words(value: Column) -> Column:
    return F.array_remove(F.split(F.lower(value), r"[^\p{L}\p{N}]+"), "")


def grams(w: Column) -> Column:
    """Word pairs and triples as strings, without pairs of frequent words; used on small tables only."""
    frequent = F.array(*[F.lit(x) for x in FREQUENT])
    def runs(k: int) -> Column:
        own = F.transform(F.sequence(F.lit(0), F.size(w) - k),
                          lambda i: F.array_join(F.slice(w, i + 1, k), " "))
        return F.when(F.size(w) >= k, own).otherwise(F.array().cast("array<string>"))
    pairs = F.filter(runs(2), lambda g: F.size(F.array_except(F.split(g, " "), frequent)) > 0)
    return F.concat(pairs, runs(3))


def gram_hash(gram: Column) -> Column:
    """The hash that scoring computes for a pair or triple given as a string."""
    w = F.split(gram, " ")
    h = [F.xxhash64(F.get(w, F.lit(i))) for i in range(3)]
    return F.when(F.size(w) == 2, F.xxhash64(h[0], h[1])).otherwise(F.xxhash64(*h))


def templates(spark: SparkSession, families: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """(label, template, w) of the families."""
    rows = [(k, t) for k, v in families.items() for t in v]
    return spark.createDataFrame(rows, "label string, template string").withColumn("w", words(F.col("template")))


def examples(spark: SparkSession, docs: DataFrame, families: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """(label, w, test) of the training and held-out paragraphs."""
    own = templates(spark, families)
    family_words = (own.select("label", F.explode("w").alias("word")).groupBy("word")
                    .agg(F.count_distinct("label").alias("n")).where("n = 1").agg(F.collect_set("word").alias("names")))
    # "license", "version" and the like are in several families; what is in one only names it
    masked = own.where(F.size("w") <= NOTICE_WORDS).crossJoin(F.broadcast(family_words)).select(  # one row on the right
        F.lit(UNKNOWN).alias("label"), F.filter("w", lambda x: ~F.array_contains("names", x)).alias("w"))
    # without "SA" a share-alike notice is the plain one, which does name a family
    masked = masked.join(F.broadcast(own.select("w").distinct()), "w", "left_anti").select("label", "w")
    generic = spark.createDataFrame([(UNKNOWN, t) for t in UNKNOWN_TEMPLATES], "label string, t string") \
        .select("label", words(F.col("t")).alias("w"))
    parts = (own.where(F.size("w") > NOTICE_WORDS)
             .withColumn("at", F.explode(F.sequence(F.lit(1), F.size("w"), F.lit(PART_WORDS))))
             .select("label", F.slice("w", F.col("at"), F.lit(PART_WORDS)).alias("w")).where("size(w) >= 8"))
    seeds = own.select("label", "w").union(parts).union(masked).union(generic)
    variants = (seeds.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
                .select("label", "r", F.filter("w", lambda x, i: (F.col("r") == 0) | (F.pmod(F.xxhash64(x, i, "r"), F.lit(8)) > 0))
                        .alias("w")))
    n = max(docs.count(), 1)
    # copies of a text are one candidate, so the bound holds whatever repeats
    picked = (docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < min(1.0, NEGATIVE_DOCS / n) * (1 << 20))
              .select("text").distinct())
    lines = picked.select(F.explode(F.split("text", "\n")).alias("line")).select(words(F.col("line")).alias("w")) \
        .where("size(w) > 0")
    # sampled paragraphs that hold triples of a template may be licenses themselves
    known = own.select(F.explode(grams(F.col("w"))).alias("g")).where("size(split(g, ' ')) = 3") \
        .agg(F.collect_set("g").alias("known"))
    plain = (lines.crossJoin(F.broadcast(known))  # one row on the right
             .where(F.size(F.array_intersect(grams(F.col("w")), F.col("known"))) < 2)
             .select(F.lit(NONE).alias("label"), F.pmod(F.xxhash64("w"), F.lit(10)).alias("r"), "w"))
    return variants.select("label", F.col("r").cast("long"), "w").union(plain) \
        .select("label", "w", (F.col("r") % 10 >= 7).alias("test"))


class Classifier:
    """Classes, vocabulary weights, intercepts and temperature."""

    def __init__(self, spark: SparkSession, docs: DataFrame, families: dict[str, list[str]] = TEMPLATES):
        self.families = families
        own = templates(spark, families).select("w").union(
            spark.createDataFrame([(t,) for t in UNKNOWN_TEMPLATES], "t string").select(words(F.col("t")).alias("w")))
        vocabulary = [r["g"] for r in own.select(F.explode(grams(F.col("w"))).alias("g")).distinct().sort("g").collect()]
        self.classes = [NONE, UNKNOWN, *sorted(families)]
        table = shared.stored(examples(spark, docs, families), "license-examples")
        index = F.lit(0.0)
        for i, c in enumerate(self.classes):
            index = F.when(F.col("label") == c, float(i)).otherwise(index)
        vector = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="g", outputCol="features")
        ready = vector.transform(table.select(grams(F.col("w")).alias("g"), index.alias("label"), "test")).cache()
        model = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60) \
            .fit(ready.where("not test"))
        weights, self.intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray().tolist()
        self.intercepts += [-50.0] * (len(self.classes) - len(self.intercepts))
        rows = [(g, [float(x) for x in w] + [0.0] * (len(self.classes) - len(w))) for g, w in zip(vocabulary, weights.T)]
        self.weights = spark.createDataFrame(rows, "gram string, w array<double>") \
            .select(gram_hash(F.col("gram")).alias("h"), "w")
        raw = vector_to_array("rawPrediction")
        held = model.transform(ready.where("test")).select(raw.alias("z"), F.col("label").cast("int").alias("y"))
        losses = held.agg(*[F.avg(-F.log(F.greatest(F.get(softmax(F.col("z"), t), F.col("y")), F.lit(1e-12)))).alias(f"t{i}")
                            for i, t in enumerate(TEMPERATURES)]).first()
        ready.unpersist()
        self.temperature = min(zip([losses[f"t{i}"] or 0.0 for i in range(len(TEMPERATURES))], TEMPERATURES))[1]


def softmax(z: Column, temperature: float) -> Column:
    e = F.transform(z, lambda x: F.exp((x - F.array_max(z)) / temperature))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def line_grams(docs: DataFrame) -> DataFrame:
    """(doc_id, row, line, h, over): hashes of the pairs and triples that begin
    in a line, and how many lines later a triple ends."""
    hashed = F.transform(F.split("text", "\n"), lambda t: F.transform(words(t), lambda x: F.xxhash64(x)))
    lines = (docs.select("doc_id", F.monotonically_increasing_id().alias("row"), hashed.alias("lines"))
             .select("doc_id", "row", F.explode(F.transform("lines", lambda w, i: F.struct(
                 i.alias("line"), w.alias("w"), _next_words("lines", i).alias("more"),
                 F.coalesce(F.size(F.get("lines", i + 1)), F.lit(0)).alias("m")))).alias("l"))
             .select("doc_id", "row", "l.line", F.size("l.w").alias("n"), "l.m", F.concat("l.w", "l.more").alias("w"))
             .where("n >= 1 and size(w) >= 2"))
    pairs = F.transform(F.sequence(F.lit(0), F.least(F.col("n") - 1, F.size("w") - 2)), lambda i: F.struct(
        F.xxhash64(F.get("w", i), F.get("w", i + 1)).alias("h"), F.lit(0).alias("over")))
    triples = F.transform(F.sequence(F.lit(0), F.least(F.col("n") - 1, F.size("w") - 3)), lambda i: F.struct(
        F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"),
        F.when(i + 2 < F.col("n"), 0).when(i + 2 < F.col("n") + F.col("m"), 1).otherwise(2).alias("over")))
    return (lines.select("doc_id", "row", "line", F.explode(
        F.when(F.size("w") > 2, F.concat(pairs, triples)).otherwise(pairs)).alias("g"))
        .select("doc_id", "row", "line", "g.h", "g.over"))


def _next_words(lines: str, i: Column) -> Column:
    """The first two words after line ``i``, none if the next line is blank."""
    none = F.array().cast("array<bigint>")
    after = F.coalesce(F.get(lines, i + 1), none)
    second = F.slice(F.coalesce(F.get(lines, i + 2), none), 1, 1)
    return F.when(F.size(after) == 1, F.concat(after, second)).otherwise(F.slice(after, 1, 2))


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, line, family, probability, similarity, confirmed) of every
    license paragraph; lines count from 0, and ``line`` is the first one."""
    return spans(docs, model).drop("last_line")


def spans(docs: DataFrame, model: Classifier) -> DataFrame:
    """``scan`` with the ``last_line`` of each paragraph."""
    spark = docs.sparkSession
    k = len(model.classes)
    sums = [f"s{c}" for c in range(k)]
    hits = line_grams(docs).join(F.broadcast(model.weights), "h")  # bounded by the templates
    by_line = hits.groupBy("row", "line").agg(
        F.first("doc_id").alias("doc_id"), F.collect_set("h").alias("hits"), F.max("over").alias("over"),
        *[F.sum(F.get("w", F.lit(c))).alias(s) for c, s in enumerate(sums)])
    order = Window.partitionBy("row").orderBy("line")
    runs = by_line.withColumn("end", F.col("line") + F.col("over")) \
        .withColumn("new", ~F.coalesce(F.lag("end").over(order) >= F.col("line"), F.lit(False))) \
        .withColumn("run", F.sum(F.col("new").cast("int")).over(order))
    scored = runs.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("line").alias("line"), F.max("end").alias("last_line"),
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array(*[F.sum(s) + model.intercepts[c] for c, s in enumerate(sums)]).alias("z"))
    p = scored.withColumn("p", softmax(F.col("z"), model.temperature)).where(F.get("p", F.lit(0)) < 0.5)
    names = F.array(*[F.lit(c) for c in model.classes])
    best = F.slice("p", 3, k - 2)
    p = p.withColumn("probability", F.array_max(best)) \
        .withColumn("family", F.when(F.col("probability") >= SURE,
                                     F.get(names, F.array_position(best, F.col("probability")).cast("int") + 1))
                    .otherwise(UNKNOWN))
    p = shared.stored(p.select("doc_id", "line", "last_line", "family", "probability", "hits"), "licenses")

    known = (templates(spark, model.families).select("label", "template", F.explode(F.array_distinct(grams(F.col("w")))).alias("g"))
             .select("label", "template", gram_hash(F.col("g")).alias("h"))
             .groupBy("label", "template").agg(F.collect_set("h").alias("own"))
             .groupBy("label").agg(F.collect_list("own").alias("templates")))
    similar = F.coalesce(F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("hits"))) / F.size(t))),
                         F.lit(0.0))
    return (p.join(F.broadcast(known.withColumnRenamed("label", "family")), "family", "left")
            .select("doc_id", "line", "last_line", "family", "probability", similar.alias("similarity"))
            .withColumn("confirmed", F.col("similarity") >= CONFIRMED))


def query(spark, sf_dir: str) -> DataFrame:
    """The license paragraphs of all documents."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text").where("text is not null")
    return spans(docs, Classifier(spark, docs))
