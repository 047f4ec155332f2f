"""Licence scans by a trained paragraph classifier, in DataFrame functions and JVM-side ML only.

A sparse logistic regression over word n-grams tells the licence family of a
line or sentence. It learns from the templates below, whole and cut short, and
from an unknown class of other sentences: written ones that speak of licences
and grant none, and a bounded sample of the corpus. A part of either is held
back and calibrates the unknown class: a family's probability must be higher
than the highest that any held-back unknown sentence reaches. A predicted
family is then confirmed by comparing the sentence with the family's templates.

Every sentence of every text is scored; ``CUES`` only keep sentences that speak
of licences out of the sample.

Defined cases: null and empty texts have no licences; equal rows get equal
results, and rows of one id are told apart by their texts; rows without an id
are scanned like others; a statement repeated in a text counts once; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamline.llm.common import Stash, bounded, table
from seamline.llm.decontaminate import row_key

UNKNOWN = "unknown"
#: Sentences of the corpus that the unknown class is taught with.
UNKNOWN_ROWS = 4000
CONFIRM = 0.5
#: Rows with a statement up to which they are broadcast.
ROWS_CAP = 1_000_000
#: Bounds of the probability that a family needs.
LEAST, MOST = 0.4, 0.9
CUES = r"(?i)licen[sc]|copyright|warrant|redistribut|public domain|spdx|creative commons|\bcc0\b|\bcc[ -]by\b|\ba?l?gpl\b"
#: Notices by licence family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Distributed under the Apache License 2.0.",
        "Released under Apache 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "Distributed under the terms of the MIT licence.",
        "Released under MIT.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Released under the GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc0": [
        "Released under CC0 1.0, dedicated to the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 by the author, all rights reserved.",
        "All rights reserved, no part of this work may be copied without written permission and a licence of the copyright holder.",
    ],
}
#: Written sentences: of every so many, one is held back.
FOLD = 4
#: Sentences that speak of licences and grant none.
OTHERS = [
    "His driving licence was suspended last year.",
    "The shop lost its liquor license in March.",
    "Copyright law differs between countries.",
    "The police had a warrant for the house.",
    "The product comes with a two year warranty.",
    "She took artistic license with the story.",
    "The licensing office is closed on Mondays.",
    "We discussed public licenses and versions of software at the meeting.",
    "The general public was not admitted.",
    "The lake is in the public domain of the village.",
    "The MIT License is short and popular among programmers.",
    "Our post compares the Apache License with the GNU General Public License.",
    "Many projects moved away from the GPL in that year.",
    "The BSD License has several versions, as the article explains.",
    "She asked which Creative Commons licence suits a photograph.",
    "Version 2.0 of the Apache License appeared in 2004.",
    "The Mozilla Public License was written by a lawyer.",
    "Lawyers discussed the GNU Affero General Public License at the conference.",
    "He reserved all rooms for the meeting on human rights.",
    "The rights of the workers were discussed, the hall was reserved.",
    "The permission was granted by the town, free of charge.",
    "The use and redistribution of water is regulated by the state.",
    "This program is for children and this work is for adults.",
    "A CC BY photo won the prize, the magazine said.",
    "Is the MIT License older than the BSD License?",
    "They could not agree on a license for the new software.",
    "The software was released under pressure from the press.",
    "Prisoners were released under the new law of the state.",
]


def sentences(docs: DataFrame) -> DataFrame:
    """``docs`` rows with each sentence."""
    parts = F.split(F.col("text"), r"\n+|(?<=[.!?;])\s+")
    return docs.withColumn("sentence", F.explode(parts)).where(F.col("sentence") != "")


def grams(tokens: Column) -> Column:
    """Distinct word pairs, and the words of shorter sentences."""
    pairs = F.transform(F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(tokens, i), w))
    return F.array_distinct(F.when(F.size(tokens) > 1, pairs).otherwise(tokens))


def train(docs: DataFrame, stash: Stash):
    """The fitted stages, the labels by class number and the probability asked of a family."""
    spark = docs.sparkSession
    rows = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = text.split()
            rows += [(family, " ".join(words[i:j])) for i, j in {(0, len(words)), (0, max(4, len(words) * 3 // 4)), (max(0, len(words) // 4), len(words))}]
    rows = [(f, t, False) for f, t in rows] + [(UNKNOWN, x, i % FOLD == 0) for i, x in enumerate(OTHERS)]
    line = F.split(F.col("text"), r"\n+|(?<=[.!?;])\s+")[0]
    plain = docs.where(F.length("text") > 0).select(line.alias("sentence")).where(~F.col("sentence").rlike(CUES))
    plain = plain.distinct().orderBy(F.xxhash64("sentence"), "sentence").limit(UNKNOWN_ROWS)
    plain = stash.put("unknown", plain.withColumn("family", F.lit(UNKNOWN)).withColumn("held", F.pmod(F.xxhash64("sentence"), F.lit(FOLD)) == 0), small=True)
    given = spark.createDataFrame(rows, "family string, sentence string, held boolean")
    names = sorted(TEMPLATES)
    number = F.create_map(*(F.lit(x) for i, n in enumerate([*names, UNKNOWN]) for x in (n, float(i))))
    data = given.unionByName(plain.select("family", "sentence", "held")).withColumn("label", number[F.col("family")])
    # Templates and written sentences are few, the sample is not: all of the sample weighs as much as twenty sentences.
    data = data.withColumn("weight", F.when((F.col("family") == UNKNOWN) & ~F.col("sentence").isin(OTHERS), 20.0 / UNKNOWN_ROWS).otherwise(1.0))
    stages = [
        RegexTokenizer(inputCol="sentence", outputCol="tokens", pattern=r"[^\p{L}\p{N}]+", minTokenLength=1),
        NGram(n=2, inputCol="tokens", outputCol="pairs"),
        SQLTransformer(statement="SELECT *, concat(tokens, pairs) AS terms FROM __THIS__"),
    ]
    prepared = Pipeline(stages=stages).fit(data)
    known = prepared.transform(data.where("NOT held"))
    # Terms that no written sentence holds say the same of all families; the vocabulary is that of the lists above.
    vectors = CountVectorizer(inputCol="terms", outputCol="features", vocabSize=1 << 18, binary=True).fit(prepared.transform(given))
    model = LogisticRegression(maxIter=100, regParam=0.001, elasticNetParam=0.1, weightCol="weight", family="multinomial").fit(vectors.transform(known))
    held = model.transform(vectors.transform(prepared.transform(data.where("held"))))
    best = F.array_max(F.slice(vector_to_array("probability"), 1, len(names)))
    asked = held.agg(F.max(best)).first()[0]
    return prepared, vectors, model, names, min(MOST, max(LEAST, asked or 0.0))


def statements(docs: DataFrame, stash: Stash, keep: list[str]) -> DataFrame:
    """``keep`` columns with family, probability and likeness of every licence statement."""
    spark = docs.sparkSession
    prepared, vectors, model, names, asked = train(docs, stash)
    found = model.transform(vectors.transform(prepared.transform(sentences(docs.select(*keep, "text")))))
    chance = vector_to_array("probability")
    named = F.array(*(F.lit(n) for n in names))
    best = F.array_max(F.slice(chance, 1, len(names)))
    told = found.withColumn("best", best).where((F.col("best") > asked) & (F.col("best") > chance[len(names)]))
    told = told.withColumn("family", F.element_at(named, F.array_position(F.slice(chance, 1, len(names)), F.col("best")).cast("int")))
    texts = spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts], "family string, sentence string")
    templates = prepared.transform(texts).select("family", grams(F.col("tokens")).alias("template"))
    compared = told.withColumn("own", grams(F.col("tokens"))).join(bounded(templates, 1000), "family")
    shared = F.size(F.array_intersect("own", "template")) / F.least(F.size("template"), F.greatest(F.size("own"), F.lit(1)))
    likeness = compared.groupBy(*keep, "sentence", "family", "best").agg(F.max(shared).alias("likeness"))
    return likeness.where(F.col("likeness") >= CONFIRM).select(*keep, "sentence", "family", F.col("best").alias("probability"), "likeness")


def scanned(docs: DataFrame, stash: Stash) -> DataFrame:
    """(doc_id, families, statements, probability) of every row of (doc_id, text)."""
    keyed = docs.select(*row_key(), "text")
    found = statements(keyed, stash, ["k1", "k2"]).groupBy("k1", "k2").agg(
        F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"), F.count_distinct("sentence").alias("statements"), F.max("probability").alias("probability")
    )
    found = stash.put("licences", found, small=True)
    return docs.select("doc_id", *row_key()).join(bounded(found, ROWS_CAP), ["k1", "k2"], "left").select(
        "doc_id", F.coalesce("families", F.lit("")).alias("families"), F.coalesce("statements", F.lit(0)).cast("long").alias("statements"), F.round("probability", 4).alias("probability")
    )


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents").select("doc_id", "text"), Stash(spark))
