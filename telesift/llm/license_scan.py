"""Licence notices found by sparse TF-IDF cosine to templates, and inherited from the nearest ancestor directory.

A text is cut into segments (lines, and sentences in lines). A segment is a notice of the licence whose template it is most
like, if the cosine is at least MIN_COSINE. A file is a licence file if its name says so, or if notices are half of its words;
its licence holds for its directory and all below it that have no nearer one.

All steps are built-in functions and joins. Document frequencies of the templates' words are counted over all texts. Of each
template only the words of greatest weight can lift a cosine over the bound (the rest together weigh too little), so only
texts with such a word are cut into segments at all: a filter that loses nothing.

Defined results
    A null or empty text has no notice. Of equally like templates the first in name order counts, of equally like notices
    of a file the first in the text; of a directory's licence files the one with the higher cosine, then the smaller path.
    Rows with a null path neither give nor inherit. Repeated rows each come back. An empty table gives an empty table.
    Input columns come back unchanged, but for those named like one of RESULT_COLUMNS, which the result takes.
"""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telesift.session import scratch_path

MIN_COSINE = 0.75
NOTICE_SHARE = 0.5
RESULT_COLUMNS = ("own_license", "own_cosine", "n_notices", "is_license_file", "license", "license_from")

#: Sentences of well-known notices, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License."),
    ("LGPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
)

NOT_WORD = "[^a-z0-9]+"
SEGMENT_END = r"\n|(?<=[.!?])[ \t]+"
LICENSE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense)[^/]*$"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def template_words() -> list[tuple[str, int, str, int]]:
    """(licence, template number, word, how often) of all templates."""
    out = []
    for number, (name, text) in enumerate(TEMPLATES):
        words = [w for w in re.split(NOT_WORD, text.lower()) if w]
        out += [(name, number, w, words.count(w)) for w in sorted(set(words))]
    return out


def _weights(df: dict[str, int], documents: int) -> tuple[dict[str, float], float, list[tuple[int, str, float]]]:
    """(idf of the templates' words, idf of any other word, unit vectors of the templates)."""
    rows = template_words()
    idf = {w: math.log((documents + 1) / (df.get(w, 0) + 1)) + 1 for _, _, w, _ in rows}
    other = sum(idf.values()) / len(idf)
    norm: dict[int, float] = {}
    for _, number, w, n in rows:
        norm[number] = norm.get(number, 0.0) + (n * idf[w]) ** 2
    return idf, other, [(number, w, n * idf[w] / math.sqrt(norm[number])) for _, number, w, n in rows]


def _needed(vectors: list[tuple[int, str, float]], bound: float) -> list[str]:
    """Words of which a segment must hold one: those that are left out of a template have a norm under the bound."""
    needed: set[str] = set()
    for number in {v[0] for v in vectors}:
        left_out = 0.0
        for _, word, weight in sorted((v for v in vectors if v[0] == number), key=lambda v: (v[2], v[1])):
            left_out += weight**2
            if left_out >= (bound - 1e-6) ** 2:
                needed.add(word)
    return sorted(needed)


def scan(files: DataFrame, path: str = "path", text: str = "text", carry: tuple[str, ...] | None = None, min_cosine: float = MIN_COSINE) -> DataFrame:
    """All rows with their own notice, and the licence that holds for them and where it comes from ('own' or a directory).

    `carry` names the columns that come back (all, if not given): rows are written once in between, with these.
    """
    spark = files.sparkSession
    keep = [c for c in (files.columns if carry is None else carry) if c.lower() not in RESULT_COLUMNS]
    vocabulary = sorted({row[2] for row in template_words()})
    known = F.array(*[F.lit(w) for w in vocabulary])

    # At most as many rows as the templates have words, and one more for the number of texts.
    held = files.select(F.array_intersect(_words(F.col(f"`{text}`")), known).alias("held"))
    counted = held.select(F.explode(F.concat(F.coalesce("held", F.array()), F.array(F.lit("")))).alias("w")).groupBy("w").count()
    counts = {r["w"]: r["count"] for r in counted.collect()}
    idf, other, vectors = _weights(counts, counts.get("", 0))
    needed = "(^|[^a-z0-9])(" + "|".join(_needed(vectors, min_cosine)) + ")($|[^a-z0-9])"

    rid = f"__rid_{uuid.uuid4().hex[:8]}"
    # Texts that are alike give alike results: each is looked at once, under a digest, so that no text is shuffled.
    whole_text = F.col(f"`{text}`")
    has = F.lower(whole_text).rlike(needed)
    numbered = F.transform(F.split(whole_text, SEGMENT_END), lambda part, i: F.struct(i.alias("at"), part.alias("segment")))
    folder = scratch_path(spark, "licences")
    files.select(
        *[F.col(f"`{c}`") for c in keep], F.col(f"`{path}`").alias("__path"), F.when(has, F.sha2(whole_text, 256)).alias("__digest"),
        F.when(has, F.size(_words(whole_text))).alias("__n"),
        F.when(has, F.filter(numbered, lambda x: F.lower(x["segment"]).rlike(needed))).alias("__parts"),
    ).write.parquet(folder)
    stored = spark.read.parquet(folder)
    texts = stored.filter("__digest IS NOT NULL").groupBy("__digest").agg(F.first("__n").alias("__n"), F.first("__parts").alias("parts"))
    segments = texts.select("__digest", "__n", F.explode("parts").alias("part")).select("__digest", "__n", "part.at", "part.segment")
    words = segments.select("__digest", "__n", "at", F.explode(_words(F.col("segment"))).alias("word"))
    weight_of = F.create_map(*[x for w in vocabulary for x in (F.lit(w), F.lit(idf[w]))])
    terms = words.groupBy("__digest", "__n", "at", "word").agg(F.count("*").alias("tf"))
    terms = terms.withColumn("weight", F.col("tf") * F.coalesce(F.try_element_at(weight_of, F.col("word")), F.lit(other)))
    whole = Window.partitionBy("__digest", "at")
    terms = terms.withColumn("norm", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(whole)))
    terms = terms.withColumn("length", F.sum("tf").over(whole))
    table = spark.createDataFrame([(TEMPLATES[n][0], n, w, x) for n, w, x in vectors], "name string, template int, word string, x double")
    cosines = terms.join(F.broadcast(table), "word").groupBy("__digest", "__n", "at", "length", "name", "template").agg(
        F.sum(F.col("weight") / F.col("norm") * F.col("x")).alias("cosine")
    )
    # The greatest first; of equals the first name.
    best = cosines.withColumn("cosine", F.round("cosine", 6)).filter(F.col("cosine") >= min_cosine).groupBy("__digest", "__n", "at", "length").agg(
        F.min(F.struct((-F.col("cosine")).alias("minus"), F.col("name"))).alias("best")
    )
    noticed = best.groupBy("__digest").agg(
        F.min(F.struct(F.col("best.minus").alias("minus"), F.col("at"), F.col("best.name").alias("name"))).alias("first"),
        F.count("*").alias("notices"),
        (F.sum("length") / F.first("__n") >= NOTICE_SHARE).alias("mostly"),
    )
    # Rows without a digest match nothing; names of their own keep them from meeting in one task.
    none = F.concat(F.lit("none "), F.pmod(F.xxhash64("__path"), F.lit(1 << 16)).cast("string"))
    marked = stored.withColumn("__digest", F.coalesce("__digest", none)).drop("__n", "__parts")
    own = marked.join(noticed, "__digest", "left").select(
        *[F.col(f"`{c}`") for c in keep], "__path",
        F.col("first.name").alias("own_license"),
        (-F.col("first.minus")).alias("own_cosine"),
        F.coalesce("notices", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce(F.col("first").isNotNull() & (F.col("mostly") | F.coalesce(F.col("__path").rlike(LICENSE_NAME), F.lit(False))), F.lit(False)).alias("is_license_file"),
        F.regexp_replace("__path", "/?[^/]*$", "").alias("__dir"),
    )
    # What each directory has by its own licence files, and what each distinct directory gets from its nearest one.
    given = own.filter("is_license_file AND __dir IS NOT NULL").groupBy("__dir").agg(
        F.min(F.struct((-F.col("own_cosine")).alias("minus"), F.col("__path").alias("path"), F.col("own_license").alias("name"))).alias("given")
    ).select(F.col("__dir").alias("__above"), F.col("given.name").alias("name"))
    steps = F.split("__dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    nearest = (
        own.filter("__dir IS NOT NULL").select("__dir").distinct()
        .select("__dir", F.explode(F.array_distinct(above)).alias("__above")).join(given, "__above")
        .groupBy("__dir").agg(F.max(F.struct(F.length("__above").alias("n"), F.col("__above").alias("from"), F.col("name"))).alias("near"))
        .select(F.col("__dir").alias(rid), "near")
    )
    joined = own.join(nearest, F.col("__dir") == F.col(rid), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in keep], *RESULT_COLUMNS[:4],
        F.coalesce("own_license", F.col("near.name")).alias("license"),
        F.when(F.col("own_license").isNotNull(), "own").otherwise(F.col("near.from")).alias("license_from"),
    )
