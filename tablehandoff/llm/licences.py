"""Licences of files: TF-IDF cosine to templates, then the nearest directory's.

Compared are every line, and runs of as many terms as a template has: over the header of a file
(its first comment block or paragraph) where that wraps, and over the whole of a licence file.
Term weights are measured over all files. Only texts that can reach the cosine are compared: if
one has none of a template's heavy terms, its cosine is at most the share of the other terms in
the template's norm (Cauchy-Schwarz), so heavy terms are those without which the cosine stays
below the limit.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehandoff.llm.frames import col, numbered, stored

LEAST = 0.75

# Licence notices as they are usually worded (fixed values).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
# The first comment block, else the first paragraph.
HEADER = r"(?s)\A\s*(/\*.*?\*/|<!--.*?-->|.*?(?=\n[ \t\r]*\n|\z))"


def terms(text: Column) -> Column:
    """Runs of letters and digits in small letters."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), "")


def _terms(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def frequencies(rows: DataFrame) -> DataFrame:
    """``term`` and ``df``, the files it is in; the empty term stands for the file itself."""
    seen = F.array_append(F.array_distinct(terms(F.col("text"))), F.lit(""))
    return rows.select(F.explode(seen).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def weigh(seen: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], int]:
    """(weight of each term, number of files): ln((1 + files) / (1 + files with it)) + 1."""
    counts = {r.term: r.df for r in seen.where(F.col("term").isin(["", *vocabulary])).collect()}
    n = counts.get("", 0)
    return {v: math.log((1 + n) / (1 + counts.get(v, 0))) + 1 for v in vocabulary}, n


def heavy_terms(vectors: list[dict[str, float]], least: float) -> list[str]:
    """Terms of which a line needs one to reach ``least`` with some template."""
    heavy: set[str] = set()
    for v in vectors:
        whole = sum(x * x for x in v.values())
        rest = whole
        for term, x in sorted(v.items(), key=lambda p: (-p[1], p[0])):
            if rest < least * least * whole:
                break
            heavy.add(term)
            rest -= x * x
    return sorted(heavy)


def line_scores(lines: DataFrame, seen: DataFrame, template_table: DataFrame, least: float) -> DataFrame:
    """``row``, ``licence``, ``score`` of the lines that reach ``least`` with a template."""
    # The templates are a fixed list, so their table is of fixed size.
    counted = (
        lines.select("row", "line", F.explode(terms(F.col("content"))).alias("term"))
        .groupBy("row", "line", "term").agg(F.count(F.lit(1)).alias("tf"))
        .join(seen, "term").withColumn("x", F.col("tf") * F.col("weight"))
    )
    return (
        counted.join(F.broadcast(template_table), "term", "left")
        .groupBy("row", "line", "term", "x").agg(F.collect_list(F.struct("template", "licence", "part")).alias("hits"))
        .groupBy("row", "line")
        .agg(F.sum(F.col("x") * F.col("x")).alias("square"), F.flatten(F.collect_list(F.transform("hits", lambda h: F.struct(
            h["template"].alias("template"), h["licence"].alias("licence"), (h["part"] * F.col("x")).alias("dot"))))).alias("hits"))
        .select("row", "line", "square", F.explode("hits").alias("h")).where("h.template is not null")
        .groupBy("row", "line", "h.template", "h.licence", "square").agg(F.sum("h.dot").alias("dot"))
        .withColumn("score", F.least(F.lit(1.0), F.round(F.col("dot") / F.sqrt("square"), 9)))
        .where(F.col("score") >= least).select("row", "licence", "score")
    )


def run_scores(areas: DataFrame, seen: DataFrame, template_table: DataFrame, least: float) -> DataFrame:
    """``row``, ``licence``, ``score`` of the best run of a template's number of terms in an area;
    an area with fewer terms is one run."""
    # A run cannot reach ``least`` if the terms of the whole area cannot.
    held = (
        areas.select("row", F.explode("hits").alias("term")).join(F.broadcast(template_table), "term")
        .groupBy("row", "template", "licence", "size").agg(F.sum(F.col("part") * F.col("part")).alias("most"))
        .where(F.col("most") >= least * least - 1e-9).drop("most")
    )
    held = held.groupBy("row").agg(F.collect_list(F.struct("template", "licence", "size")).alias("held"))
    parts = template_table.select("template", "term", "part")
    placed = (
        areas.join(held, "row").select("row", "held", F.posexplode("terms").alias("at", "term"))
        .join(seen, "term").select("row", "at", "term", "weight", F.explode("held").alias("h"))
        .select("row", "at", "term", "weight", "h.*").join(F.broadcast(parts), ["template", "term"], "left")
        .groupBy("row", "template", "licence", "size")
        .agg(F.sort_array(F.collect_list(F.struct("at", "term", F.col("weight").alias("x"), (F.col("weight") * F.coalesce("part", F.lit(0.0))).alias("dot")))).alias("all"))
    )

    def total(start: Column, value) -> Column:
        return F.aggregate(F.slice("all", start, F.col("size")), F.lit(0.0), lambda sum, e: sum + value(e))

    def repeated(start: Column):
        return lambda e: e["x"] * total(start, lambda f: F.when(f["term"] == e["term"], f["x"]).otherwise(0.0))

    # Repeated terms only lengthen a run, so the sum of single squares bounds its cosine.
    starts = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size("all") - F.col("size") + 1, F.lit(1))),
        lambda s: total(s, lambda e: e["dot"]) >= (least - 1e-9) * F.sqrt(total(s, lambda e: e["x"] * e["x"])),
    )
    score = F.array_max(F.transform(F.col("starts"), lambda s: total(s, lambda e: e["dot"]) / F.sqrt(total(s, repeated(s)))))
    return (
        placed.withColumn("starts", starts).where(F.size("starts") > 0)
        .select("row", "licence", F.least(F.lit(1.0), F.round(score, 9)).alias("score")).where(F.col("score") >= least)
    )


def matched(rows: DataFrame, templates: list[tuple[str, str]], least: float) -> DataFrame:
    """``row``, ``licence``, ``score``: the best template of any line or run of a file that reaches ``least``."""
    spark = rows.sparkSession
    bags = [Counter(_terms(t)) for _, t in templates]
    vocabulary = sorted(set().union(*bags))
    counted = stored(frequencies(rows), "frequencies")
    weights, files = weigh(counted, vocabulary)
    seen = counted.select("term", (F.log(F.lit(1.0 + files) / (1 + F.col("df"))) + 1).alias("weight"))
    vectors = [{t: n * weights[t] for t, n in b.items()} for b in bags]
    norms = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]
    heavy = "(?i)(?<![\\p{L}\\p{N}])(" + "|".join(re.escape(t) for t in heavy_terms(vectors, least)) + ")(?![\\p{L}\\p{N}])"
    template_table = spark.createDataFrame(
        [(t, templates[i][0], i, sum(bags[i].values()), x / norms[i]) for i, v in enumerate(vectors) for t, x in v.items()],
        "term string, licence string, template int, size int, part double",
    )
    able = rows.where(F.col("text").rlike(heavy))
    lines = able.select("row", F.posexplode(F.split("text", "\n")).alias("line", "content")).where(F.col("content").rlike(heavy))
    header = F.rtrim(F.regexp_extract("text", HEADER, 1))
    declares = F.coalesce(F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE), F.lit(False))
    wrapped = F.col("declares") | F.contains("area", F.lit("\n"))
    known = F.array(*[F.lit(v) for v in vocabulary])
    areas = stored(
        able.select("row", declares.alias("declares"), F.when(declares, F.col("text")).otherwise(header).alias("area"))
        .where(wrapped & F.col("area").rlike(heavy)).select("row", terms(F.col("area")).alias("terms"))
        .withColumn("hits", F.array_intersect("terms", known)),
        "areas",
    )
    scored = line_scores(lines, seen, template_table, least).unionByName(run_scores(areas, seen, template_table, least))
    # Of equal scores the first licence by name.
    return scored.groupBy("row").agg(F.max("score").alias("score"), F.min(F.struct(-F.col("score"), "licence")).alias("best")).select(
        "row", F.col("best.licence").alias("licence"), "score"
    )


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(
    files: DataFrame, id: str = "doc_id", path: str = "path", text: str = "text",
    templates: list[tuple[str, str]] | None = None, least: float = LEAST,
) -> DataFrame:
    """``doc_id``, ``path``, ``own_licence`` and ``own_score`` (of the file's best line or run, else null),
    ``inherited_licence`` and ``inherited_from`` (of the nearest directory at or above the file
    whose licence file has a licence, else null), ``licence`` (own, else inherited).

    A licence file is one named LICENSE, LICENCE, COPYING or NOTICE, with or without an ending.
    Of several in a directory the best score counts, then the least path. A null text has no
    licence of its own; a null path inherits nothing. Repeated rows get equal results; an empty
    table gives an empty result. Other columns are not read.
    """
    rows = numbered(files, text, [c for c in dict.fromkeys((id, path)) if c != text]).select(
        "row", F.col("rest").getField(id).alias("doc_id"), F.col("rest").getField(path).cast("string").alias("path"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    own = stored(matched(rows.select("row", "path", "text"), TEMPLATES if templates is None else templates, least), "own-licences")
    placed = rows.select("row", "doc_id", "path", _folder(F.col("path")).alias("folder"))
    declared = stored(
        placed.where(F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE)).join(own, "row")
        .groupBy("folder").agg(F.min(F.struct(-F.col("score"), "path", "licence")).alias("best"))
        .select(F.col("folder").alias("above"), F.col("best.licence").alias("licence")),
        "declared",
    )
    # Directories, not files, are joined with their ancestors.
    folders = placed.where(F.col("folder").isNotNull()).select("folder").distinct()
    parts = F.split("folder", "/")
    above = F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))
    nearest = stored(
        folders.select("folder", above.alias("above")).join(declared, "above")
        .groupBy("folder").agg(F.max(F.struct(F.length("above").alias("n"), "above", "licence")).alias("best"))
        .select("folder", F.col("best.licence").alias("inherited_licence"), F.col("best.above").alias("inherited_from")),
        "nearest",
    )
    found = placed.join(own.select("row", F.col("licence").alias("own_licence"), F.col("score").alias("own_score")), "row", "left")
    return found.join(nearest, "folder", "left").select(
        "doc_id", "path", "own_licence", "own_score", "inherited_licence", "inherited_from",
        F.coalesce("own_licence", "inherited_licence").alias("licence"),
    )


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "licence string, text string")
