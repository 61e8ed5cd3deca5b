"""Licences of files: TF-IDF cosine of lines to templates, then inheritance by directory.

Every line of a file is compared with the licence templates as a sparse vector of word
counts times inverse document frequencies, which are counted over all files for the words
of the templates (any other word has the weight of a word in no file). A line can reach
the threshold only if it shares one of a template's heaviest words: what the lighter ones
give together stays below it. Only lines with such a word are scored; none is lost.

A file whose first line that isn't blank is a licence line is a licence file and speaks
for its directory. A file without a licence line takes that of the nearest directory above
it which has one, by joins on the distinct directories. Everything here is DataFrame
expressions.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.near_dedup import word_text
from tidemark.llm.text import join_counted
from tidemark.session import ensure_checkpoint_dir

THRESHOLD = 0.75
ROOT = "."

# Licence notices in use, by public licence identifiers: fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-proprietary", "All rights reserved."),
)


def plain_words(text: str) -> list[str]:
    """Words of a template, as :func:`near_dedup.word_text` makes them of ASCII texts."""
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def vocabulary(templates) -> list[str]:
    return sorted({w for _, text in templates for w in plain_words(text)})


def document_frequencies(files: DataFrame, words: list[str]) -> tuple[int, dict[str, int]]:
    """The number of files, and of those that hold each of the words."""
    held = files.select(F.array_intersect(F.split(word_text(F.col("text")), " "), F.lit(words)).alias("w"))
    rows = held.select(F.explode(F.concat(F.array(F.lit("")), "w")).alias("w")).groupBy("w").count().collect()
    counts = {r["w"]: r["count"] for r in rows}  # at most one row for each word of the templates
    return counts.pop("", 0), counts


class Weights:
    """Inverse document frequencies, unit vectors of the templates, and the words of which a
    line needs one at least."""

    def __init__(self, templates, n: int, counts: dict[str, int], threshold: float = THRESHOLD):
        self.unknown = math.log(n + 1.0) + 1.0
        self.idf = {w: math.log((n + 1.0) / (counts.get(w, 0) + 1.0)) + 1.0 for w in vocabulary(templates)}
        self.vectors: list[tuple[str, dict[str, float]]] = []
        anchors: set[str] = set()
        for name, text in templates:
            v = {w: c * self.idf[w] for w, c in Counter(plain_words(text)).items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            v = {w: x / norm for w, x in v.items()}
            self.vectors.append((name, v))
            rest = 1.0
            for w, x in sorted(v.items(), key=lambda i: (-i[1], i[0])):
                if math.sqrt(max(rest, 0.0)) < threshold - 1e-9:
                    break
                anchors.add(w)
                rest -= x * x
        self.anchors = sorted(anchors)


def _lookup(values: dict[str, float], word: Column, default: float) -> Column:
    held = F.create_map(*[x for w, v in values.items() for x in (F.lit(w), F.lit(float(v)))])
    return F.coalesce(F.try_element_at(held, word), F.lit(default))


def _scores(words: Column, w: Weights) -> Column:
    """Struct (score, license) of the best template; of equal ones the last by name."""
    norm = F.sqrt(F.aggregate(F.array_distinct(words), F.lit(0.0), lambda a, x: a + F.pow(
        F.size(F.filter(words, lambda y: y == x)) * _lookup(w.idf, x, w.unknown), F.lit(2.0))))
    def cosine(v: dict[str, float]) -> Column:
        weighted = {t: y * w.idf[t] for t, y in v.items()}
        return F.round(F.aggregate(words, F.lit(0.0), lambda a, x: a + _lookup(weighted, x, 0.0)) / norm, 6)

    each = [F.struct(cosine(v).alias("score"), F.lit(name).alias("license")) for name, v in w.vectors]
    return F.array_max(F.array(*each))


def licence_lines(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``path, doc_id, line, first, license, score`` of every line that reaches the threshold;
    ``first`` holds for a file's first line that isn't blank."""
    n, counts = document_frequencies(files, vocabulary(templates))
    w = Weights(templates, n, counts, threshold)

    def words(text: str) -> Column:
        return F.split(word_text(F.col(text)), " ")

    # whole files first, then their lines: few have one of the words
    some = files.filter(F.arrays_overlap(words("text"), F.lit(w.anchors)))
    lines = some.select("path", "doc_id", F.split(F.col("text").cast("string"), "\n").alias("lines"))
    lines = lines.withColumn("top", F.array_position(F.transform("lines", lambda x: F.trim(x) != ""), True))
    lines = lines.select("path", "doc_id", "top", F.posexplode("lines").alias("line", "raw")).withColumn("words", words("raw"))
    cand = (lines.filter(F.arrays_overlap("words", F.lit(w.anchors)))
            .select("path", "doc_id", "line", (F.col("line") + 1 == F.col("top")).alias("first"), "words").checkpoint())
    return (cand.withColumn("best", _scores(F.col("words"), w)).filter(F.col("best.score") >= threshold)
            .select("path", "doc_id", "line", "first", "best.license", "best.score"))


def parent(path: Column) -> Column:
    """The directory of a path; ``.`` for a path without one."""
    up = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when((up == "") | (path == ROOT), F.lit(ROOT)).otherwise(up)


def ancestors(folder: Column) -> Column:
    """The directory and those above it, nearest first, with ``.`` at the end."""
    parts = F.split(folder, "/")
    up = F.transform(F.sequence(F.size(parts), F.lit(1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    return F.when(folder == ROOT, F.array(F.lit(ROOT))).otherwise(F.concat(up, F.array(F.lit(ROOT))))


def scan_licences(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, path, license, origin, score, source_dir`` for every row of ``files``
    (``doc_id``, ``path``, ``text``).

    ``origin`` is ``own`` where a line of the file reaches the threshold (the best one counts,
    then the earlier), ``inherited`` where the licence file (the smallest path of several)
    of the nearest directory at or above the file's speaks for it, else null, as are license
    and score. Rows with one path are one file: the best line of any counts for all. A null
    or empty text has no line. A null path stands in the root directory. All rows are
    returned; an empty table gives none.
    """
    ensure_checkpoint_dir(files.sparkSession)
    files = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), "text")
    lines = licence_lines(files, templates, threshold).checkpoint()
    own = (lines.groupBy("path").agg(F.max(F.struct("score", (-F.col("line")).alias("at"), "license")).alias("b"), F.max("first").alias("top"))
           .select("path", "b.score", "b.license", "top").checkpoint())
    speaks = (own.filter("top").groupBy(parent(F.col("path")).alias("source_dir"))
              .agg(F.min(F.struct("path", "license")).alias("s")).select("source_dir", F.col("s.license").alias("dir_license")).checkpoint())
    # directories are resolved once each, however many files they hold
    folders = files.select(parent(F.col("path")).alias("folder")).distinct()
    above = folders.select("folder", F.posexplode(ancestors(F.col("folder"))).alias("far", "source_dir"))
    nearest = (above.join(speaks, "source_dir").groupBy("folder")
               .agg(F.min(F.struct("far", "source_dir", "dir_license")).alias("n")).select("folder", "n.source_dir", "n.dir_license").checkpoint())
    rows = files.select("doc_id", "path", parent(F.col("path")).alias("folder"))
    rows = join_counted(join_counted(rows, own, "path", "left"), nearest, "folder", "left")
    has = F.col("license").isNotNull()
    return rows.select("doc_id", "path", F.coalesce("license", "dir_license").alias("license"),
                       F.when(has, "own").when(F.col("dir_license").isNotNull(), "inherited").alias("origin"), "score",
                       F.when(~has, F.col("source_dir")).alias("source_dir"))


def document_paths(docs: DataFrame, per_folder: int = 100) -> DataFrame:
    """Documents as files ``source/lang/<doc_id div per_folder>/<doc_id>`` (``_`` for a null)."""
    def part(c: Column) -> Column:
        return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("_"))

    return docs.select("doc_id", F.concat_ws("/", part(F.col("source")), part(F.col("lang")), part(F.floor(F.col("doc_id") / per_folder)),
                                             part(F.col("doc_id"))).alias("path"), "text")
