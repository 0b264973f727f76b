"""Licence scan: TF-IDF cosine to templates, then inheritance along directories.

Units are the lines of a file (headers) and the whole file (licence files). A unit is a
sparse TF-IDF vector over its tokens; document frequencies of the templates' tokens are
counted over all files, other tokens weigh like tokens of no file. A unit matches the
template of highest cosine if that reaches THRESHOLD. The index is the templates'
weights: its size follows the templates, not the corpus.

A file's own licence is the match of the whole file, else its best line. A directory's
licence is that of its licence files; where it has none, the one that all headers in it
agree on. A file without a licence of its own takes that of the nearest ancestor
directory that has one: each directory is joined to its ancestors by path, then the
files to their directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import under, written

THRESHOLD = 0.8

# Templates: licence identifier and the statements that stand for it (fixed values: the
# usual notices of these licences).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                   "this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without "
            "restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or any later version"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("Proprietary", "All rights reserved"),
]
_TOKEN = re.compile(rb"[a-z0-9]+")


def tokens(text: str | bytes) -> list[bytes]:
    """Runs of a-z and 0-9 after lower-casing A-Z."""
    return _TOKEN.findall((text.encode() if isinstance(text, str) else text).lower())


def vocabulary(templates) -> list[str]:
    return sorted({t.decode() for _, text in templates for t in tokens(text)})


def document_frequencies(files: DataFrame, terms: list[str]) -> dict[str, int]:
    """Number of texts with each of ``terms``, and of all texts under the empty term. At
    most one row for each term comes back."""
    present = F.array_intersect(F.split(F.lower("text"), "[^a-z0-9]+"),
                                F.array(*[F.lit(t) for t in terms]))
    rows = (files.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(
        present, F.expr("array()").cast("array<string>")))).alias("term"))
        .where(F.col("term").isin("", *terms)).groupBy("term").count().collect())
    return {r["term"]: r["count"] for r in rows}


class Index:
    """Unit vectors of the templates, by token."""

    def __init__(self, templates, df: dict[str, int]):
        total = df.get("", 0)
        terms = vocabulary(templates)
        self.unseen = math.log(1 + total) + 1
        self.idf = {t.encode(): math.log((1 + total) / (1 + min(df.get(t, 0), total))) + 1
                    for t in terms}
        self.names = [name for name, _ in templates]
        self.postings = defaultdict(list)
        for i, (_, text) in enumerate(templates):
            weights = {t: n * self.idf[t] for t, n in Counter(tokens(text)).items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            for t, w in weights.items():
                self.postings[t].append((i, w / norm))

    def best(self, counts: Counter) -> tuple[float, int]:
        """(cosine, template) of the nearest template, the first among equals."""
        known = other = 0.0
        weights = {}
        for t, n in counts.items():
            w = self.idf.get(t)
            if w is None:
                other += (n * self.unseen) ** 2
            else:
                weights[t] = n * w
                known += (n * w) ** 2
        # no cosine is above that of the part of the vector that any template shares
        if not known or known < THRESHOLD ** 2 * (known + other) * (1 - 1e-12):
            return 0.0, -1
        dots: dict = defaultdict(float)
        for t, w in weights.items():
            for i, v in self.postings[t]:
                dots[i] += w * v
        norm = math.sqrt(known + other)
        return max(((dot / norm, -i) for i, dot in dots.items()), default=(0.0, 1))

    def scan(self, text: bytes) -> tuple[str | None, float | None, str | None, int | None]:
        """(licence, score, "file" or "header", line) of a whole text."""
        whole: Counter = Counter()
        line_best = (0.0, 1, 0)
        for number, line in enumerate(text.split(b"\n")):
            counts = Counter(tokens(line))
            if not counts:
                continue
            whole.update(counts)
            score, minus = self.best(counts)
            line_best = max(line_best, (score, minus, -number))
        score, minus = self.best(whole)
        if score >= THRESHOLD:
            return self.names[-minus], score, "file", None
        score, minus, number = line_best
        if score >= THRESHOLD:
            return self.names[-minus], score, "header", -number
        return None, None, None, None


def own_licences(files: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``files`` (item, path, text) with licence, score, kind and line; text goes."""
    index = Index(templates, document_frequencies(files, vocabulary(templates)))

    def run(batches):
        for batch in batches:
            found = [index.scan(t.as_py() or b"") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("path"),
                 pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.string()),
                 pa.array([f[3] for f in found], pa.int64())],
                names=["item", "path", "licence", "score", "kind", "line"])

    item = files.schema["item"].dataType.simpleString()
    return files.select("item", "path", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"item {item}, path string, licence string, score double, kind string, line long")


def directory_of(path: Column) -> Column:
    """Everything before the last slash; the root is empty."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def directory_licences(files: DataFrame) -> DataFrame:
    """(directory, licence) of directories that declare one. Licence files that differ give
    the most frequent one, then the first by name; headers that differ give none."""
    by = files.where("licence is not null and path is not null").groupBy(
        directory_of(F.col("path")).alias("directory"), "kind", "licence").agg(
        F.count("*").alias("n"))
    best = F.min(F.when(F.col("kind") == "file", F.struct((-F.col("n")).alias("n"), "licence")))
    header = F.col("kind") == "header"
    return by.groupBy("directory").agg(
        best["licence"].alias("of_files"),
        F.when(F.count_distinct(F.when(header, F.col("licence"))) == 1,
               F.min(F.when(header, F.col("licence")))).alias("of_headers")).select(
        "directory", F.coalesce("of_files", "of_headers").alias("licence")).where(
        "licence is not null")


def scan(files: DataFrame, path: Column, text_col: str = "text",
         keep: list[str] | None = None, templates=TEMPLATES) -> DataFrame:
    """Every row of ``files`` (columns ``keep``, default all, under ``item``) with path,
    licence, origin ("file", "header" or "inherited"), score and line of its own match,
    and directory, the one that it inherits from.

    A null or empty text has no licence of its own; a null path has no directory and
    inherits nothing. Equal scores give the template listed first and the first line.
    Repeated rows are files of their own. An empty table gives an empty result; extra
    columns stay inside ``item``.
    """
    own = written(own_licences(files.select(under("item", files, keep), path.alias("path"),
                                            F.col(f"`{text_col}`").alias("text")), templates),
                  "licences")
    declared = written(directory_licences(own), "declared")
    # Directories, not files, are joined to their ancestors.
    parts = F.split("directory", "/")
    depth = F.explode(F.sequence(F.lit(0), F.when(F.col("directory") == "", 0).otherwise(
        F.size(parts)))).alias("depth")
    ancestors = (own.where("licence is null and path is not null")
                 .select(directory_of(F.col("path")).alias("directory")).distinct()
                 .select("directory", depth)
                 .withColumn("ancestor", F.array_join(F.slice(parts, 1, F.col("depth")), "/")))
    near = ancestors.join(declared.withColumnRenamed("directory", "ancestor"), "ancestor").groupBy(
        "directory").agg(F.max_by(F.struct("ancestor", "licence"), "depth").alias("from"))
    joined = own.withColumn("directory", F.when(F.col("licence").isNull(), directory_of(
        F.col("path")))).join(near, "directory", "left")
    return joined.select(
        "item", "path", F.coalesce("licence", F.col("from.licence")).alias("licence"),
        F.coalesce("kind", F.when(F.col("from").isNotNull(), F.lit("inherited"))).alias("origin"),
        "score", "line", F.col("from.ancestor").alias("directory"))
