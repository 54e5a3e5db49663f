"""Licences of files: sparse TF-IDF cosine of their text to templates, then inheritance along directories.

Every line of a text is a possible notice, as is every run of lines up to twice the
longest template (headers are wrapped over lines), and the text as a whole is a possible
licence file; a file named like one (LICENSE, COPYING, NOTICE) is one if it holds a notice. All become sparse vectors of term frequency times inverse document frequency, the
latter counted over all documents; terms that no template uses only lengthen a
vector and count as never seen. A file without a notice of its own takes the licence
of the nearest directory above it that holds a licence file: distinct directories are
joined with licensed ones on each of their ancestor paths, and files join on
their directory last.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.session import settle

TERM = re.compile("[a-z0-9]+")
_FOLD = {c: c + 32 for c in range(65, 91)}
NOTICE_SCORE = 0.8
FILE_SCORE = 0.4
# Names of licence files: a notice in one holds for its directory.
FILE_NAMES = "(?i)^(licen[cs]e|copying|notice)([.-].*)?$"

# Notices of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
)


def terms(text: str) -> list[str]:
    """Runs of letters a-z and digits, A-Z folded."""
    return TERM.findall(text.translate(_FOLD))


class Scorer:
    """Cosine of term counts to the templates, given document frequencies of their terms."""

    def __init__(self, templates, frequency: dict[str, int], documents: int):
        self.unseen = log(documents + 1) + 1
        self.idf = {t: log((documents + 1) / (n + 1)) + 1 for t, n in frequency.items()}
        self.by_term: dict[str, list[tuple[int, float]]] = {}
        self.names, self.norms = [], []
        self.longest = max((len(terms(text)) for _, text in templates), default=0)
        for k, (name, text) in enumerate(templates):
            weights = {t: n * self.idf.get(t, self.unseen) for t, n in Counter(terms(text)).items()}
            self.names.append(name)
            self.norms.append(sqrt(sum(w * w for w in weights.values())))
            for t, w in weights.items():
                self.by_term.setdefault(t, []).append((k, w))

    def best(self, counts: Counter) -> tuple[float, str] | None:
        """(score, licence) of the nearest template; equal scores go to the first name."""
        dots: dict[int, float] = {}
        for term in counts.keys() & self.by_term.keys():
            own = counts[term] * self.idf.get(term, self.unseen)
            for k, weight in self.by_term[term]:
                dots[k] = dots.get(k, 0.0) + own * weight
        if not dots:
            return None
        norm = sqrt(sum((n * self.idf.get(t, self.unseen)) ** 2 for t, n in counts.items()))
        return min((-dot / (norm * self.norms[k]), self.names[k]) for k, dot in dots.items())

    def masses(self, counts: Counter) -> tuple[float, float]:
        """Length of the part of a vector that templates share terms with, and squared length of the rest."""
        inside = outside = 0.0
        for term, n in counts.items():
            if term in self.by_term:
                inside += (n * self.idf.get(term, self.unseen)) ** 2
            else:
                outside += n * n
        return sqrt(inside), outside * self.unseen**2

    def notice(self, lines: list[Counter], least: float) -> tuple[float, str] | None:
        """(-score, licence) of the nearest line or run of lines, if its score may reach ``least``.

        Lines without terms are passed over. A score is at most the cosine between a vector and
        its part inside the vocabulary; of a run, that part is no longer than those of
        its lines together and the squared rest no shorter, so most runs need no count.
        """
        lines = [counts for counts in lines if counts]
        masses = [self.masses(counts) for counts in lines]
        sizes = [counts.total() for counts in lines]
        floor = max(least, 0.0) ** 2
        may = lambda inside, outside: inside * inside >= floor * (inside * inside + outside) * (1 - 1e-9)
        best = None
        for counts, mass in zip(lines, masses):
            if may(*mass) and (found := self.best(counts)) and (best is None or found < best):
                best = found
        for start, (inside, outside) in enumerate(masses):
            # A run that begins or ends with a line no template shares a term with is better without that line.
            if not inside:
                continue
            size, merged, taken = sizes[start], Counter(lines[start]), start + 1
            for end in range(start + 1, len(lines)):
                size += sizes[end]
                if size > 2 * self.longest:
                    break
                inside, outside = inside + masses[end][0], outside + masses[end][1]
                if not masses[end][0] or not may(inside, outside):
                    continue
                for counts in lines[taken : end + 1]:
                    merged.update(counts)
                taken = end + 1
                # Of equal scores, which rounding parts, a single line is the notice.
                if (found := self.best(merged)) and (best is None or found[0] < best[0] - 1e-9):
                    best = found
        return best


def _frequencies(rows: DataFrame, templates) -> tuple[dict[str, int], int]:
    """Document frequency of each template term, and the number of documents with a text."""
    vocabulary = sorted({t for _, text in templates for t in terms(text)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                if (value := text.as_py()) is not None:
                    found[""] += 1
                    found.update(wanted.intersection(terms(value)))
        yield pa.RecordBatch.from_pydict({"term": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

    wanted = frozenset(vocabulary)
    sums = rows.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # At most one row per template term.
    found = {r["term"]: r["n"] for r in sums.collect()}
    return {t: found.get(t, 0) for t in vocabulary}, found.get("", 0)


def scan(
    files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
    templates=TEMPLATES, notice_score: float = NOTICE_SCORE, file_score: float = FILE_SCORE,
) -> DataFrame:
    """Per file: ``id_col``, ``path``, ``licence``, ``how`` ("notice", "inherited" or null), ``score`` and ``source_path``.

    Runs of lines with more than twice the terms of the longest template are not tried.
    A notice is the line or run of lines nearest to a template if its cosine reaches ``notice_score``; a
    file whose whole text reaches ``file_score``, or that has a notice and a name like LICENSE, COPYING or NOTICE (any
    ending), is its directory's licence file. Several in
    one directory: the highest score, then the smallest id. ``source_path`` is the file
    itself or the directory a licence is taken from; inherited ones carry the licence file's score.

    Null or empty text: no notice, may inherit. Null path: no directory, neither gives nor
    takes. Null ids and repeated rows are kept as they are; other columns are not read.
    An empty table gives no rows.
    """
    rows = files.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{path_col}`").cast("string").alias("path"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    scorer = Scorer(templates, *_frequencies(rows, templates))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            notices, wholes = [], []
            for text in batch.column("text"):
                lines, whole = [Counter(terms(line)) for line in (text.as_py() or "").split("\n")], Counter()
                for counts in lines:
                    whole.update(counts)
                notices.append(scorer.notice(lines, notice_score))
                wholes.append(scorer.best(whole))
            column = lambda items, k, kind: pa.array([x and (-x[0] if k == 0 else x[1]) for x in items], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("path"), column(notices, 0, pa.float64()), column(notices, 1, pa.string()),
                 column(wholes, 0, pa.float64()), column(wholes, 1, pa.string())],
                names=["id", "path", "score", "licence", "file_score", "file_licence"],
            )

    scored = settle(rows.mapInArrow(
        score, "id long, path string, score double, licence string, file_score double, file_licence string"
    )).withColumn("folder", F.regexp_replace("path", "/?[^/]*$", ""))
    noticed = F.coalesce(F.col("score") >= notice_score, F.lit(False))
    # Settled, here and below: joins of plain sides are broadcast by size or split a hot directory.
    whole = F.coalesce(F.col("file_score") >= file_score, F.lit(False))
    named = noticed & F.regexp_substr("path", F.lit("[^/]*$")).rlike(FILE_NAMES)
    givers = scored.filter((whole | named) & F.col("path").isNotNull()).select(
        "folder", "id", F.when(whole, F.col("file_score")).otherwise(F.col("score")).alias("gives"),
        F.when(whole, F.col("file_licence")).otherwise(F.col("licence")).alias("licence"),
    )
    given = givers.groupBy("folder").agg(F.min(F.struct((-F.col("gives")).alias("down"), "id", "licence")).alias("best")).select(
        F.col("folder").alias("above"), F.col("best.licence").alias("taken"), (-F.col("best.down")).alias("taken_score")
    )
    given = settle(given)
    # Each directory that needs a licence once, with all directories above it and itself.
    needy = scored.filter(~noticed & F.col("path").isNotNull()).select("folder").distinct()
    parts = F.split("folder", "/")
    above = needy.select("folder", F.explode(F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(F.split("folder", "/"), 1, n), "/").alias("above"))
    )).alias("up")).select("folder", "up.*")
    # Depth 0 is the root, the empty path; a folder at the root names it once more at depth 1.
    nearest = above.join(given, "above").groupBy("folder").agg(
        F.max(F.struct("depth", "above", "taken", "taken_score")).alias("near")
    ).select("folder", "near.above", "near.taken", "near.taken_score")
    nearest = settle(nearest)
    joined = scored.join(nearest, "folder", "left")
    inherited = ~noticed & F.col("taken").isNotNull() & F.col("path").isNotNull()
    pick = lambda own, other: F.when(noticed, own).when(inherited, other)
    return joined.select(
        F.col("id").alias(id_col), "path", pick(F.col("licence"), F.col("taken")).alias("licence"),
        pick(F.lit("notice"), F.lit("inherited")).alias("how"), pick(F.col("score"), F.col("taken_score")).alias("score"),
        pick(F.col("path"), F.col("above")).alias("source_path"),
    )
