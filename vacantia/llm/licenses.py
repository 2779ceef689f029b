"""License scans: TF-IDF cosine of lines to templates, then inheritance down directories.

Every line of every text is a sparse TF-IDF vector (document frequencies of all words over
the whole corpus; only those of the templates' words reach the tasks whole, the others are
joined to the words of lines that can be license lines). Its cosine to the closest template of at least ``LEAST`` makes it a license line.
The best one licenses its own file. A file named like a license file, or of whose words
license lines make up ``FILE_SHARE`` or more, licenses its directory too. A file without a
license line takes the license of the nearest directory above it that has one.

Ties go to the smaller license name, between lines to the first, between license files of
a directory to the higher cosine. Defined cases: a null or empty text has no lines and only
inherits; a null path is the top directory; repeated rows get equal results; in an empty
corpus nothing is returned.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.llm.arrays import Words, parts, sums, unique_pairs
from vacantia.llm.contamination import lower_words, member
from vacantia.session import cut_lineage

LEAST = 0.6
FILE_SHARE = 0.25
FILE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"
PART_BYTES = 4 << 20
BAG = ["own", "product", "norm", "words", "times"]  # what the cosine of a line depends on

# License names and the sentences by which files refer to them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause license."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0)."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def frequencies(docs: DataFrame) -> DataFrame:
    """In how many texts each word is: ``word`` (hash) and ``n``."""

    def count(batches):
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                words = lower_words(part.column("text"))
                word, _ = unique_pairs(words.hash, words.text)
                word, n = np.unique(word, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Scorer:
    """Templates as unit vectors, and the weights of their words."""

    def __init__(self, words: Words, names: list[str], seen: dict[int, int], texts: int):
        self.vocabulary, at = np.unique(words.hash, return_inverse=True)
        self.names = names
        n = np.array([seen.get(w, 0) for w in self.vocabulary.view(np.int64).tolist()])
        self.weight = np.log((texts + 1) / (n + 1)) + 1
        matrix = np.zeros((len(names), len(self.vocabulary)))
        np.add.at(matrix, (words.text, at), self.weight[at])
        self.matrix = matrix / np.linalg.norm(matrix, axis=1)[:, None]

    def lines(self, words: Words, least: float) -> tuple:
        """Lines that can be license lines, with what their cosine needs.

        Text, template, product with it, square of the norm over the templates' words, words
        of the line; and for each other word of these lines its line here, hash and times.
        Other words count at their least weight, 1, so no license line is missing.
        """
        breaks = np.r_[0, np.cumsum(words.buf == 0x0A)]
        line = breaks[words.start] + words.text
        n = int(breaks[-1]) + len(words.bounds)
        known, at = member(words.hash, self.vocabulary)
        weight = np.where(known, self.weight[at], 1.0)
        some, column = np.flatnonzero(known), at[known]
        low = np.sqrt(sums(line, weight * weight, n))  # of the norm: no word counted twice
        best, which = np.zeros(n), np.zeros(n, np.int64)
        for t in range(len(self.names)):
            dot = sums(line[some], weight[some] * self.matrix[t][column], n)
            better = dot > best
            best[better], which[better] = dot[better], t
        may = np.flatnonzero((low > 0) & (best >= least * low * (1 - 1e-9)))
        # Words of the few lines that can reach the bound, with how often they stand there.
        take = np.flatnonzero(np.isin(line, may))
        order = take[np.lexsort((words.hash[take], line[take]))]
        new = np.ones(len(order), bool)
        new[1:] = (line[order][1:] != line[order][:-1]) | (words.hash[order][1:] != words.hash[order][:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.r_[first, len(order)])
        word = order[first]
        square = (times * weight[word]) ** 2
        norm = sums(line[word], np.where(known[word], square, 0.0), n)
        may = may[best[may] >= least * np.sqrt(sums(line[word], square, n)[may]) * (1 - 1e-9)]
        other = ~known[word] & np.isin(line[word], may)
        size = np.bincount(line, minlength=n)[may]
        text = words.text[np.searchsorted(line, may)]
        at = np.searchsorted(may, line[word][other])
        return text, which[may], best[may], norm[may], size, at, words.hash[word][other], times[other]


def scorer(seen: DataFrame, texts: int, templates: list[tuple[str, str]]) -> Scorer:
    words = lower_words(pa.array([t for _, t in templates], pa.string()))
    # A few hundred rows, one for each word of the templates.
    named = seen.filter(F.col("word").isin(np.unique(words.hash).view(np.int64).tolist()))
    return Scorer(words, [n for n, _ in templates], dict(map(tuple, named.collect())), texts)


def ragged(values: np.ndarray | pa.Array, of: np.ndarray, n: int) -> pa.ListArray:
    """Lists of the values of each of ``n`` owners; ``of`` is in order."""
    kind = pa.array(values, pa.int64()) if isinstance(values, np.ndarray) else values
    return pa.ListArray.from_arrays(np.searchsorted(of, np.arange(n + 1)).astype(np.int32), kind)


def cosines(lines: DataFrame, seen: DataFrame, texts: int, least: float) -> DataFrame:
    """Cosine of each different line that reaches ``least``, all words at their real weights.

    Equal lines are one row here, so a line that stands in many texts is weighed once.
    """
    bags = cut_lineage(lines.select(*BAG).distinct()).withColumn("bag", F.monotonically_increasing_id())
    words = bags.select("bag", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "bag", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    weight = F.log((F.lit(texts) + 1) / (F.col("n") + 1)) + 1
    squares = words.join(seen, "word").groupBy("bag").agg(
        # In a fixed order, so that the last digit is too; no more than the words of a line.
        F.aggregate(F.sort_array(F.collect_list(F.pow(F.col("times") * weight, 2.0))), F.lit(0.0), lambda a, x: a + x).alias("rest")
    )
    cosine = F.col("product") / F.sqrt(F.col("norm") + F.coalesce("rest", F.lit(0.0)))
    return bags.join(squares, "bag", "left").select(*BAG, cosine.alias("cosine")).filter(F.col("cosine") >= least).select(
        *BAG, F.round("cosine", 9).alias("cosine")
    )


def directory(path: Column) -> Column:
    """What is before the last slash; the top directory is ''."""
    return F.regexp_extract(F.coalesce(path, F.lit("")), r"^(.*)/[^/]*$", 1)


def licenses(
    docs: DataFrame, path: Column, *, templates: list[tuple[str, str]] = TEMPLATES,
    least: float = LEAST, file_share: float = FILE_SHARE,
) -> DataFrame:
    """One row per document: license, cosine, origin (own, inherited, none) and its directory."""
    docs = docs.select("doc_id", "text", path.alias("path"))
    seen = cut_lineage(frequencies(docs))
    texts = docs.count()
    shared = docs.sparkSession.sparkContext.broadcast(scorer(seen, texts, templates))

    def scan(batches):
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                words = lower_words(part.column("text"))
                text, which, product, norm, size, at, word, times = shared.value.lines(words, least)
                lines = pa.StructArray.from_arrays(
                    [
                        pa.array(np.array(shared.value.names, object)[which], pa.string()), pa.array(product, pa.float64()), pa.array(norm, pa.float64()),
                        pa.array(size, pa.int64()), ragged(word.view(np.int64), at, len(text)), ragged(times, at, len(text)),
                    ],
                    ["own", "product", "norm", "size", "words", "times"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()), part.column("path"), pa.array(words.counts()),
                        ragged(lines, text, part.num_rows),
                    ],
                    ["doc_id", "path", "n_words", "lines"],
                )

    line = "own string, product double, norm double, size long, words array<long>, times array<long>"
    # Without the texts; the row numbers hold because the rows are written.
    scanned = cut_lineage(
        docs.mapInArrow(scan, f"doc_id long, path string, n_words long, lines array<struct<{line}>>")
    ).withColumn("row", F.monotonically_increasing_id())
    lines = scanned.select("row", F.explode("lines").alias("line")).select("row", "line.*")
    best = lines.join(cosines(lines, seen, texts, least), BAG).groupBy("row").agg(
        F.min(F.struct((-F.col("cosine")).alias("less"), "own")).alias("best"), F.sum("size").alias("size")
    )
    share = F.coalesce("size", F.lit(0)) / F.greatest("n_words", F.lit(1))
    found = scanned.drop("lines").join(best, "row", "left").select(
        "doc_id", "path", "best.own", (-F.col("best.less")).alias("score"), share.alias("share")
    )
    found = found.withColumn("directory", directory(F.col("path")))
    base = F.regexp_extract(F.coalesce("path", F.lit("")), r"([^/]*)$", 1)
    files = found.filter("own IS NOT NULL").filter((F.col("share") >= file_share) | base.rlike(FILE_NAME))
    by_directory = files.groupBy(F.col("directory").alias("above")).agg(
        F.min(F.struct((-F.col("score")).alias("less"), "own")).alias("best")
    )
    # Inheritance is settled once per directory, whatever number of files it holds.
    names = F.split("directory", "/")
    above = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.size(names)),
            lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(names, F.lit(1), k), "/").alias("above")),
        )
    )
    nearest = (
        found.select("directory").distinct().withColumn("up", above)
        .select("directory", "up.depth", "up.above").join(by_directory, "above")
        .groupBy("directory").agg(F.max(F.struct("depth", "above", "best")).alias("from"))
    )
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("from").isNotNull(), "inherited").otherwise("none")
    return found.join(nearest, "directory", "left").select(
        "doc_id", F.coalesce("own", "from.best.own").alias("license"),
        F.coalesce("score", -F.col("from.best.less")).alias("cosine"), origin.alias("origin"), "directory",
        F.when(F.col("own").isNull(), F.col("from.above")).alias("inherited_from"),
    )
