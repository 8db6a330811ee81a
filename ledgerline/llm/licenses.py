"""Licence scan: sparse TF-IDF cosine to templates, then inheritance by path.

Segments are a file's lines (headers) and its whole text (licence files).
Their term vectors are compared with the templates' by cosine. Document
frequencies are those of the template terms over all lines of the corpus; a
term that no template holds weighs as much as an unseen one. A file without a
licence of its own inherits that of the nearest ancestor directory that holds a
licence file: directories are resolved once each, by a join with their
ancestors' paths, and files join their directory's result.

All steps are DataFrame or SQL functions. Only the frequencies of the template
terms (a fixed list) reach the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

# fixed values: public licence notices
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-Clause license."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
)
#: Words too frequent to tell anything; ignored on both sides.
STOP = ("a", "an", "and", "are", "as", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that",
        "the", "this", "to", "under", "with")
SPLIT = r"[^\p{L}\p{N}]+"
#: Least cosine of a header line, and of a whole text that is a licence file.
HEADER, FILE = 0.7, 0.9
FILE_NAMES = r"(?i)^(licen[sc]e|copying|notice|unlicense)([._-].*)?$"


def terms(text: str) -> list[str]:
    return [t for t in re.split(r"[\W_]+", text.lower()) if t and t not in STOP]


VOCABULARY = sorted({t for _, text in TEMPLATES for t in terms(text)})


def _words(text: Column) -> Column:
    return F.split(F.lower(text), SPLIT)


def _table(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small fixed table (template terms only) as an inline literal."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def segments(files: DataFrame) -> DataFrame:
    """(path, line, terms, hits) of lines (from 0) and the whole text (-1) that
    hold a template term; other segments cannot resemble a template."""
    vocabulary = F.array(*map(F.lit, VOCABULARY))
    lines = F.transform(F.split(F.col("text"), "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("t")))
    every = F.concat(F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("t"))), lines)
    return (files.where(F.arrays_overlap(_words(F.col("text")), vocabulary))
            .select("path", F.explode(every).alias("s"))
            .select("path", "s.line", F.filter(_words(F.col("s.t")), lambda t: (t != "") & ~t.isin(*STOP)).alias("terms"))
            .where(F.arrays_overlap("terms", vocabulary))
            .withColumn("hits", F.filter("terms", lambda t: t.isin(*VOCABULARY))))


def best_template(segs: DataFrame, idf: dict[str, float], unseen: float, least: float) -> DataFrame:
    """(path, line, score, license) of segments with a cosine of ``least`` or
    more; ties go to the alphabetically last licence."""
    spark = segs.sparkSession
    vectors = []
    for k, (name, text) in enumerate(TEMPLATES):
        w = {t: n * idf[t] for t, n in Counter(terms(text)).items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        vectors += [(t, k, name, x / norm) for t, x in w.items()]
    # a term not in the templates weighs ``unseen``, one in them no more, so a
    # segment with more other terms than this cannot reach ``least``
    others = F.size("terms") - F.size("hits")
    segs = segs.where(others <= (1 / least ** 2 - 1) * F.pow(F.size("hits"), F.lit(2)) + 1e-9)
    tf = (segs.select("id", "path", "line", F.explode("terms").alias("term"))
          .groupBy("id", "path", "line", "term").agg(F.count("*").alias("n")))
    weights = _table(spark, [(t, w) for t, w in idf.items()], ["term", "idf"])
    tf = (tf.join(F.broadcast(weights), "term", "left")
          .withColumn("w", F.col("n") * F.coalesce("idf", F.lit(unseen))))
    norms = tf.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (tf.join(F.broadcast(_table(spark, vectors, ["term", "k", "license", "v"])), "term")
            .groupBy("id", "path", "line", "k", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot")))
    return (dots.join(norms, "id").groupBy("id", "path", "line")
            .agg(F.max(F.struct((F.col("dot") / F.col("norm")).alias("score"), "license")).alias("b"))
            .select("path", "line", "b.score", "b.license").where(F.col("score") >= least))


def scan_licenses(files: DataFrame) -> DataFrame:
    """path, license, score, basis, origin of every distinct path of ``files``
    (path, text). basis: ``file`` (the whole text is a licence, or the file is
    named like one and a line matches), ``header`` (its best line matches),
    ``inherited`` (origin: the directory), or null with no licence.

    Null texts match nothing and can inherit. A path that repeats is one file
    with all its texts. A null path is one file without a directory. Ties go to the
    higher score, then the alphabetically last licence. Empty input: no rows."""
    scratch = Scratch(files.sparkSession, "licenses")
    files = files.select("path", "text")
    segs = scratch.save(segments(files).withColumn("id", F.monotonically_increasing_id()))
    total = files.agg(F.sum(F.size(F.split("text", "\n")).cast("long"))).first()[0] or 0
    df = dict(segs.where("line >= 0").select(F.explode(F.array_distinct("hits")).alias("t"))
              .groupBy("t").count().collect())                       # template terms only
    idf = {t: math.log((total + 1) / (df.get(t, 0) + 1)) + 1 for t in VOCABULARY}
    found = best_template(segs, idf, math.log(total + 1) + 1, HEADER)
    named = F.regexp_extract("path", r"([^/]*)$", 1).rlike(FILE_NAMES)
    is_file = ((F.col("line") == -1) & (F.col("score") >= FILE)) | ((F.col("line") >= 0) & named)
    own = scratch.save(found.where(is_file | (F.col("line") >= 0)).groupBy("path").agg(
        F.max(F.struct(is_file.alias("is_file"), "score", "license")).alias("b"))
        .select("path", "b.is_file", "b.score", "b.license"))
    parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    holders = (own.where("is_file").withColumn("dir", parent).groupBy("dir")
               .agg(F.max(F.struct("score", "license")).alias("b")).select("dir", "b.license"))
    paths = files.select("path").distinct().withColumn("dir", parent)
    ups = (paths.where("dir is not null").select(F.col("dir").alias("from")).distinct()
           .withColumn("parts", F.split("from", "/"))
           .withColumn("n", F.explode(F.sequence(F.lit(0), F.size("parts"))))
           .withColumn("dir", F.concat_ws("/", F.slice("parts", F.lit(1), F.col("n")))).drop("parts"))
    near = (ups.join(holders, "dir").groupBy("from")
            .agg(F.max(F.struct("n", "dir", "license")).alias("b"))
            .select("from", F.col("b.dir").alias("origin"), F.col("b.license").alias("inherited")))
    o = own.select(F.col("path").alias("__p"), "is_file", "score", "license")
    out = (paths.join(o, F.col("path") == F.col("__p"), "left").join(near, F.col("dir") == F.col("from"), "left"))
    has = F.col("license").isNotNull()
    return out.select(
        "path", F.coalesce("license", "inherited").alias("license"), "score",
        F.when(F.col("is_file"), "file").when(has, "header").when(F.col("inherited").isNotNull(), "inherited").alias("basis"),
        F.when(~has, F.col("origin")).alias("origin"))


def op5(docs: DataFrame) -> DataFrame:
    """Documents as files source/lang/doc_id; one row per document row."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")),
                       F.coalesce(F.col("doc_id").cast("string"), F.lit("_")))
    found = scan_licenses(docs.select(path.alias("path"), "text"))
    rows = docs.select("doc_id", path.alias("__path"))
    return rows.join(found, F.col("__path") == F.col("path")).drop("__path")
