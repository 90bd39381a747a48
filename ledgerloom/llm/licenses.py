"""Licence scan: TF-IDF cosine of headers and licence files to templates, and inheritance from directories.

Method. Where a term of a text is an anchor, a rare term that each header has (licensed, permission, ...), the text is laid under every header that has this anchor, so that the two anchors
meet: a window of as many terms as the header has. Windows of several anchors and headers overlap freely, and a header is found whatever stands before and after it. Besides, files that are named
like licence files are compared whole with the texts of licences. Windows and whole files are sparse vectors, weighted by term frequency and inverse document frequency
over the templates, terms of no template included; the template of greatest cosine names the licence if it reaches `THRESHOLD`. A file without a licence of its own inherits that of the licence
file in the nearest directory above it.

All is DataFrame expressions. Only windows and the terms of licence files are exploded, and meet the templates, some hundred rows, by join. Directories are made distinct before
their ancestors are looked up, so a directory with a third of all files is looked up once; the join back to files may be split.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import write_shared

THRESHOLD = 0.7
TERM = r"[a-z0-9]+(?:\.[0-9]+)?"
#: Terms that windows are laid out around; every header has one. Licence and license are one word.
ANCHORS = ("license", "licensed", "permission", "unencumbered")
#: Texts without any of this have no header, and are no licence.
CUE = r"(?i)licen[cs]e|permission|unencumbered|redistribution"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)(\.[a-z]+)?$"

# Usual header lines of each licence, by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Texts of licences that are whole files, or what their files begin with, by SPDX identifier.
LICENCE_TEXTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
            "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
            "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
            "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
            "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
            "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source "
                     "code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
                     "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
                     "holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS "
                     "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
                     "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                  "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of "
                  "this software dedicate any and all copyright interest in the software to the public domain."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007. This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but "
                "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
)


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.replace(F.lower(text), F.lit("licence"), F.lit("license")), F.lit(f"({TERM})"), F.lit(1))


def template_terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower().replace("licence", "license"))


def anchor_places(templates=TEMPLATES) -> list[tuple[str, int, int, int]]:
    """(anchor, template, its place in the template from 1 on, the template's length)."""
    listed = [template_terms(text) for _, text in templates]
    return [(t, n, i + 1, len(own)) for n, own in enumerate(listed) for i, t in enumerate(own) if t in ANCHORS]


def template_vectors(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, license, term, idf, weight): weight is the term's share of a unit vector."""
    rows = spark.createDataFrame([(n, *t) for n, t in enumerate(templates)], "template int, license string, text string")
    counted = rows.select("template", "license", F.explode(terms(F.col("text"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    by_term = Window.partitionBy("term")
    idf = F.log(F.lit(float(len(templates) + 1)) / (F.count("*").over(by_term) + 1)) + 1
    weighed = counted.withColumn("idf", idf).withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("template")))
    return weighed.select("template", "license", "term", "idf", (F.col("w") / norm).alias("weight"))


def header_windows(words: Column) -> Column:
    """Array of (template, body): the terms of a text under each header that has the anchor found there."""
    places = F.array(*[F.struct(F.lit(a).alias("anchor"), F.lit(n).alias("template"), F.lit(i).alias("place"), F.lit(size).alias("size")) for a, n, i, size in anchor_places()])
    at = F.filter(F.transform(words, lambda t, i: F.when(t.isin(*ANCHORS), F.struct(i.alias("at"), t.alias("term")))), lambda x: x.isNotNull())

    def under(hit):
        def window(p):
            begin = hit["at"] + 2 - p["place"]  # of the window, from 1 on; the text may begin later
            first = F.greatest(begin, F.lit(1))
            return F.struct(p["template"].alias("template"), F.slice(words, first, begin + p["size"] - first).alias("body"))

        return F.transform(F.filter(places, lambda p: p["anchor"] == hit["term"]), window)

    return F.flatten(F.transform(at, under))


def _scores(bodies: DataFrame, vectors: DataFrame, templates: int) -> DataFrame:
    """The best (cosine, license) for each `row` of bodies (row, window, template, body), each held against its template, or against all where that is null."""
    counted = bodies.select("row", "window", "template", F.explode("body").alias("term")).groupBy("row", "window", "template", "term").agg(F.count("*").alias("tf"))
    vocabulary = vectors.select("term", "idf").distinct()
    unknown = F.log(F.lit(float(templates + 1))) + 1  # of a term in no template
    weighed = counted.join(vocabulary, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", unknown))
    norms = weighed.groupBy("row", "window").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    known, v = weighed.where("idf is not null").alias("b"), vectors.alias("v")
    of_own = F.coalesce(F.col("b.template") == F.col("v.template"), F.lit(True))
    dots = known.join(v, (F.col("b.term") == F.col("v.term")) & of_own).groupBy("b.row", "b.window", "v.template", "v.license").agg(F.sum(F.col("b.w") * F.col("v.weight")).alias("dot"))
    cosines = dots.join(norms, ["row", "window"]).select("row", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))
    best = cosines.where(F.col("cosine") >= THRESHOLD).groupBy("row").agg(F.min(F.struct(-F.col("cosine"), F.col("license"))).alias("best"))
    return best.select("row", (-F.col("best.col1")).alias("cosine"), "best.license")


def is_licence_file(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1).rlike(LICENCE_FILE)


def parent(path: Column) -> Column:
    """The directory a path lies in; the topmost is empty."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def directory_licences(own: DataFrame, files: DataFrame) -> DataFrame:
    """(directory, inherited, from_directory) for each directory of `files` that has a licence file in it or above it.

    Of several licence files in one directory that with the greatest cosine counts, then the first by name.
    """
    given = (own.where(is_licence_file(F.col("path")) & F.col("license").isNotNull()).groupBy(parent(F.col("path")).alias("above"))
             .agg(F.min(F.struct(-F.col("cosine"), F.col("license"))).alias("best")).select("above", F.col("best.license").alias("inherited")))
    directories = files.where("path is not null").select(parent(F.col("path")).alias("directory")).distinct()
    parts = F.split("directory", "/")
    above = F.when(F.col("directory") == "", F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))
    reached = directories.select("directory", F.posexplode(above).alias("depth", "above")).join(given, "above")
    nearest = reached.groupBy("directory").agg(F.max(F.struct("depth", "above", "inherited")).alias("near"))
    return nearest.select("directory", "near.inherited", F.col("near.above").alias("from_directory"))


def scan_licences(files: DataFrame, text: str = "text", key: str = "doc_id", path: str = "path") -> DataFrame:
    """One row per row of `files`: doc_id, license, cosine, origin (`own`, `inherited` or null), from_directory.

    Null and empty texts have no licence of their own; a null path inherits nothing. Leading `/` and `./` do not count. Rows that repeat an id and path
    have the best licence of them all. Texts of any length are read whole. Other columns are not read. An empty table gives an empty result.
    """
    spark = files.sparkSession
    headers, whole = (write_shared(template_vectors(spark, t), "licence-templates") for t in (TEMPLATES, LICENCE_TEXTS))
    clean = F.regexp_replace(F.col(path), r"^(\./|/)+", "")
    slim = files.select(F.col(key).alias("doc_id"), clean.alias("path"), F.col(text).alias("body"))
    words = terms(F.col("body"))
    file = F.when(is_licence_file(F.col("path")), F.array(F.struct(F.lit(None).cast("int").alias("template"), words.alias("body"))))
    windows = slim.where(F.col("body").rlike(CUE)).select(
        F.struct("doc_id", "path").alias("row"), F.posexplode(F.concat(header_windows(words), F.coalesce(file, F.array().cast("array<struct<template:int,body:array<string>>>")))).alias("window", "w"))
    windows = write_shared(windows.select("row", "window", "w.template", "w.body"), "licence-windows")  # the texts are searched once
    scores = _scores(windows.where("template is not null"), headers, len(TEMPLATES)).unionByName(_scores(windows.where("template is null"), whole, len(LICENCE_TEXTS)))
    best = scores.groupBy("row").agg(F.min(F.struct(-F.col("cosine"), F.col("license"))).alias("best"))
    found = write_shared(best.select("row.doc_id", "row.path", (-F.col("best.col1")).alias("cosine"), "best.license"), "licence-own")
    paths = slim.select("doc_id", "path")
    inherited = write_shared(directory_licences(found, paths), "licence-directories")
    f, d = found.alias("f"), inherited.alias("d")
    same = F.col("p.doc_id").eqNullSafe(F.col("f.doc_id")) & F.col("p.path").eqNullSafe(F.col("f.path"))
    joined = paths.alias("p").join(f, same, "left").join(d, parent(F.col("p.path")) == F.col("d.directory"), "left")
    own = F.col("f.license").isNotNull()
    return joined.select("p.doc_id", F.coalesce("f.license", "d.inherited").alias("license"), F.col("f.cosine").alias("cosine"),
                         F.when(own, "own").when(F.col("d.inherited").isNotNull(), "inherited").alias("origin"),
                         F.when(~own, F.col("d.from_directory")).alias("from_directory"))
