"""Licenses of files: sparse TF-IDF cosine to templates, then the nearest ancestor directory's.

A file's notices are those of its sentences that speak of licenses, cut from its lines and also from its blocks:
consecutive lines, up to a blank one or the end of a comment, joined without their comment marks. A licence file's
whole text is one more.
Each is a sparse vector of words, weighted by the templates' inverse document frequencies, and
takes the template of largest cosine if that reaches ``LEAST_COSINE``. A file keeps the best of its
notices. A file without one inherits from the nearest directory at or above its own that holds a licence
file; of several there the one of least path counts.

Directories inherit once, before files do, so a directory with a third of all files is one row on one side of
an ordinary join. Texts themselves are never shuffled.

Null paths and texts are empty; an empty path lies in the root. Rows that repeat path and text give one row.
An empty table gives an empty table. Ties go to the license first in order.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import broadcast_if_small, staged

# Public notices, the usual short forms and the standard headers.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products."),
    ("BSD-2-Clause", "Released under the 2-Clause BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# Identifiers of the public list that headers state by themselves.
IDENTIFIERS = [
    "0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "BUSL-1.1", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib",
]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}{more}") for name in IDENTIFIERS for more in (["-only", "-or-later"] if "GPL" in name else [""])]
LEAST_COSINE = 0.6
WORD = r"[a-z0-9.]*[a-z0-9]"
#: Sentences that are looked at, and names of licence files.
HINT = r"(?i)licen[cs]e|copyright|spdx|public domain|free software|redistribut|hereby granted"
LICENSE_FILE = r"(?i)(?:\A|/)(?:licen[cs]e|copying|notice|unlicense)(?:[.-][^/]*)?\z"
SENTENCE = r"(?<=[.!?])\s+|\n"
#: Texts that are looked at: a notice may be wrapped anywhere.
HINT_OF_TEXT = HINT.replace(" ", r"\W+")
#: Ends of comments, line comments, what lies between blocks, and a line's end with the next line's comment mark.
COMMENT_END = r"""\*/|-->|\"{3}|'{3}"""
LINE_COMMENT = r"[ \t]*(?:#|//|;|--|%|(?i:rem|dnl)\b)"
COMMENT_EDGE = rf"(?md)^(?:({LINE_COMMENT}[^\n]*)\n(?!{LINE_COMMENT})|((?!{LINE_COMMENT})[^\n]*)\n(?={LINE_COMMENT}))"
BETWEEN_BLOCKS = r"\n[\s#*/;%<>!=-]*\n"
WRAP = r"[ \t\r]*\n[ \t]*(?:[#*;%>!|]+|//+!?|--+|(?i:rem|dnl)\b)?[ \t]*"
#: Directories with a license (200 bytes each) sent to every executor; more are shuffled.
BROADCAST_DIRECTORIES = 300_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _wrapped(text: Column) -> Column:
    """The sentences of a text's blocks."""
    apart = F.regexp_replace(F.regexp_replace(text, COMMENT_END, "\n\n"), COMMENT_EDGE, "$1$2\n\n")
    blocks = F.filter(F.split(apart, BETWEEN_BLOCKS, -1), lambda b: b.rlike(HINT_OF_TEXT))
    return F.flatten(F.transform(blocks, lambda b: F.split(F.regexp_replace(b, WRAP, " "), r"(?<=[.!?])\s+", -1)))


def _weights(spark: SparkSession, templates: list[tuple[str, str]]) -> tuple[DataFrame, float]:
    """``(word, template, license, idf, weight)`` of the templates' unit vectors, and the idf of any other word."""
    bags = [re.findall(WORD, text.lower()) for _, text in templates]
    idf = {w: math.log((1 + len(bags)) / (1 + sum(w in bag for bag in bags))) + 1 for bag in bags for w in bag}
    rows = []
    for at, ((license, _), bag) in enumerate(zip(templates, bags, strict=True)):
        vector = {w: bag.count(w) * idf[w] for w in bag}
        norm = math.sqrt(sum(x * x for x in vector.values()))
        rows += [(w, at, license, idf[w], x / norm) for w, x in vector.items()]
    return spark.createDataFrame(rows, "word string, template int, license string, idf double, weight double"), math.log(1 + len(bags)) + 1


def notices(files: DataFrame) -> DataFrame:
    """``(path, h, is_license, parts)``: the notices of each row of ``files(path, text, is_license)``."""
    text = F.coalesce("text", F.lit(""))
    parts = F.filter(F.array_distinct(F.concat(F.split(text, SENTENCE, -1), _wrapped(text))), lambda s: s.rlike(HINT))
    parts = F.when(F.col("is_license"), F.concat(F.array(text), parts)).otherwise(parts)
    parts = F.when(text.rlike(HINT_OF_TEXT), parts).otherwise(F.array().cast("array<string>"))
    return files.select("path", F.xxhash64("text").alias("h"), "is_license", parts.alias("parts"))


def named(found: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``(path, h, license, score)``: the best of each row of ``notices`` that has one."""
    table, other = _weights(found.sparkSession, templates)
    # the outer forms: for the plain ones the optimizer adds filters that would work all this out a second time
    each = found.select("path", "h", F.posexplode_outer("parts").alias("at", "notice")).where("notice is not null")
    words = each.select("path", "h", "at", F.explode_outer(_words(F.col("notice"))).alias("word")).where("word is not null")
    counted = words.groupBy("path", "h", "at", "word").agg(F.count("*").alias("n"))
    idf = table.groupBy("word").agg(F.max("idf").alias("idf"), F.collect_list(F.struct("template", "license", "weight")).alias("uses"))
    met = counted.join(F.broadcast(idf), "word", "left")  # some hundred words, fixed by the templates
    weight = F.col("n") * F.coalesce("idf", F.lit(other))
    met = met.select("path", "h", "at", weight.alias("x"), "uses")
    norms = met.groupBy("path", "h", "at").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = met.where("uses is not null").select("path", "h", "at", "x", F.explode("uses").alias("use"))
    dots = dots.groupBy("path", "h", "at", "use.template", "use.license").agg(F.sum(F.col("x") * F.col("use.weight")).alias("dot"))
    both = dots.join(norms, ["path", "h", "at"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9))
    best = both.where(F.col("score") >= LEAST_COSINE).groupBy("path", "h")
    best = best.agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"))
    return best.select("path", "h", "best.license", (-F.col("best.minus")).alias("score"))


def parent(path: Column) -> Column:
    """The directory of a path; the root is empty."""
    return F.regexp_replace(path, r"(?:\A|/)[^/]*\z", "")


def ancestors(directory: Column) -> Column:
    """``(dir, depth)`` of a directory and all above it, the root included."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(F.array_join(F.slice(parts, F.lit(1), n), "/").alias("dir"), n.alias("depth")),
    )


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``(path, h, license, score, origin, holder)`` of every row of ``files(path, text, is_license)``.

    ``h`` is the hash of the text; ``origin`` is own, inherited or none; ``holder`` is the licence file inherited
    from. A null ``is_license`` is told by the file's name.
    """
    path = F.regexp_replace(F.coalesce("path", F.lit("")), r"\A/+|/+(?=/)", "")
    files = files.select(path.alias("path"), "text", F.coalesce(F.col("is_license"), path.rlike(LICENSE_FILE)).alias("is_license"))
    found = staged(notices(files), "notices")  # texts are read and searched once; all that follows takes what was found
    own = staged(named(found, templates), "licenses")
    rows = found.groupBy("path", "h").agg(F.max("is_license").alias("is_license"))
    rows = rows.join(own, ["path", "h"], "left").withColumn("dir", parent(F.col("path")))

    holders = rows.where("is_license and license is not null").groupBy("dir")
    holders = holders.agg(F.min(F.struct("path", "h", "license", "score")).alias("holder"))
    holders = broadcast_if_small(holders, BROADCAST_DIRECTORIES)
    every = rows.where("license is null").select("dir").distinct()
    above = every.select("dir", F.explode_outer(ancestors(F.col("dir"))).alias("a")).select("dir", F.col("a.dir").alias("up"), "a.depth")
    nearest = above.join(holders.select(F.col("dir").alias("up"), "holder"), "up").groupBy("dir").agg(F.max_by("holder", "depth").alias("holder"))
    found = rows.where("license is null").select("path", "h", "dir").join(nearest, "dir", "left")
    found = found.select(
        "path", "h", F.col("holder.license").alias("license"), F.col("holder.score").alias("score"),
        F.when(F.col("holder").isNull(), F.lit("none")).otherwise(F.lit("inherited")).alias("origin"), F.col("holder.path").alias("holder"),
    )
    kept = rows.where("license is not null").select("path", "h", "license", "score", F.lit("own").alias("origin"), F.lit(None).cast("string").alias("holder"))
    return kept.unionByName(found)
