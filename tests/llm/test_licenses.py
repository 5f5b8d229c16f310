"""Against brute force: dense vectors, and a walk up the directories."""

import math
import re

from ledgerline.llm import licenses, text_queries  # noqa: F401
from ledgerline.llm.registry import QUERIES

BAGS = [re.findall(licenses.WORD, t.lower()) for _, t in licenses.TEMPLATES]
WORDS = {w for bag in BAGS for w in bag}
IDF = {w: math.log((1 + len(BAGS)) / (1 + sum(w in bag for bag in BAGS))) + 1 for w in WORDS}


def vector(bag):
    out = {w: bag.count(w) * IDF.get(w, math.log(1 + len(BAGS)) + 1) for w in set(bag)}
    norm = math.sqrt(sum(x * x for x in out.values()))
    return {w: x / norm for w, x in out.items()}


VECTORS = [(name, vector(bag)) for (name, _), bag in zip(licenses.TEMPLATES, BAGS, strict=True)]


def best(text, whole):
    parts = [p for p in re.split(licenses.SENTENCE, text or "") if re.search(licenses.HINT, p)]
    found = []
    for part in parts + ([text] if whole and re.search(licenses.HINT, text or "") else []):
        own = vector(re.findall(licenses.WORD, part.lower()))
        for name, other in VECTORS:
            score = round(sum(x * other.get(w, 0) for w, x in own.items()), 9)
            if score >= licenses.LEAST_COSINE:
                found.append((-score, name))
    return (min(found)[1], -min(found)[0]) if found else None


def brute(files):
    own = {path: best(text, whole) for path, text, whole in files}
    out = {}
    for path, _, _ in files:
        if own[path]:
            out[path] = (own[path][0], "own", None)
            continue
        parts = path.split("/")[:-1]
        out[path] = (None, "none", None)
        for n in range(len(parts), -1, -1):
            here = sorted(p for p, _, whole in files if whole and own[p] and p.split("/")[:-1] == parts[:n])
            if here:
                out[path] = (own[here[0]][0], "inherited", here[0])
                break
    return out


FILES = [
    ("LICENSE", "Released under the MIT License.", True), ("a/x.py", "nothing", False), ("a/b/COPYING", "words here\nLicensed under CC BY-NC 4.0. More", True),
    ("a/b/c/d/y.py", "é", False), ("a/b/z.py", "x. Licensed under the Apache License, Version 2.0. y", False), ("a/bc/w.py", None, False),
    ("a/b/NOTICE", "Licensed under CC BY 4.0.", True), ("q/LICENSE", "no licence at all in this one", True), ("q/r.py", "", False),
]


def result(df):
    return {r.path: (r.license, r.origin, r.holder) for r in df.collect()}


def test_inheritance(spark):
    files = spark.createDataFrame(FILES, "path string, text string, is_license boolean").selectExpr("*", "1 as dir", "2 as license")
    got = result(licenses.scan(files))
    assert got == brute(FILES)
    assert got["a/b/c/d/y.py"] == ("CC-BY-NC-4.0", "inherited", "a/b/COPYING") and got["a/bc/w.py"][2] == "LICENSE"
    by_name = spark.createDataFrame([(p, t, None) for p, t, _ in FILES], files.select("path", "text", "is_license").schema)
    assert result(licenses.scan(by_name)) == got


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    files = [(f"{d.source}/{d.doc_id // 100_000}/{d.doc_id // 1000}/{d.doc_id // 50}/{d.doc_id}", d.text, d.doc_id % 50 == 49) for d in docs]
    got = {r.path: (r.license, r.origin, r.holder_id) for r in QUERIES["op9_licenses"](spark, small).collect()}
    want = {p: (a, b, int(c.split("/")[-1]) if c else None) for p, (a, b, c) in brute(files).items()}
    assert got == want and any(v[0] for v in got.values())


def test_nulls_repeats_and_nothing(spark):
    rows = [(None, None, None), ("x", "Released under the MIT License.", None), ("x", "Released under the MIT License.", None)]
    files = spark.createDataFrame(rows, "path string, text string, is_license boolean")
    assert result(licenses.scan(files)) == {"": (None, "none", None), "x": ("MIT", "own", None)} and licenses.scan(files).count() == 2
    assert licenses.scan(files.limit(0)).count() == 0


MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/."
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n\n1. Redistributions of source code must retain the above copyright\nnotice."
GNU = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {}General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY. See the\nGNU {}General Public License for more details."
OLD = "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version."
MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:'
APACHE = 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0'
CC0 = "Dedicated to the public\ndomain under CC0 1.0\nUniversal."
ISC = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby\ngranted, provided that the above copyright notice and this permission\nnotice appear in all copies."
SHORT = "This work is licensed under a\nCreative Commons Attribution 4.0\nInternational License"
HEADERS = [
    (MPL, "MPL-2.0"), (BSD, "BSD-3-Clause"), (GNU.format("", ""), "GPL-3.0"), (GNU.format("Lesser ", "Lesser "), "LGPL-3.0"),
    (GNU.format("Affero ", "Affero "), "AGPL-3.0"), (OLD, "LGPL-2.1"), (MIT, "MIT"), (APACHE, "Apache-2.0"), (CC0, "CC0-1.0"), (ISC, "ISC"), (SHORT, "CC-BY-4.0"),
]


def commented(mark, text):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.split("\n"))


def test_wrapped_headers(spark):
    """Licenses written out here, not worked out from the module's own cuts."""
    code = "import os\nprint(os.name)\nx = [1, 2, 3]"
    rows, want = [], {}
    for i, (text, license) in enumerate(HEADERS):
        forms = [
            text, f"{commented('#', text)}\n{code}", f"int a;\n{commented('//', text)}\n{code}", f"/*\n{commented(' *', text)}\n */\n{code}",
            f"<!--\n{text}\n-->\n{code}", f'"""\n{text}\n"""\n{code}', f"{commented('#', text)}\n{code}".replace("\n", "\r\n"),
        ]
        for j, form in enumerate(forms):
            rows.append((f"{i}/{j}", form, False))
            want[f"{i}/{j}"] = license
    rows.append(("one line", f"Licensed under CC BY 4.0\n{code}", False))
    got = {r.path: r.license for r in licenses.scan(spark.createDataFrame(rows, "path string, text string, is_license boolean")).collect()}
    assert {p: (got[p], w) for p, w in {**want, "one line": "CC-BY-4.0"}.items() if got[p] != w} == {}


def test_identifiers_by_themselves(spark):
    """Every tag names its own license."""
    names = licenses.IDENTIFIERS
    tags = [n + ("-or-later" if "GPL" in n else "") for n in names]
    rows = [(f"src/{n}.c", f"// SPDX-License-Identifier: {t}\nint x;\n", False) for n, t in zip(names, tags, strict=True)]
    got = result(licenses.scan(spark.createDataFrame(rows, "path string, text string, is_license boolean")))
    assert got == {f"src/{n}.c": (n, "own", None) for n in names}
