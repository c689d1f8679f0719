"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Built-in functions only.  Windows come in the sizes ``2 * stride`` words for each of ``STRIDES`` (doubled on as far as the longest template
needs) and overlap by half; a template belongs to the smallest stride that holds it, so it lies whole in one window of its size.  A window is the set of
those of its ``SHINGLE``-word shingles that templates of its size have (others cannot change containment, and leaving them out raises the likeness of a window to
what it holds).  ``BANDS`` bands of ``ROWS`` rows collide with probability ``1 - (1 - J**ROWS)**BANDS``: a one-shingle template in a window
filled by 27 others (J = 1/28) is still retrieved with 0.999, at J = 0.1 the miss is 2e-9, alone in its window (J >= 0.8) it cannot be
missed.  A retrieved template matches if the window contains at least ``CONTAINMENT`` of its shingles, among them all that hold a number, as
versions tell licenses apart.  A template of fewer than ``SHINGLE`` words is one shingle of its own size.

Only rows with a template shingle are grouped or joined, and templates (a fixed table) are the broadcast side.

Defined cases: words are runs of letters and digits, lower-cased; null and empty texts match nothing; a template without words is
refused; repeated rows give one result per (id, license); a null id is kept as an id; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

SHINGLE = 5
CONTAINMENT = 0.8
STRIDES = (16, 64, 256)
BANDS, ROWS = 192, 1

# Wording of common license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                 "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                 "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
                 "Software is furnished to do so, subject to the following conditions",
    "MIT-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "MIT-line": "This project is licensed under the MIT License",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                           "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                  "as published by the Free Software Foundation",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
                    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                   "License as published by the Free Software Foundation",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met",
    "BSD-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
           "that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-line": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "SPDX-Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "SPDX-GPL-3.0": "SPDX-License-Identifier: GPL-3.0-or-later",
    "SPDX-GPL-3.0-only": "SPDX-License-Identifier: GPL-3.0-only",
    "SPDX-GPL-2.0": "SPDX-License-Identifier: GPL-2.0-or-later",
    "SPDX-GPL-2.0-only": "SPDX-License-Identifier: GPL-2.0-only",
    "SPDX-AGPL-3.0": "SPDX-License-Identifier: AGPL-3.0-or-later",
    "SPDX-LGPL-2.1": "SPDX-License-Identifier: LGPL-2.1-or-later",
    "SPDX-BSD-2-Clause": "SPDX-License-Identifier: BSD-2-Clause",
    "SPDX-BSD-3-Clause": "SPDX-License-Identifier: BSD-3-Clause",
    "SPDX-MPL-2.0": "SPDX-License-Identifier: MPL-2.0",
    "SPDX-EPL-2.0": "SPDX-License-Identifier: EPL-2.0",
    "SPDX-CC0-1.0": "SPDX-License-Identifier: CC0-1.0",
    "SPDX-MIT": "SPDX-License-Identifier: MIT",
    "SPDX-ISC": "SPDX-License-Identifier: ISC",
    "SPDX-Unlicense": "SPDX-License-Identifier: Unlicense",
    "SPDX-Zlib": "SPDX-License-Identifier: Zlib",
}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_array(word_hashes: Column, n: int = SHINGLE) -> Column:
    """Hash of every ``n`` consecutive words, in order; null where there are fewer."""
    last = F.size(word_hashes) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        *[F.get(word_hashes, i + j) for j in range(n)])))


def shingled(df: DataFrame, text_col: str, out_col: str, sizes: tuple[int, ...] = (SHINGLE,)) -> DataFrame:
    """``df`` with the shingle hashes of a text column, of each of the ``sizes`` one after the other (each step its own column, so
    nothing is computed twice)."""
    hashed = df.withColumn(out_col, F.transform(words(F.col(text_col)), lambda w: F.xxhash64(w)))
    each = [F.transform(F.coalesce(shingle_array(F.col(out_col), n), F.array().cast("array<bigint>")),
                        lambda h, i: F.struct(h.alias("h"), i.alias("at"))) for n in sizes]
    return hashed.withColumn(out_col, F.concat(*each))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, size, shingles, numbered): distinct shingles of each template, of ``SHINGLE`` words or its whole length, and those
    of them that hold a number."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, body string").withColumn("w", words(F.col("body")))
    rows = rows.withColumn("size", F.least(F.size("w"), F.lit(SHINGLE))).withColumn("runs", F.when(F.col("size") > 0, F.transform(
        F.sequence(F.lit(0), F.size("w") - F.col("size")), lambda i: F.slice("w", i + 1, F.col("size")))))

    def of_size(runs, n):
        return F.transform(runs, lambda r: F.xxhash64(*[F.xxhash64(F.get(r, F.lit(j))) for j in range(n)]))

    def hashed(runs):
        by_size = F.when(F.col("size") == SHINGLE, of_size(runs, SHINGLE))
        for n in range(1, SHINGLE):
            by_size = by_size.when(F.col("size") == n, of_size(runs, n))
        return F.array_distinct(by_size)

    numbered = F.filter("runs", lambda r: F.exists(r, lambda w: w.rlike("[0-9]")))
    return rows.select("license", "size", hashed(F.col("runs")).alias("shingles"), hashed(numbered).alias("numbered"))


def min_hashes(shingles: Column) -> Column:
    """One hash per band over the band's ``ROWS`` minima."""

    def minimum(j: Column) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, j)))

    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda b: F.xxhash64(b, *[minimum(b * ROWS + r) for r in range(ROWS)]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         containment: float = CONTAINMENT) -> DataFrame:
    """(id, license, containment, first_word): the best containment of every matched license and the place of the first word of
    the license's own shingles in the earliest window that holds it."""
    spark = docs.sparkSession
    table = template_table(spark, templates or TEMPLATES)
    table = written(table, "license-templates")  # computed once, not by the planner whenever it looks at a literal table
    known = table.select("license", "size", "shingles").collect()  # the fixed template table
    if any(not r.shingles for r in known):
        raise ValueError("templates need at least one word")
    strides = list(STRIDES)
    while max(len(r.shingles) for r in known) + SHINGLE - 1 > strides[-1]:
        strides.append(2 * strides[-1])
    sized = table.withColumn("stride", F.array_min(F.filter(F.array(*map(F.lit, strides)), lambda x: F.size("shingles") + SHINGLE - 1 <= x)))
    wanted = F.broadcast(sized.select(F.explode("shingles").alias("h"), "stride").distinct())
    universe = sorted({h for r in known for h in r.shingles})
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # The row number keeps the filter on ``hits`` above this projection: pushed below it, the filter would evaluate
    # the nested array expressions once more, from the text, for every word.
    hits = (shingled(base, "text", "s", tuple(sorted({r["size"] for r in known}, reverse=True))).select(
        "id", F.monotonically_increasing_id().alias("row"), F.filter("s", lambda x: x["h"].isin(universe)).alias("hits"))
        .select("id", "row", F.explode("hits").alias("x")).select("id", "row", "x.h", "x.at").join(wanted, "h"))
    part = F.floor(F.col("at") / F.col("stride"))
    windows = (hits.select("id", "row", "stride", "h", "at", F.explode(F.array(part, part - 1)).alias("window")).where("window >= 0")
               .groupBy("id", "row", "stride", "window", "h").agg(F.min("at").alias("at"))
               .groupBy("id", "row", "stride", "window").agg(F.collect_list(F.struct("h", "at")).alias("places")))
    windows = windows.withColumn("in_window", F.transform("places", lambda p: p["h"]))
    banded = windows.withColumn("uid", F.xxhash64("id", "row", "stride", "window")).withColumn("bands", min_hashes(F.col("in_window")))
    bands = F.broadcast(written(sized.select(
        "license", "shingles", "numbered", "stride", F.explode(F.array_distinct(min_hashes(F.col("shingles")))).alias("band")), "license-bands"))
    met = (banded.select("id", "uid", "stride", "in_window", "places", F.explode("bands").alias("band")).join(bands, ["stride", "band"])
           .dropDuplicates(["id", "uid", "license"]))
    share = F.size(F.array_intersect("shingles", "in_window")) / F.size("shingles")
    own = F.array_min(F.transform(F.filter("places", lambda p: F.array_contains("shingles", p["h"])), lambda p: p["at"]))
    versions = F.size(F.array_except("numbered", "in_window")) == 0
    return (met.select("id", "license", share.alias("containment"), own.alias("first_word"), versions.alias("versions"))
            .where((F.col("containment") >= containment) & F.col("versions"))
            .groupBy("id", "license").agg(F.round(F.max("containment"), 6).alias("containment"), F.min("first_word").alias("first_word"))
            .withColumnRenamed("id", id_col))
