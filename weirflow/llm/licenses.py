"""License scans: sparse TF-IDF cosine of header lines and licence files to templates, then inheritance along the path.

Spark expressions only. Every line of a file that shares two words or more with a template is compared with all templates; a licence
file is compared as a whole as well. Cosines are worked out inside the row, so texts are never shuffled: one pass counts in how many
lines each template word stands, the next scores. Which files are licence files is joined to counts and scores, so it may come from
another table (``renamed``). A file without a match of its own takes the licence of the nearest directory above it that has a licence
file: the ancestor paths of every directory are joined with those directories, then files with their directory.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import SPACE, held_above, written

COSINE = 0.8
# Usual short licence statements.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0"],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["Released under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"],
    "Proprietary": ["All rights reserved", "Copyright. All rights reserved"],
}
LICENCE_FILES = r"(?i)^(un)?licen[cs]e(\..*)?$|^copying(\..*)?$"


EDGE = ".,;:!?()[]{}\"'*/#<>-"
_EDGE_CLASS = r".,;:!?()\[\]{}\"'*/#<>\-"
# A run of punctuation is entered at its start only, so long runs stay linear.
_BETWEEN = rf"(?<![{_EDGE_CLASS}])[{_EDGE_CLASS}]*+[\x20\x09-\x0D][{_EDGE_CLASS}\x20\x09-\x0D]*+"


def terms(text: Column) -> Column:
    """Lower-case words without leading and trailing punctuation."""
    return F.array_remove(F.split(F.btrim(F.lower(text), F.lit(SPACE + EDGE)), _BETWEEN), "")


def _template_rows(spark, templates: dict[str, list[str]]) -> DataFrame:
    rows = [(name, i, text) for name, texts in templates.items() for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "license string, variant int, text string")


def _sum_of_squares(ordered: Column) -> Column:
    """Sum of the squared counts of each word of a sorted array, in one walk: the r-th of a run adds r^2 - (r-1)^2."""

    def step(acc: Column, w: Column) -> Column:
        run = F.when(acc["word"] == w, acc["run"] + 1).otherwise(F.lit(1.0))
        return F.struct(w.alias("word"), run.alias("run"), (acc["squares"] + 2 * run - 1).alias("squares"))

    start = F.struct(F.lit("").alias("word"), F.lit(0.0).alias("run"), F.lit(0.0).alias("squares"))
    return F.aggregate(ordered, start, step, lambda acc: acc["squares"])


def _sum(items: Column, of) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda a, x: a + of(x))


def _lookup(weights: dict[str, float]) -> Column:
    return F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair))


def _final(rows: DataFrame, renamed: DataFrame | None) -> DataFrame:
    """Rows with the path their file ends up with, and whether that is a licence file."""
    if renamed is None:
        rows = rows.withColumn("path", F.col("file"))
    else:
        rows = rows.join(renamed.select("file", F.col("path").alias("other")), "file", "left").withColumn("path", F.coalesce("other", "file")).drop("other")
    return rows.withColumn("licence_file", F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILES))


def matches(files: DataFrame, templates: dict[str, list[str]], cosine: float, renamed: DataFrame | None = None) -> DataFrame:
    """(path, license, score): the best template of each file at or above ``cosine``; ties go to the first name."""
    known = _template_rows(files.sparkSession, templates).select("license", "variant", F.explode(terms(F.col("text"))).alias("t"))
    known = known.groupBy("license", "variant", "t").agg(F.count(F.lit(1)).alias("tf")).collect()  # the words of the templates
    vocab = F.array(*(F.lit(t) for t in sorted({r.t for r in known}))).cast("array<string>")
    lines = F.filter(F.split("text", "\n", -1), lambda s: F.length(s) > 0)
    split = files.select("file", F.transform(lines, terms).alias("lines"))  # the words of a whole text are those of its lines
    shares = split.select("file", F.size("lines").alias("n"), F.flatten(F.transform("lines", lambda ts: F.array_intersect(ts, vocab))).alias("shared"))
    shares = _final(written(shares, "shares"), renamed).select(F.col("n") + F.col("licence_file").cast("int"), F.concat("shared", F.when(F.col("licence_file"), F.array_distinct("shared")).otherwise(F.array().cast("array<string>")))).toDF("n", "shared")
    shares = written(shares, "units")
    n = shares.agg(F.sum("n")).first()[0] or 0
    seen = shares.select(F.explode("shared").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()
    df = {r.t: r.n for r in seen}
    idf = {r.t: math.log((1 + n) / (1 + df.get(r.t, 0))) + 1 for r in known}
    other = math.log(1 + n) + 1  # words of no template count as seen nowhere
    model: dict[tuple[str, int], dict[str, float]] = {}
    for r in known:
        model.setdefault((r.license, r.variant), {})[r.t] = r.tf * idf[r.t]
    if not model:
        return files.select(F.col("file").alias("path"), F.lit("").alias("license"), F.lit(0.0).alias("score")).where(F.lit(False))
    unit = lambda whole, ts: F.struct(F.lit(whole).alias("whole"), ts.alias("ts"))
    units = split.select("file", F.explode(F.concat(F.transform("lines", lambda ts: unit(False, ts)), F.array(unit(True, F.flatten("lines"))))).alias("u"))
    units = units.select("file", "u.whole", "u.ts").withColumn("shared", F.array_intersect("ts", vocab))
    # A cosine of c asks that the template words of a line weigh c^2 / (1 - c^2) times its other words at least, squared and summed.
    # First with the greatest weight for every template word, then with their own; whole lengths are worked out for the rest only.
    floor = (cosine - 1e-6) ** 2
    units = units.withColumn("strange", F.size(F.array_distinct("ts")) - F.size("shared"))
    most = F.size("ts") - F.col("strange")
    near = held_above(units.withColumn("near", (F.size("shared") >= 2) & (most * most * (1 - floor) >= floor * F.col("strange"))), "near")
    count = lambda t: (F.size("ts") - F.size(F.array_remove("ts", t))).cast("double")
    near = near.select("file", "whole", "ts", "strange", F.transform("shared", lambda t: F.struct(t.alias("t"), count(t).alias("tf"), F.element_at(_lookup(idf), t).alias("idf"))).alias("ws"))
    near = near.withColumn("weight", _sum(F.col("ws"), lambda x: x["tf"] * x["tf"] * x["idf"] * x["idf"]))
    near = held_above(near, f"weight * {1 - floor!r} >= strange * {floor * other * other!r}")
    rest = _sum_of_squares(F.sort_array("ts")) - _sum(F.col("ws"), lambda x: x["tf"] * x["tf"])
    near = near.select("file", "whole", "ws", F.sqrt(rest * other * other + F.col("weight")).alias("length"))
    scores = []
    for (name, _), weights in sorted(model.items()):
        norm = math.sqrt(sum(w * w for w in weights.values()))
        table = _lookup(weights)
        dot = _sum(F.col("ws"), lambda x, table=table: x["tf"] * x["idf"] * F.coalesce(F.element_at(table, x["t"]), F.lit(0.0)))
        scores.append(F.struct((-F.round(dot / norm / F.col("length"), 6)).alias("s"), F.lit(name).alias("license")))
    best = held_above(near.select("file", "whole", F.array_min(F.array(*scores)).alias("b")), f"b.s <= {-cosine!r}")
    best = _final(best.groupBy("file", "whole").agg(F.min("b").alias("b")), renamed).where("licence_file or not whole")
    best = best.groupBy("path").agg(F.min("b").alias("b"))
    return best.select("path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def scan(df: DataFrame, path_col: str = "path", text_col: str = "text", templates: dict[str, list[str]] | None = None, cosine: float = COSINE, renamed: DataFrame | None = None) -> DataFrame:
    """One row per input path: path, license, score, via (own, inherited or none) and from_dir.

    Paths use "/". Repeated paths count as one file with all their lines; a null path is the file with no directory. Null and empty texts
    match nothing. With several licence files in one directory the best score, then the first name, holds. An empty table gives no rows.
    Extra columns of the input are not read. ``renamed`` (file, path; one row per file) gives some input paths another one: it is joined
    to counts and scores, never to texts.
    """
    templates = templates or TEMPLATES
    files = df.select(F.coalesce(df[path_col].cast("string"), F.lit("")).alias("file"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))
    own = written(matches(files, templates, cosine, renamed), "licences")
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    names = _final(files.select("file").distinct(), renamed).select("path", "licence_file").distinct()
    mine = written(names.join(own, "path", "left").withColumn("dir", directory), "files")
    held = mine.where("licence_file and license is not null").groupBy(F.col("dir").alias("up")).agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    parts = F.split("dir", "/")
    ups = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")))
    above = mine.where("license is null").select("dir").distinct().select("dir", F.explode_outer(ups).alias("up"))
    nearest = above.join(held, "up").groupBy("dir").agg(F.max_by(F.struct("up", "b"), F.length("up")).alias("d"))
    rows = mine.join(nearest, "dir", "left")
    via = F.when(F.col("license").isNotNull(), "own").when(F.col("d").isNotNull(), "inherited").otherwise("none")
    return rows.select(
        "path", F.coalesce("license", "d.b.license").alias("license"), F.coalesce("score", -F.col("d.b.s")).alias("score"),
        via.alias("via"), F.when(via == "inherited", F.col("d.up")).alias("from_dir"),
    )
