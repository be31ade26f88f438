"""Licence scan with DataFrame functions: TF-IDF cosine to templates, then inheritance by directory.

Lines with a licence cue are the header of a file, wherever they stand; of a file named like a licence
file it is the whole text. Headers and templates become sparse TF-IDF vectors over words; a header takes
the template with the highest cosine, if high enough. Where that names no licence, or only the reserved
rights that stand beside many licences, the best of its sentences and windows of words counts.
Files without a header inherit the licence of the nearest ancestor directory that has a licence file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atende.llm.common import Stage, let

LEAST_COSINE = 0.5
# A licence file is named like one, or is short and mostly licence.
FILE_NAMES = r"(?i)\A(licen[cs]e|copying|notice)([.\-_].*)?\z"
# Cues and the short forms of common licences.
RESERVED = "proprietary"
# Words of the windows of a long sentence, and words from one to the next.
WINDOWS = ((12, 3), (32, 8))
SENTENCE_END = r"(?<=[.!?])\s+|\n\s*\n"
CUE = r"(?i)(licen[cs]|copyright|spdx|all rights reserved|public domain)"
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    (RESERVED, "All rights reserved."),
    (RESERVED, "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited."),
)


def header_of(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: x.rlike(CUE)), " ")


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda x: x != "")


def units_of(text: Column, named: Column) -> Column:
    """Sentences of the lines and of the whole text, and windows of long ones: all of a licence file, else those with a cue."""
    near = lambda units: F.filter(units, lambda x: named | x.rlike(CUE))
    lines = F.flatten(F.transform(F.split(text, "\n"), lambda x: F.split(x, SENTENCE_END)))
    sentences = near(F.array_distinct(F.concat(F.split(text, SENTENCE_END), lines)))

    def windows(sentence: Column) -> Column:
        def cut(words: Column) -> Column:
            def of(size: int, step: int) -> Column:
                starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - size + step - 1), F.lit(step))
                return F.transform(starts, lambda n: F.array_join(F.slice(words, n + 1, size), " "))

            return F.when(F.size(words) > WINDOWS[0][0], F.concat(*(of(*w) for w in WINDOWS))).otherwise(F.array().cast("array<string>"))

        return let(F.split(F.trim(sentence), r"\s+"), cut)

    return F.array_distinct(F.concat(sentences, near(F.flatten(F.transform(sentences, windows)))))


def _terms(df: DataFrame, text: str, key: str) -> DataFrame:
    """(key, term, tf): the words of each text; the text itself is not carried along."""
    return df.select(key, F.explode(words_of(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def frequencies(headers: DataFrame, templates: DataFrame, stage: Stage) -> DataFrame:
    """(t, df): document frequencies over all distinct headers and templates."""
    terms = _terms(headers, "header", "key").select("term").union(_terms(templates, "template", "template").join(templates, "template").select("term"))
    return stage(terms.groupBy("term").agg(F.count("*").alias("df")).withColumnRenamed("term", "t"))


def cosines(headers: DataFrame, templates: DataFrame, df: DataFrame, n: int, stage: Stage) -> DataFrame:
    """(key, licence, cosine): the best template of each header (key, header); smallest name on ties."""
    own, known = _terms(headers, "header", "key"), _terms(templates, "template", "template").join(templates, "template")
    idf = F.log(F.lit(1.0 + n) / (1 + F.coalesce("df", F.lit(0)))) + 1
    weigh = lambda x: x.join(df, F.col("term") == F.col("t"), "left").withColumn("w", F.col("tf") * idf).drop("t", "df", "tf")
    own, known = stage(weigh(own)), stage(weigh(known))
    norm = lambda x, key, as_: x.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias(as_))
    # The templates are a fixed list, which bounds the broadcast.
    table = known.join(norm(known, "template", "tn"), "template").select("template", "licence", F.col("term").alias("t"), F.col("w").alias("tw"), "tn")
    dots = own.join(F.broadcast(table), F.col("term") == F.col("t")).groupBy("key", "template", "licence").agg(
        F.sum(F.col("w") * F.col("tw")).alias("dot"), F.first("tn").alias("tn")
    )
    scored = dots.join(norm(own, "key", "hn").withColumnRenamed("key", "k"), F.col("key") == F.col("k")).select(
        "key", "licence", F.round(F.col("dot") / (F.col("tn") * F.col("hn")), 6).alias("cosine")
    )
    best = F.min(F.struct((-F.col("cosine")).alias("c"), "licence"))
    return scored.groupBy("key").agg(best.alias("b")).select("key", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"))


def ancestors(path: Column) -> Column:
    """The directories above a path, the nearest last; '' is the root."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def license_scan(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST_COSINE) -> DataFrame:
    """(path, licence, cosine, how, directory) of every row.

    how: 'header' for a licence of its own, 'inherited' with the directory it comes from, 'none' otherwise. Licence
    files declare for their directory; of several in one directory the highest cosine counts, then the smallest name. A null
    text has no header; a null path declares nothing and inherits nothing. Repeated rows are judged alike; other
    columns are not read; an empty table gives an empty result.
    """
    stage = Stage(files)
    body = F.coalesce(F.col(text), F.lit(""))
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select(F.col(path).alias("path"), body.alias("body")).withColumn("named", F.coalesce(name.rlike(FILE_NAMES), F.lit(False)))
    rows = rows.withColumn("header", F.when(F.col("named"), F.col("body")).otherwise(header_of(F.col("body"))))
    has = F.col("header") != ""
    rows = stage(rows.select(
        "path", "named", F.when(has, F.col("header")).alias("header"), F.when(has, F.sha2("header", 256)).alias("head"), F.length("body").alias("chars"),
        F.when(has, F.sha2(F.concat(F.col("named").cast("string"), "body"), 256)).alias("file"),
        F.when(has, units_of(F.col("body"), F.col("named"))).alias("units"),
    ))
    spark = files.sparkSession
    templates = spark.createDataFrame(list(TEMPLATES), "licence string, template string")
    headers = stage(rows.where("header is not null").select(F.col("head").alias("key"), "header").dropDuplicates(["key"]))
    df, n = frequencies(headers, templates, stage), headers.count() + len(TEMPLATES)
    best = stage(cosines(headers, templates, df, n, stage).where(F.col("cosine") >= least))
    whole = stage(rows.withColumn("header_chars", F.length("header")).drop("header").join(best, F.col("head") == F.col("key"), "left").drop("key", "head"))
    open_ = F.col("file").isNotNull() & (F.col("licence").isNull() | (F.col("licence") == RESERVED))
    # A file's units are taken apart once for each distinct file; a long sentence is told from others by its digest.
    units = whole.where(open_).dropDuplicates(["file"]).select("file", F.explode("units").alias("unit"))
    units = stage(units.select("file", "unit", F.sha2("unit", 256).alias("of"), F.length("unit").alias("unit_chars")))
    distinct = units.select(F.col("of").alias("key"), F.col("unit").alias("header")).dropDuplicates(["key"])
    scores = stage(cosines(distinct, templates, df, n, stage).where(F.col("cosine") >= least))
    order = F.min(F.struct((F.col("licence") == RESERVED).alias("r"), (-F.col("cosine")).alias("c"), "licence", (-F.col("unit_chars")).alias("len")))
    parts = units.drop("unit").join(scores, F.col("of") == F.col("key")).groupBy(F.col("file").alias("f")).agg(order.alias("u"))
    better = F.col("u").isNotNull() & (F.col("licence").isNull() | ~F.col("u.r"))
    found = stage(
        whole.drop("units").join(stage(parts), open_ & (F.col("file") == F.col("f")), "left")
        .withColumn("cosine", F.when(better, -F.col("u.c")).otherwise(F.col("cosine")))
        .withColumn("chars_of", F.when(better, -F.col("u.len")).otherwise(F.col("header_chars")))
        .withColumn("licence", F.when(better, F.col("u.licence")).otherwise(F.col("licence"))).drop("f", "u", "file")
    )
    is_file = F.col("named") | (2 * F.col("chars_of") >= F.col("chars"))
    top = F.min(F.struct((-F.col("cosine")).alias("c"), "licence"))
    declared = stage(
        found.where(F.col("licence").isNotNull() & F.col("path").isNotNull() & is_file)
        .select(F.element_at(ancestors(F.col("path")), -1).alias("dir"), "licence", "cosine").groupBy("dir").agg(top.alias("b"))
        .select("dir", F.col("b.licence").alias("dir_licence"), (-F.col("b.c")).alias("dir_cosine"))
    )
    # Directories are few against files: each is joined to its ancestors once, then files to their directory.
    homes = found.where(F.col("licence").isNull() & F.col("path").isNotNull()).select(F.element_at(ancestors(F.col("path")), -1).alias("home")).distinct()
    up = homes.select("home", F.posexplode(F.concat(ancestors(F.col("home")), F.array("home"))).alias("depth", "above"))
    nearest = stage(
        up.join(declared, F.col("above") == F.col("dir")).groupBy("home").agg(F.max(F.struct("depth", "dir", "dir_licence", "dir_cosine")).alias("n"))
        .select("home", "n.dir", "n.dir_licence", "n.dir_cosine")
    )
    home = F.when(F.col("licence").isNull(), F.element_at(ancestors(F.col("path")), -1))
    return found.withColumn("mine", home).join(nearest, F.col("mine") == F.col("home"), "left").select(
        "path", F.coalesce("licence", "dir_licence").alias("licence"), F.coalesce("cosine", "dir_cosine").alias("cosine"),
        F.when(F.col("licence").isNotNull(), "header").when(F.col("dir").isNotNull(), "inherited").otherwise("none").alias("how"),
        F.when(F.col("licence").isNull(), F.col("dir")).alias("directory"),
    )
