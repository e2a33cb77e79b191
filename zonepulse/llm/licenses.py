"""License scans: MinHash bands over overlapping text windows find templates, exact shingles verify them.

Templates are cut into parts of at most ``PART`` shingles (three words, lower case, letters and digits
only). A part of n shingles belongs to the size class L, the least power of two not below n, and is
looked for in windows of 2 L shingles, one every L: a whole part always lies within one of them. Window and part
then have a Jaccard similarity of ``MATCH * n / (2 L)`` at least, which is above 0.2, and each of ``BANDS`` MinHash bands of
one row collides with that chance: all miss with less than 0.8 ** 48, one in 40,000.

A window's minimum equals a part's only if the window holds the shingle that gives the part its minimum. So only windows
around such shingles get signatures; no other window could collide in any band. Windows that collide are compared
shingle by shingle, as text.

A template held to ``MATCH`` has a part held to ``MATCH``, which the bands find. They only name the license; of a
license that is named, the shingles of every part are then counted in every window, however few a part keeps, and
``MATCH`` is applied once, to the template's total. Everything is built-in functions on rows of documents; what is
joined are signatures of the templates, ``BANDS`` rows per part, and their shingles.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse.llm.text import window_hashes

SHINGLE = 3
PART = 32
BANDS = 48
MATCH = 0.8

# Notices and passages of common licenses.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0-header", "you may not use this file except in compliance with the License. You may obtain a copy of the "
     "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met:"),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
)


def license_words(text: Column) -> Column:
    """Lower-case runs of letters and digits (all beyond ASCII count as letters)."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-/:-@\[-`{-\x7F]+"), "")


def _texts(words_column: str) -> str:
    """SQL for the shingles of a column of words, as text."""
    return (f"transform(sequence(1, greatest(size({words_column}) - {SHINGLE - 1}, 0), 1),"
            f" i -> array_join(slice({words_column}, i, {SHINGLE}), ' '))")


def _hash_of(shingle: str) -> str:
    """SQL for the hash that ``window_hashes`` gives to a shingle from its text."""
    return "xxhash64(" + ", ".join(f"get(split({shingle}, ' '), {i})" for i in range(SHINGLE)) + ")"


def _minima(hashes: Column) -> Column:
    """For each band, the least hash under the band's function and the shingle hash that gives it."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_min(F.transform(
        hashes, lambda h: F.struct(F.xxhash64(h, b).alias("low"), h.alias("from")))))


def template_parts(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(license, total, part, class, n, shingles, minima); templates of fewer than three words are left out."""
    rows = spark.createDataFrame(list(templates), "license string, text string")
    named = (rows.withColumn("_w", license_words(F.col("text"))).where(F.size("_w") >= SHINGLE)
             .withColumn("_h", window_hashes("_w", SHINGLE)).withColumn("_n", F.size("_h"))
             .withColumn("part", F.explode(F.expr(f"sequence(0, cast((_n - 1) div {PART} as int))")))
             .withColumn("_h", F.array_distinct(F.expr(f"slice(_h, part * {PART} + 1, {PART})")))
             .withColumn("_w", F.expr(f"slice(_w, part * {PART} + 1, {PART + SHINGLE - 1})")))
    parts = named.select("license", "part", F.size("_h").alias("n"), F.array_distinct(F.expr(_texts("_w"))).alias("shingles"),
                         _minima(F.col("_h")).alias("minima"))
    size_class = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("int")
    totals = parts.groupBy("license").agg(F.sum("n").alias("total"))
    return parts.join(totals, "license").withColumn("class", size_class)


def scan(df: DataFrame, templates=TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, license, containment, window_start) for each license a document holds.

    ``containment``: share of the template's shingles in the windows of its parts, of each part the window that holds most;
    a license is reported from ``MATCH`` on. ``window_start``: first shingle of the first window that holds most of the
    first part of which a window holds ``MATCH``. Null and empty texts and those of fewer than three words hold none; rows
    of one key are one document; null keys are one key; an empty frame or no templates give no rows.
    """
    parts = template_parts(df.sparkSession, templates)
    signatures = parts.select("license", "part", "class", F.posexplode("minima").alias("band", "_m")).select(
        "license", "part", "class", "band", F.col("_m.low").alias("low"), F.col("_m.from").alias("anchor"))
    anchors = [r[0] for r in signatures.select("anchor").distinct().collect()]      # at most BANDS a part
    classes = [r[0] for r in signatures.select("class").distinct().collect()]
    if not anchors:
        anchors, classes = [0], [1]

    at = F.filter(F.transform("_h", lambda h, i: F.when(h.isin(*anchors), i)), lambda i: i.isNotNull())
    around = F.array_distinct(F.flatten(F.transform(at, lambda i: F.flatten(F.array(*(
        F.array(*(F.struct(F.lit(c).alias("class"), F.greatest(F.floor(i / c).cast("int") - back, F.lit(0)).alias("id"))
                  for back in (0, 1))) for c in sorted(classes)))))))
    windows = F.transform(around, lambda w: F.struct(
        w["class"].alias("class"), (w["id"] * w["class"]).alias("start"),
        F.slice("_h", w["id"] * w["class"] + 1, w["class"] * 2).alias("_h"),
        F.slice("_w", w["id"] * w["class"] + 1, w["class"] * 2 + (SHINGLE - 1)).alias("_w")))
    shingled = (df.select(F.col(key), license_words(F.col(text)).alias("_w"))
                .withColumn("_h", window_hashes("_w", SHINGLE)))
    found = shingled.select(key, F.explode(windows).alias("_x")).select(key, "_x.*")
    signed = found.select(key, "class", "start", F.expr(_texts("_w")).alias("_s"), _minima(F.col("_h")).alias("_m"))
    banded = signed.select(key, "class", "start", "_s", F.posexplode(F.transform("_m", lambda m: m["low"])).alias("band", "low"))
    collided = (banded.join(F.broadcast(signatures.drop("anchor")), ["class", "band", "low"])
                .groupBy(key, "license", "part", "start").agg(F.max("_s").alias("_s")))
    named = (collided.join(F.broadcast(parts.select("license", "part", "n", "shingles")), ["license", "part"])
             .where(F.size(F.array_intersect("shingles", "_s")) >= MATCH * F.col("n"))
             .select(F.col(key).alias("_key"), F.col("license").alias("_license")).distinct())

    of = parts.select("license", "part", "class", "n", "total", F.explode("shingles").alias("_s"))
    wanted = [r[0] for r in of.select(F.expr(_hash_of("_s")).alias("h")).distinct().collect()] or [0]   # the templates' shingles
    texts = F.transform(F.filter(F.transform("_h", lambda h, i: F.when(h.isin(*wanted), i)), lambda i: i.isNotNull()),
                        lambda i: F.struct(i.alias("pos"), F.array_join(F.slice("_w", i + 1, SHINGLE), " ").alias("_s")))
    hits = (shingled.select(key, F.explode(texts).alias("_x")).select(key, "_x.*").join(F.broadcast(of), "_s")
            .join(named, F.col(key).eqNullSafe(F.col("_key")) & (F.col("license") == F.col("_license")), "left_semi"))
    held = (hits.withColumn("_back", F.explode(F.array(F.lit(0), F.lit(1))))
            .withColumn("start", F.expr("greatest(pos div class - _back, 0) * class"))
            .groupBy(key, "license", "part", "n", "total", "start").agg(F.count_distinct("_s").alias("_found")))
    best = held.groupBy(key, "license", "part", "n", "total").agg(
        F.max("_found").alias("_found"), F.min_by("start", F.struct(-F.col("_found"), F.col("start"))).alias("start"))
    whole = F.col("_found") >= MATCH * F.col("n")
    return (best.groupBy(key, "license")
            .agg((F.sum("_found") / F.max("total")).alias("containment"),
                 F.min_by("start", F.when(whole, F.col("part"))).cast("bigint").alias("window_start"))
            .where(F.col("containment") >= MATCH))
