"""License scans: min-hash bands over overlapping text windows, then exact containment.

A text's five-word shingles are hashed, and every window of ``window`` shingles gets a
one-permutation min-hash: the least hash in each of ``bands`` bins, each bin a band of one
row. A template's shingle in a window is the least of its bin unless one of the window's
other shingles falls into the same bin below it, so a window that holds even one shingle
of a template meets it with chance at least ``collision()``. What meets is verified by the
exact share of the template's shingles around the window. SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.common import table

# The usual statements of licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files, to deal in the Software without restriction",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the "
    "GNU Lesser General Public License as published by the Free Software Foundation",
    "agpl-notice": "it under the terms of the GNU Affero General Public License as published by the Free Software "
    "Foundation",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring "
    "rights to this work.",
    "apache-2.0-text": "you may not use this file except in compliance with the License. You may obtain a copy of the "
    "License at",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the "
    "authors be held liable for any damages arising from the use of this software",
}
SPDX = "SPDX-License-Identifier:"
"""Mark of a tag, which is shorter than a shingle and is found as it is written."""
SPDX_TAG = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+-]*[A-Za-z0-9+])"
SHINGLE = 5


@dataclass(frozen=True)
class Bands:
    """``window`` shingles, a new window every ``stride``; ``bands`` a power of two."""

    window: int = 16
    stride: int = 8
    bands: int = 4096
    containment: float = 0.8

    @property
    def bits(self) -> int:
        return self.bands.bit_length() - 1

    def collision(self) -> float:
        """Least chance that a template's only shingle in a window is the least of its bin.

        With p as its place in the bin, each of the other shingles is below it with chance
        p / bands; the mean over p.
        """
        n, b = self.window, self.bands
        return b / n * (1 - (1 - 1 / b) ** n)


def words_in(text: Column) -> Column:
    """Lower-case words without marks; a word of marks alone vanishes."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s]+", "")
    return F.filter(F.split(plain, r"\s+"), lambda w: w != "")


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns computed once: no later filter or projection repeats them."""
    names = list(columns)
    packed = F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("_held")
    return df.select(*df.columns, packed).select(*df.columns, *(F.col(f"_held.{n}").alias(n) for n in names))


def shingled(df: DataFrame, text: str) -> DataFrame:
    """``shingles``: hash of the five words at each place; empty for fewer words."""
    df = held(df, hashes=F.transform(words_in(F.coalesce(F.col(text), F.lit(""))), lambda w: F.xxhash64(w)))
    at = lambda i, k: F.get("hashes", i + k)
    places = F.sequence(F.lit(0), F.size("hashes") - SHINGLE)
    shingles = F.transform(places, lambda i: F.xxhash64(*(at(i, k) for k in range(SHINGLE))))
    empty = F.array().cast("array<bigint>")
    return held(df, shingles=F.when(F.size("hashes") >= SHINGLE, shingles).otherwise(empty)).drop("hashes")


def least_of_bins(arrays: Column, settings: Bands) -> Column:
    """Of every array: the least hash in each bin that has one; the bin is the hash's upper bits."""
    shift = 64 - settings.bits
    # Sorted first, as an array of its own: inside the filter it is then a variable.
    ordered = F.transform(arrays, lambda a: F.sort_array(a))
    bin_of = lambda h: F.shiftright(h, shift)
    return F.transform(
        ordered, lambda o: F.filter(o, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(o, i - 1))))
    )


def windows_of(settings: Bands) -> Column:
    last = F.greatest(F.ceil((F.size("shingles") - settings.window) / settings.stride).cast("int"), F.lit(0))
    starts = F.transform(F.sequence(F.lit(0), last), lambda k: k * settings.stride)
    return F.when(F.size("shingles") > 0, starts).otherwise(F.array().cast("array<int>"))


def template_bands(spark: SparkSession, templates: dict[str, str], settings: Bands) -> DataFrame:
    """(license, template, n_shingles, band): bounded by the list of templates."""
    rows = spark.createDataFrame(list(templates.items()), "license string, statement string")
    found = shingled(rows, "statement").where(F.size("shingles") > 0)
    found = found.select("license", F.array_distinct("shingles").alias("template"))
    # Windows of a template as long as the stride lie whole inside a window of the text.
    starts = F.sequence(F.lit(0), F.greatest(F.size("template") - settings.stride, F.lit(0)))
    pieces = held(found.select("*", F.explode(starts).alias("start")), piece=F.slice("template", F.col("start") + 1, settings.stride))
    return pieces.select("license", "template", F.explode(least_of_bins(F.array("piece"), settings)[0]).alias("band")).distinct()


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, settings: Bands = Bands(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, license, containment, first_word) for every statement found in a text.

    ``first_word`` counts the words with letters or digits before the statement's first
    shingle that is there. Statements shorter than five words are not found, but for SPDX
    tags, whose license is ``spdx:`` and the name. Null, empty and blank texts hold none.
    Rows with the same id and text count once; a null id is an id. A text with several
    places has a row for each, also where they follow each other. Other columns are ignored.
    """
    spark = docs.sparkSession
    bands = template_bands(spark, TEMPLATES if templates is None else templates, settings)
    # Parameters: as many as the given statements have shingles.
    keys = F.array(*(F.lit(r["band"]) for r in bands.select("band").distinct().orderBy("band").collect())).cast("array<bigint>")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = shingled(rows, "text").withColumn("row", F.xxhash64("text")).drop("text")
    rows = held(rows, starts=windows_of(settings))
    windows = F.transform("starts", lambda s: F.slice(F.col("shingles"), s + 1, settings.window))
    common = F.transform(least_of_bins(windows, settings), lambda a: F.array_intersect(a, keys))
    met = F.filter(F.arrays_zip(F.col("starts").alias("start"), common.alias("bands")), lambda w: F.size(w["bands"]) > 0)
    rows = held(rows, met=met)
    rows = rows.where(F.size("met") > 0).drop("starts")
    hits = rows.select("doc_id", "row", "shingles", F.explode("met").alias("w")).select(
        "doc_id", "row", "shingles", F.col("w.start").alias("start"), F.explode("w.bands").alias("band")
    )
    joined = hits.join(F.broadcast(bands), "band")
    size = F.size("template")
    # One template's length more than a place in the window can reach, so that a place cut off
    # at the left is told from one that begins there.
    low = F.greatest(F.col("start") - 2 * size, F.lit(0))
    region = F.slice("shingles", low + 1, F.lit(settings.window) + 4 * size)
    joined = held(joined.select("doc_id", "row", "license", "template", "start", low.alias("low"), region.alias("region")), both=F.array_intersect("template", "region"))
    share = F.size("both") / F.size("template")
    exact = joined.where(share >= settings.containment)
    exact = held(exact, places=places_of(settings))
    exact = exact.select("doc_id", "row", "license", "start", "low", F.size("template").alias("size"), F.explode("places").alias("place"))
    first = F.col("low") + F.col("place.at")
    # A place that begins earlier belongs to an earlier window.
    found = exact.where((first > F.col("start") - F.col("size")) | (F.col("low") == 0)).select(
        "doc_id", "row", "license", F.round("place.share", 6).alias("containment"), first.cast("long").alias("first_word")
    )
    found = found.groupBy("doc_id", "row", "license", "first_word").agg(F.max("containment").alias("containment"))
    return found.select("doc_id", "license", "containment", "first_word").unionByName(tags(docs, id_column, text_column))


def places_of(settings: Bands) -> Column:
    """(at, share) of the places in a region, left to right, none inside another.

    A place begins at a shingle of the template from which on, within the template's length
    and a quarter, enough of the template's shingles lie.
    """
    size = F.size("template")
    reach = (size + F.ceil(size / 4)).cast("int")
    candidates = F.filter(
        F.transform("region", lambda h, i: F.struct(
            i.alias("at"),
            F.when(
                F.array_contains("template", h),
                F.size(F.array_intersect(F.col("template"), F.slice(F.col("region"), i + 1, reach))) / size,
            ).otherwise(0.0).alias("share"),
        )),
        lambda p: p["share"] >= settings.containment,
    )
    none = F.array().cast("array<struct<at:int,share:double>>")
    # The next place may begin behind the last one's shingles.
    clear = lambda taken, p: (F.size(taken) == 0) | (p["at"] >= F.get(taken, F.size(taken) - 1)["at"] + size)
    return F.aggregate(candidates, none, lambda taken, p: F.when(clear(taken, p), F.concat(taken, F.array(p))).otherwise(taken))


def tags(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """SPDX tags: doc_id, license, containment 1 and first word, once per id and text."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).where(F.contains("text", F.lit(SPDX)))
    rows = rows.dropDuplicates()
    parts = held(rows, parts=F.split("text", SPDX_TAG), names=F.regexp_extract_all("text", F.lit(SPDX_TAG), F.lit(1)), whole=F.regexp_extract_all("text", F.lit(SPDX_TAG), F.lit(0)))
    # Words before a tag: those of the texts between the tags, and of the tags before it.
    total = lambda texts, n: F.aggregate(F.slice(texts, F.lit(1), n), F.lit(0), lambda a, t: a + F.size(words_in(t)))
    before = lambda i: total(F.col("parts"), i + 1) + total(F.col("whole"), i)
    found = parts.select("doc_id", F.explode(F.transform("names", lambda n, i: F.struct(n.alias("name"), before(i).alias("at")))).alias("tag"))
    return found.select(
        "doc_id", F.concat(F.lit("spdx:"), "tag.name").alias("license"), F.lit(1.0).alias("containment"),
        F.col("tag.at").cast("long").alias("first_word"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
