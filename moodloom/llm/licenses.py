"""Operator 2: licence notices found by the Dice coefficient of word bigrams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodloom.llm.common import held, if_small, text_key, texts_of
from moodloom.sources.staging import stage

THRESHOLD = 0.8
# Runs of a text are compared beside so many of its words, or the longest run of a template if that is more.
BLOCK_WORDS = 512

# Notices as their licences word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License."
    ),
    "BSD-use": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
}


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license_id string, text string")


def normal_words(text: str | Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def pairs(words: str) -> Column:
    """64-bit hashes of the bigrams of a word list, one for each word but the last."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get(F.col(words), i + 1)),
    )


def template_bigrams(templates: DataFrame) -> DataFrame:
    """``license_id, bigrams``: the different ones, a single word counting as one; templates without words vanish."""
    words = templates.select("license_id", held(normal_words("text")).alias("words")).where(F.size("words") > 0)
    single = F.size("words") == 1
    of_words = F.when(single, F.transform("words", lambda word: F.xxhash64(word))).otherwise(F.array_distinct(pairs("words")))
    return words.select("license_id", single.alias("single"), of_words.alias("bigrams")).distinct()


def places_of(words: DataFrame, hashes: Column, known: DataFrame) -> DataFrame:
    """``doc_id, text_id, place, hash`` and the template of each hash of a text that a template holds."""
    each = words.select("doc_id", "text_id", F.posexplode(hashes).alias("place", "hash"))
    keyed = known.select("license_id", F.size("bigrams").alias("license_size"), F.explode("bigrams").alias("bigram"))
    small = if_small(keyed, F.octet_length("license_id") + 64)
    return each.join(small, F.col("hash") == F.col("bigram")).drop("bigram")


def scan_licenses(
    docs: DataFrame,
    templates: DataFrame | None = None,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, line, license_id, n_common, dice`` for each place of a text that matches a template.

    A place is a run of words, over line breaks too; ``line`` is that of its first word, counted from 0. With A bigrams in the run, B in the
    template and C in common, Dice is ``2C / (A + B)``. It reaches the threshold t only if A is between ``t / (2 - t)`` and ``(2 - t) / t``
    times B and C is at least ``t / (2 - t)`` times B: texts with fewer bigrams of a template are dropped. In the others the runs within the
    bounds that begin and end with a bigram of the template, and whole lines, are compared; of runs that overlap the best
    has a row, the first of equals. A template of one word is found wherever the word is. Null, empty and wordless texts have no
    rows; a row that occurs twice with one id counts once; other columns are ignored.
    """
    spark = docs.sparkSession
    known = template_bigrams(templates if templates is not None else default_templates(spark))
    known = stage(known, "templates")
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    texts = texts_of(docs, id_column, text_column).withColumn("text_id", text_key())
    words = texts.select("doc_id", "text_id", held(normal_words("text")).alias("words"))
    of = ["doc_id", "text_id", "license_id"]
    hits = places_of(words, pairs("words"), known.where("not single"))
    need, most = F.ceil(low * F.col("license_size") - 1e-9), F.floor(high * F.col("license_size") + 1e-9).cast("int")
    lists = hits.groupBy(*of, "license_size").agg(F.sort_array(F.collect_set(F.struct("place", "hash"))).alias("hits"))
    lists = lists.where(F.size(F.array_distinct("hits.hash")) >= need)
    lists = stage(lists.select(*of, "license_size", F.col("hits.place").alias("places")), "license-places")

    wanted = lists.select(F.col("doc_id").alias("id"), F.col("text_id").alias("key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("text_id").eqNullSafe(F.col("key"))
    by_line = texts.join(if_small(wanted, 64), same, "left_semi").dropDuplicates(["doc_id", "text_id"])
    by_line = by_line.select("doc_id", "text_id", held(F.transform(F.split("text", "\n"), normal_words)).alias("lines"))

    # A text goes in blocks that overlap by the longest run, so a run is never beside the whole text.
    largest = known.where("not single").agg(F.coalesce(F.max(F.size("bigrams")), F.lit(0))).first()[0]
    reach = int(high * largest + 1e-9) + 1
    step = max(BLOCK_WORDS, reach)
    line_of = F.flatten(F.transform("lines", lambda line, i: F.array_repeat(i, F.size(line))))
    bodies = by_line.select("doc_id", "text_id", held(F.flatten("lines")).alias("words"), line_of.alias("line_of"))
    bodies = bodies.select("doc_id", "text_id", held(pairs("words")).alias("hashes"), "line_of")
    numbers = F.sequence(F.lit(0), F.floor((F.greatest(F.size("hashes"), F.lit(1)) - 1) / step).cast("int"))
    part = lambda of: F.slice(of, F.col("block") * step + 1, step + reach).alias(of)
    blocks = bodies.select("*", F.explode(numbers).alias("block")).select("doc_id", "text_id", "block", part("hashes"), part("line_of"))
    blocks = stage(blocks, "license-texts").withColumnsRenamed({"doc_id": "id", "text_id": "key", "block": "of_block"})
    own = F.floor(F.col("place") / step).cast("int")
    before = F.when((own > 0) & (F.col("place") % step < reach), F.array(own - 1, own)).otherwise(F.array(own))
    spread = lists.select(*of, "license_size", F.explode("places").alias("place")).select("*", F.explode(before).alias("block"))
    spread = spread.groupBy(*of, "license_size", "block").agg(F.sort_array(F.collect_set("place")).alias("places"))

    def runs_from(place: Column, k: Column) -> Column:
        ends = F.filter(F.slice("places", k + 1, most), lambda end: end < place + most)
        made = F.transform(ends, lambda end: F.struct(place.alias("s"), end.alias("e")))
        return F.when((F.size(ends) >= need) & (place < (F.col("block") + 1) * step), made).otherwise(F.slice(made, 1, 0))

    in_block = same & (F.col("block") == F.col("of_block"))
    listed = spread.join(if_small(blocks, 128 + 16 * F.size("hashes")), in_block)
    run = listed.select(*of, "license_size", "block", "hashes", "line_of", F.explode(F.flatten(F.transform("places", runs_from))).alias("run"))
    at = F.col("run.s") - F.col("block") * step
    taken = F.slice("hashes", at + 1, F.col("run.e") - F.col("run.s") + 1)
    run = run.select(*of, "license_size", "run", F.get("line_of", at).alias("line"), taken.alias("taken"))

    # Whole lines beyond a template's size.
    smallest = known.where("not single").agg(F.coalesce(F.min(F.size("bigrams")), F.lit(0))).first()[0]
    each_line = by_line.select("doc_id", "text_id", F.posexplode("lines").alias("line", "words"))
    of_line = each_line.select(
        "doc_id", "text_id", "line", F.size("words").alias("n"),
        F.when(F.size("words") - 2 >= int(high * smallest + 1e-9), F.col("words")).alias("words"),
    )
    earlier = Window.partitionBy("doc_id", "text_id").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("int")
    of_line = of_line.withColumn("s", begin).where(F.col("words").isNotNull())
    of_line = of_line.select(
        F.col("doc_id").alias("id"), F.col("text_id").alias("key"), "line",
        F.struct("s", (F.col("s") + F.col("n") - 2).alias("e")).alias("run"), pairs("words").alias("taken"),
    )
    of_line = stage(of_line, "license-lines")
    long_line = lists.drop("places").join(of_line, same).where(F.col("run.e") - F.col("run.s") >= most)
    run = run.unionByName(long_line.select(run.columns))

    bigrams = known.select(F.col("license_id").alias("name"), "bigrams")
    run = run.join(if_small(bigrams, F.octet_length("name") + 8 * F.size("bigrams") + 64), F.col("license_id") == F.col("name"))
    n_common = F.size(F.array_intersect("taken", "bigrams"))
    sizes = run.select(*of, "license_size", "run", "line", held(F.struct(F.size(F.array_distinct("taken")).alias("n"), n_common.alias("c"))).alias("of_run"))
    dice = 2 * F.col("of_run.c") / (F.col("of_run.n") + F.col("license_size"))
    close = sizes.select(*of, F.struct((-dice).alias("less"), "run.s", "run.e", "line", F.col("of_run.c").alias("n_common")).alias("run"))
    close = close.where(F.col("run.less") <= -threshold)
    # Runs that overlap, or touch, meet in one group; runs of different groups never decide about each other.
    in_order = Window.partitionBy(*of).orderBy("run.s", "run.e")
    reached = F.max("run.e").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    alone = F.coalesce(F.col("run.s") > reached + 1, F.lit(True)).cast("int")
    grouped = close.withColumn("alone", alone).withColumn("group", F.sum("alone").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = grouped.groupBy(*of, "group").agg(F.sort_array(F.collect_set("run")).alias("runs"))

    def add(so_far: Column, new: Column) -> Column:
        over = F.exists(so_far, lambda old: (old["s"] <= new["e"] + 1) & (new["s"] <= old["e"] + 1))
        return F.when(over, so_far).otherwise(F.concat(so_far, F.array(new)))

    best = ranked.select("doc_id", "license_id", F.explode(F.aggregate("runs", F.slice("runs", 1, 0), add)).alias("run"))
    result = best.select("doc_id", F.col("run.line").alias("line"), "license_id", F.col("run.n_common").cast("long").alias("n_common"), (-F.col("run.less")).alias("dice"))
    singles = known.where("single")
    if singles.isEmpty():
        return result
    lines = texts.distinct().select("doc_id", "text_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    each = lines.select("doc_id", "text_id", "line", F.explode(normal_words("text")).alias("word"))
    of_word = singles.select("license_id", F.col("bigrams")[0].alias("hash"))
    named = each.join(if_small(of_word, F.octet_length("license_id") + 64), F.xxhash64("word") == F.col("hash"))
    return result.unionByName(named.select("doc_id", "line", "license_id", F.lit(1).cast("long").alias("n_common"), F.lit(1.0).alias("dice")))
