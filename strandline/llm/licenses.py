"""License scans by diagonal voting (operator 4), in DataFrame functions alone.

Every rolling word pair of every text is hashed and joined to the positions where it stands in a template.
A hit at word i of a text and word j of a template votes for the diagonal i - j. Votes are gathered by
diagonal, diagonals at most ``DRIFT`` apart are merged (a word put in or left out moves the rest of a
notice to the next one), and a merged span counts if it covers enough of the template's pairs. A short
phrase is found exactly where one diagonal holds all of its pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that are always labelled, and notices of well-known licenses.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under the creative commons attribution 4 0 international license", "cc-by"),
    ("to the extent possible under law the author has waived all copyright and related or neighboring rights", "cc0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]

DRIFT = 2
COVER = 0.7


def template_positions(spark: SparkSession, phrases=None, notices=None) -> DataFrame:
    """gram, template, j, pairs, label, exact: a row for each word pair of each template.

    Row ``template = -1`` has the gram 0, which stands for the text itself (see scan).
    """
    rows = [("", -1, "", False)]
    rows += [(text, i, label, exact) for i, (text, label, exact) in enumerate([(*p, True) for p in (phrases or PHRASES)] + [(*n, False) for n in (notices or NOTICES)])]
    if any(not 1 < len(r[0].split()) <= 64 for r in rows[1:]):
        raise ValueError("templates have 2 to 64 words: a span's pairs are marked in one long")
    t = spark.createDataFrame(rows, "text string, template int, label string, exact boolean").withColumn("w", F.split("text", " "))
    pairs = F.zip_with(F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"), lambda a, b: F.xxhash64(a, b))
    t = t.withColumn("g", F.when(F.col("template") >= 0, pairs).otherwise(F.array(F.lit(0).cast("long"))))
    return t.select("template", "label", "exact", F.size("g").alias("pairs"), F.posexplode("g").alias("j", "gram"))


def scan(docs: DataFrame, phrases=None, notices=None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans for each row of ``docs``.

    Texts are read whole, A-Z in lower case; a null text is empty. n_base counts the places of the exact
    phrases, first_word and last_word are their least and greatest start (else null). labels has the labels
    of verified notices besides; spans lists them as ``label:first word:last word``. score is 1 where a
    phrase stands, else the cover of the best verified notice, else 0. Rows alike in doc_id and text have
    one result each. Templates are a fixed list, so their table is broadcast.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = docs.select("doc_id", F.xxhash64(text).alias("h"), F.regexp_extract_all(low, F.lit(WORD), F.lit(0)).alias("w"))
    pairs = F.zip_with(F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"), lambda a, b: F.xxhash64(a, b))
    grams = F.when(F.size("w") > 1, F.concat(F.array(F.lit(0).cast("long")), pairs)).otherwise(F.array(F.lit(0).cast("long")))
    rows = words.select("doc_id", "h", F.size("w").cast("long").alias("n_words"), F.posexplode(grams).alias("p", "gram"))
    key = ["doc_id", "h", "n_words"]
    # position 0 is the text itself, which meets template -1: it carries the row through, whatever is found
    hits = rows.join(F.broadcast(template_positions(spark, phrases, notices)), "gram").where((F.col("p") == 0) == (F.col("template") < 0))
    votes = hits.groupBy(*key, "template", "label", "exact", "pairs", (F.col("p") - 1 - F.col("j")).alias("diagonal")).agg(
        F.bit_or(F.expr("shiftleft(1L, j)")).alias("seen"), (F.min("p") - 1).alias("lo"), F.max("p").alias("hi"), F.count(F.lit(1)).alias("copies")
    )
    full = F.bit_count("seen") == F.col("pairs")
    by = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > DRIFT, F.lit(True))
    merged = votes.withColumn("run", F.sum(apart.cast("int")).over(by)).withColumn("place", F.when(F.col("exact") & full, F.col("diagonal")))
    spans = merged.groupBy(*key, "template", "label", "exact", "pairs", "run").agg(
        F.bit_or("seen").alias("seen"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.max("copies").alias("copies"),
        F.count("place").alias("places"),
        F.min("place").alias("first"),
        F.max("place").alias("last"),
    )
    cover = F.bit_count("seen") / F.col("pairs")
    found = F.col("template") >= 0
    notice = found & ~F.col("exact") & (cover >= COVER)
    phrase = found & F.col("exact") & (F.col("places") > 0)
    out = spans.groupBy(*key).agg(
        F.max(F.when(~found, F.col("copies"))).alias("copies"),
        F.coalesce(F.sum(F.when(phrase, F.col("places"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(phrase, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(phrase, F.col("last"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(phrase, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(phrase | notice, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(phrase, F.lit(1.0)).when(notice, cover)), F.lit(0.0)).alias("score"),
        F.array_join(F.array_sort(F.collect_set(F.when(notice, F.concat_ws(":", "label", "lo", "hi")))), ",").alias("spans"),
    )
    return out.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)"))).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
