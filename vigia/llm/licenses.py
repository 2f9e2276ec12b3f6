"""License scan by diagonal voting, in DataFrame functions only.

1. All rolling word k-grams of a text are joined by hash (and checked by words)
   to their places in the templates: a match votes for its diagonal, the word
   place at which the template would start.
2. Votes are counted per document, template and diagonal, as a set of template
   places, so neither repeated rows nor repeated phrases count twice.
3. Neighbouring diagonals of a long template (words put in or left out) are
   merged; the merged span is verified by the share of the template it covers
   and by its length.  A short phrase is exact: its diagonal needs every vote.

A text is read once; documents without any match come through on a row of
their own, so there is no join back to the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .rows import text_or_empty

#: Base phrases and their labels (fixed values).
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Notices and their labels: opening words of well-known license texts.
NOTICES = [
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
     "general public license as published by the free software foundation", "lgpl"),
    ("under the terms of the gnu affero general public license as published by the free software foundation", "agpl"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", "apache"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
    ("boost software license version 1 0", "boost"),
    ("eclipse public license v 2 0", "epl"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("creative commons zero v1 0 universal", "cc0"),
]

#: Words of a k-gram; template places are votes of a 64-bit set.
K, MAX_PLACES = 2, 62
#: Diagonals apart that are merged; share of a notice's k-grams that verifies a span.
DRIFT, COVER = 3, 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything that is no word character, after A-Z are lowered.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lowered.  On pure ASCII ``lower`` does just that."""
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def template_grams(spark: SparkSession, phrases: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    """(gram, first, second, template, place, places, exact, label) of the
    rolling k-grams of the templates: bounded by the lists."""
    rows = []
    for i, (text, label) in enumerate([*phrases, *notices]):
        w = text.split()
        grams = list(zip(w, w[1:], strict=False))
        if not 1 <= len(grams) <= MAX_PLACES:
            raise ValueError(f"a template has {K} to {MAX_PLACES + 1} words: {text}")
        rows += [(a, b, i, p, len(grams), i < len(phrases), label) for p, (a, b) in enumerate(grams)]
    grams = spark.createDataFrame(rows, "first string, second string, template int, place int, places int, "
                                        "exact boolean, label string")
    return grams.withColumn("gram", F.xxhash64("first", "second"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base (places of the phrases),
    first_word, last_word (smallest and largest start of them, else null),
    base_labels, labels (distinct, sorted, comma-joined; labels include those
    of verified notices), score (1 with a phrase, else the best share of a
    notice that is covered), spans (label, first and last word of every phrase
    and verified notice).

    Null texts are read as empty: no words, empty labels.  Rows that repeat an
    id and its text are returned as often, with the same result; rows that
    share an id (also null) but not the text are told apart by a hash of it.
    An empty table gives no rows; other columns are not read."""
    text = text_or_empty(text_col)
    split = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                        words(text).alias("w"))
    # place i: words i and i + 1; the last word's place closes the list and always comes through
    n = F.size("w")
    grams = split.select(
        "doc_id", "text_hash", n.alias("n_words"),
        F.posexplode_outer(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.greatest(n, F.lit(1))).alias("b")))
        .alias("at", "g"))
    closing = F.coalesce(F.col("at") == F.col("n_words") - 1, F.lit(True))
    keyed = grams.select("doc_id", "text_hash", "n_words", "at", closing.alias("closing"),
                         F.col("g.a").alias("a"), F.col("g.b").alias("b"),
                         F.xxhash64("g.a", "g.b").alias("gram"))
    known = template_grams(docs.sparkSession, phrases, notices)
    hit = keyed.join(F.broadcast(known), (keyed["gram"] == known["gram"]) & (keyed["a"] == known["first"])
                     & (keyed["b"] == known["second"]) & ~keyed["closing"], "left")
    votes = (hit.where("closing or template is not null")
             .select("doc_id", "text_hash", "n_words", F.coalesce("template", F.lit(-1)).alias("template"),
                     F.coalesce(F.col("at") - F.col("place"), F.lit(0)).alias("diagonal"),
                     "places", "exact", "label", F.col("at").alias("at"),
                     F.when(F.col("template").isNotNull(),
                            F.expr("shiftleft(1L, place)")).alias("vote"), "closing"))
    diagonals = (votes.groupBy("doc_id", "text_hash", "template", "diagonal")
                 .agg(F.max("n_words").alias("n_words"), F.max("places").alias("places"),
                      F.max("exact").alias("exact"), F.max("label").alias("label"),
                      F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.bit_or("vote").alias("votes"),
                      F.sum(F.when(F.col("closing"), 1).otherwise(0)).alias("copies")))
    # neighbouring diagonals of a notice: one span.  Window groups are bounded by a document's length.
    by = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("exact") | (F.col("template") < 0)
                       | (F.col("diagonal") - F.lag("diagonal").over(by) > DRIFT), F.lit(True))
    spans = (diagonals.withColumn("apart", apart)
             .withColumn("span", F.sum(F.when(F.col("apart"), 1).otherwise(0)).over(by))
             .groupBy("doc_id", "text_hash", "template", "span")
             .agg(F.max("n_words").alias("n_words"), F.max("places").alias("places"), F.max("exact").alias("exact"),
                  F.max("label").alias("label"), F.min("first_at").alias("start"),
                  (F.max("last_at") + 1).alias("end"), F.bit_or("votes").alias("votes"),
                  F.sum("copies").alias("copies")))
    share = F.bit_count("votes") / F.col("places")
    fits = F.col("end") - F.col("start") <= F.col("places") + 1 + DRIFT * 2
    verified = F.coalesce(F.when(F.col("exact"), F.bit_count("votes") == F.col("places"))
                          .otherwise((share >= COVER) & fits), F.lit(False))
    base = F.col("verified") & F.col("exact")
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    out = (spans.withColumn("verified", verified).withColumn("share", F.coalesce(share, F.lit(0.0)))
           .groupBy("doc_id", "text_hash")
           .agg(F.max("n_words").cast("long").alias("n_words"),
                F.sum(F.when(base, 1).otherwise(0)).cast("long").alias("n_base"),
                F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
                F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
                join(F.when(base, F.col("label"))).alias("base_labels"),
                join(F.when(F.col("verified"), F.col("label"))).alias("labels"),
                F.max(F.when(F.coalesce(F.col("exact"), F.lit(False)) & ~F.col("verified"), F.lit(0.0))
                      .otherwise(F.least("share", F.lit(1.0)))).alias("score"),
                F.array_sort(F.collect_set(F.when(F.col("verified"), F.struct("start", "end", "label"))))
                .alias("spans"),
                F.sum("copies").alias("copies")))
    return (out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .drop("copy", "copies", "text_hash"))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return scan(docs, id_col, text_col).drop("spans")
