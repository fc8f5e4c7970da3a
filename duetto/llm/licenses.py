"""License scan by diagonal voting.

All rolling word 3-grams of the documents are joined to the positions of the
same 3-grams in a small table of license templates.  A hit at document word
``d`` and template word ``t`` votes for the diagonal ``d - t``.  Votes are
summed by diagonal, neighbouring diagonals (words inserted or left out) are
merged, and a merged span is reported if it covers enough of its template.

Everything is DataFrame operations.  The template table is a fixed list in this
module, so its broadcast is bounded; what is shuffled is one row a document plus
the hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duetto.llm.common import cut

K = 3                   # words in a gram
MAX_SHIFT = 4           # neighbouring diagonals differ by so many words at most
MIN_COVER = 0.7         # share of a template's grams that a span must cover

#: Phrases that count wherever their words stand consecutively.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

#: Public license notices, as (label, words).
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy "
            "of this software and associated documentation files the software to deal in "
            "the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may "
                 "obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under "
              "the terms of the gnu general public license as published by the free software "
              "foundation either version 3 of the license"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
            "are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 "
                 "international license"),
]

_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text after lower-casing A-Z; null: none.

    ``lower`` also lowers letters beyond A-Z, which changes neither where words
    begin nor any ASCII word, but for the Kelvin sign, which would become a k;
    it is replaced by another letter first.
    """
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e5"))
    return F.array_remove(F.split(F.lower(safe), _NOT_WORD, -1), "")


def _template_rows(phrases: dict[str, str], templates: list[tuple[str, str]]) -> list[tuple]:
    rows = []
    for exact, (label, text) in ([(True, x) for x in phrases.items()]
                                 + [(False, x) for x in templates]):
        words = text.split(" ")
        for t in range(len(words) - K + 1):
            rows.append((len(rows) - t, label, exact, t, len(words) - K + 1, *words[t:t + K]))
    return rows


def template_grams(spark: SparkSession, phrases: dict[str, str] = PHRASES,
                   templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``template, label, exact, t, grams, w0..w2, gram``: one row per position."""
    cols = ["template int", "label string", "exact boolean", "t int", "grams int"]
    cols += [f"w{i} string" for i in range(K)]
    rows = _template_rows(phrases, templates)
    return (spark.createDataFrame(rows, ", ".join(cols))
            .withColumn("gram", F.xxhash64(*[f"w{i}" for i in range(K)])))


#: The gram that every document has once: it keeps documents without a hit.
_EVERY = 0


def license_hits(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """``doc_id, th, n_words, template, label, exact, grams, t, d``: the verified
    hits, and one row with null ``template`` for each row of ``docs``."""
    words = docs.select("doc_id", F.xxhash64("text").alias("th"),
                        words_of(F.col("text")).alias("words"))
    n, d = F.size("words").cast("bigint"), F.col("d")
    marker = grams.limit(1).select(
        *[F.lit(None).cast(t).alias(c) for c, t in grams.dtypes if c != "gram"],
        F.lit(_EVERY).cast("bigint").alias("gram"))
    table = F.broadcast(grams.unionByName(marker))
    # The place after the last word stands for the row itself.
    each = words.select("doc_id", "th", "words", n.alias("n_words"),
                        F.posexplode(F.array_append("words", "")).alias("d", "w")).drop("w")
    last = d == F.col("n_words")
    gram = F.xxhash64(*[F.get(F.col("words"), d + j) for j in range(K)])
    each = (each.filter(last | (d + K <= F.col("n_words")))
            .withColumn("gram", F.when(last, F.lit(_EVERY).cast("bigint")).otherwise(gram)))
    same = F.lit(True)
    for j in range(K):
        same = same & (F.get(F.col("words"), d + j) == F.col(f"w{j}"))
    return (each.join(table, "gram")
            .filter(F.when(F.col("template").isNull(), last).otherwise(same))
            .select("doc_id", "th", "n_words", "template", "label", "exact", "grams", "t", "d"))


def license_spans(hits: DataFrame) -> DataFrame:
    """``doc_id, th, label, exact, start, end, cover``: places of the phrases
    (exact) and spans of the templates, in words, end exclusive.  Of template
    spans that overlap, those with the largest cover are returned."""
    key = ["doc_id", "th", "template"]
    diag = (hits.filter("template is not null")
            .groupBy(*key, "label", "exact", "grams", (F.col("d") - F.col("t")).alias("diag"))
            .agg(F.collect_set("t").alias("ts"), F.min("d").alias("lo"), F.max("d").alias("hi")))
    # A span goes on while the next diagonal is near and its hits are not a full template away.
    order = Window.partitionBy(*key).orderBy("lo", "diag")
    near = ((F.abs(F.col("diag") - F.lag("diag").over(order)) <= MAX_SHIFT)
            & (F.col("lo") - F.lag("lo").over(order) <= F.col("grams") + MAX_SHIFT)
            & (F.col("exact") == F.lit(False)))
    new = F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1)
    runs = (diag.withColumn("new", new)
            .withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    spans = (runs.groupBy(*key, "label", "exact", "grams", "run")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("n"),
                  F.min("lo").alias("start"), (F.max("hi") + K).alias("end")))
    cover = F.col("n") / F.col("grams")
    good = (spans.withColumn("cover", cover)
            .filter(F.when(F.col("exact"), F.col("n") == F.col("grams"))
                    .otherwise(F.col("cover") >= MIN_COVER)))
    # Templates that share words overlap: of spans that overlap, the best covered stay.
    place = Window.partitionBy("doc_id", "th", "exact").orderBy("start", "end", "template")
    before = F.max("end").over(place.rowsBetween(Window.unboundedPreceding, -1))
    return (good.withColumn("new", F.when(F.col("start") < before, 0).otherwise(1))
            .withColumn("isle", F.sum("new").over(place.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("best", F.max("cover").over(
                Window.partitionBy("doc_id", "th", "exact", "isle")))
            .filter("exact or cover = best")
            .select("doc_id", "th", "label", "exact", F.col("start").cast("bigint").alias("start"),
                    F.col("end").cast("bigint").alias("end"), "cover"))


def scan_licenses(docs: DataFrame, grams: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, spans``.

    ``docs`` has ``doc_id`` and ``text``; further columns are ignored.  Base
    figures count the places of the phrases; ``labels`` adds those of template
    spans; ``score`` is the largest cover of a span (1 at a phrase, 0 without
    a span); ``spans`` lists all of them.  A null or empty text has no words;
    repeated rows are each returned; an empty table gives an empty result.
    """
    if grams is None:
        grams = template_grams(docs.sparkSession)
    key = ["doc_id", "th"]
    # Rows that repeat id and text make the same hits: they count once and return as often.
    # Written, since spans and rows are read from it: the texts are read once.
    hits = cut(license_hits(docs, grams)
               .groupBy(*key, "n_words", "template", "label", "exact", "grams", "t", "d")
               .agg(F.count(F.lit(1)).alias("copies")))
    spans = license_spans(hits)
    each = hits.filter("template is null").select(
        *key, "n_words", "copies", F.lit(None).cast("struct<start:bigint,end:bigint,"
                                                     "label:string,exact:boolean,cover:double>")
        .alias("s"))
    found = spans.select(*key, F.lit(None).cast("bigint").alias("n_words"),
                         F.lit(None).cast("bigint").alias("copies"),
                         F.struct("start", "end", "label", "exact", "cover").alias("s"))
    exact, labelled = F.col("s.exact"), F.col("s.label")
    out = each.unionByName(found).groupBy(*key).agg(
        F.max("n_words").alias("n_words"), F.max("copies").alias("copies"),
        F.count(F.when(exact, 1)).alias("n_base"),
        F.min(F.when(exact, F.col("s.start"))).alias("first_word"),
        F.max(F.when(exact, F.col("s.start"))).alias("last_word"),
        F.concat_ws(",", F.sort_array(F.collect_set(F.when(exact, labelled)))).alias("base_labels"),
        F.concat_ws(",", F.sort_array(F.collect_set(labelled))).alias("labels"),
        F.coalesce(F.max("s.cover"), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list("s")).alias("spans"))
    return (out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
            .drop("th", "copies", "_copy"))
