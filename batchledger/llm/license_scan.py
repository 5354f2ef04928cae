"""License scan by diagonal voting.

Words are runs of digits, a-z and non-ASCII characters after lower-casing A-Z. The two-word grams
of every document are joined by hash to the grams of the templates (a fixed, broadcast table) and
compared word by word. A hit votes for its diagonal, document position minus template position.
A diagonal with a vote from every gram of its template is that phrase, word for word, starting at
the diagonal: that is how the base phrases are found. For all templates a diagonal is merged with
those up to ``DRIFT`` behind it, which allows for words put in, and the span is verified: it has to
hold at least ``COVERAGE`` of the template's different grams. A span thus never grows beyond the
template and ``DRIFT`` words, and a gram that is repeated counts once.

Defined results: null text counts as empty; a text without words or hits has no labels, null
first and last word, and score 0; repeated rows give a row each; texts of any length are scanned whole; of
equally good spans any counts. The score is the best coverage. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import text_or_empty

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Sentences by which the method finds further labels.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "creative commons attribution license": "cc-by",
    "released into the public domain": "public-domain",
}
DRIFT = 2
COVERAGE = 0.8
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _templates(spark: SparkSession, base: dict[str, str], others: dict[str, str]) -> DataFrame:
    rows = []
    for number, (phrase, label) in enumerate([*base.items(), *others.items()]):
        words = phrase.split()
        if len(words) < 2:
            raise ValueError(f"a template needs two words: {phrase!r}")
        rows += [(number, label, number < len(base), len(words) - 1, i, a, b) for i, (a, b) in enumerate(zip(words, words[1:]))]
    grams = spark.createDataFrame(rows, "template int, label string, is_base boolean, grams int, at int, t1 string, t2 string")
    return grams.withColumn("gram", F.xxhash64("t1", "t2"))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _UPPER.lower()), _BETWEEN), "")


def scan(docs: DataFrame, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", words_of(text_or_empty()).alias("_words"))
    grams = F.transform("_words", lambda w, i: F.struct(i.alias("at"), w.alias("w1"), F.get("_words", i + 1).alias("w2")))
    # Every document keeps its first gram, so that one without hits still has a row.
    spread = rows.select("_row", "doc_id", F.size("_words").cast("bigint").alias("n_words"), F.explode_outer(grams).alias("g"))
    spread = spread.select("_row", "doc_id", "n_words", F.col("g.at").alias("pos"), "g.w1", "g.w2").withColumn("gram", F.xxhash64("w1", "w2"))
    table = F.broadcast(_templates(spark, base, templates)).alias("t")
    same = (F.col("s.gram") == F.col("t.gram")) & (F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2"))
    hits = spread.alias("s").join(table, same, "left").filter("template IS NOT NULL OR pos IS NULL OR pos = 0")
    own = ["_row", "doc_id", "n_words"]
    kind = ["template", "label", "is_base", "grams"]
    diagonals = hits.groupBy(*own, *kind, (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count("template").alias("votes"), F.collect_set("at").alias("places")  # as many as the template has grams
    )
    # A span is a diagonal and those up to DRIFT behind it: places of the template met on any of them.
    near = Window.partitionBy("_row", "template").orderBy("diagonal").rangeBetween(0, DRIFT)
    exact = F.col("is_base") & (F.col("votes") == F.col("grams"))
    merged = (
        diagonals.withColumn("_met", F.size(F.array_distinct(F.flatten(F.collect_list("places").over(near)))))
        .groupBy(*own, *kind)
        .agg(
            F.max("_met").alias("met"),
            *[f(F.when(exact, v)).alias(n) for n, f, v in (("n_base", F.count, F.lit(1)), ("first_word", F.min, F.col("diagonal")), ("last_word", F.max, F.col("diagonal")))],
        )
    )
    coverage = F.col("met") / F.col("grams")
    fits = coverage >= COVERAGE
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = F.col("n_base") > 0
    return merged.groupBy(*own).agg(
        F.sum("n_base").alias("n_base"),
        F.min("first_word").cast("bigint").alias("first_word"),
        F.max("last_word").cast("bigint").alias("last_word"),
        joined(F.when(found, F.col("label"))).alias("base_labels"),
        joined(F.when(found | fits, F.col("label"))).alias("labels"),
        F.max(F.when(found, 1.0).when(fits, coverage).otherwise(0.0)).alias("score"),
    ).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", F.coalesce("score", F.lit(0.0)).alias("score"))
