"""License scans by diagonal voting.

Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the text with A-Z in lower case.  Rolling word k-grams
of every document are joined with the k-gram positions of the templates (joined by hash, verified word by word).
A hit votes for the diagonal document position - template position.  Votes are counted per diagonal;
neighbouring diagonals (up to ``SLACK`` apart: a word more or less) are merged into a span, whose coverage is the
share of the template's k-grams that it holds.

* Phrases (``PHRASES``) are templates that count where one diagonal holds all their k-grams, that is, where the
  phrase's words stand consecutively.
* Longer notices (``NOTICES``) give their label where a merged span covers at least ``COVERAGE`` of them.

The templates are parameters of fixed size, so their table is broadcast.  No text is shuffled: a document's row and
its hits leave the scan as narrow rows.

Defined cases: null or empty text, or text without words, has 0 words, no label and score 0; repeated rows (doc_id
and text) each get their own, equal result; a null doc_id is scanned like any other; an empty table gives an empty
result; other columns are ignored."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabscope.llm.common import ascii_lower, narrow

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVERAGE = 0.6
SLACK = 3

# Phrases and the labels they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# The opening words of public licenses and notices, and the labels they give.
NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction": "mit",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at": "apache",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation": "gpl",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
    "General Public License as published by the Free Software Foundation": "lgpl",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl",
    "This is free and unencumbered software released into the public domain": "unlicense",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
}


def words_of(text: str) -> list[str]:
    return [w for w in re.split(GAP, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if w]


def template_table(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """``(template, base, label, total, k, at, gram, h)``: the k-gram positions of all templates; k is 2 for
    phrases, 3 for notices."""
    rows = []
    for i, (text, label, base) in enumerate([(t, x, True) for t, x in phrases.items()] + [(t, x, False) for t, x in notices.items()]):
        w, k = words_of(text), 2 if base else 3
        rows += [(i, base, label, len(w) - k + 1, k, p, " ".join(w[p:p + k])) for p in range(len(w) - k + 1)]
    return spark.createDataFrame(rows, "template int, base boolean, label string, total int, k int, at int, gram string") \
        .withColumn("h", F.xxhash64("gram"))


def _grams(k: int, first: list[str]) -> Column:
    """Structs (pos, gram, k) of the rolling k-grams of the array ``words``; those whose first word begins no
    template's k-gram can't join and aren't made."""
    starts = F.when(F.size("words") >= k, F.sequence(F.lit(0), F.size("words") - k)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(starts, lambda p: F.get(F.col("words"), p).isin(first))

    def gram(p):
        text = F.concat_ws(" ", F.slice(F.col("words"), p + 1, k))
        return F.struct(p.alias("pos"), text.alias("gram"), F.lit(k).alias("k"))
    return F.transform(starts, gram)


def hits(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row for each document (template null, pos the number of words) and one for each k-gram that stands in a
    template: ``(doc_id, text_hash, pos, template, base, label, total, at)``."""
    docs = narrow(docs, "doc_id", "text")
    words = F.filter(F.split(ascii_lower(F.coalesce("text", F.lit(""))), GAP), lambda w: w != "")
    own = F.array(F.struct(F.size("words").alias("pos"), F.lit("").alias("gram"), F.lit(0).alias("k")))
    x = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words.alias("words"))
    first = [sorted({w for t in texts for w in words_of(t)[:len(words_of(t)) - k + 1]}) for texts, k in ((phrases, 2), (notices, 3))]
    grams = [_grams(k, f) for f, k in zip(first, (2, 3), strict=True) if f]
    x = x.select("doc_id", "text_hash", F.inline(F.concat(own, *grams))).withColumn("h", F.xxhash64("gram"))
    t = F.broadcast(template_table(docs.sparkSession, phrases, notices)).withColumnsRenamed({"gram": "_gram", "h": "_h", "k": "_k"})
    same = (F.col("h") == F.col("_h")) & (F.col("gram") == F.col("_gram")) & (F.col("k") == F.col("_k"))
    return x.join(t, same, "left").where("template IS NOT NULL OR k = 0").select(
        "doc_id", "text_hash", "pos", "template", "base", "label", "total", "at")


def spans(found: DataFrame) -> DataFrame:
    """Merged diagonals: ``(doc_id, text_hash, template, base, label, total, first, last, votes)``."""
    votes = found.where("template IS NOT NULL").withColumn("diagonal", F.col("pos") - F.col("at"))
    key = ["doc_id", "text_hash", "template", "base", "label", "total"]
    line = votes.groupBy(*key, "diagonal").agg(F.collect_set("at").alias("ats"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    by = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    fresh = F.col("base") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > SLACK, F.lit(True))
    line = line.withColumn("span", F.sum(fresh.cast("int")).over(by))
    return line.groupBy(*key, "span").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min("diagonal").alias("diagonal"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("votes"))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES,
         coverage: float = COVERAGE) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for each document."""
    found = hits(docs, phrases, notices)
    rows = found.where("template IS NULL").groupBy("doc_id", "text_hash").agg(
        F.max("pos").cast("long").alias("n_words"), F.count("*").alias("_times"))
    s = spans(found).withColumn("share", F.col("votes") / F.col("total"))
    whole = F.col("base") & (F.col("votes") == F.col("total"))
    own = s.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text")).agg(
        F.sum(whole.cast("long")).alias("n_base"), F.min(F.when(whole, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(whole, F.col("label")))).alias("base"),
        F.array_sort(F.collect_set(F.when(whole | (~F.col("base") & (F.col("share") >= coverage)), F.col("label")))).alias("all"),
        F.max(F.when(F.col("base"), whole.cast("double")).otherwise(F.col("share"))).alias("score"))
    out = rows.join(own, rows["doc_id"].eqNullSafe(own["_id"]) & rows["text_hash"].eqNullSafe(own["_text"]), "left")
    text = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
                      text("base").alias("base_labels"), text("all").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
                      F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("_turn")).drop("_turn")
