"""License notices found by diagonal voting.

All rolling runs of words (k-grams) of the documents are joined to the places
where notices hold the same k-gram. A hit at word i of a document and word j of
a notice votes for the diagonal i - j: a notice quoted word by word has all its
votes on one diagonal. Words put in or left out shift the rest to a diagonal
close by, so neighbouring ones are merged. A merged span counts if it holds
enough of the notice's k-grams within a stretch that is not much longer.

Only functions of DataFrames: a document is unfolded into its words inside the
stage that reads it, the join keeps what hits a notice, and votes are combined
before they are shuffled. No task sees more of a group than one document.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Notice:
    """A text to look for. A ``base`` notice is a phrase that counts wherever it stands word by word."""

    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall("[a-z0-9]+", self.text.lower())


# The phrases, and sentences of well-known notices.
PHRASES = (
    Notice("cc-by", "cc by", base=True),
    Notice("gpl", "general public license", base=True),
    Notice("reserved", "all rights reserved", base=True),
)
NOTICES = (
    Notice("apache-2", "Licensed under the Apache License, Version 2"),
    Notice("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Notice("cc-by-nc", "Licensed under CC BY-NC 4"),
    Notice("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Notice("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    Notice("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    Notice("mit", "Released under the MIT License"),
    Notice("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    Notice("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 3
#: Diagonals this far apart are one span; less in short notices.
GAP = 3
#: Share of a notice's k-grams that a span must hold, and its longest stretch as a multiple of the notice.
SHARE = 0.6
STRETCH = 1.5
#: Words of all notices together, up to which their table is broadcast.
BROADCAST_WORDS = 100_000
_BITS = 60
_WHOLE = -1


def gap_of(words: int, gap: int) -> int:
    """Merging must not reach the next copy of a short notice."""
    return min(gap, words // 4)


def _grams(spark: SparkSession, notices: Sequence[Notice], k: int, gap: int) -> DataFrame:
    """One row per k-gram of every notice, and one that stands for the document itself."""
    rows = [F.struct(F.lit("").alias("gram"), F.lit("").alias("first"), F.lit("").alias("second"), *[F.lit(v).alias(n) for n, v in (("notice", _WHOLE), ("at", 0), ("k", 1))])]
    facts = []
    for number, notice in enumerate(notices):
        words = notice.words
        if len(words) < 2:
            raise ValueError(f"a notice needs two words: {notice.text!r}")
        size = min(k, len(words))
        facts.append((number, notice, len(words), len(words) - size + 1))
        for at in range(len(words) - size + 1):
            gram = words[at : at + size]
            numbers = (("notice", number), ("at", at), ("k", size))
            rows.append(F.struct(F.lit(" ".join(gram)).alias("gram"), F.lit(gram[0]).alias("first"), F.lit(gram[1]).alias("second"), *[F.lit(v).alias(n) for n, v in numbers]))
    grams = spark.range(1).select(F.inline(F.array(*rows)))
    about = F.array(
        F.struct(F.lit(_WHOLE).alias("notice"), F.lit("").alias("label"), F.lit(False).alias("base"), F.lit(1).alias("words"), F.lit(1).alias("grams"), F.lit(0).alias("gap")),
        *[
            F.struct(F.lit(i).alias("notice"), F.lit(n.label).alias("label"), F.lit(n.base).alias("base"), F.lit(w).alias("words"), F.lit(g).alias("grams"), F.lit(0 if n.base else gap_of(w, gap)).alias("gap"))
            for i, n, w, g in facts
        ],
    )
    return grams.join(F.broadcast(spark.range(1).select(F.inline(about))), "notice")


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; none for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # Lower case of other letters would change words; plain texts are the usual case and much faster.
    plain = F.octet_length(text) == F.char_length(text)
    return F.regexp_extract_all(F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)), F.lit(WORD), F.lit(0))


def scan(
    docs: DataFrame,
    notices: Sequence[Notice] = PHRASES + NOTICES,
    k: int = GRAM,
    gap: int = GAP,
    share: float = SHARE,
    stretch: float = STRETCH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Spans of notices in every document: one row per document and span, and one with notice -1 per document.

    Columns: doc_id, n_words, copies (rows of this id and text; in the row with
    notice -1 only), notice (place in ``notices``), label, base, first_word,
    last_word, found (share of the notice's k-grams) and counts (whether the
    span is accepted). See ``license_labels`` for one row per document.
    """
    notices = list(notices)
    spark = docs.sparkSession
    grams = _grams(spark, notices, k, gap).withColumn("key", F.xxhash64("first", "second")).drop("first", "second")
    if sum(len(n.words) for n in notices) <= BROADCAST_WORDS:
        grams = F.broadcast(grams)
    text = docs[text_col].cast("string")
    # An empty word in front stands for the document, so that one without any hit stays.
    words = docs.select(
        docs[id_col].alias("doc_id"), F.xxhash64(text).alias("mark"), F.coalesce(F.octet_length(text), F.lit(-1)).alias("bytes"), F.concat(F.array(F.lit("")), words_of(text)).alias("words")
    )
    doc = ["doc_id", "mark", "bytes", "n_words"]
    here = words.select("doc_id", "mark", "bytes", (F.size("words") - 1).cast("bigint").alias("n_words"), "words", F.posexplode("words").alias("place", "first"))
    run = [F.col("first"), *[F.get("words", F.col("place") + i) for i in range(1, max(k, 2))]]
    here = here.select(
        *doc, (F.col("place") - 1).alias("place"), F.xxhash64("first", F.when(F.col("first") == "", "").otherwise(run[1])).alias("key"), *[c.alias(f"w{i}") for i, c in enumerate(run)]
    )
    same = F.lit(False)
    for size in {min(k, len(n.words)) for n in notices} | {1}:
        same |= (F.col("k") == size) & (F.col("gram") == F.concat_ws(" ", *[f"w{i}" for i in range(size)]))
    # The key holds two words; what follows, and the words themselves, are compared inside the join.
    hits = here.alias("d").join(grams.alias("t"), (F.col("d.key") == F.col("t.key")) & same)
    # Votes of a diagonal: one bit per place of the notice, so that repeated rows of a document change nothing.
    diagonal = F.when(F.col("notice") == _WHOLE, 0).otherwise(F.col("place") - F.col("at"))
    votes = hits.groupBy(*doc, "notice", "label", "base", "words", "grams", "gap", diagonal.alias("diagonal"), F.floor(F.col("at") / _BITS).alias("part")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at") % _BITS)).alias("places"),
        F.min("place").alias("first_word"),
        F.max(F.col("place") + F.col("k") - 1).alias("last_word"),
        F.count("*").alias("rows"),
    )
    about = ["notice", "label", "base", "words", "grams", "gap"]
    along = Window.partitionBy(*doc, *about).orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > F.col("gap")).cast("int"), F.lit(0))
    votes = votes.withColumn("_apart", apart).withColumn("span", F.sum("_apart").over(along.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = votes.groupBy(*doc, *about, "span", "part").agg(F.bit_or("places").alias("places"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.max("rows").alias("rows"))
    spans = parts.groupBy(*doc, *about, "span").agg(
        F.sum(F.bit_count("places")).alias("hit"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.max("rows").alias("rows")
    )
    found = F.col("hit") / F.col("grams")
    length = F.col("last_word") - F.col("first_word") + 1
    counts = F.when(F.col("base"), F.col("hit") == F.col("grams")).otherwise((found >= share) & (length <= F.col("words") * F.lit(stretch)))
    return spans.select(
        *doc,
        F.when(F.col("notice") == _WHOLE, F.col("rows")).alias("copies"),
        "notice",
        "label",
        "base",
        F.col("first_word").cast("bigint").alias("first_word"),
        F.col("last_word").cast("bigint").alias("last_word"),
        found.alias("found"),
        counts.alias("counts"),
    )


def license_labels(docs: DataFrame, **options: object) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts all places where a base phrase stands word by word, with
    the first and the last of their first words (words from 0; null without
    any). Labels are distinct, sorted and joined by commas, empty without any;
    ``labels`` also has those of other notices. ``score`` is the largest share
    of a notice found in one span, from 0 to 1.

    Null and empty texts have no words and no labels. Texts are taken whole,
    however long. Repeated rows give a row each, rows of one id with different
    texts are told apart, a null id stays null, an empty table gives none and
    other columns are not looked at. ``options`` are those of ``scan``.
    """
    spans = scan(docs, **options)
    listed = F.col("counts") & (F.col("notice") != _WHOLE)
    base = listed & F.col("base")

    def labels(where: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(where, F.col("label")))), ",")

    rows = spans.groupBy("doc_id", "mark", "bytes", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(listed).alias("labels"),
        F.coalesce(F.max(F.when(F.col("notice") != _WHOLE, F.col("found"))), F.lit(0.0)).alias("score"),
        F.max("copies").alias("copies"),
    )
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(columns)
