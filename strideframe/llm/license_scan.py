"""License scan: exact set-similarity join of text blocks and license templates.

A block is a run of ``2 * STRIDE`` consecutive words, starting every
``STRIDE`` words (or as many as the longest template has), so any ``STRIDE + 1`` words in a row lie in one block.  A
template meets a block when at least ``threshold`` of its distinct words are
among the block's.  The join never compares every pair:

* the template words are ordered globally by the number of documents that
  hold them (one aggregate over the whole corpus), rarest first;
* prefix filter: a template of n words that needs o of them shares one of its
  n - o + 1 rarest words with every block that meets it, so only those words
  of a block are joined, and texts without any of them make no block at all;
* length filter: the block must hold at least o template words;
* positional filter: the first shared word, at place i of the template and
  place j of the block, bounds the overlap by 1 + min(words after either);
* the survivors are verified on the full word sets.

Base phrases are templates with threshold 1 whose words must in addition stand
consecutively.  Only built-in DataFrame functions are used.  The templates are
a parameter, so what is broadcast (their words) does not grow with the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.llm.common import read_table

STRIDE = 32


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.8
    #: The words must stand consecutively, and their places are counted.
    phrase: bool = False

    def words(self) -> list[str]:
        return self.text.split()


# Phrases and notices in lower case, words separated by spaces.
BASE = (
    Template("mit", "mit license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
)
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("gpl", "licensed under the gnu general public license version"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0"),
    Template("cc", "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
)
TEMPLATES = BASE + NOTICES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def text_words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; null and wordless texts have none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, _NOT_WORD), "")


def _array(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def word_order(docs: DataFrame, text: str, templates: Sequence[Template]) -> list[str]:
    """The templates' words by the number of rows of ``docs`` that hold them,
    rarest first (ties by the word)."""
    vocab = sorted({w for t in templates for w in t.words()})
    held = docs.select(F.explode(F.array_intersect(_array(vocab), text_words(F.col(text)))).alias("w"))
    n = {r.w: r.n for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return sorted(vocab, key=lambda w: (n.get(w, 0), w))


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, n_blocks.

    n_base counts the places of the phrases, first_word and last_word are the
    smallest and largest place (words from 0, else null); score is the largest
    containment among the templates met (0.0 without any), n_blocks the blocks
    that meet one.  Null, empty and wordless texts have no words and labels
    ''.  Every row gives a row of its own, whatever its id.  Blocks grow with
    the longest template, which always lies within one.  Other columns are
    not read.  An empty table gives no rows.
    """
    stride = max([STRIDE, *(len(t.words()) for t in templates)])
    order = word_order(docs, text, templates)
    rank = {w: i for i, w in enumerate(order)}
    rows, prefixes = [], set()
    for k, t in enumerate(templates):
        words = sorted(set(t.words()), key=rank.__getitem__)
        need = max(1, math.ceil(t.threshold * len(words) - 1e-9))
        for i, w in enumerate(words[:len(words) - need + 1]):
            rows.append((k, w, i, len(words), need, words, t.words(), t.label, t.phrase))
            prefixes.add(w)
    prefix = docs.sparkSession.createDataFrame(
        rows, "t int, w string, i int, size int, need int, t_words array<string>, seq array<string>, "
              "label string, phrase boolean")
    rare = _array([w for w in order if w in prefixes])

    words = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                        text_words(F.col(text)).alias("words"))
    starts = F.when(F.arrays_overlap("words", rare), F.sequence(
        F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(stride)))
    blocks = (words.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), "words",
                           F.explode_outer(starts).alias("start"))
                   .withColumn("block", F.expr(f"slice(words, start + 1, {2 * stride})")).drop("words")
                   .withColumn("held", F.array_intersect(_array(order), "block")))
    # a row per prefix word of a block; texts and blocks without one keep a row with a null word
    marked = F.filter(F.transform("held", lambda w, j: F.struct(w.alias("w"), j.alias("j"))),
                      lambda x: F.array_contains(rare, x["w"]))
    places = blocks.select("doc_id", "row", "n_words", "start", "block", "held",
                           F.explode_outer(marked).alias("x")).select("*", "x.w", "x.j").drop("x")
    joined = places.join(F.broadcast(prefix), "w", "left")
    bound = 1 + F.least(F.col("size") - F.col("i") - 1, F.size("held") - F.col("j") - 1)
    shared = F.size(F.array_intersect("t_words", "held"))
    # the bound holds for the first shared word only
    first = F.element_at(F.array_intersect("t_words", "held"), 1) == F.col("w")
    met = (F.col("t").isNotNull() & (F.size("held") >= F.col("need")) & first
           & (bound >= F.col("need")) & (shared >= F.col("need")))
    own = F.expr(f"filter(sequence(0, {stride - 1}), p -> slice(block, p + 1, size(seq)) = seq)")
    found = joined.select(
        "doc_id", "row", "n_words", F.when(met, F.col("start")).alias("start"), "label", "phrase",
        F.when(met & F.col("phrase"), own).alias("at"),
        F.when(met, shared / F.col("size")).alias("contained"))
    at = F.col("start").cast("long")
    is_base, is_label = F.size("at") > 0, ~F.col("phrase") & F.col("start").isNotNull()
    joined_labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return found.groupBy("doc_id", "row", "n_words").agg(
        F.coalesce(F.sum(F.when(is_base, F.size("at")).cast("long")), F.lit(0).cast("long")).alias("n_base"),
        F.min(F.when(is_base, at + F.array_min("at"))).alias("first_word"),
        F.max(F.when(is_base, at + F.array_max("at"))).alias("last_word"),
        joined_labels(F.when(is_base, F.col("label"))).alias("base_labels"),
        joined_labels(F.when(is_base | is_label, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(is_base | is_label, F.col("contained"))), F.lit(0.0)).alias("score"),
        F.count_distinct(F.when(is_base | is_label, F.col("start"))).cast("long").alias("n_blocks"),
    ).drop("row")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Query: ``license_scan`` of every document."""
    return license_scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
