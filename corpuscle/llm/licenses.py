"""License notices in texts: an exact set-similarity join with templates.

A template is the set of the words of a notice.  A block is a run of words of a text, taken
as the set of its words, wherever its lines end: for templates of up to R words (R one of
``SIZES``) blocks hold 2 R words and start at every R-th, so that any R words in a row lie
whole in one block.  A block carries a template when it holds at least the share
``threshold`` of the template's words and, word by word, one of the phrases that tell the
licence from others (its name with its version, or an opening clause).

Words are ordered by the number of blocks of the corpus they occur in, rare ones first.  If
a block b holds ``need`` words of a template t, then one of the first ``|t| - need + 1``
words of t is among the first ``|b| - need + 1`` words of b (prefix filter), b has at least
``need`` words (length filter), and no more words can follow a common word than either side
has left (positional filter).  Pairs that pass are checked exactly, and last for a phrase.

All blocks of all texts are counted and joined, those without a phrase too.  Words of no
template are in no overlap and are left out as texts are read, which keeps the join exact and
makes the order one over the templates' words.  Column expressions throughout; no Python on
executors.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.binding import bind
from corpuscle.llm.common import ascii_lower, without
from corpuscle.session import stage

THRESHOLD = 0.8

# Phrases and labels of the base rule.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

SIZES = (16, 64)  # words of a template, at most

# Notices as they stand in texts: label, words, and phrases of which one must stand there word by word.
TEMPLATES = (
    ("mit", "Released under the MIT License", ("the mit license", "under mit license")),
    ("mit", "SPDX-License-Identifier: MIT", ("spdx license identifier mit",)),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction",
     ("permission is hereby granted free of charge",)),
    ("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license version 2", "apache license 2")),
    ("apache-2", "SPDX-License-Identifier: Apache-2.0", ("license identifier apache 2",)),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3",
     ("general public license version 3", "general public license v3")),
    ("gpl-3", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
              "Free Software Foundation, either version 3 of the License, or any later version",
     ("either version 3 of the license",)),
    ("gpl-3", "SPDX-License-Identifier: GPL-3.0", ("license identifier gpl 3",)),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2",
     ("general public license version 2", "general public license v2")),
    ("gpl-2", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
              "Free Software Foundation, either version 2 of the License, or any later version",
     ("either version 2 of the license",)),
    ("gpl-2", "SPDX-License-Identifier: GPL-2.0", ("license identifier gpl 2",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc 4", "cc by nc 3", "cc by nc 2")),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ("commons attribution noncommercial 4", "commons attribution noncommercial 3")),
    ("cc-by", "Licensed under CC BY 4.0", ("cc by 4", "cc by 3", "cc by 2")),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ("commons attribution 4", "commons attribution 3")),
    ("bsd", "Released under the BSD License", ("the bsd license", "under bsd license")),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("all-rights-reserved", "All rights reserved", ("all rights reserved",)),
)


def _split(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def words_of(text: str) -> list[str]:
    """Distinct words of a template, as the blocks are split."""
    return list(dict.fromkeys(_split(text)))


def size_of(notice: str) -> int:
    """The size of blocks, in words, that a template is looked for in."""
    return next(size for size in SIZES if len(_split(notice)) <= size)


def _base(norm: Column, n_words: Column, phrases) -> dict[str, Column]:
    """Places of the phrases in ``norm``, the words with one space around each."""
    counts, firsts, lasts, labels = [], [], [], []
    doubled = F.replace(norm, F.lit(" "), F.lit("  "))  # so that neighbouring places share no space
    size = lambda piece: F.size(F.regexp_extract_all(piece, F.lit("[^ ]+"), F.lit(0)))
    for phrase, label in phrases:
        there = F.contains(norm, F.lit(f" {phrase} "))
        parts = F.split(doubled, f" {phrase.replace(' ', '  ')} ", -1)
        counts.append(F.when(there, F.size(parts) - 1).otherwise(0).cast("long"))
        firsts.append(F.when(there, size(parts[0]).cast("long")))
        lasts.append(F.when(there, n_words - size(F.element_at(parts, -1)) - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    return {
        "n_base": sum(counts[1:], counts[0]), "first_word": F.least(*firsts), "last_word": F.greatest(*lasts),
        "base_labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }


def scan(
    docs: DataFrame, text: str = "text", templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` without ``text``, with n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    ``labels`` joins the base labels and those of the templates found, ``score`` is the
    largest share of a template found in one block, 1 where a base phrase stands, else
    0, and ``blocks`` holds number of the line, label and share of every hit, in order.
    A null text is an empty one.  Repeated rows are told apart and get equal results;
    an empty table gives no rows; input columns named like an output are replaced.

    The corpus is read once; what is kept of it, the templates' words of every block that has
    one, is written to the shared folder and serves both the word counts and the join.  The
    templates are an argument, so they, their words and their index are of known size.
    """
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks")
    own = without(docs, text, "row", *added)
    sets = [(label, words_of(notice), tuple(marks), size_of(notice)) for label, notice, marks in templates]
    every_mark = list(dict.fromkeys(mark for _, _, marks, _ in sets for mark in marks))

    norm = F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    rows = docs.select(*[F.col(f"`{c}`") for c in own.columns], norm.alias("__norm"))
    rows = rows.withColumn("n_words", F.when(F.col("__norm") == "", 0).otherwise(
        F.char_length("__norm") - F.char_length(F.replace("__norm", F.lit(" "), F.lit(""))) + 1
    ).cast("long")).withColumn("__norm", F.concat(F.lit(" "), "__norm", F.lit(" ")))

    def has(run: Column, mark: str) -> Column:
        return F.contains(run, F.lit(f" {mark} "))

    def blocks_of(size: int) -> Column:
        """Blocks: size, number, the templates' words, if there are any, and the phrases that stand there."""
        marks = list(dict.fromkeys(mark for _, _, marks, s in sets if s == size for mark in marks))
        words = F.array(*[F.lit(w) for w in sorted({w for _, own_words, _, s in sets if s == size for w in own_words})])
        none = F.array().cast("array<string>")
        told = lambda run: F.array_compact(F.array(*[F.when(has(run, mark), F.lit(mark)) for mark in marks]))
        cut = lambda runs: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(runs) - 2, F.lit(0))),
            lambda at: F.struct(
                F.lit(size).alias("size"), at.alias("block"),
                F.array_union(F.coalesce(F.get(runs, at).words, none), F.coalesce(F.get(runs, at + 1).words, none)).alias("words"),
                F.when(F.col("__marked"), told(F.concat(F.lit(" "), F.get(runs, at).run, F.coalesce(F.get(runs, at + 1).run, F.lit("")))))
                .otherwise(none).alias("marks"),
            ),
        )
        runs = F.transform(
            F.regexp_extract_all(F.ltrim("__norm"), F.lit(f"(?:[^ ]++ ){{1,{size}}}"), F.lit(0)),
            lambda run: F.struct(run.alias("run"), F.array_intersect(words, F.split(run, " ")).alias("words")),
        )
        return F.filter(bind(runs, cut), lambda b: F.size(b.words) > 0)

    sizes = sorted({size for *_, size in sets})
    # Of a text without any phrase no block holds one.
    rows = rows.withColumn("__marked", reduce(or_, [has(F.col("__norm"), mark) for mark in every_mark]))
    kept = stage(rows.select(
        F.monotonically_increasing_id().alias("row"), *[F.col(f"`{c}`") for c in own.columns], "n_words",
        *[c.alias(n) for n, c in _base(F.col("__norm"), F.col("n_words"), phrases).items()], F.concat(*[blocks_of(size) for size in sizes]).alias("__blocks"),
    ), "license-words")

    each = kept.select("row", F.inline("__blocks"))
    counted = each.select(F.explode("words").alias("word")).groupBy("word").count().collect()  # one row per template word
    often = {r["word"]: r["count"] for r in counted}
    order = sorted({w for _, words, _, _ in sets for w in words}, key=lambda w: (often.get(w, 0), w))
    index, least = [], {}
    for label, words, marks, reach in sets:
        ordered = [w for w in order if w in words]
        need = max(1, math.ceil(threshold * len(words) - 1e-9))
        least[reach] = min(need, least.get(reach, need))
        for at, word in enumerate(ordered[: len(words) - need + 1]):
            index.append(F.struct(
                F.lit(word).alias("word"), F.lit(label).alias("label"), F.lit(at).alias("at"), F.lit(need).alias("need"),
                F.lit(reach).alias("reach"), F.array(*[F.lit(w) for w in ordered]).alias("template"),
                F.array(*[F.lit(m) for m in marks]).alias("told_by"),
            ))
    prefixes = docs.sparkSession.range(1).select(F.inline(F.array(*index)))
    fewest = F.coalesce(*[F.when(F.col("size") == reach, need) for reach, need in least.items()])
    ranked = each.where(F.size("words") >= fewest).withColumn("words", F.array_intersect(F.array(*[F.lit(w) for w in order]), "words"))
    heads = ranked.select("*", F.posexplode(F.slice("words", F.lit(1), F.size("words") - (fewest - 1))).alias("pos", "word"))
    size, whole = F.size("words"), F.size("template")
    pairs = heads.join(
        F.broadcast(prefixes),
        (heads.word == prefixes.word) & (F.col("size") == F.col("reach")) & (size >= F.col("need")) & (F.col("pos") <= size - F.col("need"))
        & (1 + F.least(whole - F.col("at") - 1, size - F.col("pos") - 1) >= F.col("need")),
    )
    shared = F.size(F.array_intersect("words", "template"))
    hits = pairs.where((shared >= F.col("need")) & F.arrays_overlap("marks", "told_by")).groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("size", "block", "label", (shared / whole).alias("share")))).alias("blocks"),
    )
    found = kept.drop("__blocks").join(hits, "row", "left")
    every = F.coalesce("blocks", F.array().cast("array<struct<size:int,block:int,label:string,share:double>>"))
    return found.withColumn("blocks", every).withColumn(
        "labels", F.array_join(F.array_sort(F.array_union("base_labels", F.transform("blocks", lambda b: b.label))), ","),
    ).withColumn(
        "score", F.greatest(F.coalesce(F.array_max(F.transform("blocks", lambda b: b.share)), F.lit(0.0)),
                            F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)),
    ).withColumn("base_labels", F.array_join("base_labels", ",")).select(*[f"`{c}`" for c in own.columns], *added)
