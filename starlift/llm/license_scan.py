"""License scans: exact set-similarity join of text blocks with license templates, in DataFrame functions only.

Blocks are windows of BLOCK words, STRIDE apart, over every whole text; a template's passage of up to
BLOCK - STRIDE words lies in one of them wherever it starts. A block answers a template when it holds at least
CONTAINMENT of the template's distinct words. The join runs inside the row, against the bounded list of templates:

* words are ordered by how often they occur in the whole corpus, rarest first (counted over all documents);
* prefix filter: with need = ceil(CONTAINMENT * m), a match shares one of the template's m - need + 1 rarest words, so
  only documents with such a word are cut into blocks, and only blocks whose own prefix meets the template's go on;
* length filter: a block with fewer template words than ``need`` cannot match;
* positional filter: after the first common word at places i and j, at most 1 + min(m - i, size - j) can be common;
* a block that is near enough must also hold the template's telling words.

Nothing is shuffled but the count of a few dozen words; texts stay in their row. The base phrases are found exactly
at their places. Defined results: null text counts as empty (no words, no labels, score 0); repeated rows give
repeated results.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import lower_ascii, texts

BLOCK = 48
STRIDE = 24
CONTAINMENT = 0.8

#: Phrases whose places are the base, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: License statements as licensors word them (own list): label, statement, and the words that tell it from the
#: statements of other licenses; a block without one of these is no match however much it holds of the rest.
TEMPLATES = [
    ("mit", "released under the mit license", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission granted charge"),
    ("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    ("apache-2", "you may not use this file except in compliance with the license", "not file compliance"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial international license", "creative commons noncommercial"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution source binary"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla 2"),
]

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _strings(xs) -> Column:
    return F.array(*[F.lit(x) for x in xs])


def word_text(docs: DataFrame) -> DataFrame:
    """doc_id and the words of the text joined by single spaces."""
    norm = F.trim(F.regexp_replace(lower_ascii(F.col("text")), _NOT_WORD, " "))
    return texts(docs).select("doc_id", norm.alias("t"))


def _words() -> Column:
    return F.when(F.col("t") == "", F.array().cast("array<string>")).otherwise(F.split("t", " "))


def template_order(rows: DataFrame, templates: list) -> dict[str, int]:
    """Rank of each template word by its count in all documents, rarest first; one row per word reaches the driver."""
    vocabulary = sorted({w for _, t, _ in templates for w in t.split()})
    counts = (rows.select(F.explode(F.split("t", " ")).alias("w")).where(F.col("w").isin(vocabulary))
              .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect())
    n = {r["w"]: r["n"] for r in counts}
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (n.get(w, 0), w)))}


def _hit(block: Column, sets: list[int], need: int, telling: list[int]) -> Column:
    """Share of the template's words in a block (sorted ranks), or null when a filter, the count or a telling word rules it out."""
    m = len(sets)
    own = F.array(*[F.lit(x) for x in sets])
    prefix = F.array(*[F.lit(x) for x in sets[:m - need + 1]])
    first = F.array_min(F.array_intersect(prefix, F.slice(block, 1, F.greatest(F.size(block) - F.lit(need - 1), F.lit(0)))))
    bound = F.lit(1) + F.least(F.lit(m) - F.array_position(own, first), F.size(block) - F.array_position(block, first))
    common = F.size(F.array_intersect(own, block))
    told = F.size(F.array_intersect(F.array(*[F.lit(x) for x in telling]), block)) == len(telling)
    return F.when((F.size(block) >= need) & first.isNotNull(), F.when(bound >= need, F.when((common >= need) & told, common / F.lit(float(m)))))


def scan(docs: DataFrame, containment: float = CONTAINMENT, templates: list | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.

    A template is (label, statement, telling words of the statement). ``n_blocks`` is the number of (block, template) matches; score is 1 with a base phrase, else the best containment.
    """
    templates = templates or TEMPLATES
    rows = word_text(docs)
    rank = template_order(rows, templates)
    sets = [(label, sorted({rank[w] for w in t.split()}), sorted({rank[w] for w in told.split()})) for label, t, told in templates]
    sets = [(label, s, math.ceil(containment * len(s) - 1e-9), told) for label, s, told in sets]
    word_of = {k: w for w, k in rank.items()}
    prefix_words = sorted({word_of[k] for _, s, need, _ in sets for k in s[:len(s) - need + 1]})
    ranks = F.create_map(*[x for w, k in rank.items() for x in (F.lit(w), F.lit(k))])

    padded = F.concat(F.lit(" "), F.col("t"), F.lit(" "))
    rows = rows.withColumn("p", padded).withColumn("words", _words())
    n_words = F.size("words")

    def places(phrase: str) -> Column:
        ws = phrase.split()
        here = reduce(lambda a, b: a & b, [F.lit(True)])
        at = F.filter(F.sequence(F.lit(0), n_words - F.lit(len(ws))),
                      lambda i: reduce(lambda a, b: a & b, [F.get(F.col("words"), (i + F.lit(k)).cast("int")) == w for k, w in enumerate(ws)], here))
        return F.when(F.col("p").contains(f" {phrase} "), at).otherwise(F.array().cast("array<int>"))

    found = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(len(p.split())).alias("w"), places(p).alias("at")) for p, label in PHRASES.items()])
    rows = rows.withColumn("base", found)
    starts = F.flatten(F.transform("base", lambda b: b["at"]))
    base_labels = F.array_sort(F.array_distinct(F.transform(F.filter("base", lambda b: F.size(b["at"]) > 0), lambda b: b["label"])))

    block_ranks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil((n_words - BLOCK) / F.lit(float(STRIDE))), F.lit(0)).cast("int")),
        lambda b: F.array_sort(F.transform(F.array_intersect(F.slice(F.col("words"), b * STRIDE + 1, F.lit(BLOCK)), _strings(sorted(rank))),
                                           lambda w: F.element_at(ranks, w))))
    candidate = F.arrays_overlap(F.col("words"), _strings(prefix_words))
    blocks = F.when(candidate, F.filter(block_ranks, lambda r: F.size(r) >= min(n for _, _, n, _ in sets))).otherwise(F.array().cast("array<array<int>>"))
    rows = rows.withColumn("blocks", blocks)
    matches = F.flatten(F.transform("blocks", lambda r: F.filter(
        F.array(*[F.struct(F.lit(label).alias("label"), _hit(r, s, need, told).alias("share")) for label, s, need, told in sets]),
        lambda x: x["share"].isNotNull())))
    rows = rows.withColumn("matches", matches).withColumn("starts", starts).withColumn("base_list", base_labels)
    labels = F.array_sort(F.array_distinct(F.concat("base_list", F.transform("matches", lambda x: x["label"]))))
    best = F.coalesce(F.array_max(F.transform("matches", lambda x: x["share"])), F.lit(0.0))
    return rows.select(
        "doc_id", n_words.cast("long").alias("n_words"), F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base_list", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(best).cast("double").alias("score"),
        F.size("matches").cast("long").alias("n_blocks"))
