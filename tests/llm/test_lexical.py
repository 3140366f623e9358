"""Ranked search against plain scoring of every document: ties, repeated rows and items, nulls, long texts, blocks of queries."""

import math
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from starlift.llm import lexical  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k):
    counts = [Counter(terms(t)) for _, t in docs]
    n = [sum(c.values()) for c in counts]
    N, L = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for (d, _), c, x in zip(docs, counts, n):
            if x:
                m = 50 + 50 * x * N // L
                s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
                if s > 0:
                    scored.append((-s, d is None, d or 0))
        out += [(str(item_id), rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    common = "the of and to in a is it that for".split()
    rare = [f"word{k}" for k in range(700)] + ["ÉTÉ", "naïve", "東京", "x1", "O'Neil"]
    weights = [1 / (i + 3) for i in range(len(rare))]

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else rng.choices(rare, weights)[0] for _ in range(n))
    docs = [(k, text(rng.randrange(3, 200))) for k in range(420)]
    docs += [(1000 + k, docs[5][1].upper()) for k in range(60)]  # ties beyond k
    docs += [(5, docs[5][1]), (None, docs[5][1]), (None, None), (2000, ""), (2001, "!?"), (2002, text(40000)), (2003, "solo " * 3), (2004, "z" * 2_500_000)]
    rng.shuffle(docs)
    items = [(k, text(rng.randrange(1, 40))) for k in range(25)]
    items += [(100, docs[9][1]), (101, None), (102, "..."), (103, "absent unheard"), (104, "Solo"), (105, "the of and"), (106, text(5) + " word3 " + text(30)), (3, "word1 word2 ÉTÉ"), (None, "word5")]
    items += [(107, next(t for d, t in docs if d == 1000))]
    return docs, items


def run(spark, docs, items, k, **more):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, rank int").repartition(4)
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int").repartition(2)
    return sorted(((str(r["item_id"]), r["rank"], r["doc_id"], r["score"]) for r in lexical.search(d, q, k, **more).collect()), key=str)


def test_search_equals_scoring_all(spark, corpus):
    docs, items = corpus
    assert run(spark, docs, items, 10) == brute(docs, items, 10)


def test_blocks_of_queries_and_small_blocks(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(lexical, "CLUSTER", 32)
    monkeypatch.setattr(lexical, "CELLS", 3000)
    monkeypatch.setattr(lexical, "PIECE_BYTES", 64)
    assert run(spark, docs, items[:18], 50, item_block=7, term_bound=120, block=3) == brute(docs, items[:18], 50)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert run(spark, [], items, 5) == []
    assert run(spark, docs, [], 5) == []
    assert run(spark, docs, [(1, None)], 5) == []


def test_summaries_bound_and_skip(spark, corpus):
    """A block's bound is never below a member's score, and most blocks are skipped."""
    docs, items = corpus
    d = lexical.texts(spark.createDataFrame(docs, "doc_id long, text string"))
    block = {i: [t.encode() for t in sorted(set(terms(x)))] for i, (_, x) in enumerate(items) if terms(x)}
    vectors, q = lexical.prepare(d, block, 5)
    seen = kept = 0
    for row in lexical.build_index(vectors, q, 4).collect():
        c, parts = lexical._restore(row.asDict())
        at = low = 0
        for t, size in zip(parts["blocks"]["term"], parts["blocks"]["size"]):
            weights = q["bounds"][int(t)]
            bound = parts["summaries"]["ratio"][low:low + len(weights)].astype(np.int64) @ weights
            low += len(weights)
            rows = parts["members"]["doc"][at:at + size].astype(np.int64)
            at += size
            for j, item in enumerate(q["lists"][int(t)]):
                assert (c.scores(rows, q["items"][item], q["weight"]) <= bound[j]).all()
        _, a, b = lexical.open_documents(parts, q, lambda i: q["least"].get(i, 0))
        seen, kept = seen + a, kept + b
    assert 0 < kept < seen / 2
