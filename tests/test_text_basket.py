"""Topic labelling, TF-IDF, and basket mining against brute force."""

import itertools

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import basket as B
from starlift.operators import nmf as NMF
from starlift.operators import text as TX

# own topics: three made-up themes and their anchors
THEMES = {"garden": {"soil", "seed"}, "kitchen": {"oven"}, "harbour": {"tide", "ship"}}
TOPICS = [["ship", "rope", "tide", "salt"], ["seed", "rain", "soil"], ["oven", "salt", "flour", "seed"]]


def test_every_order_of_topics_gets_the_same_labels():
    for order in itertools.permutations(range(3)):
        labels = TX.match_topic_labels([TOPICS[k] for k in order], THEMES)
        assert [labels[i] for i in range(3)] == [("harbour", "garden", "kitchen")[k] for k in order]


@pytest.mark.parametrize("topics,fault", [
    (TOPICS[:2] + [["flour"]], "label kitchen: 0 topics"),
    (TOPICS + [["oven"]], "label kitchen: 2 topics"),
    ([TOPICS[0] + ["oven"], TOPICS[1], ["flour"]], "topic 0: 2 labels"),
    (TOPICS + [["moss"]], "topic 3: 0 labels"),
])
def test_labels_and_topics_must_pair_up(topics, fault):
    with pytest.raises(ValueError, match=fault):
        TX.match_topic_labels(topics, THEMES, "m1")


def test_stability_trials_name_the_labels_that_break():
    fits = [TOPICS, TOPICS[:2] + [["flour"]], [TOPICS[0] + ["oven"], TOPICS[1], ["flour"]], TOPICS + [["oven"]]]
    hits = [TX.label_hits(f, THEMES) for f in fits]
    assert [TX.broken_labels(h, list(THEMES)) for h in hits] == [[], ["kitchen"], ["kitchen", "harbour"], ["kitchen"]]
    assert hits[0].tolist() == [[0, 1, 0], [0, 0, 1], [1, 0, 0]]


def test_heaviest_term_equals_the_rows(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a", "c"]), (3, ["b", "a"]), (4, [])], "id long, terms array<string>")
    tf = TX.exploded_counts(TX.counted_terms(docs, "id"), "id")
    vocab = TX.vocabulary(tf, docs.agg(F.count(F.lit(1)).alias("n")), min_df=1, max_df=1.0)
    rows = {r.id: list(zip(r.values, r.terms)) for r in TX.tfidf_rows(tf, vocab, "id").collect()}
    got = {r.id: (r.nnz, r.top_term, r.top_weight) for r in TX.heaviest_term(tf, vocab, "id").collect()}
    assert got.keys() == rows.keys() == {1, 2, 3}
    for k, cells in rows.items():
        best = min(cells, key=lambda c: (-c[0], c[1]))
        assert got[k][:2] == (len(cells), best[1]) and abs(got[k][2] - best[0]) < 1e-12


def test_tfidf_rows_match_formula(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a", "c"]), (3, ["b"])], "id long, terms array<string>")
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    vocab = TX.vocabulary_from_df(TX.document_frequency(docs), n, min_df=1, max_df=1.0)
    rows = {r.id: dict(zip(r.terms, r.values)) for r in TX.tfidf_rows_from_terms(docs, vocab, "id").collect()}
    idf = {t: np.log(4 / (1 + d)) + 1 for t, d in {"a": 2, "b": 2, "c": 1}.items()}
    w = np.array([2 * idf["a"], idf["b"]])
    w = w / np.linalg.norm(w)
    assert abs(rows[1]["a"] - w[0]) < 1e-12 and abs(rows[1]["b"] - w[1]) < 1e-12
    assert abs(rows[3]["b"] - 1.0) < 1e-12


BASKETS = [["a", "b", "c"], ["a", "b"], ["a", "c"], ["b", "c"], ["a", "b", "c", "d"], ["d"], ["a", "b", "d"]]


def _support(items):
    return sum(1 for b in BASKETS if set(items) <= set(b))


def test_rules_with_multi_item_consequents_match_brute_force(spark):
    df = spark.createDataFrame([(i, x) for i, b in enumerate(BASKETS) for x in b], "b long, item string")
    bk = B.baskets(df, "b", "item")
    n = bk.agg(F.count(F.lit(1)).alias("n"))
    fi = B.frequent_itemsets(bk, 0.25)
    got_sets = {tuple(r.items): r.freq for r in fi.collect()}
    items = sorted({x for b in BASKETS for x in b})
    want_sets = {c: _support(c) for k in range(1, 5) for c in itertools.combinations(items, k) if _support(c) >= 2}
    assert got_sets == want_sets
    rules = {(tuple(r.antecedent), tuple(r.consequent)): r.lift for r in B.association_rules(fi, n).collect()}
    want = {}
    for s in want_sets:
        for k in range(1, len(s)):
            for a in itertools.combinations(s, k):
                c = tuple(x for x in s if x not in a)
                want[(a, c)] = (_support(s) / _support(a)) / (_support(c) / len(BASKETS))
    assert rules.keys() == want.keys()
    assert all(abs(rules[k] - want[k]) < 1e-12 for k in want)
    assert any(len(c) > 1 for _, c in rules)


def test_cooccurrence_matches_pair_counts(spark):
    rows = [(i, x) for i, b in enumerate(BASKETS) for x in b] + [(0, "a")]  # a duplicate row must not double count
    df = spark.createDataFrame(rows, "b long, item string")
    got = {(r.item_a, r.item_b): r.weight for r in B.cooccurrence(df, "b", "item", min_weight=2, block=2).collect()}
    items = sorted({x for b in BASKETS for x in b})
    want = {(a, c): _support((a, c)) for a, c in itertools.combinations(items, 2) if _support((a, c)) >= 2}
    assert got == want


def test_rules_of_a_large_itemset_follow_the_confidence_bound(spark):
    """40 items: the splits of the itemset could not be listed; consequents are grown only while confidence holds."""
    big = [f"i{k:02d}" for k in range(40)]
    sets = [(big, 10)] + [([x for x in big if x != b], 10 if b == "i00" else 40) for b in big] + [([b], 50) for b in big]
    fi = spark.createDataFrame(sets, "items array<string>, freq long")
    n = spark.createDataFrame([(100,)], "n long")
    got = [r for r in B.association_rules(fi, n, min_confidence=0.9).collect() if len(r["antecedent"]) + len(r["consequent"]) == 40]
    assert [(r["consequent"], r["confidence"], r["lift"]) for r in got] == [(["i00"], 1.0, 2.0)]


def test_missing_report_is_sorted(spark):
    from starlift.operators.profile import missing_report
    df = spark.createDataFrame([(1, None, None, "x"), (2, "a", None, None), (3, None, None, "y"), (4, "b", 1.0, "z")], "k int, b string, c double, a string")
    assert [(r["column"], r["missing_count"], r["missing_pct"]) for r in missing_report(df, "t").collect()] == [("c", 3, 75.0), ("b", 2, 50.0), ("a", 1, 25.0)]
    assert missing_report(df.limit(0), "t").count() == 0


def test_counted_blocks_equal_the_rows_counted_one_by_one(spark):
    texts = [(1, "red fish blue fish"), (2, "blue fish and red bird"), (2, "red bird"), (None, "one red fish"), (None, "red fish"), (5, ""), (6, None), (7, "the and of"), (8, "blue fish red fish")]
    d = spark.createDataFrame(texts, "doc_id long, text string").repartition(3, "doc_id").sortWithinPartitions("doc_id")
    counted = TX.counted_terms(TX.terms(spark.createDataFrame([r for r in texts if r[1] is not None], d.schema), "text", stopwords=None), "doc_id")
    tf = TX.exploded_counts(counted, "doc_id")
    vocab = TX.vocabulary(tf, spark.range(9).agg(F.count("*").alias("n")), 2, 1.0)
    want = {r["doc_id"]: r for r in TX.tfidf_rows(tf, vocab, "doc_id").collect()}
    for size in (1, 2, 100):   # blocks are cut between ids only
        blocks = TX.counted_blocks(d, "doc_id", "text", stopwords=None, block_rows=size).persist()
        assert {r["term"]: r["df"] for r in TX.block_vocabulary(blocks, 2, 1.0).collect()} == {r["term"]: r["df"] for r in vocab.collect()}
        assert {r["term"]: r["c"] for r in TX.block_terms(blocks, "counts", "c").collect()} == {r["term"]: r["c"] for r in tf.groupBy("term").agg(F.sum("tf").alias("c")).collect()}
        got = TX.block_rows(blocks, vocab, "doc_id").collect()
        assert len(got) == len(want)
        for r in got:
            assert r["indices"] == want[r["doc_id"]]["indices"]
            np.testing.assert_allclose(r["values"], want[r["doc_id"]]["values"])
        best = {r["doc_id"]: r for r in TX.block_heaviest(blocks, vocab, "doc_id").collect()}
        for r in TX.heaviest_term(tf, vocab, "doc_id").collect():
            assert (best[r["doc_id"]]["nnz"], best[r["doc_id"]]["top_term"]) == (r["nnz"], r["top_term"])
        drawn = TX.sampled_blocks(blocks, 0.5, 3).persist()
        kept = [i for b in drawn.collect() for i in b["ids"]]
        assert 0 < len(kept) < len(texts) and sum(b["n"] for b in drawn.collect()) == len(kept)
        assert all(min(b["dfs"], default=1) >= 1 and len(b["terms"]) == len(b["dfs"]) for b in drawn.collect())
        blocks.unpersist(), drawn.unpersist()


def test_blocks_go_on_over_batches_and_are_kept_a_few_at_a_time(spark, monkeypatch):
    from starlift.operators import factor as FA
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    d = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit(x), F.col("id")) for x in ("red", "blue", "dark")]).alias("text")).coalesce(1)
    spark.conf.set(batch, "3")
    try:
        sizes = [r["n"] for r in TX.counted_blocks(d, "doc_id", "text", block_rows=16).orderBy("block").collect()]
    finally:
        spark.conf.set(batch, before)
    assert sizes == [16, 16, 8]
    # 30 rows of 100 kB: Parquet's writer looks at its buffers after the 100th only, unless told otherwise
    monkeypatch.setattr(FA, "LARGE_ROWS", 1 << 19)
    large = spark.range(30, numPartitions=1).select("id", F.expr("transform(sequence(1, 6250), x -> sha1(cast(x * 31 + id as string)))").alias("x"))
    kept = FA.stored(large, "zstd", large_rows=True)
    files = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")) for f in kept.inputFiles()]
    assert sum(f.num_row_groups for f in files) >= 5 and kept.count() == 30
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(64 << 20) + "b"
    FA.drop(kept)


def test_row_weights_are_the_products_with_the_factor(spark):
    rows = spark.createDataFrame([(0, 1, [0, 2], [0.5, 1.5]), (0, 2, [3], [1.0]), (1, 3, [0, 3], [2.0, 4.0])], "block long, id long, indices array<int>, values array<double>")
    factor = spark.createDataFrame([(0, 0, 0.25), (0, 1, 9000.5), (2, 1, 0.000001)], "term_index long, topic_id int, weight double")
    got = {r["id"]: r["w"] for r in NMF.row_weights(rows, "id", factor, 2, 10**6).collect()}
    assert got == {1: [0.125, 4500.25 + 1.5e-6], 3: [0.5, 18001.0]}   # document 2 has no term of the factor


def test_spam_flag_and_word_bound_agree_with_counting(spark):
    texts = ["spam " * 20, "spam " * 16 + "a b c d", "spam " * 17 + "a b c d", "a " * 8 + "b " * 8, "Spam spam " * 9, " ".join(map(str, range(30))), "", None, " one two\tthree\nfour ", "one two three four five", "  one two three four  five"]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    toks = SF.ws_tokens("text", lower=True)
    old = F.coalesce((F.size(toks) > 15) & (SF.max_token_run(toks) / F.size(toks) > 0.8), F.lit(False))
    for r in d.select(old.alias("a"), SF.spam_flag("text").alias("b"), (SF.word_count("text") > 4).alias("c"), SF.more_words_than("text", 4).alias("d")).collect():
        assert (r["a"], r["c"]) == (r["b"], r["d"])
