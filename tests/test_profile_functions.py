"""Profiler edge cases and column helpers."""

import numpy as np
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import conform as CF
from starlift.operators import profile as P


def test_data_dictionary_basic(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "y")], "a long, b string")
    rows = {r.column: r for r in P.data_dictionary(df).collect()}
    assert (rows["a"].missing_count, rows["a"].missing_pct, rows["a"].unique_count) == (1, 25.0, 2)
    assert (rows["a"].min, rows["a"].max) == (1.0, 2.0)
    assert rows["b"].min is None and rows["b"].max is None and rows["b"].unique_count == 2
    assert [r.column for r in P.data_dictionary(df).orderBy("position").collect()] == ["a", "b"]


def test_data_dictionary_all_null_and_empty(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    r = P.data_dictionary(df).first()
    assert (r.missing_count, r.missing_pct, r.unique_count, r.min, r.max) == (2, 100.0, 0, None, None)
    empty = spark.createDataFrame([], "a double")
    assert P.data_dictionary(empty).first().missing_pct == 0.0


def test_bucket_is_right_closed_and_keeps_null(spark):
    df = spark.createDataFrame([(x,) for x in [None, 0.0, 2.0, 2.5, 5.0, 9.0, 9.5]], "w double")
    got = [r.b for r in df.select(SF.bucket_right_closed("w").alias("b")).collect()]
    assert got == [None, "Entry", "Entry", "Mid", "Mid", "Senior", "Lead"]


def test_winsorize_matches_linear_percentiles(spark):
    vals = [float(x) for x in range(1, 101)] + [1000.0]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    out = [r.w for r in CF.winsorize(df, "x", "w").collect()]
    lo, hi = np.percentile(vals, [1, 99])
    assert out[-1] is None
    assert abs(min(v for v in out if v is not None) - lo) < 1e-9
    assert abs(max(v for v in out if v is not None) - hi) < 1e-9


def test_clip_guard_does_not_impute(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0), (5.0, None, None)], "x double, lo double, hi double")
    assert [r.c for r in df.select(SF.clip_guarded("x", "lo", "hi").alias("c")).collect()] == [None, 5.0]


def test_tag_normalisation(spark):
    df = spark.createDataFrame([(" SQL |Python| Cloud (AWS/GCP/Azure)|Python",), (None,)], "t string")
    got = [r.n for r in df.select(SF.normalize_tags_string("t", {"Cloud (AWS/GCP/Azure)": "Cloud"}).alias("n")).collect()]
    assert got == ["Cloud|Python|SQL", None]


def test_spam_mask_whole_text(spark):
    troll = " ".join(["no"] * 60000)  # a very long answer repeating one word
    df = spark.createDataFrame([(troll,), ("debugging",), ("a b c d e f g h i j k l m n o p",), (None,)], "t string")
    got = [r.s for r in df.select(SF.spam_flag("t").alias("s")).collect()]
    assert got == [True, False, False, False]


def test_word_count_like_python_split(spark):
    texts = ["  a b  ", "", "one\ttwo\nthree", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.n for r in df.select(SF.word_count("t").alias("n")).collect()] == [2, 0, 3, None]


def test_run_lengths(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],)], "t array<string>")
    got = [[(x.term, x.tf) for x in r.r] for r in df.select(SF.run_lengths(F.col("t")).alias("r")).collect()]
    assert got == [[("a", 1), ("b", 2)], []]


def test_wilson_interval(spark):
    df = spark.createDataFrame([(135, 739)], "x long, n long")
    lo, hi = SF.wilson_interval("x", "n")
    r = df.select(lo.alias("lo"), hi.alias("hi")).first()
    p, n, z = 135 / 739, 739, SF.Z95
    c = (p + z * z / (2 * n)) / (1 + z * z / n)
    h = z / (1 + z * z / n) * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    assert abs(r.lo - (c - h)) < 1e-12 and abs(r.hi - (c + h)) < 1e-12


def test_date_key_and_tolerant_parse(spark):
    df = spark.createDataFrame([("1/5/2024",), ("x",), (None,)], "d string")
    got = [r.k for r in df.select(SF.date_key(SF.parse_date("d")).alias("k")).collect()]
    assert got == [20240105, None, None]


def test_dictionary_counts_like_distinct_and_needs_no_expand(spark, capsys):
    rows = [(i % 7, float(i % 3) * (-1 if i % 2 else 1), ("x" * 5000 + str(i % 4)) if i % 5 else None, [str(i % 2), "a, b"] if i % 3 else None)
            for i in range(200)] + [(None, float("nan"), "", ["a", "b"])] * 2
    df = spark.createDataFrame(rows, "i int, d double, t string, a array<string>").repartition(3)
    df = df.withColumn("when", F.to_date(F.lit("2024-01-01"))).withColumn("flag", F.col("i") > 3)
    want = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first()
    for approx in (False, True):
        got = {r.column: r for r in P.data_dictionary(df, approx_distinct=approx).collect()}
        assert [got[c].position for c in df.columns] == list(range(6))
        assert {c: r.unique_count for c, r in got.items()} == want.asDict()
        assert got["i"].missing_count == 2 and (got["i"].min, got["i"].max) == (0.0, 6.0)
        assert got["t"].missing_pct == 19.8 and got["t"].min is None and got["a"].dtype == "array<string>"
    P.data_dictionary(df).explain()
    plan = capsys.readouterr().out
    assert "Expand" not in plan and plan.count("Generate") >= 1
    assert [(r.unique_count, r.missing_count) for r in P.data_dictionary(df.limit(0)).collect()] == [(0, 0)] * 6
