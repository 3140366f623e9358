"""Quantiles by rank, bounded co-occurrence blocks, and the fixed conformance maps."""

import numpy as np
import pandas as pd
import pytest

from starlift.operators import basket as B
from starlift.operators import conform as CF
from starlift.operators import stats as ST
from starlift.refdata import labour as L


def test_quantiles_match_numpy_for_hot_small_and_null_groups(spark):
    rng = np.random.default_rng(4)
    rows = [("hot", float(x)) for x in rng.integers(0, 300, 4000)] + [("few", x) for x in (1.5, -2.0, 9.0)]
    rows += [(None, 4.0), (None, 5.0), ("none", None), ("hot", None), ("one", 7.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probs = {"a": 0.01, "m": 0.5, "z": 0.99, "lo": 0.0, "hi": 1.0}
    got = {r.g: r for r in ST.with_quantiles(df.select("g").distinct(), df, ["g"], "x", probs).collect()}
    for g in {g for g, _ in rows}:
        xs = [x for k, x in rows if k == g and x is not None]
        for name, p in probs.items():
            assert got[g][name] is None if not xs else abs(got[g][name] - np.quantile(xs, p)) < 1e-9
    assert len(got) == 5
    whole = ST.quantiles(df, [], "x", {"m": 0.5}).collect()
    assert len(whole) == 1 and whole[0].m == np.quantile([x for _, x in rows if x is not None], 0.5)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert ST.quantiles(df, ["g"], "x", {"m": 0.5}).count() == 0
    assert [r.m for r in ST.quantiles(df, [], "x", {"m": 0.5}).collect()] == [None]


def test_gram_blocks_given_up_early_add_up():
    rng = np.random.default_rng(1)
    lists = [sorted(rng.choice(12, rng.integers(0, 9), replace=False).tolist()) for _ in range(60)]
    parts = [pd.DataFrame({"idx": lists[i:i + 7]}) for i in range(0, 60, 7)]
    few, all_ = (pd.concat(B._gram_fn(12, 3, held)(iter(parts))).groupby(["a", "b"])["w"].sum() for held in (2, 100))
    want = {}
    for xs in lists:
        for i, a in enumerate(xs):
            for b in xs[i + 1:]:
                want[a, b] = want.get((a, b), 0) + 1
    assert few.to_dict() == all_.to_dict() == want


def test_maps_are_complete_and_merge_variants():
    assert all(L.COUNTRY_MAP.values()) and all(L.INDUSTRY_MAP.values())
    assert L.COUNTRY_MAP["USA"] == L.COUNTRY_MAP["United States"] and L.COUNTRY_MAP["UK"] == L.COUNTRY_MAP["United Kingdom"]
    assert L.COUNTRY_MAP["Global"] == L.COUNTRY_MAP["Nomadic"]
    assert len({L.COUNTRY_MAP[k] for k in L.COUNTRY_MAP if "Korea" in k}) == 2
    assert L.INDUSTRY_MAP["Fintech"] == L.INDUSTRY_MAP["Finance"] and L.INDUSTRY_MAP["Technology"] == L.INDUSTRY_MAP["AI"]
    assert set(L.ROLE_MAP.values()) == {"Emerging", "Traditional"}
    assert set(L.EXPERIENCE_MAP.values()) == {"Entry", "Mid", "Senior", "Lead"}
    assert not set(L.EXPERIENCE_MAP.values()) & set(L.EXPERIENCE_MAP)


def test_shades_keep_missing_cells(spark):
    rows = [("a", 10, 4.0, None), ("b", None, 4.0, None), ("c", 30, None, None), ("d", 15, 4.0, None)]
    got = {r.g: r for r in ST.with_shades(spark.createDataFrame(rows, "g string, x long, y double, z double"), ["x", "y", "z"]).collect()}
    assert [got[g].shade_x for g in "abcd"] == [0.0, None, 1.0, 0.25]
    assert [got[g].shade_y for g in "abcd"] == [1.0, 1.0, None, 1.0]
    assert [got[g].shade_z for g in "abcd"] == [None] * 4


def test_a_map_with_holes_stops_the_load(spark):
    used = spark.createDataFrame([("UAE",), ("UAE",), (None,), ("Nomadic",), ("Atlantis",)], "country string")
    with pytest.raises(ValueError, match=r"1 value\(s\) of country without a canonical one: \['Atlantis'\]"):
        CF.complete_map(L.COUNTRY_MAP, used, "country")
    table = spark.createDataFrame([("UAE", "Emirates"), ("Nomadic", None), ("Atlantis", "Atlantis")], "raw string, canonical string")
    with pytest.raises(ValueError, match="Nomadic"):
        CF.complete_map(table, used, "country")
    known = used.where("country <> 'Atlantis'")
    assert CF.complete_map(L.COUNTRY_MAP, known, "country") is L.COUNTRY_MAP


def test_matched_families_keep_the_unmatched_ones(spark):
    from starlift.plans.q_analytics import family_matches
    answers = spark.createDataFrame([("x1", True), ("x2", False), ("x1", False), ("y", True), ("?", True), (None, True)],
                                    "label string, worried boolean")
    posts = spark.createDataFrame([("X", 2.0), ("X", 4.0), ("Z", 1.0)], "family string, demand_growth double")
    got = {r.family: (r.answers, r.yes, r.growth, r.postings, r.matched) for r in
           family_matches(answers, posts, "label", "worried", {"x1": "X", "x2": "X", "y": "Y"}).collect()}
    assert got == {"X": (3, 1, 3.0, 2, True), "Y": (1, 1, None, None, False), "Z": (None, None, 1.0, 1, False)}
