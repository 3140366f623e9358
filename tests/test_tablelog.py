"""Append-only versions: folders per table, one winner per version, compaction, and the mart kept from states."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from starlift import jobs as J
from starlift.operators import tablelog as T
from starlift.operators import warehouse as W
from test_warehouse import JOBS_CSV, LAYOFFS_CSV, SURVEY_CSV


def _folders(root):
    return {n: set(os.listdir(os.path.join(root, "tables", n))) for n in os.listdir(os.path.join(root, "tables"))}


def test_append_writes_only_what_changed(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "log")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "k long")
    assert W.append(spark, root, 0, {"dim_a": rows(1, 2), "dim_b": rows()}) == 1
    before = _folders(root)
    assert W.append(spark, root, 1, {"dim_a": rows(3), "dim_b": rows()}) == 2
    after = _folders(root)
    assert after["dim_b"] == before["dim_b"] and len(after["dim_a"] - before["dim_a"]) == 1
    assert sorted(r.k for r in W.read_published(spark, root, "dim_a").collect()) == [1, 2, 3]
    assert sorted(r.k for r in W.read_published(spark, root, "dim_a", 1).collect()) == [1, 2]
    assert W.read_published(spark, root, "dim_b").count() == 0
    assert {r.kind: r.tables for r in W.inventory(spark, root).collect()} == {"dimension": 2}


def test_added_rows_are_checked_against_kept_ones(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "log")
    parent = spark.createDataFrame([(1,)], "k long")
    child = lambda *v: spark.createDataFrame(list(v), "id long, k long")

    def declared(t):
        return [W.Constraints("dim_p", unique=[["k"]]),
                W.Constraints("fact_c", unique=[["id"]], foreign_keys={"k": (t["dim_p"], "k")})]

    W.append(spark, root, 0, {"dim_p": parent, "fact_c": child((1, 1))}, constraints=declared)
    with pytest.raises(ValueError, match=r"fact_c.unique\(id\)=1"):
        W.append(spark, root, 1, {"fact_c": child((1, 1))}, constraints=declared)
    with pytest.raises(ValueError, match=r"fact_c.fk\(k\)=1"):
        W.append(spark, root, 1, {"fact_c": child((2, 7))}, constraints=declared)
    assert W.current_version(spark, root) == 1
    # a parent that comes in the same version counts
    new = {"dim_p": spark.createDataFrame([(7,)], "k long"), "fact_c": child((2, 7))}
    assert W.append(spark, root, 1, new, constraints=declared) == 2


def test_parts_take_the_place_of_the_same_parts(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "log")
    rows = lambda *v: spark.createDataFrame(list(v), "year int, x long")
    W.append(spark, root, 0, {}, {"mart_x": (rows((2023, 1), (2024, 2)), "year")})
    kept = [e.folder for e in T.entries(spark, root, 1) if e.part == "2023"]
    W.append(spark, root, 1, {}, {"mart_x": (rows((2024, 5), (2025, 6)), "year")})
    assert sorted(map(tuple, W.read_published(spark, root, "mart_x").collect())) == [(2023, 1), (2024, 5), (2025, 6)]
    assert [e.folder for e in T.entries(spark, root, 2) if e.part == "2023"] == kept
    assert [tuple(r) for r in W.read_published(spark, root, "mart_x", parts=["2025"]).collect()] == [(2025, 6)]
    assert W.read_published(spark, root, "mart_x", parts=["1999"]).count() == 0


def test_two_writers_of_one_version_never_both_win(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "log")
    for version in range(1, 4):
        done, gate = [], threading.Barrier(4)

        def write(i, version=version, done=done, gate=gate):
            gate.wait()
            try:
                T.commit(spark, root, version, [T.Entry("dim_a", None, f"tables/dim_a/{i}", i, "")])
                done.append(i)
            except W.VersionConflict:
                pass

        threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert len(done) == 1
        assert [e.row_count for e in T.entries(spark, root, version)] == done


def test_rename_through_the_file_system_does_not_overwrite(spark, tmpdir_path):
    """The path that other file systems take, on a file system whose scheme is not ``file``."""
    src, dst = (os.path.join(tmpdir_path, d) for d in ("src", "dst"))
    for d in (src, dst):
        os.makedirs(d)
        with open(os.path.join(d, "rows"), "w") as fh:
            fh.write(d)
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.t.link./m", f"file://{tmpdir_path}")
    at = lambda d: f"viewfs://t/m/{d}"
    assert not T.put_if_absent(spark, at("src"), at("dst"))
    assert open(os.path.join(dst, "rows")).read() == dst and os.path.exists(src)
    assert T.put_if_absent(spark, at("src"), at("deep/new"))
    assert os.listdir(os.path.join(tmpdir_path, "deep", "new")) == ["rows"] and not os.path.exists(src)


def test_small_folders_merge_and_rows_stay(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "log")
    version = W.append(spark, root, 0, {"fact_a": spark.range(1000)})
    for i in range(5):
        version = W.append(spark, root, version, {"fact_a": spark.range(2000 + i, 2001 + i)})
    big = [e.folder for e in T.entries(spark, root, version) if e.row_count == 1000]
    assert W.compact(spark, root, max_folders=3) == version + 1
    now = T.entries(spark, root, version + 1)
    assert sorted(e.row_count for e in now) == [5, 1000] and big[0] in {e.folder for e in now}
    assert W.read_published(spark, root, "fact_a").distinct().count() == 1005
    assert W.compact(spark, root, max_folders=3) == version + 1


def test_few_folders_are_left_alone():
    one = lambda i, n: T.Entry("t", None, str(i), n, "")
    assert T.small_folders([one(i, 1) for i in range(4)], 4) == []
    found = [one(0, 100), one(1, 1), one(2, 1), one(3, 50), one(4, 3)]
    assert {e.folder for e in T.small_folders(found, 4)} == {"1", "2", "4"}
    assert len(T.small_folders([one(i, 10 ** i) for i in range(6)], 3)) == 4


def test_mart_from_states_equals_the_rebuilt_mart_after_each_load(spark, tmpdir_path):
    root, rng = os.path.join(tmpdir_path, "log"), random.Random(5)
    cal = W.calendar(spark, "2022-01-01", "2025-12-31")
    countries = spark.createDataFrame([(1, "Chile"), (2, "Norway")], "country_key long, country_canonical string")
    schema = "date_key int, country_key long, total_laid_off double, percentage_laid_off decimal(18,9)"
    version, seen = 0, None
    for load in range(5):
        rows = [((2022 + rng.randrange(min(load + 1, 3))) * 10000 + rng.randint(1, 3) * 100 + rng.randint(1, 28),
                 rng.choice([1, 2, None]), rng.choice([None, float(rng.randint(1, 900))]),
                 rng.choice([None, rng.randint(1, 99)])) for _ in range(40)]
        new = spark.createDataFrame(rows, "date_key int, country_key long, total_laid_off double, p int") \
            .withColumn("percentage_laid_off", (F.col("p") / 100).cast("decimal(18,9)")).drop("p").to(
                spark.createDataFrame([], schema).schema)
        seen = new if seen is None else seen.unionByName(new)

        def all_facts(load=load, seen=seen):
            assert load == 0, "the whole fact is read by the first load only"
            return seen

        replaced, whole = W.refreshed_mart(spark, root, version, "mart_country_month", new, cal, countries, all_facts)
        version = W.append(spark, root, version, {"fact_layoff_event": new}, replaced, whole=whole)
        got = W.read_published(spark, root, "mart_country_month")
        want = W.country_month_mart(W.read_published(spark, root, "fact_layoff_event"), cal, countries)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    # a load that touches one year leaves the folders of the others
    before = {e.part: e.folder for e in T.entries(spark, root, version) if e.table_name == "mart_country_month"}
    one = spark.createDataFrame([(20230101, 1, 3.0, None)], schema)
    replaced, whole = W.refreshed_mart(spark, root, version, "mart_country_month", one, cal, countries, all_facts)
    version = W.append(spark, root, version, {"fact_layoff_event": one}, replaced, whole=whole)
    after = {e.part: e.folder for e in T.entries(spark, root, version) if e.table_name == "mart_country_month"}
    assert {p for p in after if after[p] != before[p]} == {"2023"}


def test_a_load_joins_and_sums_its_facts_once(spark, tmpdir_path):
    root, read = os.path.join(tmpdir_path, "log"), spark.sparkContext.accumulator(0)
    cal = W.calendar(spark, "2023-01-01", "2024-12-31")
    countries = spark.createDataFrame([(1, "Chile")], "country_key long, country_canonical string")

    @F.udf("double")
    def seen(x):
        read.add(1)
        return x

    version = 0
    for load, n in enumerate((20, 30)):
        rows = [(20230101 + 10000 * (i % 2), 1, float(i), 0.5) for i in range(n)]
        new = spark.createDataFrame(rows, "date_key int, country_key long, total_laid_off double, percentage_laid_off double")
        counted = new.repartition(3).withColumn("total_laid_off", seen("total_laid_off"))
        before = read.value
        replaced, whole = W.refreshed_mart(spark, root, version, "mart_country_month", counted, cal, countries, lambda c=counted: c)
        version = W.append(spark, root, version, {"fact_layoff_event": new}, replaced, whole=whole)
        assert read.value - before == n
    got = sorted(map(tuple, W.read_published(spark, root, "mart_country_month").collect()))
    assert got == [("Chile", 2023, 1, 25, 300.0, 0.5), ("Chile", 2024, 1, 25, 325.0, 0.5)]


def _raw(tmpdir_path, name, **texts):
    raw = os.path.join(tmpdir_path, name)
    os.makedirs(raw)
    paths = {}
    for key, text in texts.items():
        paths[key] = os.path.join(raw, f"{key}.csv")
        with open(paths[key], "w") as fh:
            fh.write(text)
    return paths


def test_loads_append_and_an_overtaken_load_starts_again(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "wh")
    more = LAYOFFS_CSV + 'Acme,Oslo,7,2/9/2024,0.2,Finance,https://c,Series A,5,Norway,2/10/2024\n'
    other = LAYOFFS_CSV + 'Gamma,Rome,9,4/9/2024,0.3,Finance,https://d,Series B,5,Italy,4/10/2024\n'
    out = {}
    for name, lay in (("one", LAYOFFS_CSV), ("more", more), ("other", other)):
        out[name] = os.path.join(tmpdir_path, f"out_{name}", "processed")
        assert J.run_all(spark, _raw(tmpdir_path, name, layoffs=lay, ai_jobs=JOBS_CSV, survey=SURVEY_CSV),
                         os.path.dirname(out[name]), with_features=False)[2] == 0
    J.ensure_warehouse(spark, root)
    J.load_warehouse(spark, out["one"], root)
    first = _folders(root)
    assert not any(J.load_warehouse(spark, out["one"], root).values()) and _folders(root) == first
    # while this load stages its rows, another one commits
    real, overtaken = W.append, []

    def late(spark, root, base, *args, **kwargs):
        if not overtaken:
            overtaken.append(base)
            monkeypatch.setattr(W, "append", real)
            J.load_warehouse(spark, out["other"], root)
        return real(spark, root, base, *args, **kwargs)

    monkeypatch.setattr(W, "append", late)
    counts = J.load_warehouse(spark, out["more"], root)
    assert overtaken == [2] and W.current_version(spark, root) == 4
    assert {n: c for n, c in counts.items() if c} == {"dim_country": 1, "fact_layoff_event": 1}
    fact = W.read_published(spark, root, "fact_layoff_event")
    assert fact.count() == fact.select("layoff_event_key").distinct().count() == 5
    assert sorted(r.row_count for r in T.entries(spark, root, 4) if r.table_name == "fact_layoff_event") == [1, 1, 3]
    t = {n: W.read_published(spark, root, n) for n in J.TABLE_SCHEMAS}
    want = W.country_month_mart(t["fact_layoff_event"], t["dim_date"], t["dim_country"])
    got = t["mart_country_month"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    for c in J.warehouse_constraints(t):
        W.assert_constraints(W.check_constraints(t[c.table], c))
    assert J.check_drift(spark, root) == []
