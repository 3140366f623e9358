"""Surrogate keys, idempotent loads, constraints, atomic publish and the dataset -> warehouse jobs."""

import os

import pytest
from pyspark.sql import functions as F

from starlift import jobs as J
from starlift.operators import warehouse as W


def test_assign_keys_dense_in_natural_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).cast("string").alias("k")).repartition(7)
    keyed = W.assign_keys(df, ["k"], "key", num_partitions=5)
    rows = sorted((r.key, r.k) for r in keyed.collect())
    assert [r[0] for r in rows] == list(range(1, 5001))
    assert [r[1] for r in rows] == sorted(r[1] for r in rows)


def test_insert_if_absent_first_wins_and_repeat_inserts_nothing(spark):
    batch = spark.createDataFrame([("b", 2), ("a", 1), ("b", 3)], "name string, v int")
    first = W.insert_if_absent(None, batch, ["name"], "key", order_cols=["v"])
    assert sorted((r.key, r.name, r.v) for r in first.collect()) == [(1, "a", 1), (2, "b", 2)]
    more = spark.createDataFrame([("c", 9), ("a", 5)], "name string, v int")
    second = W.insert_if_absent(first, more, ["name"], "key")
    assert [(r.key, r.name) for r in second.collect()] == [(3, "c")]
    assert W.insert_if_absent(first.unionByName(second), batch, ["name"], "key").count() == 0


def test_constraints_report_violations(spark):
    dim = spark.createDataFrame([(1,)], "k long")
    df = spark.createDataFrame([(1, 5.0), (1, -1.0), (2, None), (None, 1.0)], "k long, x double")
    c = W.Constraints("t", not_null=["k"], unique=[["k"]], checks={"x >= 0": F.col("x") >= 0},
                      foreign_keys={"k": (dim, "k")})
    got = {r.constraint_name: r.violations for r in W.check_constraints(df, c).collect()}
    assert got == {"not_null(k)": 1, "check(x >= 0)": 1, "unique(k)": 1, "fk(k)": 1}


def test_mart_keeps_unknown_country(spark):
    fact = spark.createDataFrame([(20240201, None, 10.0, 0.5), (20240201, 1, None, None)],
                                 "date_key int, country_key long, total_laid_off double, percentage_laid_off double")
    cal = W.calendar(spark, "2024-01-01", "2024-12-31")
    dc = spark.createDataFrame([(1, "Germany")], "country_key long, country_canonical string")
    got = {r.country_canonical: (r.year, r.month, r.layoff_events, r.total_laid_off)
           for r in W.country_month_mart(fact, cal, dc).collect()}
    assert got == {"(Unknown)": (2024, 2, 1, 10.0), "Germany": (2024, 2, 1, None)}


def test_publish_is_atomic(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "wh")
    good = spark.createDataFrame([(1,)], "k long")
    assert W.publish({"dim_x": good}, root) == 1
    bad = spark.createDataFrame([(1,), (1,)], "k long")
    with pytest.raises(ValueError):
        W.publish({"dim_x": bad}, root, constraints=[W.Constraints("dim_x", unique=[["k"]])])
    assert W.current_version(spark, root) == 1
    assert W.read_published(spark, root, "dim_x").count() == 1
    inv = {r.kind: r.tables for r in W.inventory(spark, root).collect()}
    assert inv == {"dimension": 1}


def test_failing_manifest_read_does_not_overwrite(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "wh_broken")
    assert W.current_version(spark, root) == 0
    W.publish({"dim_x": spark.createDataFrame([(1,)], "k long")}, root)
    with open(os.path.join(root, "_manifests", "version=1", "part-x.parquet"), "w") as fh:
        fh.write("not parquet")
    before = sorted(os.listdir(os.path.join(root, "tables", "dim_x")))
    with pytest.raises(Exception):
        W.publish({"dim_x": spark.createDataFrame([(2,)], "k long")}, root)
    assert sorted(os.listdir(os.path.join(root, "tables", "dim_x"))) == before


LAYOFFS_CSV = """company,location,total_laid_off,date,percentage_laid_off,industry,source,stage,funds_raised,country,date_added
Acme,"Calgary, Non-U.S.",10,2/1/2024,0.1,Finance,https://a,Series A,5,Canada,2/2/2024
Acme,Berlin,,3/1/2024,,Finance,https://b,Post-IPO,,Germany,3/2/2024
Beta,Paris,NA,2/15/2024,,,,,,,2/16/2024
Bad,Paris,-5,2/15/2024,,Finance,,,,France,2/16/2024
"""
JOBS_CSV = """job_id,job_title,job_category,experience_level,years_of_experience,education_required,annual_salary_usd,salary_min_usd,salary_max_usd,city,country,remote_work,company_size,industry,required_skills,ai_salary_premium_pct,demand_score,demand_growth_yoy_pct,benefits_score_10,posting_year,posting_month,is_senior,is_remote_friendly,is_llm_role,salary_tier
J1,AI Engineer,Engineering,Senior (6-9 yrs),7,Master,150000,120000,140000,Berlin,Germany,Hybrid,Large,Technology,Python|Cloud (AWS/GCP/Azure),10,80,5,8,2025,3,1,1,0,Mid ($100-150k)
J2,LLM Engineer,Engineering,Entry (0-2 yrs),1,BSc,90000,80000,100000,Paris,France,On-site,Small,Technology,Python|SQL,12,70,4,7,2025,4,0,0,1,Entry (<$100k)
"""
SURVEY_CSV = """ResponseId,MainBranch,Age,EdLevel,Employment,WorkExp,YearsCode,DevType,RemoteWork,Country,Industry,ConvertedCompYearly,AIThreat,AISelect,AISent,AIAcc,JobSat,AIOpen,Extra
1,Dev,25-34 years old,BSc,Employed,5,8,"Developer, back-end",Remote,Germany,Fintech,70000,No,Yes,Favorable,Trust,7,"the answer, with a comma",x
2,Dev,,,,,,,,,,,,,,,,,y
"""


def test_jobs_end_to_end_idempotent(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    paths = {}
    for name, text in (("layoffs", LAYOFFS_CSV), ("ai_jobs", JOBS_CSV), ("survey", SURVEY_CSV)):
        paths[name] = os.path.join(raw, f"{name}.csv")
        with open(paths[name], "w") as fh:
            fh.write(text)
    out = os.path.join(tmpdir_path, "out")
    results, failures, status = J.run_all(spark, paths, out, with_features=False)
    assert status == 0, failures
    assert (results["layoffs"].raw_rows, results["layoffs"].quarantined_rows) == (4, 1)
    assert results["layoffs"].summary == {"total_laid_off_negative": 1}
    q = spark.read.parquet(results["ai_jobs"].paths["quarantine"])
    assert q.count() == 0 and "quarantine_reason" in q.columns
    root = os.path.join(tmpdir_path, "wh")
    first = J.load_warehouse(spark, os.path.join(out, "processed"), root)
    assert first["fact_layoff_event"] == 3 and first["fact_job_posting"] == 2 and first["fact_survey_response"] == 2
    assert first["dim_company"] == 2 and first["dim_skill"] == 3 and first["fact_job_posting_skill"] == 4
    again = J.load_warehouse(spark, os.path.join(out, "processed"), root)
    assert all(v == 0 for v in again.values()), again
    mart = W.read_published(spark, root, "mart_country_month")
    assert mart.where("country_canonical = '(Unknown)'").first().layoff_events == 1


def _published(spark, tmpdir_path):
    raw, out, root = (os.path.join(tmpdir_path, d) for d in ("raw", "out", "wh"))
    os.makedirs(raw)
    paths = {}
    for name, text in (("layoffs", LAYOFFS_CSV), ("ai_jobs", JOBS_CSV), ("survey", SURVEY_CSV)):
        paths[name] = os.path.join(raw, f"{name}.csv")
        with open(paths[name], "w") as fh:
            fh.write(text)
    assert J.run_all(spark, paths, out, with_features=False)[2] == 0
    assert J.ensure_warehouse(spark, root) == J.ensure_warehouse(spark, root) == 1
    assert J.check_drift(spark, root) == [] and W.read_published(spark, root, "dim_role").count() == 0
    J.load_warehouse(spark, os.path.join(out, "processed"), root)
    assert W.current_version(spark, root) == 2 and J.check_drift(spark, root) == []
    return {name: W.read_published(spark, root, name) for name in J.TABLE_SCHEMAS}, root


def test_declared_constraints_catch_bad_rows(spark, tmpdir_path):
    t, root = _published(spark, tmpdir_path)
    by_table = {c.table: c for c in J.warehouse_constraints(t)}
    assert set(by_table) == set(t)
    bad = {
        "dim_date": {"quarter": 5, "day": 40},
        "dim_role": {"role_source": "other", "role_category": None},
        "fact_layoff_event": {"date_added_key": 19000101, "country_key": 999, "industry_key": 999, "total_laid_off": -1.0},
        "fact_job_posting": {"city": None, "annual_salary_usd": 0.0, "benefits_score_10": 11.0, "experience_level_canonical": "Boss", "role_key": 999},
        "fact_survey_response": {"work_exp": 101.0, "converted_comp_yearly_winsorized": 0.0, "country_key": 999},
        "fact_job_posting_skill": {"skill_key": 999, "job_posting_key": None},
    }
    want = {
        "dim_date": {"check(quarter 1..4)", "check(day 1..31)", "check(smart key)"},
        "dim_role": {"not_null(role_category)", "check(role_source)", "check(attributes by source)"},
        "fact_layoff_event": {"fk(date_added_key)", "fk(country_key)", "fk(industry_key)", "check(total_laid_off >= 0)"},
        "fact_job_posting": {"not_null(city)", "check(annual_salary > 0)", "check(benefits_score 0..10)", "check(experience_level)",
                             "check(salary_tier derived)", "fk(role_key)"},
        "fact_survey_response": {"check(work_exp 0..100)", "check(converted_comp > 0)", "check(experience bucket derived)", "fk(country_key)"},
        "fact_job_posting_skill": {"not_null(job_posting_key)", "fk(skill_key)"},
    }
    for name, values in bad.items():
        df = t[name]
        one = df.limit(1).withColumns({c: F.lit(v).cast(df.schema[c].dataType) for c, v in values.items()})
        got = {r.constraint_name for r in W.check_constraints(one, by_table[name]).where("violations > 0").collect()}
        assert want[name] <= got, (name, got)
    assert t["fact_layoff_event"].count() == 3 and J.reset_warehouse(spark, root) == 3
    assert W.read_published(spark, root, "fact_layoff_event").count() == 0
    assert W.read_published(spark, root, "fact_layoff_event", version=2).count() == 3


def test_schema_drift_names_every_difference(spark):
    want = {"a": spark.createDataFrame([], "x int, y string").schema, "b": spark.createDataFrame([], "x int").schema}
    have = {"a": spark.createDataFrame([], "x long, y string").schema}
    assert W.schema_drift(want, have) == ["a.x: type bigint != int", "b: missing table"]
    assert W.schema_drift({"a": want["a"]}, {"a": want["b"]})[0].startswith("a: columns")
    assert W.schema_drift(want, want) == []


def test_feature_step_reaches_the_fact_and_a_failing_dataset_is_isolated(spark, tmpdir_path):
    import dataclasses
    import functools
    import random
    from starlift.plans.labour import DATASETS, survey_features
    rng, themes = random.Random(2), {"Garden": "soil seed water plant garden grows", "Harbour": "ship tide rope anchor harbour sails"}
    header = SURVEY_CSV.splitlines()[0]
    want, lines = {}, [header]
    for i in range(1, 41):
        name = ("Garden", "Harbour")[i % 2]
        words = themes[name].split()
        rng.shuffle(words)
        want[i] = name
        lines.append(f'{i},Dev,25-34 years old,BSc,Employed,5,8,"Developer, back-end",Remote,Germany,Fintech,70000,No,Yes,Favorable,Trust,7,{" ".join(words)},x')
    lines.append('41,Dev,25-34 years old,BSc,Employed,5,8,"Developer, back-end",Remote,Germany,Fintech,70000,No,Yes,Favorable,Trust,7,too short,x')
    raw, out, root = (os.path.join(tmpdir_path, d) for d in ("raw_f", "out_f", "wh_f"))
    os.makedirs(raw)
    paths = {"layoffs": os.path.join(raw, "missing.csv")}
    for name, text in (("ai_jobs", JOBS_CSV), ("survey", "\n".join(lines) + "\n"), ("layoffs_ok", LAYOFFS_CSV)):
        paths[name] = os.path.join(raw, f"{name}.csv")
        with open(paths[name], "w") as fh:
            fh.write(text)
    features = functools.partial(survey_features, anchors={"Garden": {"soil"}, "Harbour": {"tide"}}, k=2, max_iter=60)
    defs = {**DATASETS, "survey": dataclasses.replace(DATASETS["survey"], features=features)}
    results, failures, status = J.run_all(spark, paths, out, defs)
    assert status == 1 and set(failures) == {"layoffs"} and set(results) == {"ai_jobs", "survey"}
    J.run_dataset(spark, DATASETS["layoffs"], paths["layoffs_ok"], out)
    counts = J.load_warehouse(spark, os.path.join(out, "processed"), root)
    assert counts["dim_ai_open_topic"] == 2 and counts["fact_survey_response"] == 41
    fact = W.read_published(spark, root, "fact_survey_response")
    topics = W.read_published(spark, root, "dim_ai_open_topic").select("ai_open_topic_key", "topic_label")
    got = {r.response_id: r.topic_label for r in fact.join(topics, "ai_open_topic_key", "left").collect()}
    assert got == {**want, 41: None}


def test_posting_skills_lie_by_posting_in_tasks_of_a_fixed_size(spark, tmpdir_path, monkeypatch):
    from starlift.plans import standins as S
    from starlift.session import Tables
    lines = [(k // 4 if k < 60 else None, k % 5) for k in range(64)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    spark.createDataFrame([(0, "Brand#1"), (1, "Brand#10"), (2, " Brand#3 "), (3, ""), (3, "x"), (4, None), (9, "unused")], "p_partkey long, p_brand string").write.parquet(f"{tmpdir_path}/part.parquet")
    t = Tables(spark, tmpdir_path)
    names = {0: ["Brand#10"], 1: ["Brand#10"], 2: ["Brand#3"], 3: ["", "x"], 4: [None]}
    pairs = S.posting_skills(t)
    assert sorted(map(str, pairs.collect())) == sorted(f"Row(posting_id={o}, skill={n!r})" for o, n in {(o, n) for o, p in lines for n in names[p]})
    assert {r.skill for r in S.skills(t).collect()} == {"Brand#10", "Brand#3", "", "x", None} and S.skills(t).count() == 5
    monkeypatch.setattr(S, "TASK_LINES", 8)
    assert S.posting_skills(t).rdd.getNumPartitions() == 8   # 64 lines
    found = S.posting_skills(t).groupBy("posting_id").count()._jdf.queryExecution().executedPlan().toString()
    assert found.count("Exchange hashpartitioning(posting_id") == 1
