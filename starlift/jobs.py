"""User-facing jobs (§2.12 J1-J4).

J1 ``run_dataset``  contract scan -> rules -> quarantine sink -> transform -> (features) -> sink -> profile
J2 ``run_all``      every dataset runs even if another fails; non-zero status if any failed
J3 ``load_warehouse`` dimensions -> keys -> facts -> bridge -> mart, insert-if-absent against the
                    current published version, then one atomic version (all tables or none) that adds the new rows
J4 ``ensure_warehouse`` / ``reset_warehouse``

The tagged split is checkpointed once to the shared checkpoint folder (both
halves, the summary and the counts read it); processed files are the
contract between the dataset jobs and the warehouse load.
"""

from __future__ import annotations

import os
import sys
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import profile as P
from starlift.operators import quality as Q
from starlift.operators import warehouse as W
from starlift.plans.labour import DATASETS, SEQ, DatasetDef
from starlift.refdata import labour as L
from starlift.session import ensure_checkpoint_dir
from starlift.sources.contracts import read_csv, read_optional, schema_of

SURVEY_YEAR = 2025


@dataclass
class PipelineResult:
    name: str
    raw_rows: int
    clean_rows: int
    quarantined_rows: int
    summary: dict[str, int]
    dictionary: DataFrame
    paths: dict[str, str] = field(default_factory=dict)


def _write(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)   # S5/S6/S7: overwrite; an empty frame keeps its schema
    return path


def run_dataset(spark: SparkSession, ds: DatasetDef, raw_path: str, out_dir: str,
                with_features: bool = True) -> PipelineResult:
    """J1 for one dataset."""
    ensure_checkpoint_dir(spark)
    raw = read_csv(spark, raw_path, ds.contract, position=SEQ)
    df, rules = ds.rules(raw)
    cols = ds.contract.columns
    tagged = Q.tag(df, rules).select(*cols, SEQ, Q.REASONS).checkpoint(eager=True)
    clean = tagged.where(F.size(Q.REASONS) == 0).select(*cols, SEQ)
    quarantine = tagged.where(F.size(Q.REASONS) > 0).select(
        *cols, F.array_join(Q.REASONS, Q.REASON_SEP).alias(Q.REASON_COL))
    paths = {"quarantine": _write(quarantine, os.path.join(out_dir, "quarantine", ds.name))}
    processed = ds.transform(clean)
    artifacts: dict[str, DataFrame] = {}
    if ds.features is not None and with_features:
        processed, artifacts = ds.features(processed)
    paths["processed"] = _write(processed, os.path.join(out_dir, "processed", ds.name))
    for art, adf in artifacts.items():
        paths[art] = _write(adf, os.path.join(out_dir, "processed", f"{ds.name}_{art}"))
    c = tagged.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size(Q.REASONS) > 0).alias("q")).first()
    summary = {r.rule: int(r.violations) for r in Q.summarize(quarantine).collect()}  # one row per rule
    dictionary = P.data_dictionary(spark.read.parquet(paths["processed"]).drop(SEQ))
    return PipelineResult(ds.name, int(c.n), int(c.n - c.q), int(c.q), summary, dictionary, paths)


def run_all(spark: SparkSession, raw_paths: dict[str, str], out_dir: str,
            datasets: dict[str, DatasetDef] | None = None, with_features: bool = True):
    """Run every dataset; a failure is recorded and the others still run. Returns (results, failures, status)."""
    datasets = datasets or DATASETS
    results, failures = {}, {}
    for name, ds in datasets.items():
        try:
            results[name] = run_dataset(spark, ds, raw_paths[name], out_dir, with_features)
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            failures[name] = f"{type(exc).__name__}: {exc}"
    return results, failures, 1 if failures else 0


# ---------------------------------------------------------------- J3 warehouse load

TOPIC_SCHEMA = schema_of("model_version string, component_id int, topic_label string, top_terms string")

#: Columns and types of every published table (W20 compares them with what is on disk).
TABLE_SCHEMAS = {name: schema_of(ddl) for name, ddl in {
    "dim_date": "date_key int, full_date date, year int, quarter int, month int, month_name string, day int",
    "dim_country": "country_key bigint, country_canonical string, continent string",
    "dim_industry": "industry_key bigint, industry_sector string",
    "dim_company": "company_key bigint, company_name string",
    "dim_role": "role_key bigint, role_source string, role_title string, role_category string, job_category string, "
                "is_llm_role boolean",
    "dim_ai_sentiment": "ai_sentiment_key bigint, ai_threat string, ai_select string, ai_sent string, ai_acc string",
    "dim_skill": "skill_key bigint, skill_name string",
    "dim_ai_open_topic": "ai_open_topic_key bigint, model_version string, component_id int, topic_label string, top_terms string",
    "fact_layoff_event": "layoff_event_key bigint, date_key int, date_added_key int, company_key bigint, country_key bigint, "
                         "industry_key bigint, location string, stage string, total_laid_off double, "
                         "percentage_laid_off double, funds_raised_usd_millions double, source_url string",
    "fact_job_posting": "job_posting_key bigint, job_id string, date_key int, role_key bigint, country_key bigint, "
                        "industry_key bigint, city string, company_size string, remote_work string, "
                        "education_required string, experience_level_canonical string, years_of_experience bigint, "
                        "annual_salary_usd double, salary_min_usd bigint, salary_max_usd bigint, "
                        "ai_salary_premium_pct double, demand_score bigint, demand_growth_yoy_pct double, "
                        "benefits_score_10 double, is_senior boolean, is_remote_friendly boolean, salary_tier string",
    "fact_survey_response": "response_key bigint, survey_year int, response_id bigint, role_key bigint, country_key bigint, "
                            "industry_key bigint, ai_sentiment_key bigint, main_branch string, age_bucket string, "
                            "ed_level string, employment string, remote_work string, work_exp double, years_code double, "
                            "experience_level_canonical string, converted_comp_yearly_winsorized double, job_sat double, "
                            "ai_open_topic_key bigint",
    "fact_job_posting_skill": "job_posting_key bigint, skill_key bigint",
    "mart_country_month": "country_canonical string, year int, month int, layoff_events bigint, total_laid_off double, "
                          "avg_percentage_laid_off double",
    "state_mart_country_month": "country_canonical string, year int, month int, layoff_events bigint, laid_off_sum double, "
                                "share_sum double, share_count bigint",
}.items()}
LOAD_ATTEMPTS = 5
CALENDAR = ("2020-01-01", "2030-12-31")


def _existing(spark, root, version, name):
    return W.read_published(spark, root, name, version) if version else None


def _merge(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if existing is None else existing.unionByName(new.select(*existing.columns))


def load_warehouse(spark: SparkSession, processed_dir: str, root: str) -> dict[str, int]:
    """Returns rows actually inserted per table (all 0 on a repeat load of the same files).

    The version that it commits adds folders with the new rows; a load without new rows writes nothing. A load that
    another one overtakes starts again from the newer version, since its keys and its "not there yet" are of the old
    one; after ``LOAD_ATTEMPTS`` it gives up.
    """
    ensure_checkpoint_dir(spark)
    for attempt in range(LOAD_ATTEMPTS):
        new: dict[str, DataFrame] = {}
        try:
            counts = _load_once(spark, processed_dir, root, new)
            break
        except W.VersionConflict:
            if attempt + 1 == LOAD_ATTEMPTS:
                raise
        finally:
            for df in new.values():
                df.unpersist()
    try:
        W.compact(spark, root)
    except W.VersionConflict:
        pass   # another load has committed; the next one compacts
    return counts


def _load_once(spark: SparkSession, processed_dir: str, root: str, new: dict[str, DataFrame]) -> dict[str, int]:
    """One attempt at the load; ``new`` receives the cached new rows of every table."""
    rd = lambda n: spark.read.parquet(os.path.join(processed_dir, n))
    lay, jobs, sur = rd("layoffs"), rd("ai_jobs"), rd("survey")
    topics = read_optional(spark, os.path.join(processed_dir, "survey_topics"), TOPIC_SCHEMA)
    v = W.current_version(spark, root)
    ex = lambda n: _existing(spark, root, v, n)
    full: dict[str, DataFrame] = {}

    def add(name, batch, natural_key, key_col):
        order = [SEQ] if SEQ in batch.columns else None   # file order: the first row of a key wins
        new[name] = W.insert_if_absent(ex(name), batch, natural_key, key_col, order).drop(SEQ).cache()
        full[name] = _merge(ex(name), new[name])

    # dimensions
    cal = W.calendar(spark, *CALENDAR)   # pre-seeded, gap-free; the smart key is the key
    dex = ex("dim_date")
    new["dim_date"] = (cal if dex is None else cal.join(dex.select("date_key"), "date_key", "left_anti")).cache()
    full["dim_date"] = _merge(dex, new["dim_date"])
    add("dim_country", W.union_distinct([lay, jobs, sur], ["country_canonical"])
        .withColumn("continent", F.lit(None).cast("string")), ["country_canonical"], "country_key")
    add("dim_industry", W.union_distinct([lay, jobs, sur], ["industry_sector"]), ["industry_sector"], "industry_key")
    add("dim_company", lay.select(F.col("company").alias("company_name")).dropna().distinct(), ["company_name"], "company_key")
    roles_jobs = W.first_per_group(jobs, ["job_title"], [SEQ],
                                   ["role_category", "job_category", "is_llm_role"]).select(
        F.lit("job_title").alias("role_source"), F.col("job_title").alias("role_title"), "role_category",
        "job_category", F.col("is_llm_role").cast("boolean").alias("is_llm_role"))
    roles_dev = W.first_per_group(sur.where(F.col("DevType").isNotNull()), ["DevType"], [SEQ],
                                  ["role_category"]).select(
        F.lit("DevType").alias("role_source"), F.col("DevType").alias("role_title"), "role_category",
        F.lit(None).cast("string").alias("job_category"), F.lit(None).cast("boolean").alias("is_llm_role"))
    add("dim_role", roles_jobs.unionByName(roles_dev), ["role_source", "role_title"], "role_key")
    sent = W.junk_dimension(sur.select(*[F.col(c).alias(n) for c, n in
                                         zip(L.AI_SENTIMENT_COLS, ["ai_threat", "ai_select", "ai_sent", "ai_acc"])]),
                            ["ai_threat", "ai_select", "ai_sent", "ai_acc"])
    add("dim_ai_sentiment", sent, ["ai_threat", "ai_select", "ai_sent", "ai_acc"], "ai_sentiment_key")
    skills = jobs.select(F.explode(F.split("required_skills_normalized", r"\|")).alias("skill_name")) \
        .where(F.col("skill_name") != "").distinct()
    add("dim_skill", skills, ["skill_name"], "skill_key")
    add("dim_ai_open_topic", topics, ["model_version", "component_id"], "ai_open_topic_key")

    # facts (W10-W14): natural keys -> surrogate keys
    f = lay.withColumn("date_key", SF.date_key(SF.parse_date("date", strict=True))) \
        .withColumn("date_added_key", SF.date_key(SF.parse_date("date_added", strict=True)))
    f = W.lookup(f, full["dim_company"], {"company": "company_name"}, "company_key")
    f = W.lookup(f, full["dim_country"], {"country_canonical": "country_canonical"}, "country_key")
    f = W.lookup(f, full["dim_industry"], {"industry_sector": "industry_sector"}, "industry_key")
    f = f.select("date_key", "date_added_key", "company_key", "country_key", "industry_key", "location", "stage",
                 SF.nan_to_null("total_laid_off").alias("total_laid_off"),
                 SF.nan_to_null("percentage_laid_off").alias("percentage_laid_off"),
                 SF.nan_to_null("funds_raised").alias("funds_raised_usd_millions"),
                 F.col("source").alias("source_url"), SEQ)
    add("fact_layoff_event", f, ["company_key", "date_key", "location"], "layoff_event_key")

    p = jobs.withColumn("role_source", F.lit("job_title"))
    p = W.lookup(p, full["dim_role"], {"role_source": "role_source", "job_title": "role_title"}, "role_key")
    p = W.lookup(p, full["dim_country"], {"country_canonical": "country_canonical"}, "country_key")
    p = W.lookup(p, full["dim_industry"], {"industry_sector": "industry_sector"}, "industry_key")
    p = p.select("job_id", SF.month_key("posting_year", "posting_month").alias("date_key"), "role_key", "country_key",
                 "industry_key", "city", "company_size", "remote_work", "education_required",
                 "experience_level_canonical", "years_of_experience", "annual_salary_usd", "salary_min_usd",
                 "salary_max_usd", "ai_salary_premium_pct", "demand_score", "demand_growth_yoy_pct",
                 "benefits_score_10", F.col("is_senior").cast("boolean").alias("is_senior"),
                 F.col("is_remote_friendly").cast("boolean").alias("is_remote_friendly"), "salary_tier", SEQ)
    add("fact_job_posting", p, ["job_id"], "job_posting_key")

    s = sur.withColumn("role_source", F.lit("DevType"))
    s = W.lookup(s, full["dim_role"], {"role_source": "role_source", "DevType": "role_title"}, "role_key")
    s = W.lookup(s, full["dim_country"], {"country_canonical": "country_canonical"}, "country_key")
    s = W.lookup(s, full["dim_industry"], {"industry_sector": "industry_sector"}, "industry_key")
    s = W.lookup(s, full["dim_ai_sentiment"], {"AIThreat": "ai_threat", "AISelect": "ai_select", "AISent": "ai_sent",
                                               "AIAcc": "ai_acc"}, "ai_sentiment_key")
    if "ai_open_topic_id" in s.columns:
        s = s.withColumn("__mv", F.lit(L_MODEL_VERSION)).withColumn("__cid", F.col("ai_open_topic_id").cast("bigint"))
        s = W.lookup(s, full["dim_ai_open_topic"], {"__mv": "model_version", "__cid": "component_id"},
                     "ai_open_topic_key")
    else:
        s = s.withColumn("ai_open_topic_key", F.lit(None).cast("long"))
    s = s.select(F.lit(SURVEY_YEAR).alias("survey_year"), F.col("ResponseId").alias("response_id"), "role_key",
                 "country_key", "industry_key", "ai_sentiment_key", F.col("MainBranch").alias("main_branch"),
                 F.col("Age").alias("age_bucket"), F.col("EdLevel").alias("ed_level"),
                 F.col("Employment").alias("employment"), F.col("RemoteWork").alias("remote_work"),
                 F.col("WorkExp").alias("work_exp"), F.col("YearsCode").alias("years_code"),
                 "experience_level_canonical", "converted_comp_yearly_winsorized",
                 F.col("JobSat").alias("job_sat"), "ai_open_topic_key", SEQ)
    add("fact_survey_response", s, ["survey_year", "response_id"], "response_key")

    # bridge (W15)
    b = jobs.select("job_id", F.explode(F.split("required_skills_normalized", r"\|")).alias("skill_name")) \
        .where(F.col("skill_name") != "")
    b = b.join(full["fact_job_posting"].select("job_id", "job_posting_key"), "job_id") \
        .join(full["dim_skill"].select("skill_name", "skill_key"), "skill_name") \
        .select("job_posting_key", "skill_key").dropDuplicates()
    bex = ex("fact_job_posting_skill")
    new["fact_job_posting_skill"] = (b if bex is None else b.join(bex, ["job_posting_key", "skill_key"], "left_anti")).cache()
    full["fact_job_posting_skill"] = _merge(bex, new["fact_job_posting_skill"])

    counts = {n: int(df.count()) for n, df in new.items()}
    if v and not any(counts.values()):
        return counts
    # mart (W16/W17): refreshed in the same version, from the new facts and the kept states
    replaced, whole = W.refreshed_mart(spark, root, v, "mart_country_month", new["fact_layoff_event"], full["dim_date"],
                                       full["dim_country"], lambda: full["fact_layoff_event"])
    W.append(spark, root, v, {n: df.to(TABLE_SCHEMAS[n]) for n, df in new.items()},
             {n: (df.to(TABLE_SCHEMAS[n]), part) for n, (df, part) in replaced.items()}, warehouse_constraints, whole)
    return counts


L_MODEL_VERSION = "nmf-2025-v1"


def warehouse_constraints(t: dict[str, DataFrame]) -> list[W.Constraints]:
    """The declared constraints of every table (checked on the staged rows; ``t`` are the tables with them).

    A primary key is NOT NULL plus UNIQUE; a nullable foreign key holds where it is set.
    """
    c = F.col

    def fk(*cols, **named):
        parents = {col: ("dim_date", "date_key") if col.startswith("date") else (named[col], col) if col in named
                   else (f"dim_{col.removesuffix('_key')}", col) for col in (*cols, *named)}
        return {col: (t[table], pcol) for col, (table, pcol) in parents.items()}

    title = c("role_source") == "job_title"
    levels = ["Entry", "Mid", "Senior", "Lead"]
    return [
        W.Constraints("dim_date", not_null=["date_key", "full_date", "year", "quarter", "month", "month_name", "day"],
                      unique=[["date_key"], ["full_date"]],
                      checks={"quarter 1..4": c("quarter").between(1, 4), "month 1..12": c("month").between(1, 12),
                              "day 1..31": c("day").between(1, 31),
                              "smart key": c("date_key") == c("year") * 10000 + c("month") * 100 + c("day")}),
        *[W.Constraints(f"dim_{name}", not_null=[f"{name}_key", label], unique=[[f"{name}_key"], [label]])
          for name, label in (("country", "country_canonical"), ("industry", "industry_sector"),
                              ("company", "company_name"), ("skill", "skill_name"))],
        W.Constraints("dim_role", not_null=["role_key", "role_source", "role_title", "role_category"],
                      unique=[["role_key"], ["role_source", "role_title"]],
                      checks={"role_source": c("role_source").isin("job_title", "DevType"),
                              "role_category": c("role_category").isin("Emerging", "Traditional"),
                              "attributes by source": F.when(title, c("job_category").isNotNull() & c("is_llm_role").isNotNull())
                              .otherwise(c("job_category").isNull() & c("is_llm_role").isNull())}),
        W.Constraints("dim_ai_sentiment", not_null=["ai_sentiment_key", "ai_threat", "ai_select", "ai_sent", "ai_acc"],
                      unique=[["ai_sentiment_key"], ["ai_threat", "ai_select", "ai_sent", "ai_acc"]]),
        W.Constraints("dim_ai_open_topic", not_null=["ai_open_topic_key", "model_version", "component_id", "topic_label", "top_terms"],
                      unique=[["ai_open_topic_key"], ["model_version", "component_id"], ["model_version", "topic_label"]],
                      checks={"component_id >= 0": c("component_id") >= 0}),
        W.Constraints("fact_layoff_event",
                      not_null=["layoff_event_key", "date_key", "date_added_key", "company_key", "location", "stage"],
                      unique=[["layoff_event_key"], ["company_key", "date_key", "location"]],
                      checks={"total_laid_off >= 0": c("total_laid_off") >= 0,
                              "percentage_laid_off 0..1": c("percentage_laid_off").between(0, 1),
                              "funds >= 0": c("funds_raised_usd_millions") >= 0},
                      foreign_keys=fk("date_key", "date_added_key", "company_key", "country_key", "industry_key")),
        W.Constraints("fact_job_posting",
                      not_null=["job_posting_key", "job_id", "date_key", "role_key", "country_key", "industry_key", "city",
                                "company_size", "remote_work", "education_required", "experience_level_canonical",
                                "years_of_experience", "annual_salary_usd", "salary_min_usd", "salary_max_usd",
                                "ai_salary_premium_pct", "demand_score", "demand_growth_yoy_pct", "benefits_score_10",
                                "is_senior", "is_remote_friendly", "salary_tier"],
                      unique=[["job_posting_key"], ["job_id"]],
                      checks={"salary_min <= salary_max": c("salary_min_usd") <= c("salary_max_usd"),
                              "annual_salary > 0": c("annual_salary_usd") > 0,
                              "years_of_experience >= 0": c("years_of_experience") >= 0,
                              "experience_level": c("experience_level_canonical").isin(levels),
                              "demand_score 0..100": c("demand_score").between(0, 100),
                              "benefits_score 0..10": c("benefits_score_10").between(0, 10),
                              "is_senior derived": c("is_senior") == c("experience_level_canonical").isin("Senior", "Lead"),
                              "is_remote_friendly derived": c("is_remote_friendly") == (c("remote_work") != "On-site"),
                              "salary_tier derived": c("salary_tier") == SF.salary_tier("annual_salary_usd")},
                      foreign_keys=fk("date_key", "role_key", "country_key", "industry_key")),
        W.Constraints("fact_survey_response", not_null=["response_key", "survey_year", "response_id", "ai_sentiment_key"],
                      unique=[["response_key"], ["survey_year", "response_id"]],
                      checks={"work_exp 0..100": c("work_exp").between(0, 100),
                              "years_code 0..100": c("years_code").between(0, 100),
                              "experience_level": c("experience_level_canonical").isin(levels),
                              "converted_comp > 0": c("converted_comp_yearly_winsorized") > 0,
                              "job_sat 0..10": c("job_sat").between(0, 10),
                              "experience bucket derived": c("experience_level_canonical").eqNullSafe(
                                  SF.bucket_right_closed("work_exp"))},
                      foreign_keys=fk("role_key", "country_key", "industry_key", "ai_sentiment_key", "ai_open_topic_key")),
        W.Constraints("fact_job_posting_skill", not_null=["job_posting_key", "skill_key"],
                      unique=[["job_posting_key", "skill_key"]],
                      foreign_keys=fk("skill_key", job_posting_key="fact_job_posting")),
        W.Constraints("mart_country_month", not_null=["country_canonical", "year", "month"],
                      unique=[["country_canonical", "year", "month"]]),
        W.Constraints("state_mart_country_month", not_null=["country_canonical", "year", "month", "layoff_events", "share_count"],
                      unique=[["country_canonical", "year", "month"]],
                      checks={"layoff_events > 0": c("layoff_events") > 0,
                              "share_count 0..layoff_events": c("share_count").between(0, c("layoff_events"))}),
    ]


# ---------------------------------------------------------------- J4

def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Every table with its columns and types and without rows, but for the calendar, which is seeded."""
    tables = {name: spark.createDataFrame([], schema) for name, schema in TABLE_SCHEMAS.items()}
    tables["dim_date"] = W.calendar(spark, *CALENDAR).to(TABLE_SCHEMAS["dim_date"])
    return tables


def ensure_warehouse(spark: SparkSession, root: str) -> int:
    """Publish the typed empty tables where nothing is published yet; returns the current version."""
    return W.current_version(spark, root) or W.publish(empty_tables(spark), root)


def reset_warehouse(spark: SparkSession, root: str) -> int:
    """J4 reset: the typed empty tables become the next version; earlier versions stay readable by number."""
    return W.publish(empty_tables(spark), root)


def check_drift(spark: SparkSession, root: str) -> list[str]:
    """Differences between TABLE_SCHEMAS and the current version, empty when there are none."""
    version = W.current_version(spark, root)
    names = [r.table_name for r in W.inventory_rows(spark, root).select("table_name").distinct().collect()]
    found = W.schema_drift(TABLE_SCHEMAS, {n: W.read_published(spark, root, n, version).schema for n in names})
    return found + [f"{n}: unknown table" for n in sorted(set(names) - set(TABLE_SCHEMAS))]


def main(argv: list[str]) -> int:
    """CLI: ``python -m starlift.jobs <raw_dir> <out_dir> <warehouse_root>``."""
    from starlift.session import local_session
    raw_dir, out_dir, root = argv[1:4]
    spark = local_session()
    raw = {"layoffs": os.path.join(raw_dir, "layoffs.csv"), "ai_jobs": os.path.join(raw_dir, "ai_jobs.csv"),
           "survey": os.path.join(raw_dir, "survey.csv")}
    results, failures, status = run_all(spark, raw, out_dir)
    for name, r in results.items():
        print(f"[OK]   {name}: {r.raw_rows} raw, {r.clean_rows} clean, {r.quarantined_rows} quarantined {r.summary}")
    for name, msg in failures.items():
        print(f"[FAIL] {name}: {msg}")
    if not failures:
        ensure_warehouse(spark, root)
        for table, n in load_warehouse(spark, os.path.join(out_dir, "processed"), root).items():
            print(f"[OK]   {table}: {n} row(s) inserted")
    return status


if __name__ == "__main__":
    sys.exit(main(sys.argv))
