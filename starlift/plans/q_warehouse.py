"""Warehouse queries (W1-W21, C1-C16) over the stand-ins."""

from __future__ import annotations

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import conform as CF
from starlift.operators import warehouse as W
from starlift.plans import q_quality as QQ
from starlift.plans import standins as S
from starlift.plans.registry import register
from starlift.session import Tables, ensure_checkpoint_dir

SURVEY_YEAR = 2025
EMERGING_TITLES = ("1-URGENT", "2-HIGH")


# ---------------------------------------------------------------- Spark side

def conformed_layoffs(t: Tables) -> DataFrame:
    """Clean half of the layoff split, conformed (C1, C2) and filled (C6 after mapping, §7.3 X12)."""
    def build():
        clean = QQ.split_dataset(t, "layoff_events")[0]
        out = CF.conform(clean, "country", S.country_map(t), "country_canonical")
        out = out.withColumn("industry_sector", SF.map_lookup("industry", S.SEGMENT_SECTOR))
        return CF.fill_unknown(out, ["stage", "industry"])
    return t.memo("conformed_layoffs", build)


def conformed_postings(t: Tables) -> DataFrame:
    po = CF.conform(S.postings(t), "country", S.country_map(t), "country_canonical")
    return po.withColumn("industry_sector", SF.map_lookup("family", S.SEGMENT_SECTOR))


def posting_label_pairs(t: Tables) -> DataFrame:
    """Distinct (country, family) of the postings, joined once for both dimensions that need them."""
    return t.memo("posting_label_pairs", lambda: S.posting_labels(t).select("country", "family").distinct())


def dim_country(t: Tables) -> DataFrame:
    return t.memo("dim_country", lambda: _dim_country(t))


def _dim_country(t: Tables) -> DataFrame:
    """W2 over three sources, keyed in name order (bounded by the country vocabulary)."""
    cmap = S.country_map(t)
    sup = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("country"))
    srcs = [CF.conform(df.select("country").distinct(), "country", cmap, "country_canonical", extra=["continent"])
            for df in (conformed_layoffs(t), posting_label_pairs(t), sup)]
    d = W.union_distinct(srcs, ["country_canonical", "continent"])
    return W.assign_keys(d, ["country_canonical"], "country_key")


def dim_industry(t: Tables) -> DataFrame:
    return t.memo("dim_industry", lambda: _dim_industry(t))


def _dim_industry(t: Tables) -> DataFrame:
    posting_sectors = posting_label_pairs(t).withColumn("industry_sector", SF.map_lookup("family", S.SEGMENT_SECTOR))
    d = W.union_distinct([conformed_layoffs(t), posting_sectors], ["industry_sector"])
    return W.assign_keys(d, ["industry_sector"], "industry_key")


def dim_company(t: Tables) -> DataFrame:
    return t.memo("dim_company", lambda: _dim_company(t))


def _dim_company(t: Tables) -> DataFrame:
    """Not bounded by a vocabulary, so keys use the distributed allocator."""
    d = conformed_layoffs(t).select(F.col("company").alias("company_name")).dropna().distinct()
    return W.assign_keys(d, ["company_name"], "company_key")


def dim_date(t: Tables) -> DataFrame:
    return W.calendar_covering(t.orders, "o_orderdate")


def fact_layoff_event(t: Tables) -> DataFrame:
    return t.memo("fact_layoff_event", lambda: _fact_layoff_event(t))


def _fact_layoff_event(t: Tables) -> DataFrame:
    """W10 + W12: natural keys -> surrogate keys, smart date key, renamed payload."""
    ev = conformed_layoffs(t).withColumn("date_key", SF.date_key("event_date"))
    ev = W.lookup(ev, dim_company(t), {"company": "company_name"}, "company_key")
    ev = W.lookup(ev, dim_country(t), {"country_canonical": "country_canonical"}, "country_key")
    ev = W.lookup(ev, dim_industry(t), {"industry_sector": "industry_sector"}, "industry_key")
    fact = ev.select("date_key", "company_key", "country_key", "industry_key",
                     F.col("country").alias("location"), "stage", "total_laid_off",
                     # an exact decimal from here on: ties round alike on every engine
                     F.col("percentage_laid_off").cast("decimal(18,9)").alias("percentage_laid_off"),
                     F.col("funds_raised").alias("funds_raised_usd_millions"))
    return W.assign_keys(fact, ["company_key", "date_key", "location"], "layoff_event_key")


def dim_role(t: Tables) -> DataFrame:
    return t.memo("dim_role", lambda: _dim_role(t))


def _dim_role(t: Tables) -> DataFrame:
    """First posting per title (+ family, llm flag) UNION ALL distinct answer sources (NULL attributes)."""
    po = S.postings(t)
    titles = W.first_per_group(po, ["title"], ["posting_id"], ["family", "is_llm_role"]).select(
        F.lit("title").alias("role_source"), F.col("title").alias("role_title"),
        F.when(F.col("title").isin(*EMERGING_TITLES), "Emerging").otherwise("Traditional").alias("role_category"),
        F.col("family").alias("job_category"), "is_llm_role")
    sources = S.labelled_docs(t).select("source").dropna().distinct().select(
        F.lit("source").alias("role_source"), F.col("source").alias("role_title"),
        F.lit("Traditional").alias("role_category"))
    both = titles.unionByName(sources, allowMissingColumns=True)
    return W.assign_keys(both, ["role_source", "role_title"], "role_key")


JUNK_COLS = ["lang", "source", "quality_answer", "toxic_answer"]


def dim_answer_combo(t: Tables) -> DataFrame:
    return t.memo("dim_answer_combo", lambda: _dim_answer_combo(t))


def _dim_answer_combo(t: Tables) -> DataFrame:
    """Junk dimension of four low-cardinality answers."""
    d = W.junk_dimension(S.labelled_docs(t), JUNK_COLS)
    return W.assign_keys(d, JUNK_COLS, "answer_combo_key")


def dim_skill(t: Tables) -> DataFrame:
    return t.memo("dim_skill", lambda: _dim_skill(t))


def _dim_skill(t: Tables) -> DataFrame:
    d = S.skills(t).select(F.col("skill").alias("skill_name")).where("skill_name != ''")
    return W.assign_keys(d, ["skill_name"], "skill_key")


def fact_job_posting(t: Tables) -> DataFrame:
    return t.memo("fact_job_posting", lambda: _fact_job_posting(t))


def _fact_job_posting(t: Tables) -> DataFrame:
    """Posting fact with month-grain date key (C15), tier (C16) and derived flags."""
    po = conformed_postings(t)
    po = W.lookup(po.withColumn("role_source", F.lit("title")), dim_role(t),
                  {"role_source": "role_source", "title": "role_title"}, "role_key")
    po = W.lookup(po, dim_country(t), {"country_canonical": "country_canonical"}, "country_key")
    po = W.lookup(po, dim_industry(t), {"industry_sector": "industry_sector"}, "industry_key")
    fact = po.select(
        F.col("posting_id").alias("job_id"), SF.month_key("posting_year", "posting_month").alias("date_key"),
        "role_key", "country_key", "industry_key", F.col("education").alias("education_required"),
        F.col("experience_level").alias("experience_level_canonical"),
        F.col("salary").alias("annual_salary_usd"), "demand_score",
        F.col("demand_growth").alias("demand_growth_yoy_pct"),
        F.col("experience_level").isin("Senior", "Lead").alias("is_senior"),
        SF.salary_tier("salary").alias("salary_tier"))
    return W.assign_keys(fact, ["job_id"], "job_posting_key")


def fact_survey_response(t: Tables) -> DataFrame:
    """Constant survey year, conditional role lookup, junk-dimension key, bucketed experience."""
    ld = S.labelled_docs(t).withColumn("work_exp", F.col("n_chars") / 1000.0)
    ld = W.lookup(ld.withColumn("role_source", F.lit("source")), dim_role(t),
                  {"role_source": "role_source", "source": "role_title"}, "role_key")
    ld = W.lookup(ld, dim_answer_combo(t), {c: c for c in JUNK_COLS}, "answer_combo_key")
    fact = ld.select(F.lit(SURVEY_YEAR).alias("survey_year"), F.col("doc_id").alias("response_id"),
                     "role_key", "answer_combo_key", "work_exp",
                     SF.bucket_right_closed("work_exp").alias("experience_level_canonical"))
    return W.assign_keys(fact, ["survey_year", "response_id"], "response_key")


def bridge_posting_skill(t: Tables) -> DataFrame:
    """(posting key, skill key), unknown/empty skills skipped, distinct by the pair.

    ``posting_skills`` has each pair once, a posting key belongs to one posting and a skill key to one skill, so the
    joined pairs are distinct as they are.
    """
    ps = S.posting_skills(t).where("skill != ''")
    fp = fact_job_posting(t).select("job_posting_key", F.col("job_id").alias("posting_id"))
    ds = dim_skill(t)
    return (ps.join(fp, "posting_id").join(ds, ps.skill == ds.skill_name)
            .select("job_posting_key", "skill_key"))


def mart_country_month(t: Tables) -> DataFrame:
    return W.country_month_mart(fact_layoff_event(t), dim_date(t), dim_country(t))


# ---------------------------------------------------------------- SQL twins

_SECTOR_CASE = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.SEGMENT_SECTOR.items()) + " END"
WAREHOUSE_SQL = "WITH " + QQ.LAYOFF_TAGGED_SQL.strip() + ",\n" + S.POSTINGS_SQL.strip() + ",\n" + S.LABELLED_DOCS_SQL.strip() + f""",
evc AS (
  SELECT e.event_id, e.company, e.event_date, e.country, e.continent, coalesce(e.industry, 'Unknown') AS industry,
         coalesce(e.stage, 'Unknown') AS stage, e.total_laid_off, e.percentage_laid_off, e.funds_raised,
         m.canonical AS country_canonical, {_SECTOR_CASE.format(c='e.industry')} AS industry_sector
  FROM evq e LEFT JOIN cmap m ON e.country = m.raw WHERE e.reasons = ''),
poc AS (
  SELECT p.*, m.canonical AS country_canonical, {_SECTOR_CASE.format(c='p.family')} AS industry_sector
  FROM po p LEFT JOIN cmap m ON p.country = m.raw),
dc_src AS (
  SELECT m.canonical AS country_canonical, m.continent FROM evc JOIN cmap m ON evc.country = m.raw
  UNION SELECT m.canonical, m.continent FROM poc JOIN cmap m ON poc.country = m.raw
  UNION SELECT m.canonical, m.continent FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN cmap m ON n_name = m.raw),
dim_country AS (
  SELECT CAST(row_number() OVER (ORDER BY country_canonical) AS BIGINT) AS country_key, country_canonical, continent
  FROM dc_src WHERE country_canonical IS NOT NULL AND continent IS NOT NULL),
dim_industry AS (
  SELECT CAST(row_number() OVER (ORDER BY industry_sector) AS BIGINT) AS industry_key, industry_sector
  FROM (SELECT industry_sector FROM evc UNION SELECT industry_sector FROM poc) WHERE industry_sector IS NOT NULL),
dim_company AS (
  SELECT CAST(row_number() OVER (ORDER BY company) AS BIGINT) AS company_key, company AS company_name
  FROM (SELECT DISTINCT company FROM evc WHERE company IS NOT NULL)),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day
  FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
                                      date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                      INTERVAL 1 DAY)) AS d FROM orders)),
fl0 AS (
  SELECT CAST(year(e.event_date) * 10000 + month(e.event_date) * 100 + day(e.event_date) AS INTEGER) AS date_key,
         dco.company_key, dc.country_key, di.industry_key, e.country AS location, e.stage, e.total_laid_off,
         CAST(e.percentage_laid_off AS DECIMAL(18,9)) AS percentage_laid_off, e.funds_raised AS funds_raised_usd_millions
  FROM evc e LEFT JOIN dim_company dco ON e.company = dco.company_name
  LEFT JOIN dim_country dc ON e.country_canonical = dc.country_canonical
  LEFT JOIN dim_industry di ON e.industry_sector = di.industry_sector),
fact_layoff_event AS (
  SELECT CAST(row_number() OVER (ORDER BY company_key, date_key, location) AS BIGINT) AS layoff_event_key, * FROM fl0),
dim_role AS (
  SELECT CAST(row_number() OVER (ORDER BY role_source, role_title) AS BIGINT) AS role_key, * FROM (
    SELECT 'title' AS role_source, title AS role_title,
           CASE WHEN title IN ('1-URGENT', '2-HIGH') THEN 'Emerging' ELSE 'Traditional' END AS role_category,
           arg_min(family, posting_id) AS job_category, arg_min(is_llm_role, posting_id) AS is_llm_role
    FROM po GROUP BY title
    UNION ALL
    SELECT DISTINCT 'source', source, 'Traditional', CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN)
    FROM ld WHERE source IS NOT NULL)),
dim_answer_combo AS (
  SELECT CAST(row_number() OVER (ORDER BY lang, source, quality_answer, toxic_answer) AS BIGINT) AS answer_combo_key, *
  FROM (SELECT DISTINCT lang, source, quality_answer, toxic_answer FROM ld WHERE lang IS NOT NULL AND source IS NOT NULL)),
""" + S.POSTING_SKILLS_SQL.strip() + """,
dim_skill AS (
  SELECT CAST(row_number() OVER (ORDER BY skill) AS BIGINT) AS skill_key, skill AS skill_name
  FROM (SELECT DISTINCT skill FROM ps WHERE skill <> '')),
fp0 AS (
  SELECT p.posting_id AS job_id, CAST(p.posting_year * 10000 + p.posting_month * 100 + 1 AS INTEGER) AS date_key,
         r.role_key, dc.country_key, di.industry_key, p.education AS education_required,
         p.experience_level AS experience_level_canonical, p.salary AS annual_salary_usd, p.demand_score,
         p.demand_growth AS demand_growth_yoy_pct, p.experience_level IN ('Senior', 'Lead') AS is_senior,
         CASE WHEN p.salary IS NULL THEN NULL WHEN p.salary <= 100000 THEN 'Entry (<$100k)'
              WHEN p.salary <= 150000 THEN 'Mid ($100-150k)' WHEN p.salary <= 200000 THEN 'Upper-Mid ($150-200k)'
              WHEN p.salary <= 300000 THEN 'Senior ($200-300k)' ELSE 'Elite (>$300k)' END AS salary_tier
  FROM poc p LEFT JOIN dim_role r ON r.role_source = 'title' AND p.title = r.role_title
  LEFT JOIN dim_country dc ON p.country_canonical = dc.country_canonical
  LEFT JOIN dim_industry di ON p.industry_sector = di.industry_sector),
fact_job_posting AS (SELECT CAST(row_number() OVER (ORDER BY job_id) AS BIGINT) AS job_posting_key, * FROM fp0)"""


def _sql(select: str) -> str:
    return WAREHOUSE_SQL + "\n" + select


@register("w1_calendar", _sql("SELECT * FROM dim_date"))
def w1_calendar(spark, sf_dir):
    return dim_date(Tables(spark, sf_dir))


@register("w2_dim_country", _sql("SELECT * FROM dim_country"))
def w2_dim_country(spark, sf_dir):
    return dim_country(Tables(spark, sf_dir))


@register("w2_dim_industry", _sql("SELECT * FROM dim_industry"))
def w2_dim_industry(spark, sf_dir):
    return dim_industry(Tables(spark, sf_dir))


@register("w3_dim_company", _sql("SELECT * FROM dim_company"))
def w3_dim_company(spark, sf_dir):
    return dim_company(Tables(spark, sf_dir))


@register("w3_dim_skill", _sql("SELECT * FROM dim_skill"))
def w3_dim_skill(spark, sf_dir):
    return dim_skill(Tables(spark, sf_dir))


@register("w4_dim_role", _sql("SELECT * FROM dim_role"))
def w4_dim_role(spark, sf_dir):
    return dim_role(Tables(spark, sf_dir))


@register("w5_junk_dimension", _sql("SELECT * FROM dim_answer_combo"))
def w5_junk_dimension(spark, sf_dir):
    return dim_answer_combo(Tables(spark, sf_dir))


@register("w12_fact_layoff_event", _sql("""
SELECT layoff_event_key, date_key, company_key, country_key, industry_key, location, stage,
       round(total_laid_off, 2) AS total_laid_off, CAST(round(percentage_laid_off, 6) AS DOUBLE) AS percentage_laid_off,
       round(funds_raised_usd_millions, 2) AS funds_raised_usd_millions FROM fact_layoff_event"""))
def w12_fact_layoff_event(spark, sf_dir):
    f = fact_layoff_event(Tables(spark, sf_dir))
    return f.select("layoff_event_key", "date_key", "company_key", "country_key", "industry_key", "location", "stage",
                    SF.rounded("total_laid_off", 2).alias("total_laid_off"),
                    F.round("percentage_laid_off", 6).cast("double").alias("percentage_laid_off"),
                    SF.rounded("funds_raised_usd_millions", 2).alias("funds_raised_usd_millions"))


@register("w13_fact_job_posting", _sql("""
SELECT job_posting_key, job_id, date_key, role_key, country_key, industry_key, education_required,
       experience_level_canonical, round(annual_salary_usd, 2) AS annual_salary_usd, demand_score,
       round(demand_growth_yoy_pct, 6) AS demand_growth_yoy_pct, is_senior, salary_tier FROM fact_job_posting"""))
def w13_fact_job_posting(spark, sf_dir):
    f = fact_job_posting(Tables(spark, sf_dir))
    return f.select("job_posting_key", "job_id", "date_key", "role_key", "country_key", "industry_key",
                    "education_required", "experience_level_canonical",
                    SF.rounded("annual_salary_usd", 2).alias("annual_salary_usd"), "demand_score",
                    SF.rounded("demand_growth_yoy_pct", 6).alias("demand_growth_yoy_pct"), "is_senior", "salary_tier")


@register("w14_fact_survey_response", _sql("""
SELECT CAST(row_number() OVER (ORDER BY response_id) AS BIGINT) AS response_key, * FROM (
  SELECT 2025 AS survey_year, ld.doc_id AS response_id, r.role_key, j.answer_combo_key,
         round(ld.n_chars / 1000.0, 6) AS work_exp,
         CASE WHEN ld.n_chars IS NULL THEN NULL WHEN ld.n_chars / 1000.0 <= 2 THEN 'Entry'
              WHEN ld.n_chars / 1000.0 <= 5 THEN 'Mid' WHEN ld.n_chars / 1000.0 <= 9 THEN 'Senior' ELSE 'Lead' END
           AS experience_level_canonical
  FROM ld LEFT JOIN dim_role r ON r.role_source = 'source' AND ld.source = r.role_title
  LEFT JOIN dim_answer_combo j ON ld.lang = j.lang AND ld.source = j.source AND ld.quality_answer = j.quality_answer
                              AND ld.toxic_answer = j.toxic_answer)"""))
def w14_fact_survey_response(spark, sf_dir):
    f = fact_survey_response(Tables(spark, sf_dir))
    return f.withColumn("work_exp", SF.rounded("work_exp", 6))


@register("w15_bridge_posting_skill", _sql("""
SELECT DISTINCT f.job_posting_key, s.skill_key FROM ps JOIN fact_job_posting f ON ps.posting_id = f.job_id
JOIN dim_skill s ON ps.skill = s.skill_name WHERE ps.skill <> ''"""))
def w15_bridge_posting_skill(spark, sf_dir):
    return bridge_posting_skill(Tables(spark, sf_dir))


MART_SQL = _sql("""
SELECT coalesce(dc.country_canonical, '(Unknown)') AS country_canonical, d.year, d.month,
       CAST(count(*) AS BIGINT) AS layoff_events, round(sum(f.total_laid_off), 2) AS total_laid_off,
       CAST(((2 * CAST(sum(f.percentage_laid_off) * 1000000000 AS HUGEINT) * 10000 + count(f.percentage_laid_off))
             // (2 * count(f.percentage_laid_off)) + 5000000) // 10000000 AS DOUBLE) / 1000000 AS avg_percentage_laid_off
FROM fact_layoff_event f JOIN dim_date d ON d.date_key = f.date_key
LEFT JOIN dim_country dc ON dc.country_key = f.country_key
GROUP BY 1, d.year, d.month""")


@register("w16_mart_country_month", MART_SQL)
def w16_mart_country_month(spark, sf_dir):
    """Flagship: contract -> quality split -> conform -> star join -> mart."""
    m = mart_country_month(Tables(spark, sf_dir))
    return m.select("country_canonical", "year", "month", "layoff_events",
                    SF.rounded("total_laid_off", 2).alias("total_laid_off"),
                    F.round("avg_percentage_laid_off", 6).cast("double").alias("avg_percentage_laid_off"))


@register("w17_mart_uniqueness", f"""
WITH mart AS ({MART_SQL})
SELECT 'mart_country_month' AS table_name, 'not_null(country_canonical)' AS constraint_name,
       CAST(count(*) FILTER (WHERE country_canonical IS NULL) AS BIGINT) AS violations FROM mart
UNION ALL SELECT 'mart_country_month', 'unique(country_canonical,year,month)',
       CAST(count(*) - count(DISTINCT (country_canonical, year, month)) AS BIGINT) FROM mart""")
def w17_mart_uniqueness(spark, sf_dir):
    """The rebuilt mart has one row per country and month."""
    mart = mart_country_month(Tables(spark, sf_dir))
    return W.check_constraints(mart, W.Constraints("mart_country_month", not_null=["country_canonical"],
                                                   unique=[["country_canonical", "year", "month"]]))


ARRIVALS = 3


def _arrival(date_key: str) -> Column:
    """Load of a fact in the queries below: first, second or last third of the event's month."""
    return F.least(F.floor((F.col(date_key) % 100 - 1) / 11), F.lit(ARRIVALS - 1)).cast("int")


def loaded_in_arrivals(t: Tables) -> str:
    """The layoff facts arrive in three loads, each appended with its refreshed mart as a version of its
    own; returns the folder of the warehouse, which lies in the shared checkpoint folder."""
    spark = t.spark
    root = os.path.join(ensure_checkpoint_dir(spark), f"warehouse-{uuid.uuid4().hex[:12]}")
    # only the columns loaded here are cached, not the whole fact beside them
    fact, cal, countries = _fact_layoff_event(t), dim_date(t), dim_country(t)
    cols = ("date_key", "country_key", "total_laid_off", "percentage_laid_off")
    fact = fact.select("layoff_event_key", *cols).persist(StorageLevel.MEMORY_AND_DISK)
    version = W.append(spark, root, 0, {"dim_date": cal, "dim_country": countries, "fact_layoff_event": fact.limit(0)})
    cal, countries = (W.read_published(spark, root, n) for n in ("dim_date", "dim_country"))

    def declared(tables):
        return [W.Constraints("fact_layoff_event", not_null=["layoff_event_key", "date_key"], unique=[["layoff_event_key"]],
                              foreign_keys={"date_key": (tables["dim_date"], "date_key"),
                                            "country_key": (tables["dim_country"], "country_key")}),
                W.Constraints("mart_country_month", unique=[["country_canonical", "year", "month"]])]

    for load in range(ARRIVALS):
        new = fact.where(_arrival("date_key") == load)
        replaced, whole = W.refreshed_mart(spark, root, version, "mart_country_month", new, cal, countries, lambda new=new: new)
        version = W.append(spark, root, version, {"fact_layoff_event": new}, replaced, declared, whole)
    fact.unpersist()
    return root


@register("w17_incremental_mart", MART_SQL)
def w17_incremental_mart(spark, sf_dir):
    """The mart after three appended loads, kept from states; equals the mart built in one go."""
    m = W.read_published(spark, loaded_in_arrivals(Tables(spark, sf_dir)), "mart_country_month")
    return m.select("country_canonical", "year", "month", "layoff_events",
                    SF.rounded("total_laid_off", 2).alias("total_laid_off"),
                    F.round("avg_percentage_laid_off", 6).cast("double").alias("avg_percentage_laid_off"))


@register("w18_published_versions", _sql("""
, arrived AS (SELECT least((f.date_key % 100 - 1) // 11, 2) AS load, f.date_key, d.year, d.month, dc.country_canonical
              FROM fact_layoff_event f JOIN dim_date d ON d.date_key = f.date_key
              LEFT JOIN dim_country dc ON dc.country_key = f.country_key)
SELECT CAST(v.version AS INTEGER) AS version, 'fact' AS kind, 'fact_layoff_event' AS table_name,
       CAST(count(a.load) AS BIGINT) AS row_count
FROM range(1, 5) v(version) LEFT JOIN arrived a ON a.load < v.version - 1 GROUP BY 1
UNION ALL
SELECT CAST(v.version AS INTEGER), 'mart', 'mart_country_month',
       CAST(count(DISTINCT (coalesce(country_canonical, '(Unknown)'), year, month)) AS BIGINT)
FROM range(2, 5) v(version) JOIN arrived a ON a.load < v.version - 1 GROUP BY 1
UNION ALL
SELECT CAST(v.version AS INTEGER), 'dimension', n, c
FROM range(1, 5) v(version),
     (SELECT 'dim_date' AS n, CAST(count(*) AS BIGINT) AS c FROM dim_date
      UNION ALL SELECT 'dim_country', CAST(count(*) AS BIGINT) FROM dim_country)"""))
def w18_published_versions(spark, sf_dir):
    """Tables and rows of every published version, from the manifests of the appended loads."""
    rows = W.versions(spark, loaded_in_arrivals(Tables(spark, sf_dir)))
    return rows.where(F.col("kind") != "state")


@register("w11_role_playing_dates", """
WITH li AS (SELECT CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS order_date_key,
                   CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS ship_date_key
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
cal AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year
        FROM (SELECT unnest(generate_series(date_trunc('year', least(min(o_orderdate), (SELECT min(l_shipdate) FROM lineitem))),
                                            date_trunc('year', greatest(max(o_orderdate), (SELECT max(l_shipdate) FROM lineitem))) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                            INTERVAL 1 DAY)) AS d FROM orders))
SELECT od.year AS order_year, sd.year AS ship_year, CAST(count(*) AS BIGINT) AS line_count
FROM li JOIN cal od ON li.order_date_key = od.date_key JOIN cal sd ON li.ship_date_key = sd.date_key
GROUP BY 1, 2""")
def w11_role_playing_dates(spark, sf_dir):
    """One calendar playing two roles (order date, ship date)."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    dates = t.orders.select(F.col("o_orderdate").alias("d")).unionByName(t.lineitem.select(F.col("l_shipdate").alias("d")))
    cal = W.calendar_covering(dates, "d").select("date_key", "year")
    keyed = li.select(SF.date_key("o_orderdate").alias("order_date_key"), SF.date_key("l_shipdate").alias("ship_date_key"))
    od, sd = cal.alias("od"), cal.alias("sd")
    j = (keyed.join(F.broadcast(od), F.col("order_date_key") == F.col("od.date_key"))
         .join(F.broadcast(sd), F.col("ship_date_key") == F.col("sd.date_key")))
    return j.groupBy(F.col("od.year").alias("order_year"), F.col("sd.year").alias("ship_year")) \
        .agg(F.count(F.lit(1)).alias("line_count"))


@register("w8_insert_if_absent", _sql("""
, existing AS (
  SELECT CAST(row_number() OVER (ORDER BY company) AS BIGINT) AS company_key, company AS company_name
  FROM (SELECT DISTINCT company FROM evc WHERE event_date < DATE '1998-01-01')),
fresh AS (SELECT DISTINCT company FROM evc WHERE company NOT IN (SELECT company_name FROM existing))
SELECT CAST((SELECT max(company_key) FROM existing) + row_number() OVER (ORDER BY company) AS BIGINT) AS company_key,
       company AS company_name FROM fresh"""))
def w8_insert_if_absent(spark, sf_dir):
    """Load of all companies into a dimension that already holds the pre-1998 ones."""
    ev = conformed_layoffs(Tables(spark, sf_dir)).select(F.col("company").alias("company_name"), "event_date")
    existing = W.insert_if_absent(None, ev.where(F.col("event_date") < F.lit("1998-01-01").cast("date"))
                                  .select("company_name").dropna(), ["company_name"], "company_key")
    batch = ev.select("company_name").dropna()
    return W.insert_if_absent(existing, batch, ["company_name"], "company_key")


@register("w8_repeat_load_inserts", _sql("""
SELECT 1 AS load_run, CAST(count(*) AS BIGINT) AS inserted_rows FROM dim_company
UNION ALL SELECT 2, CAST(0 AS BIGINT)"""))
def w8_repeat_load_inserts(spark, sf_dir):
    """W8 idempotency: the second load of the same batch inserts nothing."""
    ev = conformed_layoffs(Tables(spark, sf_dir)).select(F.col("company").alias("company_name")).dropna()
    first = W.insert_if_absent(None, ev, ["company_name"], "company_key")
    second = W.insert_if_absent(first, ev, ["company_name"], "company_key")
    return (first.agg(F.count(F.lit(1)).alias("inserted_rows")).select(F.lit(1).alias("load_run"), "inserted_rows")
            .unionByName(second.agg(F.count(F.lit(1)).alias("inserted_rows"))
                         .select(F.lit(2).alias("load_run"), "inserted_rows")))


def layoff_constraints(t: Tables, fact: DataFrame) -> W.Constraints:
    return W.Constraints(
        table="fact_layoff_event",
        not_null=["date_key", "company_key", "location", "stage"],
        unique=[["company_key", "date_key", "location"], ["layoff_event_key"]],
        checks={"total_laid_off >= 0": F.col("total_laid_off") >= 0,
                "percentage_laid_off between 0 and 1": F.col("percentage_laid_off").between(0, 1),
                "funds_raised_usd_millions >= 0": F.col("funds_raised_usd_millions") >= 0},
        foreign_keys={"date_key": (dim_date(t), "date_key"), "company_key": (dim_company(t), "company_key"),
                      "country_key": (dim_country(t), "country_key"),
                      "industry_key": (dim_industry(t), "industry_key")})


@register("w9_constraints_fact_layoff", _sql("""
SELECT 'fact_layoff_event' AS table_name, constraint_name, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'not_null(date_key)' AS constraint_name, count(*) FILTER (WHERE date_key IS NULL) AS violations FROM fact_layoff_event
  UNION ALL SELECT 'not_null(company_key)', count(*) FILTER (WHERE company_key IS NULL) FROM fact_layoff_event
  UNION ALL SELECT 'not_null(location)', count(*) FILTER (WHERE location IS NULL) FROM fact_layoff_event
  UNION ALL SELECT 'not_null(stage)', count(*) FILTER (WHERE stage IS NULL) FROM fact_layoff_event
  UNION ALL SELECT 'check(total_laid_off >= 0)', count(*) FILTER (WHERE total_laid_off < 0) FROM fact_layoff_event
  UNION ALL SELECT 'check(percentage_laid_off between 0 and 1)',
                   count(*) FILTER (WHERE NOT (percentage_laid_off BETWEEN 0 AND 1)) FROM fact_layoff_event
  UNION ALL SELECT 'check(funds_raised_usd_millions >= 0)',
                   count(*) FILTER (WHERE funds_raised_usd_millions < 0) FROM fact_layoff_event
  UNION ALL SELECT 'unique(company_key,date_key,location)', coalesce(sum(n - 1), 0) FROM (
    SELECT count(*) AS n FROM fact_layoff_event WHERE company_key IS NOT NULL AND date_key IS NOT NULL
    AND location IS NOT NULL GROUP BY company_key, date_key, location HAVING count(*) > 1)
  UNION ALL SELECT 'unique(layoff_event_key)', coalesce(sum(n - 1), 0) FROM (
    SELECT count(*) AS n FROM fact_layoff_event GROUP BY layoff_event_key HAVING count(*) > 1)
  UNION ALL SELECT 'fk(date_key)', count(*) FROM fact_layoff_event
    WHERE date_key IS NOT NULL AND date_key NOT IN (SELECT date_key FROM dim_date)
  UNION ALL SELECT 'fk(company_key)', count(*) FROM fact_layoff_event
    WHERE company_key IS NOT NULL AND company_key NOT IN (SELECT company_key FROM dim_company)
  UNION ALL SELECT 'fk(country_key)', count(*) FROM fact_layoff_event
    WHERE country_key IS NOT NULL AND country_key NOT IN (SELECT country_key FROM dim_country)
  UNION ALL SELECT 'fk(industry_key)', count(*) FROM fact_layoff_event
    WHERE industry_key IS NOT NULL AND industry_key NOT IN (SELECT industry_key FROM dim_industry))"""))
def w9_constraints_fact_layoff(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fact = fact_layoff_event(t)
    return W.check_constraints(fact, layoff_constraints(t, fact))


@register("w21_reconciliation", _sql("""
, mart AS (
  SELECT coalesce(dc.country_canonical, '(Unknown)') AS country_canonical, d.year, d.month,
         count(*) AS layoff_events, sum(f.total_laid_off) AS total_laid_off
  FROM fact_layoff_event f JOIN dim_date d ON d.date_key = f.date_key
  LEFT JOIN dim_country dc ON dc.country_key = f.country_key GROUP BY 1, 2, 3)
SELECT 'mart events = fact rows' AS check_name, round(CAST((SELECT sum(layoff_events) FROM mart) AS DOUBLE), 2) AS lhs,
       round(CAST((SELECT count(*) FROM fact_layoff_event) AS DOUBLE), 2) AS rhs
UNION ALL SELECT 'mart headcount = fact headcount', round((SELECT sum(total_laid_off) FROM mart), 2),
       round((SELECT sum(total_laid_off) FROM fact_layoff_event), 2)
UNION ALL SELECT 'fact rows = clean rows', round(CAST((SELECT count(*) FROM fact_layoff_event) AS DOUBLE), 2),
       round(CAST((SELECT count(*) FROM evc) AS DOUBLE), 2)"""))
def w21_reconciliation(spark, sf_dir):
    """Mart totals equal fact totals, fact rows equal clean rows (one small job per side)."""
    t = Tables(spark, sf_dir)
    fact = fact_layoff_event(t).cache()
    mart = W.country_month_mart(fact, dim_date(t), dim_country(t))
    m = mart.agg(F.sum("layoff_events").cast("double").alias("e"), F.sum("total_laid_off").alias("h"))
    f = fact.agg(F.count(F.lit(1)).cast("double").alias("e"), F.sum("total_laid_off").alias("h"))
    c = conformed_layoffs(t).agg(F.count(F.lit(1)).cast("double").alias("e"))
    mf = m.crossJoin(f.select(F.col("e").alias("fe"), F.col("h").alias("fh"))).crossJoin(c.select(F.col("e").alias("ce")))
    return mf.select(F.explode(F.array(
        F.struct(F.lit("mart events = fact rows").alias("check_name"), SF.rounded("e", 2).alias("lhs"),
                 SF.rounded("fe", 2).alias("rhs")),
        F.struct(F.lit("mart headcount = fact headcount").alias("check_name"), SF.rounded("h", 2).alias("lhs"),
                 SF.rounded("fh", 2).alias("rhs")),
        F.struct(F.lit("fact rows = clean rows").alias("check_name"), SF.rounded("fe", 2).alias("lhs"),
                 SF.rounded("ce", 2).alias("rhs")))).alias("s")).select("s.*")
