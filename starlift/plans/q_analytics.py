"""Analytic tiles A1-A40 over the warehouse stand-ins.

Layoff tiles read the quality-checked, conformed events; posting tiles the
postings and the skill bridge; survey tiles the labelled documents and user
events. Every aggregate is a grouped aggregate (partial per partition);
windows only run over already-aggregated rows (bounded by the number of
groups), and top-k uses ``orderBy().limit()`` (per-partition top-k, no
global sort of the input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import stats as ST
from starlift.plans import q_warehouse as QW
from starlift.plans import standins as S
from starlift.plans.registry import register
from starlift.session import Tables, spread

# Fixed values (parameters of the tiles).
MIN_GROUP_N = 30                      # A9, A10, A23, A29: suppress groups below this size
POOLED_STAGES = ("4-NOT SPECIFIED", "5-LOW")   # A9: pooled into "Other"
TOP_N = 10                            # A11-A13
PERIOD_MONTHS = 12                    # A14
FOCUS_COUNTRY = "NATION 24"           # A17: share of one market
FOCUS_FAMILY = "BUILDING"             # A19, A24
TOP_SKILLS = 12                       # A22
FAMILY_TOP_SKILLS = 8                 # A24
SLICER = {"from": "1996-01-01", "to": "1997-12-31", "continent": "EUROPE"}   # A16
EVENT_THEME = {"view": "browse", "click": "browse", "signup": "commit", "purchase": "commit", "error": "friction"}
EXCLUDED_THEME_EVENTS = ("error",)    # A32: answers outside the skill themes


def r(c, d: int = 6):
    return SF.rounded(c, d)


def R(x: str, d: int = 6) -> str:
    return f"(round({x}, {d}) + 0.0)"


def events(t: Tables) -> DataFrame:
    ev = QW.conformed_layoffs(t)
    return ev.withColumn("month_start", F.trunc("event_date", "month")).withColumn("yr", F.year("event_date"))


BASE_SQL = QW.WAREHOUSE_SQL + """,
evm AS (SELECT *, CAST(date_trunc('month', event_date) AS DATE) AS month_start, CAST(year(event_date) AS INTEGER) AS yr
        FROM evc)"""


def _sql(select: str, extra: str = "") -> str:
    return BASE_SQL + extra + "\n" + select


# ---------------------------------------------------------------- A1-A16 layoffs

def _kpis(ev: DataFrame) -> DataFrame:
    return ev.agg(
        r(F.sum("total_laid_off"), 2).alias("people"),
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("company").alias("companies"),
        F.count_distinct("month_start").alias("months"),
        r(F.avg(F.col("total_laid_off").isNotNull().cast("double")) * 100.0, 6).alias("pct_with_headcount"))


KPI_SQL = f"""SELECT {R('sum(total_laid_off)', 2)} AS people, CAST(count(*) AS BIGINT) AS events,
       CAST(count(DISTINCT company) AS BIGINT) AS companies, CAST(count(DISTINCT month_start) AS BIGINT) AS months,
       {R('avg(CASE WHEN total_laid_off IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100.0')} AS pct_with_headcount FROM evm"""


@register("a1_kpi_row", _sql(KPI_SQL))
def a1_kpi_row(spark, sf_dir):
    return _kpis(events(Tables(spark, sf_dir)))


@register("a16_slicer_kpis", _sql(KPI_SQL + f" WHERE event_date BETWEEN DATE '{SLICER['from']}' AND DATE '{SLICER['to']}'"
                                  f" AND continent = '{SLICER['continent']}'"))
def a16_slicer_kpis(spark, sf_dir):
    """The slicers are filters applied before the tile's aggregate (pushed to the scan where possible)."""
    ev = events(Tables(spark, sf_dir)).where(
        F.col("event_date").between(F.lit(SLICER["from"]).cast("date"), F.lit(SLICER["to"]).cast("date"))
        & (F.col("continent") == SLICER["continent"]))
    return _kpis(ev)


@register("a2_monthly_trend", _sql(f"""
, months AS (SELECT CAST(unnest(generate_series(min(month_start), max(month_start), INTERVAL 1 MONTH)) AS DATE) AS month_start
             FROM evm),
agg AS (SELECT month_start, count(*) AS events, sum(total_laid_off) AS people FROM evm GROUP BY month_start)
SELECT m.month_start, CAST(coalesce(a.events, 0) AS BIGINT) AS events, {R('a.people', 2)} AS people
FROM months m LEFT JOIN agg a ON m.month_start = a.month_start"""))
def a2_monthly_trend(spark, sf_dir):
    """A2: gap-free monthly series (calendar months right-joined to the aggregate)."""
    ev = events(Tables(spark, sf_dir))
    agg = ev.groupBy("month_start").agg(F.count(F.lit(1)).alias("events"), F.sum("total_laid_off").alias("people"))
    months = ev.agg(F.min("month_start").alias("lo"), F.max("month_start").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return months.join(agg, "month_start", "left").select(
        "month_start", F.coalesce("events", F.lit(0)).cast("long").alias("events"), r("people", 2).alias("people"))


@register("a3_small_multiples", _sql(f"""
SELECT month_start, continent, CAST(count(*) AS BIGINT) AS events, {R('sum(total_laid_off)', 2)} AS people
FROM evm GROUP BY month_start, continent"""))
def a3_small_multiples(spark, sf_dir):
    ev = events(Tables(spark, sf_dir))
    return ev.groupBy("month_start", "continent").agg(
        F.count(F.lit(1)).alias("events"), r(F.sum("total_laid_off"), 2).alias("people"))


@register("a4_yearly_peak", _sql(f"""
, bym AS (SELECT yr, month_start, sum(total_laid_off) AS people, count(*) AS events FROM evm GROUP BY yr, month_start),
ranked AS (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY people DESC NULLS LAST, month_start) AS rn FROM bym)
SELECT yr AS year, {R('sum(people)', 2)} AS people, CAST(sum(events) AS BIGINT) AS events,
       max(CASE WHEN rn = 1 THEN month_start END) AS peak_month, {R('max(CASE WHEN rn = 1 THEN people END)', 2)} AS peak_people
FROM ranked GROUP BY yr"""))
def a4_yearly_peak(spark, sf_dir):
    """A4: yearly totals and the peak month of each year (ties -> earliest month)."""
    ev = events(Tables(spark, sf_dir))
    bym = ev.groupBy("yr", "month_start").agg(F.sum("total_laid_off").alias("people"), F.count(F.lit(1)).alias("events"))
    order = F.struct(F.coalesce("people", F.lit(float("-inf"))).alias("p"),
                     F.datediff(F.lit("2999-12-31").cast("date"), "month_start").alias("early"))
    return bym.groupBy(F.col("yr").alias("year")).agg(
        r(F.sum("people"), 2).alias("people"), F.sum("events").cast("long").alias("events"),
        F.max_by("month_start", order).alias("peak_month"), r(F.max_by("people", order), 2).alias("peak_people"))


@register("a5_geographic_share", _sql(f"""
, bc AS (SELECT country_canonical, continent, sum(total_laid_off) AS people FROM evm GROUP BY ALL)
SELECT country_canonical, continent, {R('people', 2)} AS people,
       {R('people * 100.0 / sum(people) OVER ()')} AS pct_of_total,
       {R('people * 100.0 / sum(people) OVER (PARTITION BY continent)')} AS pct_of_continent FROM bc"""))
def a5_geographic_share(spark, sf_dir):
    ev = events(Tables(spark, sf_dir))
    bc = ev.groupBy("country_canonical", "continent").agg(F.sum("total_laid_off").alias("people"))
    return bc.select("country_canonical", "continent", r("people", 2).alias("people"),
                     r(ST.share_of_total("people") * 100.0).alias("pct_of_total"),
                     r(ST.share_of_total("people", ["continent"]) * 100.0).alias("pct_of_continent"))


@register("a6_log_class", _sql("""
SELECT CAST(floor(log10(total_laid_off)) AS INTEGER) AS size_class, CAST(count(*) AS BIGINT) AS events
FROM evm WHERE total_laid_off > 0 GROUP BY 1"""))
def a6_log_class(spark, sf_dir):
    ev = events(Tables(spark, sf_dir)).where(F.col("total_laid_off") > 0)
    return ev.groupBy(SF.log10_class("total_laid_off").alias("size_class")).agg(F.count(F.lit(1)).alias("events"))


@register("a7_depth_by_sector", _sql(f"""
SELECT coalesce(industry_sector, 'Unmapped') AS industry_sector, {R('median(percentage_laid_off)')} AS median_share_cut,
       {R('sum(total_laid_off)', 2)} AS people, {R('sum(total_laid_off) * 100.0 / sum(sum(total_laid_off)) OVER ()')} AS pct_of_people,
       CAST(count(*) AS BIGINT) AS events,
       {R('avg(CASE WHEN percentage_laid_off = 1 THEN 1.0 ELSE 0.0 END)')} AS shutdown_share
FROM evm GROUP BY 1"""))
def a7_depth_by_sector(spark, sf_dir):
    ev = events(Tables(spark, sf_dir)).withColumn("industry_sector", F.coalesce("industry_sector", F.lit("Unmapped")))
    g = ev.groupBy("industry_sector").agg(
        F.sum("total_laid_off").alias("people"), F.count(F.lit(1)).alias("events"),
        F.avg((F.col("percentage_laid_off") == 1).cast("double")).alias("sd"))
    g = ST.with_quantiles(g, ev, ["industry_sector"], "percentage_laid_off", {"m": 0.5})
    return g.select("industry_sector", r("m").alias("median_share_cut"), r("people", 2).alias("people"),
                    r(ST.share_of_total("people") * 100.0).alias("pct_of_people"), "events",
                    r("sd").alias("shutdown_share"))


@register("a8_shutdown_indicator", _sql(f"""
SELECT CAST(count(*) FILTER (WHERE percentage_laid_off = 1) AS BIGINT) AS shutdowns, CAST(count(*) AS BIGINT) AS events,
       CAST(count(percentage_laid_off) AS BIGINT) AS events_with_pct,
       {R('count(*) FILTER (WHERE percentage_laid_off = 1) * 100.0 / count(*)')} AS pct_of_all_events,
       {R('count(*) FILTER (WHERE percentage_laid_off = 1) * 100.0 / count(percentage_laid_off)')} AS pct_of_events_with_pct
FROM evm"""))
def a8_shutdown_indicator(spark, sf_dir):
    """The same numerator over two denominators (all events / events with a share)."""
    ev = events(Tables(spark, sf_dir))
    g = ev.agg(F.count_if(F.col("percentage_laid_off") == 1).alias("shutdowns"), F.count(F.lit(1)).alias("events"),
               F.count("percentage_laid_off").alias("events_with_pct"))
    return g.select("shutdowns", "events", "events_with_pct",
                    r(F.col("shutdowns") * 100.0 / F.nullif("events", F.lit(0))).alias("pct_of_all_events"),
                    r(F.col("shutdowns") * 100.0 / F.nullif("events_with_pct", F.lit(0))).alias("pct_of_events_with_pct"))


_POOL_SQL = "CASE WHEN stage IN (" + ", ".join(f"'{s}'" for s in POOLED_STAGES) + ") THEN 'Other' ELSE stage END"


@register("a9_depth_by_stage", _sql(f"""
SELECT {_POOL_SQL} AS stage_group, CAST(count(*) AS BIGINT) AS events, {R('median(percentage_laid_off)')} AS median_share_cut,
       {R('avg(CASE WHEN percentage_laid_off = 1 THEN 1.0 ELSE 0.0 END)')} AS shutdown_share
FROM evm GROUP BY 1 HAVING count(*) >= {MIN_GROUP_N}"""))
def a9_depth_by_stage(spark, sf_dir):
    """Pool small stages into 'Other', then suppress groups below N."""
    grp = F.when(F.col("stage").isin(*POOLED_STAGES), F.lit("Other")).otherwise(F.col("stage"))
    ev = events(Tables(spark, sf_dir)).withColumn("stage_group", grp)
    g = ev.groupBy("stage_group").agg(
        F.count(F.lit(1)).alias("events"), r(F.avg((F.col("percentage_laid_off") == 1).cast("double"))).alias("shutdown_share"))
    g = ST.with_quantiles(g, ev, ["stage_group"], "percentage_laid_off", {"m": 0.5})
    return g.where(F.col("events") >= MIN_GROUP_N).select("stage_group", "events", r("m").alias("median_share_cut"), "shutdown_share")


@register("a10_shutdown_by_year", _sql(f"""
, y AS (SELECT yr, count(*) AS events, avg(CASE WHEN percentage_laid_off = 1 THEN 1.0 ELSE 0.0 END) AS share FROM evm GROUP BY yr),
o AS (SELECT avg(CASE WHEN percentage_laid_off = 1 THEN 1.0 ELSE 0.0 END) AS overall FROM evm)
SELECT yr AS year, CAST(events AS BIGINT) AS events, {R('share')} AS shutdown_share, {R('overall')} AS overall_share
FROM y, o WHERE events >= {MIN_GROUP_N}"""))
def a10_shutdown_by_year(spark, sf_dir):
    ev = events(Tables(spark, sf_dir))
    sd = (F.col("percentage_laid_off") == 1).cast("double")
    y = ev.groupBy(F.col("yr").alias("year")).agg(F.count(F.lit(1)).alias("events"), F.avg(sd).alias("share"))
    o = ev.agg(F.avg(sd).alias("overall"))
    return y.crossJoin(F.broadcast(o)).where(F.col("events") >= MIN_GROUP_N).select(
        "year", "events", r("share").alias("shutdown_share"), r("overall").alias("overall_share"))


@register("a11_event_scatter", _sql(f"""
, top AS (SELECT event_id FROM evm WHERE total_laid_off IS NOT NULL ORDER BY total_laid_off DESC, event_id LIMIT {TOP_N}),
med AS (SELECT median(total_laid_off) AS m FROM evm)
SELECT e.event_id, e.event_date, {R('log10(e.total_laid_off)')} AS log_size,
       e.event_id IN (SELECT event_id FROM top) AS is_top, coalesce(e.percentage_laid_off = 1, false) AS is_shutdown,
       e.total_laid_off IS NULL AS headcount_missing, {R('med.m')} AS median_size
FROM evm e, med"""))
def a11_event_scatter(spark, sf_dir):
    """Row-level scatter; the top-N flag comes from a per-partition top-k (limit), not a global window."""
    ev = events(Tables(spark, sf_dir))
    top = ev.where(F.col("total_laid_off").isNotNull()).orderBy(F.desc("total_laid_off"), "event_id") \
        .limit(TOP_N).select("event_id", F.lit(True).alias("__top"))
    med = ST.quantiles(ev, [], "total_laid_off", {"__m": 0.5})
    j = ev.join(F.broadcast(top), "event_id", "left").crossJoin(F.broadcast(med))
    return j.select("event_id", "event_date", r(F.log10("total_laid_off")).alias("log_size"),
                    F.coalesce("__top", F.lit(False)).alias("is_top"),
                    F.coalesce(F.col("percentage_laid_off") == 1, F.lit(False)).alias("is_shutdown"),
                    F.col("total_laid_off").isNull().alias("headcount_missing"), r("__m").alias("median_size"))


@register("a12_topn_concentration", _sql(f"""
, win AS (SELECT * FROM evm WHERE month_start > (SELECT max(month_start) FROM evm) - INTERVAL {PERIOD_MONTHS} MONTH)
SELECT 'all time' AS scope, {R(f'(SELECT sum(x) FROM (SELECT total_laid_off AS x FROM evm WHERE total_laid_off IS NOT NULL ORDER BY x DESC LIMIT {TOP_N}))', 2)} AS top_people,
       {R('(SELECT sum(total_laid_off) FROM evm)', 2)} AS total_people,
       {R(f'(SELECT sum(x) FROM (SELECT total_laid_off AS x FROM evm WHERE total_laid_off IS NOT NULL ORDER BY x DESC LIMIT {TOP_N})) * 100.0 / (SELECT sum(total_laid_off) FROM evm)')} AS pct_top
UNION ALL
SELECT 'last {PERIOD_MONTHS} months', {R(f'(SELECT sum(x) FROM (SELECT total_laid_off AS x FROM win WHERE total_laid_off IS NOT NULL ORDER BY x DESC LIMIT {TOP_N}))', 2)},
       {R('(SELECT sum(total_laid_off) FROM win)', 2)},
       {R(f'(SELECT sum(x) FROM (SELECT total_laid_off AS x FROM win WHERE total_laid_off IS NOT NULL ORDER BY x DESC LIMIT {TOP_N})) * 100.0 / (SELECT sum(total_laid_off) FROM win)')}"""))
def a12_topn_concentration(spark, sf_dir):
    """Share of the total held by the N largest events, all time and in the last window."""
    ev = events(Tables(spark, sf_dir))
    last = ev.agg(F.max("month_start").alias("__last"))
    win = ev.crossJoin(F.broadcast(last)).where(
        F.col("month_start") > F.add_months("__last", -PERIOD_MONTHS)).drop("__last")

    def one(df, scope):
        top = df.where(F.col("total_laid_off").isNotNull()).orderBy(F.desc("total_laid_off")).limit(TOP_N) \
            .agg(F.sum("total_laid_off").alias("tp"))
        tot = df.agg(F.sum("total_laid_off").alias("tt"))
        return top.crossJoin(tot).select(F.lit(scope).alias("scope"), r("tp", 2).alias("top_people"),
                                         r("tt", 2).alias("total_people"),
                                         r(F.col("tp") * 100.0 / F.col("tt")).alias("pct_top"))
    return one(ev, "all time").unionByName(one(win, f"last {PERIOD_MONTHS} months"))


@register("a13_top_companies", _sql(f"""
, bc AS (SELECT company, sum(total_laid_off) AS people, count(*) AS events, max(total_laid_off) AS largest FROM evm GROUP BY company),
tot AS (SELECT sum(total_laid_off) AS t FROM evm)
SELECT CAST(row_number() OVER (ORDER BY people DESC NULLS LAST, company) AS INTEGER) AS rank, company, {R('people', 2)} AS people,
       CAST(events AS BIGINT) AS events, {R('people * 100.0 / t')} AS pct_of_total, {R('largest', 2)} AS largest_event
FROM bc, tot ORDER BY people DESC NULLS LAST, company LIMIT {TOP_N}"""))
def a13_top_companies(spark, sf_dir):
    """Top-N report (the limit is the feature); rank by people, ties by name."""
    ev = events(Tables(spark, sf_dir))
    bc = ev.groupBy("company").agg(F.sum("total_laid_off").alias("people"), F.count(F.lit(1)).alias("events"),
                                   F.max("total_laid_off").alias("largest"))
    tot = ev.agg(F.sum("total_laid_off").alias("__t"))
    top = bc.orderBy(F.desc_nulls_last("people"), "company").limit(TOP_N)
    w = Window.orderBy(F.desc_nulls_last("people"), "company")
    return top.crossJoin(F.broadcast(tot)).select(
        F.row_number().over(w).alias("rank"), "company", r("people", 2).alias("people"), "events",
        r(F.col("people") * 100.0 / F.col("__t")).alias("pct_of_total"), r("largest", 2).alias("largest_event"))


@register("a14_period_over_period", _sql(f"""
, b AS (SELECT max(month_start) AS last FROM evm),
p AS (SELECT
  sum(total_laid_off) FILTER (WHERE month_start > last - INTERVAL {PERIOD_MONTHS} MONTH) AS cur_people,
  sum(total_laid_off) FILTER (WHERE month_start <= last - INTERVAL {PERIOD_MONTHS} MONTH
                              AND month_start > last - INTERVAL {2 * PERIOD_MONTHS} MONTH) AS prev_people,
  count(*) FILTER (WHERE month_start > last - INTERVAL {PERIOD_MONTHS} MONTH) AS cur_events,
  count(*) FILTER (WHERE month_start <= last - INTERVAL {PERIOD_MONTHS} MONTH
                   AND month_start > last - INTERVAL {2 * PERIOD_MONTHS} MONTH) AS prev_events
  FROM evm, b)
SELECT 'people' AS metric, {R('cur_people', 2)} AS current_value, {R('prev_people', 2)} AS previous_value,
       {R('(cur_people - prev_people) * 100.0 / prev_people')} AS pct_change FROM p
UNION ALL SELECT 'events', {R('CAST(cur_events AS DOUBLE)', 2)}, {R('CAST(prev_events AS DOUBLE)', 2)},
       {R('(cur_events - prev_events) * 100.0 / prev_events')} FROM p"""))
def a14_period_over_period(spark, sf_dir):
    """Last N months against the N months before, as conditional sums (one pass)."""
    ev = events(Tables(spark, sf_dir))
    last = ev.agg(F.max("month_start").alias("__last"))
    j = ev.crossJoin(F.broadcast(last))
    cur = F.col("month_start") > F.add_months("__last", -PERIOD_MONTHS)
    prev = (F.col("month_start") <= F.add_months("__last", -PERIOD_MONTHS)) & \
           (F.col("month_start") > F.add_months("__last", -2 * PERIOD_MONTHS))
    p = j.agg(F.sum(F.when(cur, F.col("total_laid_off"))).alias("cp"), F.sum(F.when(prev, F.col("total_laid_off"))).alias("pp"),
              F.count_if(cur).cast("double").alias("ce"), F.count_if(prev).cast("double").alias("pe"))
    return p.select(F.explode(F.array(
        F.struct(F.lit("people").alias("metric"), r("cp", 2).alias("current_value"), r("pp", 2).alias("previous_value"),
                 r((F.col("cp") - F.col("pp")) * 100.0 / F.col("pp")).alias("pct_change")),
        F.struct(F.lit("events").alias("metric"), r("ce", 2).alias("current_value"), r("pe", 2).alias("previous_value"),
                 r((F.col("ce") - F.col("pe")) * 100.0 / F.nullif("pe", F.lit(0.0))).alias("pct_change")))).alias("s")
    ).select("s.*")


@register("a15_disclosure_completeness", _sql(f"""
SELECT continent, CAST(count(*) AS BIGINT) AS events, CAST(count(total_laid_off) AS BIGINT) AS disclosed,
       {R('count(total_laid_off) * 100.0 / count(*)')} AS pct_disclosed, {R('sum(total_laid_off)', 2)} AS people
FROM evm GROUP BY continent"""))
def a15_disclosure_completeness(spark, sf_dir):
    ev = events(Tables(spark, sf_dir))
    return ev.groupBy("continent").agg(
        F.count(F.lit(1)).alias("events"), F.count("total_laid_off").alias("disclosed"),
        r(F.count("total_laid_off") * 100.0 / F.count(F.lit(1))).alias("pct_disclosed"),
        r(F.sum("total_laid_off"), 2).alias("people"))


# ---------------------------------------------------------------- A17-A24 postings

def postings(t: Tables) -> DataFrame:
    return QW.conformed_postings(t)


@register("a17_posting_kpis", _sql(f"""
, bc AS (SELECT country_canonical, count(*) AS n FROM poc GROUP BY 1),
top3 AS (SELECT sum(n) AS s FROM (SELECT n FROM bc ORDER BY n DESC, country_canonical LIMIT 3))
SELECT CAST(count(*) AS BIGINT) AS postings, CAST(count(DISTINCT country_canonical) AS BIGINT) AS countries,
       CAST(count(DISTINCT title) AS BIGINT) AS titles,
       {R('avg(CASE WHEN is_llm_role THEN 1.0 ELSE 0.0 END) * 100.0')} AS pct_llm,
       {R(f"avg(CASE WHEN country_canonical = '{FOCUS_COUNTRY}' THEN 1.0 ELSE 0.0 END) * 100.0")} AS pct_focus_country,
       {R('(SELECT s FROM top3) * 100.0 / count(*)')} AS pct_top3_countries
FROM poc"""))
def a17_posting_kpis(spark, sf_dir):
    po = postings(Tables(spark, sf_dir))
    bc = po.groupBy("country_canonical").agg(F.count(F.lit(1)).alias("n"))
    top3 = bc.orderBy(F.desc("n"), "country_canonical").limit(3).agg(F.sum("n").alias("__s"))
    k = po.agg(F.count(F.lit(1)).alias("postings"), F.count_distinct("country_canonical").alias("countries"),
               F.count_distinct("title").alias("titles"),
               F.avg(F.col("is_llm_role").cast("double")).alias("llm"),
               F.avg((F.col("country_canonical") == FOCUS_COUNTRY).cast("double")).alias("focus"))
    return k.crossJoin(top3).select("postings", "countries", "titles", r(F.col("llm") * 100.0).alias("pct_llm"),
                                    r(F.col("focus") * 100.0).alias("pct_focus_country"),
                                    r(F.col("__s") * 100.0 / F.col("postings")).alias("pct_top3_countries"))


@register("a18_family_bubble", _sql(f"""
SELECT family, {R('median(salary)')} AS median_salary, {R('avg(demand_growth)')} AS mean_demand_growth,
       CAST(count(*) AS BIGINT) AS postings FROM poc GROUP BY family"""))
def a18_family_bubble(spark, sf_dir):
    po = postings(Tables(spark, sf_dir))
    g = po.groupBy("family").agg(r(F.avg("demand_growth")).alias("mean_demand_growth"), F.count(F.lit(1)).alias("postings"))
    g = ST.with_quantiles(g, po, ["family"], "salary", {"m": 0.5})
    return g.select("family", r("m").alias("median_salary"), "mean_demand_growth", "postings")


#: The metrics of the switch; a posting's pay above 100,000, in percent, stands in for the premium.
BUBBLE_METRICS = {"growth": "demand_growth", "paybump": "(salary / 100000 - 1) * 100", "score": "demand_score"}


def family_bubbles(po: DataFrame) -> DataFrame:
    """A18 with every position of its switch: (metric, family, median_salary, mean_metric, postings); one aggregate
    works out all metrics, its few rows are then unpivoted."""
    g = po.groupBy("family").agg(F.count(F.lit(1)).alias("postings"),
                                 *[F.avg(F.expr(e)).alias(m) for m, e in BUBBLE_METRICS.items()])
    g = ST.with_quantiles(g, po, ["family"], "salary", {"median_salary": 0.5})
    return g.unpivot(["family", "median_salary", "postings"], list(BUBBLE_METRICS), "metric", "mean_metric")


@register("a18_family_bubble_metrics", _sql("""
, fam AS (SELECT family, median(salary) AS med, count(*) AS n, """ + ", ".join(f"avg({e}) AS {m}" for m, e in BUBBLE_METRICS.items())
    + " FROM poc GROUP BY family)\n" + "\nUNION ALL ".join(
        f"SELECT '{m}' AS metric, family, {R('med')} AS median_salary, {R(m)} AS mean_metric, CAST(n AS BIGINT) AS postings FROM fam"
        for m in BUBBLE_METRICS)))
def a18_family_bubble_metrics(spark, sf_dir):
    """The bubble of every family for each metric of the switch."""
    return family_bubbles(postings(Tables(spark, sf_dir))).select(
        "metric", "family", r("median_salary").alias("median_salary"), r("mean_metric").alias("mean_metric"), "postings")


@register("a19_salary_spread", _sql(f"""
, s AS (SELECT title, min(salary) AS p0, quantile_cont(salary, 0.25) AS p25, median(salary) AS p50,
               quantile_cont(salary, 0.75) AS p75, max(salary) AS p100, count(*) AS n
        FROM poc WHERE family = '{FOCUS_FAMILY}' GROUP BY title)
SELECT title, {R('p0')} AS p0, {R('p25')} AS p25, {R('p50')} AS p50, {R('p75')} AS p75, {R('p100')} AS p100,
       CAST(n AS BIGINT) AS postings, row_number() OVER (ORDER BY p50 DESC, title) = 1 AS is_top FROM s"""))
def a19_salary_spread(spark, sf_dir):
    """Five-number spread per title inside one family; which spread the bar shows is the caller's choice."""
    po = postings(Tables(spark, sf_dir)).where(F.col("family") == FOCUS_FAMILY)
    spread_at = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    s = po.groupBy("title").agg(F.count(F.lit(1)).alias("postings"))
    s = ST.with_quantiles(s, po, ["title"], "salary", spread_at)
    w = Window.orderBy(F.desc("p50"), "title")
    return s.select("title", *[r(n).alias(n) for n in spread_at], "postings", (F.row_number().over(w) == 1).alias("is_top"))


@register("a20_median_by_degree", _sql(f"""
SELECT education, {R('median(salary)')} AS median_salary, {R('min(salary)', 2)} AS min_salary,
       {R('max(salary)', 2)} AS max_salary, CAST(count(*) AS BIGINT) AS postings FROM poc GROUP BY education"""))
def a20_median_by_degree(spark, sf_dir):
    po = postings(Tables(spark, sf_dir))
    g = po.groupBy("education").agg(F.min("salary").alias("lo"), F.max("salary").alias("hi"), F.count(F.lit(1)).alias("postings"))
    g = ST.with_quantiles(g, po, ["education"], "salary", {"m": 0.5})
    return g.select("education", r("m").alias("median_salary"), r("lo", 2).alias("min_salary"), r("hi", 2).alias("max_salary"), "postings")


@register("a21_uplift_vs_entry", _sql(f"""
, m AS (SELECT experience_level, median(salary) AS med FROM poc WHERE experience_level IS NOT NULL GROUP BY 1)
SELECT experience_level, {R('med')} AS median_salary,
       {R("(med / (SELECT med FROM m WHERE experience_level = 'Entry') - 1) * 100.0")} AS pct_vs_entry FROM m"""))
def a21_uplift_vs_entry(spark, sf_dir):
    po = postings(Tables(spark, sf_dir)).where(F.col("experience_level").isNotNull())
    m = ST.with_quantiles(po.select("experience_level").distinct(), po, ["experience_level"], "salary", {"med": 0.5})
    base = m.where(F.col("experience_level") == "Entry").select(F.col("med").alias("__base"))
    return m.crossJoin(F.broadcast(base)).select(
        "experience_level", r("med").alias("median_salary"),
        r((F.col("med") / F.col("__base") - 1) * 100.0).alias("pct_vs_entry"))


def _skills_with_family(t: Tables) -> DataFrame:
    return S.posting_skills(t).join(postings(t).select("posting_id", "family", "salary", "demand_score"), "posting_id")


_PSF_SQL = """
, psf AS (SELECT ps.posting_id, ps.skill, p.family, p.salary, p.demand_score FROM ps JOIN poc p ON ps.posting_id = p.posting_id)"""


@register("a22_skill_family_heatmap", _sql(f"""
, top AS (SELECT skill FROM psf GROUP BY skill ORDER BY count(DISTINCT posting_id) DESC, skill LIMIT {TOP_SKILLS}),
fam AS (SELECT family, count(*) AS n FROM poc GROUP BY family),
cell AS (SELECT family, skill, count(DISTINCT posting_id) AS k FROM psf WHERE skill IN (SELECT skill FROM top) GROUP BY ALL)
SELECT f.family, t.skill, {R('c.k * 100.0 / f.n')} AS pct_of_family
FROM fam f CROSS JOIN top t LEFT JOIN cell c ON c.family = f.family AND c.skill = t.skill""", _PSF_SQL))
def a22_skill_family_heatmap(spark, sf_dir):
    """% of each family's postings that need each of the most requested skills; absent -> NULL.

    The family x skill grid is bounded by (#families x TOP_SKILLS), both small, so it is built from
    the aggregated rows; the postings themselves are never crossed with anything.
    """
    t = Tables(spark, sf_dir)
    psf = _skills_with_family(t)
    top = psf.groupBy("skill").agg(F.count_distinct("posting_id").alias("__n")) \
        .orderBy(F.desc("__n"), "skill").limit(TOP_SKILLS).select("skill")
    fam = postings(t).groupBy("family").agg(F.count(F.lit(1)).alias("__fn"))
    cell = psf.join(F.broadcast(top), "skill").groupBy("family", "skill").agg(F.count_distinct("posting_id").alias("__k"))
    grid = fam.crossJoin(F.broadcast(top))
    return grid.join(cell, ["family", "skill"], "left").select(
        "family", "skill", r(F.col("__k") * 100.0 / F.col("__fn")).alias("pct_of_family"))


@register("a23_most_requested_skills", _sql(f"""
SELECT skill, CAST(count(DISTINCT posting_id) AS BIGINT) AS postings, {R('avg(demand_score)')} AS avg_demand_score,
       {R('median(salary)')} AS median_salary
FROM psf GROUP BY skill HAVING count(DISTINCT posting_id) >= {MIN_GROUP_N}""", _PSF_SQL))
def a23_most_requested_skills(spark, sf_dir):
    psf = _skills_with_family(Tables(spark, sf_dir))
    g = psf.groupBy("skill").agg(F.count_distinct("posting_id").alias("postings"),
                                 r(F.avg("demand_score")).alias("avg_demand_score"))
    g = ST.with_quantiles(g.where(F.col("postings") >= MIN_GROUP_N), psf, ["skill"], "salary", {"m": 0.5})
    return g.select("skill", "postings", "avg_demand_score", r("m").alias("median_salary"))


@register("a24_family_top_skills", _sql(f"""
SELECT skill, {R(f"count(DISTINCT posting_id) * 100.0 / (SELECT count(*) FROM poc WHERE family = '{FOCUS_FAMILY}')")} AS pct_of_family
FROM psf WHERE family = '{FOCUS_FAMILY}' GROUP BY skill
ORDER BY count(DISTINCT posting_id) DESC, skill LIMIT {FAMILY_TOP_SKILLS}""", _PSF_SQL))
def a24_family_top_skills(spark, sf_dir):
    t = Tables(spark, sf_dir)
    psf = _skills_with_family(t).where(F.col("family") == FOCUS_FAMILY)
    n = postings(t).where(F.col("family") == FOCUS_FAMILY).agg(F.count(F.lit(1)).alias("__n"))
    g = psf.groupBy("skill").agg(F.count_distinct("posting_id").alias("__k")) \
        .orderBy(F.desc("__k"), "skill").limit(FAMILY_TOP_SKILLS)
    return g.crossJoin(F.broadcast(n)).select("skill", r(F.col("__k") * 100.0 / F.col("__n")).alias("pct_of_family"))


# ---------------------------------------------------------------- A25-A34 answers

_UE_SQL = ",\n" + S.USER_EVENTS_SQL.strip() + ",\n ues AS (SELECT *, CASE event_type " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in S.EVENT_LIKERT.items()) + " END AS score FROM ue)"


def user_events(t: Tables) -> DataFrame:
    m = F.create_map(*[F.lit(x) for kv in S.EVENT_LIKERT.items() for x in kv])
    return S.user_events(t).withColumn("score", m[F.col("event_type")])


@register("a25_answer_rate", _sql(f"""
SELECT lang, CAST(count(toxic) AS BIGINT) AS answered, CAST(count(*) FILTER (WHERE toxic = 1) AS BIGINT) AS yes,
       {R('avg(CASE WHEN toxic = 1 THEN 1.0 ELSE 0.0 END) FILTER (WHERE toxic IS NOT NULL)')} AS yes_rate
FROM ld GROUP BY lang"""))
def a25_answer_rate(spark, sf_dir):
    """Yes / answered, non-answers excluded from the denominator, N attached."""
    ld = S.labelled_docs(Tables(spark, sf_dir))
    return ld.groupBy("lang").agg(
        F.count("toxic").alias("answered"), F.count_if(F.col("toxic") == 1).alias("yes"),
        r(F.avg(F.when(F.col("toxic").isNotNull(), (F.col("toxic") == 1).cast("double")))).alias("yes_rate"))


@register("a26_likert_mean", _sql(f"""
SELECT r_name AS region, {R('avg(score)')} AS mean_score, CAST(count(score) AS BIGINT) AS answers
FROM ues GROUP BY r_name""", _UE_SQL))
def a26_likert_mean(spark, sf_dir):
    """Label -> 1..5, excluded labels (no score) left out of mean and N."""
    ue = user_events(Tables(spark, sf_dir))
    return ue.groupBy(F.col("r_name").alias("region")).agg(r(F.avg("score")).alias("mean_score"),
                                                          F.count("score").alias("answers"))


@register("a27_diverging_split", _sql(f"""
SELECT c_mktsegment AS segment, {R('avg(CASE WHEN score <= 2 THEN 1.0 ELSE 0.0 END)')} AS negative,
       {R('avg(CASE WHEN score = 3 THEN 1.0 ELSE 0.0 END)')} AS neutral,
       {R('avg(CASE WHEN score >= 4 THEN 1.0 ELSE 0.0 END)')} AS positive,
       {R('avg(CASE WHEN score >= 4 THEN 1.0 ELSE 0.0 END) - avg(CASE WHEN score <= 2 THEN 1.0 ELSE 0.0 END)')} AS net
FROM ues WHERE score IS NOT NULL GROUP BY c_mktsegment""", _UE_SQL))
def a27_diverging_split(spark, sf_dir):
    ue = user_events(Tables(spark, sf_dir)).where(F.col("score").isNotNull())
    neg, neu, pos = [(c).cast("double") for c in (F.col("score") <= 2, F.col("score") == 3, F.col("score") >= 4)]
    g = ue.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.avg(neg).alias("n"), F.avg(neu).alias("u"), F.avg(pos).alias("p"))
    return g.select("segment", r("n").alias("negative"), r("u").alias("neutral"), r("p").alias("positive"),
                    r(F.col("p") - F.col("n")).alias("net"))


def _wilson_sql(x: str, n: str, z: float = SF.Z95) -> tuple[str, str]:
    p = f"(({x}) * 1.0 / ({n}))"
    z2 = z * z
    denom = f"(1 + {z2} / ({n}))"
    centre = f"(({p} + {z2} / (2.0 * ({n}))) / {denom})"
    half = f"(({z} / {denom}) * sqrt({p} * (1 - {p}) / ({n}) + {z2} / (4.0 * ({n}) * ({n}))))"
    return f"({centre} - {half})", f"({centre} + {half})"


_W_LO, _W_HI = _wilson_sql("yes", "n")


@register("a28_group_vs_overall", _sql(f"""
, g AS (SELECT source, nullif(count(toxic), 0) AS n, count(*) FILTER (WHERE toxic = 1) AS yes FROM ld GROUP BY source),
o AS (SELECT avg(CASE WHEN toxic = 1 THEN 1.0 ELSE 0.0 END) FILTER (WHERE toxic IS NOT NULL) AS overall FROM ld),
c AS (SELECT source, n, yes, yes * 1.0 / n AS rate, {_W_LO} AS lo, {_W_HI} AS hi, overall FROM g, o)
SELECT source, CAST(coalesce(n, 0) AS BIGINT) AS answered, {R('rate')} AS rate, {R('lo')} AS ci_low, {R('hi')} AS ci_high,
       {R('overall')} AS overall_rate,
       CASE WHEN lo > overall THEN 'higher' WHEN hi < overall THEN 'lower' ELSE 'not clear' END AS vs_overall FROM c"""))
def a28_group_vs_overall(spark, sf_dir):
    """A28 (+A30): per group rate (none without an answer), Wilson interval, and whether it clearly differs from the overall rate."""
    ld = S.labelled_docs(Tables(spark, sf_dir))
    g = ld.groupBy("source").agg(F.nullif(F.count("toxic"), F.lit(0)).alias("n"), F.count_if(F.col("toxic") == 1).alias("yes"))
    o = ld.agg(F.avg(F.when(F.col("toxic").isNotNull(), (F.col("toxic") == 1).cast("double"))).alias("overall"))
    lo, hi = SF.wilson_interval("yes", "n")
    c = g.crossJoin(F.broadcast(o)).select("source", "n", (F.col("yes") / F.col("n")).alias("rate"),
                                           lo.alias("lo"), hi.alias("hi"), "overall")
    return c.select("source", F.coalesce("n", F.lit(0)).alias("answered"), r("rate").alias("rate"), r("lo").alias("ci_low"),
                    r("hi").alias("ci_high"), r("overall").alias("overall_rate"),
                    ST.clear_flag(F.col("lo"), F.col("hi"), F.col("overall")).alias("vs_overall"))


_AP_LO, _AP_HI = _wilson_sql("count(*) FILTER (WHERE ratio > 0)", "count(ratio)")


@register("a29_pay_vs_peers", _sql(f"""
, cells AS (SELECT country_canonical, experience_level, median(salary) AS cell_median FROM poc
            WHERE experience_level IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= {MIN_GROUP_N}),
ratios AS (SELECT p.title, p.salary / c.cell_median - 1 AS ratio FROM poc p
           JOIN cells c ON p.country_canonical = c.country_canonical AND p.experience_level = c.experience_level)
SELECT title, {R('median(ratio)')} AS median_pay_vs_peers, CAST(count(*) AS BIGINT) AS postings,
       {R('avg(CASE WHEN ratio > 0 THEN 1.0 ELSE 0.0 END)')} AS share_above_peers,
       CASE WHEN {_AP_LO} > 0.5 THEN 'higher' WHEN {_AP_HI} < 0.5 THEN 'lower' ELSE 'not clear' END AS vs_peers
FROM ratios GROUP BY title"""))
def a29_pay_vs_peers(spark, sf_dir):
    """A29 (our definition, §7.3 X9): ratio to the (country, experience) cell median with N >= 30; clear where the
    Wilson interval of the share of ratios above 0 excludes one half."""
    po = postings(Tables(spark, sf_dir)).where(F.col("experience_level").isNotNull())
    cell = ["country_canonical", "experience_level"]
    cells = po.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= MIN_GROUP_N)
    cells = ST.with_quantiles(cells, po, cell, "salary", {"cell_median": 0.5})
    ratios = po.join(cells, cell).select(
        "title", (F.col("salary") / F.col("cell_median") - 1).alias("ratio"))
    g = ratios.groupBy("title").agg(F.count(F.lit(1)).alias("postings"),
                                    r(F.avg((F.col("ratio") > 0).cast("double"))).alias("share_above_peers"),
                                    F.count_if(F.col("ratio") > 0).alias("__above"), F.count("ratio").alias("__n"))
    lo, hi = SF.wilson_interval("__above", "__n")
    g = g.withColumn("vs_peers", ST.clear_flag(lo, hi, F.lit(0.5)))
    g = ST.with_quantiles(g, ratios, ["title"], "ratio", {"m": 0.5})
    return g.select("title", r("m").alias("median_pay_vs_peers"), "postings", "share_above_peers", "vs_peers")


_WL_LO, _WL_HI = _wilson_sql("yes", "n")


@register("a30_proportion_intervals", _sql(f"""
, g AS (SELECT lang, nullif(count(toxic), 0) AS n, count(*) FILTER (WHERE toxic = 1) AS yes FROM ld GROUP BY lang)
SELECT lang, CAST(coalesce(n, 0) AS BIGINT) AS n, CAST(yes AS BIGINT) AS yes, {R('yes * 1.0 / n')} AS rate,
       {R(_WL_LO)} AS wilson_low, {R(_WL_HI)} AS wilson_high,
       {R(f'yes * 1.0 / n - {SF.Z95} * sqrt((yes * 1.0 / n) * (1 - yes * 1.0 / n) / n)')} AS wald_low,
       {R(f'yes * 1.0 / n + {SF.Z95} * sqrt((yes * 1.0 / n) * (1 - yes * 1.0 / n) / n)')} AS wald_high FROM g"""))
def a30_proportion_intervals(spark, sf_dir):
    """Wilson (default) and normal-approximation intervals side by side (§7.3 X8)."""
    ld = S.labelled_docs(Tables(spark, sf_dir))
    g = ld.groupBy("lang").agg(F.nullif(F.count("toxic"), F.lit(0)).alias("n"), F.count_if(F.col("toxic") == 1).alias("yes"))
    wlo, whi = SF.wilson_interval("yes", "n")
    alo, ahi = SF.wald_interval("yes", "n")
    return g.select("lang", F.coalesce("n", F.lit(0)).alias("n"), "yes", r(F.col("yes") / F.col("n")).alias("rate"), r(wlo).alias("wilson_low"),
                    r(whi).alias("wilson_high"), r(alo).alias("wald_low"), r(ahi).alias("wald_high"))


@register("a31_mean_intervals", _sql(f"""
SELECT lang, CAST(count(n_chars) AS BIGINT) AS n, {R('avg(n_chars)')} AS mean_chars, {R('stddev_samp(n_chars)')} AS sd_chars,
       {R(f'avg(n_chars) - {SF.Z95} * stddev_samp(n_chars) / sqrt(count(n_chars))')} AS ci_low,
       {R(f'avg(n_chars) + {SF.Z95} * stddev_samp(n_chars) / sqrt(count(n_chars))')} AS ci_high
FROM ld GROUP BY lang"""))
def a31_mean_intervals(spark, sf_dir):
    ld = S.labelled_docs(Tables(spark, sf_dir))
    g = ld.groupBy("lang").agg(F.count("n_chars").alias("n"), F.avg("n_chars").alias("m"),
                               F.stddev_samp("n_chars").alias("sd"))
    lo, hi = SF.mean_interval("m", "sd", "n")
    return g.select("lang", "n", r("m").alias("mean_chars"), r("sd").alias("sd_chars"), r(lo).alias("ci_low"),
                    r(hi).alias("ci_high"))


_STAGE_SQL = ("CASE WHEN c_acctbal IS NULL THEN NULL WHEN c_acctbal / 1000.0 <= 2 THEN 'Entry' "
              "WHEN c_acctbal / 1000.0 <= 5 THEN 'Mid' WHEN c_acctbal / 1000.0 <= 9 THEN 'Senior' ELSE 'Lead' END")
_THEME_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_THEME.items()) + " END"


@register("a32_theme_share_by_stage", _sql(f"""
, th AS (SELECT {_STAGE_SQL} AS stage, {_THEME_SQL} AS theme FROM ue
         WHERE event_type NOT IN (""" + ", ".join(f"'{e}'" for e in EXCLUDED_THEME_EVENTS) + f""")),
sh AS (SELECT stage, theme, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY stage) AS share FROM th
       WHERE stage IN ('Entry', 'Lead') GROUP BY stage, theme)
SELECT theme, {R("max(share) FILTER (WHERE stage = 'Entry')")} AS entry_share,
       {R("max(share) FILTER (WHERE stage = 'Lead')")} AS lead_share,
       {R("max(share) FILTER (WHERE stage = 'Lead') - max(share) FILTER (WHERE stage = 'Entry')")} AS gap
FROM sh GROUP BY theme""", _UE_SQL))
def a32_theme_share_by_stage(spark, sf_dir):
    """Share of answers per theme for entry vs senior-most stage; excluded themes leave the denominator."""
    ue = S.user_events(Tables(spark, sf_dir)).where(~F.col("event_type").isin(*EXCLUDED_THEME_EVENTS))
    th = ue.select(SF.bucket_right_closed(F.col("c_acctbal") / 1000.0).alias("stage"),
                   SF.map_lookup("event_type", EVENT_THEME).alias("theme")).where(F.col("stage").isin("Entry", "Lead"))
    g = th.groupBy("stage", "theme").agg(F.count(F.lit(1)).alias("k"))
    sh = g.withColumn("share", F.col("k") / F.sum("k").over(Window.partitionBy("stage")))
    p = sh.groupBy("theme").agg(F.max(F.when(F.col("stage") == "Entry", F.col("share"))).alias("e"),
                                F.max(F.when(F.col("stage") == "Lead", F.col("share"))).alias("l"))
    return p.select("theme", r("e").alias("entry_share"), r("l").alias("lead_share"),
                    r(F.col("l") - F.col("e")).alias("gap"))


@register("a33_topic_coverage", f"""
WITH d AS (SELECT text, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s FROM documents),
w AS (SELECT text, s, CASE WHEN s = '' THEN [] ELSE string_split_regex(s, '\\s+') END AS toks,
             CASE WHEN s = '' THEN [] ELSE string_split_regex(lower(s), '\\s+') END AS ltoks FROM d),
f AS (SELECT text, len(toks) AS n_words, len(ltoks) AS n_low,
             (SELECT max(c) FROM (SELECT count(*) AS c FROM unnest(ltoks) AS u(x) GROUP BY x)) AS top_count FROM w)
SELECT CAST(count(text) AS BIGINT) AS answered,
       CAST(count(*) FILTER (WHERE text IS NOT NULL AND NOT (n_low > 15 AND top_count * 1.0 / n_low > 0.8)) AS BIGINT) AS valid,
       CAST(count(*) FILTER (WHERE text IS NOT NULL AND NOT (n_low > 15 AND top_count * 1.0 / n_low > 0.8) AND n_words > 4) AS BIGINT) AS modelled,
       {R("count(*) FILTER (WHERE text IS NOT NULL AND NOT (n_low > 15 AND top_count * 1.0 / n_low > 0.8) AND n_words > 4) * 100.0 / count(*) FILTER (WHERE text IS NOT NULL AND NOT (n_low > 15 AND top_count * 1.0 / n_low > 0.8))")} AS pct_modelled
FROM f""")
def a33_topic_coverage(spark, sf_dir):
    """A33 funnel over whole texts: answered -> valid (spam masked, C11) -> long enough to model."""
    d = spread(Tables(spark, sf_dir).documents.select("text"))
    f = d.select(F.col("text").isNotNull().alias("answered"),
                 SF.spam_masked("text").alias("clean"))
    f = f.select("answered", F.col("clean").isNotNull().alias("valid"),
                 (F.col("clean").isNotNull() & (SF.word_count("clean") > 4)).alias("modelled"))
    return f.agg(F.count_if("answered").alias("answered"), F.count_if("valid").alias("valid"),
                 F.count_if("modelled").alias("modelled")).select(
        "answered", "valid", "modelled", r(F.col("modelled") * 100.0 / F.col("valid")).alias("pct_modelled"))


_WE_LO, _WE_HI = _wilson_sql("yes", "n")


@register("a34_emerging_vs_traditional", _sql(f"""
, g AS (SELECT CASE WHEN title IN ('1-URGENT', '2-HIGH') THEN 'Emerging' ELSE 'Traditional' END AS role_category,
               count(*) AS n, count(*) FILTER (WHERE is_llm_role) AS yes FROM po GROUP BY 1)
SELECT role_category, CAST(n AS BIGINT) AS n, {R('yes * 1.0 / n')} AS rate, {R(_WE_LO)} AS ci_low, {R(_WE_HI)} AS ci_high
FROM g"""))
def a34_emerging_vs_traditional(spark, sf_dir):
    po = S.postings(Tables(spark, sf_dir))
    cat = F.when(F.col("title").isin(*QW.EMERGING_TITLES), "Emerging").otherwise("Traditional")
    g = po.groupBy(cat.alias("role_category")).agg(F.count(F.lit(1)).alias("n"),
                                                   F.count_if("is_llm_role").alias("yes"))
    lo, hi = SF.wilson_interval("yes", "n")
    return g.select("role_category", "n", r(F.col("yes") / F.col("n")).alias("rate"), r(lo).alias("ci_low"),
                    r(hi).alias("ci_high"))


# ---------------------------------------------------------------- A35-A40 cross-source

def _region_grid(t: Tables) -> DataFrame:
    ev = events(t).groupBy(F.col("continent").alias("region")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("total_laid_off").alias("people"))
    li = t.lineitem.select("l_orderkey", "l_suppkey")
    sup = t.supplier.select("s_suppkey", "s_nationkey").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    po = li.join(sup, li.l_suppkey == sup.s_suppkey).groupBy(F.col("r_name").alias("region")).agg(
        F.count_distinct("l_orderkey").alias("postings"))
    ue = S.user_events(t).groupBy(F.col("r_name").alias("region")).agg(
        F.count(F.lit(1)).alias("answers"), F.count_if(F.col("event_type") == "error").alias("yes"))
    return ev.join(po, "region", "full_outer").join(ue, "region", "full_outer")


_GRID_SQL = """
, g_ev AS (SELECT continent AS region, count(*) AS events, sum(total_laid_off) AS people FROM evm GROUP BY 1),
g_po AS (SELECT r_name AS region, count(DISTINCT l_orderkey) AS postings FROM lineitem
         JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey GROUP BY 1),
g_ue AS (SELECT r_name AS region, count(*) AS answers, count(*) FILTER (WHERE event_type = 'error') AS yes FROM ue GROUP BY 1),
grid AS (SELECT coalesce(g_ev.region, g_po.region, g_ue.region) AS region, events, people, postings, answers, yes
         FROM g_ev FULL OUTER JOIN g_po ON g_ev.region = g_po.region
         FULL OUTER JOIN g_ue ON coalesce(g_ev.region, g_po.region) = g_ue.region)"""
_GRID_EXTRA = ",\n" + S.USER_EVENTS_SQL.strip() + _GRID_SQL


@register("a35_sector_grid", _sql(f"""
SELECT region, CAST(events AS BIGINT) AS events, {R('people', 2)} AS people, CAST(postings AS BIGINT) AS postings,
       {R('yes * 1.0 / answers')} AS threat_rate FROM grid""", _GRID_EXTRA))
def a35_sector_grid(spark, sf_dir):
    """One row per sector from three sources (full outer joins of three small aggregates)."""
    g = _region_grid(Tables(spark, sf_dir))
    return g.select("region", "events", r("people", 2).alias("people"), "postings",
                    r(F.col("yes") / F.col("answers")).alias("threat_rate"))


_SHADES = ("events", "people", "postings", "threat_rate")


@register("a35_sector_grid_shades", _sql(f"""
, g2 AS (SELECT region, events, people, postings, yes * 1.0 / answers AS threat_rate FROM grid)
SELECT region, {", ".join(f"CASE WHEN {c} IS NOT NULL THEN coalesce({R(f'({c} - min({c}) OVER ()) * 1.0 / nullif(max({c}) OVER () - min({c}) OVER (), 0)')}, 1.0) END AS shade_{c}" for c in _SHADES)}
FROM g2""", _GRID_EXTRA))
def a35_sector_grid_shades(spark, sf_dir):
    """How dark each cell of the grid is within its column; a cell without data has no shade."""
    g = _region_grid(Tables(spark, sf_dir)).withColumn("threat_rate", F.col("yes") / F.col("answers"))
    g = ST.with_shades(g, _SHADES)
    return g.select("region", *[r(f"shade_{c}").alias(f"shade_{c}") for c in _SHADES])


@register("a36_share_gap", _sql(f"""
, both_ AS (SELECT region, people, postings FROM grid WHERE people IS NOT NULL AND postings IS NOT NULL)
SELECT region, {R('people * 100.0 / sum(people) OVER ()')} AS pct_people, {R('postings * 100.0 / sum(postings) OVER ()')} AS pct_postings,
       {R('people * 100.0 / sum(people) OVER () - postings * 100.0 / sum(postings) OVER ()')} AS share_gap FROM both_""",
    _GRID_EXTRA))
def a36_share_gap(spark, sf_dir):
    """Only sectors present in both sources; shares renormalised within them."""
    g = _region_grid(Tables(spark, sf_dir)).where(F.col("people").isNotNull() & F.col("postings").isNotNull())
    pp = ST.share_of_total("people") * 100.0
    pq = ST.share_of_total("postings") * 100.0
    return g.select("region", r(pp).alias("pct_people"), r(pq).alias("pct_postings"), r(pp - pq).alias("share_gap"))


@register("a37_rank_correlation", _sql("""
, v AS (SELECT people AS x, yes * 1.0 / answers AS y FROM grid WHERE people IS NOT NULL AND answers IS NOT NULL),
rk AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
              rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM v)
SELECT CAST(count(*) AS BIGINT) AS n, (round(corr(rx, ry), 6) + 0.0) AS rho FROM rk""", _GRID_EXTRA))
def a37_rank_correlation(spark, sf_dir):
    g = _region_grid(Tables(spark, sf_dir)).where(F.col("people").isNotNull() & F.col("answers").isNotNull())
    v = g.select(F.col("people").alias("x"), (F.col("yes") / F.col("answers")).alias("y"))
    return ST.spearman(v, "x", "y").select("n", r("rho").alias("rho"))


_GL, _GH = _wilson_sql("yes", "answers")


@register("a38_sector_bubble", _sql(f"""
SELECT region, {R('log10(people)')} AS log_people, {R('yes * 1.0 / answers')} AS threat_rate,
       {R(_GL)} AS ci_low, {R(_GH)} AS ci_high, CAST(postings AS BIGINT) AS postings FROM grid""", _GRID_EXTRA))
def a38_sector_bubble(spark, sf_dir):
    g = _region_grid(Tables(spark, sf_dir))
    lo, hi = SF.wilson_interval("yes", "answers")
    return g.select("region", r(F.log10("people")).alias("log_people"),
                    r(F.col("yes") / F.col("answers")).alias("threat_rate"), r(lo).alias("ci_low"),
                    r(hi).alias("ci_high"), "postings")


@register("a39_matched_family", _sql(f"""
, a AS (SELECT c_mktsegment AS family, count(*) AS answers, count(*) FILTER (WHERE event_type = 'error') AS yes FROM ue GROUP BY 1),
b AS (SELECT family, avg(demand_growth) AS growth FROM po GROUP BY 1)
SELECT a.family, {R('yes * 1.0 / answers')} AS threat_rate, {R(_GL)} AS ci_low, {R(_GH)} AS ci_high,
       {R('growth')} AS mean_demand_growth FROM a JOIN b ON a.family = b.family""",
    ",\n" + S.USER_EVENTS_SQL.strip()))
def a39_matched_family(spark, sf_dir):
    """Families present in both sources (inner join of two aggregates)."""
    t = Tables(spark, sf_dir)
    a = S.user_events(t).groupBy(F.col("c_mktsegment").alias("family")).agg(
        F.count(F.lit(1)).alias("answers"), F.count_if(F.col("event_type") == "error").alias("yes"))
    b = S.postings(t).groupBy("family").agg(F.avg("demand_growth").alias("growth"))
    lo, hi = SF.wilson_interval("yes", "answers")
    return a.join(b, "family").select("family", r(F.col("yes") / F.col("answers")).alias("threat_rate"),
                                      r(lo).alias("ci_low"), r(hi).alias("ci_high"),
                                      r("growth").alias("mean_demand_growth"))


#: Survey label -> posting family; two labels share a family and one family has no label.
LABEL_FAMILY = {"AUTOMOBILE": "AUTOMOBILE", "FURNITURE": "HOUSEHOLD", "HOUSEHOLD": "HOUSEHOLD", "MACHINERY": "MACHINERY"}


def family_matches(answers: DataFrame, postings_: DataFrame, label: str, yes: str, mapping: dict[str, str]) -> DataFrame:
    """(family, answers, yes, growth, postings, matched) of every posting family and every mapped label's family.

    Labels go to families by the map before they are counted; a label without a family leaves the comparison. A family
    of one source only stays, with NULL for the other and ``matched`` false.
    """
    a = answers.select(SF.map_lookup(label, mapping).alias("family"), F.col(yes).alias("__yes")) \
        .where(F.col("family").isNotNull()).groupBy("family") \
        .agg(F.count(F.lit(1)).alias("answers"), F.count_if("__yes").alias("yes"))
    b = postings_.groupBy("family").agg(F.avg("demand_growth").alias("growth"), F.count(F.lit(1)).alias("postings"))
    return a.join(b, "family", "full_outer").withColumn(
        "matched", F.col("answers").isNotNull() & F.col("postings").isNotNull())


@register("a39_mapped_family", _sql("""
, a AS (SELECT CASE c_mktsegment """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABEL_FAMILY.items()) + f""" END AS family,
               count(*) AS answers, count(*) FILTER (WHERE event_type = 'error') AS yes FROM ue GROUP BY 1 HAVING family IS NOT NULL),
b AS (SELECT family, avg(demand_growth) AS growth, count(*) AS postings FROM po GROUP BY 1)
SELECT coalesce(a.family, b.family) AS family, a.family IS NOT NULL AND b.family IS NOT NULL AS matched,
       {R('yes * 1.0 / answers')} AS threat_rate, {R(_GL)} AS ci_low, {R(_GH)} AS ci_high,
       {R('growth')} AS mean_demand_growth, CAST(postings AS BIGINT) AS postings
FROM a FULL OUTER JOIN b ON a.family = b.family""", ",\n" + S.USER_EVENTS_SQL.strip()))
def a39_mapped_family(spark, sf_dir):
    """Threat rate beside demand growth for every family, labels mapped to families, unmatched families kept."""
    t = Tables(spark, sf_dir)
    ue = S.user_events(t).withColumn("__error", F.col("event_type") == "error")
    g = family_matches(ue, S.postings(t), "c_mktsegment", "__error", LABEL_FAMILY)
    lo, hi = SF.wilson_interval("yes", "answers")
    return g.select("family", "matched", r(F.col("yes") / F.col("answers")).alias("threat_rate"),
                    r(lo).alias("ci_low"), r(hi).alias("ci_high"), r("growth").alias("mean_demand_growth"), "postings")


_SKILL_THEME_SQL = ("CASE WHEN TRY_CAST(substr(skill, 7) AS INTEGER) <= 8 THEN 'browse' "
                    "WHEN TRY_CAST(substr(skill, 7) AS INTEGER) <= 16 THEN 'commit' ELSE 'friction' END")


def _skill_theme(c):
    n = F.expr(f"try_cast(substr({c}, 7) AS INT)")
    return F.when(n <= 8, "browse").when(n <= 16, "commit").otherwise("friction")


@register("a40_theme_rank_comparison", _sql(f"""
, ans AS (SELECT {_THEME_SQL} AS theme, count(*) * 1.0 / sum(count(*)) OVER () AS share FROM ue GROUP BY 1),
pst AS (SELECT theme, count(DISTINCT posting_id) * 1.0 / (SELECT count(DISTINCT posting_id) FROM ps) AS share
        FROM (SELECT posting_id, {_SKILL_THEME_SQL} AS theme FROM ps) GROUP BY 1),
rk AS (SELECT a.theme, a.share AS answer_share, p.share AS posting_share,
              rank() OVER (ORDER BY a.share DESC) AS answer_rank, rank() OVER (ORDER BY p.share DESC) AS posting_rank
       FROM ans a JOIN pst p ON a.theme = p.theme)
SELECT theme, {R('answer_share')} AS answer_share, {R('posting_share')} AS posting_share,
       CAST(answer_rank AS INTEGER) AS answer_rank, CAST(posting_rank AS INTEGER) AS posting_rank,
       abs(answer_rank - posting_rank) >= 2 AS rank_differs FROM rk""", ",\n" + S.USER_EVENTS_SQL.strip()))
def a40_theme_rank_comparison(spark, sf_dir):
    """Theme share and rank in answers vs postings (a posting counted once per theme)."""
    t = Tables(spark, sf_dir)
    ans = S.user_events(t).groupBy(SF.map_lookup("event_type", EVENT_THEME).alias("theme")).agg(
        F.count(F.lit(1)).alias("k"))
    ans = ans.select("theme", (F.col("k") / F.sum("k").over(Window.partitionBy())).alias("answer_share"))
    ps = S.posting_skills(t)
    n = ps.agg(F.count_distinct("posting_id").alias("__n"))
    pst = ps.groupBy(_skill_theme("skill").alias("theme")).agg(F.count_distinct("posting_id").alias("k")) \
        .crossJoin(F.broadcast(n)).select("theme", (F.col("k") / F.col("__n")).alias("posting_share"))
    j = ans.join(pst, "theme")
    j = j.select("theme", "answer_share", "posting_share",
                 F.rank().over(Window.orderBy(F.desc("answer_share"))).alias("answer_rank"),
                 F.rank().over(Window.orderBy(F.desc("posting_share"))).alias("posting_rank"))
    return j.select("theme", r("answer_share").alias("answer_share"), r("posting_share").alias("posting_share"),
                    "answer_rank", "posting_rank",
                    (F.abs(F.col("answer_rank") - F.col("posting_rank")) >= 2).alias("rank_differs"))
