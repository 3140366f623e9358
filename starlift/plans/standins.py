"""Stand-in datasets derived from the driver tables.

Each stand-in is given twice: as a Spark DataFrame (the real implementation)
and as a DuckDB SQL common-table expression used only by the oracle check.
Every stand-in reads whole tables; nothing is sampled or capped.

| stand-in        | built from                                     | plays the role of      |
|-----------------|------------------------------------------------|------------------------|
| layoff events   | orders ⋈ customer ⋈ nation ⋈ region            | layoffs dataset        |
| postings        | orders ⋈ customer ⋈ nation (+ lineitem ⋈ part) | AI-jobs dataset        |
| posting tags    | distinct p_brand of an order's lines           | required_skills        |
| answers         | documents ⟕ labels, events ⋈ customer          | survey answers         |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.session import Tables

# Fixed values for the stand-ins (parameters of the demonstration, not of the engine).
# market segment -> sector; HOUSEHOLD is deliberately absent (an unmapped label).
SEGMENT_SECTOR = {
    "AUTOMOBILE": "Manufacturing & Industrial",
    "MACHINERY": "Manufacturing & Industrial",
    "BUILDING": "Real Estate",
    "FURNITURE": "Retail & Consumer",
}
# order priority -> experience level (C4 shape: raw label -> canonical level).
PRIORITY_LEVEL = {
    "1-URGENT": "Lead",
    "2-HIGH": "Senior",
    "3-MEDIUM": "Mid",
    "4-NOT SPECIFIED": "Entry",
    "5-LOW": "Entry",
}
# brand synonyms for tag normalisation (C10 shape: two labels merged into one).
BRAND_SYNONYMS = {
    "Brand#1": "Brand#10",
    "Brand#2": "Brand#20",
}
# event type -> Likert score (A26); 'error' is the excluded "Unsure" answer.
EVENT_LIKERT = {"view": 1, "click": 2, "signup": 4, "purchase": 5}
# label of an answer not given.
NOT_ANSWERED = "Not answered"
# share above which an event counts as a shutdown-like full cut.
PRICE_FULL_SCALE = 400000.0

LAYOFF_CONTENT = ["company", "event_date", "country", "continent", "industry", "stage",
                  "total_laid_off", "percentage_laid_off", "funds_raised"]


def layoff_events(t: Tables) -> DataFrame:
    """One row per order: company = customer, date = order date, headcount = total
    price (undisclosed while the order is pending), share = price / full scale."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    return j.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("c_name").alias("company"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("continent"),
        F.col("c_mktsegment").alias("industry"),
        F.col("o_orderpriority").alias("stage"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double")).otherwise(F.col("o_totalprice"))
        .alias("total_laid_off"),
        F.least(F.col("o_totalprice") / PRICE_FULL_SCALE, F.lit(1.0)).alias("percentage_laid_off"),
        F.col("c_acctbal").alias("funds_raised"))


LAYOFF_EVENTS_SQL = f"""
ev AS (
  SELECT o.o_orderkey AS event_id, c.c_name AS company, CAST(o.o_orderdate AS DATE) AS event_date,
         n.n_name AS country, r.r_name AS continent, c.c_mktsegment AS industry, o.o_orderpriority AS stage,
         CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_totalprice END AS total_laid_off,
         least(o.o_totalprice / {PRICE_FULL_SCALE}, 1.0) AS percentage_laid_off,
         c.c_acctbal AS funds_raised
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def country_map(t: Tables) -> DataFrame:
    """C1 reference table (raw, canonical, continent) derived from nation ⋈ region."""
    n, r = t.nation, t.region
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("raw"), F.regexp_replace("n_name", "_", " ").alias("canonical"),
        F.col("r_name").alias("continent"))


COUNTRY_MAP_SQL = """
cmap AS (
  SELECT n_name AS raw, replace(n_name, '_', ' ') AS canonical, r_name AS continent
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def order_brands(t: Tables) -> DataFrame:
    """(order, raw pipe-joined brand list): the multi-value tag field before normalisation."""
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .groupBy("l_orderkey").agg(F.concat_ws(" | ", F.collect_list("p_brand")).alias("raw_tags")))


def posting_labels(t: Tables) -> DataFrame:
    """(posting_id, country, family) only - what the conformed dimensions need, without the line measures."""
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("o_orderkey").alias("posting_id"), F.col("n_name").alias("country"),
                    F.col("c_mktsegment").alias("family")))


def postings(t: Tables) -> DataFrame:
    """One row per order as a job posting, with line-level measures."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name")
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.avg("l_discount").alias("avg_discount"))
    j = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
         .join(li, o.o_orderkey == li.l_orderkey, "left"))
    lvl = F.create_map(*[F.lit(x) for kv in PRIORITY_LEVEL.items() for x in kv])
    return j.select(
        F.col("o_orderkey").alias("posting_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("c_mktsegment").alias("family"),
        F.col("n_name").alias("country"),
        F.col("o_totalprice").alias("salary"),
        lvl[F.col("o_orderpriority")].alias("experience_level"),
        F.col("o_orderstatus").alias("education"),
        (F.col("o_orderstatus") == "F").alias("is_llm_role"),
        F.year("o_orderdate").alias("posting_year"),
        F.month("o_orderdate").alias("posting_month"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("demand_score"),
        (F.col("avg_discount") * 100.0).alias("demand_growth"))


POSTINGS_SQL = """
li_agg AS (SELECT l_orderkey, count(*) AS n_lines, avg(l_discount) AS avg_discount FROM lineitem GROUP BY l_orderkey),
po AS (
  SELECT o.o_orderkey AS posting_id, o.o_orderpriority AS title, c.c_mktsegment AS family, n.n_name AS country,
         o.o_totalprice AS salary,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Lead' WHEN '2-HIGH' THEN 'Senior' WHEN '3-MEDIUM' THEN 'Mid'
              WHEN '4-NOT SPECIFIED' THEN 'Entry' WHEN '5-LOW' THEN 'Entry' END AS experience_level,
         o.o_orderstatus AS education, (o.o_orderstatus = 'F') AS is_llm_role,
         CAST(year(o.o_orderdate) AS INTEGER) AS posting_year, CAST(month(o.o_orderdate) AS INTEGER) AS posting_month,
         CAST(coalesce(li.n_lines, 0) AS BIGINT) AS demand_score, li.avg_discount * 100.0 AS demand_growth
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN li_agg li ON o.o_orderkey = li.l_orderkey)"""


def _skill() -> Column:
    syn = F.create_map(*[F.lit(x) for kv in BRAND_SYNONYMS.items() for x in kv])
    return F.coalesce(syn[F.trim("p_brand")], F.trim("p_brand")).alias("skill")


#: Lines of a task of ``posting_skills``.
TASK_LINES = 1 << 18


def posting_skills(t: Tables) -> DataFrame:
    """Bridge source: (posting_id, skill) with brand synonyms merged, distinct pairs.

    The pairs lie by posting, so what follows by posting shuffles them no more; tasks grow in number, not in size.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", "p_brand")
    pairs = li.join(p, li.l_partkey == p.p_partkey).select(F.col("l_orderkey").alias("posting_id"), _skill())
    lines = t.lineitem.count()   # from the footers
    n = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-lines // TASK_LINES))
    return pairs.repartition(n, "posting_id").distinct()


def skills(t: Tables) -> DataFrame:
    """The distinct skills of ``posting_skills``, without its pairs."""
    return t.lineitem.select("l_partkey").join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(_skill()).distinct()


POSTING_SKILLS_SQL = """
ps AS (
  SELECT DISTINCT l_orderkey AS posting_id,
         CASE trim(p_brand) WHEN 'Brand#1' THEN 'Brand#10' WHEN 'Brand#2' THEN 'Brand#20' ELSE trim(p_brand) END AS skill
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def labelled_docs(t: Tables) -> DataFrame:
    """Survey-answer stand-in: every document is a respondent; toxic = yes/no answer, NULL where not answered.

    ``*_answer`` hold the answers as labels with an explicit non-answer (C7)."""
    d = t.documents.select("doc_id", "lang", "source", "n_chars", "text")
    lab = t.labels.select("doc_id", "quality", "toxic")
    answers = [F.coalesce(F.col(c).cast("string"), F.lit(NOT_ANSWERED)).alias(f"{c}_answer") for c in ("quality", "toxic")]
    return d.join(lab, "doc_id", "left").select("*", *answers)


LABELLED_DOCS_SQL = f"""
ld AS (SELECT d.doc_id, l.quality, l.toxic, d.lang, d.source, d.n_chars, d.text,
              coalesce(CAST(l.quality AS VARCHAR), '{NOT_ANSWERED}') AS quality_answer,
              coalesce(CAST(l.toxic AS VARCHAR), '{NOT_ANSWERED}') AS toxic_answer
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def user_events(t: Tables) -> DataFrame:
    """Events with the user's customer attributes (user_id = customer key)."""
    e = t.events.select("event_id", "user_id", "event_type", "value", "ts")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return (e.join(c, e.user_id == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select("event_id", "user_id", "event_type", "value", "ts", "c_mktsegment", "c_acctbal", "r_name"))


USER_EVENTS_SQL = """
ue AS (SELECT e.event_id, e.user_id, e.event_type, e.value, e.ts, c.c_mktsegment, c.c_acctbal, r.r_name
       FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
