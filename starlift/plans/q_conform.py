"""Conformance / cleanup queries (C1-C10) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import conform as CF
from starlift.plans import standins as S
from starlift.plans.registry import register
from starlift.session import Tables

_SECTOR_CASE = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.SEGMENT_SECTOR.items()) + " END"


@register("c5_conform_customers", "WITH " + S.COUNTRY_MAP_SQL.strip() + f"""
SELECT c.c_custkey, m.canonical AS country_canonical, m.continent, {_SECTOR_CASE} AS industry_sector,
       coalesce(c.c_mktsegment, 'Unknown') AS industry
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN cmap m ON n.n_name = m.raw""")
def c5_conform_customers(spark, sf_dir):
    """C1 (reference-table join) + C2 (literal map) + C6 (fill after mapping)."""
    t = Tables(spark, sf_dir)
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select("c_custkey", F.col("n_name").alias("country"), "c_mktsegment")
    c = CF.conform(c, "country", S.country_map(t), "country_canonical", extra=["continent"])
    c = c.withColumn("industry_sector", SF.map_lookup("c_mktsegment", S.SEGMENT_SECTOR))
    c = CF.fill_unknown(c.withColumn("industry", F.col("c_mktsegment")), ["industry"])
    return c.select("c_custkey", "country_canonical", "continent", "industry_sector", "industry")


@register("c1_complete_country_map", "WITH " + S.COUNTRY_MAP_SQL.strip() + """,
used AS (SELECT n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey
         UNION ALL SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT m.canonical AS country_canonical, CAST(count(*) AS BIGINT) AS row_count
FROM used JOIN cmap m ON used.country = m.raw GROUP BY 1""")
def c1_complete_country_map(spark, sf_dir):
    """Rows per canonical country, after the check that the reference table resolves every country in use."""
    t = Tables(spark, sf_dir)
    names = t.nation.select("n_nationkey", F.col("n_name").alias("country"))
    used = t.customer.join(names, F.col("c_nationkey") == F.col("n_nationkey")).select("country").unionByName(
        t.supplier.join(names, F.col("s_nationkey") == F.col("n_nationkey")).select("country"))
    cmap = CF.complete_map(S.country_map(t), used, "country")
    return CF.conform(used, "country", cmap, "country_canonical").groupBy("country_canonical") \
        .agg(F.count(F.lit(1)).alias("row_count"))


@register("c8_bucket_counts", """
SELECT CASE WHEN p_size IS NULL THEN NULL WHEN p_size <= 2 THEN 'Entry' WHEN p_size <= 5 THEN 'Mid'
            WHEN p_size <= 9 THEN 'Senior' ELSE 'Lead' END AS size_bucket, CAST(count(*) AS BIGINT) AS parts
FROM part GROUP BY 1""")
def c8_bucket_counts(spark, sf_dir):
    """Right-closed buckets (-inf,2], (2,5], (5,9], (9,inf)."""
    p = CF.add_bucket(Tables(spark, sf_dir).part, "p_size", "size_bucket")
    return p.groupBy("size_bucket").agg(F.count(F.lit(1)).alias("parts"))


@register("c9_winsorize", """
WITH b AS (SELECT quantile_cont(c_acctbal, 0.01) AS lo, quantile_cont(c_acctbal, 0.99) AS hi FROM customer
           WHERE c_acctbal IS NOT NULL)
SELECT c_custkey, (round(c_acctbal, 2) + 0.0) AS c_acctbal,
       (round(CASE WHEN c_acctbal IS NULL THEN NULL WHEN c_acctbal < lo THEN lo WHEN c_acctbal > hi THEN hi
                   ELSE c_acctbal END, 6) + 0.0) AS acctbal_winsorized
FROM customer, b""")
def c9_winsorize(spark, sf_dir):
    """Clip to the exact 1st/99th percentiles (interpolated); NULL stays NULL."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_acctbal")
    w = CF.winsorize(c, "c_acctbal", "acctbal_winsorized")
    return w.select("c_custkey", SF.rounded("c_acctbal", 2).alias("c_acctbal"),
                    SF.rounded("acctbal_winsorized").alias("acctbal_winsorized"))


@register("c10_tag_normalization", "WITH " + """
raw AS (SELECT l_orderkey, string_agg(p_brand, ' | ') AS raw_tags FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY l_orderkey)
SELECT l_orderkey, array_to_string(list_sort(list_distinct(list_transform(string_split(raw_tags, '|'),
         lambda t: CASE trim(t) WHEN 'Brand#1' THEN 'Brand#10' WHEN 'Brand#2' THEN 'Brand#20' ELSE trim(t) END))), '|')
         AS tags_normalized
FROM raw""")
def c10_tag_normalization(spark, sf_dir):
    """Raw pipe-joined tags (duplicates, spaces) -> trimmed, synonyms merged, distinct, sorted."""
    raw = S.order_brands(Tables(spark, sf_dir))
    return CF.normalize_tag_column(raw, "raw_tags", "tags_normalized", S.BRAND_SYNONYMS) \
        .select("l_orderkey", "tags_normalized")


# Stand-in role vocabulary; an order priority outside it has no category.
ROLE_MAP = {"1-URGENT": "Emerging", "2-HIGH": "Emerging", "3-MEDIUM": "Traditional", "5-LOW": "Traditional"}
_ROLE_CASE = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROLE_MAP.items()) + " END"


@register("c3_role_conform", f"SELECT o_orderkey, o_orderpriority AS title, {_ROLE_CASE} AS role_category FROM orders")
def c3_role_conform(spark, sf_dir):
    """Literal map of titles to categories; an unmapped title stays NULL."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.col("o_orderpriority").alias("title"))
    return CF.conform(o, "title", ROLE_MAP, "role_category").select("o_orderkey", "title", "role_category")


@register("c13_text_date_key", """
WITH d AS (SELECT o_orderkey, month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) AS date_text FROM orders)
SELECT o_orderkey, date_text, CAST(strftime(strptime(date_text, '%m/%d/%Y'), '%Y%m%d') AS INTEGER) AS date_key FROM d""")
def c13_text_date_key(spark, sf_dir):
    """M/d/yyyy text -> smart key; bad text would fail the job."""
    text = F.concat_ws("/", F.month("o_orderdate"), F.dayofmonth("o_orderdate"), F.year("o_orderdate"))
    d = Tables(spark, sf_dir).orders.select("o_orderkey", text.alias("date_text"))
    return d.withColumn("date_key", SF.date_key(SF.parse_date("date_text", strict=True)))


@register("c14_tolerant_date_key", """
WITH d AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
                  ELSE month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) END AS date_text FROM orders)
SELECT o_orderkey, date_text, CAST(strftime(try_strptime(date_text, '%m/%d/%Y'), '%Y%m%d') AS INTEGER) AS date_key FROM d""")
def c14_tolerant_date_key(spark, sf_dir):
    """C14: text in another format and text that is no date give NULL, the rest its key."""
    usual = F.concat_ws("/", F.month("o_orderdate"), F.dayofmonth("o_orderdate"), F.year("o_orderdate"))
    text = F.when(F.col("o_orderstatus") == "P", "pending").when(
        F.col("o_orderstatus") == "O", F.col("o_orderdate").cast("date").cast("string")).otherwise(usual)
    d = Tables(spark, sf_dir).orders.select("o_orderkey", text.alias("date_text"))
    return d.withColumn("date_key", SF.date_key(SF.parse_date("date_text")))


@register("c17_clean_nulls", """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN (round(c_acctbal, 2) + 0.0) END AS acctbal,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer""")
def c17_clean_nulls(spark, sf_dir):
    """C17: NaN and null tokens become NULL (the stand-in marks missing balances NaN and one segment N/A)."""
    raw = Tables(spark, sf_dir).customer.select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(SF.rounded("c_acctbal", 2)).alias("acctbal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "N/A").otherwise(F.col("c_mktsegment")).alias("segment"))
    return CF.clean_nulls(raw)
