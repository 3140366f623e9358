"""Basket-mining queries (B1-B5): orders as baskets of part types or brands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import basket as B
from starlift.plans import standins as S
from starlift.plans.registry import register
from starlift.session import Tables

# Thresholds of the mining runs.
MIN_SUPPORT = 0.05
MIN_LIFT = 1.0
MIN_WEIGHT = 30
SYNONYM_CANDIDATES = [("Brand#1", "Brand#10"), ("Brand#2", "Brand#20"), ("Brand#3", "Brand#13")]


def type_baskets(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", "p_type")
    return B.baskets(li.join(p, li.l_partkey == p.p_partkey), "l_orderkey", "p_type")


_BASKET_SQL = f"""
b AS (SELECT l_orderkey, list_sort(list_distinct(list(p_type))) AS items FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE p_type IS NOT NULL GROUP BY l_orderkey),
nb AS (SELECT count(*) AS n FROM b),
sub AS (SELECT list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS itemset
        FROM (SELECT items, unnest(range(1, CAST(pow(2, len(items)) AS BIGINT))) AS mask FROM b)),
fi AS (SELECT itemset, count(*) AS freq FROM sub GROUP BY itemset HAVING count(*) >= ceil({MIN_SUPPORT} * (SELECT n FROM nb)))"""


@register("b1_frequent_itemsets", "WITH " + _BASKET_SQL.strip() + """
SELECT array_to_string(itemset, '|') AS items, CAST(len(itemset) AS INTEGER) AS size, CAST(freq AS BIGINT) AS freq,
       (round(freq * 1.0 / (SELECT n FROM nb), 6) + 0.0) AS support FROM fi""")
def b1_frequent_itemsets(spark, sf_dir):
    """B1: FP-growth itemsets of part types per order."""
    bk = type_baskets(Tables(spark, sf_dir))
    n = bk.agg(F.count(F.lit(1)).alias("n"))
    fi = B.frequent_itemsets(bk, MIN_SUPPORT)
    return fi.crossJoin(F.broadcast(n)).select(
        F.array_join("items", B.ITEM_SEP).alias("items"), F.size("items").alias("size"), "freq",
        SF.rounded(F.col("freq") / F.col("n")).alias("support"))


@register("b2_association_rules", "WITH " + _BASKET_SQL.strip() + f""",
sp AS (SELECT itemset, freq, list_filter(itemset, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS ante,
              list_filter(itemset, lambda x, i: (mask >> (i - 1)) & 1 = 0) AS cons
       FROM (SELECT itemset, freq, unnest(range(1, CAST(pow(2, len(itemset)) AS BIGINT) - 1)) AS mask FROM fi
             WHERE len(itemset) >= 2)),
r AS (SELECT sp.ante, sp.cons, sp.freq * 1.0 / (SELECT n FROM nb) AS support, sp.freq * 1.0 / a.freq AS confidence,
             (sp.freq * 1.0 / a.freq) / (c.freq * 1.0 / (SELECT n FROM nb)) AS lift
      FROM sp JOIN fi a ON sp.ante = a.itemset JOIN fi c ON sp.cons = c.itemset)
SELECT array_to_string(ante, '|') AS antecedent, array_to_string(cons, '|') AS consequent,
       (round(support, 6) + 0.0) AS support, (round(confidence, 6) + 0.0) AS confidence, (round(lift, 6) + 0.0) AS lift
FROM r WHERE lift >= {MIN_LIFT}""")
def b2_association_rules(spark, sf_dir):
    """B2: rules with multi-item consequents from the B1 itemsets, lift >= threshold."""
    bk = type_baskets(Tables(spark, sf_dir))
    n = bk.agg(F.count(F.lit(1)).alias("n"))
    rules = B.association_rules(B.frequent_itemsets(bk, MIN_SUPPORT), n, min_lift=MIN_LIFT)
    return rules.select(F.array_join("antecedent", B.ITEM_SEP).alias("antecedent"),
                        F.array_join("consequent", B.ITEM_SEP).alias("consequent"),
                        SF.rounded("support").alias("support"), SF.rounded("confidence").alias("confidence"),
                        SF.rounded("lift").alias("lift"))


_EDGES_SQL = f"""
ps2 AS (SELECT DISTINCT posting_id, skill FROM ps WHERE skill IS NOT NULL),
edges AS (SELECT a.skill AS item_a, b.skill AS item_b, count(*) AS weight FROM ps2 a JOIN ps2 b
          ON a.posting_id = b.posting_id AND a.skill < b.skill GROUP BY 1, 2 HAVING count(*) >= {MIN_WEIGHT})"""


@register("b3_cooccurrence_edges", "WITH " + S.POSTING_SKILLS_SQL.strip() + "," + _EDGES_SQL + """
SELECT item_a, item_b, CAST(weight AS BIGINT) AS weight FROM edges""")
def b3_cooccurrence_edges(spark, sf_dir):
    """Skill pairs in >= MIN_WEIGHT postings, via per-partition Gram blocks (no per-basket pair lists)."""
    return B.cooccurrence(S.posting_skills(Tables(spark, sf_dir)), "posting_id", "skill", MIN_WEIGHT)


@register("b3_network_summary", "WITH " + S.POSTING_SKILLS_SQL.strip() + "," + _EDGES_SQL + """
SELECT CAST((SELECT count(*) FROM (SELECT item_a FROM edges UNION SELECT item_b FROM edges)) AS BIGINT) AS nodes,
       CAST(count(*) AS BIGINT) AS edges FROM edges""")
def b3_network_summary(spark, sf_dir):
    return B.network_summary(B.cooccurrence(S.posting_skills(Tables(spark, sf_dir)), "posting_id", "skill", MIN_WEIGHT))


def raw_brand_rows(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", "p_brand")
    o = t.orders.select("o_orderkey", "o_orderpriority")
    return (li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("l_orderkey").alias("posting_id"), F.col("p_brand").alias("tag"),
                    F.col("o_orderpriority").alias("title")))


_CAND_SQL = " UNION ALL ".join(f"SELECT '{a}' AS tag_a, '{b}' AS tag_b" for a, b in SYNONYM_CANDIDATES)


@register("b4_synonym_evidence", f"""
WITH raw AS (SELECT l_orderkey AS posting_id, p_brand AS tag, o_orderpriority AS title FROM lineitem
             JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
cand AS ({_CAND_SQL}),
both_ AS (SELECT c.tag_a, c.tag_b, count(*) AS k FROM cand c JOIN (
            SELECT DISTINCT x.posting_id, c2.tag_a, c2.tag_b FROM raw x JOIN raw y ON x.posting_id = y.posting_id
            JOIN cand c2 ON x.tag = c2.tag_a AND y.tag = c2.tag_b) z ON c.tag_a = z.tag_a AND c.tag_b = z.tag_b
          GROUP BY 1, 2),
tv AS (SELECT tag, count(DISTINCT title) AS v FROM raw GROUP BY tag)
SELECT c.tag_a, c.tag_b, CAST(coalesce(b.k, 0) AS BIGINT) AS baskets_with_both,
       CAST(coalesce(ta.v, 0) AS BIGINT) AS values_a, CAST(coalesce(tb.v, 0) AS BIGINT) AS values_b,
       ta.v = 1 AS a_exclusive, tb.v = 1 AS b_exclusive
FROM cand c LEFT JOIN both_ b ON c.tag_a = b.tag_a AND c.tag_b = b.tag_b
LEFT JOIN tv ta ON c.tag_a = ta.tag LEFT JOIN tv tb ON c.tag_b = tb.tag""")
def b4_synonym_evidence(spark, sf_dir):
    """Co-occurrence in the same posting and title exclusivity of candidate tag pairs (before merging)."""
    return B.synonym_evidence(raw_brand_rows(Tables(spark, sf_dir)), "posting_id", "tag", "title", SYNONYM_CANDIDATES)


@register("b5_tag_base_rate", "WITH " + S.POSTING_SKILLS_SQL.strip() + """
SELECT skill, CAST(count(DISTINCT posting_id) AS BIGINT) AS baskets,
       (round(count(DISTINCT posting_id) * 1.0 / (SELECT count(DISTINCT posting_id) FROM ps), 6) + 0.0) AS share
FROM ps WHERE skill IS NOT NULL GROUP BY skill""")
def b5_tag_base_rate(spark, sf_dir):
    br = B.base_rate(S.posting_skills(Tables(spark, sf_dir)), "posting_id", "skill")
    return br.select("skill", "baskets", SF.rounded("share").alias("share"))
