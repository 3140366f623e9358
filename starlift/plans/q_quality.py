"""Quality-rule queries (Q1-Q11, S2-S4, P1-P4) over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.operators import profile as P
from starlift.operators import quality as Q
from starlift.plans import standins as S
from starlift.plans.registry import reasons_sql, register
from starlift.session import Tables
from starlift.sources import contracts as C

# ---------------------------------------------------------------- rule sets on the stand-ins

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
RETURNFLAG_VOCAB = ("A", "R")
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
# Upper size bound per part type for the bucket-bound rule (Q10); offset 5.
PART_TYPE_SIZE_BOUND = {"SMALL": 20, "MEDIUM": 35, "LARGE": 50}
DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
LANG_VOCAB = ("en", "fr", "de")


def layoff_rules(t: Tables) -> tuple[DataFrame, dict]:
    ev = S.layoff_events(t)
    ev = Q.add_row_and_key_flags(ev, S.LAYOFF_CONTENT, ["company", "event_date", "country"], "event_id", "event_id",
                                 "__dup_row", "__conflict")
    rules = {
        "percentage_laid_off_out_of_range": Q.range_violation("percentage_laid_off", 0, 1),
        "total_laid_off_negative": F.col("total_laid_off") < 0,
        "funds_raised_negative": F.col("funds_raised") < 0,
        "duplicate_row": F.col("__dup_row"),
        "duplicate_key_conflicting_values": F.col("__conflict"),
        "country_not_in_dimension_map": F.col("country").isNotNull() & ~F.col("__country_known"),
        "industry_not_in_dimension_map": F.col("industry").isNotNull() & ~F.col("industry").isin(list(S.SEGMENT_SECTOR)),
    }
    known = S.country_map(t).select(F.col("raw").alias("__raw")).distinct().withColumn("__hit", F.lit(True))
    ev = ev.join(known, F.col("country") == F.col("__raw"), "left") \
        .withColumn("__country_known", F.coalesce(F.col("__hit"), F.lit(False))).drop("__raw", "__hit")
    return ev, rules


_ALL_EV = ", ".join(S.LAYOFF_CONTENT)
LAYOFF_TAGGED_SQL = S.LAYOFF_EVENTS_SQL + "," + S.COUNTRY_MAP_SQL + f""",
ev_t AS (
  SELECT *,
    row_number() OVER (PARTITION BY {_ALL_EV} ORDER BY event_id) AS rn_full,
    count(*) OVER (PARTITION BY {_ALL_EV}) AS n_full,
    count(*) OVER (PARTITION BY company, event_date, country) AS n_key,
    CASE WHEN company IS NOT NULL AND event_date IS NOT NULL AND country IS NOT NULL
         THEN max(event_id) OVER (PARTITION BY company, event_date, country) END AS latest
  FROM ev),
evq AS (
  SELECT ev_t.*, """ + reasons_sql([
    ("percentage_laid_off_out_of_range", "percentage_laid_off IS NOT NULL AND NOT (percentage_laid_off BETWEEN 0 AND 1)"),
    ("total_laid_off_negative", "total_laid_off < 0"),
    ("funds_raised_negative", "funds_raised < 0"),
    ("duplicate_row", "rn_full > 1"),
    ("duplicate_key_conflicting_values", "n_key > 1 AND n_full = 1 AND NOT coalesce(event_id = latest, false)"),
    ("country_not_in_dimension_map", "country IS NOT NULL AND country NOT IN (SELECT raw FROM cmap)"),
    ("industry_not_in_dimension_map",
     "industry IS NOT NULL AND industry NOT IN (" + ", ".join(f"'{k}'" for k in S.SEGMENT_SECTOR) + ")"),
]) + " AS reasons FROM ev_t)"


def lineitem_rules(t: Tables) -> tuple[DataFrame, dict]:
    li = Q.with_position(t.lineitem, "__seq")  # file order (§7.3 X5)
    li = Q.add_row_and_key_flags(li, LINEITEM_COLS, ["l_orderkey", "l_linenumber"], "__seq", "l_shipdate",
                                 "__dup_row", "__conflict")
    rules = {
        "tax_out_of_range": Q.range_violation("l_tax", 0, 0.07),
        "quantity_negative": F.col("l_quantity") < 0,
        "price_not_positive": F.col("l_extendedprice") <= 0,
        "duplicate_row": F.col("__dup_row"),
        "duplicate_key_conflicting_values": F.col("__conflict"),
        "returnflag_not_in_vocabulary": F.col("l_returnflag").isNotNull() & ~F.col("l_returnflag").isin(*RETURNFLAG_VOCAB),
    }
    return li, rules


_ALL_LI = ", ".join(LINEITEM_COLS)
LINEITEM_TAGGED_SQL = f"""
li_t AS (
  SELECT *,
    row_number() OVER (PARTITION BY {_ALL_LI}) AS rn_full,
    count(*) OVER (PARTITION BY {_ALL_LI}) AS n_full,
    count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n_key,
    CASE WHEN l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
         THEN max(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber) END AS latest
  FROM lineitem),
liq AS (
  SELECT li_t.*, """ + reasons_sql([
    ("tax_out_of_range", "l_tax IS NOT NULL AND NOT (l_tax BETWEEN 0 AND 0.07)"),
    ("quantity_negative", "l_quantity < 0"),
    ("price_not_positive", "l_extendedprice <= 0"),
    ("duplicate_row", "rn_full > 1"),
    ("duplicate_key_conflicting_values", "n_key > 1 AND n_full = 1 AND NOT coalesce(l_shipdate = latest, false)"),
    ("returnflag_not_in_vocabulary", "l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'R')"),
]) + " AS reasons FROM li_t)"


def customer_rules(t: Tables) -> tuple[DataFrame, dict]:
    c = Q.add_duplicate_flag(Q.with_position(t.customer, "__seq"), ["c_name"], ["c_custkey", "__seq"], "__dup_name")
    c = Q.add_vocab_flag(c, "c_nationkey", t.nation.select("n_nationkey"), "__bad_nation")
    rules = {
        "acctbal_negative": F.col("c_acctbal") < 0,
        "duplicate_name": F.col("__dup_name"),
        "segment_not_in_dimension_map": F.col("c_mktsegment").isNotNull() & ~F.col("c_mktsegment").isin(list(S.SEGMENT_SECTOR)),
        "nation_not_in_dimension_map": F.col("__bad_nation"),
    }
    return c, rules


CUSTOMER_TAGGED_SQL = """
cu_t AS (SELECT *, row_number() OVER (PARTITION BY c_name ORDER BY c_custkey) AS rn_name FROM customer),
cuq AS (
  SELECT cu_t.*, """ + reasons_sql([
    ("acctbal_negative", "c_acctbal < 0"),
    ("duplicate_name", "rn_name > 1"),
    ("segment_not_in_dimension_map",
     "c_mktsegment IS NOT NULL AND c_mktsegment NOT IN (" + ", ".join(f"'{k}'" for k in S.SEGMENT_SECTOR) + ")"),
    ("nation_not_in_dimension_map", "c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation)"),
]) + " AS reasons FROM cu_t)"


def part_rules(t: Tables) -> tuple[DataFrame, dict]:
    p = Q.add_duplicate_flag(Q.with_position(t.part, "__seq"), ["p_name"], ["p_partkey", "__seq"], "__dup_name")
    brand_no = F.expr("try_cast(substr(p_brand, 7) AS INT)")
    rules = {
        "duplicate_part_name": F.col("__dup_name"),
        "size_implausible_for_type": Q.bound_violation("p_size", "p_type", PART_TYPE_SIZE_BOUND, offset=5),
        "retailprice_out_of_range": Q.range_violation("p_retailprice", 900, 2000),
        "brand_number_exceeds_size": brand_no > F.col("p_size"),
    }
    return p, rules


PART_TAGGED_SQL = """
pa_t AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn_name,
                CASE p_type WHEN 'SMALL' THEN 20 WHEN 'MEDIUM' THEN 35 WHEN 'LARGE' THEN 50 END - 5 AS size_bound
         FROM part),
paq AS (
  SELECT pa_t.*, """ + reasons_sql([
    ("duplicate_part_name", "rn_name > 1"),
    ("size_implausible_for_type", "p_size IS NOT NULL AND size_bound IS NOT NULL AND p_size > size_bound"),
    ("retailprice_out_of_range", "p_retailprice IS NOT NULL AND NOT (p_retailprice BETWEEN 900 AND 2000)"),
    ("brand_number_exceeds_size", "TRY_CAST(substr(p_brand, 7) AS INTEGER) > p_size"),
]) + " AS reasons FROM pa_t)"


def document_rules(t: Tables) -> tuple[DataFrame, dict]:
    # rows are grouped by a digest of their content, so whole texts are not shuffled as keys
    content = F.sha2(F.to_json(F.struct("text", "lang", "source", "n_chars")), 256)
    d = Q.with_position(t.documents, "__seq").withColumn("__content", content)
    d = Q.add_duplicate_flag(d, ["__content"], ["doc_id", "__seq"], "__dup_row")
    d = Q.add_duplicate_flag(d, ["doc_id"], ["__seq"], "__dup_id")
    rules = {
        "duplicate_row": F.col("__dup_row"),
        "duplicate_doc_id": F.col("__dup_id"),
        "n_chars_out_of_range": Q.range_violation("n_chars", 1, 20000),
        "lang_not_in_vocabulary": F.col("lang").isNotNull() & ~F.col("lang").isin(*LANG_VOCAB),
    }
    return d, rules


DOC_TAGGED_SQL = """
do_t AS (SELECT *, row_number() OVER (PARTITION BY text, lang, source, n_chars ORDER BY doc_id) AS rn_row,
                row_number() OVER (PARTITION BY doc_id ORDER BY doc_id) AS rn_id FROM documents),
doq AS (
  SELECT do_t.*, """ + reasons_sql([
    ("duplicate_row", "rn_row > 1"),
    ("duplicate_doc_id", "rn_id > 1"),
    ("n_chars_out_of_range", "n_chars IS NOT NULL AND NOT (n_chars BETWEEN 1 AND 20000)"),
    ("lang_not_in_vocabulary", "lang IS NOT NULL AND lang NOT IN ('en', 'fr', 'de')"),
]) + " AS reasons FROM do_t)"

RULE_SETS = {
    "layoff_events": (layoff_rules, ["event_id"] + S.LAYOFF_CONTENT),
    "lineitem": (lineitem_rules, LINEITEM_COLS),
    "customer": (customer_rules, CUSTOMER_COLS),
    "part": (part_rules, PART_COLS),
    "documents": (document_rules, DOC_COLS),
}
TAGGED_SQL = {
    "layoff_events": ("evq", LAYOFF_TAGGED_SQL),
    "lineitem": ("liq", LINEITEM_TAGGED_SQL),
    "customer": ("cuq", CUSTOMER_TAGGED_SQL),
    "part": ("paq", PART_TAGGED_SQL),
    "documents": ("doq", DOC_TAGGED_SQL),
}


def split_dataset(t: Tables, name: str):
    fn, cols = RULE_SETS[name]
    df, rules = fn(t)
    return Q.split(df, rules, keep_cols=cols)


def tagged_dataset(t: Tables, name: str) -> DataFrame:
    fn, cols = RULE_SETS[name]
    df, rules = fn(t)
    return Q.tag(df, rules).select(*cols, Q.REASONS)


def _quarantine_sql(name: str) -> str:
    view, cte = TAGGED_SQL[name]
    cols = ", ".join(RULE_SETS[name][1])
    return f"WITH {cte.strip()}\nSELECT {cols}, reasons AS quarantine_reason FROM {view} WHERE reasons <> ''"


def _make_quarantine(name: str):
    def run(spark, sf_dir):
        return split_dataset(Tables(spark, sf_dir), name)[1]
    return run


# Q1 (+Q3-Q10 as the rules inside each set): quarantine half of the split, per dataset.
for _name in RULE_SETS:
    register(f"q1_quarantine_{_name}", _quarantine_sql(_name))(_make_quarantine(_name))


@register("q1_clean_layoff_events", "WITH " + TAGGED_SQL["layoff_events"][1].strip() + "\nSELECT "
          + ", ".join(RULE_SETS["layoff_events"][1]) + " FROM evq WHERE reasons = ''")
def q1_clean_layoff_events(spark, sf_dir):
    return split_dataset(Tables(spark, sf_dir), "layoff_events")[0]


@register("q7_duplicate_keys", """
WITH rows AS (SELECT c_custkey, c_acctbal, 0 AS arrival FROM customer
              UNION ALL SELECT c_custkey, c_acctbal + 1, 1 FROM customer WHERE c_acctbal < 0
              UNION ALL SELECT c_custkey, c_acctbal + 2, 2 FROM customer WHERE c_acctbal < -500)
SELECT c_custkey, arrival, round(c_acctbal, 2) AS c_acctbal,
       row_number() OVER (PARTITION BY c_custkey ORDER BY arrival) > 1 AS is_duplicate FROM rows""")
def q7_duplicate_keys(spark, sf_dir):
    """Q7 on keys that do repeat: customers in debt arrive again with a changed balance; the first arrival is kept."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_acctbal")
    again = [c.where(cond).select("c_custkey", (F.col("c_acctbal") + k).alias("c_acctbal"), F.lit(k).alias("arrival"))
             for k, cond in enumerate((F.lit(True), F.col("c_acctbal") < 0, F.col("c_acctbal") < -500))]
    rows = again[0].unionByName(again[1]).unionByName(again[2])
    return Q.add_duplicate_flag(rows, ["c_custkey"], ["arrival"], "is_duplicate").select(
        "c_custkey", "arrival", F.round("c_acctbal", 2).alias("c_acctbal"), "is_duplicate")


def _all_tagged_sql() -> str:
    return "WITH " + ",\n".join(cte.strip() for _, cte in TAGGED_SQL.values())


@register("q2_quarantine_summary", _all_tagged_sql() + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS dataset, rule, CAST(count(*) AS BIGINT) AS violations FROM "
    f"(SELECT unnest(string_split(reasons, ', ')) AS rule FROM {view} WHERE reasons <> '') GROUP BY rule"
    for name, (view, _) in TAGGED_SQL.items()))
def q2_quarantine_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = None
    for name in RULE_SETS:
        s = Q.summarize(split_dataset(t, name)[1]).select(F.lit(name).alias("dataset"), "rule", "violations")
        out = s if out is None else out.unionByName(s)
    return out


@register("q11_reconciliation", _all_tagged_sql() + ",\nper AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS dataset, count(*) AS raw_rows, count(*) FILTER (WHERE reasons = '') AS clean_rows, "
    f"count(*) FILTER (WHERE reasons <> '') AS quarantined_rows FROM {view}"
    for name, (view, _) in TAGGED_SQL.items()) + """),
rolled AS (
  SELECT dataset, raw_rows, clean_rows, quarantined_rows FROM per
  UNION ALL SELECT 'TOTAL', sum(raw_rows), sum(clean_rows), sum(quarantined_rows) FROM per)
SELECT dataset, CAST(raw_rows AS BIGINT) AS raw_rows, CAST(clean_rows AS BIGINT) AS clean_rows,
       CAST(quarantined_rows AS BIGINT) AS quarantined_rows,
       CAST(raw_rows - clean_rows - quarantined_rows AS BIGINT) AS unaccounted_rows,
       round(quarantined_rows * 100.0 / raw_rows, 2) AS quarantined_pct
FROM rolled""")
def q11_reconciliation(spark, sf_dir):
    """Q11: raw rows counted from the source independently of the split."""
    t = Tables(spark, sf_dir)
    raw, split_rows = None, None
    for name, (fn, cols) in RULE_SETS.items():
        src = {"layoff_events": lambda: S.layoff_events(t), "lineitem": lambda: t.lineitem,
               "customer": lambda: t.customer, "part": lambda: t.part, "documents": lambda: t.documents}[name]()
        r = src.agg(F.count(F.lit(1)).cast("long").alias("raw_rows")).select(F.lit(name).alias("dataset"), "raw_rows")
        s = tagged_dataset(t, name).select(F.lit(name).alias("dataset"), (F.size(Q.REASONS) > 0).alias("is_quarantined"))
        raw = r if raw is None else raw.unionByName(r)
        split_rows = s if split_rows is None else split_rows.unionByName(s)
    return Q.reconcile(raw, split_rows)


# ---------------------------------------------------------------- sources and profiling

@register("s3_contract_projection", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s3_contract_projection(spark, sf_dir):
    """S2+S3: validate the contract, then project to it in contract order (pruning reaches the scan)."""
    df = Tables(spark, sf_dir).customer
    return C.project_to_contract(df, C.CUSTOMER_CONTRACT)


@register("s4_source_summary", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
    f"CAST((SELECT count(*) FROM information_schema.columns WHERE table_name = '{n}') AS INTEGER) AS column_count FROM {n}"
    for n in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]))
def s4_source_summary(spark, sf_dir):
    from starlift.session import TABLES, read_table
    return P.source_summary({n: read_table(spark, sf_dir, n) for n in TABLES})


@register("s4_missing_report", "WITH " + S.LAYOFF_EVENTS_SQL.strip() + """
SELECT 'layoff_events' AS table_name, 'total_laid_off' AS "column",
       CAST(count(*) FILTER (WHERE total_laid_off IS NULL) AS BIGINT) AS missing_count,
       round(count(*) FILTER (WHERE total_laid_off IS NULL) * 100.0 / count(*), 1) AS missing_pct
FROM ev HAVING count(*) FILTER (WHERE total_laid_off IS NULL) > 0""")
def s4_missing_report(spark, sf_dir):
    return P.missing_report(S.layoff_events(Tables(spark, sf_dir)), "layoff_events")


def _profile_sql(table: str, cols: list[tuple[str, str, bool]]) -> str:
    parts = []
    for i, (c, dtype, numeric) in enumerate(cols):
        lo = f"CAST(min({c}) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        hi = f"CAST(max({c}) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", '{dtype}' AS dtype, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_count, "
            f"CASE WHEN count(*) = 0 THEN 0.0 ELSE round_even(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 1) END AS missing_pct, "
            f"CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count, {lo} AS \"min\", {hi} AS \"max\", {i} AS position FROM {table}")
    return "\nUNION ALL\n".join(parts)


@register("p1_data_dictionary_orders", _profile_sql("orders", [
    ("o_orderkey", "bigint", True), ("o_custkey", "bigint", True), ("o_orderstatus", "string", False),
    ("o_totalprice", "double", True), ("o_orderdate", "timestamp_ntz", False), ("o_orderpriority", "string", False)]))
def p1_data_dictionary_orders(spark, sf_dir):
    return P.data_dictionary(Tables(spark, sf_dir).orders)


@register("p1_data_dictionary_customer", _profile_sql("customer", [
    ("c_custkey", "bigint", True), ("c_name", "string", False), ("c_nationkey", "int", True),
    ("c_acctbal", "double", True), ("c_mktsegment", "string", False)]))
def p1_data_dictionary_customer(spark, sf_dir):
    return P.data_dictionary(Tables(spark, sf_dir).customer)


@register("p3_vocabulary_coverage", """
SELECT 'customer' AS dataset, c_mktsegment AS raw_value, CAST(count(*) AS BIGINT) AS row_count,
       c_mktsegment IN (""" + ", ".join(f"'{k}'" for k in S.SEGMENT_SECTOR) + """) AS mapped
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment""")
def p3_vocabulary_coverage(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return P.vocabulary_coverage({"customer": (t.customer, "c_mktsegment")}, list(S.SEGMENT_SECTOR)) \
        .select("dataset", "raw_value", "row_count", "mapped")


@register("p3_country_coverage", "WITH " + S.COUNTRY_MAP_SQL.strip() + """,
listed AS (
  SELECT 'customer' AS dataset, n_name AS raw_value FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'supplier', n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'documents', lang FROM documents)
SELECT dataset, raw_value, CAST(count(*) AS BIGINT) AS row_count, raw_value IN (SELECT raw FROM cmap) AS mapped
FROM listed WHERE raw_value IS NOT NULL GROUP BY dataset, raw_value""")
def p3_country_coverage(spark, sf_dir):
    """P3 over three datasets against one reference table; language codes stand in for spellings it doesn't know."""
    t = Tables(spark, sf_dir)
    names = t.nation.select("n_nationkey", F.col("n_name").alias("country"))
    customer = t.customer.join(names, F.col("c_nationkey") == F.col("n_nationkey"))
    supplier = t.supplier.join(names, F.col("s_nationkey") == F.col("n_nationkey"))
    return P.vocabulary_coverage({"customer": (customer, "country"), "supplier": (supplier, "country"),
                                  "documents": (t.documents, "lang")}, S.country_map(t), "raw") \
        .select("dataset", "raw_value", "row_count", "mapped")


@register("p4_functional_dependency", """
SELECT 'p_brand' AS determinant, 'p_type' AS dependent, CAST(count(*) AS BIGINT) AS groups,
       CAST(count(*) FILTER (WHERE k > 1) AS BIGINT) AS violating_groups
FROM (SELECT p_brand, count(DISTINCT p_type) AS k FROM part GROUP BY p_brand)
UNION ALL
SELECT 'o_custkey', 'o_orderpriority', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE k > 1) AS BIGINT)
FROM (SELECT o_custkey, count(DISTINCT o_orderpriority) AS k FROM orders GROUP BY o_custkey)
UNION ALL
SELECT 'n_nationkey', 'n_regionkey', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE k > 1) AS BIGINT)
FROM (SELECT n_nationkey, count(DISTINCT n_regionkey) AS k FROM nation GROUP BY n_nationkey)""")
def p4_functional_dependency(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (P.functional_dependency(t.part, ["p_brand"], "p_type")
            .unionByName(P.functional_dependency(t.orders, ["o_custkey"], "o_orderpriority"))
            .unionByName(P.functional_dependency(t.nation, ["n_nationkey"], "n_regionkey")))
