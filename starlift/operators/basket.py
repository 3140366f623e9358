"""Tag / basket mining (§2.6 B1-B5).

* B1 frequent itemsets: Spark ML's parallel FP-growth.
* B2 association rules with multi-item consequents (Spark's own rules only
  have single-item consequents): every frequent itemset is split into
  antecedent / consequent by bit masks inside the row, and both sides are
  looked up in the itemset table.
* B3 co-occurrence: the item x item Gram matrix ``Bᵀ B`` of the basket
  incidence matrix. Each partition multiplies its own baskets (numpy, dense
  blocks over the frequent-item index), holds at most HELD_BLOCKS blocks of
  partial counts and emits them when another is needed; one grouped aggregate
  adds the partials. No basket ever emits its own list of pairs, so a huge
  basket costs O(blocks) matrix work, not a quadratic stream of rows, and
  baskets are first reduced to their distinct frequent items (an aggregate,
  combined map-side).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.session import ensure_checkpoint_dir

ITEM_SEP = "|"
#: Blocks of partial counts that one task holds (block * block * 8 bytes each).
HELD_BLOCKS = 8


def baskets(df: DataFrame, basket_col: str, item_col: str) -> DataFrame:
    """(basket, items): distinct non-NULL items per basket, sorted."""
    return (df.where(F.col(item_col).isNotNull()).groupBy(basket_col)
            .agg(F.sort_array(F.collect_set(item_col)).alias("items")))


def frequent_itemsets(bk: DataFrame, min_support: float, items_col: str = "items") -> DataFrame:
    """B1: (items sorted array, freq) with freq >= ceil(min_support * baskets)."""
    model = FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=1.0).fit(bk)
    return model.freqItemsets.select(F.sort_array("items").alias("items"), F.col("freq").cast("long").alias("freq"))


def association_rules(itemsets: DataFrame, n_baskets: DataFrame, min_lift: float = 0.0,
                      min_confidence: float = 0.0) -> DataFrame:
    """B2: all rules A -> B with A ∪ B frequent, A and B non-empty and disjoint.

    support = freq(A∪B)/n, confidence = freq(A∪B)/freq(A), lift = confidence / (freq(B)/n).
    ``n_baskets`` is a one-row frame ``(n)``.

    Consequents grow level by level: two rules of one itemset whose consequents share all but the last item give the next
    level's. Confidence only falls as a consequent grows, so a rule below ``min_confidence`` is not grown; work follows
    the rules that are kept, and itemsets may have any number of items. Every level is checkpointed.
    """
    ensure_checkpoint_dir(itemsets.sparkSession)
    itemsets = itemsets.select("items", "freq").checkpoint(eager=True)
    most = itemsets.agg(F.max(F.size("items"))).first()[0] or 0
    sup = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("freq_a"))
    level = itemsets.where(F.size("items") >= 2).select("items", "freq", F.explode("items").alias("x")).select("items", "freq", F.array("x").alias("consequent"))
    found = None
    for size in range(1, max(2, most)):
        rules = level.withColumn("antecedent", F.array_except("items", "consequent")).join(sup, "antecedent")
        rules = rules.where(F.col("freq") / F.col("freq_a") >= min_confidence).checkpoint(eager=True)
        found = rules if found is None else found.unionByName(rules)
        if size + 1 >= most or rules.isEmpty():
            break
        half = rules.select("items", "freq", F.slice("consequent", 1, size - 1).alias("head"), F.element_at("consequent", -1).alias("last"))
        level = half.join(half.select("items", "head", F.col("last").alias("more")), ["items", "head"]).where("last < more").select(
            "items", "freq", F.concat("head", F.array("last", "more")).alias("consequent"))
    b = itemsets.select(F.col("items").alias("consequent"), F.col("freq").alias("freq_b"))
    j = found.join(b, "consequent").crossJoin(F.broadcast(n_baskets))
    out = j.select("antecedent", "consequent",
                   (F.col("freq") / F.col("n")).alias("support"),
                   (F.col("freq") / F.col("freq_a")).alias("confidence"),
                   ((F.col("freq") / F.col("freq_a")) / (F.col("freq_b") / F.col("n"))).alias("lift"))
    return out.where((F.col("lift") >= min_lift) & (F.col("confidence") >= min_confidence))


def _gram_fn(n_items: int, block: int, held: int = HELD_BLOCKS):
    def counts(key, c):
        bi, bj = key
        if bi == bj:
            c = np.triu(c, k=1)
        a, b = np.nonzero(c)
        return pd.DataFrame({"a": a + bi * block, "b": b + bj * block, "w": c[a, b]})

    def gram(batches):
        acc: dict[tuple[int, int], np.ndarray] = {}
        nb = (n_items + block - 1) // block
        for pdf in batches:
            lists = pdf["idx"].to_numpy()
            n = len(lists)
            if n == 0:
                continue
            lens = np.fromiter((len(x) for x in lists), dtype=np.int64, count=n)
            rows = np.repeat(np.arange(n), lens)
            cols = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists]) if lens.sum() else np.zeros(0, np.int64)
            for bi in range(nb):
                mi = (cols >= bi * block) & (cols < (bi + 1) * block)
                if not mi.any():
                    continue
                Bi = np.zeros((n, block), dtype=np.float32)
                Bi[rows[mi], cols[mi] - bi * block] = 1.0
                for bj in range(bi, nb):
                    mj = (cols >= bj * block) & (cols < (bj + 1) * block)
                    if not mj.any():
                        continue
                    if bj == bi:
                        Bj = Bi
                    else:
                        Bj = np.zeros((n, block), dtype=np.float32)
                        Bj[rows[mj], cols[mj] - bj * block] = 1.0
                    c = (Bi.T @ Bj).astype(np.int64)  # exact: counts per batch < 2**24
                    key = (bi, bj)
                    if key in acc:
                        acc[key] += c
                        continue
                    if len(acc) == held:
                        oldest = next(iter(acc))
                        yield counts(oldest, acc.pop(oldest))
                    acc[key] = c
        for key, c in acc.items():
            yield counts(key, c)
    return gram


def cooccurrence(df: DataFrame, basket_col: str, item_col: str, min_weight: int = 30, block: int = 2048) -> DataFrame:
    """(item_a, item_b, weight) for unordered pairs (a < b) found together in >= ``min_weight`` baskets.

    Items seen in fewer than ``min_weight`` baskets cannot reach the bound, so
    they are dropped before the Gram product (exact pruning, nothing capped).
    """
    pairs = df.where(F.col(item_col).isNotNull()).select(basket_col, item_col).distinct()
    freq = pairs.groupBy(item_col).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_weight)
    from starlift.operators.warehouse import assign_keys
    index = assign_keys(freq.select(item_col), [item_col], "__ix", start=0)
    n_items = index.count()
    if n_items < 2:
        return df.sparkSession.createDataFrame([], "item_a string, item_b string, weight long")
    per_basket = pairs.join(index, item_col).groupBy(basket_col).agg(F.collect_list(F.col("__ix").cast("long")).alias("idx"))
    partial = per_basket.select("idx").mapInPandas(_gram_fn(n_items, min(block, n_items)), "a long, b long, w long")
    edges = partial.groupBy("a", "b").agg(F.sum("w").alias("weight")).where(F.col("weight") >= min_weight)
    ia = index.select(F.col("__ix").alias("a"), F.col(item_col).alias("item_a"))
    ib = index.select(F.col("__ix").alias("b"), F.col(item_col).alias("item_b"))
    return edges.join(ia, "a").join(ib, "b").select("item_a", "item_b", F.col("weight").cast("long"))


def network_summary(edges: DataFrame) -> DataFrame:
    """Node and edge counts of the co-occurrence network."""
    nodes = edges.select(F.col("item_a").alias("n")).unionByName(edges.select(F.col("item_b").alias("n"))).distinct()
    return nodes.agg(F.count(F.lit(1)).alias("nodes")).crossJoin(edges.agg(F.count(F.lit(1)).alias("edges")))


def synonym_evidence(df: DataFrame, basket_col: str, item_col: str, attr_col: str,
                     candidates: Sequence[tuple[str, str]]) -> DataFrame:
    """Per candidate pair: baskets holding both tags, distinct attribute values per tag,
    and whether each tag is exclusive to one attribute value.

    Only rows of candidate tags are touched; the candidate list is a small parameter.
    """
    spark = df.sparkSession
    cand = spark.createDataFrame([(a, b) for a, b in candidates], "tag_a string, tag_b string")
    side = cand.select(F.col("tag_a").alias("tag"), "tag_a", "tag_b").unionByName(
        cand.select(F.col("tag_b").alias("tag"), "tag_a", "tag_b"))
    rows = df.select(basket_col, F.col(item_col).alias("tag"), attr_col).where(F.col("tag").isNotNull())
    hit = rows.join(F.broadcast(side), "tag")   # candidate list: bounded by the parameter
    both = hit.groupBy("tag_a", "tag_b", basket_col).agg(F.count_distinct("tag").alias("__k")) \
        .groupBy("tag_a", "tag_b").agg(F.count_if(F.col("__k") == 2).alias("baskets_with_both"))
    titles = rows.join(F.broadcast(side.select("tag").distinct()), "tag").groupBy("tag") \
        .agg(F.count_distinct(attr_col).alias("__t"))
    ta = titles.select(F.col("tag").alias("tag_a"), F.col("__t").alias("values_a"))
    tb = titles.select(F.col("tag").alias("tag_b"), F.col("__t").alias("values_b"))
    out = cand.join(both, ["tag_a", "tag_b"], "left").join(ta, "tag_a", "left").join(tb, "tag_b", "left")
    return out.select("tag_a", "tag_b", F.coalesce("baskets_with_both", F.lit(0)).cast("long").alias("baskets_with_both"),
                      F.coalesce("values_a", F.lit(0)).cast("long").alias("values_a"),
                      F.coalesce("values_b", F.lit(0)).cast("long").alias("values_b"),
                      (F.col("values_a") == 1).alias("a_exclusive"), (F.col("values_b") == 1).alias("b_exclusive"))


def base_rate(df: DataFrame, basket_col: str, item_col: str) -> DataFrame:
    """Baskets per tag and share of all baskets."""
    total = df.agg(F.count_distinct(basket_col).alias("__n"))
    per = df.where(F.col(item_col).isNotNull()).groupBy(item_col).agg(F.count_distinct(basket_col).alias("baskets"))
    return per.crossJoin(F.broadcast(total)).select(item_col, "baskets", (F.col("baskets") / F.col("__n")).alias("share"))
