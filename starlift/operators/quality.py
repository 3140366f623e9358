"""Data-quality rules (§2.2 Q1-Q11).

A rule is a named boolean ``Column`` (True = the row fails). A NULL mask
counts as "not violated" (three-valued logic, §7.3 X7). ``tag`` evaluates all
rules in one projection, so whole-stage codegen fuses them.

Group-based rules (duplicates, conflicting keys) are computed as a grouped
aggregate joined back to the rows instead of a window over the group: the
aggregate is combined map-side, and the join back is split by AQE's skew
join when one key holds a large share of all rows. A window over such a key
would sort and buffer the whole group in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "_reasons"
REASON_COL = "quarantine_reason"
REASON_SEP = ", "


# ---------------------------------------------------------------- helpers

def with_position(df: DataFrame, name: str) -> DataFrame:
    """A parquet scan with the place of each row (file, row in file): unique, and the same in every evaluation."""
    return df.withColumn(name, F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")))


def _null_safe_join(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join ``stats`` (one row per key) back to ``df`` with NULL = NULL key matching."""
    renamed = stats.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                           *[c for c in stats.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    out = df.join(renamed, on=cond, how="left")
    return out.drop(*[f"__k{i}" for i in range(len(keys))])


def digest(cols: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes with seeds of their own, equal for rows that a grouping by ``cols`` takes as equal (NULLs equal, 0.0 = -0.0).

    Hashes pass over NULLs, so the places of the NULLs are hashed first."""
    nulls = [sum((F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(cols[k:k + 30])), F.lit(0)) for k in range(0, len(cols), 30)]
    return tuple(F.xxhash64(F.lit(seed), *nulls, *cols) for seed in (1, 2))


def with_group_stats(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Add per-group aggregates to each row (null-safe group keys).

    Equivalent to ``agg.over(Window.partitionBy(keys))`` but skew-safe:
    partial aggregation before the shuffle, AQE skew join after it.
    """
    stats = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return _null_safe_join(df, stats, keys)


def add_duplicate_flag(df: DataFrame, cols: Sequence[str], order_cols: Sequence[str], flag: str) -> DataFrame:
    """Q6/Q7 keep-first: ``flag`` is True for every row of a group of equal ``cols``
    (NULLs equal) except the first one by ``order_cols``, which must tell the rows of a group apart
    (end them with ``with_position`` where they may tie): rows equal in both all stay first."""
    if not order_cols:
        raise ValueError("keep-first needs an order column (file order or an explicit one, §7.3 X5)")
    order = F.struct(*[F.col(c) for c in order_cols])
    out = with_group_stats(df.withColumn("__ord", order), cols, {"__first": F.min("__ord")})
    return out.withColumn(flag, F.col("__ord") != F.col("__first")).drop("__ord", "__first")


def add_conflicting_key_flag(df: DataFrame, key: Sequence[str], all_cols: Sequence[str],
                             latest_col: str, flag: str) -> DataFrame:
    """Q8: same key, not an exact duplicate, and ``latest_col`` is not the group maximum.

    Edge cases as in §7.3 X4: NULL keys match each other for the duplicate
    test, but the group maximum is only defined when every key column is set,
    so conflicting rows with a NULL key part are always flagged; a NULL
    ``latest_col`` is flagged; ties on the maximum are all kept.
    """
    key_set_ok = F.lit(True)
    for k in key:
        key_set_ok = key_set_ok & F.col(k).isNotNull()
    out = with_group_stats(df, key, {"__n_key": F.count(F.lit(1)), "__latest": F.max(latest_col)})
    out = with_group_stats(out, all_cols, {"__n_full": F.count(F.lit(1))})
    conflicting = (F.col("__n_key") > 1) & (F.col("__n_full") == 1)
    latest = F.when(key_set_ok, F.col("__latest"))
    bad = conflicting & ~F.coalesce(F.col(latest_col) == latest, F.lit(False))
    return out.withColumn(flag, bad).drop("__n_key", "__latest", "__n_full")


def add_row_and_key_flags(df: DataFrame, content_cols: Sequence[str], key: Sequence[str], order_col: str,
                          latest_col: str, dup_flag: str, conflict_flag: str) -> DataFrame:
    """Q6 + Q8 together; the whole rows are shuffled once.

    Rows with equal content always share a key, and only rows whose key comes more than once can be flagged:

    1. keys with more than one row                                        (128-bit digests, combined map-side)
    2. (key, content, order, latest) of the rows with such a key          (digests)
    3. per content group: rows, first ``order_col``, max ``latest_col``   (combined map-side)
    4. per key, from 3: rows, max ``latest_col``; joined with 3           (small)
    5. rows ⋈ 4 on key and content                                        (raw rows, AQE skew join)

    ``dup_flag``: not the first row of its exact-duplicate group (keep first).
    ``conflict_flag``: Q8 as in ``add_conflicting_key_flag``.
    """
    of_key, of_row = digest(key), digest(content_cols)
    narrow = df.select(*[c.alias(f"__k{i}") for i, c in enumerate(of_key)], *[c.alias(f"__c{i}") for i, c in enumerate(of_row)],
                       F.col(order_col).alias("__o"), F.col(latest_col).alias("__l"))
    again = df.select(*[c.alias(f"__r{i}") for i, c in enumerate(of_key)]).groupBy("__r0", "__r1").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    narrow = narrow.join(again, (F.col("__k0") == F.col("__r0")) & (F.col("__k1") == F.col("__r1")), "left_semi")
    g1 = narrow.groupBy("__k0", "__k1", "__c0", "__c1").agg(F.count(F.lit(1)).alias("__n_full"), F.min("__o").alias("__first"), F.max("__l").alias("__mx"))
    # the struct keeps the columns of both uses of g1 alike, so that Spark makes it once
    g2 = g1.groupBy(F.col("__k0").alias("__g0"), F.col("__k1").alias("__g1")).agg(F.sum("__n_full").alias("__n_key"), F.max(F.struct("__mx", "__first"))["__mx"].alias("__latest"))
    g3 = g1.join(g2, (F.col("__k0") == F.col("__g0")) & (F.col("__k1") == F.col("__g1"))).select("__c0", "__c1", "__n_full", "__first", "__n_key", "__latest")
    out = df.join(g3, (of_row[0] == F.col("__c0")) & (of_row[1] == F.col("__c1")), "left")
    key_set_ok = F.lit(True)
    for k in key:
        key_set_ok = key_set_ok & F.col(k).isNotNull()
    conflicting = (F.coalesce("__n_key", F.lit(1)) > 1) & (F.col("__n_full") == 1)
    bad = conflicting & ~F.coalesce(F.col(latest_col) == F.when(key_set_ok, F.col("__latest")), F.lit(False))
    return (out.withColumn(dup_flag, F.coalesce(F.col(order_col) != F.col("__first"), F.lit(False)))
            .withColumn(conflict_flag, bad)
            .drop("__c0", "__c1", "__n_full", "__first", "__n_key", "__latest"))


def add_vocab_flag(df: DataFrame, col: str, vocab: DataFrame | Iterable[str], flag: str,
                   vocab_col: str | None = None) -> DataFrame:
    """Q9: ``flag`` = value set and not in the vocabulary.

    A fixed vocabulary becomes an ``In`` set (no join). A vocabulary held in a
    DataFrame is semi-joined; Spark broadcasts it only when its measured size
    is under the broadcast threshold (AQE), otherwise it shuffles.
    """
    if not isinstance(vocab, DataFrame):
        return df.withColumn(flag, F.col(col).isNotNull() & ~F.col(col).isin(list(vocab)))
    vc = vocab_col or vocab.columns[0]
    known = vocab.select(F.col(vc).alias("__v")).where(F.col("__v").isNotNull()).distinct() \
        .withColumn("__hit", F.lit(True))
    out = df.join(known, F.col(col) == F.col("__v"), "left")
    return out.withColumn(flag, F.col(col).isNotNull() & F.col("__hit").isNull()).drop("__v", "__hit")


def range_violation(col: str, lo: float, hi: float) -> Column:
    """Q3: value set and outside [lo, hi] (inclusive bounds)."""
    return F.col(col).isNotNull() & ~F.col(col).between(lo, hi)


def bound_violation(value_col: str, label_col: str, upper_bounds: Mapping[str, float], offset: float = 0.0) -> Column:
    """Q10: label -> upper bound - offset; the value must not exceed it.

    Unknown labels and NULLs never fail."""
    m = F.create_map(*[F.lit(x) for kv in upper_bounds.items() for x in kv])
    bound = m[F.col(label_col)] - F.lit(offset)
    return F.col(value_col).isNotNull() & bound.isNotNull() & (F.col(value_col) > bound)


# ---------------------------------------------------------------- split (Q1)

def tag(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``_reasons``: names of all failed rules in declaration order."""
    failed = [F.when(F.coalesce(mask, F.lit(False)), F.lit(name)) for name, mask in rules.items()]
    reasons = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return df.withColumn(REASONS, reasons)


def split(df: DataFrame, rules: Mapping[str, Column], keep_cols: Sequence[str] | None = None
          ) -> tuple[DataFrame, DataFrame]:
    """Q1: (clean, quarantine). The quarantine keeps every input column plus
    ``quarantine_reason`` (failed rule names joined by ", ").

    Callers that use both halves should persist/checkpoint ``tag(df, rules)`` once.
    """
    cols = list(keep_cols) if keep_cols is not None else [c for c in df.columns if not c.startswith("__")]
    tagged = tag(df, rules)
    clean = tagged.where(F.size(REASONS) == 0).select(*cols)
    quarantine = tagged.where(F.size(REASONS) > 0).select(
        *cols, F.array_join(F.col(REASONS), REASON_SEP).alias(REASON_COL))
    return clean, quarantine


def summarize(quarantine: DataFrame, reason_col: str = REASON_COL) -> DataFrame:
    """Q2: rows per rule; a row failing two rules counts under both."""
    return (quarantine
            .select(F.explode(F.split(F.col(reason_col), REASON_SEP)).alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).alias("violations")))


def reconcile(raw_counts: DataFrame, split_counts: DataFrame) -> DataFrame:
    """Q11: raw = clean + quarantined per dataset, with a TOTAL row (rollup).

    ``raw_counts``: (dataset, raw_rows); ``split_counts``: (dataset, is_quarantined bool) per row.
    """
    per = split_counts.groupBy("dataset").agg(
        F.sum(F.when(~F.col("is_quarantined"), 1).otherwise(0)).cast("long").alias("clean_rows"),
        F.sum(F.when(F.col("is_quarantined"), 1).otherwise(0)).cast("long").alias("quarantined_rows"))
    joined = raw_counts.join(per, "dataset", "full_outer").na.fill(0, ["raw_rows", "clean_rows", "quarantined_rows"])
    rolled = joined.rollup("dataset").agg(
        F.sum("raw_rows").cast("long").alias("raw_rows"),
        F.sum("clean_rows").cast("long").alias("clean_rows"),
        F.sum("quarantined_rows").cast("long").alias("quarantined_rows"))
    return rolled.select(
        F.coalesce(F.col("dataset"), F.lit("TOTAL")).alias("dataset"),
        "raw_rows", "clean_rows", "quarantined_rows",
        (F.col("raw_rows") - F.col("clean_rows") - F.col("quarantined_rows")).alias("unaccounted_rows"),
        F.round(F.col("quarantined_rows") * 100.0 / F.nullif(F.col("raw_rows"), F.lit(0)), 2).alias("quarantined_pct"))
