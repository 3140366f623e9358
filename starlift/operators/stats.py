"""Statistical building blocks for the analytic tiles.

Medians and quantiles are exact and interpolate like pandas and
``quantile_cont``. They are found by rank in a range-sorted table of value
counts, so a group of any size is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.session import ensure_checkpoint_dir

_IDX_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index in partition


def quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: Mapping[str, float]) -> DataFrame:
    """``keys`` and one double column per entry of ``probs``: exact, linearly interpolated quantiles of non-NULL values.

    1. values are counted per group (combined map-side);
    2. the counts are range-sorted by group and value and checkpointed, so a hot group spans partitions;
    3. partition sums per group (partitions + groups rows) give the rank at which each partition starts;
    4. the values at the two ranks next to each quantile are picked by a plain aggregate.

    A group without values has no row; without keys and values there is one row of NULLs.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = list(keys)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = (df.select(*keys, F.col(col).cast("double").alias("__v")).where(F.col("__v").isNotNull())
               .groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n")))
    ranked = (counted.repartitionByRange(n, *keys, "__v").sortWithinPartitions(*keys, "__v")
              .withColumn("__at", F.monotonically_increasing_id()).checkpoint(eager=True)
              .withColumn("__p", F.shiftrightunsigned("__at", _IDX_BITS)))
    earlier = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranked.groupBy(*keys, "__p").agg(F.sum("__n").alias("__s"))
              .withColumn("__zero", F.coalesce(F.sum("__s").over(earlier), F.lit(0)))
              .withColumn("__total", F.sum("__s").over(Window.partitionBy(*keys))).drop("__s"))
    so_far = Window.partitionBy(*keys, "__p").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    ranked = null_safe_join(ranked.withColumn("__to", F.sum("__n").over(so_far)), starts, [*keys, "__p"], "inner")
    end = F.col("__zero") + F.col("__to")

    def at(rank: Column) -> Column:
        return F.max(F.when((end - F.col("__n") <= rank) & (rank < end), F.col("__v")))

    place = {name: (F.col("__total") - 1) * F.lit(float(q)) for name, q in probs.items()}
    g = ranked.groupBy(*keys).agg(*[x for name, pos in place.items() for x in (
        at(F.floor(pos)).alias(f"__lo_{name}"), at(F.ceil(pos)).alias(f"__hi_{name}"),
        F.max(pos - F.floor(pos)).alias(f"__part_{name}"))])
    return g.select(*keys, *[F.when(F.col(f"__lo_{name}") == F.col(f"__hi_{name}"), F.col(f"__lo_{name}")).otherwise(
        (1.0 - F.col(f"__part_{name}")) * F.col(f"__lo_{name}") + F.col(f"__part_{name}") * F.col(f"__hi_{name}")).alias(name)
        for name in probs])


def with_quantiles(grouped: DataFrame, df: DataFrame, keys: Sequence[str], col: str, probs: Mapping[str, float]) -> DataFrame:
    """``grouped`` (one row per group of ``df``) with the quantiles of ``col`` in each group; NULL where it has no values."""
    return null_safe_join(grouped, quantiles(df, keys, col, probs), keys, "left")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; each key appears once."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def share_of_total(col: str, partition: Sequence[str] = ()) -> Column:
    """A5: value / sum(value) over the partition (the input is already aggregated, so the window is small)."""
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return F.col(col) / F.sum(col).over(w)


def clear_flag(lo: Column, hi: Column, reference: Column) -> Column:
    """A28: 'higher' / 'lower' when the interval excludes the reference value, else 'not clear'."""
    return (F.when(lo > reference, F.lit("higher"))
            .when(hi < reference, F.lit("lower"))
            .otherwise(F.lit("not clear")))


def with_shades(df: DataFrame, cols: Sequence[str], prefix: str = "shade_") -> DataFrame:
    """Per column, where a value lies between the smallest (0) and the largest (1) one; NULL stays NULL, equal
    values are all the largest. The rows are aggregated already (one per group); the extremes are one row."""
    ends = df.agg(*[f(c).alias(f"__{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    out = df.crossJoin(F.broadcast(ends))
    for c in cols:
        lo, hi = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        span = F.nullif((hi - lo).cast("double"), F.lit(0.0))
        out = out.withColumn(f"{prefix}{c}", F.when(F.col(c).isNotNull(), F.coalesce((F.col(c) - lo) / span, F.lit(1.0))))
    return out.drop(*ends.columns)


def with_wilson(df: DataFrame, successes: str, n: str, prefix: str = "", z: float = SF.Z95) -> DataFrame:
    lo, hi = SF.wilson_interval(successes, n, z)
    return df.withColumn(f"{prefix}ci_low", lo).withColumn(f"{prefix}ci_high", hi)


def average_rank(col: str) -> Column:
    """Rank with ties given their average position (1-based), as Spearman needs.

    Used on aggregated rows (one per group), so the global window is small.
    """
    w = Window.orderBy(F.col(col))
    ties = Window.partitionBy(F.col(col))
    return F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman rank correlation = Pearson correlation of average ranks; one row (n, rho)."""
    ranked = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()) \
        .select(average_rank(x).alias("__rx"), average_rank(y).alias("__ry"))
    return ranked.agg(F.count(F.lit(1)).alias("n"), F.corr("__rx", "__ry").alias("rho"))
