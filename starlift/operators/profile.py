"""Profiling (§2.4 P1-P4, §2.1 S4).

All column statistics come from one scan, combined in each task before
anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DoubleType, FloatType, MapType, NumericType, StringType, StructType

PROFILE_COLUMNS = ["column", "dtype", "missing_count", "missing_pct", "unique_count", "min", "max", "position"]


def _is_numeric(dt) -> bool:
    return isinstance(dt, NumericType)


def _value_key(col: Column, dt: DataType) -> Column:
    """A short binary key that two values of a column share exactly when they are equal; NULL for NULL.

    Texts go by their SHA-256, so no long value is shuffled; nested values by the SHA-256 of their JSON form.
    """
    if isinstance(dt, (FloatType, DoubleType)):
        col = col + F.lit(0.0).cast(dt)   # -0.0 equals 0.0
    if isinstance(dt, (ArrayType, StructType, MapType)):
        col = F.when(col.isNotNull(), F.to_json(F.struct(col.alias("v"))))
    if isinstance(dt, (ArrayType, StructType, MapType, StringType, BinaryType)):
        return F.unhex(F.sha2(col.cast("binary"), 256))
    return col.cast("string").cast("binary")


def data_dictionary(df: DataFrame, approx_distinct: bool = False, rsd: float = 0.02) -> DataFrame:
    """Per column dtype, missing count and % (1 dp, 0.0 on an empty table),
    non-NULL distinct count, min/max for numeric columns only; original column order.

    One scan turns every row into narrow (column, value key, number) entries. They are counted per value, combined
    in each task before the shuffle, and the values are then counted per column; the wide rows never leave the scan.
    ``approx_distinct`` swaps the exact distinct count for HyperLogLog++, which needs one aggregate and no entries.
    """
    fields = df.schema.fields
    names = df.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
                                            "position int, column string, dtype string")   # one row per column
    number = [F.col(f"`{f.name}`").cast("double") if _is_numeric(f.dataType) else F.lit(None).cast("double") for f in fields]
    if approx_distinct:
        stats = df.agg(F.array(*[F.struct(
            F.lit(i).alias("position"), F.count(F.lit(1)).alias("n"), F.count_if(F.col(f"`{f.name}`").isNull()).alias("missing_count"),
            F.approx_count_distinct(f"`{f.name}`", rsd).alias("unique_count"), F.min(x).alias("min"), F.max(x).alias("max"))
            for i, (f, x) in enumerate(zip(fields, number))]).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    else:
        entries = df.select(F.explode(F.array(*[F.struct(
            F.lit(i).alias("position"), _value_key(F.col(f"`{f.name}`"), f.dataType).alias("key"), x.alias("number"))
            for i, (f, x) in enumerate(zip(fields, number))])).alias("e")).select("e.*")
        values = entries.groupBy("position", "key").agg(F.count(F.lit(1)).alias("rows"), F.min("number").alias("number"))
        stats = values.groupBy("position").agg(
            F.sum("rows").alias("n"), F.sum(F.when(F.col("key").isNull(), F.col("rows"))).alias("missing_count"),
            F.count("key").alias("unique_count"), F.min("number").alias("min"), F.max("number").alias("max"))
    pct = F.when(F.col("n") > 0, F.bround(F.col("missing_count") * 100.0 / F.col("n"), 1))  # half-even like Python round (X6)
    filled = names.join(stats, "position", "left").withColumn("missing_count", F.coalesce("missing_count", F.lit(0).cast("long")))
    return filled.select("column", "dtype", "missing_count", F.coalesce(pct, F.lit(0.0)).alias("missing_pct"),
                         F.coalesce("unique_count", F.lit(0).cast("long")).alias("unique_count"), "min", "max", "position")


def missing_report(df: DataFrame, table: str) -> DataFrame:
    """Columns with any missing value, % missing at 1 dp, largest share first, then by name. One scan, null counts only."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").cast("long").alias("missing_count")) for i, c in enumerate(df.columns)])
    out = counts.select("n", F.explode(rows).alias("r")).select("n", "r.*").where("missing_count > 0")
    pct = F.bround(F.col("missing_count") * 100.0 / F.col("n"), 1)  # half-even, as in the dictionary
    return out.select(F.lit(table).alias("table_name"), "column", "missing_count", pct.alias("missing_pct")).orderBy(F.desc("missing_pct"), "column")


def source_summary(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per source (one count job per source, parquet answers from metadata)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"))
        for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def vocabulary_coverage(values: Mapping[str, tuple[DataFrame, str]], vocabulary: DataFrame | Sequence[str],
                        vocab_col: str | None = None) -> DataFrame:
    """Per dataset and raw value: rows, and whether the vocabulary knows it.

    ``values`` maps dataset name -> (frame, column).
    """
    if not isinstance(vocabulary, DataFrame):
        known = list(vocabulary)
        flag = lambda c: F.col(c).isin(known)
    else:
        flag = None
    parts = []
    for name, (df, col) in values.items():
        g = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("raw_value")) \
            .agg(F.count(F.lit(1)).alias("row_count")).withColumn("dataset", F.lit(name))
        parts.append(g)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if flag is not None:
        return out.withColumn("mapped", flag("raw_value"))
    vc = vocab_col or vocabulary.columns[0]
    v = vocabulary.select(F.col(vc).alias("__v")).distinct().withColumn("__hit", F.lit(True))
    return out.join(v, F.col("raw_value") == F.col("__v"), "left") \
        .withColumn("mapped", F.coalesce(F.col("__hit"), F.lit(False))).drop("__v", "__hit")


def functional_dependency(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """Is ``dependent`` constant per ``determinant``? groups, violating groups."""
    per = df.groupBy(*determinant).agg(F.count_distinct(dependent).alias("__k"))
    return per.agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(F.col("__k") > 1).alias("violating_groups")).select(
        F.lit(",".join(determinant)).alias("determinant"), F.lit(dependent).alias("dependent"),
        "groups", "violating_groups")
