"""Warehouse build (§2.7 W1-W21).

Dimensions and facts are DataFrames; the warehouse on disk is a folder of
parquet tables published atomically through versioned manifests (W18).

Surrogate keys (W7) follow natural-key order so they are reproducible and
checkable; they are dense integers assigned with per-partition offsets (the
``zipWithIndex`` idea) after a range-partitioned sort, never with a global
one-partition window over a fact.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from starlift import functions as SF
from starlift.operators import tablelog
from starlift.operators.tablelog import Entry, VersionConflict, compact, current_version, read_if_written  # noqa: F401
from starlift.session import ensure_checkpoint_dir

_IDX_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index in partition


# ---------------------------------------------------------------- W1 calendar

def calendar(spark: SparkSession, start: str | _dt.date, end: str | _dt.date) -> DataFrame:
    """One row per day in [start, end] with the YYYYMMDD smart key."""
    span = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                                                      F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return _calendar_columns(span)


def calendar_covering(df: DataFrame, date_col: str) -> DataFrame:
    """W1 for data of any span: whole years from the first to the last date of ``date_col``."""
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"), F.max(F.col(date_col).cast("date")).alias("hi"))
    days = bounds.select(F.explode(F.sequence(F.trunc("lo", "year"),
                                              F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1),
                                              F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return _calendar_columns(days)


def _calendar_columns(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return days.select(
        SF.date_key(d).alias("date_key"), d.alias("full_date"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).alias("day"))


# ---------------------------------------------------------------- W7 surrogate keys

def assign_keys(df: DataFrame, order_cols: Sequence[str], key_col: str, start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """Dense keys ``start, start+1, ...`` in ``order_cols`` order (which must be unique).

    1. range-partition and sort on the natural key;
    2. checkpoint (reliable, shared folder) so both passes below see the same
       partition layout even if an executor is lost and work is recomputed;
    3. count rows per partition (one small row per partition) and turn the
       counts into offsets; the offsets table is broadcast — its size is the
       number of partitions, a proven bound;
    4. key = start + partition offset + row index inside the partition.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("__id", F.monotonically_increasing_id())
              .persist(StorageLevel.MEMORY_AND_DISK))   # reliable checkpoint would otherwise compute it twice
    ordered = staged.checkpoint(eager=True)
    staged.unpersist()
    counts = ordered.groupBy(F.shiftrightunsigned("__id", _IDX_BITS).alias("__p")).agg(F.count(F.lit(1)).alias("__c"))
    offsets = counts.withColumn(
        "__off", F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)))
    joined = ordered.join(F.broadcast(offsets.select("__p", "__off")),
                          F.shiftrightunsigned(F.col("__id"), _IDX_BITS) == F.col("__p"))
    idx = F.col("__id").bitwiseAND(F.lit((1 << _IDX_BITS) - 1))
    key = (F.lit(start) + F.col("__off") + idx).cast("long")
    return joined.select(key.alias(key_col), *[F.col(c) for c in df.columns])


# ---------------------------------------------------------------- W2-W6 dimensions

def union_distinct(frames: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values of ``cols`` over several datasets."""
    out = None
    for df in frames:
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out.dropna(subset=list(cols)).distinct()


def first_per_group(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Attributes of the first row (by ``order_cols``) of each key group.

    ``min(struct(order, attrs))`` is an aggregate (combined map-side), so a hot
    key never lands in one task as it would with ``row_number() == 1``.
    """
    packed = F.min(F.struct(*[F.col(c) for c in order_cols], *[F.col(a).alias(f"__a_{a}") for a in attrs]))
    g = df.groupBy(*keys).agg(packed.alias("__m"))
    return g.select(*keys, *[F.col(f"__m.__a_{a}").alias(a) for a in attrs])


def junk_dimension(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations, rows with any NULL dropped."""
    return df.select(*cols).dropna().distinct()


def insert_if_absent(existing: DataFrame | None, batch: DataFrame, natural_key: Sequence[str], key_col: str,
                     order_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``batch`` whose natural key is not yet in ``existing``, with new keys.

    In-batch duplicates: the first by ``order_cols`` wins (else the natural key
    order decides, which is deterministic). Keys continue after ``max(existing)``.
    A repeat run with the same batch returns no rows.
    """
    order_cols = list(order_cols or natural_key)
    ranked = first_per_group(batch, natural_key, order_cols,
                             [c for c in batch.columns if c not in natural_key])
    fresh = ranked if existing is None else ranked.join(existing.select(*natural_key), list(natural_key), "left_anti")
    keyed = assign_keys(fresh, list(natural_key), key_col)
    if existing is None:
        return keyed
    base = existing.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("__base"))  # one row
    return keyed.crossJoin(F.broadcast(base)).withColumn(key_col, F.col(key_col) + F.col("__base")).drop("__base") \
        .select(key_col, *[c for c in keyed.columns if c != key_col])


# ---------------------------------------------------------------- W10 lookups

def lookup(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], key_col: str, out: str | None = None) -> DataFrame:
    """Natural key -> surrogate key; no match -> NULL. ``on`` maps fact column -> dim column.

    No broadcast hint: AQE broadcasts the dimension when its measured size is
    below the threshold, and keeps a shuffle join when a dimension is large.
    """
    out = out or key_col
    d = dim.select(F.col(key_col).alias(out), *[F.col(v).alias(f"__d_{v}") for v in on.values()])
    cond = [F.col(k) == F.col(f"__d_{v}") for k, v in on.items()]
    return fact.join(d, cond, "left").drop(*[f"__d_{v}" for v in on.values()])


# ---------------------------------------------------------------- W9 constraints

@dataclass
class Constraints:
    """Declarative constraints of one table."""

    table: str
    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)  # name -> condition that must not be FALSE
    foreign_keys: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)  # col -> (parent, parent col)


def check_constraints(df: DataFrame, c: Constraints, existing: DataFrame | None = None) -> DataFrame:
    """(table_name, constraint_name, violations) for every constraint of ``c``.

    Row-level checks share one aggregate; each UNIQUE is one grouped count;
    each FK is one left-anti join (the parent side is a dimension).
    ``existing`` are rows checked earlier to which ``df`` is added: a UNIQUE
    counts those that share a key with ``df`` too.
    """
    spark = df.sparkSession
    row_aggs, names = [], []
    for col in c.not_null:
        names.append(f"not_null({col})")
        row_aggs.append(F.count_if(F.col(col).isNull()))
    for name, cond in c.checks.items():
        names.append(f"check({name})")
        row_aggs.append(F.count_if(F.coalesce(~cond, F.lit(False))))
    parts = []
    if row_aggs:
        one = df.agg(*[a.alias(f"__c{i}") for i, a in enumerate(row_aggs)])
        stacked = one.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("constraint_name"), F.col(f"__c{i}").cast("long").alias("violations"))
            for i, n in enumerate(names)])).alias("s")).select("s.*")
        parts.append(stacked)
    for cols in c.unique:
        nn = F.lit(True)
        for col in cols:
            nn = nn & F.col(col).isNotNull()
        keys = df.where(nn).select(*cols)
        if existing is not None:
            keys = keys.unionByName(existing.select(*cols).join(keys, list(cols), "left_semi"))
        dup = keys.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1") \
            .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("violations"))
        parts.append(dup.select(F.lit(f"unique({','.join(cols)})").alias("constraint_name"), "violations"))
    for col, (parent, pcol) in c.foreign_keys.items():
        orphans = df.where(F.col(col).isNotNull()).join(
            parent.select(F.col(pcol).alias(col)), col, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).cast("long").alias("violations"))
                     .select(F.lit(f"fk({col})").alias("constraint_name"), "violations"))
    if not parts:
        return spark.createDataFrame([], "table_name string, constraint_name string, violations long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(c.table).alias("table_name"), "constraint_name", "violations")


def assert_constraints(report: DataFrame) -> None:
    """Raise if any constraint is violated (the report is one row per constraint: bounded)."""
    bad = [r for r in report.where("violations > 0").collect()]
    if bad:
        raise ValueError("constraint violations: " + "; ".join(
            f"{r.table_name}.{r.constraint_name}={r.violations}" for r in bad))


# ---------------------------------------------------------------- W16 mart

def country_month_mart(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame,
                       date_key: str = "date_key", country_key: str = "country_key",
                       headcount: str = "total_laid_off", share: str = "percentage_laid_off") -> DataFrame:
    """Inner join calendar, LEFT join country (missing -> '(Unknown)'),
    count(*), sum(headcount), avg(share) per (country, year, month).

    Adaptive execution broadcasts the calendar and the country dimension by
    their measured sizes; the aggregate is partial per partition.
    """
    f = fact.select(F.col(date_key).alias("__fdk"), F.col(country_key).alias("__fck"), headcount, share)
    j = (f.join(dim_date.select(F.col("date_key").alias("__dk"), "year", "month"),
                F.col("__fdk") == F.col("__dk"))
         .join(dim_country.select(F.col("country_key").alias("__ck"), "country_canonical"),
               F.col("__fck") == F.col("__ck"), "left"))
    return j.groupBy(F.coalesce(F.col("country_canonical"), F.lit("(Unknown)")).alias("country_canonical"),
                     "year", "month").agg(
        F.count(F.lit(1)).alias("layoff_events"),
        F.sum(headcount).alias("total_laid_off"),
        F.avg(share).alias("avg_percentage_laid_off"))


STATE_KEYS = ("country_canonical", "year", "month")


def country_month_state(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame,
                        date_key: str = "date_key", country_key: str = "country_key",
                        headcount: str = "total_laid_off", share: str = "percentage_laid_off") -> DataFrame:
    """What the mart has to remember per (country, year, month): event count, headcount sum (NULL without
    any), share sum and number of shares. States of disjoint sets of facts add up."""
    f = fact.select(F.col(date_key).alias("__fdk"), F.col(country_key).alias("__fck"),
                    F.col(headcount).alias("__h"), F.col(share).alias("__s"))
    j = (f.join(dim_date.select(F.col("date_key").alias("__dk"), "year", "month"), F.col("__fdk") == F.col("__dk"))
         .join(dim_country.select(F.col("country_key").alias("__ck"), "country_canonical"),
               F.col("__fck") == F.col("__ck"), "left"))
    return j.groupBy(F.coalesce(F.col("country_canonical"), F.lit("(Unknown)")).alias("country_canonical"),
                     "year", "month").agg(
        F.count(F.lit(1)).alias("layoff_events"), F.sum("__h").alias("laid_off_sum"),
        F.sum("__s").alias("share_sum"), F.count("__s").alias("share_count"))


def add_states(a: DataFrame, b: DataFrame) -> DataFrame:
    """The state of both sets of facts together, with the columns and types of ``a``."""
    sums = [c for c in a.columns if c not in STATE_KEYS]
    return a.unionByName(b).groupBy(*STATE_KEYS).agg(
        *[F.sum(c).cast(a.schema[c].dataType).alias(c) for c in sums]).select(*a.columns)


def mart_of_state(state: DataFrame) -> DataFrame:
    """The rows of the mart (as ``country_month_mart``) from its states."""
    kind = state.schema["share_sum"].dataType
    mean = F.col("share_sum") / F.nullif(F.col("share_count"), F.lit(0))
    if isinstance(kind, DecimalType):   # the type of avg() over the decimals that were summed
        n = F.nullif(F.col("share_count"), F.lit(0)).cast("decimal(20,0)")
        mean = (F.col("share_sum") / n).cast(DecimalType(kind.precision - 6, kind.scale + 4))
    return state.select(*STATE_KEYS, "layoff_events", F.col("laid_off_sum").alias("total_laid_off"),
                        mean.alias("avg_percentage_laid_off"))


def refreshed_mart(spark: SparkSession, root: str, base: int, mart: str, new_facts: DataFrame, dim_date: DataFrame,
                   dim_country: DataFrame, all_facts: Callable[[], DataFrame]) -> tuple[dict, list[str]]:
    """The changed years of the mart and its states, as ``append`` takes them (``replaced``, ``whole``).

    Only the new facts are read; their states are added to the kept states of the years they touch (a list no
    longer than the calendar), other years keep their folders. Where ``base`` has no states, both tables are built anew
    from ``all_facts()``. The facts are read and joined once: their states are checkpointed, and the years, the kept
    states and both written tables follow from there.
    """
    ensure_checkpoint_dir(spark)
    name = f"state_{mart}"
    if name in {e.table_name for e in tablelog.entries(spark, root, base)}:
        state = country_month_state(new_facts, dim_date, dim_country).checkpoint(eager=True)
        years = [str(r.year) for r in state.select("year").distinct().collect()]
        state, whole = add_states(read_published(spark, root, name, base, years), state), []
    else:
        state, whole = country_month_state(all_facts(), dim_date, dim_country).checkpoint(eager=True), [name, mart]
    return {name: (state, "year"), mart: (mart_of_state(state), "year")}, whole


# ---------------------------------------------------------------- W18-W21 publish, inventory, drift

def read_published(spark: SparkSession, root: str, table: str, version: int | None = None,
                   parts: Sequence[str] | None = None) -> DataFrame:
    """Read a table of the current (or a given) committed version, or only the folders of the given parts."""
    v = version or current_version(spark, root)
    if v == 0:
        raise FileNotFoundError(f"no published warehouse under {root}")
    found = [e for e in tablelog.entries(spark, root, v) if e.table_name == table]
    if not found:
        raise FileNotFoundError(f"no table {table} in version {v} under {root}")
    if parts is not None:
        # without a folder of these parts any other gives the schema
        wanted = [e for e in found if e.part is None or e.part in parts]
        return tablelog.read(spark, root, wanted) if wanted else tablelog.read(spark, root, found[:1]).limit(0)
    return tablelog.read(spark, root, found)


Declared = Sequence[Constraints] | Callable[[dict[str, DataFrame]], Sequence[Constraints]]


def _check_staged(spark: SparkSession, root: str, declared: Declared, kept: Sequence[Entry], staged: Sequence[Entry]) -> None:
    """W9 on what is about to be published: the staged rows, with the kept folders as their context.

    Row checks and foreign keys read the staged folders only, a UNIQUE also those kept rows that share a key
    with them; parents of foreign keys are whole tables, kept and staged. Kept rows passed in their own version.
    """
    before, added = tablelog.by_table(kept), tablelog.by_table(staged)
    if callable(declared):
        declared = declared({n: tablelog.read(spark, root, before.get(n, []) + added.get(n, [])) for n in {**before, **added}})
    for c in declared:
        if c.table in added:
            old = before.get(c.table)
            assert_constraints(check_constraints(tablelog.read(spark, root, added[c.table]), c,
                                                 tablelog.read(spark, root, old) if old else None))


def publish(tables: Mapping[str, DataFrame], root: str, constraints: Declared = (),
            part_by: Mapping[str, str] | None = None) -> int:
    """All tables or none; the version consists of the given tables alone.

    Tables go to folders of this load alone, are checked there (W9), and only
    then is the version committed. Readers resolve the newest committed
    manifest, so a failed or half-written load is never visible. Nothing is
    overwritten: a load that finds its version committed fails.
    """
    spark = next(iter(tables.values())).sparkSession
    version = current_version(spark, root) + 1
    load = tablelog.new_load(version)
    staged = [e for name, df in tables.items() for e in tablelog.stage(df, root, name, load, (part_by or {}).get(name))]
    _check_staged(spark, root, constraints, [], staged)
    return tablelog.commit(spark, root, version, staged)


def append(spark: SparkSession, root: str, base: int, new: Mapping[str, DataFrame],
           replaced: Mapping[str, tuple[DataFrame, str]] | None = None, constraints: Declared = (),
           whole: Sequence[str] = ()) -> int:
    """Version ``base + 1`` = the folders of ``base`` and what changed; returns it.

    ``new`` holds rows to add to a table; a table without new rows keeps its
    folders and gets none. ``replaced`` maps a table to (rows, part column):
    the parts that occur in the rows take the place of the same parts of
    ``base``, other parts stay. Tables named in ``whole`` lose all folders of
    ``base``. What is written follows the changed rows, not the size of the
    tables. Raises ``VersionConflict`` where another writer committed after
    ``base``: the rows were then worked out against an old version.
    """
    load, kept, staged = tablelog.new_load(base + 1), [], []
    replaced = replaced or {}
    before = tablelog.by_table(tablelog.entries(spark, root, base))
    for name in [*before, *[n for n in (*new, *replaced) if n not in before]]:
        added: list[Entry] = []
        old = [] if name in whole else before.get(name, [])
        df, part_col = replaced[name] if name in replaced else (new.get(name), None)
        if df is not None and (not old or not df.isEmpty()):
            added = tablelog.stage(df, root, name, load, part_col)
        parts = {e.part for e in added} if part_col else set()
        # a folder without rows only keeps the schema, which the added folders hold too
        kept += [e for e in old if (e.row_count or not added) and (e.part is None or e.part not in parts)]
        staged += added
    _check_staged(spark, root, constraints, kept, staged)
    return tablelog.commit(spark, root, base + 1, [*kept, *staged])


def inventory_rows(spark: SparkSession, root: str) -> DataFrame:
    """The manifest rows of the current version, one per folder of a table."""
    return tablelog.manifests(spark, root).where(F.col("version") == current_version(spark, root))


def _kind() -> Column:
    prefix = F.split(F.col("table_name"), "_")[0]
    return (F.when(prefix == "dim", "dimension").when(prefix.isin("fact", "mart", "state"), prefix).otherwise("other"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Number of dimension, fact and mart tables in the current version (the kept states of a mart don't count)."""
    return inventory_rows(spark, root).withColumn("kind", _kind()).where("kind != 'state'") \
        .groupBy("kind").agg(F.countDistinct("table_name").alias("tables"))


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(version, kind, table_name, row_count) of every committed version, from the manifests alone."""
    return tablelog.manifests(spark, root).groupBy("version", _kind().alias("kind"), "table_name") \
        .agg(F.sum("row_count").alias("row_count"))


def schema_drift(expected: Mapping[str, StructType], actual: Mapping[str, StructType]) -> list[str]:
    """Differences in column names/order and types between descriptors and published tables."""
    problems = []
    for name, schema in expected.items():
        if name not in actual:
            problems.append(f"{name}: missing table")
            continue
        exp = [(f.name, f.dataType.simpleString()) for f in schema.fields]
        act = [(f.name, f.dataType.simpleString()) for f in actual[name].fields]
        if [n for n, _ in exp] != [n for n, _ in act]:
            problems.append(f"{name}: columns {[n for n, _ in act]} != {[n for n, _ in exp]}")
        else:
            for (n, t1), (_, t2) in zip(exp, act):
                if t1 != t2:
                    problems.append(f"{name}.{n}: type {t2} != {t1}")
    return problems
