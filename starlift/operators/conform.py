"""Conformance and cleanup transforms (§2.3 C1-C12).

Small fixed vocabularies are applied as literal maps (no join). Vocabularies
held in a DataFrame are joined; Spark broadcasts them when AQE measures them
under the broadcast threshold and shuffles otherwise, so nothing unbounded
is ever forced into a broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import stats as ST


def conform(df: DataFrame, col: str, mapping: Mapping[str, str] | DataFrame, out: str,
            raw_col: str = "raw", canonical_col: str = "canonical",
            extra: Sequence[str] = ()) -> DataFrame:
    """Add ``out`` = canonical value of ``col``; unmapped -> NULL.

    ``mapping`` is a dict (literal map) or a reference DataFrame
    ``(raw, canonical, *extra)``; extra attributes (e.g. continent) are carried.
    """
    if not isinstance(mapping, DataFrame):
        return df.withColumn(out, SF.map_lookup(col, mapping))
    ref = mapping.select(F.col(raw_col).alias("__raw"), F.col(canonical_col).alias(out), *extra) \
        .dropDuplicates(["__raw"])
    return df.join(ref, F.col(col) == F.col("__raw"), "left").drop("__raw")


def complete_map(mapping: Mapping[str, str | None] | DataFrame, listed: DataFrame, col: str,
                 raw_col: str = "raw", canonical_col: str = "canonical") -> Mapping[str, str | None] | DataFrame:
    """The map itself, after a check that it resolves every non-NULL value of ``listed``.

    Raises ValueError with the number of unresolved values and the first twenty of them, so a load never runs on a
    map with holes. The map may be a dict or a reference table; the values are made distinct before they are joined.
    """
    values = listed.select(F.col(col).alias("__value")).where(F.col("__value").isNotNull()).distinct()
    missing = conform(values, "__value", mapping, "__canonical", raw_col, canonical_col) \
        .where(F.col("__canonical").isNull()).select("__value").persist()
    names = [row[0] for row in missing.orderBy("__value").limit(20).collect()]
    try:
        if names:
            raise ValueError(f"{missing.count()} value(s) of {col} without a canonical one: {names}")
    finally:
        missing.unpersist()
    return mapping


def fill_unknown(df: DataFrame, cols: Sequence[str], label: str = "Unknown") -> DataFrame:
    """Explicit label for missing values (apply after conform, §7.3 X12)."""
    return df.fillna(label, subset=list(cols))


def percentile_bounds(df: DataFrame, col: str, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """One-row DataFrame (lo, hi) of exact, linearly interpolated percentiles over non-NULL values."""
    return ST.quantiles(df, [], col, {"__lo": lower, "__hi": upper})


def winsorize(df: DataFrame, col: str, out: str | None = None, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Clip to the ``lower``/``upper`` percentiles; NULL stays NULL; no data -> unchanged.

    The bounds are a single row, joined with a broadcast (its size is one row
    by construction); they are exact and interpolate like pandas (§7.3 X3).
    """
    bounds = percentile_bounds(df, col, lower, upper)
    out = out or col
    joined = df.crossJoin(F.broadcast(bounds))
    return joined.withColumn(out, SF.clip_guarded(col, "__lo", "__hi")).drop("__lo", "__hi")


def add_bucket(df: DataFrame, col: str, out: str, edges=SF.EXPERIENCE_EDGES, labels=SF.EXPERIENCE_LEVELS) -> DataFrame:
    """Right-closed bucket label."""
    return df.withColumn(out, SF.bucket_right_closed(col, edges, labels))


def normalize_tag_column(df: DataFrame, col: str, out: str, synonyms: Mapping[str, str] | None = None,
                         sep: str = "|") -> DataFrame:
    """Split, trim, synonym map, de-duplicate, sort, re-join."""
    return df.withColumn(out, SF.normalize_tags_string(col, synonyms, sep))


def mask_spam(df: DataFrame, col: str, out: str, min_words: int = 15, ratio: float = 0.8) -> DataFrame:
    """C11: NULL out repetitive long text (whole text, O(n log n) per row)."""
    return df.withColumn(out, SF.spam_masked(col, min_words, ratio))


def short_answer_mask(col: str, max_words: int = 4) -> Column:
    """True when the text has more than ``max_words`` words (will be modelled)."""
    return F.col(col).isNotNull() & (SF.word_count(col) > max_words)


def clean_nulls(df: DataFrame, string_tokens: bool = True) -> DataFrame:
    """C17 + §7.3 X1: NaN -> NULL on float columns, pandas null tokens -> NULL on strings."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("double", "float"):
            out.append(SF.nan_to_null(f.name).alias(f.name))
        elif t == "string" and string_tokens:
            out.append(SF.null_tokens_to_null(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
