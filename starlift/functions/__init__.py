"""Column-level helpers (scalar transforms, §2.3 C*; interval maths, A30/A31).

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen (higher-order functions are JVM-side too).
No Python UDF is used here.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Tokens that pandas' CSV reader turns into missing values by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Z value for a two-sided 95 % interval.
Z95 = 1.959963984540054

# A word for the tokenizer: a run of two or more letters, digits or underscores
# (the same tokens as the pattern ``\b\w\w+\b`` with Unicode ``\w``).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- null model

def null_tokens_to_null(c: ColumnOrName, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """String column with the pandas null tokens replaced by NULL (§7.3 X1)."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def nan_to_null(c: ColumnOrName) -> Column:
    """C17: NaN becomes SQL NULL (Spark treats NaN = NaN as true and sorts it highest)."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


# ---------------------------------------------------------------- dates

def parse_date(c: ColumnOrName, fmt: str = "M/d/yyyy", strict: bool = False) -> Column:
    """``strict`` raises on bad input (ANSI ``to_date``), otherwise NULL."""
    c = _col(c)
    return F.to_date(c, fmt) if strict else F.try_to_date(c, fmt)


def date_key(d: ColumnOrName) -> Column:
    """Smart key YYYYMMDD as int, computed (no lookup). NULL passes through."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(year: ColumnOrName, month: ColumnOrName) -> Column:
    """First day of the month as a YYYYMMDD key."""
    return (_col(year) * 10000 + _col(month) * 100 + 1).cast("int")


# ---------------------------------------------------------------- buckets, clip, tiers

# Experience buckets, right-closed edges (-inf,2], (2,5], (5,9], (9,inf).
EXPERIENCE_EDGES = (2.0, 5.0, 9.0)
EXPERIENCE_LEVELS = ("Entry", "Mid", "Senior", "Lead")


def bucket_right_closed(c: ColumnOrName, edges: Sequence[float] = EXPERIENCE_EDGES,
                        labels: Sequence[str] = EXPERIENCE_LEVELS) -> Column:
    """Label of the right-closed bin holding ``c``; NULL stays NULL.

    ``Bucketizer`` is left-closed, hence a ``when`` chain.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    c = _col(c)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        expr = expr.when(c <= F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def clip_guarded(c: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """Clip to [lo, hi]; NULL stays NULL and NULL bounds leave the value unchanged (§7.3 X3)."""
    c, lo, hi = _col(c), _col(lo), _col(hi)
    lower = F.when(lo.isNotNull() & (c < lo), lo).otherwise(c)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.when(hi.isNotNull() & (lower > hi), hi).otherwise(lower).cast("double"))


# Salary tiers (right-closed upper bounds in USD, label).
SALARY_TIERS = (
    (100000, "Entry (<$100k)"),
    (150000, "Mid ($100-150k)"),
    (200000, "Upper-Mid ($150-200k)"),
    (300000, "Senior ($200-300k)"),
)
SALARY_TIER_TOP = "Elite (>$300k)"


def salary_tier(c: ColumnOrName) -> Column:
    """Five right-closed salary tiers."""
    c = _col(c)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for bound, label in SALARY_TIERS:
        expr = expr.when(c <= bound, F.lit(label))
    return expr.otherwise(F.lit(SALARY_TIER_TOP))


# ---------------------------------------------------------------- maps and tags

def map_lookup(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Literal map lookup for small fixed vocabularies (no join); unmapped -> NULL."""
    if not mapping:
        return F.lit(None).cast("string")
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return m[_col(c)]


def normalize_tags(c: ColumnOrName, synonyms: Mapping[str, str] | None = None, sep: str = "|") -> Column:
    """C10 as an array: split on ``sep``, trim, map synonyms, de-duplicate, sort."""
    parts = F.split(_col(c), "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)
    trimmed = F.transform(parts, lambda t: F.trim(t))
    if synonyms:
        m = F.create_map(*[F.lit(x) for kv in synonyms.items() for x in kv])
        trimmed = F.transform(trimmed, lambda t: F.coalesce(m[t], t))
    return F.sort_array(F.array_distinct(trimmed))


def normalize_tags_string(c: ColumnOrName, synonyms: Mapping[str, str] | None = None, sep: str = "|") -> Column:
    """Normalised tags re-joined with ``sep``; NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(normalize_tags(c, synonyms, sep), sep))


# ---------------------------------------------------------------- free text

def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading/trailing whitespace of any kind (Spark ``trim`` only removes spaces)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def ws_tokens(c: ColumnOrName, lower: bool = False) -> Column:
    """Whitespace tokens like Python's ``str.split()`` (maximal runs of non-space), one regex pass."""
    s = F.lower(_col(c)) if lower else _col(c)
    return F.regexp_extract_all(s, F.lit(r"\S+"), 0)


def word_count(c: ColumnOrName) -> Column:
    """Number of whitespace-separated words; NULL stays NULL."""
    return F.when(_col(c).isNull(), F.lit(None)).otherwise(F.size(ws_tokens(c)))


def more_words_than(c: ColumnOrName, n: int) -> Column:
    """``word_count(c) > n``, without cutting the text into words; NULL stays NULL."""
    return _col(c).rlike(r"^\s*+(?:\S++\s++){%d}\S" % n)


def run_lengths(tokens: Column) -> Column:
    """array<struct<term, tf>>: each distinct token with its count, in sorted order.

    O(n log n) inside the row: sort, flag run starts against the shifted
    array, then run lengths from consecutive start positions. Every lambda
    only uses its own arguments - an outer array referenced inside a lambda
    would be re-evaluated once per element.
    """
    s = F.sort_array(tokens)
    n = F.size(s)
    shifted = F.concat(F.array(F.lit(None).cast("string")), s)
    is_start = F.zip_with(s, shifted, lambda a, b: a.isNotNull() & (b.isNull() | (a != b)))
    starts = F.filter(F.transform(is_start, lambda f, i: F.when(f, i).otherwise(F.lit(-1))), lambda p: p >= 0)
    ends = F.slice(F.concat(starts, F.array(n)), 2, F.size(starts))
    counts = F.zip_with(starts, ends, lambda a, b: b - a)
    terms = F.array_compact(F.zip_with(s, is_start, lambda t, f: F.when(f, t)))
    return F.arrays_zip(terms.alias("term"), counts.alias("tf"))


def max_token_run(tokens: Column) -> Column:
    """Count of the most common token of an array, in O(n log n) inside the row.

    The array is sorted and the longest run of equal neighbours is folded with
    ``aggregate``; no pairwise ``filter`` (O(n^2)) and no shuffle of tokens.
    """
    sorted_tokens = F.sort_array(tokens)
    init = F.struct(F.lit(None).cast("string").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc, x):
        run = F.when(x == acc["prev"], acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("prev"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(sorted_tokens, init, step, lambda acc: acc["best"])


def spam_flag(c: ColumnOrName, min_words: int = 15, ratio: float = 0.8) -> Column:
    """C11: more than ``min_words`` lower-cased tokens and the most common one
    makes up more than ``ratio`` of them. NULL text is never spam."""
    c = _col(c)
    # the lambda's argument is worked out once; a plain reference would cut the text into tokens for every use
    if ratio < 0.5:
        flag = F.transform(F.array(ws_tokens(c, lower=True)), lambda toks: (F.size(toks) > min_words) & (max_token_run(toks) / F.size(toks) > ratio))
    else:
        # a token with more than half of the places is the middle one of the sorted tokens; texts with many distinct tokens need no sort
        def most(toks):
            middle = F.get(F.sort_array(toks), F.floor(F.size(toks) / 2).cast("int"))
            return F.size(toks) - F.size(F.array_remove(toks, middle))
        few = lambda toks: F.size(F.array_distinct(toks)) - 1 <= (1 - ratio) * F.size(toks)
        flag = F.transform(F.array(ws_tokens(c, lower=True)), lambda toks: (F.size(toks) > min_words) & few(toks) & (most(toks) / F.size(toks) > ratio))
    return F.when(c.isNull(), F.lit(False)).otherwise(F.get(flag, F.lit(0)))


def spam_masked(c: ColumnOrName, min_words: int = 15, ratio: float = 0.8) -> Column:
    """C11: text with spam replaced by NULL."""
    c = _col(c)
    return F.when(spam_flag(c, min_words, ratio), F.lit(None).cast("string")).otherwise(c)


def word_tokens(c: ColumnOrName) -> Column:
    """Lower-cased word tokens of two or more characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN_PATTERN), 0)


# ---------------------------------------------------------------- intervals

def wilson_interval(successes: ColumnOrName, n: ColumnOrName, z: float = Z95) -> tuple[Column, Column]:
    """95 % Wilson score interval for a proportion, (low, high). NULL when n = 0."""
    x, n = _col(successes).cast("double"), _col(n).cast("double")
    p = x / F.nullif(n, F.lit(0.0))
    z2 = z * z
    denom = 1 + z2 / n
    centre = (p + z2 / (2 * n)) / denom
    half = (z / denom) * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    return centre - half, centre + half


def wald_interval(successes: ColumnOrName, n: ColumnOrName, z: float = Z95) -> tuple[Column, Column]:
    """Normal-approximation interval (the method behind published tiles, §7.3 X8)."""
    x, n = _col(successes).cast("double"), _col(n).cast("double")
    p = x / F.nullif(n, F.lit(0.0))
    half = z * F.sqrt(p * (1 - p) / n)
    return p - half, p + half


def mean_interval(mean: ColumnOrName, sd: ColumnOrName, n: ColumnOrName, z: float = Z95) -> tuple[Column, Column]:
    """Mean +- z * sd / sqrt(n)."""
    m, s, n = _col(mean), _col(sd), _col(n).cast("double")
    half = z * s / F.sqrt(F.nullif(n, F.lit(0.0)))
    return m - half, m + half


def log10_class(c: ColumnOrName) -> Column:
    """Class of a positive value on a log10 scale (0 for 1..9, 1 for 10..99, ...)."""
    c = _col(c)
    return F.when(c > 0, F.floor(F.log10(c))).cast("int")


def rounded(c: ColumnOrName, digits: int = 6) -> Column:
    """Round a double for presentation / cross-engine comparison; -0.0 becomes 0.0."""
    return F.round(_col(c).cast("double"), digits) + F.lit(0.0)


