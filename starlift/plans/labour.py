"""The three labour-market datasets as ``DatasetDef`` configurations.

Each definition is a contract (S1-S3), a rule set (Q*), a transform (C*) and
optional features (T*). Rules are Column expressions; the group rules are
skew-safe aggregates (see ``operators.quality``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import conform as CF
from starlift.operators import quality as Q
from starlift.refdata import labour as L
from starlift.sources.contracts import Contract, schema_of

SEQ = "_seq"  # file order (§7.3 X5): file path + position, carried from the scan


@dataclass
class DatasetDef:
    name: str
    contract: Contract
    rules: Callable[[DataFrame], tuple[DataFrame, dict[str, Column]]]
    transform: Callable[[DataFrame], DataFrame]
    features: Callable[[DataFrame], tuple[DataFrame, dict[str, DataFrame]]] | None = None
    extra: dict = field(default_factory=dict)


LAYOFFS = Contract("layoffs", schema_of(
    "company string, location string, total_laid_off double, date string, percentage_laid_off double, "
    "industry string, source string, stage string, funds_raised double, country string, date_added string"))
AI_JOBS = Contract("ai_jobs", schema_of(
    "job_id string, job_title string, job_category string, experience_level string, years_of_experience bigint, "
    "education_required string, annual_salary_usd double, salary_min_usd bigint, salary_max_usd bigint, "
    "city string, country string, remote_work string, company_size string, industry string, "
    "required_skills string, ai_salary_premium_pct double, demand_score bigint, demand_growth_yoy_pct double, "
    "benefits_score_10 double, posting_year bigint, posting_month bigint, is_senior bigint, "
    "is_remote_friendly bigint, is_llm_role bigint, salary_tier string"))
SURVEY = Contract("survey", schema_of(
    "ResponseId bigint, MainBranch string, Age string, EdLevel string, Employment string, WorkExp double, "
    "YearsCode double, DevType string, RemoteWork string, Country string, Industry string, "
    "ConvertedCompYearly double, AIThreat string, AISelect string, AISent string, AIAcc string, "
    "JobSat double, AIOpen string"))


def _vocab(col: str, vocab) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(list(vocab))


# ---------------------------------------------------------------- layoffs

def layoffs_rules(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    cols = LAYOFFS.columns
    df = df.withColumn("__date_added", SF.parse_date("date_added"))
    df = Q.add_row_and_key_flags(df, cols, ["company", "date", "location"], SEQ, "__date_added",
                                 "__dup_row", "__conflict")
    return df, {
        "percentage_laid_off_out_of_range": Q.range_violation("percentage_laid_off", 0, 1),
        "total_laid_off_negative": F.col("total_laid_off") < 0,
        "funds_raised_negative": F.col("funds_raised") < 0,
        "duplicate_row": F.col("__dup_row"),
        "duplicate_key_conflicting_values": F.col("__conflict"),
        "country_not_in_dimension_map": _vocab("country", L.COUNTRY_MAP),
        "industry_not_in_dimension_map": _vocab("industry", L.INDUSTRY_MAP),
    }


def layoffs_transform(df: DataFrame) -> DataFrame:
    df = CF.conform(df, "country", L.COUNTRY_MAP, "country_canonical")
    df = CF.conform(df, "industry", L.INDUSTRY_MAP, "industry_sector")
    return CF.fill_unknown(df, ["location", "industry", "stage"], L.UNKNOWN)


# ---------------------------------------------------------------- ai jobs

def ai_jobs_rules(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    df = Q.add_duplicate_flag(df, AI_JOBS.columns, [SEQ], "__dup_row")
    df = Q.add_duplicate_flag(df, ["job_id"], [SEQ], "__dup_id")
    return df, {
        "duplicate_row": F.col("__dup_row"),
        "duplicate_job_id": F.col("__dup_id"),
        "salary_min_exceeds_max": F.col("salary_min_usd") > F.col("salary_max_usd"),
        "salary_min_not_positive": F.col("salary_min_usd") <= 0,
        "years_of_experience_negative": F.col("years_of_experience") < 0,
        "country_not_in_dimension_map": _vocab("country", L.COUNTRY_MAP),
        "industry_not_in_dimension_map": _vocab("industry", L.INDUSTRY_MAP),
        "job_title_not_in_dimension_map": _vocab("job_title", L.ROLE_MAP),
        "experience_level_not_in_dimension_map": _vocab("experience_level", L.EXPERIENCE_MAP),
    }


def ai_jobs_transform(df: DataFrame) -> DataFrame:
    df = CF.conform(df, "country", L.COUNTRY_MAP, "country_canonical")
    df = CF.conform(df, "industry", L.INDUSTRY_MAP, "industry_sector")
    df = CF.conform(df, "job_title", L.ROLE_MAP, "role_category")
    df = CF.conform(df, "experience_level", L.EXPERIENCE_MAP, "experience_level_canonical")
    return CF.normalize_tag_column(df, "required_skills", "required_skills_normalized", L.SKILL_MAP)


# ---------------------------------------------------------------- survey

def survey_rules(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    df = Q.add_duplicate_flag(df, SURVEY.columns, [SEQ], "__dup_row")
    df = Q.add_duplicate_flag(df, ["ResponseId"], [SEQ], "__dup_id")
    return df, {
        "duplicate_row": F.col("__dup_row"),
        "duplicate_response_id": F.col("__dup_id"),
        "work_exp_implausible_for_age": Q.bound_violation("WorkExp", "Age", L.AGE_UPPER_BOUND, L.EARLIEST_START_AGE),
        "years_code_implausible_for_age": Q.bound_violation("YearsCode", "Age", L.AGE_UPPER_BOUND, L.EARLIEST_START_AGE),
        "job_sat_out_of_range": Q.range_violation("JobSat", 0, 10),
        "country_not_in_dimension_map": _vocab("Country", L.COUNTRY_MAP),
        "industry_not_in_dimension_map": _vocab("Industry", L.INDUSTRY_MAP),
        "devtype_not_in_dimension_map": _vocab("DevType", L.ROLE_MAP),
    }


def survey_transform(df: DataFrame) -> DataFrame:
    df = CF.conform(df, "Country", L.COUNTRY_MAP, "country_canonical")
    df = CF.conform(df, "Industry", L.INDUSTRY_MAP, "industry_sector")
    df = CF.conform(df, "DevType", L.ROLE_MAP, "role_category")
    df = CF.add_bucket(df, "WorkExp", "experience_level_canonical")
    df = CF.winsorize(df, "ConvertedCompYearly", "converted_comp_yearly_winsorized")
    df = CF.fill_unknown(df, list(L.AI_SENTIMENT_COLS), L.NOT_ANSWERED)
    return CF.mask_spam(df, "AIOpen", "ai_open_clean")


# Topic labels and the anchor terms that identify them in a fit.
TOPIC_ANCHORS = {
    "AI capability skepticism": frozenset({"ai tools"}),
    "Problem solving": frozenset({"problem solving"}),
    "Critical thinking": frozenset({"critical thinking"}),
    "Software architecture / system design": frozenset({"software architecture"}),
    "Skills will remain valuable (generic)": frozenset({"remain valuable"}),
    "Soft skills / communication": frozenset({"soft skills"}),
    "Business/domain understanding": frozenset({"understanding business"}),
    "Code reading & writing": frozenset({"code", "writing"}),
    "Complex-problem-solving ability": frozenset({"complex problems"}),
    "High-level vs. low-level design": frozenset({"high level", "low level"}),
}
SURVEY_MODEL_VERSION = "nmf-2025-v1"


def survey_features(df: DataFrame, anchors=TOPIC_ANCHORS, k: int = 10, max_iter: int = 500
                    ) -> tuple[DataFrame, dict[str, DataFrame]]:
    """T1-T8 on ``ai_open_clean``: TF-IDF + NMF, anchor labels, row assignment, topic artifact."""
    from starlift.operators import nmf as NMF
    from starlift.operators import text as TX
    from starlift.operators.factor import stored
    spark = df.sparkSession
    sentences = df.where(F.col("ai_open_clean").isNotNull() & (SF.word_count("ai_open_clean") > 4)) \
        .select(F.col("ResponseId").alias("__rid"), F.col("ai_open_clean").alias("text"))
    topic_schema = "model_version string, component_id int, topic_label string, top_terms string"
    if sentences.limit(1).count() == 0:
        out = df.withColumn("ai_open_topic_id", F.lit(None).cast("int")) \
            .withColumn("ai_open_topic_label", F.lit(None).cast("string"))
        return out, {"topics": spark.createDataFrame([], topic_schema)}
    counted = stored(TX.counted_terms(TX.terms(sentences, "text", stopwords=None), "__rid"))
    tf = TX.exploded_counts(counted, "__rid")
    vocab = stored(TX.vocabulary(tf, counted.agg(F.count(F.lit(1)).alias("n")), 5, 0.6).select("term", "term_index", "idf"))
    model = NMF.fit(TX.sparse_rows(TX.tfidf_rows(tf, vocab, "__rid"), "__rid"), vocab.count(), k=k, max_iter=max_iter, id_col="__rid")
    table = NMF.top_terms(NMF.long_factor(model.H, "term_index", "h"), vocab, 10).collect()  # 10 rows a topic
    top = [[r["term"] for r in sorted(table, key=lambda r: r["rank"]) if r["topic_id"] == i] for i in range(k)]
    labels = TX.match_topic_labels(top, anchors, SURVEY_MODEL_VERSION)
    lab = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    assigned = model.W.select("__rid", TX.dominant_topic("w").alias("ai_open_topic_id"))
    out = df.join(assigned, df.ResponseId == assigned.__rid, "left").drop("__rid") \
        .withColumn("ai_open_topic_label", lab[F.col("ai_open_topic_id")])
    topics = spark.createDataFrame([(SURVEY_MODEL_VERSION, i, labels[i], ", ".join(ts)) for i, ts in enumerate(top)],
                                   topic_schema)
    return out, {"topics": topics}


DATASETS = {
    "layoffs": DatasetDef("layoffs", LAYOFFS, layoffs_rules, layoffs_transform),
    "ai_jobs": DatasetDef("ai_jobs", AI_JOBS, ai_jobs_rules, ai_jobs_transform),
    "survey": DatasetDef("survey", SURVEY, survey_rules, survey_transform, survey_features),
}
