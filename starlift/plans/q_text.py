"""Text queries (C11, C12, T1-T11) over ``documents``.

Answers to model = English documents whose text survives the spam mask and
has more than four words (the reference's "sentence answers"). Every text
is processed whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift import functions as SF
from starlift.operators import nmf as NMF
from starlift.operators import text as TX
from starlift.operators.factor import stored
from starlift.plans.registry import register
from starlift.session import Tables, spread

# Model hyper-parameters (TF-IDF bounds, topics, iterations and seed as in the source project's fit).
MIN_DF = 5
MAX_DF = 0.6
N_TOPICS = 10
TOP_TERMS = 10
MAX_ITER = 500
TOL = 1e-4
SEED = 42
MODEL_VERSION = "nmf-sl-v1"
#: Projected gradient of a side, summed, relative to the sum of its product with the data (certificate of T3).
CERTIFICATE = 1e-3
SHORT_MAX_WORDS = 4
TOP_N_SHORT = 20


def model_answers(t: Tables) -> DataFrame:
    """(doc_id, text) of the answers that get a topic (C11 spam mask, C12 length mask)."""
    d = spread(t.documents.select("doc_id", "text"))
    # one filter over the raw text: a masked column would be worked out again by every condition on it
    return d.where(F.col("text").isNotNull() & SF.more_words_than("text", SHORT_MAX_WORDS) & ~SF.spam_flag("text"))


def model_terms(t: Tables) -> DataFrame:
    return TX.terms(model_answers(t), "text", stopwords=None).select("doc_id", "terms")


def model_blocks(t: Tables) -> DataFrame:
    """The answers' term counts in blocks, written once; frequencies, vocabulary and rows read them again."""
    key = "model_blocks"
    if key not in t._memo:
        answers = model_answers(t)
        spark = answers.sparkSession
        # large blocks share more of their terms; a task's texts are sorted in memory
        n = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
        # rows of one doc_id side by side: they make one TF-IDF row
        t._memo[key] = stored(TX.counted_blocks(answers.repartition(n, "doc_id").sortWithinPartitions("doc_id"), "doc_id", "text", stopwords=None), "zstd", large_rows=True)
    return t._memo[key]


def model_vocabulary(blocks: DataFrame) -> DataFrame:
    return TX.block_vocabulary(blocks, MIN_DF, MAX_DF)


_SW_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in TX.english_stopwords()) + "]"
MODEL_SQL = f"""
d0 AS (SELECT doc_id, text, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s FROM documents),
d1 AS (SELECT doc_id, text, CASE WHEN s = '' THEN [] ELSE string_split_regex(s, '\\s+') END AS toks,
              CASE WHEN s = '' THEN [] ELSE string_split_regex(lower(s), '\\s+') END AS ltoks FROM d0),
d2 AS (SELECT doc_id, text, len(toks) AS n_words, len(ltoks) AS n_low,
              (SELECT max(c) FROM (SELECT count(*) AS c FROM unnest(ltoks) AS u(x) GROUP BY x)) AS top_count FROM d1),
model AS (SELECT doc_id, text FROM d2
          WHERE text IS NOT NULL AND NOT (n_low > 15 AND top_count * 1.0 / n_low > 0.8) AND n_words > {SHORT_MAX_WORDS}),
mt AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS toks FROM model),
mf AS (SELECT doc_id, list_filter(toks, lambda x: NOT list_contains({_SW_SQL}, x)) AS w FROM mt),
mterm AS (SELECT doc_id, unnest(list_concat(w, CASE WHEN len(w) < 2 THEN [] ELSE
                 list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS term FROM mf),
tf AS (SELECT doc_id, term, count(*) AS tf FROM mterm GROUP BY ALL),
ndocs AS (SELECT count(*) AS n FROM model),
vocab AS (SELECT term, count(*) AS df, ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0 AS idf FROM tf, ndocs
          GROUP BY term HAVING count(*) >= {MIN_DF} AND count(*) <= {MAX_DF} * any_value(n))"""


@register("c11_spam_mask", """
WITH d0 AS (SELECT doc_id, text, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s FROM documents),
d1 AS (SELECT doc_id, text, CASE WHEN s = '' THEN [] ELSE string_split_regex(lower(s), '\\s+') END AS ltoks FROM d0),
d2 AS (SELECT doc_id, text, len(ltoks) AS n_tokens,
              (SELECT max(c) FROM (SELECT count(*) AS c FROM unnest(ltoks) AS u(x) GROUP BY x)) AS top FROM d1)
SELECT doc_id, CAST(n_tokens AS INTEGER) AS n_tokens, CAST(coalesce(top, 0) AS INTEGER) AS top_token_count,
       coalesce(text IS NOT NULL AND n_tokens > 15 AND top * 1.0 / n_tokens > 0.8, false) AS is_spam FROM d2""")
def c11_spam_mask(spark, sf_dir):
    """C11 over whole texts: token count, count of the most common token, spam flag."""
    d = spread(Tables(spark, sf_dir).documents.select("doc_id", "text"))
    toks = SF.ws_tokens("text", lower=True)
    return d.select("doc_id", F.size(toks).alias("n_tokens"), SF.max_token_run(toks).alias("top_token_count"),
                    SF.spam_flag("text").alias("is_spam"))


@register("t1_top_terms", "WITH " + MODEL_SQL.strip() + """
SELECT term, CAST(count(*) AS BIGINT) AS count FROM mterm GROUP BY term""")
def t1_top_terms(spark, sf_dir):
    """All unigrams + bigrams after English stop words over the modelled answers, with their counts."""
    blocks = TX.counted_blocks(model_answers(Tables(spark, sf_dir)), "doc_id", "text", stopwords=None)
    return TX.block_terms(blocks, "counts", "count")


@register("t2_tfidf_vocabulary", "WITH " + MODEL_SQL.strip() + """
SELECT term, CAST(df AS BIGINT) AS df, (round(idf, 6) + 0.0) AS idf FROM vocab""")
def t2_tfidf_vocabulary(spark, sf_dir):
    """Vocabulary after min_df / max_df with smoothed idf."""
    vocab = model_vocabulary(model_blocks(Tables(spark, sf_dir)))
    return vocab.select("term", "df", SF.rounded("idf").alias("idf"))


@register("t2_tfidf_doc_top_term", "WITH " + MODEL_SQL.strip() + """,
w AS (SELECT tf.doc_id, tf.term, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term),
nw AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight,
              count(*) OVER (PARTITION BY doc_id) AS nnz,
              row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term) AS rn FROM w)
SELECT doc_id, CAST(nnz AS BIGINT) AS nnz, term AS top_term, (round(weight, 6) + 0.0) AS top_weight FROM nw WHERE rn = 1""")
def t2_tfidf_doc_top_term(spark, sf_dir):
    """L2-normalised TF-IDF rows; per document its size and heaviest term (ties by term)."""
    blocks = model_blocks(Tables(spark, sf_dir))
    top = TX.block_heaviest(blocks, model_vocabulary(blocks), "doc_id")
    return top.select("doc_id", F.col("nnz").cast("long").alias("nnz"), "top_term", SF.rounded("top_weight").alias("top_weight"))


@register("t9_short_answer_terms", f"""
WITH d0 AS (SELECT text, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s FROM documents),
short AS (SELECT text FROM d0 WHERE text IS NOT NULL
          AND (CASE WHEN s = '' THEN 0 ELSE len(string_split_regex(s, '\\s+')) END) <= {SHORT_MAX_WORDS}),
tk AS (SELECT regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM short),
terms AS (SELECT unnest(list_concat(w, CASE WHEN len(w) < 2 THEN [] ELSE
                 list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS term FROM tk)
SELECT term, CAST(count(*) AS BIGINT) AS count FROM terms GROUP BY term ORDER BY count DESC, term LIMIT {TOP_N_SHORT}""")
def t9_short_answer_terms(spark, sf_dir):
    """Unigram + bigram counts over answers of at most four words (no stop-word removal), top-n."""
    d = spread(Tables(spark, sf_dir).documents.select("text"))
    short = d.where(F.col("text").isNotNull() & (SF.word_count("text") <= SHORT_MAX_WORDS))
    return TX.term_frequency(TX.terms(short, "text", stopwords=()), top_n=TOP_N_SHORT)


# ---------------------------------------------------------------- T3-T8, T10, T11: the topic model

class Topics:
    """A fitted topic model with its vocabulary, TF-IDF rows and top terms."""

    def __init__(self, blocks: DataFrame, warm: DataFrame | None = None):
        self.vocab = stored(model_vocabulary(blocks).select("term", "term_index", "idf"))
        self.rows = stored(TX.block_rows(blocks, self.vocab, "doc_id").select("doc_id", "indices", "values"))
        if warm is not None:   # (term, h) of another fit: terms that it doesn't know start near zero
            warm = self.vocab.join(warm, "term").select("term_index", "h")
        self.model = NMF.fit(self.rows, self.vocab.count(), k=N_TOPICS, max_iter=MAX_ITER, tol=TOL if warm is None else TRIAL_TOL, seed=SEED, id_col="doc_id", warm=warm)
        self.factor = NMF.long_factor(self.model.H, "term_index", "h")
        table = NMF.top_terms(self.factor, self.vocab, TOP_TERMS).collect()  # N_TOPICS * TOP_TERMS rows
        self.top = [[r["term"] for r in sorted(table, key=lambda r: r["rank"]) if r["topic_id"] == k] for k in range(N_TOPICS)]

    def by_term(self) -> DataFrame:
        """(term, h): the term factor under the terms themselves, for a fit with another vocabulary."""
        return self.model.H.join(self.vocab.select("term", "term_index"), "term_index").select("term", "h")


def fit_topics(t: Tables, fraction: float = 1.0, seed: int = SEED, warm: DataFrame | None = None) -> Topics:
    """T2 + T3 + T5: TF-IDF rows -> NMF -> top terms per topic, kept with the tables.

    ``fraction < 1`` refits on a seeded sample without replacement (T11).
    """
    key = f"topics-{fraction}-{seed}-{warm is not None}"
    if key not in t._memo:
        blocks = model_blocks(t)
        t._memo[key] = Topics(blocks if fraction == 1.0 else stored(TX.sampled_blocks(blocks, fraction, seed), "zstd", large_rows=True), warm)
    return t._memo[key]


def match_topics(t: Tables, one: Topics, other: Topics) -> tuple[list[int], np.ndarray]:
    """The topic of ``other`` for each topic of ``one`` (minimum-cost assignment) and the cosines of all pairs.

    The products of the two term factors are joined and summed; k x k numbers reach the driver.
    """
    def long(topics: Topics, topic: str, x: str) -> DataFrame:
        return topics.by_term().select("term", F.posexplode("h").alias(topic, x)).where(F.col(x) > 0)

    a, b = long(one, "i", "x"), long(other, "j", "y")
    cosine = np.zeros((N_TOPICS, N_TOPICS))
    for r in a.join(b, "term").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("p")).collect():
        cosine[r["i"], r["j"]] = r["p"]
    for f, axis, topic, x in ((a, 1, "i", "x"), (b, 0, "j", "y")):
        for r in f.groupBy(topic).agg(F.sqrt(F.sum(F.col(x) * F.col(x))).alias("norm")).collect():
            where = (r[topic], slice(None)) if axis else (slice(None), r[topic])
            cosine[where] /= r["norm"]
    return NMF.assign_pairs(1.0 - cosine), cosine


#: Shares of the rows left out, and the seeds of the samples.
TRIAL_DROPS = (0.05, 0.1)
TRIAL_SEEDS = (1,)
#: A refit starts at the full fit and is only matched with it, so it may stop sooner.
TRIAL_TOL = 1e-3
#: A topic survives a refit when its partner is this similar to it and shares most of its top terms.
SURVIVES = 0.9


def stability_trials(t: Tables, anchors=None, drops=TRIAL_DROPS, seeds=TRIAL_SEEDS) -> list[dict]:
    """Refits without a share of the rows, each started from the full fit.

    Per trial: the partner of every topic of the full fit, the cosines of all pairs, and the topics whose partner has the
    same place (``kept``). With anchors also the labels x topics hits and the labels that break: a label holds in a trial
    when exactly one topic has its anchors and that topic fits no other label.
    """
    full = fit_topics(t)
    trials = []
    for drop in drops:
        for seed in seeds:
            other = fit_topics(t, 1.0 - drop, seed, full.by_term())
            partner, cosine = match_topics(t, full, other)
            trial = {"drop": drop, "seed": seed, "partner": partner, "cosine": cosine, "top": other.top}
            if anchors:
                hits = TX.label_hits(other.top, anchors)
                trial |= {"hits": hits, "broken": TX.broken_labels(hits, list(anchors))}
            trials.append(trial)
    return trials


def topic_labels(top: list[list[str]], anchors=None) -> dict[int, str]:
    """T6 when anchors are given; otherwise each topic is named after its leading terms."""
    if anchors:
        return TX.match_topic_labels(top, anchors, MODEL_VERSION)
    return {i: " / ".join(ts[:2]) for i, ts in enumerate(top)}


@lru_cache(maxsize=8)
def _tables(session: str, sf_dir: str) -> Tables:
    """Tables of one Spark application, so that queries over the same model fit it once."""
    from pyspark.sql import SparkSession
    return Tables(SparkSession.getActiveSession(), sf_dir)


def fitted(spark, sf_dir) -> Topics:
    return fit_topics(_tables(spark.sparkContext.applicationId, sf_dir))


@register("t3_nmf_topics")
def t3_nmf_topics(spark, sf_dir):
    """Topic artifact (model_version, component_id, topic_label, top_terms); no SQL oracle (iterative)."""
    top = fitted(spark, sf_dir).top
    labels = topic_labels(top)
    rows = [(MODEL_VERSION, i, labels[i], ", ".join(ts)) for i, ts in enumerate(top)]
    return spark.createDataFrame(rows, "model_version string, component_id int, topic_label string, top_terms string")


@register("t3_nmf_certificate", """
SELECT * FROM (VALUES ('documents', true, true), ('terms', true, true), ('fit', true, true)) AS v(side, not_negative, stationary)""")
def t3_nmf_certificate(spark, sf_dir):
    """Is the fit what it should be? Worked out by joins over the exploded rows and both factors, apart from the fit's own numbers.

    Per side: no entry is negative, and the projected gradient is at most CERTIFICATE of the product with the data. For the
    fit: the objective never rose, and the iteration converged.
    """
    f = fitted(spark, sf_dir)
    cells = f.rows.select("doc_id", F.explode(F.arrays_zip("indices", "values")).alias("z"))
    cells = cells.select(F.col("doc_id").alias("id"), F.col("z.indices").cast("long").alias("term_index"), F.col("z.values").alias("value"))
    w = NMF.long_factor(f.model.W, "doc_id", "w").withColumnRenamed("doc_id", "id")
    sides = NMF.stationarity(cells, w, f.factor).select("side", (F.col("least") >= 0).alias("not_negative"), (F.col("residual") <= CERTIFICATE).alias("stationary"))
    falls = all(b <= a * (1 + 1e-12) for a, b in zip(f.model.objective, f.model.objective[1:]))
    return sides.unionByName(spark.createDataFrame([("fit", falls, f.model.converged)], "side string, not_negative boolean, stationary boolean"))


def assignments(docs: DataFrame, weights: DataFrame, labels: dict[int, str] | DataFrame) -> DataFrame:
    """Every document with its dominant topic; NULL for documents without weights (spam, short, empty).

    ``weights``: (doc_id, w array); ``labels``: a map, or (topic_id, topic_label).
    """
    topics = weights.select("doc_id", TX.dominant_topic("w").alias("topic_id"))
    out = docs.select("doc_id").join(topics, "doc_id", "left")
    if isinstance(labels, dict):
        return out.withColumn("topic_label", F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[F.col("topic_id")])
    return out.join(labels, "topic_id", "left").select("doc_id", "topic_id", "topic_label")


def _assigned(spark, sf_dir) -> DataFrame:
    f = fitted(spark, sf_dir)
    return assignments(Tables(spark, sf_dir).documents, f.model.W, topic_labels(f.top))


@register("t8_topic_assignment")
def t8_topic_assignment(spark, sf_dir):
    return _assigned(spark, sf_dir)


@register("t10_topic_sizes")
def t10_topic_sizes(spark, sf_dir):
    """Answers and share per topic."""
    return TX.topic_sizes(_assigned(spark, sf_dir)).select("topic_id", "answers", SF.rounded("share").alias("share"))


@register("t11_stability_trial")
def t11_stability_trial(spark, sf_dir):
    """Per trial and topic of the full fit its partner in the refit, their cosine, whether the topic kept its place
    (reorder) and whether it survives; every number of the match matrix is a row of its own in ``cosines``."""
    t = _tables(spark.sparkContext.applicationId, sf_dir)
    rows = []
    for x in stability_trials(t):
        for i, j in enumerate(x["partner"]):
            rows.append((x["drop"], x["seed"], i, j, float(x["cosine"][i, j]), i == j, bool(x["cosine"][i, j] >= SURVIVES), [float(c) for c in x["cosine"][i]]))
    return spark.createDataFrame(rows, "drop double, seed int, topic_id int, partner_id int, cosine double, same_place boolean, survives boolean, cosines array<double>")


# ---------------------------------------------------------------- T4, T5, T7, T8, T10 on a factor table that SQL can build

@dataclass
class SourceFactor:
    """The sources as topics: a topic's weight of a term is the sum of its documents' TF-IDF weights, a document's weight of a
    topic is the product of the two rows; rounded, so that both engines rank equal values alike."""

    vocab: DataFrame
    names: DataFrame      # (topic_id, source)
    terms: DataFrame      # (term_index, topic_id, weight)
    weights: DataFrame    # (doc_id, w array)


def source_factor(t: Tables) -> SourceFactor:
    blocks = model_blocks(t)
    vocab = stored(model_vocabulary(blocks).select("term", "term_index", "idf"))
    rows = stored(TX.block_rows(blocks, vocab, "doc_id"), "zstd")
    sources = t.documents.select("doc_id", "source").where("source is not null")
    from starlift.operators.warehouse import assign_keys
    names = assign_keys(sources.select("source").distinct(), ["source"], "topic_id", start=0).select(F.col("topic_id").cast("int").alias("topic_id"), "source")
    named = stored(names)
    own = sources.join(named, "source").select("doc_id", "topic_id")
    cells = rows.join(own, "doc_id").select("topic_id", F.explode(F.arrays_zip("indices", "values")).alias("z"))
    terms = stored(cells.groupBy(F.col("z.indices").cast("long").alias("term_index"), "topic_id").agg(F.round(F.sum("z.values"), 6).alias("weight")))
    weights = NMF.row_weights(rows, "doc_id", terms, named.count(), 10**6)
    return SourceFactor(vocab, named, terms, weights.withColumn("w", F.transform("w", lambda x: F.round(x, 6))))


FACTOR_SQL = "WITH " + MODEL_SQL.strip() + """,
x0 AS (SELECT tf.doc_id, tf.term, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term),
x AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM x0),
names AS (SELECT source, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS topic_id FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)),
h AS (SELECT x.term, n.topic_id, round(sum(value), 6) AS weight FROM x JOIN documents d ON d.doc_id = x.doc_id JOIN names n ON n.source = d.source GROUP BY ALL),
wt AS (SELECT x.doc_id, h.topic_id, round(sum(value * weight), 6) AS weight FROM x JOIN h ON h.term = x.term GROUP BY ALL),
top AS (SELECT topic_id, CAST(row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) AS INTEGER) AS rank, term, weight FROM h
        WHERE weight > 0 QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) <= 10),
labels AS (SELECT topic_id, string_agg(term, ' / ' ORDER BY rank) FILTER (WHERE rank <= 2) AS topic_label, string_agg(term, ', ' ORDER BY rank) AS top_terms FROM top GROUP BY topic_id),
main AS (SELECT doc_id, topic_id FROM wt WHERE weight > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, topic_id) = 1),
assigned AS (SELECT d.doc_id, main.topic_id, labels.topic_label FROM documents d LEFT JOIN main ON main.doc_id = d.doc_id LEFT JOIN labels ON labels.topic_id = main.topic_id)
"""


def _labelled(f: SourceFactor) -> DataFrame:
    """(topic_id, topic_label, top_terms) from the top terms; TOP_TERMS rows a topic."""
    top = NMF.top_terms(f.terms, f.vocab, TOP_TERMS).groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("t"))
    return top.select("topic_id", F.array_join(F.slice("t.term", 1, 2), " / ").alias("topic_label"), F.array_join("t.term", ", ").alias("top_terms"))


@register("t4_dominant_topic", FACTOR_SQL + "SELECT doc_id, topic_id FROM main")
def t4_dominant_topic(spark, sf_dir):
    """T4: argmax of the row's weights, ties to the lowest index, on the factor of the sources."""
    f = source_factor(Tables(spark, sf_dir))
    return f.weights.select("doc_id", TX.dominant_topic("w").alias("topic_id")).where("topic_id is not null")


@register("t5_top_terms", FACTOR_SQL + "SELECT topic_id, rank, term, weight FROM top")
def t5_top_terms(spark, sf_dir):
    """T5: the ten heaviest terms of each topic, highest first, ties by term."""
    f = source_factor(Tables(spark, sf_dir))
    return NMF.top_terms(f.terms, f.vocab, TOP_TERMS)


@register("t7_topic_artifact", FACTOR_SQL + f"""SELECT '{MODEL_VERSION}' AS model_version, topic_id AS component_id, topic_label, top_terms FROM labels""")
def t7_topic_artifact(spark, sf_dir):
    """(model_version, component_id, topic_label, top_terms)."""
    f = source_factor(Tables(spark, sf_dir))
    return _labelled(f).select(F.lit(MODEL_VERSION).alias("model_version"), F.col("topic_id").alias("component_id"), "topic_label", "top_terms")


@register("t8_factor_assignment", FACTOR_SQL + "SELECT doc_id, topic_id, topic_label FROM assigned")
def t8_factor_assignment(spark, sf_dir):
    """Every document with the dominant topic and label of the factor of the sources, NULL where it has none."""
    t = Tables(spark, sf_dir)
    f = source_factor(t)
    return assignments(t.documents, f.weights, _labelled(f).select("topic_id", "topic_label"))


@register("t10_factor_sizes", FACTOR_SQL + """SELECT topic_id, count(*) AS answers, round(count(*) * 1.0 / sum(count(*)) OVER (), 6) + 0.0 AS share
FROM assigned WHERE topic_id IS NOT NULL GROUP BY topic_id""")
def t10_factor_sizes(spark, sf_dir):
    """Answers and share per topic of the factor of the sources."""
    t = Tables(spark, sf_dir)
    f = source_factor(t)
    sizes = TX.topic_sizes(assignments(t.documents, f.weights, _labelled(f).select("topic_id", "topic_label")))
    return sizes.select("topic_id", "answers", SF.rounded("share").alias("share"))
