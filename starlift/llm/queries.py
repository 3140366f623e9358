"""The numbered queries of this subpackage, their DuckDB statements, and the corpus pipeline."""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift.llm import (decontaminate, exact_dedup, lexical, license_scan, merkle, mixing, ngram_join, quality_knn, secret_scan, simhash_pivots, suffix_dedup,
                          token_counts, token_output)
from starlift.llm.common import documents

VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.materialise(documents(spark, sf_dir), token_counts.vocabulary_path(VOCABULARY))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir), keep="largest")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.jaccard_components(documents(spark, sf_dir), words=3, threshold=(90, 100))
    return out.select("doc_id", "n_shingles", "component_id", "n_links")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), token_counts.vocabulary_path(VOCABULARY))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.classify(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources at the target weights of the corpus."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    return mixing.mix(docs, mixing.WEIGHTS)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op11_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pivots.simhash_components(documents(spark, sf_dir))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"), lexical.TOP)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_token_output, op2_exact_dedup, op3_suffix_dedup, op4_ngram_jaccard_join, op5_license_scan, op6_secret_scan, op7_token_counts,
                                   op8_quality_classifier, op9_mixing, op10_decontamination, op11_simhash_pivots, op12_lexical_search, op13_merkle_manifest, pipeline)}

#: A-Z only; ``lower`` would fold other letters too.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _strings(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _license_sql() -> str:
    """Every block compared with every template, every place with every phrase."""
    sets = [(label, sorted(set(t.split())), told.split()) for label, t, told in license_scan.TEMPLATES]
    templates = ", ".join(f"('{label}', {_strings(ws)}, {math.ceil(license_scan.CONTAINMENT * len(ws) - 1e-9)}, {_strings(told)})" for label, ws, told in sets)
    phrases = ", ".join(f"('{label}', {_strings(p.split())})" for p, label in license_scan.PHRASES.items())
    vocabulary = _strings(sorted({w for _, ws, _ in sets for w in ws}))
    block, stride = license_scan.BLOCK, license_scan.STRIDE
    return f"""
        WITH w AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
        templates(label, ws, need, told) AS (VALUES {templates}),
        phrases(label, ws) AS (VALUES {phrases}),
        cut AS (
            SELECT r, unnest(list_transform(range(0, CAST(greatest(ceil((len(ws) - {block}) / {stride}.0), 0) AS BIGINT) + 1),
                                            lambda b: list_filter(ws[b * {stride} + 1 : b * {stride} + {block}], lambda x: list_contains({vocabulary}, x)))) AS ws
            FROM w),
        near AS (
            SELECT r, label, len(list_intersect(cut.ws, templates.ws)) / CAST(len(templates.ws) AS DOUBLE) AS share
            FROM cut, templates WHERE len(list_intersect(cut.ws, templates.ws)) >= need AND list_has_all(cut.ws, told)),
        place AS (
            SELECT r, label, unnest(list_filter(range(0, len(w.ws) - len(phrases.ws) + 1), lambda i: w.ws[i + 1 : i + len(phrases.ws)] = phrases.ws)) AS word
            FROM w, phrases),
        base AS (SELECT r, count(*) AS n, min(word) AS lo, max(word) AS hi, list(DISTINCT label) AS labels FROM place GROUP BY r),
        found AS (SELECT r, count(*) AS n, max(share) AS share, list(DISTINCT label) AS labels FROM near GROUP BY r)
        SELECT doc_id, len(ws) AS n_words, coalesce(base.n, 0) AS n_base, lo AS first_word, hi AS last_word,
               array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
               CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(found.share, 0.0) END AS score, coalesce(found.n, 0) AS n_blocks
        FROM w LEFT JOIN base USING (r) LEFT JOIN found USING (r)"""


def _merkle_sql() -> str:
    """Both trees level by level, siblings by their place, folded roots step by step."""
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(more: int) -> str:
        return "sha256(" + " || ".join(field(f"(n_chars + {more})" if c == "n_chars" else c) for c in merkle.DOCUMENT_COLUMNS) + ")"

    # reflected CRC-32, bit by bit
    crc = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)), lambda a, b:
                 list_reduce(range(0, 8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), xor(a, b)), 4294967295), 4294967295)"""
    return f"""
        WITH RECURSIVE d AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, {leaf(0)} AS leaf,
                   CASE WHEN doc_id IS NOT NULL AND {crc} % 7 = 0 THEN {leaf(1)} END AS tampered FROM documents),
        leaves AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
        nodes(tree, level, pos, n, h) AS (
            SELECT tree, 0, pos, n, leaf FROM leaves
            UNION ALL SELECT tree, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2),
        low AS MATERIALIZED (SELECT * FROM nodes),
        subroots AS MATERIALIZED (
            SELECT tree, level AS height, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
        tops(level, pos, n, h) AS (
            SELECT 0, pos, n, subroot FROM subroots
            UNION ALL SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2),
        high AS MATERIALIZED (SELECT * FROM tops),
        steps AS MATERIALIZED (
            SELECT r, x.level, y.h, y.pos < x.pos AS before
            FROM leaves JOIN low x ON x.tree = leaves.tree AND x.pos = leaves.pos >> x.level AND x.n > 1
            LEFT JOIN low y ON y.tree = x.tree AND y.level = x.level AND y.pos = xor(x.pos, 1)
            UNION ALL
            SELECT r, s.height + x.level, y.h, y.pos < x.pos
            FROM leaves JOIN subroots s ON s.tree = leaves.tree JOIN high x ON x.pos = s.pos >> x.level AND x.n > 1
            LEFT JOIN high y ON y.level = x.level AND y.pos = xor(x.pos, 1)),
        folded(r, level, h) AS (
            SELECT r, 0, coalesce(tampered, leaf) FROM leaves
            UNION ALL
            SELECT f.r, f.level + 1, sha256(CASE WHEN s.before THEN s.h ELSE '' END || f.h || CASE WHEN s.before THEN '' ELSE coalesce(s.h, '') END)
            FROM folded f JOIN steps s ON s.r = f.r AND s.level = f.level),
        proof AS (SELECT r, sha256(coalesce(string_agg(h, '' ORDER BY level), '')) AS proof_sha256 FROM steps GROUP BY r),
        last AS (SELECT r, arg_max(h, level) AS folded_root FROM folded GROUP BY r)
        SELECT doc_id, leaf, subroot, root.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root.h AS verified
        FROM leaves JOIN subroots USING (tree) JOIN last USING (r) LEFT JOIN proof USING (r), (SELECT h FROM high WHERE n = 1) AS root"""


ORACLE_SQL = {
    "op2_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_LOWER} AS t FROM documents) WINDOW w AS (PARTITION BY t)""",
    # distinct sets first, so copies meet once; then every pair that shares a shingle, and reachability by links
    "op4_ngram_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        s AS MATERIALIZED (
            SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i : i + 2], ' ')) END)) AS sh FROM w),
        c AS MATERIALIZED (SELECT sh, len(sh) AS n, min(doc_id) AS node, count(*) AS copies FROM s WHERE len(sh) > 0 GROUP BY sh),
        g AS MATERIALIZED (SELECT node, n, unnest(sh) AS x FROM c),
        links AS MATERIALIZED (
            SELECT a.node AS a, b.node AS b FROM g a JOIN g b ON a.x = b.x AND a.node <> b.node AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
            GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        reach(node, other) AS (
            SELECT node, node FROM c UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
        comp AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
        near AS (SELECT links.a AS node, CAST(sum(c.copies) AS BIGINT) AS n FROM links JOIN c ON c.node = links.b GROUP BY links.a)
        SELECT s.doc_id, len(s.sh) AS n_shingles, coalesce(comp.component_id, s.doc_id) AS component_id,
               coalesce(c.copies - 1, 0) + coalesce(near.n, 0) AS n_links
        FROM s LEFT JOIN c ON s.sh = c.sh LEFT JOIN comp ON comp.node = c.node LEFT JOIN near ON near.node = c.node""",
    "op5_license_scan": _license_sql(),
    # every document scored for every item
    "op12_lexical_search": f"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_TERMS}') AS ws FROM documents),
        i AS MATERIALIZED (SELECT row_number() OVER () AS i, item_id, unnest(list_distinct(regexp_extract_all({_LOWER}, '{_TERMS}'))) AS t FROM benchmark),
        s AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
        tf AS MATERIALIZED (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY r, t),
        w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY t),
        m AS (SELECT r, doc_id, 100 - 50 + ((50 * len(ws) * n_docs) // n_terms) AS m FROM d, s),
        scored AS (SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
                   FROM i JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY i, r),
        placed AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 50""",
    "op13_merkle_manifest": _merkle_sql(),
}
