"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, chat, decontam, divergence, lm_scoring, merkle, minhash, oracle, packing, quality, sharding, suffix_dedup,
               toxicity, url_tree)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_urls(pages: DataFrame) -> DataFrame:
    """``page_id, doc_id, url``: a url's last number is the id of the document that the page shows."""
    n = F.regexp_extract("url", "/([0-9]{1,18})(?:[.]html|/)?(?:[?#].*)?$", 1)
    return pages.select("page_id", "url", n.alias("n")).where("n <> ''").select(
        "page_id", F.col("n").cast("long").alias("doc_id"), "url")


def op1_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"),
                         document_urls(_table(spark, sf_dir, "pages")))


def op2_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.maximal_conversations(_table(spark, sf_dir, "conversations"))


def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op4_minhash_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleaved_shards(_table(spark, sf_dir, "documents"))


#: The rules that the contract fixes.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return document_urls(pages).join(labels, "doc_id").select("page_id", bad.alias("bad"))


def op9_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_tree.filter_urls(pages, page_labels(pages, _table(spark, sf_dir, "labels")), URL_RULES)


def op10_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def lower_az(c):
    """Text with A-Z, and nothing else, lower-cased."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def op11_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return lm_scoring.score(_table(spark, sf_dir, "documents"), held_out)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(_table(spark, sf_dir, "documents"), F.when(tampered, lower_az(F.col("text"))))


QUERIES = {f.__name__: f for f in (
    op1_quality_cotraining, op2_chat_snapshots, op3_adaptive_scan, op4_minhash_stars, op5_cost_packing,
    op6_spaced_seeds, op7_suffix_dedup, op8_interleaved_shards, op9_url_templates, op10_toxicity_nnpu,
    op11_attention_lm, op12_source_divergence, op13_merkle_manifest)}

ORACLE: dict[str, str] = {
    "op4_minhash_stars": """
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
            FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS items
            FROM w),
        n AS (SELECT doc_id, len(items) AS n FROM s),
        e AS (SELECT doc_id, md5_number(x) AS x FROM (SELECT doc_id, unnest(items) AS x FROM s)),
        p AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
            FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (
            SELECT u, v FROM p JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v
            WHERE 100 * shared >= 85 * (nu.n + nv.n - shared)),
        r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT l.v, r.seen FROM r JOIN l ON l.u = r.node)
        SELECT n.doc_id, n.n::BIGINT AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
        FROM n JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY node) c ON c.node = n.doc_id
    """,
    "op2_chat_snapshots": """
        WITH t AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
                   '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS line
            FROM conversations WHERE conv_id IS NOT NULL),
        p AS (SELECT conv_id, place, string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY place) AS head FROM t),
        w AS (SELECT conv_id, max(place) AS n, arg_max(head, place) AS body FROM p GROUP BY conv_id),
        k AS (SELECT min(conv_id) AS conv_id, n, body, count(*) - 1 AS copies FROM w GROUP BY n, body)
        SELECT k.conv_id, k.n::BIGINT AS n_turns, k.body AS rendered, k.copies::BIGINT AS n_snapshots
        FROM k WHERE NOT EXISTS (
            SELECT 1 FROM p JOIN w USING (conv_id) WHERE p.head = k.body AND p.place = k.n AND p.place < w.n)
    """,
    "op6_spaced_seeds": oracle.spaced_seeds(),
    "op9_url_templates": oracle.url_templates(URL_RULES),
    "op12_source_divergence": oracle.source_divergence(),
    "op13_merkle_manifest": oracle.merkle(),
}
