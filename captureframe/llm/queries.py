"""The queries of this subpackage's operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captureframe.llm import binary_tokens, context_mixing, decontaminate, line_templates, packing, simhash, topk_search, toxicity, url_graph, warc
from captureframe.llm.shared import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


@query("op1_nnpu_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), folds=5)


@query("op2_context_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(read_table(spark, sf_dir, "documents"), folds=7, held_fold=2)


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(read_table(spark, sf_dir, "documents"), capacity=4096, end_id=1)


@query(
    "op4_positional_index",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT cast(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    s AS (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0),
    g AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i + 1, i + k), ' ') AS gram FROM s),
    ks AS (SELECT DISTINCT k FROM g),
    p AS (SELECT doc_id, k, w, unnest(range(0, len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k),
    m AS (SELECT p.doc_id, p.i, p.k, g.item_id FROM (SELECT doc_id, i, k, array_to_string(list_slice(w, i + 1, i + k), ' ') AS gram FROM p) p JOIN g ON p.gram = g.gram AND p.k = g.k),
    h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS x FROM m) GROUP BY doc_id),
    t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM m GROUP BY doc_id)
    SELECT d.doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit, cast(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), width=10)


@query(
    "op5_zip_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, cast(octet_length(encode(html)) AS BIGINT) AS n, sha256(html) AS h FROM p),
    f AS (SELECT h, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY h)
    SELECT page_id, n AS payload_bytes, h AS payload_digest,
           CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first_id <> page_id THEN first_id END AS refers_to
    FROM d LEFT JOIN f USING (h)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"), min_revisit=100).drop("target_uri")


#: The query's rules: host, path prefix, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query(
    "op6_url_graph",
    r"""
    WITH RECURSIVE u AS (SELECT page_id, html, coalesce(url, '') AS url FROM pages),
    p AS (SELECT page_id, html, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM u),
    r(rh, rp, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    j AS (SELECT page_id, html, host, path, (SELECT max(struct_pack(n := length(rh) + length(rp), rule := rh || rp, v := rv)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS hit FROM p),
    s AS (SELECT host, avg((hit.v = 'allow')::INT::DOUBLE) AS good, avg((hit.v = 'block')::INT::DOUBLE) AS bad FROM j WHERE host <> '' AND hit IS NOT NULL GROUP BY host),
    l AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?(?:https?:)?//([^/?#"''\s<>]+)', 1)) AS raw FROM p),
    e AS (SELECT DISTINCT src, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM l WHERE src <> ''),
    fw AS (SELECT src, dst, 0.85::DOUBLE / count(*) OVER (PARTITION BY src) AS w FROM e WHERE src <> dst),
    bw AS (SELECT dst AS src, src AS dst, 0.85::DOUBLE / count(*) OVER (PARTITION BY dst) AS w FROM e WHERE src <> dst),
    t(k, host, m) AS (SELECT 0, host, good / (SELECT sum(good) FROM s) FROM s WHERE good > 0 UNION ALL SELECT k + 1, fw.dst, sum(m * w) FROM t JOIN fw ON t.host = fw.src GROUP BY k, fw.dst HAVING sum(m * w) > 1e-12),
    d(k, host, m) AS (SELECT 0, host, bad / (SELECT sum(bad) FROM s) FROM s WHERE bad > 0 UNION ALL SELECT k + 1, bw.dst, sum(m * w) FROM d JOIN bw ON d.host = bw.src GROUP BY k, bw.dst HAVING sum(m * w) > 1e-12),
    tt AS (SELECT host, sum(m) / (SELECT sum(m) FROM t) AS trust FROM t GROUP BY host),
    dd AS (SELECT host, sum(m) / (SELECT sum(m) FROM d) AS distrust FROM d GROUP BY host)
    SELECT page_id, j.host, path, hit.rule AS rule,
           coalesce(hit.v, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) * (1 + 1e-9::DOUBLE) THEN 'block' ELSE 'allow' END) AS verdict
    FROM j LEFT JOIN tt ON j.host = tt.host LEFT JOIN dd ON j.host = dd.host
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge(read_table(spark, sf_dir, "pages"), URL_RULES).drop("trust", "distrust")


@query("op7_ranked_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_tokens.round_trip(read_table(spark, sf_dir, "documents"), end_id=2)


@query("op8_line_templates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_templates.drop_recurring(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op9_block_max_bm25")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    asked = docs.where(F.col("doc_id") % 50 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return topk_search.search(docs, asked, k=10)


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
