"""The queries of this folder's operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import attach
from . import annulus, block_max, bpe, exact_dedup, html_text, ngram_join, packing, piece_bpe, pii, quality, sharding, toxicity, vptree


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return attach(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=8)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(_table(spark, sf_dir, "pages"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest_neighbours(_table(spark, sf_dir, "embeddings"), k=5, every=50)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(_table(spark, sf_dir, "documents"), n=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.piece_digests(_table(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annulus.cluster(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, salt=2)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_max.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_exact_dedup, op2_bpe, op3_sharding, op4_toxicity, op5_pii, op6_html_text, op7_nearest, op8_quality, op9_packing, op10_ngram_join, op11_pieces, op12_clusters, op13_search]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": """
            WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
            FROM t WINDOW w AS (PARTITION BY norm)""",
        "op10_ngram_join": r"""
            WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x != '') AS w FROM documents),
            s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
            n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
            o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
            e AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 90 * (x.n + y.n - k)),
            sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
            r(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT sym.b, r.c FROM r JOIN sym ON r.id = sym.a),
            c AS (SELECT id, min(c) AS component_id FROM r GROUP BY id)
            SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.id = d.doc_id""",
        "op12_clusters": annulus.cluster_sql(),
        "op13_search": block_max.search_sql(),
    }
