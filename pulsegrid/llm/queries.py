"""The registered opN queries: thin digests of the operators, over whole
tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import crosstok, epsgrid, hamming, htmltext, langid, mixing, neardup, packing, ppm, quality, sharding, tokenfile, variants
from pulsegrid.llm.common import doc_remainder


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.even_tree(40)
    rows = sharding.shard_rows(_t(spark, sf_dir, "documents"), tree, sharding.with_shard(tree))
    return rows.withColumn("law", F.lit("key"))


def op2_span_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    held = doc_remainder(F.col("doc_id"), 3) == 1
    model = langid.fit_languages(docs.where(~held))
    return langid.label_languages(docs, model, spans=False).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op3_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_t(spark, sf_dir, "documents"))


def op5_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, _t(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id", (doc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_t(spark, sf_dir, "documents"), tokenizer_path())


def op6_multi_index_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _t(spark, sf_dir, "embeddings").withColumn("code", hamming.sign_code(F.col("embedding")))
    return hamming.top_k(codes, F.col("vec_id") % 50 == 0)


def op8_style_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(_t(spark, sf_dir, "pages"))


def op9_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsgrid.near_vectors(_t(spark, sf_dir, "embeddings"))


def op7_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_t(spark, sf_dir, "documents"))


def op10_partial_matching_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    scored = ppm.score_documents(docs, doc_remainder(F.col("doc_id"), 10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(_t(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op12_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = crosstok.align_documents(_t(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_bloom_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_t(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {f.__name__: f for f in (
    op1_hash_tree_shards, op2_span_language, op3_bottom_k_near_duplicates, op4_best_fit_packing, op5_rule_quality,
    op6_multi_index_top_k, op7_pareto_mix, op8_style_tree_text, op9_epsilon_grid_join,
    op10_partial_matching_scores, op11_arrow_token_files, op12_diagonal_alignment,
    op13_bloom_spelling_variants)}

ORACLE_SQL: dict[str, str] = {
    "op6_multi_index_top_k": """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS b FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0),
d AS (SELECT q.vec_id AS query_id, o.vec_id AS neighbour_id,
             CAST(list_sum(list_transform(list_zip(q.b, o.b), lambda z: CAST(z[1] <> z[2] AS INTEGER))) AS BIGINT) AS distance
      FROM c q CROSS JOIN c o WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, neighbour_id, distance FROM r WHERE rank <= 10""",
    "op9_epsilon_grid_join": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT *, sqrt(list_dot_product(e, e)) AS size FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
r AS (SELECT vec_id AS v, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.v)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, r.c AS component_id, e.vec_id = r.c AS kept
FROM embeddings e JOIN (SELECT v, min(c) AS c FROM r GROUP BY v) r ON r.v = e.vec_id""",
}
