"""Registered queries of the package: thin digests over the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tastemap.llm import (ann, best_fit, byte_bpe, jaccard_join, langid, licenses, packing, pii, pivot_clusters,
                          topk_search, toxicity, url_lists, vector_codes)
from tastemap.sources.tables import load_table

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_threshold_topk(spark, sf):
    return topk_search.top_k(load_table(spark, sf, "embeddings", ["vec_id", "embedding"]))


def op2_adaptive_dimension_ann(spark, sf):
    return ann.nearest(load_table(spark, sf, "embeddings", ["vec_id", "embedding"]))


def op3_sum_of_squares_packing(spark, sf):
    pieces = packing.pack_documents(load_table(spark, sf, "documents", ["doc_id", "text"]), WORD_VOCABULARY)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op4_temporal_url_filter(spark, sf):
    return url_lists.judge_pages(load_table(spark, sf, "pages", ["page_id", "url"]))


def op5_skip_chain_pii(spark, sf):
    return pii.report(load_table(spark, sf, "documents", ["doc_id", "text"]))


def op6_licence_sentences(spark, sf):
    return licenses.scan(load_table(spark, sf, "documents", ["doc_id", "text"]))


def op7_language_id(spark, sf):
    return langid.identify(load_table(spark, sf, "documents", ["doc_id", "text", "lang"]))


def op8_toxic_spans(spark, sf):
    return toxicity.rate(load_table(spark, sf, "documents", ["doc_id", "text"]),
                         load_table(spark, sf, "labels", ["doc_id", "toxic"]))


def op9_byte_bpe(spark, sf):
    ids = byte_bpe.encode(load_table(spark, sf, "documents", ["doc_id", "text"]), BYTE_VOCABULARY,
                          public_tokenizers.PATTERN, decoded=True)
    return ids.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_ngram_jaccard_join(spark, sf):
    return jaccard_join.join_components(load_table(spark, sf, "documents", ["doc_id", "text"]))


def op11_cover_tree_codes(spark, sf):
    return vector_codes.compress(load_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"]))


def op12_swap_best_fit(spark, sf):
    pieces = best_fit.pack(load_table(spark, sf, "documents", ["doc_id", "text"]), WORD_VOCABULARY)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_ptolemaic_clusters(spark, sf):
    return pivot_clusters.cluster(load_table(spark, sf, "embeddings", ["vec_id", "embedding"]))


QUERIES = {
    "op1_threshold_topk": op1_threshold_topk,
    "op2_adaptive_dimension_ann": op2_adaptive_dimension_ann,
    "op3_sum_of_squares_packing": op3_sum_of_squares_packing,
    "op4_temporal_url_filter": op4_temporal_url_filter,
    "op5_skip_chain_pii": op5_skip_chain_pii,
    "op6_licence_sentences": op6_licence_sentences,
    "op7_language_id": op7_language_id,
    "op8_toxic_spans": op8_toxic_spans,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_cover_tree_codes": op11_cover_tree_codes,
    "op12_swap_best_fit": op12_swap_best_fit,
    "op13_ptolemaic_clusters": op13_ptolemaic_clusters,
}

ORACLE_SQL = {
    "op1_threshold_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op4_temporal_url_filter": url_lists.SQL,
    "op6_licence_sentences": licenses.sql(),
    "op11_cover_tree_codes": vector_codes.SQL,
    "op13_ptolemaic_clusters": pivot_clusters.SQL,
}
