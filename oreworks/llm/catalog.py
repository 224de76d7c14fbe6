"""The text operators as queries over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.llm import (
    decontaminate,
    fingerprints,
    k2_treap,
    licenses,
    mixture,
    near_dedup,
    packing,
    prefix_trie,
    quality_gam,
    sharding,
    token_counts,
    toxicity,
    url_filter,
)
from oreworks.llm.common import read_table
from oreworks.llm.simhash import hex_text

# Tokens a document may have before it counts as over the limit.
TOKEN_LIMIT = 1024


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_groups(read_table(spark, sf_dir, "documents"))


def op2_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, read_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged_urls(read_table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_documents(read_table(spark, sf_dir, "documents"), file)


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = fingerprints.fingerprint_digest(read_table(spark, sf_dir, "documents"))
    return digest.withColumns({c: hex_text(F.col(c)) for c in ("fingerprint", "edited_fingerprint")})


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), file, TOKEN_LIMIT)


def op11_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path("byte_bpe_50k.json")
    return mixture.mixture_digest(read_table(spark, sf_dir, "documents"), file)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k2_treap.ranked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_digest(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_label_propagation_shards": op2_label_propagation_shards,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_license_scan": op8_license_scan,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_mixture_packing": op11_mixture_packing,
    "op12_ranked_search": op12_ranked_search,
    "op13_conversation_prefix_trie": op13_conversation_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op8_license_scan": licenses.oracle_sql(),
    "op12_ranked_search": k2_treap.oracle_sql(),
    "op13_conversation_prefix_trie": prefix_trie.oracle_sql(),
}
