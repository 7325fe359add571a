"""Registered queries of the operators for training data, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, merkle, mixing, neural_lm, prefix_trie, quality_trees, rtree_join, sharding, simhash, substring_dedup, token_files, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neural_lm.score_documents(_table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path as tokenizer_path

    path = token_files.write_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return token_files.with_crc(token_files.read_tokens(spark, path))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_trees.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return quality_trees.quality_rules(docs, model)


def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.histogram_shards(_table(spark, sf_dir, "documents"))


def op8_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents."""
    return decontaminate.leaky_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def op11_rtree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rtree_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_log_bilinear": op1_log_bilinear,
    "op2_token_files": op2_token_files,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_warc": op5_warc,
    "op6_quality_rules": op6_quality_rules,
    "op7_histogram_shards": op7_histogram_shards,
    "op8_temperature_mix": op8_temperature_mix,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_rtree_join": op11_rtree_join,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op8_temperature_mix": mixing.mix_sql("documents"),
    "op9_substring_dedup": substring_dedup.REPEATS_SQL,
    "op12_prefix_trie": prefix_trie.prefix_trie_sql(),
    "op13_merkle_manifest": merkle.manifest_sql(),
}
