"""Corpus pipeline over ``documents``: quality rules, near-dedup, decontamination, source mixing, token files.

Each stage works on all that its predecessor kept and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geolist.llm import common, decontaminate, mixing, quality_trees, simhash, token_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees keep.

    Null and empty texts have no words and go; rows with null ids are judged by their text; repeated rows share a
    verdict and all stay or go.
    """
    model = quality_trees.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_trees.drop_low_quality(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies (five-word shingles, similarity 0.8).

    That with the smallest id stays, one with a null id only if the group has no other.  Null texts count as
    empty; all texts without words that are equal are one group.  Of repeated rows one stays.
    """
    return simhash.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts and items hold and match nothing; rows with null ids are told apart by their text.
    """
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source of its own; a text without words counts one token; rows without an id are drawn by
    their text.  Repeating and leaving out rows is what this stage does.
    """
    return mixing.apply_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: ``doc_id, start, n_tokens, ids_crc32``.

    Null texts are documents of one end id; null ids come first; repeated rows are written as often as they come.
    """
    from public_tokenizers import path

    written = token_files.write_tokens(docs, path("word_bpe_49k.json"))
    return token_files.with_crc(token_files.read_tokens(spark, written))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("mix", mixed), ("tokens", tokens)]

#: Boosted trees, SimHash and the tokenizer have no SQL equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = common.staged(docs)
    return docs
