"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (op1_wrappers, op2_posting_lists, op3_mix, op4_toxicity, op5_license, op7_token_records, op8_packing,
               op9_stream_dedup, op10_url_filter, op11_whitening, op12_sharding, op13_prefix_trie)
from . import op6_ngram_join as ngram_join

WORD_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return op1_wrappers.main_text(_table(spark, sf_dir, "pages"))


def op2_posting_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th embedding."""
    return op2_posting_lists.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op3_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return op3_mix.taken(_table(spark, sf_dir, "documents"))


def op4_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return op4_toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases of every document."""
    return op5_license.scan(_table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return ngram_join.link_rows(_table(spark, sf_dir, "documents"))


def op7_token_records_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token records of all documents hold."""
    return op7_token_records.digest(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op8_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences."""
    return op8_packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


def op9_stream_dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal documents stays, for every document."""
    return op9_stream_dedup.dedup_rows(_table(spark, sf_dir, "documents"))


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    rules = op10_url_filter.rules_frame(spark, op10_url_filter.BASE_RULES)
    return op10_url_filter.judge(_table(spark, sf_dir, "pages"), rules)


def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened components of every embedding."""
    return op11_whitening.components(_table(spark, sf_dir, "embeddings"))


def op12_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return op12_sharding.sharded(_table(spark, sf_dir, "documents"))


def op13_prefix_trie_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return op13_prefix_trie.contract_nodes(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_wrapper_text, op2_posting_search, op3_systematic_mix, op4_toxicity_scores, op5_license_scan,
        op6_ngram_join, op7_token_records_digest, op8_harmonic_packing, op9_stream_dedup_rows, op10_url_verdicts,
        op11_feast_whitening, op12_byte_shards, op13_prefix_trie_nodes)}
