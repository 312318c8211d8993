"""The corpus pipeline: documents -> toxicity -> exact dedup -> near dedup -> mix -> packed sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame; all but the last return the columns of ``documents``. ``run`` writes every stage to the
shared folder and reads it back, so a lost executor costs at most the running stage's tasks.

SQL cannot express the learnt score, the similarity join or the tokenizer: ORACLE_SQL is None and
the pipeline is tested against brute-force versions of its stages (tests/llm/test_pipeline.py).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeward.llm import op3_mix, op4_toxicity, op6_ngram_join, op8_packing, op9_stream_dedup
from lakeward.llm.common import written
from lakeward.llm.queries import BYTE_TOKENIZER

ORACLE_SQL = None

#: Rows handed to a Python worker at a time: documents are long, and a batch is held by the executor
#: and by its worker.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay."""
    _small_batches(spark)
    return op4_toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return op9_stream_dedup.distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents that with the smallest doc_id stays."""
    _small_batches(spark)
    return op6_ngram_join.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return op3_mix.mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in packed sequences."""
    _small_batches(spark)
    return op8_packing.pack(docs, public_tokenizers.path(BYTE_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
