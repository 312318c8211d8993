"""Exact deduplication with durable streaming state.

1. Every row leaves a fingerprint (doc_id, SHA-256 of the text, content locator) in the shared
   folder.
2. A Structured Streaming query reads the fingerprints in file batches and keeps, per digest and
   without expiry, the number of rows, the stable identifier (largest doc_id) and its content
   locator. The state lives in RocksDB on the executors' disks, with its change log and snapshots
   in the shared folder; a lost executor restores it from there. The aggregation combines on the
   map side, so a digest that a third of all rows share is one row per task.
3. Digests seen more than once are hits: their rows' full texts are compared byte by byte (grouped
   by digest and text, again combined on the map side). If texts with one digest differ, each text
   is its own class.

Defined edge cases: null text counts as the empty text. A null doc_id is smaller than any other.
Rows that agree in doc_id and text are repeats of one document: ``dedup_rows`` marks them all as
kept, ``distinct_documents`` leaves one of them (which one, if other columns differ, is not
defined). An empty table gives an empty result. Extra columns are carried by
``distinct_documents`` and ignored by ``dedup_rows``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import packed, settings, text_or_empty, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Hit digests are announced to the scan by a prefix of so many hex digits: at most 16**5 =
#: 1,048,576 values, which bounds the broadcast whatever the input's size.
HIT_PREFIX_DIGITS = 5


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def _fingerprints(docs: DataFrame, digest: Callable[[Column], Column]) -> tuple[DataFrame, str]:
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    docs.select(
        "doc_id", digest(text_or_empty()).alias("digest"),
        F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("block")).alias("locator"),
    ).write.parquet(path)
    schema = "doc_id bigint, digest string, locator struct<file:string,block:bigint>"
    return spark.read.schema(schema).parquet(path), path


def keyed_state(spark: SparkSession, fingerprints: DataFrame, path: str, files_per_batch: int = 256) -> DataFrame:
    """Run the stream over the fingerprint files to their end and read its state.

    One row per digest: digest, n (rows), keep_id (largest doc_id), locator (of that row).
    """
    checkpoint = scratch_path(spark, "dedup-state")
    newest = F.max(F.struct("doc_id", "locator")).alias("best")
    stream = (
        spark.readStream.schema(fingerprints.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        .groupBy("digest").agg(F.count(F.lit(1)).alias("n"), newest)
    )
    with settings(spark, {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # all stores of an executor share one bounded cache and write buffer
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
        # a store takes the disk that its rows need, without blocks reserved ahead for its logs
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    }):
        query = (stream.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
                 .option("checkpointLocation", checkpoint).start())
        query.awaitTermination()
        failed = query.exception()
        if failed:
            raise failed
        state = spark.read.format("statestore").load(checkpoint)
        # the rows are copied out of the state store while its settings hold
        return written(state.select(
            F.col("key.digest").alias("digest"), F.col("value.count").alias("n"),
            F.col("value.max.doc_id").alias("keep_id"), F.col("value.max.locator").alias("locator")), "dedup-digests")


def _byte_classes(docs: DataFrame, state: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Classes of equal bytes among the hit digests: digest, tag (of the text), n, keep_id."""
    hits = state.filter("n > 1")
    prefixes = hits.select(F.substring("digest", 1, HIT_PREFIX_DIGITS).alias("prefix")).distinct()
    rows = docs.select("doc_id", text_or_empty().alias("text"), digest(text_or_empty()).alias("digest")) \
        .withColumn("prefix", F.substring("digest", 1, HIT_PREFIX_DIGITS)) \
        .join(F.broadcast(prefixes), "prefix", "left_semi")
    # the text itself is the grouping key: equal means equal in every byte
    classes = rows.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"))
    return written(classes.select("digest", F.sha2("text", 512).alias("tag"), "n", "keep_id"), "dedup-classes")


def _verdicts(docs: DataFrame, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fingerprints, classes by digest, classes by text of the digests that different texts share)."""
    spark = docs.sparkSession
    prints, path = _fingerprints(docs, digest)
    if not prints.take(1):
        empty = spark.createDataFrame([], "digest string, n bigint, keep_id bigint")
        return prints, empty, spark.createDataFrame([], "digest string, tag string, n bigint, keep_id bigint")
    state = keyed_state(spark, prints, path)
    classes = _byte_classes(docs, state, digest)
    shared = classes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest")
    collided = classes.join(shared, "digest", "left_semi")
    if not collided.take(1):
        return prints, state.select("digest", "n", "keep_id"), collided
    return prints, state.join(shared, "digest", "left_anti").select("digest", "n", "keep_id"), collided


def dedup_rows(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256; dropped rows too."""
    prints, classes, collided = _verdicts(docs, digest)
    columns = ("doc_id", "keep_id", F.col("n").alias("group_size"),
               F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    if digest is sha256_hex and not collided.take(1):
        return prints.join(classes, "digest").withColumn("text_sha256", F.col("digest")).select(*columns)
    texts = docs.select(
        "doc_id", digest(text_or_empty()).alias("digest"), F.sha2(text_or_empty(), 512).alias("tag"),
        sha256_hex(text_or_empty()).alias("text_sha256"))
    plain = texts.join(classes, "digest").select(*columns)
    return plain.unionByName(texts.join(collided, ["digest", "tag"]).select(*columns))


def distinct_documents(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per class of equal texts."""
    _, classes, collided = _verdicts(docs, digest)
    rows = packed(docs, identifier=F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                  digest=digest(text_or_empty()), tag=F.sha2(text_or_empty(), 512))

    def kept(rows: DataFrame, classes: DataFrame, by: list[str]) -> DataFrame:
        # one key for a document and its content: repeats of it combine on the map side, and the
        # join with the classes' survivors uses the same partitioning
        stays = classes.select(F.concat_ws(":", F.coalesce(F.col("keep_id").cast("string"), F.lit("null")), *by)
                               .alias("key"))
        return rows.select("row", F.concat_ws(":", "identifier", *by).alias("key")).dropDuplicates(["key"]) \
            .join(stays, "key", "left_semi").select("row.*")

    if not collided.take(1):
        return kept(rows, classes, ["digest"])
    shared = collided.select("digest").distinct()
    return kept(rows.join(shared, "digest", "left_anti"), classes, ["digest"]).unionByName(
        kept(rows.join(shared, "digest", "left_semi"), collided, ["digest", "tag"]))
