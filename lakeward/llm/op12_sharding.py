"""Contiguous shards of equal bytes from global prefix sums.

Rows are put in one order and written in range partitions. The partitions' totals (one row each),
added up, give every partition's offset in bytes and rows. With B bytes in all and k shards, a row
goes to the shard in which the middle of its bytes lies, so the cuts are at B/k, 2B/k ...: a shard
is a contiguous run of rows, and misses B/k by no more than half the size of the rows at its two
ends. Only partitions in which a cut falls (k - 1 at most) are read again to find the row.

The order is by a digest of the text, then doc_id: copies of a text stand side by side and only a
cut can part them (a group larger than a shard has to be cut), and each shard is a fair mix of the
table. Other columns can be given as order. The sorted files are the shards' files: the manifest
says which run of which file belongs to which shard, so texts are written once.

Defined edge cases: a null text is empty and has size 1 (no bytes plus 1); null doc_ids come first
among equal texts; rows equal in all order columns follow their place in the table, so repeated
rows, however many, spread over ranges; fewer rows than shards leave shards empty; an empty table
gives an empty manifest and result; extra columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import packed, text_or_empty, width

SHARDS = 8


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text plus 1."""
    return F.octet_length(text).cast("bigint") + 1


def text_order() -> list[Column]:
    """Equal texts side by side, in a mixed order of texts."""
    return [F.unhex(F.sha2(text_or_empty(), 256)), F.col("doc_id")]


def _shard(middle_twice: Column, total: Column, shards: int) -> Column:
    """Shard of a place, given as twice the bytes before it; exact for any sizes."""
    places = F.lit(shards).cast("decimal(10,0)") * middle_twice.cast("decimal(27,0)")
    share = F.call_function("div", places, 2 * total.cast("decimal(27,0)"))
    return F.least(share, F.lit(shards - 1)).cast("int")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, order: list[Column] | None = None,
                 size: Column | None = None) -> DataFrame:
    """Write ``docs`` to ``folder`` in shard order: the manifest.

    Files under ``rows``: ``row`` (the columns of ``docs``), ``size``, ``part`` and ``at`` (the row's
    number in its file). Manifest: shard, file, part, first (``at``), rows, bytes, slot (of the first).
    """
    spark, order = docs.sparkSession, order or text_order()
    keyed = packed(docs, size=size_of(text_or_empty()) if size is None else size,
                   place=F.monotonically_increasing_id(), **{f"order{k}": c for k, c in enumerate(order)})
    by = [F.col(f"order{k}").asc_nulls_first() for k in range(len(order))] + [F.col("place").asc()]
    number = F.monotonically_increasing_id()  # partition << 33 | row in it
    sorted_ = keyed.repartitionByRange(width(spark), *by).sortWithinPartitions(*by) \
        .select("row", "size", F.shiftright(number, 33).cast("int").alias("part"),
                number.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    sorted_.write.parquet(f"{folder}/rows")
    rows = spark.read.schema(sorted_.schema).parquet(f"{folder}/rows")

    # one row per partition: its totals and what comes before it
    totals = rows.select("part", "size", F.input_file_name().alias("file")).groupBy("part", "file") \
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("part", "file", "bytes", "rows", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"),
                           F.sum("bytes").over(everything).alias("total"))
    first, last = (_shard(2 * F.col("start") + x, F.col("total"), shards) for x in (F.lit(0), 2 * F.col("bytes")))
    totals = totals.withColumn("shard", first).withColumn("cut", last > first)

    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.select("part", "at", "size").join(totals.filter("cut").select("part", "file", "start", "total"), "part") \
        .withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .groupBy("part", "file", _shard(2 * F.col("before") + F.col("size"), F.col("total"), shards).alias("shard")) \
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
    columns = ["shard", "file", "part", "first", "rows", "bytes"]
    runs = totals.filter(~F.col("cut")).withColumn("first", F.lit(0).cast("bigint")).select(columns) \
        .unionByName(cut.select(columns))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = runs.withColumn("slot", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of the shards: ``row``, ``size``, ``shard`` and ``slot``.

    The manifest has a row per file and cut, so it is joined as the small side it is.
    """
    rows, runs = spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/manifest")
    runs = runs.select("part", "shard", "first", F.col("rows").alias("n"), "slot")
    return rows.join(runs, "part").filter("at >= first and at < first + n") \
        .select("row", "size", "shard", (F.col("slot") + F.col("at") - F.col("first")).alias("slot"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Write the shards of ``docs`` and return what they hold, per document."""
    spark, folder = docs.sparkSession, scratch_path(docs.sparkSession, "shards")
    write_shards(docs, folder, shards)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return read_shards(spark, folder).select(
        F.col("row.doc_id").alias("doc_id"), "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
