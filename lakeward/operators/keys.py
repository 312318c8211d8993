"""Dense surrogate keys (1..n in a total order) without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into one task. Here the
rows are range-partitioned and sorted by the order columns, each row gets its index inside its
partition from ``monotonically_increasing_id`` (partition id in the upper bits), the per-partition
counts (one row per partition) are turned into offsets, and offset + index + 1 is the key. The
numbered frame is checkpointed to the shared checkpoint folder so that both passes see the same
partitioning and a lost executor recomputes from the checkpoint, not from the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | row index in partition


def dense_ids(df: DataFrame, order_cols: list[str], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name`` = 1..n following ``order_cols`` ascending (NULLs first; the order must
    be total for the keys to be reproducible)."""
    spark = df.sparkSession
    shared_dir(spark)  # checkpoint folder: the cluster's shared one, or a local one in tests
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    numbered = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                  .withColumn("_mid", F.monotonically_increasing_id())
                  .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
                  .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS))
                  .checkpoint(eager=True))
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a bounded table, ranked in a single small window
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    return (numbered.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
                    .withColumn(name, (F.col("_off") + F.col("_local") + 1).cast("long"))
                    .drop("_mid", "_pid", "_local", "_off"))
