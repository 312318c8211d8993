"""Incremental quality gate over a landing folder (Structured Streaming).

Raw trip files dropped into a landing folder are picked up by the parquet file stream source;
every micro-batch is flagged by the same rules as the batch gate and written by the parquet file
sink partitioned by ``dq_pass`` (passed rows and quarantine in one write). The sink's own
metadata log makes the output exactly-once across restarts: a batch re-run after a lost
executor or driver replaces nothing that was committed, and readers of the sink folder see only
committed files. The per-batch report counts ride on the write as an observation (``observe``
on a streaming frame is reported in each batch's progress), so no batch is scanned twice.

Offsets and the sink log live in ``checkpoint`` — a folder on shared storage (by default a
sub-folder of the session's ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality as q
from ..session import scratch_path

REPORT_NAME = "quality_gate_batch"


def gate_landing_stream(spark: SparkSession, landing_dir: str, schema: T.StructType, out_dir: str,
                        checkpoint: str | None = None, rules: list[q.Rule] | None = None,
                        max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the incremental gate; returns the running query (``available_now`` drains what has
    landed and stops, otherwise it keeps polling the folder)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = reader.parquet(landing_dir)
    rules = q.code_rules(raw) if rules is None else rules
    flagged = q.flag_frame(raw, rules).observe(REPORT_NAME, *q.report_measures(rules))
    writer = (flagged.writeStream.format("parquet").partitionBy(q.DQ_PASS)
                     .option("checkpointLocation", checkpoint or scratch_path(spark, "gate_stream_ckpt"))
                     .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(out_dir)


def _sink_schema(spark: SparkSession, out_dir: str) -> T.StructType:
    data = spark.read.parquet(out_dir).schema
    return T.StructType([f for f in data.fields if f.name != q.DQ_PASS] +
                        [T.StructField(q.DQ_PASS, T.BooleanType())])


def read_passed(spark: SparkSession, out_dir: str) -> DataFrame:
    """Committed passed rows of the sink (flags kept, ``dq_pass`` dropped); partition pruned."""
    df = spark.read.schema(_sink_schema(spark, out_dir)).parquet(out_dir)
    return df.filter(F.col(q.DQ_PASS)).drop(q.DQ_PASS)


def read_quarantine(spark: SparkSession, out_dir: str) -> DataFrame:
    """Committed quarantined rows of the sink (all flags, ``dq_pass`` false)."""
    df = spark.read.schema(_sink_schema(spark, out_dir)).parquet(out_dir)
    return df.filter(~F.col(q.DQ_PASS))


def sink_report(spark: SparkSession, out_dir: str, rules: list[q.Rule]) -> DataFrame:
    """The gate report over everything the sink has committed, whatever batches or restarts it took."""
    return q.gate_report(spark.read.schema(_sink_schema(spark, out_dir)).parquet(out_dir), rules)


def batch_reports(query: StreamingQuery) -> list[dict]:
    """For monitoring: reports of the newest micro-batches of this run (batch id + the gate counts).

    Spark keeps a bounded number of them; ``sink_report`` has the whole counts.
    """
    out = []
    for p in query.recentProgress:
        row = (p.observedMetrics or {}).get(REPORT_NAME)
        if row is not None:
            out.append({"batch_id": p.batchId, **row.asDict()})
    return out
