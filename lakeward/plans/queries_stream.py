"""Registered incremental-gate queries (D-13 run by Structured Streaming over a landing folder).

The whole trip view is landed as raw parquet files, then drained by the streaming gate in a few
micro-batches (a file budget per trigger), and the committed sink is read back.
"""

from __future__ import annotations

import math

from ..operators import quality as q
from ..session import scratch_path
from ..sources import fixtures as fx
from ..streaming import gate_stream as gs
from .catalog import query

BATCHES = 3  # micro-batches the landed files are drained in


def _drain(spark, sf_dir):
    trips = fx.trips(spark, sf_dir)
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "gate_stream")
    trips.write.parquet(landing)
    n_files = len(spark.read.parquet(landing).inputFiles())
    sq = gs.gate_landing_stream(spark, landing, trips.schema, out,
                                max_files_per_trigger=max(1, math.ceil(n_files / BATCHES)))
    sq.awaitTermination()
    if sq.exception() is not None:
        raise RuntimeError(f"gate stream failed: {sq.exception()}")
    return out, sq


@query("gate_stream_passed")
def gate_stream_passed(spark, sf_dir):
    """Passed rows committed by the streaming gate (flags kept, no dq_pass)."""
    out, _ = _drain(spark, sf_dir)
    return gs.read_passed(spark, out)


@query("gate_stream_report")
def gate_stream_report(spark, sf_dir):
    """Gate counts over everything the stream has committed (equals the batch report)."""
    out, _ = _drain(spark, sf_dir)
    return gs.sink_report(spark, out, q.code_rules(fx.trips(spark, sf_dir))).select(
        "total_rows", "passed_rows", "failed_rows", "pickup_before_dropoff_fail_count", "ratecode_range_fail_count")
