from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from lakeward.operators import quality as q
from lakeward.session import scratch_path
from lakeward.sources import fixtures as fx
from lakeward.streaming import gate_stream as gs


def _land(spark, files: int):
    trips = fx.trips(spark, SF_SMALL)
    landing = scratch_path(spark, "landing")
    trips.repartition(files).write.parquet(landing)
    return trips, landing


def test_stream_gate_batches_equal_batch_gate(spark):
    trips, landing = _land(spark, 4)
    out, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    sq = gs.gate_landing_stream(spark, landing, trips.schema, out, checkpoint=ckpt, max_files_per_trigger=1)
    sq.awaitTermination()
    reports = gs.batch_reports(sq)
    assert len(reports) == 4  # one file per trigger
    batch = q.quality_gate(trips)
    expect = batch.report.first()
    assert sum(r["total_rows"] for r in reports) == expect.total_rows
    assert sum(r["passed_rows"] for r in reports) == expect.passed_rows
    passed = gs.read_passed(spark, out)
    assert sorted(passed.columns) == sorted(batch.passed.columns)
    assert passed.exceptAll(batch.passed).count() == 0 and batch.passed.exceptAll(passed).count() == 0
    assert gs.read_quarantine(spark, out).count() == expect.failed_rows


def test_stream_restart_commits_nothing_twice(spark):
    trips, landing = _land(spark, 2)
    out, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    gs.gate_landing_stream(spark, landing, trips.schema, out, checkpoint=ckpt).awaitTermination()
    first = gs.read_passed(spark, out).count()
    # a restart on the same checkpoint finds no new files and writes no batch
    sq = gs.gate_landing_stream(spark, landing, trips.schema, out, checkpoint=ckpt)
    sq.awaitTermination()
    assert gs.batch_reports(sq) == []
    assert gs.read_passed(spark, out).count() == first
    # a newly landed file is picked up on the next run, only it
    extra = trips.limit(5)
    extra.write.mode("append").parquet(landing)
    sq = gs.gate_landing_stream(spark, landing, trips.schema, out, checkpoint=ckpt)
    sq.awaitTermination()
    assert sum(r["total_rows"] for r in gs.batch_reports(sq)) == 5
    assert gs.read_quarantine(spark, out).filter(F.col("dq_pass")).count() == 0


def test_sink_report_outlives_the_progress_window_and_restarts(spark):
    trips, landing = _land(spark, 4)
    out, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for _ in range(2):
            gs.gate_landing_stream(spark, landing, trips.schema, out, checkpoint=ckpt,
                                   max_files_per_trigger=1).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert gs.sink_report(spark, out, q.code_rules(trips)).first() == q.quality_gate(trips).report.first()
