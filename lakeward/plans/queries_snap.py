"""Registered versioned-table queries (S-04..S-07, K-01..K-11, L-03, L-08).

These queries write into the shared folder named by ``spark.checkpoint.dir`` (a fresh sub-folder
per call) and read the written products back.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from .. import governance as gov
from ..operators import ingest as ing
from ..operators import matching as m
from ..operators import quality as q
from ..sources import fixtures as fx
from ..sources import sinks
from ..sources.snapshots import SnapshotTable
from ..session import scratch_path
from . import jobs
from .catalog import JOB_NAME, RUN_CLOCK, query

T0 = dt.datetime(2025, 1, 1, 0, 0, 0)


def _validated_snapshot(spark, sf_dir):
    t = SnapshotTable(spark, scratch_path(spark, "validated"))
    t.commit(ing.validate_trips(fx.trips(spark, sf_dir), now=RUN_CLOCK), partition_by=["pickup_date"], now=T0)
    return t


@query("snapshot_current")
def snapshot_current(spark, sf_dir):
    """Validated trips written as a day-partitioned snapshot and read back (current version)."""
    return _validated_snapshot(spark, sf_dir).read()


@query("partition_day_counts")
def partition_day_counts(spark, sf_dir):
    """Trips per pickup day from the day-partitioned snapshot."""
    return _validated_snapshot(spark, sf_dir).read().groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"))


def _three_versions(spark, sf_dir):
    t = SnapshotTable(spark, scratch_path(spark, "master"))
    parts = fx.part_entities(spark, sf_dir)
    changed = fx.changed_snapshot(fx.part_entities_sized(spark, sf_dir)).drop("p_size")
    t.commit(parts, now=T0)
    t.commit(changed, mode="overwrite", now=T0 + dt.timedelta(hours=1))
    t.commit(changed.filter(F.col("LocationID") < 0), mode="append", now=T0 + dt.timedelta(hours=2))
    return t


@query("time_travel_version")
def time_travel_version(spark, sf_dir):
    """Version 0 of a three-version master, read after later overwrites."""
    return _three_versions(spark, sf_dir).read(version=0)


@query("time_travel_timestamp")
def time_travel_timestamp(spark, sf_dir):
    """The master as of a time between the second and the third commit."""
    return _three_versions(spark, sf_dir).read(timestamp="2025-01-01 01:30:00")


@query("snapshot_append_current")
def snapshot_append_current(spark, sf_dir):
    """Current version after an append: the overwrite's rows plus the appended rows."""
    return _three_versions(spark, sf_dir).read()


@query("table_history")
def table_history(spark, sf_dir):
    """History of two snapshot tables in one frame (versions, operations, output rows)."""
    master = _three_versions(spark, sf_dir)
    valid = _validated_snapshot(spark, sf_dir)
    h = jobs.table_history(spark, {"master_zones": master.root, "curated_trips": valid.root}, JOB_NAME, RUN_CLOCK)
    return h.select("table_name", "version", "operation", "committed_at_utc",
                    F.col("operation_metrics")["numOutputRows"].cast("long").alias("num_output_rows"),
                    F.col("operation_parameters")["mode"].alias("mode"), "job_name", "captured_at_utc")


def _gate_run(spark, sf_dir):
    root = scratch_path(spark, "gate")
    ledger = jobs.RunLedger(spark, f"{root}/_runs")
    rec = jobs.RunRecord(JOB_NAME, "trips", f"{root}/curated")
    with ledger.run(rec):
        out = jobs.quality_gate_job(spark, fx.trips(spark, sf_dir), f"{root}/curated", f"{root}/quarantine",
                                    f"{root}/report", job_name=JOB_NAME, now=RUN_CLOCK)
        rec.records_in, rec.records_out = out.report["total_rows"], out.report["passed_rows"]
        rec.rejects_count = out.report["failed_rows"]
    return root, ledger, out


@query("pipeline_runs")
def pipeline_runs(spark, sf_dir):
    """Run ledger row of a one-pass quality-gate run (counts from the write's observation)."""
    _, ledger, _ = _gate_run(spark, sf_dir)
    return ledger.read().select("job_name", "environment", "status", "error_message", "records_in",
                                "records_out", "rejects_count")


@query("gate_curated_written")
def gate_curated_written(spark, sf_dir):
    """Passed rows as committed by the one-pass gate write (flags kept, no dq_pass)."""
    root, _, _ = _gate_run(spark, sf_dir)
    return SnapshotTable(spark, f"{root}/curated").read()


@query("gate_quarantine_written")
def gate_quarantine_written(spark, sf_dir):
    """Quarantined rows as written by the one-pass gate write."""
    _, _, out = _gate_run(spark, sf_dir)
    return jobs.read_quarantine(spark, out.quarantine_path)


@query("gate_report_json")
def gate_report_json(spark, sf_dir):
    """The gate's one-row JSON report read back (counts only)."""
    root, _, _ = _gate_run(spark, sf_dir)
    rep = spark.read.json(f"{root}/report")
    return rep.select("total_rows", "passed_rows", "failed_rows", "pickup_before_dropoff_fail_count",
                      "ratecode_range_fail_count", "job_name")


@query("gate_stop")
def gate_stop(spark, sf_dir):
    """A gate run under the declared minimum pass rate: stopped or not, and what was published."""
    root = scratch_path(spark, "gate-stop")
    try:
        jobs.quality_gate_job(spark, fx.trips(spark, sf_dir), f"{root}/curated", f"{root}/quarantine",
                              f"{root}/report", now=RUN_CLOCK, min_pass_rate=gov.DEFAULT_MIN_PASS_RATE)
        stopped = False
    except q.QualityGateFailed:
        stopped = True
    published = SnapshotTable(spark, f"{root}/curated").history().count()
    counts = spark.read.json(f"{root}/report").select("total_rows", "passed_rows", "failed_rows")
    return counts.withColumns({"stopped": F.lit(stopped), "curated_versions": F.lit(published).cast("long")})


@query("catalog_tables")
def catalog_tables(spark, sf_dir):
    """Golden master committed in two steps (overwrite, append) and queried by its catalog name."""
    name = f"lakeward_master_{uuid.uuid4().hex[:10]}"
    t = SnapshotTable(spark, scratch_path(spark, "golden"), view=name)
    golden = m.golden_master(m.standardize(fx.part_entities(spark, sf_dir)), now=RUN_CLOCK)
    t.commit(golden)
    t.commit(golden.filter("location_id % 2 = 0"))
    t.commit(golden.filter("location_id % 2 <> 0"), mode="append")
    try:
        return spark.sql(f"SELECT * FROM {name}")  # resolved here; the entry is not needed afterwards
    finally:
        t.drop_view()


@query("schema_evolution")
def schema_evolution(spark, sf_dir):
    """A master over three commits: ids as int, then as bigint with a size, then as int with a flag."""
    parts = fx.part_entities_sized(spark, sf_dir)
    t = SnapshotTable(spark, scratch_path(spark, "evolving"))
    t.commit(parts.filter("LocationID % 3 = 0").drop("p_size"), now=T0)
    far = (F.col("LocationID").cast("bigint") + 3_000_000_000).alias("LocationID")
    t.commit(parts.filter("LocationID % 3 = 1").select(far, "Borough", "Zone", "service_zone", "p_size"), mode="append")
    t.commit(parts.filter("LocationID % 3 = 2").drop("p_size").withColumn("reviewed", F.lit(True)), mode="append")
    return t.read()


@query("history_appended")
def history_appended(spark, sf_dir):
    """Table versions captured by three audit runs, each adding what is new; a fourth adds nothing."""
    root = scratch_path(spark, "audit-history")
    master = SnapshotTable(spark, scratch_path(spark, "master"))
    parts = fx.part_entities(spark, sf_dir)
    changed = fx.changed_snapshot(fx.part_entities_sized(spark, sf_dir)).drop("p_size")
    tables = {"master_zones": master.root}

    def capture():
        return jobs.append_history(spark, tables, root, JOB_NAME, RUN_CLOCK)

    master.commit(parts, now=T0)
    capture()
    master.commit(changed, now=T0 + dt.timedelta(hours=1))
    capture()
    master.commit(changed.filter(F.col("LocationID") < 0), mode="append", now=T0 + dt.timedelta(hours=2))
    tables["curated_trips"] = _validated_snapshot(spark, sf_dir).root
    capture()
    capture()
    return SnapshotTable(spark, root).read().select(
        "snapshot_id", "table_name", "version", "operation", "committed_at_utc",
        F.col("operation_metrics")["numOutputRows"].cast("long").alias("num_output_rows"),
        F.col("operation_parameters")["mode"].alias("mode"), "job_name", "captured_at_utc")


@query("dup_evidence_csv")
def dup_evidence_csv(spark, sf_dir):
    """Duplicate evidence (match keys held by more than one row) written as header CSV and read back."""
    path = scratch_path(spark, "dup-evidence")
    sinks.write_product(m.dup_by_match_key(m.standardize(fx.part_entities(spark, sf_dir))), "dup_by_match_key", path)
    return spark.read.option("header", True).schema("match_key string, count bigint").csv(path)


@query("archive_expired")
def archive_expired(spark, sf_dir):
    """Expired master rows moved to the append-only archive; the archive read back."""
    root = scratch_path(spark, "lifecycle")
    SnapshotTable(spark, f"{root}/master").commit(fx.with_state(fx.part_entities(spark, sf_dir)), now=T0)
    jobs.archive_expired(spark, f"{root}/master", f"{root}/archive", "2035-01-01")
    return SnapshotTable(spark, f"{root}/archive").read()
