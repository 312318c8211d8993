"""The five lake jobs end to end: read, transform, write versioned products, record the run.

Each job is a plain function with paths as arguments (no service wrapper). Writes go to
snapshot tables (``SnapshotTable``) or plain parquet/JSON/CSV folders; counts come from
``Observation``s on the writes, so no job re-reads its output or runs extra count actions.
"""

from __future__ import annotations

import datetime as dt
import secrets
import traceback
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import governance as gov
from ..operators import ingest as ing
from ..operators import lifecycle as lc
from ..operators import matching as m
from ..operators import quality as q
from ..operators import stewardship as sw
from ..operators.keys import dense_ids
from ..sources import files, sinks
from ..sources.snapshots import PLUMBING, SnapshotTable

# FIXED VALUES: columns of the run ledger and of the history ledger, as the audit tables declare them.
RUN_LEDGER_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("job_name", T.StringType()),
    T.StructField("job_run_id", T.StringType()),
    T.StructField("environment", T.StringType()),
    T.StructField("input_path", T.StringType()),
    T.StructField("output_path", T.StringType()),
    T.StructField("start_time_utc", T.TimestampType()),
    T.StructField("end_time_utc", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("records_in", T.LongType()),
    T.StructField("records_out", T.LongType()),
    T.StructField("rejects_count", T.LongType()),
    T.StructField("created_at_utc", T.TimestampType()),
])
HISTORY_COLUMNS = ["snapshot_id", "table_name", "table_path", "version", "operation", "operation_parameters",
                   "operation_metrics", "user_metadata", "committed_at_utc", "captured_at_utc"]

RUNNING, SUCCEEDED, FAILED = "RUNNING", "SUCCEEDED", "FAILED"
#: Bits of a run id below the time: ids of the same millisecond differ by chance.
RANDOM_BITS = 22


def _utcnow() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class RunRecord:
    job_name: str
    input_path: str
    output_path: str
    environment: str = "dev"
    records_in: int | None = None
    records_out: int | None = None
    rejects_count: int | None = None
    run_id: int | None = None
    extra: dict = field(default_factory=dict)


def new_run_id(now: dt.datetime | None = None) -> int:
    """A 64-bit id that needs no central counter: milliseconds since 1970, then 22 random bits.

    Ids grow with time; two runs that start in the same millisecond clash once in 4 million times.
    """
    at = (now or _utcnow()) - dt.datetime(1970, 1, 1)
    return (at // dt.timedelta(milliseconds=1)) << RANDOM_BITS | secrets.randbits(RANDOM_BITS)


class RunLedger:
    """Append-only table of job runs with counts.

    A run appends a RUNNING row when it starts and a row with its final status (SUCCEEDED / FAILED)
    when it ends; the row written last is the run's state, so a driver that dies leaves RUNNING.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @contextmanager
    def run(self, rec: RunRecord):
        start, error = _utcnow(), None
        run_id = rec.run_id = new_run_id(start)

        def append(status: str, end: dt.datetime | None) -> None:
            row = (run_id, rec.job_name, rec.extra.get("job_run_id"), rec.environment, rec.input_path, rec.output_path,
                   start, end, status, error, rec.records_in, rec.records_out, rec.rejects_count, end or start)
            self.spark.createDataFrame([row], RUN_LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

        append(RUNNING, None)
        try:
            yield rec
        except BaseException as exc:
            error = "".join(traceback.format_exception_only(type(exc), exc)).strip()
            append(FAILED, _utcnow())
            raise
        append(SUCCEEDED, _utcnow())

    def rows(self) -> DataFrame:
        """Every row ever written."""
        return self.spark.read.schema(RUN_LEDGER_SCHEMA).parquet(self.path)

    def read(self) -> DataFrame:
        """One row per run: its state."""
        # a run has two rows at most; the one that has ended counts
        latest = F.struct(F.col("end_time_utc").isNotNull(), "created_at_utc")
        row = F.struct(*[F.col(c) for c in RUN_LEDGER_SCHEMA.names])
        return self.rows().groupBy("run_id").agg(F.max_by(row, latest).alias("row")).select("row.*")


# ----------------------------------------------------------------------------------- job 1 / 2

def raw_to_validated(spark: SparkSession, raw: DataFrame | str, validated_root: str, zones_path: str | None = None,
                     now=None) -> int:
    """Raw trips -> validated snapshot partitioned by day. Returns the committed version."""
    raw_df = files.read_trips(spark, raw) if isinstance(raw, str) else raw
    if zones_path:
        files.read_optional(spark, zones_path)  # reachability only; resolves the listing, runs no job
    validated = ing.validate_trips(raw_df, now=now)
    return SnapshotTable(spark, validated_root).commit(validated, partition_by=["pickup_date"],
                                                       operation="WRITE", parameters={"job": "raw_to_validated"})


def validated_to_curated(spark: SparkSession, validated_root: str, zones_csv: str, curated_root: str, now=None) -> int:
    """Validated snapshot + zone lookup CSV -> curated snapshot partitioned by day."""
    validated = SnapshotTable(spark, validated_root).read()
    zones = files.read_zones_csv(spark, zones_csv)
    curated = ing.enrich_trips(validated, zones, now=now)
    return SnapshotTable(spark, curated_root).commit(curated, partition_by=["pickup_date"],
                                                     parameters={"job": "validated_to_curated"})


# ------------------------------------------------------------------------------------- job 3

@dataclass
class GateOutputs:
    curated_version: int
    quarantine_path: str
    report: dict


def quality_gate_job(spark: SparkSession, source: DataFrame, curated_root: str, quarantine_root: str,
                     report_path: str, job_name: str = "quality_gate", input_path: str = "",
                     min_pass_rate: float | None = None, rules: list[q.Rule] | None = None,
                     partition_by: list[str] | None = None, now=None) -> GateOutputs:
    """One pass over the input: flag, observe every report count, and write passed and failed rows
    in a single write partitioned by ``dq_pass`` into a run folder of its own. The failed side becomes
    the next quarantine version (flags kept), the report is a one-row JSON built from the
    observation. With ``min_pass_rate`` the job stops here on a lower rate, before the passed side
    is published as the next curated version. A side without rows is a version without rows.
    """
    rules = q.code_rules(source) if rules is None else rules
    flagged = q.flag_frame(source, rules)
    sides = T.StructType([f for f in flagged.schema.fields if f.name != q.DQ_PASS])
    obs = Observation("quality_gate")
    if partition_by:
        # high-cardinality output partitions (days): cluster first so a task writes few files
        flagged = flagged.hint("rebalance", q.DQ_PASS, *partition_by)
    observed = flagged.observe(obs, *q.report_measures(rules))
    run_dir = f"{curated_root.rstrip('/')}-gate-runs/run={uuid.uuid4().hex}"
    observed.write.mode("error").partitionBy(q.DQ_PASS, *(partition_by or [])).parquet(run_dir)
    counts = {k: int(v) for k, v in obs.get.items()}

    def publish(root: str, side: str, rows: int) -> int:
        folders = [f"{run_dir}/{q.DQ_PASS}={side}"] if rows else []
        return SnapshotTable(spark, root).register(folders, sides, {"numOutputRows": rows},
                                                   parameters={"job": job_name}, partition_by=partition_by)

    publish(quarantine_root, "false", counts["failed_rows"])
    report = dict(counts, input_path=input_path, curated_path=curated_root, quarantine_path=quarantine_root,
                  job_name=job_name)
    stamp = now or _utcnow().isoformat(sep=" ")
    (spark.createDataFrame([report]).withColumn("generated_at_utc", F.lit(str(stamp)).cast("timestamp"))
          .coalesce(1).write.mode("overwrite").json(report_path))
    if min_pass_rate is not None:
        q.enforce_pass_rate(counts, min_pass_rate)
    return GateOutputs(publish(curated_root, "true", counts["passed_rows"]), quarantine_root, report)


def read_quarantine(spark: SparkSession, quarantine_root: str) -> DataFrame:
    """Rows quarantined by the last gate run (``dq_pass`` restored as boolean false)."""
    return SnapshotTable(spark, quarantine_root).read().withColumn(q.DQ_PASS, F.lit(False))


# ------------------------------------------------------------------------------------- job 4

def matching_job(spark: SparkSession, zones: DataFrame, master_root: str, steward_path: str, products_root: str,
                 audit_path: str, high: float = gov.HIGH_CONFIDENCE, medium: float = gov.MEDIUM_CONFIDENCE,
                 job_name: str = "mdm_matching", now=None, rejects_path: str | None = None) -> dict:
    """Standardise, write golden master (snapshot), steward queue, auto-merge pairs of keys and members
    of keys, duplicate evidence and the audit summary (in its own ``summary/`` folder, beside the evidence).

    ``rejects_path`` receives what becomes of the rejected pairs: their number per block (the pairs
    themselves are nearly all pairs of a block).
    """
    rejects_path = rejects_path or f"{products_root}/rejects"
    z = m.standardize(zones)
    master_format = sinks.write_product(m.golden_master(z, now=now), "master_zones", master_root,
                                        parameters={"job": job_name})
    per_id = m.id_multiplicity(z)
    m.name_pair_scores(z, high, medium, per_id=per_id).write.mode("overwrite").parquet(f"{products_root}/name_pairs")
    scores = spark.read.parquet(f"{products_root}/name_pairs")  # scored once; every product reads these rows
    decisions = m.match_decisions(z, high, medium, per_id=per_id, scores=scores)
    sinks.write_product(m.steward_queue(decisions, now=now), "steward_queue", steward_path)
    sinks.write_product(decisions.filter(F.col("decision") == gov.AUTO_MERGE), "auto_merge_pairs",
                        f"{products_root}/auto_merge")
    sinks.write_product(m.auto_merge_members(z, high, per_id=per_id), "auto_merge_members",
                        f"{products_root}/auto_merge_members")
    by_block = m.bands_by_block(per_id, scores).select("borough", "total_pairs_compared", "reject_pairs")
    sinks.write_product(by_block, "reject_counts", rejects_path)
    for name, frame in (("dup_by_location_id", m.dup_by_id(z)), ("dup_by_match_key", m.dup_by_match_key(z))):
        sinks.write_product(frame, name, f"{products_root}/{name}")
    audit = m.match_audit(z, high, medium, per_id=per_id, scores=scores).withColumns({
        "master_out_path": F.lit(master_root), "master_format": F.lit(master_format),
        "steward_queue_path": F.lit(steward_path), "rejects_path": F.lit(rejects_path), "job_name": F.lit(job_name),
        "generated_at_utc": F.current_timestamp() if now is None else F.lit(now).cast("timestamp")})
    sinks.write_product(audit, "match_audit", f"{audit_path.rstrip('/')}/summary")
    master_version = SnapshotTable(spark, master_root).latest_version() if master_format == "parquet" else None
    return {"master_version": master_version, "master_format": master_format}


def steward_job(spark: SparkSession, master_root: str, queue: DataFrame, now=None) -> int:
    """The master after a steward's approvals, committed as its next version."""
    master = SnapshotTable(spark, master_root)
    return master.commit(sw.master_after_approvals(master.read(), queue, now=now), operation="STEWARD")


# ------------------------------------------------------------------------------------- job 5

def table_history(spark: SparkSession, tables: dict[str, str], job_name: str, now=None) -> DataFrame:
    """History of several snapshot tables in one frame (table name, path, job, capture time)."""
    frames = []
    for name, root in tables.items():
        h = SnapshotTable(spark, root).history().drop(*PLUMBING)
        frames.append(h.withColumns({"table_name": F.lit(name), "table_path": F.lit(root),
                                     "job_name": F.lit(job_name),
                                     "captured_at_utc": F.current_timestamp() if now is None
                                     else F.lit(now).cast("timestamp")}))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def append_history(spark: SparkSession, tables: dict[str, str], history_root: str, job_name: str, now=None) -> int:
    """Append the versions of ``tables`` that the history does not have yet; how many there were.

    The newest version captured per table is the high-water mark, so a run adds only what was
    committed since the last one and a re-run adds nothing. ``snapshot_id`` counts up over all runs.
    """
    history = SnapshotTable(spark, history_root)
    known = history.latest_version() is not None
    captured = history.read() if known else None
    seen = table_history(spark, tables, job_name, now)
    last = 0
    if known:
        marks = captured.groupBy("table_name").agg(F.max("version").alias("_mark"))
        seen = seen.join(marks, "table_name", "left").filter(F.col("version") > F.coalesce("_mark", F.lit(-1))).drop("_mark")
        last = captured.agg(F.max("snapshot_id")).first()[0] or 0
    unseen = dense_ids(seen, ["committed_at_utc", "table_name", "version"], "snapshot_id") \
        .withColumn("snapshot_id", F.col("snapshot_id") + F.lit(last))
    count = unseen.count()  # of the checkpointed rows
    if count or not known:
        history.commit(unseen.select(*HISTORY_COLUMNS, "partition_by", "job_name"), mode="append", operation="CAPTURE")
    return count


def lifecycle_job(spark: SparkSession, master_root: str, curated_root: str, orphans_root: str,
                  lifecycle_root: str, history_root: str, summary_root: str, job_name: str = "mdm_lifecycle",
                  now=None) -> dict:
    master = sinks.read_table(spark, master_root)
    trips = sinks.read_table(spark, curated_root)
    orph = lc.orphans(trips, master, job_name, now=now)
    obs = Observation("orphans")
    SnapshotTable(spark, orphans_root).commit(orph.observe(obs, F.count(F.lit(1)).alias("n")))
    n_orphans = int(obs.get["n"])
    SnapshotTable(spark, lifecycle_root).commit(lc.lifecycle_snapshot(master, job_name, now=now))
    # of the tables that keep their versions in a ledger
    tables = {name: root for name, root in (("master_zones", master_root), ("curated_trips", curated_root))
              if sinks.table_format(spark, root) in (None, "parquet")}
    append_history(spark, tables, history_root, job_name, now)
    summary = spark.createDataFrame(
        [(job_name, master_root, curated_root, orphans_root, lifecycle_root, history_root, n_orphans)],
        "job_name string, master_zones_path string, curated_trips_path string, orphans_out_path string, "
        "lifecycle_snapshot_path string, audit_history_out_path string, orphans_count long")
    summary = summary.withColumn("generated_at_utc", F.current_timestamp() if now is None else F.lit(now).cast("timestamp"))
    SnapshotTable(spark, summary_root).commit(summary)
    return {"orphans_count": n_orphans}


# ----------------------------------------------------------------------------------- archive

def archive_expired(spark: SparkSession, master_root: str, archive_root: str, as_of: str) -> dict:
    """Move expired master rows: append them to the (append-only) archive, then commit the
    remaining rows as the next master version. Nothing is deleted from earlier versions."""
    master, archive = SnapshotTable(spark, master_root), SnapshotTable(spark, archive_root)
    expired, kept = lc.split_expired(master.read(), as_of)
    # the archive row names the master version it came from: a re-run after a crash between the two
    # commits finds it and does not archive the same rows again
    source = {"as_of": as_of, "master_version": master.latest_version()}
    av = archive.committed_with("ARCHIVE", source)
    if av is None:
        av = archive.commit(expired, mode="append", operation="ARCHIVE", parameters=source)
    mv = master.commit(kept.drop("retention_until", "is_expired"), operation="RETENTION", parameters=source)
    return {"archive_version": av, "master_version": mv}
