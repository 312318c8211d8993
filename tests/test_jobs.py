"""The five lake jobs chained end to end on the smallest driver tables, with invariants."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from lakeward.operators import ingest as ing
from lakeward.operators import lifecycle as lc
from lakeward.operators import matching as m
from lakeward.plans import jobs
from lakeward.session import scratch_path
from lakeward.sources import files, sinks
from lakeward.sources import fixtures as fx
from lakeward.sources.snapshots import SnapshotTable

CLOCK = "2025-01-01 00:00:00"


def test_five_jobs_end_to_end(spark):
    root = scratch_path(spark, "lake")
    raw, zones_csv = f"{root}/raw", f"{root}/zones_csv"
    trips = fx.trips(spark, SF_SMALL)
    trips.write.parquet(raw)
    files.write_zones_csv(fx.master_zones(spark, SF_SMALL), zones_csv)

    # job 1: raw -> validated (day-partitioned snapshot), optional zone source probed
    assert jobs.raw_to_validated(spark, raw, f"{root}/validated", zones_path=zones_csv, now=CLOCK) == 0
    validated = SnapshotTable(spark, f"{root}/validated").read()
    assert validated.count() == ing.validate_trips(trips, now=CLOCK).count()
    assert files.read_optional(spark, f"{root}/no_such_folder") is None

    # job 2: validated + zone CSV -> curated
    jobs.validated_to_curated(spark, f"{root}/validated", zones_csv, f"{root}/curated", now=CLOCK)
    curated = SnapshotTable(spark, f"{root}/curated").read()
    assert curated.count() == validated.count()  # left joins on a unique lookup keep every trip
    assert curated.filter(F.col("pu_zone").isNotNull()).count() > 0

    # job 3: one-pass gate over curated; passed + failed = total, committed side = passed
    out = jobs.quality_gate_job(spark, curated, f"{root}/gated", f"{root}/quarantine", f"{root}/report",
                                job_name="gate", now=CLOCK)
    rep = out.report
    assert rep["passed_rows"] + rep["failed_rows"] == rep["total_rows"] == curated.count()
    assert SnapshotTable(spark, f"{root}/gated").read().count() == rep["passed_rows"]
    assert jobs.read_quarantine(spark, out.quarantine_path).count() == rep["failed_rows"]
    assert spark.read.json(f"{root}/report").first().total_rows == rep["total_rows"]

    # job 4: matching over the zone CSV; master = one row per key; products in routed formats
    zones = files.read_zones_csv(spark, zones_csv)
    res = jobs.matching_job(spark, zones, f"{root}/master", f"{root}/steward", f"{root}/products",
                            f"{root}/audit", now=CLOCK)
    assert res["master_format"] == "parquet" and res["master_version"] == 0
    master = SnapshotTable(spark, f"{root}/master").read()
    assert master.count() == m.standardize(zones).select("match_key").distinct().count()
    audit = spark.read.json(f"{root}/audit/summary").first()
    assert audit.total_zone_rows == zones.count() and audit.master_format == "parquet"
    for name in ("dup_by_location_id", "dup_by_match_key"):
        assert os.path.isdir(f"{root}/products/{name}".removeprefix("file:"))

    # job 5: orphans of curated trips against the master, state snapshot, history, summary
    res5 = jobs.lifecycle_job(spark, f"{root}/master", f"{root}/curated", f"{root}/orphans",
                              f"{root}/lifecycle", f"{root}/history", f"{root}/summary", now=CLOCK)
    expect = lc.orphans(curated, master, "x", now=CLOCK).count()
    assert res5["orphans_count"] == expect == SnapshotTable(spark, f"{root}/orphans").read().count()
    hist = SnapshotTable(spark, f"{root}/history").read()
    assert set(r.table_name for r in hist.select("table_name").distinct().collect()) == {"master_zones",
                                                                                          "curated_trips"}
    summ = SnapshotTable(spark, f"{root}/summary").read().first()
    assert summ.orphans_count == expect


def test_product_routing_formats(spark):
    root = scratch_path(spark, "routing")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sinks.write_table(df, f"{root}/t") == "parquet"
    assert SnapshotTable(spark, f"{root}/t").read().count() == 2
    assert sinks.write_product(df, "steward_queue", f"{root}/q") == "parquet"
    assert sinks.write_product(df, "match_audit", f"{root}/j") == "json"
    assert sinks.write_product(df, "dup_by_match_key", f"{root}/c") == "csv"
    assert spark.read.json(f"{root}/j").count() == 2
    csv = spark.read.option("header", True).csv(f"{root}/c")
    assert csv.columns == ["id", "v"] and csv.count() == 2
    assert set(sinks.PRODUCT_FORMATS) >= {"curated_trips", "quarantine", "master_zones", "steward_queue"}


def test_jobs_read_the_format_that_was_written(spark, monkeypatch):
    """With another table format first in line, what job 4 writes is what job 5 reads."""
    root = scratch_path(spark, "formats")
    used = []

    def write(df, path, partition_by, mode, parameters):
        used.append("write")
        df.write.mode(mode).orc(f"{path}/orc")

    def read(s, path):
        used.append("read")
        return s.read.orc(f"{path}/orc")

    stub = sinks.TableFormat(lambda s: True, write, read)
    trips = fx.trips(spark, SF_SMALL).limit(200)
    jobs.raw_to_validated(spark, trips, f"{root}/validated", now=CLOCK)
    files.write_zones_csv(fx.master_zones(spark, SF_SMALL), f"{root}/zones")
    jobs.validated_to_curated(spark, f"{root}/validated", f"{root}/zones", f"{root}/curated", now=CLOCK)
    monkeypatch.setattr(sinks, "TABLE_FORMATS", {"stub": stub, **sinks.TABLE_FORMATS})
    res = jobs.matching_job(spark, files.read_zones_csv(spark, f"{root}/zones"), f"{root}/master", f"{root}/steward",
                            f"{root}/products", f"{root}/audit", now=CLOCK)
    assert res == {"master_version": None, "master_format": "stub"}
    jobs.lifecycle_job(spark, f"{root}/master", f"{root}/curated", f"{root}/orphans", f"{root}/lifecycle",
                       f"{root}/history", f"{root}/summary", now=CLOCK)
    assert used == ["write", "read"]
    # a table keeps its format, whatever is preferred later
    assert sinks.table_format(spark, f"{root}/master") == "stub"
    monkeypatch.setattr(sinks, "TABLE_FORMATS", {"parquet": sinks.TABLE_FORMATS["parquet"], "stub": stub})
    assert sinks.write_table(trips, f"{root}/master") == "stub"
    rejects = spark.read.parquet(f"{root}/products/rejects")
    audit = spark.read.json(f"{root}/audit/summary").first()
    assert audit.rejects_path == f"{root}/products/rejects"
    assert rejects.agg(F.sum("reject_pairs")).first()[0] == audit.reject_pairs


def test_profile_leaves_settings_alone(spark):
    from lakeward import session

    key, other = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(other)
    spark.conf.set(key, "1m")
    try:
        session.apply_profile(spark, {key: "64m", other: "8m", "spark.task.maxFailures": "8"})
        assert spark.conf.get(key) == "1m" and spark.conf.get(other) == "8m"
    finally:
        spark.conf.unset(key)
        spark.conf.unset(other)
    assert spark.conf.get(other) == before


def test_products_are_readable_by_name(spark):
    root = scratch_path(spark, "catalog")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    for product in ("master_zones", "steward_queue", "match_audit", "dup_by_match_key"):
        path, name = f"{root}/{product}", f"by_name_{product}"
        sinks.write_product(df, product, path)
        sinks.register_product(spark, product, path, name)
        got = spark.table(name).select(F.col("id").cast("int"), "v")
        assert sorted(map(tuple, got.collect()), key=repr) == [(1, "a"), (2, None)], product
        if product == "master_zones":
            sinks.write_product(df.limit(1), product, path)
            sinks.register_product(spark, product, path, name)
            assert spark.table(name).count() == 1
        sinks.unregister_product(spark, name)
        assert not spark.catalog.tableExists(name)
