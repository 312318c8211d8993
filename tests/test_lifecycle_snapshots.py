import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeward.operators import lifecycle as lc
from lakeward.sources.snapshots import SnapshotTable


def test_orphans_null_and_both_roles(spark):
    trips = spark.createDataFrame([(1, 1), (9, 9), (None, 1), (1, 8)], "PULocationID int, DOLocationID int")
    master = spark.createDataFrame([("1",), ("N/A",), (None,)], "LocationID string")
    o = lc.orphans(trips, master, "job", now="2025-01-01 00:00:00").collect()
    kinds = [(r.PULocationID, r.DOLocationID, r.orphan_type) for r in o]
    assert len(o) == 4  # (9,9) twice, (NULL,1) pickup, (1,8) dropoff
    assert (None, 1, "PICKUP_NOT_IN_MASTER") in [(a, b, c) for a, b, c in kinds]
    assert sum(1 for r in o if r.PULocationID == 9) == 2


def test_lifecycle_snapshot_default_and_empty(spark):
    df = spark.createDataFrame([(1,), (2,)], "LocationID int")
    assert lc.lifecycle_snapshot(df, "j").first().record_count == 2
    assert lc.lifecycle_snapshot(df.limit(0), "j").count() == 0
    st = spark.createDataFrame([("A",), (None,)], "mdm_state string")
    assert lc.lifecycle_snapshot(st, "j").count() == 2  # NULL state is its own group


def test_transition_check(spark):
    ch = spark.createDataFrame([("PROPOSED", "ACTIVE", "x", None, "s"), ("RETIRED", "ACTIVE", "x", "y", "s")],
                               "from_state string, to_state string, created_at_utc string, updated_at_utc string, "
                               "source_system string")
    r = lc.transition_check(spark, ch).orderBy("from_state").collect()
    assert r[0].is_allowed and r[0].missing_fields == "updated_at_utc" and not r[0].is_valid
    assert not r[1].is_allowed and r[1].missing_fields == ""


def test_retention(spark):
    df = spark.createDataFrame([("ACTIVE", dt.date(2010, 1, 1)), ("REJECTED", dt.date(2024, 1, 1)),
                                ("PROPOSED", dt.date(2000, 1, 1))], "mdm_state string, state_date date")
    exp, keep = lc.split_expired(df, "2025-01-02")
    assert [r.mdm_state for r in exp.collect()] == ["ACTIVE", "REJECTED"]
    assert [r.mdm_state for r in keep.collect()] == ["PROPOSED"]  # no retention declared


def test_cdc_round_trip(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "k int, v string")
    ch = lc.change_capture(old, new.filter("k != 1").unionByName(spark.createDataFrame([], "k int, v string")), "k")
    kinds = {r.k: r.change_type for r in ch.collect()}
    assert kinds == {1: "DELETE", 2: "UPDATE", 4: "INSERT"}
    applied = lc.apply_changes(old, ch, "k")
    assert sorted(applied.collect()) == sorted(new.filter("k != 1").collect())


def test_snapshot_versions_time_travel_and_crash(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "tbl"))
    t0 = dt.datetime(2025, 1, 1)
    t.commit(spark.createDataFrame([(1, "2024-01-01")], "a int, d string"), partition_by=["d"], now=t0)
    t.commit(spark.createDataFrame([(2, "x")], "a int, d string"), now=t0 + dt.timedelta(hours=1))
    t.commit(spark.createDataFrame([(3, "y")], "a int, d string"), mode="append", now=t0 + dt.timedelta(hours=2))
    assert [r.a for r in t.read(version=0).collect()] == [1]
    assert sorted(r.a for r in t.read().collect()) == [2, 3]
    assert [r.a for r in t.read(timestamp="2025-01-01 01:30:00").collect()] == [2]
    h = t.history().collect()
    assert [r.version for r in h] == [2, 1, 0] and h[0].operation == "APPEND"
    assert h[2].operation_metrics["numOutputRows"] == "1"
    # a data folder without a ledger row (a crashed write) is never read
    spark.createDataFrame([(99, "z")], "a int, d string").write.parquet(str(tmp_path / "tbl" / "v=3"))
    assert sorted(r.a for r in t.read().collect()) == [2, 3]
    with pytest.raises(ValueError):
        t.read(timestamp="2024-01-01 00:00:00")


def test_snapshot_appends_read_as_one_relation_with_evolving_schema(spark):
    from lakeward.session import scratch_path

    t = SnapshotTable(spark, scratch_path(spark, "evolve"))
    t.commit(spark.createDataFrame([(1, "a")], "k int, v string"))
    t.commit(spark.createDataFrame([(2, "b", 2.5)], "k int, v string, extra double"), mode="append")
    df = t.read()
    assert sorted(df.columns) == ["extra", "k", "v"]
    assert sorted((r.k, r.extra) for r in df.collect()) == [(1, None), (2, 2.5)]
    # both folders are one scan of one relation, not a union of one relation per commit
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan


def test_text_partition_value_round_trips(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.commit(spark.createDataFrame([(1, "007")], "id int, code string"), partition_by=["code"])
    assert t.read().first().code == "007"
    t.commit(spark.createDataFrame([(2, "010", "x")], "id int, code string, note string"), mode="append",
             partition_by=["code"])
    assert sorted((r.id, r.code, r.note) for r in t.read().collect()) == [(1, "007", None), (2, "010", "x")]


def test_commit_after_a_writer_that_died(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    spark.range(3).write.parquet(f"{t.root}/v=0-dead")  # a folder no ledger row names
    assert t.commit(spark.range(5)) == 0 and t.read().count() == 5


def test_archive_rerun_adds_nothing(spark, tmp_path):
    from lakeward.plans import jobs

    rows = spark.createDataFrame([(1, "ACTIVE", dt.date(2010, 1, 1)), (2, "ACTIVE", dt.date(2024, 1, 1))],
                                 "id int, mdm_state string, state_date date")
    master, archive = SnapshotTable(spark, str(tmp_path / "m")), SnapshotTable(spark, str(tmp_path / "a"))
    master.commit(rows)
    # the job dies between its two commits: the archive holds the rows, the master still does too
    expired, _ = lc.split_expired(master.read(), "2025-01-02")
    archive.commit(expired, mode="append", operation="ARCHIVE",
                   parameters={"as_of": "2025-01-02", "master_version": 0})
    for _ in range(2):
        jobs.archive_expired(spark, master.root, archive.root, "2025-01-02")
        assert [r.id for r in archive.read().collect()] == [1] and [r.id for r in master.read().collect()] == [2]


def test_types_widen_and_columns_come_over_appends(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.commit(spark.createDataFrame([(1, "a", 1.5)], "id int, v string, x float"))
    t.commit(spark.createDataFrame([(3_000_000_000, True)], "id bigint, flag boolean"), mode="append")
    t.commit(spark.createDataFrame([(2, 2.25)], "id int, x double"), mode="append")
    got = t.read()
    assert got.dtypes == [("id", "bigint"), ("v", "string"), ("x", "double"), ("flag", "boolean")]
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1.5, None), (2, None, 2.25, None), (3_000_000_000, None, None, True)]
    assert t.read(version=0).dtypes == [("id", "int"), ("v", "string"), ("x", "float")]
    with pytest.raises(ValueError, match="column v"):
        t.commit(spark.createDataFrame([(1, 2)], "id int, v int"), mode="append")
    assert t.latest_version() == 2 and t.read().count() == 3  # refused before anything was written
    assert sorted((r.version, r.column_name, r.change, r.old_type, r.new_type) for r in t.schema_versions().collect()) == [
        (0, "id", "added", None, "int"), (0, "v", "added", None, "string"), (0, "x", "added", None, "float"),
        (1, "flag", "added", None, "boolean"), (1, "id", "changed", "int", "bigint"), (2, "x", "changed", "float", "double")]
    t.commit(spark.createDataFrame([(7,)], "v int"))  # an overwrite may have any schema
    assert [tuple(r) for r in t.read().collect()] == [(7,)]


def test_a_ledger_row_names_its_own_folders(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    for k in range(4):
        t.commit(spark.createDataFrame([(k,)], "k int"), mode="append")
    rows = t.history().collect()
    assert [len(r.files) for r in rows] == [1] * 4 and {r.base_version for r in rows} == {0}
    assert sorted(r.k for r in t.read(version=2).collect()) == [0, 1, 2]


def test_catalog_view_follows_the_table(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), view="follows_the_table")
    by_name = lambda: sorted(map(tuple, spark.sql("SELECT * FROM follows_the_table").collect()), key=repr)
    t.commit(spark.createDataFrame([(1, "007"), (2, None)], "id int, code string"), partition_by=["code"])
    assert by_name() == [(1, "007"), (2, None)]
    t.commit(spark.createDataFrame([(3_000_000_000, "n")], "id bigint, note string"), mode="append")
    assert by_name() == sorted(map(tuple, t.read().collect()), key=repr) and len(by_name()) == 3
    t.commit(spark.createDataFrame([(9,)], "id int").limit(0))
    assert by_name() == [] and spark.table("follows_the_table").columns == ["id"]
    t.register([], spark.createDataFrame([(1,)], "other int").schema, {})
    assert by_name() == [] and spark.table("follows_the_table").columns == ["other"]
    t.drop_view()
    assert not spark.catalog.tableExists("follows_the_table")


def test_history_is_appended(spark, tmp_path):
    from lakeward.plans import jobs

    a, b, root = SnapshotTable(spark, str(tmp_path / "a")), SnapshotTable(spark, str(tmp_path / "b")), str(tmp_path / "h")
    tables = {"a": a.root, "b": b.root}
    assert jobs.append_history(spark, tables, root, "j") == 0 and SnapshotTable(spark, root).read().count() == 0
    for k in range(3):
        a.commit(spark.range(k + 1))
    assert jobs.append_history(spark, tables, root, "j") == 3
    b.commit(spark.range(1))
    a.commit(spark.range(1), mode="append")
    assert jobs.append_history(spark, tables, root, "j") == 2
    assert jobs.append_history(spark, tables, root, "j") == 0
    got = SnapshotTable(spark, root).read()
    assert got.columns[:10] == jobs.HISTORY_COLUMNS and dict(got.dtypes)["snapshot_id"] == "bigint"
    assert sorted((r.snapshot_id, r.table_name, r.version) for r in got.collect()) == [
        (1, "a", 0), (2, "a", 1), (3, "a", 2), (4, "b", 0), (5, "a", 3)]


def test_run_ledger_states(spark, tmp_path):
    from lakeward.plans import jobs

    ledger = jobs.RunLedger(spark, str(tmp_path / "runs"))
    ids = []
    with ledger.run(jobs.RunRecord("ok", "in", "out")) as rec:
        rec.records_in = 5
        ids.append(rec.run_id)
        assert [(r.status, r.records_in) for r in ledger.read().collect()] == [("RUNNING", None)]
    with pytest.raises(RuntimeError):
        with ledger.run(jobs.RunRecord("bad", "in", "out")) as rec:
            ids.append(rec.run_id)
            raise RuntimeError("broken")
    got = {r.run_id: (r.job_name, r.status, r.records_in, r.error_message) for r in ledger.read().collect()}
    assert got == {ids[0]: ("ok", "SUCCEEDED", 5, None), ids[1]: ("bad", "FAILED", None, "RuntimeError: broken")}
    assert ledger.rows().count() == 4 and dict(ledger.read().dtypes)["run_id"] == "bigint"
    first, later = jobs.new_run_id(dt.datetime(2025, 1, 1)), jobs.new_run_id(dt.datetime(2025, 1, 1, 0, 0, 1))
    assert 0 < first < later < 1 << 63
