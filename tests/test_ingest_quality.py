import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeward.operators import ingest as ing
from lakeward.operators import quality as q
from lakeward.operators import schema as sch
from lakeward.sources import files

T = "VendorID int, tpep_pickup_datetime string, tpep_dropoff_datetime string, fare_amount string, " \
    "passenger_count int, RatecodeID int, PULocationID int, DOLocationID int, trip_distance double"


def _trips(spark, rows):
    return spark.createDataFrame(rows, T)


def test_ingest_filters_and_casts(spark):
    rows = [
        (1, "2024-01-01 10:00:00", "2024-01-01 10:30:00", "10.5", 1, 1, 1, 1, 1.0),  # kept
        (1, "2024-01-01 10:00:00", "2024-01-01 10:00:00", "1", 1, 1, 1, 1, 1.0),     # equal times kept
        (1, None, "2024-01-01 10:00:00", "1", 1, 1, 1, 1, 1.0),                      # NULL pickup
        (1, "abc", "2024-01-01 10:00:00", "1", 1, 1, 1, 1, 1.0),                     # bad text -> NULL
        (1, "2024-01-01 11:00:00", "2024-01-01 10:00:00", "1", 1, 1, 1, 1, 1.0),     # dropoff before
        (1, "2024-01-01 10:00:00", "2024-01-01 11:00:00", None, 1, 1, 1, 1, 1.0),    # NULL fare
        (1, "2024-01-01 10:00:00", "2024-01-01 11:00:00", "0", 1, 1, 1, 1, 1.0),     # zero fare
        (1, "2024-01-01 10:00:00", "2024-01-01 11:00:00", "-1", 1, 1, 1, 1, 1.0),    # negative
        (1, "2024-01-01 10:00:00", "2024-01-01 11:00:00", "x", 1, 1, 1, 1, 1.0),     # text fare
    ]
    v = ing.validate_trips(_trips(spark, rows), now="2025-01-01 00:00:00").collect()
    assert len(v) == 2
    assert {r.governance_zone for r in v} == {"validated"} and v[0].source_system == "NYC_TLC"
    assert v[0].pickup_date == dt.date(2024, 1, 1)


def test_ingest_name_resolution_and_missing(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:00:01", "2023-01-01 00:00:00")],
                               "lpep_pickup_datetime string, lpep_dropoff_datetime string, pickup_datetime string")
    assert ing.resolve_trip_times(df) == ("lpep_pickup_datetime", "lpep_dropoff_datetime")
    from lakeward import governance as gov
    from lakeward.sources.files import preferred_column
    # the gate probes plain names before lpep names
    assert preferred_column(df, gov.GATE_PICKUP_CANDIDATES) == "pickup_datetime"
    with pytest.raises(ValueError):
        ing.resolve_trip_times(spark.createDataFrame([(1,)], "x int"))


def test_duration_floors_subseconds(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 58, 500000), dt.datetime(1970, 1, 1, 0, 1, 0))],
                               "pickup_ts timestamp, dropoff_ts timestamp")
    assert ing.with_duration(df).first().trip_duration_min == pytest.approx(62 / 60.0)


def test_enrich_left_join_unmatched_and_fanout(spark):
    trips = spark.createDataFrame([(1, 2, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 10)),
                                   (None, 9, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 10))],
                                  "PULocationID int, DOLocationID int, pickup_ts timestamp, dropoff_ts timestamp")
    zones = spark.createDataFrame([("1", "Q", "A", "Boro"), ("2", "Q", "B", "Boro"), ("2", "Q", "B2", "Boro"),
                                   ("N/A", "Q", "C", "Boro")], "LocationID string, Borough string, Zone string, service_zone string")
    out = ing.enrich_trips(trips, zones, now="2025-01-01 00:00:00").collect()
    assert len(out) == 3  # duplicate id 2 multiplies the first trip; the second trip is kept unmatched
    assert {r.do_zone for r in out if r.PULocationID == 1} == {"B", "B2"}
    assert [r.pu_zone for r in out if r.PULocationID is None] == [None]
    assert ing.lookup_fanout(zones).collect()[0].location_id == 2


def test_gate_null_semantics_and_counts(spark):
    rows = [(None, None, "2024-01-01 00:00:00", None, 9, 99, None, 1, float("nan")),
            (1, "2024-01-01 00:00:00", "2024-01-01 00:00:00", "5", 8, 6, 1, 1, 0.0)]
    g = q.quality_gate(_trips(spark, rows))
    flags = {r.name: None for r in g.rules}
    f = g.flagged.orderBy(F.col("VendorID").asc_nulls_first()).collect()
    bad, good = f[0], f[1]
    assert bad.pickup_not_null is False and bad.pickup_before_dropoff is False  # NULL condition fails
    assert bad.trip_distance_non_negative is True  # NaN >= 0 is true in Spark
    assert bad.passenger_count_range is False and bad.ratecode_range is False
    assert good.dq_pass is True and bad.dq_pass is False
    rep = g.report.first().asDict()
    assert rep["total_rows"] == 2 and rep["passed_rows"] == 1 and rep["failed_rows"] == 1
    assert rep["pu_location_not_null_fail_count"] == 1 and set(flags) <= {k[:-11] for k in rep if k.endswith("_fail_count")}
    assert "dq_pass" not in g.passed.columns and "dq_pass" in g.quarantined.columns


def test_gate_empty_and_no_rules(spark):
    empty = spark.createDataFrame([], T)
    rep = q.quality_gate(empty).report.first().asDict()
    assert all(v == 0 for v in rep.values())  # counts, not NULL sums
    one = spark.createDataFrame([(1,)], "x int")
    assert q.quality_gate(one).flagged.first().dq_pass is True
    with pytest.raises(ValueError):
        q.flag_frame(spark.createDataFrame([(1,)], "vendor_not_null int"), [q.Rule("vendor_not_null", F.lit(True))])


def test_declared_rules_equal_code_rules(spark, ):
    from tests.conftest import SF_SMALL
    from lakeward.sources import fixtures as fx

    t = fx.trips(spark, SF_SMALL)
    code = {r.name: r for r in q.code_rules(t)}
    decl = q.declared_rules(columns=t.columns)
    rename = {"trip_vendor_not_null": "vendor_not_null"}
    fc = q.gate_report(q.flag_frame(t, list(code.values())), list(code.values())).first().asDict()
    fd = q.gate_report(q.flag_frame(t, decl), decl).first().asDict()
    for r in decl:
        assert fd[f"{r.name}_fail_count"] == fc[f"{rename.get(r.name, r.name)}_fail_count"]


def test_pass_rate_enforced_after_report(spark, tmp_path):
    from lakeward.plans import jobs

    rows = [(None, "2024-01-01 00:00:00", "2024-01-01 00:00:00", "5", 1, 1, 1, 1, 1.0),
            (1, "2024-01-01 00:00:00", "2024-01-01 00:00:00", "5", 1, 1, 1, 1, 1.0)]
    with pytest.raises(q.QualityGateFailed):
        jobs.quality_gate_job(spark, _trips(spark, rows), str(tmp_path / "cur"), str(tmp_path / "quar"),
                              str(tmp_path / "rep"), min_pass_rate=0.95)
    rep = spark.read.json(str(tmp_path / "rep")).first()
    assert rep.total_rows == 2 and rep.passed_rows == 1  # report written before the stop


def test_top_failures_scorecard_null_profile(spark):
    rows = [(None, None, None, None, None, None, None, None, None), (1, None, None, None, 1, 1, 1, 1, 1.0)]
    g = q.quality_gate(_trips(spark, rows))
    top = q.top_failures(g.report, g.rules, k=2).collect()
    assert [r.failure_rank for r in top] == [1, 2] and top[0].fail_count >= top[1].fail_count
    sc = {(r.dimension, r.severity): r for r in q.scorecard(g.flagged, g.rules).collect()}
    assert sc[("completeness", "high")].failed_rows == 2
    npf = {r.column_name: r for r in q.null_profile(_trips(spark, rows)).collect()}
    assert npf["VendorID"].null_share == 0.5 and npf["VendorID"].blocks_load is True


def test_schema_diff_and_evolution(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "VendorID bigint, extra_col string")
    d = {r.column_name: r.status for r in sch.schema_diff(spark, df).collect()}
    assert d["VendorID"] == "type_mismatch" and d["extra_col"] == "extra" and d["fare_amount"] == "missing"
    with pytest.raises(ValueError):
        sch.raise_on_schema_drift(sch.schema_diff(spark, df))
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([(2, "n")], "a int, b string").write.parquet(str(tmp_path / "p2"))
    ev = sch.read_evolving(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")])
    assert sorted(ev.columns) == ["a", "b"] and ev.filter("b is null").count() == 1


def test_gate_sides_without_rows_and_stop_before_publishing(spark, tmp_path):
    from lakeward.plans import jobs
    from lakeward.sources.snapshots import SnapshotTable

    good = (1, "2024-01-01 00:00:00", "2024-01-01 00:00:00", "5", 1, 1, 1, 1, 1.0)
    bad = (None, *good[1:])
    for name, rows in (("all", [good, good]), ("none", [bad]), ("empty", [])):
        out = jobs.quality_gate_job(spark, _trips(spark, rows), str(tmp_path / name / "cur"),
                                    str(tmp_path / name / "quar"), str(tmp_path / name / "rep"))
        kept = SnapshotTable(spark, str(tmp_path / name / "cur")).read()
        held = jobs.read_quarantine(spark, out.quarantine_path)
        assert (kept.count(), held.count()) == (rows.count(good), rows.count(bad))
        assert "vendor_not_null" in kept.columns and kept.columns == held.columns[:-1]
    with pytest.raises(q.QualityGateFailed):
        jobs.quality_gate_job(spark, _trips(spark, [bad]), str(tmp_path / "all" / "cur"),
                              str(tmp_path / "all" / "quar"), str(tmp_path / "all" / "rep"), min_pass_rate=0.95)
    assert SnapshotTable(spark, str(tmp_path / "all" / "cur")).latest_version() == 0  # nothing published
    assert jobs.read_quarantine(spark, str(tmp_path / "all" / "quar")).count() == 1


def test_text_measure_fails_its_row(spark):
    df = spark.createDataFrame([("x",), ("-1",), ("2",), (None,)], "fare_amount string")
    assert q.quality_gate(df).report.first().fare_amount_non_negative_fail_count == 2


def test_csv_folder_with_differing_headers(spark, tmp_path):
    folder = tmp_path / "zones"
    folder.mkdir()
    (folder / "a.csv").write_text("LocationID,Borough,Zone,service_zone\n1,B1,Z1,s\nx,B9,\"Z,9\",s\n")
    (folder / "b.csv").write_text("LocationID,Zone,Borough,service_zone\n2,Z2,B2,t\n")
    (folder / "c.csv").write_text("zone_name,note,LOCATIONID\nZ3,n,3\n")
    (folder / "d.csv").write_text("")
    (folder / "e.csv").write_text("Zone,LocationID,Borough,service_zone\n")
    got = files.read_zones_csv(spark, str(folder), typed=True)
    assert dict(got.dtypes)["LocationID"] == "int"
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, "B1", "Z1", "s"), (None, "B9", "Z,9", "s"), (2, "B2", "Z2", "t"), (3, None, "Z3", None)], key=repr)
    assert len(files.csv_headers(spark, str(folder))) == 4
    inferred = files.read_zones_inferred(spark, str(folder))
    assert dict(inferred.dtypes) == {"LocationID": "string", "Borough": "string", "Zone": "string",
                                     "service_zone": "string", "zone_name": "string", "note": "string"}
    (folder / "a.csv").write_text("LocationID,Borough,Zone,service_zone\n1,B1,Z1,2.5\n")
    (folder / "b.csv").write_text("LocationID,Zone,Borough,service_zone\n3000000000,Z2,B2,7\n")
    kinds = dict(files.read_zones_inferred(spark, str(folder)).dtypes)
    assert (kinds["LocationID"], kinds["service_zone"]) == ("bigint", "double")


def test_declared_rules_on_text(spark):
    rows = [("1", "3.5", "2024-01-01 00:00:00", "2024-01-01 01:00:00"), ("1", "x", "2024-01-01 00:00:00", "2024-01-01 01:00:00"),
            (None, "-2", "late", "2024-01-01 01:00:00"), ("seven", None, "2024-01-02 00:00:00", "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "VendorID string, fare_amount string, tpep_pickup_datetime string, tpep_dropoff_datetime string")
    rules = q.declared_rules(df=df)
    assert {r.name: [c for c, _ in r.typed] for r in rules}["pickup_before_dropoff"] == [
        "tpep_pickup_datetime", "tpep_dropoff_datetime"]
    flagged = q.flag_frame(df, rules)
    assert flagged.columns[:4] == df.columns  # the input stays as it came
    got = flagged.select("fare_amount", "trip_vendor_not_null", "fare_amount_non_negative", "pickup_before_dropoff", "dq_pass")
    assert [tuple(r) for r in got.collect()] == [
        ("3.5", True, True, True, True), ("x", True, False, True, False), ("-2", False, False, False, False),
        (None, False, True, False, False)]
    # code rules beside them see the columns as they are
    both = q.flag_frame(df, q.code_rules(df, [("fare_range", "within", ("fare_amount",), (0, None), "validity", "low")]) + rules)
    assert [r.fare_range for r in both.collect()] == [True, False, False, True]


def test_text_ingest_keeps_what_does_not_convert(spark):
    df = spark.createDataFrame([("1", "2.5", "keep"), ("one", "", None), (None, "1e3", "k")],
                               "VendorID string, fare_amount string, other string")
    found = sch.typed_ingest(df)
    assert [(r.VendorID, r.fare_amount, r.other, r.raw_values, r.nonconforming) for r in found.collect()] == [
        (1, 2.5, "keep", {}, 0), (None, None, None, {"VendorID": "one", "fare_amount": ""}, 2), (None, 1000.0, "k", {}, 0)]
    report = {r.column_name: (r.nonconforming_rows, r.null_rows, r.example) for r in sch.conformance_of_ingest(found).collect()}
    assert report == {"VendorID": (1, 1, "one"), "fare_amount": (1, 0, "")}
    assert sch.conformance_of_ingest(sch.typed_ingest(df.limit(0))).first().total_rows == 0
    with pytest.raises(ValueError):
        sch.typed_ingest(df.withColumnRenamed("other", "raw_values"))


def test_text_ingest_converts_without_a_lambda_per_row(spark):
    """Evidence is built by generated code; rows with several bad texts keep all of them, clean ones none."""
    df = spark.createDataFrame([("1", "2.5", "n"), ("one", "x", "n"), ("2", "y", None)],
                               "VendorID string, fare_amount string, store_and_fwd_flag string")
    found = sch.typed_ingest(df)
    assert "lambdafunction" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.raw_values, r.nonconforming) for r in found.collect()] == [
        ({}, 0), ({"VendorID": "one", "fare_amount": "x"}, 2), ({"fare_amount": "y"}, 1)]
    assert dict(found.dtypes)["raw_values"] == "map<string,string>"
