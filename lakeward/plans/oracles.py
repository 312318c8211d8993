"""SQL twins of the registered queries, for DuckDB over the same parquet tables.

The fixture views are written once as CTEs (same expressions as ``lakeward.sources.fixtures``),
and each oracle selects the same column names as its Spark query.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


TRIPS = """
trips AS (
  SELECT
    CAST(NULLIF(l_linenumber, 7) AS INTEGER) AS VendorID,
    CAST(o_orderdate AS TIMESTAMP) AS tpep_pickup_datetime,
    CAST(l_shipdate AS TIMESTAMP) AS tpep_dropoff_datetime,
    CAST(l_quantity AS INTEGER) % 10 AS passenger_count,
    l_quantity AS trip_distance,
    CAST(l_linenumber AS INTEGER) AS RatecodeID,
    l_linestatus AS store_and_fwd_flag,
    CAST(NULLIF(c_nationkey, 13) AS INTEGER) AS PULocationID,
    CAST(NULLIF(s_nationkey, 7) AS INTEGER) AS DOLocationID,
    c_acctbal AS fare_amount,
    s_acctbal AS extra,
    l_extendedprice * l_discount + 0.0::DOUBLE AS tip_amount,
    l_extendedprice * l_tax + 0.0::DOUBLE AS tolls_amount,
    l_extendedprice AS total_amount
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
         'Zone ' || CAST(r_regionkey AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

MASTER = """
master AS (SELECT * FROM zones WHERE Borough IN ('AMERICA', 'ASIA', 'EUROPE'))"""

# (name, predicate, dimension, severity) of the code rule set over the trips view
CODE_RULES = [
    ("vendor_not_null", "VendorID IS NOT NULL", "completeness", "high"),
    ("pickup_not_null", "tpep_pickup_datetime IS NOT NULL", "completeness", "high"),
    ("dropoff_not_null", "tpep_dropoff_datetime IS NOT NULL", "completeness", "high"),
    ("pickup_before_dropoff", "tpep_pickup_datetime <= tpep_dropoff_datetime", "validity", "high"),
    ("pu_location_not_null", "PULocationID IS NOT NULL", "completeness", "high"),
    ("do_location_not_null", "DOLocationID IS NOT NULL", "completeness", "high"),
] + [
    (f"{c}_non_negative", f"{c} IS NULL OR {c} >= 0", "validity", "medium")
    for c in ["trip_distance", "fare_amount", "total_amount", "tip_amount", "tolls_amount", "extra"]
] + [
    ("passenger_count_range", "passenger_count IS NULL OR (passenger_count >= 0 AND passenger_count <= 8)",
     "validity", "low"),
    ("ratecode_range", "RatecodeID IS NULL OR (RatecodeID >= 1 AND RatecodeID <= 6)", "validity", "low"),
]

DECLARED = [
    ("trip_vendor_not_null", "VendorID IS NOT NULL"),
    ("pickup_not_null", "tpep_pickup_datetime IS NOT NULL"),
    ("dropoff_not_null", "tpep_dropoff_datetime IS NOT NULL"),
    ("pickup_before_dropoff", "tpep_pickup_datetime <= tpep_dropoff_datetime"),
    ("pu_location_not_null", "PULocationID IS NOT NULL"),
    ("do_location_not_null", "DOLocationID IS NOT NULL"),
    ("trip_distance_non_negative", "trip_distance IS NULL OR trip_distance >= 0"),
    ("fare_amount_non_negative", "fare_amount IS NULL OR fare_amount >= 0"),
    ("total_amount_non_negative", "total_amount IS NULL OR total_amount >= 0"),
    ("passenger_count_range", "passenger_count IS NULL OR (passenger_count >= 0 AND passenger_count <= 8)"),
]


def flagged_cte(rules=CODE_RULES, source: str = "trips") -> str:
    flags = ",\n    ".join(f"COALESCE({pred}, FALSE) AS {name}" for name, pred, *_ in rules)
    conj = " AND ".join(name for name, *_ in rules) or "TRUE"
    return f"""
flags0 AS (SELECT *,
    {flags}
  FROM {source}),
flagged AS (SELECT *, ({conj}) AS dq_pass FROM flags0)"""


def report_select(rules=CODE_RULES) -> str:
    fails = ",\n  ".join(f"COUNT(*) FILTER (WHERE NOT {name}) AS {name}_fail_count" for name, *_ in rules)
    return f"""SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE dq_pass) AS passed_rows,
  COUNT(*) FILTER (WHERE NOT dq_pass) AS failed_rows,
  {fails}
FROM flagged"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


GATE = with_(TRIPS, flagged_cte())

oracle("dq_flags", f"{GATE}\nSELECT * FROM flagged")
oracle("dq_passed", f"{GATE}\nSELECT * EXCLUDE (dq_pass) FROM flagged WHERE dq_pass")
oracle("quarantine_rows", f"{GATE}\nSELECT * FROM flagged WHERE NOT dq_pass")
oracle("dq_report", f"{GATE}\n{report_select()}")
oracle("dq_pass_rate", f"""{GATE}, rep AS ({report_select()})
SELECT total_rows, passed_rows,
  CASE WHEN total_rows > 0 THEN passed_rows / total_rows END AS pass_rate,
  0.95::DOUBLE AS min_pass_rate,
  COALESCE(CASE WHEN total_rows > 0 THEN passed_rows / total_rows END >= 0.95::DOUBLE, TRUE) AS gate_ok
FROM rep""")

_unpivot = "\n  UNION ALL ".join(
    f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE NOT {name}) AS fail_count FROM flagged"
    for name, *_ in CODE_RULES)
oracle("dq_top_failures", f"""{GATE}, long AS ({_unpivot})
SELECT rule, fail_count, ROW_NUMBER() OVER (ORDER BY fail_count DESC, rule) AS failure_rank FROM long""")


def _scorecard() -> str:
    groups: dict = {}
    for name, _, dim, sev in CODE_RULES:
        groups.setdefault((dim, sev), []).append(name)
    parts = []
    for (dim, sev), names in sorted(groups.items()):
        all_ok = " AND ".join(names)
        fails = " + ".join(f"COUNT(*) FILTER (WHERE NOT {n})" for n in names)
        parts.append(
            f"SELECT '{dim}' AS dimension, '{sev}' AS severity, CAST({len(names)} AS BIGINT) AS rule_count, "
            f"{fails} AS rule_failures, COUNT(*) FILTER (WHERE NOT ({all_ok})) AS failed_rows, "
            f"COUNT(*) AS total_rows, "
            f"CASE WHEN COUNT(*) > 0 THEN 1 - (COUNT(*) FILTER (WHERE NOT ({all_ok})))::DOUBLE / COUNT(*) END "
            f"AS pass_rate FROM flagged")
    return "\nUNION ALL ".join(parts)


oracle("dq_scorecard", f"{GATE}\n{_scorecard()}")

_DECL = [(n, p) for n, p in DECLARED]
oracle("dq_declared_rules", f"{with_(TRIPS, flagged_cte(_DECL))}\n{report_select(_DECL)}")

_TRIP_COLS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
              "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "fare_amount", "extra",
              "tip_amount", "tolls_amount", "total_amount"]
_nulls = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, COUNT(*) AS total_rows FROM trips"
    for c in _TRIP_COLS)
oracle("null_profile", f"""{with_(TRIPS)}, np AS ({_nulls})
SELECT column_name, null_count, total_rows,
  CASE WHEN total_rows > 0 THEN null_count / total_rows END AS null_share,
  COALESCE(CASE WHEN total_rows > 0 THEN null_count / total_rows END >= 0.01::DOUBLE, FALSE) AS blocks_load
FROM np""")

oracle("referential_integrity", f"""{with_(TRIPS, ZONES, MASTER)}, ids AS (SELECT DISTINCT LocationID AS id FROM master),
cnt AS (
  SELECT COUNT(*) AS total,
    COUNT(*) FILTER (WHERE PULocationID IN (SELECT id FROM ids)) AS m0,
    COUNT(*) FILTER (WHERE DOLocationID IN (SELECT id FROM ids)) AS m1
  FROM trips)
SELECT 'PULocationID' AS key_column, m0 AS matched_rows, total - m0 AS unmatched_rows,
  CASE WHEN total > 0 THEN m0 / total END AS match_rate FROM cnt
UNION ALL
SELECT 'DOLocationID', m1, total - m1, CASE WHEN total > 0 THEN m1 / total END FROM cnt""")

oracle("referential_rejects", f"""{with_(TRIPS, ZONES, MASTER)}
SELECT *, 'PULocationID' AS key_column FROM trips t
WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.LocationID = t.PULocationID)""")


def oracle_sql() -> dict[str, str]:
    from . import oracles_more  # noqa: F401  (registers the remaining oracles)

    return dict(ORACLES)
