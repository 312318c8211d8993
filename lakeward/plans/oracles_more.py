"""More SQL twins."""

from __future__ import annotations

from .oracles import ORACLES, oracle  # noqa: F401

from .oracles import DECLARED, GATE, MASTER, TRIPS, ZONES, flagged_cte, report_select, with_

CLOCK = "TIMESTAMP '2025-01-01 00:00:00'"

VALIDATED = f"""
validated AS (
  SELECT *, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    'validated' AS governance_zone, {CLOCK} AS ingested_at, 'NYC_TLC' AS source_system
  FROM trips
  WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND tpep_dropoff_datetime >= tpep_pickup_datetime AND TRY_CAST(fare_amount AS DOUBLE) > 0
)"""

DURATION = """(FLOOR(EPOCH(dropoff_ts))::BIGINT - FLOOR(EPOCH(pickup_ts))::BIGINT) / 60.0::DOUBLE"""

PARTS = """
parts AS (
  SELECT CAST(p_partkey AS INTEGER) AS LocationID, p_brand AS Borough, p_name AS Zone, p_type AS service_zone
  FROM part
)"""

oracle("validated_trips", f"{with_(TRIPS, VALIDATED)}\nSELECT * FROM validated")
oracle("trip_duration", f"{with_(TRIPS, VALIDATED)}\nSELECT *, {DURATION} AS trip_duration_min FROM validated")
oracle("enriched_trips", f"""{with_(TRIPS, VALIDATED, ZONES, MASTER)},
lookup AS (SELECT CAST(LocationID AS VARCHAR) AS location_id, Zone AS zone_name, Borough AS borough, service_zone
           FROM master)
SELECT v.* REPLACE ('curated' AS governance_zone), {DURATION} AS trip_duration_min,
  pu.location_id AS pu_location_id, pu.zone_name AS pu_zone, pu.borough AS pu_borough,
  pu.service_zone AS pu_service_zone,
  dz.location_id AS do_location_id, dz.zone_name AS do_zone, dz.borough AS do_borough,
  dz.service_zone AS do_service_zone,
  {CLOCK} AS curated_at
FROM validated v
LEFT JOIN lookup pu ON v.PULocationID = TRY_CAST(pu.location_id AS INTEGER)
LEFT JOIN lookup dz ON v.DOLocationID = TRY_CAST(dz.location_id AS INTEGER)""")
oracle("zone_lookup_csv", f"""{with_(PARTS)}
SELECT CAST(LocationID AS VARCHAR) AS LocationID, Borough, Zone, service_zone FROM parts""")
oracle("zone_lookup_inferred", f"""{with_(PARTS)}
SELECT LocationID, Borough, Zone, service_zone, CASE WHEN LocationID % 2 <> 0 THEN 'b' END AS export FROM parts""")
oracle("zone_lookup_typed", f"{with_(PARTS)}\nSELECT * FROM parts")

_DECL_TYPES = [("VendorID", "int", "INTEGER"), ("tpep_pickup_datetime", "timestamp", "TIMESTAMP"),
               ("tpep_dropoff_datetime", "timestamp", "TIMESTAMP"), ("passenger_count", "int", "INTEGER"),
               ("trip_distance", "double", "DOUBLE"), ("RatecodeID", "int", "INTEGER"),
               ("store_and_fwd_flag", "string", "VARCHAR"), ("PULocationID", "int", "INTEGER"),
               ("DOLocationID", "int", "INTEGER"), ("fare_amount", "double", "DOUBLE"),
               ("extra", "double", "DOUBLE"), ("tip_amount", "double", "DOUBLE"),
               ("tolls_amount", "double", "DOUBLE"), ("total_amount", "double", "DOUBLE")]
_conf = "\nUNION ALL ".join(
    f"SELECT '{n}' AS column_name, '{t}' AS declared_type, '{t}' AS actual_type, "
    f"COUNT(*) FILTER (WHERE {n} IS NOT NULL AND TRY_CAST({n} AS {d}) IS NULL) AS nonconforming_rows, "
    f"COUNT(*) FILTER (WHERE {n} IS NULL) AS null_rows, COUNT(*) AS total_rows FROM trips"
    for n, t, d in _DECL_TYPES)
oracle("schema_conformance", f"{with_(TRIPS)}\n{_conf}")

# the untyped export: rows (by the typed view's columns) whose text is spoilt, and the text
_SPOILT = {"VendorID": ("RatecodeID = 6", "vendor six"), "tpep_pickup_datetime": ("PULocationID = 3", "1996-13-45 00:00:00"),
           "passenger_count": ("passenger_count = 9", "nine"), "trip_distance": ("trip_distance = 13", "13 miles"),
           "fare_amount": ("DOLocationID = 11", "x"), "total_amount": ("RatecodeID = 2 AND passenger_count = 1", "n/a")}
_BAD = {n: f"COALESCE({w}, FALSE)" for n, (w, _) in _SPOILT.items()}
_TYPED = f"""
typed AS (SELECT {", ".join(f"CASE WHEN {_BAD[n]} THEN NULL ELSE {n} END AS {n}" if n in _BAD else n for n, _, _ in _DECL_TYPES)},
  {", ".join(f"{b} AS bad_{n}" for n, b in _BAD.items())} FROM trips)"""
_texts = ", ".join(f"CASE WHEN bad_{n} THEN '{n}={text}' END" for n, (_, text) in _SPOILT.items())
oracle("text_ingest", f"""{with_(TRIPS, _TYPED)}, found AS (SELECT *, list_sort(list_filter([{_texts}], lambda x: x IS NOT NULL)) AS t FROM typed)
SELECT {", ".join(n for n, _, _ in _DECL_TYPES)}, array_to_string(t, ';') AS raw_values, CAST(len(t) AS INTEGER) AS nonconforming FROM found""")
oracle("text_conformance", with_(TRIPS, _TYPED) + "\nUNION ALL ".join(
    f"\nSELECT '{n}' AS column_name, '{t}' AS declared_type, " + (
        f"COUNT(*) FILTER (WHERE bad_{n}) AS nonconforming_rows, COUNT(*) FILTER (WHERE {n} IS NULL AND NOT bad_{n}) AS null_rows, "
        f"CASE WHEN COUNT(*) FILTER (WHERE bad_{n}) > 0 THEN '{_SPOILT[n][1]}' END AS example"
        if n in _SPOILT else
        f"CAST(0 AS BIGINT) AS nonconforming_rows, COUNT(*) FILTER (WHERE {n} IS NULL) AS null_rows, CAST(NULL AS VARCHAR) AS example")
    + ", COUNT(*) AS total_rows FROM typed" for n, t, _ in _DECL_TYPES))


def _on_text(predicate: str) -> str:
    bad = [f"NOT bad_{n}" for n in _SPOILT if n in predicate]
    return " AND ".join([f"COALESCE({predicate}, FALSE)", *bad])


_DECL_TEXT = [(n, _on_text(p)) for n, p in DECLARED]
oracle("dq_declared_rules_text", f"{with_(TRIPS, _TYPED, flagged_cte(_DECL_TEXT, 'typed'))}\n{report_select(_DECL_TEXT)}")

# ------------------------------------------------------------------------------------ matching

SUPPLIERS = """
sups AS (
  SELECT CAST(s_suppkey AS INTEGER) AS LocationID, CAST(s_nationkey AS VARCHAR) AS Borough, s_name AS Zone,
         CAST(NULL AS VARCHAR) AS service_zone
  FROM supplier
)"""


def norm(col: str) -> str:
    return (f"TRIM(REGEXP_REPLACE(REGEXP_REPLACE(UPPER(CAST({col} AS VARCHAR)), '[^A-Z0-9 ]', ' ', 'g'), "
            f"'\\s+', ' ', 'g'))")


def r4(x: str) -> str:
    """Round half-up on the shortest decimal text of a double, as Spark's round(double, 4) does."""
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 4) AS DOUBLE)"


def std(src: str) -> str:
    return f"""
z AS (
  SELECT LocationID AS location_id, Borough, Zone, service_zone,
    {norm('Zone')} AS zone_norm, {norm('Borough')} AS borough_norm
  FROM {src}
),
zk AS (SELECT *, CONCAT_WS('::', borough_norm, zone_norm) AS match_key FROM z)"""


SIM = (f"CASE WHEN GREATEST(LENGTH(zone_a), LENGTH(zone_b)) = 0 THEN 0.0::DOUBLE ELSE "
       f"{r4('1 - LEVENSHTEIN(zone_a, zone_b) / GREATEST(LENGTH(zone_a), LENGTH(zone_b))')} END")

PAIRS = f"""
pairs AS (
  SELECT a.location_id AS id_a, b.location_id AS id_b, a.zone_norm AS zone_a, b.zone_norm AS zone_b,
         a.borough_norm AS borough
  FROM zk a JOIN zk b ON a.borough_norm = b.borough_norm AND a.location_id < b.location_id
),
s1 AS (SELECT *, {SIM} AS name_similarity, SPLIT_PART(zone_a, ' ', 1) AS token_a,
         SPLIT_PART(zone_b, ' ', 1) AS token_b FROM pairs),
s2 AS (SELECT *, CASE WHEN token_a = token_b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS token_match FROM s1),
s3 AS (SELECT *, {r4('name_similarity * 0.9::DOUBLE + token_match * 0.1::DOUBLE')} AS match_confidence FROM s2),
scored AS (SELECT *, CASE WHEN match_confidence >= 0.95::DOUBLE THEN 'AUTO_MERGE'
                          WHEN match_confidence >= 0.8::DOUBLE THEN 'STEWARD_REVIEW' ELSE 'REJECT' END AS decision
           FROM s3)"""

# All pairs of rows brought together per pair of match keys, under the smallest id of each key.
KEYED = """
key_ids AS (SELECT borough_norm, zone_norm, MIN(location_id) AS golden_id FROM zk
            WHERE location_id IS NOT NULL GROUP BY ALL),
counted AS (SELECT LEAST(zone_a, zone_b) AS zu, GREATEST(zone_a, zone_b) AS zv, borough, name_similarity,
              token_match, match_confidence, decision, COUNT(*) AS pair_count
            FROM scored WHERE decision <> 'REJECT' AND zone_a <> zone_b GROUP BY ALL),
ended AS (SELECT c.*, u.golden_id AS gu, v.golden_id AS gv, u.golden_id <= v.golden_id AS straight
          FROM counted c JOIN key_ids u ON u.borough_norm = borough AND u.zone_norm = zu
                         JOIN key_ids v ON v.borough_norm = borough AND v.zone_norm = zv),
keyed AS (SELECT LEAST(gu, gv) AS id_a, GREATEST(gu, gv) AS id_b,
            CASE WHEN straight THEN zu ELSE zv END AS zone_a, CASE WHEN straight THEN zv ELSE zu END AS zone_b,
            borough, name_similarity, token_match, match_confidence, decision, pair_count FROM ended)"""

PARTS_M = with_(PARTS, std("parts"), PAIRS)
SUPS_M = with_(SUPPLIERS, std("sups"), PAIRS)
_PAIR_COLS = ("id_a, id_b, zone_a, zone_b, borough, name_similarity, SPLIT_PART(zone_a, ' ', 1) AS token_a, "
              "SPLIT_PART(zone_b, ' ', 1) AS token_b, token_match, match_confidence, decision, pair_count")

oracle("normalized_names", f"{with_(PARTS, std('parts'))}\nSELECT * FROM zk")
oracle("normalized_names_declared", f"""{with_(PARTS)},
z AS (SELECT LocationID AS location_id, Borough, Zone, service_zone, {norm('Zone')} AS zone_norm,
             UPPER(TRIM(Borough)) AS borough_norm,
             UPPER(TRIM(Borough)) || '::' || UPPER(TRIM(Zone)) AS declared_key FROM parts)
SELECT *, CONCAT_WS('::', borough_norm, zone_norm) AS match_key FROM z""")
oracle("dup_by_match_key", f"""{with_(PARTS, std('parts'))}
SELECT match_key, COUNT(*) AS count FROM zk GROUP BY match_key HAVING COUNT(*) > 1""")
oracle("dup_by_id", f"""{with_(PARTS, SUPPLIERS)}, both_src AS (SELECT * FROM parts UNION ALL SELECT * FROM sups)
SELECT LocationID AS location_id, COUNT(*) AS count FROM both_src GROUP BY LocationID HAVING COUNT(*) > 1""")
oracle("match_name_pairs", f"""{PARTS_M}
SELECT borough, LEAST(zone_a, zone_b) AS zone_u, GREATEST(zone_a, zone_b) AS zone_v, name_similarity,
  SPLIT_PART(LEAST(zone_a, zone_b), ' ', 1) AS token_u, SPLIT_PART(GREATEST(zone_a, zone_b), ' ', 1) AS token_v,
  token_match, match_confidence, decision, COUNT(*) AS pair_count
FROM scored WHERE match_confidence >= 0.8::DOUBLE
GROUP BY ALL""")
oracle("match_decisions", f"{PARTS_M}, {KEYED}\nSELECT {_PAIR_COLS} FROM keyed")
oracle("match_decisions_suppliers", f"{SUPS_M}, {KEYED}\nSELECT {_PAIR_COLS} FROM keyed")
oracle("auto_merge_members", f"""{PARTS_M}
SELECT id_b AS location_id, MIN(id_a) AS golden_id, borough AS borough_norm, zone_b AS zone_norm,
  CONCAT_WS('::', borough, zone_b) AS match_key
FROM scored WHERE decision = 'AUTO_MERGE' AND zone_a = zone_b GROUP BY id_b, borough, zone_b""")
oracle("steward_queue", f"""{PARTS_M}, {KEYED}
SELECT id_a, id_b, zone_a, zone_b, borough, name_similarity, match_confidence, decision,
  'PENDING' AS review_status, {CLOCK} AS submitted_at_utc, pair_count
FROM keyed WHERE decision = 'STEWARD_REVIEW'""")


def _audit(base: str) -> str:
    return f"""{base}
SELECT (SELECT COUNT(*) FROM zk) AS total_zone_rows, COUNT(*) AS total_pairs_compared,
  COUNT(*) FILTER (WHERE decision = 'AUTO_MERGE') AS auto_merge_pairs,
  COUNT(*) FILTER (WHERE decision = 'STEWARD_REVIEW') AS steward_review_pairs,
  COUNT(*) FILTER (WHERE decision = 'REJECT') AS reject_pairs,
  0.95::DOUBLE AS high_conf_threshold, 0.8::DOUBLE AS med_conf_threshold
FROM scored"""


# the same pairs under the other name similarity
_JW = r4("JARO_WINKLER_SIMILARITY(zone_a, zone_b)")
PARTS_JW = PARTS_M.replace(SIM, f"CASE WHEN LENGTH(zone_a) = 0 OR LENGTH(zone_b) = 0 THEN 0.0::DOUBLE ELSE {_JW} END")
oracle("match_name_pairs_jaro_winkler", ORACLES["match_name_pairs"].replace(PARTS_M.strip(), PARTS_JW.strip()))


def _by_block(scorer: str, band: str, base: str) -> str:
    return f"""SELECT '{scorer}' AS scorer, borough, COUNT(*) AS total_pairs_compared,
  COUNT(*) FILTER (WHERE {band} = 'AUTO_MERGE') AS auto_merge_pairs,
  COUNT(*) FILTER (WHERE {band} = 'STEWARD_REVIEW') AS steward_review_pairs,
  COUNT(*) FILTER (WHERE {band} = 'REJECT') AS reject_pairs
FROM ({base}) GROUP BY borough"""


oracle("match_by_scorer", "\nUNION ALL\n".join([
    _by_block("levenshtein", "decision", f"{PARTS_M} SELECT * FROM scored"),
    _by_block("jaro_winkler", "decision", f"{PARTS_JW} SELECT * FROM scored"),
    _by_block("heuristic", "CASE WHEN zone_a = zone_b THEN 'AUTO_MERGE' ELSE 'STEWARD_REVIEW' END",
              f"{PARTS_M} SELECT * FROM scored")]))
oracle("match_declared_blocking", _by_block("heuristic", "band", f"""{with_(PARTS, std('parts'))},
keyed AS (SELECT location_id, zone_norm, UPPER(TRIM(Borough)) || '::' || UPPER(TRIM(Zone)) AS declared_key FROM zk)
SELECT a.declared_key AS borough, CASE WHEN a.zone_norm = b.zone_norm THEN 'AUTO_MERGE' ELSE 'STEWARD_REVIEW' END AS band
FROM keyed a JOIN keyed b ON a.declared_key = b.declared_key AND a.location_id < b.location_id"""))
oracle("match_audit", _audit(PARTS_M))
oracle("match_audit_suppliers", _audit(SUPS_M))
oracle("golden_master", f"""{with_(PARTS, std('parts'))},
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY match_key ORDER BY location_id NULLS FIRST,
             Borough NULLS FIRST, Zone NULLS FIRST, service_zone NULLS FIRST, zone_norm NULLS FIRST,
             borough_norm NULLS FIRST) AS rn FROM zk)
SELECT * EXCLUDE (rn), 'ACTIVE' AS mdm_state, {CLOCK} AS created_at_utc, {CLOCK} AS updated_at_utc,
  'min(location_id) per match_key' AS survivorship_rule
FROM ranked WHERE rn = 1""")
oracle("survivorship_first_non_null", f"""{with_(PARTS, std('parts'))}
SELECT match_key, MIN(location_id) AS location_id,
  ARG_MIN(Zone, location_id) FILTER (WHERE Zone IS NOT NULL) AS Zone,
  ARG_MIN(Borough, location_id) FILTER (WHERE Borough IS NOT NULL) AS Borough,
  ARG_MIN(service_zone, location_id) FILTER (WHERE service_zone IS NOT NULL) AS service_zone
FROM zk GROUP BY match_key""")
oracle("match_heuristic", f"""{PARTS_M},
np AS (SELECT borough, LEAST(zone_a, zone_b) AS zone_u, GREATEST(zone_a, zone_b) AS zone_v, COUNT(*) AS pair_count
       FROM scored WHERE match_confidence >= 0.8::DOUBLE GROUP BY ALL)
SELECT *, CASE WHEN zone_u = zone_v THEN 1.0::DOUBLE ELSE 0.85::DOUBLE END AS heuristic_score,
  CASE WHEN zone_u = zone_v THEN 'AUTO_MERGE' ELSE 'STEWARD_REVIEW' END AS heuristic_decision
FROM np""")

# ----------------------------------------------------------------------------------- lifecycle

JOB = "'lakeward_check'"
ORPH = f"""
ti AS (SELECT *, PULocationID AS PULocationID_int, DOLocationID AS DOLocationID_int FROM trips),
orph AS (
  SELECT *, 'PICKUP_NOT_IN_MASTER' AS orphan_type FROM ti
  WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.LocationID = ti.PULocationID_int)
  UNION ALL
  SELECT *, 'DROPOFF_NOT_IN_MASTER' AS orphan_type FROM ti
  WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.LocationID = ti.DOLocationID_int)
)"""
oracle("orphans_all", f"""{with_(TRIPS, ZONES, MASTER, ORPH)}
SELECT *, {JOB} AS job_name, {CLOCK} AS detected_at_utc FROM orph""")
oracle("orphans_pickup", f"""{with_(TRIPS, ZONES, MASTER, ORPH)}
SELECT *, {JOB} AS job_name, {CLOCK} AS detected_at_utc FROM orph WHERE orphan_type = 'PICKUP_NOT_IN_MASTER'""")
oracle("orphans_dropoff", f"""{with_(TRIPS, ZONES, MASTER)}
SELECT *, DOLocationID AS DOLocationID_int, 'DROPOFF_NOT_IN_MASTER' AS orphan_type, {JOB} AS job_name,
  {CLOCK} AS detected_at_utc
FROM trips t WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.LocationID = t.DOLocationID)""")

STATES = """
st AS (
  SELECT *, (['PROPOSED', 'ACTIVE', 'DEPRECATED', 'RETIRED', 'REJECTED'])[(LocationID % 5) + 1] AS mdm_state,
    CAST(DATE '2020-01-01' + CAST(LocationID AS INTEGER) AS DATE) AS state_date
  FROM parts
)"""
oracle("lifecycle_snapshot", f"""{with_(PARTS, STATES)}
SELECT mdm_state, COUNT(*) AS record_count, {JOB} AS job_name, {CLOCK} AS snapshot_at_utc FROM st GROUP BY mdm_state""")
oracle("lifecycle_snapshot_default", f"""{with_(PARTS)}
SELECT 'ACTIVE' AS mdm_state, COUNT(*) AS record_count, {JOB} AS job_name, {CLOCK} AS snapshot_at_utc
FROM parts HAVING COUNT(*) > 0""")

_REQ = [("PROPOSED", ["submitted_at_utc", "submitted_by", "review_reason"]),
        ("ACTIVE", ["created_at_utc", "updated_at_utc", "source_system"]),
        ("DEPRECATED", ["deprecated_at_utc", "deprecated_reason"]),
        ("RETIRED", ["retired_at_utc", "retired_reason", "retention_until"]),
        ("REJECTED", ["rejected_at_utc", "reject_reason"])]
_PRESENT = {"created_at_utc", "updated_at_utc", "source_system", "deprecated_at_utc", "deprecated_reason",
            "submitted_at_utc"}
_miss = ", ".join(
    f"CASE WHEN r.to_state = '{s}' AND {(f + ' IS NULL') if f in _PRESENT else 'TRUE'} THEN '{f}' END"
    for s, fs in _REQ for f in fs)
oracle("transition_check", f"""{with_(PARTS, STATES)},
req AS (
  SELECT LocationID AS location_id, mdm_state AS from_state,
    (['PROPOSED', 'ACTIVE', 'DEPRECATED', 'RETIRED', 'REJECTED'])[((LocationID + 1) % 5) + 1] AS to_state,
    {CLOCK} AS created_at_utc, {CLOCK} AS updated_at_utc,
    CASE WHEN service_zone IS NOT NULL THEN 'raw_reference' END AS source_system,
    CASE WHEN LENGTH(Zone) > 9 THEN {CLOCK} END AS deprecated_at_utc,
    'superseded' AS deprecated_reason, {CLOCK} AS submitted_at_utc
  FROM st),
edges(from_state, to_state) AS (VALUES ('PROPOSED', 'ACTIVE'), ('PROPOSED', 'REJECTED'), ('ACTIVE', 'DEPRECATED'),
  ('DEPRECATED', 'RETIRED'), ('DEPRECATED', 'ACTIVE')),
chk AS (
  SELECT r.*, e.from_state IS NOT NULL AS is_allowed, CONCAT_WS(',', {_miss}) AS missing_fields
  FROM req r LEFT JOIN edges e ON r.from_state = e.from_state AND r.to_state = e.to_state)
SELECT *, is_allowed AND missing_fields = '' AS is_valid FROM chk""")
oracle("retention_expired", f"""{with_(PARTS, STATES)},
r AS (SELECT *, CAST(state_date + CAST(CASE mdm_state WHEN 'ACTIVE' THEN 3650 WHEN 'DEPRECATED' THEN 3650
         WHEN 'RETIRED' THEN 3650 WHEN 'REJECTED' THEN 365 END AS INTEGER) AS DATE) AS retention_until FROM st)
SELECT *, TRUE AS is_expired FROM r WHERE retention_until < DATE '2035-01-01'""")

NEWSNAP = """
sized AS (SELECT CAST(p_partkey AS INTEGER) AS LocationID, p_brand AS Borough, p_name AS Zone, p_type AS service_zone,
                 p_size FROM part),
newsnap AS (
  SELECT LocationID, Borough, Zone,
    CASE WHEN p_size <= 6 THEN service_zone || ' REVISED' ELSE service_zone END AS service_zone
  FROM sized WHERE p_size > 2
  UNION ALL
  SELECT -LocationID - 1, Borough, Zone, service_zone FROM sized WHERE p_size >= 49
)"""
oracle("master_cdc", f"""{with_(PARTS, NEWSNAP)}
SELECT COALESCE(n.LocationID, o.LocationID) AS LocationID,
  CASE WHEN n.LocationID IS NULL THEN o.Borough ELSE n.Borough END AS Borough,
  CASE WHEN n.LocationID IS NULL THEN o.Zone ELSE n.Zone END AS Zone,
  CASE WHEN n.LocationID IS NULL THEN o.service_zone ELSE n.service_zone END AS service_zone,
  CASE WHEN o.LocationID IS NULL THEN 'INSERT' WHEN n.LocationID IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS change_type
FROM parts o FULL OUTER JOIN newsnap n ON o.LocationID = n.LocationID
WHERE o.LocationID IS NULL OR n.LocationID IS NULL
   OR o.Borough IS DISTINCT FROM n.Borough OR o.Zone IS DISTINCT FROM n.Zone
   OR o.service_zone IS DISTINCT FROM n.service_zone""")
oracle("run_summary", f"""{with_(TRIPS, ZONES, MASTER, ORPH)}
SELECT 'audit/history' AS audit_history_out_path, 'curated/trips' AS curated_trips_path,
  'audit/lifecycle' AS lifecycle_snapshot_path, 'master/zones' AS master_zones_path,
  'audit/orphans' AS orphans_out_path, {JOB} AS job_name, COUNT(*) AS orphans_count, {CLOCK} AS generated_at_utc
FROM orph""")

# ----------------------------------------------------------------------------------- snapshots

oracle("snapshot_current", f"{with_(TRIPS, VALIDATED)}\nSELECT * FROM validated")
oracle("partition_day_counts", f"{with_(TRIPS, VALIDATED)}\nSELECT pickup_date, COUNT(*) AS trips FROM validated GROUP BY ALL")
oracle("time_travel_version", f"{with_(PARTS)}\nSELECT * FROM parts")
oracle("time_travel_timestamp", f"{with_(PARTS, NEWSNAP)}\nSELECT * FROM newsnap")
oracle("snapshot_append_current", f"""{with_(PARTS, NEWSNAP)}
SELECT * FROM newsnap UNION ALL SELECT * FROM newsnap WHERE LocationID < 0""")
oracle("table_history", f"""{with_(PARTS, NEWSNAP, TRIPS, VALIDATED)},
h(table_name, version, operation, committed_at_utc, num_output_rows, mode) AS (
  SELECT 'master_zones', 0::BIGINT, 'WRITE', TIMESTAMP '2025-01-01 00:00:00', (SELECT COUNT(*) FROM parts), 'Overwrite'
  UNION ALL SELECT 'master_zones', 1, 'WRITE', TIMESTAMP '2025-01-01 01:00:00', (SELECT COUNT(*) FROM newsnap), 'Overwrite'
  UNION ALL SELECT 'master_zones', 2, 'APPEND', TIMESTAMP '2025-01-01 02:00:00',
    (SELECT COUNT(*) FROM newsnap WHERE LocationID < 0), 'Append'
  UNION ALL SELECT 'curated_trips', 0, 'WRITE', TIMESTAMP '2025-01-01 00:00:00', (SELECT COUNT(*) FROM validated),
    'Overwrite')
SELECT *, {JOB} AS job_name, {CLOCK} AS captured_at_utc FROM h""")
_GATE_TRIPS = with_(TRIPS, __import__("lakeward.plans.oracles", fromlist=["flagged_cte"]).flagged_cte())
oracle("pipeline_runs", f"""{_GATE_TRIPS}
SELECT {JOB} AS job_name, 'dev' AS environment, 'SUCCEEDED' AS status, CAST(NULL AS VARCHAR) AS error_message,
  COUNT(*) AS records_in, COUNT(*) FILTER (WHERE dq_pass) AS records_out,
  COUNT(*) FILTER (WHERE NOT dq_pass) AS rejects_count
FROM flagged""")
oracle("gate_curated_written", f"{_GATE_TRIPS}\nSELECT * EXCLUDE (dq_pass) FROM flagged WHERE dq_pass")
oracle("gate_quarantine_written", f"{_GATE_TRIPS}\nSELECT * FROM flagged WHERE NOT dq_pass")
oracle("gate_report_json", f"""{_GATE_TRIPS}
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE dq_pass) AS passed_rows,
  COUNT(*) FILTER (WHERE NOT dq_pass) AS failed_rows,
  COUNT(*) FILTER (WHERE NOT pickup_before_dropoff) AS pickup_before_dropoff_fail_count,
  COUNT(*) FILTER (WHERE NOT ratecode_range) AS ratecode_range_fail_count, {JOB} AS job_name
FROM flagged""")
oracle("gate_stream_passed", ORACLES["gate_curated_written"])
oracle("gate_stream_report", f"""{_GATE_TRIPS}
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE dq_pass) AS passed_rows,
  COUNT(*) FILTER (WHERE NOT dq_pass) AS failed_rows,
  COUNT(*) FILTER (WHERE NOT pickup_before_dropoff) AS pickup_before_dropoff_fail_count,
  COUNT(*) FILTER (WHERE NOT ratecode_range) AS ratecode_range_fail_count
FROM flagged""")
oracle("gate_stop", f"""{GATE}, rep AS (
  SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE dq_pass) AS passed_rows,
    COUNT(*) FILTER (WHERE NOT dq_pass) AS failed_rows FROM flagged)
SELECT *, total_rows > 0 AND passed_rows / total_rows < 0.95::DOUBLE AS stopped,
  CASE WHEN total_rows > 0 AND passed_rows / total_rows < 0.95::DOUBLE THEN 0 ELSE 1 END::BIGINT AS curated_versions
FROM rep""")
oracle("catalog_tables", ORACLES["golden_master"])
oracle("dup_evidence_csv", ORACLES["dup_by_match_key"])
oracle("schema_evolution", """
SELECT CAST(p_partkey AS BIGINT) + CASE WHEN p_partkey % 3 = 1 THEN 3000000000 ELSE 0 END AS LocationID,
  p_brand AS Borough, p_name AS Zone, p_type AS service_zone, CASE WHEN p_partkey % 3 = 1 THEN p_size END AS p_size,
  CASE WHEN p_partkey % 3 = 2 THEN TRUE END AS reviewed
FROM part""")
oracle("history_appended", f"""{with_(PARTS, NEWSNAP, TRIPS, VALIDATED)},
h(snapshot_id, table_name, version, operation, committed_at_utc, num_output_rows, mode) AS (
  SELECT 1::BIGINT, 'master_zones', 0::BIGINT, 'WRITE', TIMESTAMP '2025-01-01 00:00:00', (SELECT COUNT(*) FROM parts), 'Overwrite'
  UNION ALL SELECT 2, 'master_zones', 1, 'WRITE', TIMESTAMP '2025-01-01 01:00:00', (SELECT COUNT(*) FROM newsnap), 'Overwrite'
  UNION ALL SELECT 3, 'curated_trips', 0, 'WRITE', TIMESTAMP '2025-01-01 00:00:00', (SELECT COUNT(*) FROM validated), 'Overwrite'
  UNION ALL SELECT 4, 'master_zones', 2, 'APPEND', TIMESTAMP '2025-01-01 02:00:00',
    (SELECT COUNT(*) FROM newsnap WHERE LocationID < 0), 'Append')
SELECT *, {JOB} AS job_name, {CLOCK} AS captured_at_utc FROM h""")
oracle("archive_expired", ORACLES["retention_expired"])

# ---------------------------------------------------------------------------------- stewardship

GOLD = f"""
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY match_key ORDER BY location_id NULLS FIRST,
             Borough NULLS FIRST, Zone NULLS FIRST, service_zone NULLS FIRST, zone_norm NULLS FIRST,
             borough_norm NULLS FIRST) AS rn FROM zk),
gold AS (SELECT * EXCLUDE (rn), 'ACTIVE' AS mdm_state, {CLOCK} AS created_at_utc, {CLOCK} AS updated_at_utc,
  'min(location_id) per match_key' AS survivorship_rule FROM ranked WHERE rn = 1)"""
oracle("master_table_shape", f"""{with_(PARTS, std('parts'), GOLD)}
SELECT ROW_NUMBER() OVER (ORDER BY match_key) AS golden_id, location_id, Borough AS borough, Zone AS zone_name,
  service_zone, match_key, CAST(1 AS DECIMAL(5,4)) AS match_confidence, survivorship_rule, mdm_state,
  'raw_reference' AS source_system, created_at_utc, updated_at_utc, 'data_owner_masterdata' AS data_owner,
  'data_steward_masterdata' AS data_steward, 'internal' AS classification, 'v1' AS version_tag
FROM gold""")
QUEUE = f"""
queue AS (
  SELECT ROW_NUMBER() OVER (ORDER BY s.id_a, s.id_b, s.zone_a, s.zone_b, s.borough) AS queue_id,
    s.id_b AS location_id, r.Borough AS borough,
    r.Zone AS zone_name, r.service_zone, r.match_key, CAST(s.match_confidence AS DECIMAL(5,4)) AS match_confidence,
    s.decision, 'possible duplicate of ' || CAST(s.id_a AS VARCHAR) || ' (' || s.zone_a || ')' AS review_reason,
    'OPEN' AS status, 'data_steward_masterdata' AS assigned_to, {CLOCK} AS submitted_at_utc,
    {CLOCK} AS updated_at_utc
  FROM keyed s JOIN gold r ON r.zone_norm = s.zone_b AND r.borough_norm = s.borough
  WHERE s.decision = 'STEWARD_REVIEW'
),
verdicts AS (SELECT queue_id, (['OPEN', 'IN_REVIEW', 'APPROVED', 'REJECTED'])[queue_id % 4 + 1] AS verdict FROM queue),
applied AS (
  SELECT q.* REPLACE (verdict AS status,
    CASE WHEN verdict <> status THEN TIMESTAMP '2025-01-02 00:00:00' ELSE updated_at_utc END AS updated_at_utc)
  FROM queue q JOIN verdicts USING (queue_id)
)"""
REVIEW = f"{PARTS_M}, {KEYED}, {GOLD}, {QUEUE}"
oracle("steward_queue_table", f"{REVIEW}\nSELECT * FROM queue")
oracle("steward_apply", f"{REVIEW}\nSELECT * FROM applied")
oracle("steward_master_after", f"""{REVIEW}
SELECT g.location_id, g.match_key,
  CASE WHEN a.match_key IS NOT NULL AND g.mdm_state = 'ACTIVE' THEN 'DEPRECATED' ELSE g.mdm_state END AS mdm_state,
  CASE WHEN a.match_key IS NOT NULL AND g.mdm_state = 'ACTIVE' THEN TIMESTAMP '2025-01-02 00:00:00'
       ELSE g.updated_at_utc END AS updated_at_utc
FROM gold g LEFT JOIN (SELECT DISTINCT match_key FROM applied WHERE status = 'APPROVED') a
  ON g.match_key = a.match_key""")
oracle("match_jaro_winkler", f"""{PARTS_M}
SELECT borough, LEAST(zone_a, zone_b) AS zone_u, GREATEST(zone_a, zone_b) AS zone_v, COUNT(*) AS pair_count,
  {r4('JARO_WINKLER_SIMILARITY(LEAST(zone_a, zone_b), GREATEST(zone_a, zone_b))')} AS jaro_winkler
FROM scored WHERE match_confidence >= 0.8::DOUBLE GROUP BY ALL""")
