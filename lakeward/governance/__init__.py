"""Declared governance configuration: rule catalogue, thresholds, lifecycle states, trip schema.

Everything in this module is data. Operators take these values as default arguments, so a
caller can pass a different rule list, threshold or state machine without touching code.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — these must equal the governed-lake specification being re-implemented
# (rule ids, dimensions, severities, SQL predicates, thresholds, states, transitions, required
# fields, retention days, trip schema). Kept verbatim, in their natural order.
# ---------------------------------------------------------------------------------------------

DEFAULT_MIN_PASS_RATE = 0.95

HIGH_CONFIDENCE = 0.95
MEDIUM_CONFIDENCE = 0.80

# Match confidence: weight of the name similarity, weight of the first-token match.
CONFIDENCE_WEIGHTS = (0.90, 0.10)

# Heuristic scorer of the declared match rules: exact key -> 1.0, otherwise 0.85.
HEURISTIC_EXACT_SCORE = 1.0
HEURISTIC_OTHER_SCORE = 0.85

# (id, dimension, severity, expression_sql, action_on_fail)
DECLARED_RULES = [
    ("trip_vendor_not_null", "completeness", "high", "VendorID IS NOT NULL", "reject"),
    ("pickup_not_null", "completeness", "high", "tpep_pickup_datetime IS NOT NULL", "reject"),
    ("dropoff_not_null", "completeness", "high", "tpep_dropoff_datetime IS NOT NULL", "reject"),
    ("pickup_before_dropoff", "validity", "high", "tpep_pickup_datetime <= tpep_dropoff_datetime", "reject"),
    ("pu_location_not_null", "completeness", "high", "PULocationID IS NOT NULL", "reject"),
    ("do_location_not_null", "completeness", "high", "DOLocationID IS NOT NULL", "reject"),
    ("trip_distance_non_negative", "validity", "medium", "trip_distance IS NULL OR trip_distance >= 0", "reject"),
    ("fare_amount_non_negative", "validity", "medium", "fare_amount IS NULL OR fare_amount >= 0", "reject"),
    ("total_amount_non_negative", "validity", "medium", "total_amount IS NULL OR total_amount >= 0", "reject"),
    ("passenger_count_range", "validity", "low",
     "passenger_count IS NULL OR (passenger_count >= 0 AND passenger_count <= 8)", "reject"),
]

# Code-level rule set of the gate job: (rule, kind, columns, bounds, dimension, severity).
# "known": the column is not NULL; "ordered": first <= second as timestamps; "within": NULL or
# inside the inclusive bounds (None: open). "pickup" and "dropoff" stand for the timestamp
# column found among the gate's candidates below.
GATE_RULES = [
    ("vendor_not_null", "known", ("VendorID",), None, "completeness", "high"),
    ("pickup_not_null", "known", ("pickup",), None, "completeness", "high"),
    ("dropoff_not_null", "known", ("dropoff",), None, "completeness", "high"),
    ("pickup_before_dropoff", "ordered", ("pickup", "dropoff"), None, "validity", "high"),
    ("pu_location_not_null", "known", ("PULocationID",), None, "completeness", "high"),
    ("do_location_not_null", "known", ("DOLocationID",), None, "completeness", "high"),
    ("trip_distance_non_negative", "within", ("trip_distance",), (0, None), "validity", "medium"),
    ("fare_amount_non_negative", "within", ("fare_amount",), (0, None), "validity", "medium"),
    ("total_amount_non_negative", "within", ("total_amount",), (0, None), "validity", "medium"),
    ("tip_amount_non_negative", "within", ("tip_amount",), (0, None), "validity", "medium"),
    ("tolls_amount_non_negative", "within", ("tolls_amount",), (0, None), "validity", "medium"),
    ("extra_non_negative", "within", ("extra",), (0, None), "validity", "medium"),
    ("passenger_count_range", "within", ("passenger_count",), (0, 8), "validity", "low"),
    ("ratecode_range", "within", ("RatecodeID",), (1, 6), "validity", "low"),
]

# Pickup/dropoff name candidates: the ingest job and the gate job probe them in different orders.
INGEST_PICKUP_CANDIDATES = ["tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"]
INGEST_DROPOFF_CANDIDATES = ["tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime"]
GATE_PICKUP_CANDIDATES = ["tpep_pickup_datetime", "pickup_datetime", "lpep_pickup_datetime"]
GATE_DROPOFF_CANDIDATES = ["tpep_dropoff_datetime", "dropoff_datetime", "lpep_dropoff_datetime"]

# Lifecycle state machine: state -> (allowed next states, required fields)
LIFECYCLE_STATES = {
    "PROPOSED": (["ACTIVE", "REJECTED"], ["submitted_at_utc", "submitted_by", "review_reason"]),
    "ACTIVE": (["DEPRECATED"], ["created_at_utc", "updated_at_utc", "source_system"]),
    "DEPRECATED": (["RETIRED", "ACTIVE"], ["deprecated_at_utc", "deprecated_reason"]),
    "RETIRED": ([], ["retired_at_utc", "retired_reason", "retention_until"]),
    "REJECTED": ([], ["rejected_at_utc", "reject_reason"]),
}
RETENTION_DAYS = {"ACTIVE": 3650, "DEPRECATED": 3650, "RETIRED": 3650, "REJECTED": 365}

# Steward queue statuses of the relational queue table.
STEWARD_STATUSES = ["OPEN", "IN_REVIEW", "APPROVED", "REJECTED"]

# Declared trip schema (name, type) in file order.
TRIP_SCHEMA = [
    ("VendorID", "int"), ("tpep_pickup_datetime", "timestamp"), ("tpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "int"), ("trip_distance", "double"), ("RatecodeID", "int"),
    ("store_and_fwd_flag", "string"), ("PULocationID", "int"), ("DOLocationID", "int"),
    ("payment_type", "int"), ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"),
    ("tip_amount", "double"), ("tolls_amount", "double"), ("improvement_surcharge", "double"),
    ("total_amount", "double"), ("congestion_surcharge", "double"), ("airport_fee", "double"),
    ("cbd_congestion_fee", "double"),
]

# Literal stamps written by the jobs.
SOURCE_SYSTEM = "NYC_TLC"
ZONE_VALIDATED = "validated"
ZONE_CURATED = "curated"
MASTER_SURVIVORSHIP_TEXT = "min(location_id) per match_key"
MASTER_DEFAULT_STATE = "ACTIVE"
MASTER_SOURCE_SYSTEM = "raw_reference"
MASTER_OWNER = "data_owner_masterdata"
MASTER_STEWARD = "data_steward_masterdata"
PENDING = "PENDING"
PICKUP_ORPHAN = "PICKUP_NOT_IN_MASTER"
DROPOFF_ORPHAN = "DROPOFF_NOT_IN_MASTER"
AUTO_MERGE = "AUTO_MERGE"
STEWARD_REVIEW = "STEWARD_REVIEW"
REJECT = "REJECT"

# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleSpec:
    """One declared quality rule (SQL predicate text; Spark parses it)."""

    id: str
    dimension: str
    severity: str
    expression_sql: str
    action_on_fail: str = "reject"


def declared_rules() -> list[RuleSpec]:
    return [RuleSpec(*r) for r in DECLARED_RULES]


def transition_edges() -> list[tuple[str, str]]:
    return [(src, dst) for src, (targets, _) in LIFECYCLE_STATES.items() for dst in targets]


@dataclass(frozen=True)
class MatchThresholds:
    high: float = HIGH_CONFIDENCE
    medium: float = MEDIUM_CONFIDENCE
