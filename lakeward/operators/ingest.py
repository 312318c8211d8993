"""Raw -> validated (canonical timestamps, day column, minimal gates, governance stamp) and
validated -> curated enrichment (duration, role-playing zone lookups, curated stamp).

Both are narrow transformations over the fact table: filters and projections fuse into the
scan's codegen stage and the not-NULL / comparison filters are pushed into the parquet reader
where the source columns are already timestamps. The only join partner is the zone lookup,
broadcast behind a row-count check, so trips are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import governance as gov
from ..functions.time import as_timestamp, duration_minutes, stamp
from ..sources.files import preferred_column
from ..functions.casts import text_to_int, to_int


def resolve_trip_times(df: DataFrame,
                       pickup_candidates=gov.INGEST_PICKUP_CANDIDATES,
                       dropoff_candidates=gov.INGEST_DROPOFF_CANDIDATES) -> tuple[str, str]:
    pickup = preferred_column(df, pickup_candidates)
    dropoff = preferred_column(df, dropoff_candidates)
    if not pickup or not dropoff:
        raise ValueError(f"pickup/dropoff columns not found; columns={df.columns}")
    return pickup, dropoff


def with_canonical_times(df: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    """Adds ``pickup_ts``, ``dropoff_ts`` (TIMESTAMP; bad text -> NULL) and ``pickup_date``."""
    return df.withColumns({
        "pickup_ts": as_timestamp(df, pickup),
        "dropoff_ts": as_timestamp(df, dropoff),
    }).withColumn("pickup_date", F.to_date("pickup_ts"))


def ingest_filter(df: DataFrame) -> DataFrame:
    """Both timestamps present, dropoff >= pickup, and fare > 0 when a fare column exists
    (NULL, zero and unparsable fares are dropped)."""
    cond = F.col("pickup_ts").isNotNull() & F.col("dropoff_ts").isNotNull() & (F.col("dropoff_ts") >= F.col("pickup_ts"))
    if "fare_amount" in df.columns:
        cond = cond & (F.col("fare_amount").try_cast("double") > F.lit(0.0))
    return df.filter(cond)


def governance_stamp(df: DataFrame, zone: str, at_col: str, now=None, source_system: str | None = None) -> DataFrame:
    cols: dict[str, Column] = {"governance_zone": F.lit(zone), at_col: stamp(now)}
    if source_system is not None:
        cols["source_system"] = F.lit(source_system)
    return df.withColumns(cols)


def validate_trips(raw: DataFrame, now=None, source_system: str = gov.SOURCE_SYSTEM) -> DataFrame:
    """Raw trips -> validated trips (job 1 without its write)."""
    pickup, dropoff = resolve_trip_times(raw)
    df = ingest_filter(with_canonical_times(raw, pickup, dropoff))
    return governance_stamp(df, gov.ZONE_VALIDATED, "ingested_at", now, source_system)


def with_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_duration_min", duration_minutes(F.col("pickup_ts"), F.col("dropoff_ts")))


def standard_zone_lookup(zones: DataFrame) -> DataFrame:
    """Lookup columns renamed to location_id / zone_name / borough / service_zone (absent = no-op)."""
    return zones.withColumnsRenamed({"LocationID": "location_id", "Zone": "zone_name", "Borough": "borough"})


def role_lookup(lookup: DataFrame, prefix: str) -> DataFrame:
    """One role of the zone dimension: ``{prefix}_location_id, _zone, _borough, _service_zone``
    plus the integer join key ``_{prefix}_key`` (unparsable id text -> NULL, never matches)."""
    return lookup.select(
        F.col("location_id").alias(f"{prefix}_location_id"),
        F.col("zone_name").alias(f"{prefix}_zone"),
        F.col("borough").alias(f"{prefix}_borough"),
        F.col("service_zone").alias(f"{prefix}_service_zone"),
        text_to_int(F.col("location_id")).alias(f"_{prefix}_key"),
    )


def enrich_trips(validated: DataFrame, zones: DataFrame, now=None,
                 roles=(("PULocationID", "pu"), ("DOLocationID", "do"))) -> DataFrame:
    """Validated -> curated: duration, one left lookup join per present location role, stamp.

    Left joins keep trips without a zone; duplicate ids in the lookup multiply trips (the lookup
    is expected to be unique; see ``lookup_fanout``). How to join is left to the planner, which
    knows the measured sizes.
    """
    lookup = standard_zone_lookup(zones)
    df = with_duration(validated)
    for key, prefix in roles:
        if key not in df.columns:
            continue
        side = role_lookup(lookup, prefix)
        df = df.join(side, to_int(df, key) == F.col(f"_{prefix}_key"), "left").drop(f"_{prefix}_key")
    return governance_stamp(df, gov.ZONE_CURATED, "curated_at", now)


def lookup_fanout(zones: DataFrame) -> DataFrame:
    """Lookup ids present more than once (each such id multiplies the matching trips)."""
    lookup = standard_zone_lookup(zones)
    return (lookup.groupBy(text_to_int(F.col("location_id")).alias("location_id"))
                  .agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1))
