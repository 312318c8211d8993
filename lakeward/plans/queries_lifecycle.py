"""Registered lifecycle / audit queries (L-01, L-02, L-04..L-07, J-04, J-05, J-08, J-09, U-01, A-06..A-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import governance as gov
from ..operators import lifecycle as lc
from ..sources import fixtures as fx
from .catalog import JOB_NAME, RUN_CLOCK, query

RETENTION_AS_OF = "2035-01-01"


def _orphans(spark, sf_dir):
    return lc.orphans(fx.trips(spark, sf_dir), fx.master_zones(spark, sf_dir), JOB_NAME, now=RUN_CLOCK)


@query("orphans_all")
def orphans_all(spark, sf_dir):
    """Trips whose pickup or dropoff location is not in the master, one row per failing role."""
    return _orphans(spark, sf_dir)


@query("orphans_pickup")
def orphans_pickup(spark, sf_dir):
    """Pickup-side orphans only."""
    return _orphans(spark, sf_dir).filter(F.col("orphan_type") == gov.PICKUP_ORPHAN)


@query("orphans_dropoff")
def orphans_dropoff(spark, sf_dir):
    """Dropoff role alone: trips whose dropoff location is not in the master (one anti role)."""
    return lc.orphans(fx.trips(spark, sf_dir), fx.master_zones(spark, sf_dir), JOB_NAME, now=RUN_CLOCK,
                      roles=(("DOLocationID", gov.DROPOFF_ORPHAN),))


@query("lifecycle_snapshot")
def lifecycle_snapshot(spark, sf_dir):
    """Entity count per lifecycle state."""
    return lc.lifecycle_snapshot(fx.with_state(fx.part_entities(spark, sf_dir)), JOB_NAME, now=RUN_CLOCK)


@query("lifecycle_snapshot_default")
def lifecycle_snapshot_default(spark, sf_dir):
    """Master without a state column: every entity counts as ACTIVE."""
    return lc.lifecycle_snapshot(fx.part_entities(spark, sf_dir), JOB_NAME, now=RUN_CLOCK)


@query("transition_check")
def transition_check(spark, sf_dir):
    """State-change requests checked against allowed edges and required fields of the target."""
    return lc.transition_check(spark, fx.change_requests(fx.part_entities(spark, sf_dir), RUN_CLOCK))


@query("retention_expired")
def retention_expired(spark, sf_dir):
    """Entities past their retention date at the as-of day (to be moved to the archive)."""
    expired, _ = lc.split_expired(fx.with_state(fx.part_entities(spark, sf_dir)), RETENTION_AS_OF)
    return expired


@query("master_cdc")
def master_cdc(spark, sf_dir):
    """INSERT / UPDATE / DELETE between two snapshots of the part master."""
    old = fx.part_entities(spark, sf_dir)
    new = fx.changed_snapshot(fx.part_entities_sized(spark, sf_dir)).drop("p_size")
    return lc.change_capture(old, new, "LocationID")


@query("run_summary")
def run_summary(spark, sf_dir):
    """One summary row of the orphan job: product paths, orphan count, time."""
    paths = {"master_zones_path": "master/zones", "curated_trips_path": "curated/trips",
             "orphans_out_path": "audit/orphans", "lifecycle_snapshot_path": "audit/lifecycle",
             "audit_history_out_path": "audit/history"}
    return lc.run_summary(_orphans(spark, sf_dir), paths, JOB_NAME, now=RUN_CLOCK)
