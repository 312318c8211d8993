"""Steward workflow in the relational shapes: master table, review queue, applying decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import governance as gov
from ..functions.text import concat_key
from ..functions.time import stamp
from ..sources.files import resolve_any
from .keys import dense_ids
from .matching import ID


def raw_attributes(golden: DataFrame, borough: str = "Borough", zone: str | None = None,
                   service_zone: str = "service_zone") -> dict[str, Column]:
    """The attributes as they came (borough, zone_name, service_zone) of any golden rows that
    ``standardize`` accepts: a missing block is UNKNOWN, a missing service zone NULL."""
    zone = zone or resolve_any(golden, "Zone", "zone_name", what="golden rows")
    return {"borough": F.col(borough) if borough in golden.columns else F.lit("UNKNOWN"),
            "zone_name": F.col(zone),
            "service_zone": F.col(service_zone) if service_zone in golden.columns else F.lit(None).cast("string")}


def master_table(golden: DataFrame, classification: str = "internal", version_tag: str = "v1",
                 **columns: str) -> DataFrame:
    """Golden rows in the master-table shape, ``golden_id`` = 1..n by match key.

    ``columns`` names the raw attributes where they differ (``borough``, ``zone``, ``service_zone``).
    """
    raw = raw_attributes(golden, **columns)
    g = dense_ids(golden, ["match_key"], "golden_id")
    return g.select(
        "golden_id", F.col(ID), *[c.alias(n) for n, c in raw.items()],
        "match_key", F.lit(1).cast("decimal(5,4)").alias("match_confidence"), "survivorship_rule", "mdm_state",
        F.lit(gov.MASTER_SOURCE_SYSTEM).alias("source_system"), "created_at_utc", "updated_at_utc",
        F.lit(gov.MASTER_OWNER).alias("data_owner"), F.lit(gov.MASTER_STEWARD).alias("data_steward"),
        F.lit(classification).alias("classification"), F.lit(version_tag).alias("version_tag"))


def queue_table(decisions: DataFrame, golden: DataFrame, now=None, assignee: str = gov.MASTER_STEWARD,
                **columns: str) -> DataFrame:
    """STEWARD_REVIEW pairs of keys as queue entries about the later key's golden record, status
    OPEN, ``queue_id`` = 1..n by (id_a, id_b, names, block), a total order.

    ``golden`` has one row per match key, so entries do not multiply when an id was loaded twice.
    """
    raw = raw_attributes(golden, **columns)
    record = golden.select("match_key", *[c.alias(f"_raw_{n}") for n, c in raw.items()])
    review = decisions.filter(F.col("decision") == gov.STEWARD_REVIEW).withColumn(
        "match_key", concat_key("borough", "zone_b"))
    pairs = dense_ids(review.join(record, "match_key"), ["id_a", "id_b", "zone_a", "zone_b", "borough"], "queue_id")
    ts = stamp(now)
    return pairs.select(
        "queue_id", F.col("id_b").alias("location_id"), *[F.col(f"_raw_{n}").alias(n) for n in raw], "match_key",
        F.col("match_confidence").cast("decimal(5,4)").alias("match_confidence"), "decision",
        F.concat(F.lit("possible duplicate of "), F.col("id_a").cast("string"), F.lit(" ("), F.col("zone_a"),
                 F.lit(")")).alias("review_reason"),
        F.lit("OPEN").alias("status"), F.lit(assignee).alias("assigned_to"),
        ts.alias("submitted_at_utc"), ts.alias("updated_at_utc"))


def apply_decisions(queue: DataFrame, decisions: DataFrame, now=None) -> DataFrame:
    """New queue state: a decided entry takes the decision's status (OPEN / IN_REVIEW / APPROVED /
    REJECTED) and a new ``updated_at_utc``; undecided entries are unchanged."""
    d = (decisions.select("queue_id", F.col("status").alias("_new"))
                  .filter(F.col("_new").isin(gov.STEWARD_STATUSES)))
    j = queue.join(d, "queue_id", "left")
    changed = F.col("_new").isNotNull() & (F.col("_new") != F.col("status"))
    return (j.withColumn("updated_at_utc", F.when(changed, stamp(now)).otherwise(F.col("updated_at_utc")))
             .withColumn("status", F.coalesce("_new", "status")).drop("_new"))


def master_after_approvals(master: DataFrame, queue: DataFrame, now=None,
                           from_state: str = "ACTIVE", to_state: str = "DEPRECATED") -> DataFrame:
    """Master rows whose match key was APPROVED as a duplicate move ACTIVE -> DEPRECATED (soft
    delete: the row stays). Approved keys are made distinct first, so the join cannot fan out."""
    approved = (queue.filter(F.col("status") == "APPROVED").select("match_key").distinct()
                     .withColumn("_approved", F.lit(True)))
    j = master.join(approved, "match_key", "left")
    hit = F.coalesce(F.col("_approved"), F.lit(False)) & (F.col("mdm_state") == F.lit(from_state))
    return (j.withColumns({"mdm_state": F.when(hit, F.lit(to_state)).otherwise(F.col("mdm_state")),
                           "updated_at_utc": F.when(hit, stamp(now)).otherwise(F.col("updated_at_utc"))})
             .select(*master.columns))
