"""Master-data lifecycle and audit: orphans, state snapshot, transition checks, retention,
change capture between snapshots, run summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import governance as gov
from ..functions.casts import to_int
from ..functions.time import stamp
from ..sources.files import require_columns, resolve_any


def master_ids(master: DataFrame) -> DataFrame:
    """Distinct integer ids of the master (``LocationID`` or ``location_id``); bad text dropped."""
    idc = resolve_any(master, "LocationID", "location_id", what="master")
    return master.select(to_int(master, idc).alias("_mid")).dropna().distinct()


def orphans(trips: DataFrame, master: DataFrame, job_name: str, now=None,
            roles=(("PULocationID", gov.PICKUP_ORPHAN), ("DOLocationID", gov.DROPOFF_ORPHAN))) -> DataFrame:
    """Trips whose location id is not in the master, one row per (trip, failing role).

    A trip failing both roles appears twice. NULL or non-integer ids are orphans. Written as one
    scan of the facts: each role is a left join to the bounded, broadcast master key set, and the
    failing roles are exploded — instead of one anti join and one full fact scan per role.
    """
    require_columns(trips, *[k for k, _ in roles], what="trips")
    ids = master_ids(master)
    df = trips.withColumns({f"{k}_int": to_int(trips, k) for k, _ in roles})
    for i, (k, _) in enumerate(roles):
        df = df.join(ids.select(F.col("_mid").alias(f"_hit{i}")), F.col(f"{k}_int") == F.col(f"_hit{i}"), "left")
    kinds = F.array(*[F.when(F.col(f"_hit{i}").isNull(), F.lit(t)) for i, (_, t) in enumerate(roles)])
    out = (df.withColumn("orphan_type", F.explode(F.array_compact(kinds)))
             .drop(*[f"_hit{i}" for i in range(len(roles))]))
    return out.withColumns({"job_name": F.lit(job_name), "detected_at_utc": stamp(now)})


def lifecycle_snapshot(master: DataFrame, job_name: str, now=None, default_state: str = gov.MASTER_DEFAULT_STATE) -> DataFrame:
    """Row count per ``mdm_state`` (NULL is its own group); all rows count as the default state
    when the column is missing (an empty master gives no row)."""
    state = F.col("mdm_state") if "mdm_state" in master.columns else F.lit(default_state)
    return (master.groupBy(state.alias("mdm_state")).agg(F.count(F.lit(1)).alias("record_count"))
                  .withColumns({"job_name": F.lit(job_name), "snapshot_at_utc": stamp(now)}))


def transition_edges_df(spark: SparkSession, states=gov.LIFECYCLE_STATES) -> DataFrame:
    """The allowed (from_state, to_state) edges as a small frame (size fixed by the state machine)."""
    return spark.createDataFrame([(s, t) for s, (targets, _) in states.items() for t in targets],
                                 "from_state string, to_state string")


def transition_check(spark: SparkSession, changes: DataFrame, states=gov.LIFECYCLE_STATES) -> DataFrame:
    """Validate change requests (``from_state`` -> ``to_state``): is the edge allowed, and are the
    fields required by the target state present (non-NULL)?

    Adds ``is_allowed``, ``missing_fields`` (comma-separated, in declared order; a required column
    absent from the frame counts as missing) and ``is_valid``. The edge table has a size fixed by
    the state machine, so it is broadcast.
    """
    edges = transition_edges_df(spark, states).withColumn("_edge", F.lit(True))
    j = changes.join(F.broadcast(edges), ["from_state", "to_state"], "left")
    missing: list[Column] = []
    for state, (_, required) in states.items():
        for f in required:
            absent = F.col(f).isNull() if f in changes.columns else F.lit(True)
            missing.append(F.when((F.col("to_state") == F.lit(state)) & absent, F.lit(f)))
    miss = F.concat_ws(",", F.array_compact(F.array(*missing)))
    return (j.withColumn("is_allowed", F.coalesce(F.col("_edge"), F.lit(False))).drop("_edge")
             .withColumn("missing_fields", miss)
             .withColumn("is_valid", F.col("is_allowed") & (F.col("missing_fields") == F.lit(""))))


def retention_days_expr(state: Column, days=gov.RETENTION_DAYS) -> Column:
    """Retention days of a state as a literal map lookup (NULL for states without retention)."""
    m = F.create_map(*[x for k, v in days.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, state)


def with_retention(master: DataFrame, as_of: str, state_date: str = "state_date", days=gov.RETENTION_DAYS) -> DataFrame:
    """Adds ``retention_until = state_date + days(state)`` and ``is_expired`` (strictly before ``as_of``).

    A pure projection: the state -> days table is a literal map, no join.
    """
    until = F.date_add(F.col(state_date), retention_days_expr(F.col("mdm_state"), days))
    return (master.withColumn("retention_until", until)
                  .withColumn("is_expired", F.coalesce(F.col("retention_until") < F.lit(as_of).cast("date"), F.lit(False))))


def split_expired(master: DataFrame, as_of: str, **kw) -> tuple[DataFrame, DataFrame]:
    """(rows to archive, rows that stay); the archive is append-only, nothing is deleted in place."""
    r = with_retention(master, as_of, **kw)
    return r.filter(F.col("is_expired")), r.filter(~F.col("is_expired"))


def change_capture(old: DataFrame, new: DataFrame, key: str, compare: list[str] | None = None) -> DataFrame:
    """INSERT / UPDATE / DELETE rows between two snapshots on ``key`` (unchanged rows omitted).

    One full outer join on the key; a row is an UPDATE when any compared column differs
    (NULL-safe). Values are the new ones, or the old ones for a DELETE.
    """
    compare = compare if compare is not None else [c for c in new.columns if c != key]
    o = old.select(F.col(key).alias("_k_old"), *[F.col(c).alias(f"_o_{c}") for c in compare])
    n = new.select(F.col(key).alias("_k_new"), *[F.col(c).alias(f"_n_{c}") for c in compare])
    j = o.join(n, F.col("_k_old") == F.col("_k_new"), "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}")) for c in compare], F.lit(True))
    kind = (F.when(F.col("_k_old").isNull(), F.lit("INSERT"))
             .when(F.col("_k_new").isNull(), F.lit("DELETE"))
             .when(~same, F.lit("UPDATE")))
    j = j.withColumn("change_type", kind).filter(F.col("change_type").isNotNull())
    is_del = F.col("change_type") == F.lit("DELETE")
    return j.select(F.coalesce("_k_new", "_k_old").alias(key),
                    *[F.when(is_del, F.col(f"_o_{c}")).otherwise(F.col(f"_n_{c}")).alias(c) for c in compare],
                    "change_type")


def apply_changes(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Replay a change set onto the old snapshot (used to verify CDC: result == new)."""
    cols = [c for c in old.columns]
    kept = old.join(changes.select(key), key, "left_anti")
    upserts = changes.filter(F.col("change_type") != "DELETE").select(*cols)
    return kept.select(*cols).unionByName(upserts)


def run_summary(orphan_rows: DataFrame, paths: dict[str, str], job_name: str, now=None) -> DataFrame:
    """One summary row: paths, job name, orphan count (aggregated on the executors), time."""
    return orphan_rows.agg(F.count(F.lit(1)).alias("orphans_count")).select(
        *[F.lit(v).alias(k) for k, v in sorted(paths.items())], F.lit(job_name).alias("job_name"),
        "orphans_count", stamp(now).alias("generated_at_utc"))
