"""Session helpers: building a local session for tests/bench, and the shared folder.

Library functions never create sessions; they take the caller's. Only tests, the bench and
command-line jobs build one here.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


# Settings for the cluster profile (about 1,000 executors, inputs of ~100 TB). Sessions are built
# by the cluster's launcher; these are the values the jobs are planned for, applied with
# ``apply_profile`` (only keys the launcher left unset are set).
CLUSTER_PROFILE: dict[str, str] = {
    # AQE re-plans at every stage boundary: coalesces small shuffle partitions, splits skewed
    # partitions of sort-merge / shuffled-hash joins and of rebalances, turns small sides into
    # broadcasts from measured sizes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # initial shuffle width for ~100 TB: ~256 MB per partition after the map-side combine; AQE
    # coalesces it down for the smaller stages
    "spark.sql.shuffle.partitions": "20000",
    # scan splits: fewer, larger tasks for columnar files
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.files.openCostInBytes": "8m",
    # static broadcast only for small sides; larger ones stay shuffle joins
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": UTC,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    # lost executors: shuffle files survive on the external shuffle service / decommissioning
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
}


def apply_profile(spark: SparkSession, profile: dict[str, str] = CLUSTER_PROFILE) -> None:
    """Set the runtime-settable SQL keys of ``profile`` that the session does not set yet."""
    for k, v in profile.items():
        if not k.startswith("spark.sql."):
            continue  # cluster-level keys belong to the launcher
        if not _explicitly_set(spark, k):
            spark.conf.set(k, v)


def _explicitly_set(spark: SparkSession, key: str) -> bool:
    # set by the launcher, or later at run time
    return spark.sparkContext.getConf().contains(key) or key in dict(spark.conf.getAll)


def _listing_tasks(cores: int | str) -> int:
    n = (os.cpu_count() or 8) if str(cores) == "*" else int(cores)
    return 4 * n


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakeward") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UTC, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # file listing of a day-partitioned table: one listing task per folder by default
        # (up to 10,000); a few tasks per core is enough and saves the scheduling cost
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(_listing_tasks(cores)))
        .config("spark.driver.memory", os.environ.get("LAKEWARD_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """All governed timestamps are UTC (`*_utc` columns); make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read as is. Only when it is unset
    (tests, local runs) a fresh local folder is created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="lakeward-ckpt-")
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-path of the shared folder for one product or run."""
    return f"{shared_dir(spark)}/lakeward/{name}-{uuid.uuid4().hex[:12]}"
