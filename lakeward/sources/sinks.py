"""Product sinks: versioned-table write with a format chosen before writing, and the routing of
each lake product to its format.

The table format is probed on the class path *before* anything is written (a failed write is
never retried in another format, so a real write error surfaces instead of being hidden).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import files
from .snapshots import SnapshotTable, delta_available


# ---------------------------------------------------------------------------------------------
# FIXED VALUES — which product is written in which format (and partitioned by what), as the lake
# jobs write them: versioned tables for the zones' main products, plain parquet for review
# products, one JSON file for run reports, header CSV for duplicate evidence.
# ---------------------------------------------------------------------------------------------
PRODUCT_FORMATS: dict[str, tuple[str, list[str]]] = {
    "validated_trips": ("table", ["pickup_date"]),
    "curated_trips": ("table", ["pickup_date"]),
    "quality_passed": ("table", []),
    "quarantine": ("parquet", []),
    "quality_report": ("json", []),
    "master_zones": ("table", []),
    "steward_queue": ("parquet", []),
    "auto_merge_pairs": ("parquet", []),
    "auto_merge_members": ("parquet", []),
    "reject_counts": ("parquet", []),
    "dup_by_location_id": ("csv", []),
    "dup_by_match_key": ("csv", []),
    "match_audit": ("json", []),
    "orphans": ("table", []),
    "lifecycle_snapshot": ("table", []),
    "audit_history": ("table", []),
    "run_summary": ("table", []),
}


@dataclass(frozen=True)
class TableFormat:
    """How a versioned table of one format is written and read."""

    available: Callable[[SparkSession], bool]
    write: Callable[[DataFrame, str, list[str], str, dict], None]
    read: Callable[[SparkSession, str], DataFrame]


def _write_delta(df: DataFrame, path: str, partition_by: list[str], mode: str, parameters: dict) -> None:
    w = df.write.format("delta").mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).save(path)


def _write_snapshot(df: DataFrame, path: str, partition_by: list[str], mode: str, parameters: dict) -> None:
    SnapshotTable(df.sparkSession, path).commit(df, mode=mode, partition_by=partition_by or None, parameters=parameters)


#: Formats in the order of preference; the last is always there.
TABLE_FORMATS: dict[str, TableFormat] = {
    "delta": TableFormat(delta_available, _write_delta, lambda spark, path: spark.read.format("delta").load(path)),
    "parquet": TableFormat(lambda spark: True, _write_snapshot, lambda spark, path: SnapshotTable(spark, path).read()),
}


def _format_path(path: str) -> str:
    return f"{path.rstrip('/')}-format"


def table_format(spark: SparkSession, path: str) -> str | None:
    """The format that the table at ``path`` is written in (recorded beside it); None for no table."""
    recorded = files.read_optional(spark, _format_path(path), lambda p: spark.read.schema("format string").json(p))
    row = recorded.first() if recorded is not None else None
    return row["format"] if row else None


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                parameters: dict | None = None) -> str:
    """Write ``df`` as a versioned table; returns the format used.

    A table keeps the format it has; a new one gets the first that is on the class path (``"delta"``,
    else ``"parquet"``: a snapshot-ledger table over parquet), recorded beside the table.
    """
    spark = df.sparkSession
    fmt = table_format(spark, path)
    if fmt is None:
        fmt = next(name for name, f in TABLE_FORMATS.items() if f.available(spark))
        spark.createDataFrame([(fmt,)], "format string").coalesce(1).write.mode("overwrite").json(_format_path(path))
    TABLE_FORMATS[fmt].write(df, path, partition_by or [], mode, parameters or {})
    return fmt


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table, by the reader of the format it was written in (a table that
    was committed to directly is a snapshot table)."""
    return TABLE_FORMATS[table_format(spark, path) or "parquet"].read(spark, path)


def write_product(df: DataFrame, product: str, path: str, parameters: dict | None = None) -> str:
    """Write one lake product in its routed format; returns the format used."""
    fmt, partition_by = PRODUCT_FORMATS[product]
    if fmt == "table":
        return write_table(df, path, partition_by=partition_by, parameters=parameters)
    if fmt == "parquet":
        w = df.write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    elif fmt == "json":
        df.write.mode("overwrite").json(path)
    elif fmt == "csv":  # evidence: as many files as Spark plans
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r} for product {product!r}")
    return fmt


def register_product(spark: SparkSession, product: str, path: str, name: str) -> None:
    """Make the current state of a product readable by ``name`` in the catalog.

    A table's entry shows its current version (register again after a commit, or commit through a
    ``SnapshotTable`` that has the view); other products are the files at ``path``.
    """
    fmt = PRODUCT_FORMATS[product][0]
    if fmt == "table":
        fmt = table_format(spark, path) or "parquet"
        if fmt == "parquet":
            SnapshotTable(spark, path, view=name).refresh_view()
            return
    if fmt == "csv":
        # a view cannot carry reader options; the evidence has a header
        frame = spark.read.option("header", True).csv(path)
        source = ", ".join(f"`_c{i}` AS `{c}`" for i, c in enumerate(frame.columns))
        header = " OR ".join(f"`_c{i}` <> '{c}'" for i, c in enumerate(frame.columns)) or "true"
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {source} FROM csv.`{path}` WHERE {header}")
    else:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{path}`")


def unregister_product(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")
