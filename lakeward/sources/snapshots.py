"""Versioned tables on plain parquet: overwrite/append commits, history, time travel, evolving schemas.

Each commit writes a new data folder ``<root>/v=<n>`` and then appends one row to the ledger
``<root>/_ledger`` (version, commit time, operation, parameters, metrics, user metadata, the data
folders of this commit, the version it builds on, partition columns, schemas). A version consists
of the folders of all commits from its ``base_version`` (the last overwrite) on, so a ledger row
names its own folders only. Readers only see folders named by a ledger row, so a job that dies
mid-write leaves an unreferenced folder and never a half-visible version; a re-run simply commits
the next version. One writer per table is assumed.

A commit stores its own schema and the table's: an append may add columns and widen types
(``WIDER``). Readers get the table's schema; folders with a narrower type are read as they were
written and converted, all others are one relation. An append whose types cannot be brought
together with the table's is refused before anything is written.

Row metrics come from an ``Observation`` attached to the write (no second pass over the data).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("committed_at_utc", T.TimestampType()),
    T.StructField("operation", T.StringType()),
    T.StructField("operation_parameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("operation_metrics", T.MapType(T.StringType(), T.StringType())),
    T.StructField("user_metadata", T.StringType()),
    T.StructField("files", T.ArrayType(T.StringType())),
    T.StructField("partition_by", T.ArrayType(T.StringType())),
    T.StructField("schema_json", T.StringType()),
    T.StructField("own_schema_json", T.StringType()),
    T.StructField("base_version", T.LongType()),
])
#: Ledger columns that only the reader of a table needs.
PLUMBING = ("files", "schema_json", "own_schema_json", "base_version")
#: Types that hold every value of both: a column's type after an append.
WIDER = {frozenset(pair): wide for *pair, wide in (
    ("tinyint", "smallint", "smallint"), ("tinyint", "int", "int"), ("tinyint", "bigint", "bigint"),
    ("smallint", "int", "int"), ("smallint", "bigint", "bigint"), ("int", "bigint", "bigint"),
    ("tinyint", "double", "double"), ("smallint", "double", "double"), ("int", "double", "double"),
    ("float", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"))}


def delta_available(spark: SparkSession) -> bool:
    """True when the transactional table format is on the class path (it is used when present)."""
    try:
        spark._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
        return True
    except Exception:
        return False


def merged_schema(table: T.StructType, added: T.StructType) -> T.StructType:
    """The table's columns with types wide enough for both, then the new ones an append brings."""
    columns = {f.name: f for f in table.fields}
    for f in added.fields:
        old = columns.get(f.name)
        if old is None or old.dataType == f.dataType:
            columns[f.name] = old or f
            continue
        wide = WIDER.get(frozenset((old.dataType.simpleString(), f.dataType.simpleString())))
        if wide is None:
            raise ValueError(f"column {f.name}: {f.dataType.simpleString()} cannot be appended to "
                             f"{old.dataType.simpleString()}")
        columns[f.name] = T.StructField(f.name, T.StructType.fromDDL(f"c {wide}")[0].dataType)
    return T.StructType([T.StructField(f.name, f.dataType) for f in columns.values()])


def _parsed(schema_json: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(schema_json))


class SnapshotTable:
    """``view``: name of a catalog view that every commit makes show the current version."""

    def __init__(self, spark: SparkSession, root: str, view: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ledger_path = f"{self.root}/_ledger"
        self.view = view

    # ------------------------------------------------------------------ ledger
    def _ledger_exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.ledger_path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def history(self) -> DataFrame:
        """All versions, newest first (empty frame for a new table)."""
        if self._ledger_exists():
            led = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger_path)
        else:
            led = self.spark.createDataFrame([], LEDGER_SCHEMA)
        return led.orderBy(F.desc("version"))

    def _newest(self, such_that=None) -> dict | None:
        """The newest ledger row (of those a condition selects): one row, not the ledger."""
        rows = self.history() if such_that is None else self.history().filter(such_that)
        row = rows.first()
        return row.asDict() if row else None

    def latest_version(self) -> int | None:
        newest = self._newest()
        return newest["version"] if newest else None

    def committed_with(self, operation: str, parameters: dict) -> int | None:
        """Newest version committed by ``operation`` with these parameters, if any (for re-runs)."""
        same = F.col("operation") == operation
        for key, value in parameters.items():
            same &= F.col("operation_parameters")[key] == str(value)
        row = self._newest(same)
        return row["version"] if row else None

    def _append_row(self, newest: dict | None, folders: list[str], schema: T.StructType, mode: str, operation: str,
                    parameters: dict, metrics: dict, user_metadata: str | None, partition_by: list[str] | None,
                    now: dt.datetime | None) -> int:
        version = newest["version"] + 1 if newest else 0
        extends = newest is not None and mode == "append"
        table = merged_schema(_parsed(newest["schema_json"]), schema) if extends else schema
        row = (version, now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), operation, parameters,
               {k: str(v) for k, v in metrics.items()}, user_metadata, folders, list(partition_by or []), table.json(),
               schema.json(), newest["base_version"] if extends else version)
        self.spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.ledger_path)
        if self.view:
            self.refresh_view()
        return version

    # ------------------------------------------------------------------ write
    def commit(self, df: DataFrame, mode: str = "overwrite", partition_by: list[str] | None = None,
               operation: str | None = None, parameters: dict | None = None, user_metadata: str | None = None,
               now: dt.datetime | None = None) -> int:
        newest = self._newest()
        version = newest["version"] + 1 if newest else 0
        if newest and mode == "append":
            merged_schema(_parsed(newest["schema_json"]), df.schema)  # refused before it is written
        # a folder of its own per attempt: what a dead writer left is never in the way of the next one
        folder = f"{self.root}/v={version}-{uuid.uuid4().hex}"
        obs = Observation(f"commit_{version}")
        if partition_by:
            # cluster rows by the partition value before the write: each task then writes few
            # files instead of one per (task, day); AQE splits a hot day and merges small ones
            df = df.hint("rebalance", *partition_by)
        observed = df.observe(obs, F.count(F.lit(1)).alias("numOutputRows"))
        w = observed.write.mode("error")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(folder)
        params = {"mode": mode.capitalize(), "partitionBy": json.dumps(partition_by or [])}
        params.update({k: str(v) for k, v in (parameters or {}).items()})
        return self._append_row(newest, [folder], df.schema, mode,
                                operation or ("WRITE" if mode == "overwrite" else "APPEND"), params, obs.get,
                                user_metadata, partition_by, now)

    def register(self, folders: list[str], schema: T.StructType, metrics: dict, mode: str = "overwrite", operation: str = "WRITE",
                 parameters: dict | None = None, partition_by: list[str] | None = None,
                 now: dt.datetime | None = None) -> int:
        """Commit data folders written by someone else (e.g. one side of a partitioned write); no
        folder at all is a version without rows."""
        params = {"mode": mode.capitalize()}
        params.update({k: str(v) for k, v in (parameters or {}).items()})
        return self._append_row(self._newest(), list(folders), schema, mode, operation, params, metrics, None,
                                partition_by, now)

    # ------------------------------------------------------------------ read
    def _entry(self, version: int | None = None, timestamp: str | dt.datetime | None = None) -> dict:
        if not self._ledger_exists():
            raise FileNotFoundError(f"no committed version under {self.root}")
        wanted = None
        if version is not None:
            wanted = F.col("version") == version
        elif timestamp is not None:
            ts = dt.datetime.fromisoformat(str(timestamp)) if not isinstance(timestamp, dt.datetime) else timestamp
            wanted = F.col("committed_at_utc") <= F.lit(ts)
        found = self._newest(wanted)
        if found is None:
            raise ValueError(f"no version {version if version is not None else f'at or before {timestamp}'}")
        return found

    def _commits(self, entry: dict) -> list[dict]:
        """The ledger rows whose folders make up a version: a row per commit since the last overwrite."""
        since = F.col("version").between(entry["base_version"], entry["version"])
        return [r.asDict() for r in self.history().filter(since).orderBy("version").collect() if r["files"]]

    def read(self, version: int | None = None, timestamp=None, schema: T.StructType | None = None) -> DataFrame:
        """Current version, or the one given by number or by time (latest commit at or before it)."""
        e = self._entry(version, timestamp)
        # as committed: no inference, and a text partition value such as '007' stays text
        schema = schema or _parsed(e["schema_json"])
        # folders that differ only in columns they lack are one relation: one listing, one scan,
        # however many appends the table has had; folders with partitions are one each
        groups: dict[tuple, list[str]] = {}
        for commit in self._commits(e):
            for folder in commit["files"]:
                apart = folder if commit["partition_by"] else ""
                groups.setdefault((apart, *self._narrower(commit, schema)), []).append(folder)
        frames = []
        for (_, *narrow), files in groups.items():
            types = dict(narrow)
            stored = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in schema.fields])
            frames.append(self.spark.read.schema(stored).parquet(*files).select(
                *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in types else F.col(f"`{f.name}`")
                  for f in schema.fields]))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)

    @staticmethod
    def _narrower(commit: dict, schema: T.StructType) -> list[tuple[str, T.DataType]]:
        """Columns that the commit's files hold in another type than ``schema``."""
        wanted = {f.name: f.dataType for f in schema.fields}
        own = _parsed(commit["own_schema_json"]).fields
        return [(f.name, f.dataType) for f in own if f.name in wanted and f.dataType != wanted[f.name]]

    def schema_versions(self) -> DataFrame:
        """How the schema came about: a row per version and column that it added or widened
        (version, column_name, change, old_type, new_type)."""
        rows, before = [], {}
        for entry in self.history().orderBy("version").select("version", "schema_json").collect():
            after = {f.name: f.dataType.simpleString() for f in _parsed(entry["schema_json"]).fields}
            rows += [(entry["version"], n, "added" if n not in before else "changed", before.get(n), t)
                     for n, t in after.items() if before.get(n) != t]
            rows += [(entry["version"], n, "removed", t, None) for n, t in before.items() if n not in after]
            before = after
        return self.spark.createDataFrame(rows, "version bigint, column_name string, change string, old_type string, "
                                                "new_type string")

    # ------------------------------------------------------------------ catalog
    def refresh_view(self) -> None:
        """(Re)build the catalog view from the ledger: every folder of the current version, with the
        table's schema. Readers by name see the next version as soon as it is committed."""
        entry = self._entry()
        schema, commits = _parsed(entry["schema_json"]), self._commits(entry)
        text = {f.name for f in schema.fields if f.dataType == T.StringType()}
        self.drop_view()
        if any(text & set(c["partition_by"]) for c in commits):
            # SQL over a folder takes '007' in a folder's name for a number: such a table's entry is
            # a view of the session
            self.read().createOrReplaceTempView(self.view)
            return
        selects = []
        for commit in commits:
            own = set(_parsed(commit["own_schema_json"]).names)
            columns = ", ".join(f"CAST({f'`{f.name}`' if f.name in own else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
                                for f in schema.fields)
            selects += [f"SELECT {columns} FROM parquet.`{folder}`" for folder in commit["files"]]
        if not selects:
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
            selects = [f"SELECT {nothing} WHERE false"]
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} AS {' UNION ALL '.join(selects)}")

    def drop_view(self) -> None:
        """Take the table's entry out of the catalog (its owner does, when the table goes)."""
        self.spark.catalog.dropTempView(self.view)
        self.spark.sql(f"DROP VIEW IF EXISTS {self.view}")
