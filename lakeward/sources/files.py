"""File sources: trip parquet folders, zone lookups in CSV, optional reads, column resolution."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

ZONE_CSV_COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]
# Explicit all-string schema for the header-only CSV read: no inference job, and the same
# columns a header-only read would produce.
ZONE_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ZONE_CSV_COLUMNS])
ZONE_TYPED_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])
#: Headers read at the same time.
HEADERS_AT_ONCE = 16
#: Types that inference tries, narrowest first.
INFERRED_TYPES = ("int", "bigint", "double", "timestamp", "boolean")


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Parquet folder (or file) of raw trips; schema from the files."""
    return spark.read.parquet(path)


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a CSV folder by their header: column names -> files.

    Spark lists the files and its CSV reader takes each header from the file's first line, several
    files at a time. What comes to the driver is a name list per file, as the listing itself does.
    """
    names = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = pool.map(lambda name: tuple(spark.read.option("header", True).csv(name).columns), names)
    found: dict[tuple[str, ...], list[str]] = {}
    for name, header in zip(names, headers, strict=True):
        if header:  # a file without any line has no columns and no rows
            found.setdefault(header, []).append(name)
    return found


def read_zones_csv(spark: SparkSession, path: str, typed: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """Zone lookup CSV (a file or a folder of files) with headers.

    ``typed=False`` gives every column as text (header-only read); ``typed=True`` reads the id as
    an integer, which is what type inference yields on a clean file but without the extra
    inference pass over the data. Unparsable ids become NULL (PERMISSIVE mode).

    A header names the columns of its own file, whatever their order or number: files are read
    together per distinct header and united by name (any case; ``zone_name`` stands for ``Zone``).
    Columns that a file lacks are NULL, others are left out; no file at all gives no rows.
    """
    wanted = schema if schema is not None else ZONE_TYPED_SCHEMA if typed else ZONE_CSV_SCHEMA
    frames = []
    for header, names in csv_headers(spark, path).items():
        as_text = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))])
        found = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(as_text).csv(names)
        # of columns that differ in case only, the first counts
        have = {c.lower(): i for i, c in reversed(list(enumerate(header)))}
        columns = []
        for field in wanted.fields:
            place = have.get(field.name.lower(), have.get("zone_name") if field.name == "Zone" else None)
            value = F.lit(None).cast(field.dataType) if place is None else F.col(f"_c{place}").try_cast(field.dataType)
            columns.append(value.alias(field.name))
        frames.append(found.select(*columns))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], wanted)


def read_zones_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup whose column types are inferred from all its values, for lookups whose columns
    are not known in advance: header order and types may differ between files."""
    names = {}
    for header in csv_headers(spark, path):
        for name in header:
            names.setdefault(name.lower(), name)
    text = read_zones_csv(spark, path, schema=T.StructType([T.StructField(n, T.StringType()) for n in names.values()]))
    if not names:
        return text

    def misfits(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        # a single letter or digit converts to a boolean too, but does not say that it is one
        fits = F.lower(value).isin("true", "false") if kind == "boolean" else value.try_cast(kind).isNotNull()
        return F.count_if(value.isNotNull() & ~fits).alias(kind)

    # one pass: a column has the first type that all its values convert to
    fits = text.agg(*[F.struct(*[misfits(n, kind) for kind in INFERRED_TYPES]).alias(f"c{i}")
                      for i, n in enumerate(text.columns)]).first()
    kinds = [next((kind for kind in INFERRED_TYPES if not fits[f"c{i}"][kind]), "string") for i in range(len(text.columns))]
    return text.select(*[F.col(f"`{n}`").try_cast(kind).alias(n) for n, kind in zip(text.columns, kinds, strict=True)])


def write_zones_csv(df: DataFrame, path: str) -> str:
    """Write a zone lookup as header CSV (one folder; part files as Spark plans them)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_optional(spark: SparkSession, path: str, reader=None) -> DataFrame | None:
    """Read a source that may be missing: a missing/unreadable path is logged and gives None.

    Only analysis errors (path not found, no schema) are swallowed; anything else propagates.
    """
    reader = reader or (lambda p: spark.read.option("header", True).csv(p))
    try:
        df = reader(path)
        df.schema  # resolves the relation (path listing) without running a job
        return df
    except AnalysisException as exc:
        log.warning("optional source %s unavailable: %s", path, str(exc).splitlines()[0])
        return None


def preferred_column(df: DataFrame, accepted: Iterable[str]) -> str | None:
    """Of the accepted names that ``df`` has (exact, case-sensitive) the most preferred: the earliest."""
    rank = {name: place for place, name in enumerate(accepted)}
    return min(rank.keys() & set(df.columns), key=rank.__getitem__, default=None)


def require_columns(df: DataFrame, *names: str, what: str = "input") -> None:
    """Raise ``ValueError`` naming the missing columns of ``df``."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required column(s) {missing}; found {df.columns}")


def resolve_any(df: DataFrame, *candidates: str, what: str = "input") -> str:
    """First present of several accepted names for one column, or raise."""
    name = preferred_column(df, candidates)
    if name is None:
        raise ValueError(f"{what} has none of {list(candidates)}; found {df.columns}")
    return name
