"""Registered ingest / enrichment / schema queries (S-01..S-03, S-09, P-01..P-07, F-01..F-03,
J-01, J-02, N-01)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest as ing
from ..operators import schema as sch
from ..session import scratch_path
from ..sources import files
from ..sources import fixtures as fx
from .catalog import RUN_CLOCK, query


def _validated(spark, sf_dir):
    return ing.validate_trips(fx.trips(spark, sf_dir), now=RUN_CLOCK)


def _string_lookup(df):
    """A lookup as a header-only CSV read returns it: every column text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query("validated_trips")
def validated_trips(spark, sf_dir):
    """Raw trips -> validated: canonical timestamps, day, gates, governance stamp."""
    return _validated(spark, sf_dir)


@query("trip_duration")
def trip_duration(spark, sf_dir):
    """Validated trips with the duration in minutes (whole epoch seconds / 60)."""
    return ing.with_duration(_validated(spark, sf_dir))


@query("enriched_trips")
def enriched_trips(spark, sf_dir):
    """Validated -> curated: pickup and dropoff zone lookups (master subset, so some miss)."""
    lookup = _string_lookup(fx.master_zones(spark, sf_dir))
    return ing.enrich_trips(_validated(spark, sf_dir), lookup, now=RUN_CLOCK)


def _mixed_lookup(spark, sf_dir):
    """A folder of lookup CSVs from two exports: another column order, one column renamed, one more."""
    path = scratch_path(spark, "lookup_csv")
    parts = fx.part_entities(spark, sf_dir)
    files.write_zones_csv(parts.filter("LocationID % 2 = 0"), path)
    other = parts.filter("LocationID % 2 <> 0").select(
        F.col("Zone").alias("zone_name"), "service_zone", F.lit("b").alias("export"), "LocationID", "Borough")
    other.write.mode("append").option("header", True).csv(path)
    return path


@query("zone_lookup_csv")
def zone_lookup_csv(spark, sf_dir):
    """Entity lookup written as header CSVs of two column orders and read back by name (all text)."""
    return files.read_zones_csv(spark, _mixed_lookup(spark, sf_dir))


@query("zone_lookup_inferred")
def zone_lookup_inferred(spark, sf_dir):
    """The same folder with types inferred from the values; the columns of all headers."""
    found = files.read_zones_inferred(spark, _mixed_lookup(spark, sf_dir))
    return found.select("LocationID", "Borough", F.coalesce("Zone", "zone_name").alias("Zone"), "service_zone", "export")


@query("zone_lookup_typed")
def zone_lookup_typed(spark, sf_dir):
    """Same CSV read with a typed schema (integer id; what inference yields, without its pass)."""
    path = scratch_path(spark, "lookup_csv")
    files.write_zones_csv(fx.part_entities(spark, sf_dir), path)
    return files.read_zones_csv(spark, path, typed=True)


@query("schema_conformance")
def schema_conformance(spark, sf_dir):
    """Per declared trip column: non-conforming and NULL values over the whole table."""
    return sch.conformance(fx.trips(spark, sf_dir))


@query("text_ingest")
def text_ingest(spark, sf_dir):
    """The untyped export ingested: typed columns, and the raw text of what did not convert."""
    found = sch.typed_ingest(fx.trips_as_text(spark, sf_dir))
    # a map has no order: its texts in the order of their columns
    evidence = F.array_join(F.transform(F.array_sort(F.map_entries("raw_values")),
                                        lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.withColumn("raw_values", evidence)


@query("text_conformance")
def text_conformance(spark, sf_dir):
    """Per declared column of the untyped export: texts that do not convert, missing values, an example."""
    return sch.conformance_of_ingest(sch.typed_ingest(fx.trips_as_text(spark, sf_dir)))
