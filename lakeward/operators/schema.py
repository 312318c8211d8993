"""Schema validation against the declared trip schema, and schema evolution on read."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import governance as gov
from ..functions.rows import explode_rows

_SIMPLE = {"int": "int", "integer": "int", "bigint": "bigint", "long": "bigint", "double": "double",
           "string": "string", "timestamp": "timestamp", "timestamp_ntz": "timestamp_ntz",
           "date": "date", "boolean": "boolean"}


def _type_name(dt: T.DataType) -> str:
    return _SIMPLE.get(dt.simpleString(), dt.simpleString())


def schema_diff(spark: SparkSession, df: DataFrame, declared=gov.TRIP_SCHEMA) -> DataFrame:
    """Per column: declared type, actual type, status (ok / missing / extra / type_mismatch).

    Both sides are schema metadata (a few dozen rows), compared with a full outer join.
    """
    decl = spark.createDataFrame([(n, _SIMPLE.get(t, t)) for n, t in declared],
                                 "column_name string, declared_type string")
    actual = spark.createDataFrame([(f.name, _type_name(f.dataType)) for f in df.schema.fields],
                                   "column_name string, actual_type string")
    j = decl.join(actual, "column_name", "full_outer")
    status = (F.when(F.col("actual_type").isNull(), "missing")
               .when(F.col("declared_type").isNull(), "extra")
               .when(F.col("actual_type") != F.col("declared_type"), "type_mismatch")
               .otherwise("ok"))
    return j.select("column_name", "declared_type", "actual_type", status.alias("status"))


def raise_on_schema_drift(diff: DataFrame, allow=("ok", "extra", "missing")) -> None:
    bad = diff.filter(~F.col("status").isin(list(allow))).collect()  # bounded by the column count
    if bad:
        raise ValueError(f"schema drift: {[r.asDict() for r in bad]}")


def conformance(df: DataFrame, declared=gov.TRIP_SCHEMA) -> DataFrame:
    """Value-level schema check over the whole table in one aggregate pass: per declared column
    present in ``df``, how many non-NULL values do not convert to the declared type."""
    present = [(n, t) for n, t in declared if n in df.columns]
    if not present:
        raise ValueError("no declared column present")
    measures = [F.count(F.lit(1)).alias("_total")]
    for i, (n, t) in enumerate(present):
        c = F.col(n)
        measures.append(F.count_if(c.isNotNull() & c.try_cast(t).isNull()).alias(f"_bad{i}"))
        measures.append(F.count_if(c.isNull()).alias(f"_null{i}"))
    wide = df.agg(*measures)
    rows = [[F.lit(n).alias("column_name"), F.lit(_SIMPLE.get(t, t)).alias("declared_type"),
             F.lit(_type_name(df.schema[n].dataType)).alias("actual_type"),
             F.col(f"_bad{i}").alias("nonconforming_rows"), F.col(f"_null{i}").alias("null_rows"),
             F.col("_total").alias("total_rows")]
            for i, (n, t) in enumerate(present)]
    return explode_rows(wide, rows)


def typed_ingest(raw: DataFrame, declared=gov.TRIP_SCHEMA) -> DataFrame:
    """Permissive ingestion of untyped columns: declared columns converted under their own names,
    other columns as they are, and beside them the evidence of what did not convert.

    ``raw_values`` maps a column to its original text where that text does not convert to the
    declared type (the typed column is NULL there), so nothing that came in is lost;
    ``nonconforming`` is the number of such columns in the row. Declared columns that ``raw``
    lacks are left out; a missing (NULL) value is not a bad one.
    """
    kinds = {n: t for n, t in declared if n in raw.columns}
    clash = {"raw_values", "nonconforming"} & set(raw.columns)
    if clash:
        raise ValueError(f"evidence columns collide with input columns: {sorted(clash)}")
    source = {c: F.col(f"`{c}`") for c in raw.columns}
    typed = {c: source[c].try_cast(t) for c, t in kinds.items()}
    spoilt = {c: source[c].isNotNull() & typed[c].isNull() for c in kinds}
    none = F.array().cast("array<struct<key:string,value:string>>")
    # most rows convert: their evidence is the empty map, without a look at each column
    bad = F.concat(none, *[
        F.when(spoilt[c], F.array(F.struct(F.lit(c).alias("key"), source[c].cast("string").alias("value")))).otherwise(none)
        for c in kinds])
    evidence = F.when(reduce(operator.or_, spoilt.values(), F.lit(False)), F.map_from_entries(bad)).otherwise(
        F.map_from_entries(none))
    return raw.select(*[typed.get(c, source[c]).alias(c) for c in raw.columns], evidence.alias("raw_values")) \
        .withColumn("nonconforming", F.size("raw_values"))


def conformance_of_ingest(ingested: DataFrame, declared=gov.TRIP_SCHEMA) -> DataFrame:
    """Per declared column of ``typed_ingest``'s result: values that did not convert, missing values
    and one of the bad texts (the smallest). One aggregate over the typed rows."""
    present = [(n, t) for n, t in declared if n in ingested.columns]
    measures = [F.count(F.lit(1)).alias("_total")]
    for i, (n, _) in enumerate(present):
        bad = F.col("raw_values")[n]
        measures += [F.count(bad).alias(f"_bad{i}"), F.min(bad).alias(f"_text{i}"),
                     F.count_if(F.col(f"`{n}`").isNull() & bad.isNull()).alias(f"_null{i}")]
    rows = [[F.lit(n).alias("column_name"), F.lit(_SIMPLE.get(t, t)).alias("declared_type"),
             F.col(f"_bad{i}").alias("nonconforming_rows"), F.col(f"_null{i}").alias("null_rows"),
             F.col(f"_text{i}").alias("example"), F.col("_total").alias("total_rows")]
            for i, (n, t) in enumerate(present)]
    return explode_rows(ingested.agg(*measures), rows)


def read_evolving(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Read parquet folders written with different (compatible) schemas; columns missing in a
    file come back as NULL (parquet schema merging)."""
    return spark.read.option("mergeSchema", True).parquet(*paths)
