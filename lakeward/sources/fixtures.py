"""Views over the driver's TPC-H-style tables that take the shape of the governed-lake inputs.

Each view is an expression over the given tables only (no made-up rows), so the work grows with
the scale factor. The same expressions are written in SQL in ``lakeward.plans.oracles``.

* trips   = lineitem ⋈ orders ⋈ customer ⋈ supplier, projected onto the trip schema
* zones   = nation ⋈ region, projected onto the zone lookup (LocationID, Borough, Zone, service_zone)
* parts / suppliers as entities (id, block, name) for matching at growing scale
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# FIXED VALUES of the fixture views (see FIXTURES.md §3): which driver column plays which trip
# column, and the sentinel values turned into NULLs so that NULL paths are exercised.
# ---------------------------------------------------------------------------------------------
VENDOR_NULL_LINENUMBER = 7
PICKUP_NULL_NATION = 13
DROPOFF_NULL_NATION = 7
MASTER_BOROUGHS = ["AMERICA", "ASIA", "EUROPE"]
STATE_CYCLE = ["PROPOSED", "ACTIVE", "DEPRECATED", "RETIRED", "REJECTED"]
STATE_EPOCH = "2020-01-01"
CDC_DELETE_MAX_SIZE = 2
CDC_UPDATE_MAX_SIZE = 6
CDC_INSERT_MIN_SIZE = 49
CHANGE_FIELD_MIN_LEN = 9
# column of the text export -> (rows whose value is spoilt, what stands there instead)
TEXT_SPOILT = {
    "VendorID": ("RatecodeID = 6", "vendor six"),
    "tpep_pickup_datetime": ("PULocationID = 3", "1996-13-45 00:00:00"),
    "passenger_count": ("passenger_count = 9", "nine"),
    "trip_distance": ("trip_distance = 13", "13 miles"),
    "fare_amount": ("DOLocationID = 11", "x"),
    "total_amount": ("RatecodeID = 2 and passenger_count = 1", "n/a"),
}
# ---------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nullif(col: Column, value) -> Column:
    return F.when(col == F.lit(value), F.lit(None)).otherwise(col)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-shaped fact view; one row per lineitem.

    The dimension joins are left to Catalyst/AQE: orders and customer grow with the data and are
    shuffle-joined on their keys; supplier is small and AQE turns its join into a broadcast at
    run time when the measured size is under the threshold.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    j = (li.join(od, li.l_orderkey == od.o_orderkey)
           .join(cu, F.col("o_custkey") == cu.c_custkey)
           .join(su, F.col("l_suppkey") == su.s_suppkey))
    return j.select(
        _nullif(F.col("l_linenumber"), VENDOR_NULL_LINENUMBER).cast("int").alias("VendorID"),
        F.col("o_orderdate").cast("timestamp").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").cast("timestamp").alias("tpep_dropoff_datetime"),
        (F.col("l_quantity").cast("int") % 10).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").cast("int").alias("RatecodeID"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        _nullif(F.col("c_nationkey"), PICKUP_NULL_NATION).cast("int").alias("PULocationID"),
        _nullif(F.col("s_nationkey"), DROPOFF_NULL_NATION).cast("int").alias("DOLocationID"),
        F.col("c_acctbal").alias("fare_amount"),
        F.col("s_acctbal").alias("extra"),
        (F.col("l_extendedprice") * F.col("l_discount") + F.lit(0.0)).alias("tip_amount"),
        (F.col("l_extendedprice") * F.col("l_tax") + F.lit(0.0)).alias("tolls_amount"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def trips_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip view as an export without types delivers it: every column text, some values spoilt."""
    t = trips(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in t.columns}
    for column, (when, value) in TEXT_SPOILT.items():
        text[column] = F.when(F.expr(when), F.lit(value)).otherwise(text[column])
    return t.select(*[c.alias(name) for name, c in text.items()])


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup view (25 rows at every scale: nation and region are fixed-size dimensions)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").cast("int").alias("LocationID"),
                     F.col("r_name").alias("Borough"),
                     F.col("n_name").alias("Zone"),
                     F.concat(F.lit("Zone "), F.col("r_regionkey").cast("string")).alias("service_zone")))


def master_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master subset: zones of three boroughs, so that trips elsewhere become orphans."""
    return zones(spark, sf_dir).filter(F.col("Borough").isin(MASTER_BOROUGHS))


def with_state(entities: DataFrame) -> DataFrame:
    """Entities with a lifecycle state and a state date derived from the id."""
    states = F.array(*[F.lit(s) for s in STATE_CYCLE])
    return entities.select(
        "*",
        F.element_at(states, (F.col("LocationID") % len(STATE_CYCLE)) + 1).alias("mdm_state"),
        F.date_add(F.lit(STATE_EPOCH).cast("date"), F.col("LocationID")).alias("state_date"),
    )


def change_requests(entities: DataFrame, clock: str) -> DataFrame:
    """Each entity asks to move to the next state of the cycle; some required fields are filled."""
    states = F.array(*[F.lit(s) for s in STATE_CYCLE])
    e = with_state(entities)
    ts = F.lit(clock).cast("timestamp")
    return e.select(
        F.col("LocationID").alias("location_id"),
        F.col("mdm_state").alias("from_state"),
        F.element_at(states, ((F.col("LocationID") + 1) % len(STATE_CYCLE)) + 1).alias("to_state"),
        ts.alias("created_at_utc"), ts.alias("updated_at_utc"),
        F.when(F.col("service_zone").isNotNull(), F.lit("raw_reference")).alias("source_system"),
        F.when(F.length("Zone") > CHANGE_FIELD_MIN_LEN, ts).alias("deprecated_at_utc"),
        F.lit("superseded").alias("deprecated_reason"),
        ts.alias("submitted_at_utc"),
    )


def changed_snapshot(entities: DataFrame, size_col: str = "p_size") -> DataFrame:
    """The 'new' snapshot of a CDC pair, from attribute rules: small sizes deleted, a size band
    re-typed, the largest sizes re-keyed as new entities (negative ids)."""
    kept = entities.filter(F.col(size_col) > CDC_DELETE_MAX_SIZE).withColumn(
        "service_zone",
        F.when(F.col(size_col) <= CDC_UPDATE_MAX_SIZE, F.concat(F.col("service_zone"), F.lit(" REVISED")))
         .otherwise(F.col("service_zone")))
    added = entities.filter(F.col(size_col) >= CDC_INSERT_MIN_SIZE).withColumn(
        "LocationID", -F.col("LocationID") - 1)
    return kept.unionByName(added)


def part_entities_sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part entities with the size attribute used to derive snapshot changes."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("LocationID"), F.col("p_brand").alias("Borough"),
        F.col("p_name").alias("Zone"), F.col("p_type").alias("service_zone"), "p_size")


def part_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as MDM entities: id, blocking attribute (brand), name; grows with the scale factor."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("LocationID"),
        F.col("p_brand").alias("Borough"),
        F.col("p_name").alias("Zone"),
        F.col("p_type").alias("service_zone"))


def supplier_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as MDM entities: id, blocking attribute (nation key), name."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("LocationID"),
        F.col("s_nationkey").cast("string").alias("Borough"),
        F.col("s_name").alias("Zone"),
        F.lit(None).cast("string").alias("service_zone"))
