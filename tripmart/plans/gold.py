"""Gold layer: five dimensions and the trip fact (star schema)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions.columns import date_key, day_of_week, year_month
from tripmart.operators.joins import Dim
from tripmart.params import Params
from tripmart.sources import generators


@dataclass(frozen=True)
class Gold:
    fact: DataFrame            # without trip_key unless built with keys
    dim_date: Dim
    dim_zones: Dim
    dim_service_type: Dim
    dim_payment_type: Dim
    dim_vendors: Dim
    params: Params

    def dims(self) -> dict[str, Dim]:
        return {"dim_date": self.dim_date, "dim_zones": self.dim_zones,
                "dim_service_type": self.dim_service_type,
                "dim_payment_type": self.dim_payment_type, "dim_vendors": self.dim_vendors}

    def bc(self, dim: Dim) -> DataFrame:
        return dim.side(self.params.max_broadcast_rows)


# --------------------------------------------------------------------- dims

def dim_date(spark: SparkSession, p: Params) -> Dim:
    d = generators.calendar(spark, p.calendar_start, p.calendar_end)
    df = d.select(
        date_key("date").alias("date_key"),
        F.col("date"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.dayofmonth("date").alias("day"),
        day_of_week("date").alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        year_month("date").alias("year_month"),
    )
    return Dim(df, generators.calendar_days(p.calendar_start, p.calendar_end))


def dim_zones(zones_bronze: Dim) -> Dim:
    df = zones_bronze.df.select(
        F.col("location_id").alias("zone_key"),
        F.coalesce("borough", F.lit(schemas.UNKNOWN_BOROUGH)).alias("borough"),
        F.coalesce("zone_name", F.lit(schemas.UNKNOWN_ZONE)).alias("zone_name"),
        F.coalesce("service_zone", F.lit(schemas.UNKNOWN_SERVICE_ZONE)).alias("service_zone"),
    )
    return Dim(df, zones_bronze.max_rows)


def dim_service_type(spark: SparkSession) -> Dim:
    return Dim(generators.service_types(spark), len(schemas.SERVICE_TYPES))


def dim_payment_type(spark: SparkSession) -> Dim:
    return Dim(generators.payment_types(spark), len(schemas.PAYMENT_TYPES))


def dim_vendors(spark: SparkSession) -> Dim:
    return Dim(generators.vendors(spark), len(schemas.VENDORS))


# --------------------------------------------------------------------- fact

def _cleaned(silver: DataFrame) -> DataFrame:
    z = F.lit(0)
    c = lambda n: F.coalesce(F.col(n), z)
    keep = (
        F.col("pickup_location_id").isNotNull() & F.col("dropoff_location_id").isNotNull()
        # positive minutes imply both timestamps, in order
        & (F.col("trip_time_minutes") > 0) & (F.col("trip_distance") > 0) & (F.col("total_amount") > 0)
        & (F.least(c("fare_amount"), c("tip_amount"), c("tolls_amount")) >= 0) & (c("passenger_count") >= 0)
        & (year_month("pickup_ts") == F.col("source_month"))
    )
    return silver.where(keep).select(
        F.coalesce(F.col("VendorID").cast("int"), F.lit(schemas.DEFAULT_VENDOR_ID)).alias("vendor_id"),
        F.coalesce("payment_type_id", F.lit(schemas.DEFAULT_PAYMENT_TYPE_ID)).alias("payment_type_id"),
        "pickup_ts", "dropoff_ts", "pickup_location_id", "dropoff_location_id",
        "service_type", "source_month", "ingest_ts",
        c("passenger_count").alias("passenger_count"),
        c("trip_distance").alias("trip_distance"),
        c("fare_amount").alias("fare_amount"),
        c("tip_amount").alias("tip_amount"),
        c("tolls_amount").alias("tolls_amount"),
        c("total_amount").alias("total_amount"),
        c("trip_time_minutes").alias("trip_time_minutes"),
    )


def fact_trips(silver: DataFrame, zones: Dim, vendors: Dim, payments: Dim,
               broadcast_limit: int) -> DataFrame:
    """The fact without its surrogate key (see ``with_trip_key``).

    Rows keep ``pickup_ts``/``dropoff_ts`` as hidden columns so the trip key
    can be ranked later; ``FACT_COLUMNS`` selects the published layout.
    """
    t = _cleaned(silver)
    v = vendors.side(broadcast_limit).select(F.col("vendor_id").alias("_v_id"), "vendor_key")
    pt = payments.side(broadcast_limit).select(F.col("payment_type_key").alias("_pt_key"))
    zk = zones.side(broadcast_limit).select("zone_key")
    zpu = zk.select(F.col("zone_key").alias("pu_zone_key"))
    zdo = zk.select(F.col("zone_key").alias("do_zone_key"))

    j = (t.join(v, t.vendor_id == v._v_id, "left")
          .join(pt, t.payment_type_id == pt._pt_key, "left")
          # Left joins followed by NOT NULL on the keys are inner joins.
          .join(zpu, t.pickup_location_id == zpu.pu_zone_key)
          .join(zdo, t.dropoff_location_id == zdo.do_zone_key))

    svc = F.col("service_type")
    svc_key = F.when(svc == "yellow", F.lit(schemas.SERVICE_TYPE_KEYS["yellow"])) \
        .when(svc == "green", F.lit(schemas.SERVICE_TYPE_KEYS["green"])) \
        .otherwise(F.lit(schemas.SERVICE_TYPE_KEY_ELSE))
    tip_pct = F.when(F.col("fare_amount") > 0, F.col("tip_amount") / F.col("fare_amount")).otherwise(F.lit(0))
    # speed = distance / (minutes / 60), written as one division of exact decimals.
    speed = F.when(F.col("trip_time_minutes") > 0,
                   F.col("trip_distance") * F.lit(60) / F.col("trip_time_minutes")).otherwise(F.lit(0))

    return j.select(
        F.to_date("pickup_ts").alias("pickup_date"),
        date_key("pickup_ts").alias("pickup_date_key"),
        date_key("dropoff_ts").alias("dropoff_date_key"),
        svc_key.alias("service_type_key"),
        F.coalesce("vendor_key", F.lit(schemas.DEFAULT_VENDOR_KEY)).alias("vendor_key"),
        F.col("pu_zone_key"), F.col("do_zone_key"),
        F.coalesce("_pt_key", F.lit(schemas.DEFAULT_PAYMENT_TYPE_KEY)).alias("payment_type_key"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("decimal(10,2)").alias("trip_distance"),
        F.col("fare_amount").cast("decimal(10,2)").alias("fare_amount"),
        F.col("tip_amount").cast("decimal(10,2)").alias("tip_amount"),
        F.col("tolls_amount").cast("decimal(10,2)").alias("tolls_amount"),
        F.col("total_amount").cast("decimal(10,2)").alias("total_amount"),
        F.col("trip_time_minutes").cast("decimal(10,2)").alias("trip_time_minutes"),
        F.round(tip_pct, 4).cast("decimal(18,4)").alias("tip_percentage"),
        F.round(speed, 2).cast("decimal(18,2)").alias("speed_mph"),
        "pickup_location_id", "dropoff_location_id", "payment_type_id", "vendor_id",
        "source_month", "service_type", "ingest_ts",
        "pickup_ts", "dropoff_ts",
    )


#: Measures of the percentile reports and the condition of the trips that count for them.
VALUE_MEASURES = {"speed_mph": "trip_time_minutes > 0 AND trip_distance > 0", "trip_time_minutes": "trip_time_minutes > 0"}


def value_state(fact: DataFrame) -> DataFrame:
    """How often each value of the reports' measures occurs, by month and pickup zone: (source_month, pu_zone_key,
    measure, _v, _n). A month's counts come from its trips alone, so they are rebuilt with it; the counts of several
    months add up to exact percentiles of all of them."""
    pairs = [F.when(F.expr(counts), F.struct(F.lit(name).alias("measure"), F.col(name).cast("decimal(18,2)").alias("_v")))
             for name, counts in VALUE_MEASURES.items()]
    found = fact.select("source_month", "pu_zone_key", F.explode(F.array(*pairs)).alias("x"))
    rows = found.where("x IS NOT NULL").select("source_month", "pu_zone_key", "x.measure", "x._v").where("_v IS NOT NULL")
    return rows.groupBy("source_month", "pu_zone_key", "measure", "_v").agg(F.count(F.lit(1)).alias("_n"))


def build_gold(spark: SparkSession, bronze: DataFrame, zones_bronze: Dim, p: Params,
               silver: DataFrame | None = None) -> Gold:
    """Lazily plan all gold tables from bronze trips and zones."""
    from tripmart.plans.silver import silver_trips

    lim = p.max_broadcast_rows
    zones = dim_zones(zones_bronze)
    vendors, payments = dim_vendors(spark), dim_payment_type(spark)
    silver = silver if silver is not None else silver_trips(bronze, zones_bronze, lim)
    fact = fact_trips(silver, zones, vendors, payments, lim)
    return Gold(fact=fact, dim_date=dim_date(spark, p), dim_zones=zones,
                dim_service_type=dim_service_type(spark), dim_payment_type=payments,
                dim_vendors=vendors, params=p)


def fact_from_bronze(bronze: DataFrame, gold: Gold) -> DataFrame:
    """The unkeyed fact with its timestamps, for dimensions that are built already."""
    lim = gold.params.max_broadcast_rows
    zones = Dim(gold.dim_zones.df.select(F.col("zone_key").alias("location_id"), "zone_name"), gold.dim_zones.max_rows)
    from tripmart.plans.silver import silver_trips

    return fact_trips(silver_trips(bronze, zones, lim), gold.dim_zones, gold.dim_vendors, gold.dim_payment_type, lim)


def with_trip_key(fact: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Add the dense-rank surrogate key and select the published layout."""
    from tripmart.operators.dense_rank import with_dense_rank

    keyed = with_dense_rank(fact, schemas.TRIP_KEY_ORDER, "trip_key", num_partitions)
    return keyed.select(*schemas.FACT_COLUMNS)


def with_hash_trip_key(fact: DataFrame) -> DataFrame:
    """Alternative surrogate key: 128 bits of SHA-256 over the ten key columns, as hex text.

    Row-local (no shuffle, no global pass) and stable across loads, so the
    fact can be rebuilt month by month. Unlike the dense rank it is not dense;
    two of n trips collide with probability about n^2 / 2^129.
    """
    parts = F.to_json(F.struct(*schemas.TRIP_KEY_ORDER), {"ignoreNullFields": "false"})
    keyed = fact.withColumn("trip_key", F.substring(F.sha2(parts, 256), 1, 32))
    return keyed.select(*schemas.FACT_COLUMNS)
