"""Bronze layer: typed trips with the overflow guard; typed zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions.columns import dec, minutes_between, to_int

AMOUNTS = ["fare_amount", "tip_amount", "tolls_amount", "total_amount"]


def bronze_trips(landing: DataFrame) -> DataFrame:
    """Cast every raw column, derive trip minutes, drop amounts that would
    overflow (NULL amounts drop too: ``NULL <= x`` is not true)."""
    types = {f.name: f.dataType for f in landing.schema.fields}
    guard = None
    for a in AMOUNTS:
        # try_cast: a value too large for the decimal fails the guard anyway.
        cond = F.expr(f"try_cast(`{a}` AS decimal(38,10))") <= dec(schemas.AMOUNT_GUARD)
        guard = cond if guard is None else guard & cond
    return landing.where(guard).select(
        to_int("VendorID", types.get("VendorID")).alias("VendorID"),
        F.col("lpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_ts"),
        F.col("lpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_ts"),
        to_int("passenger_count", types.get("passenger_count")).alias("passenger_count"),
        F.col("trip_distance").cast("decimal(10,2)").alias("trip_distance"),
        to_int("PULocationID", types.get("PULocationID")).alias("pickup_location_id"),
        to_int("DOLocationID", types.get("DOLocationID")).alias("dropoff_location_id"),
        to_int("RatecodeID", types.get("RatecodeID")).alias("rate_code_id"),
        to_int("payment_type", types.get("payment_type")).alias("payment_type_id"),
        F.col("fare_amount").cast("decimal(15,2)").alias("fare_amount"),
        F.col("tip_amount").cast("decimal(15,2)").alias("tip_amount"),
        F.col("tolls_amount").cast("decimal(15,2)").alias("tolls_amount"),
        F.col("total_amount").cast("decimal(15,2)").alias("total_amount"),
        to_int("trip_type", types.get("trip_type")).alias("trip_type"),
        F.col("ingest_ts").cast("timestamp_ntz").alias("ingest_ts"),
        F.col("source_month"),
        F.col("service_type"),
        minutes_between("lpep_pickup_datetime", "lpep_dropoff_datetime").alias("trip_time_minutes"),
    )


def bronze_zones(zone_lookup: DataFrame) -> DataFrame:
    return zone_lookup.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone").alias("service_zone"),
    )


def null_audit(bronze: DataFrame) -> DataFrame:
    """Row total and NULL dropoff locations (the silver source audit)."""
    return bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("dropoff_location_id").isNull()).alias("null_dropoff_count"),
    )
