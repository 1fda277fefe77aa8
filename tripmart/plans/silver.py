"""Silver layer: trips with pickup and dropoff zone names (role-playing join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.joins import Dim

SILVER_COLUMNS = [
    "VendorID", "pickup_ts", "dropoff_ts", "passenger_count", "trip_distance",
    "pickup_location_id", "dropoff_location_id", "rate_code_id", "payment_type_id",
    "fare_amount", "tip_amount", "tolls_amount", "total_amount", "trip_type",
    "ingest_ts", "source_month", "service_type", "trip_time_minutes",
]


def silver_trips(bronze: DataFrame, zones: Dim, broadcast_limit: int) -> DataFrame:
    """Inner-join the zone lookup twice; NULL passengers become 0."""
    z = zones.side(broadcast_limit)
    pu = z.select(F.col("location_id").alias("_pu_id"), F.col("zone_name").alias("pickup_location_name"))
    do = z.select(F.col("location_id").alias("_do_id"), F.col("zone_name").alias("dropoff_location_name"))
    t = bronze.where(F.col("pickup_location_id").isNotNull() & F.col("dropoff_location_id").isNotNull())
    j = (t.join(pu, t.pickup_location_id == pu._pu_id)
          .join(do, t.dropoff_location_id == do._do_id))
    cols = [F.coalesce("passenger_count", F.lit(0)).alias("passenger_count")
            if c == "passenger_count" else F.col(c) for c in SILVER_COLUMNS]
    return j.select(*cols, "pickup_location_name", "dropoff_location_name")
