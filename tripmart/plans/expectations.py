"""The declared column tests of the silver and gold layers (fixed values)."""

from __future__ import annotations

from tripmart.operators.quality import accepted, fk, not_null, unique

# ---------------------------------------------------------------- fixed values
SILVER_PASSENGER_COUNTS = [0, 1, 2, 3, 4, 5, 6, 7, 8]
GOLD_PASSENGER_COUNTS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]
SERVICE_CODES = ["yellow", "green"]
PAYMENT_GROUPS = ["cash", "card", "flex", "other/unknown"]
VENDOR_GROUPS = ["creative", "curb", "myle", "helix", "other"]

SILVER = "int_taxi_trips_zones_joined"
FACT = "fct_trips"

SILVER_TESTS = [
    *not_null(SILVER, "pickup_ts", "dropoff_ts"),
    *not_null(SILVER, "pickup_location_id"),
    *fk(SILVER, "pickup_location_id", "stg_zones", "location_id"),
    *not_null(SILVER, "dropoff_location_id"),
    *fk(SILVER, "dropoff_location_id", "stg_zones", "location_id"),
    *not_null(SILVER, "passenger_count"),
    *accepted(SILVER, "passenger_count", SILVER_PASSENGER_COUNTS),
]

GOLD_TESTS = [
    *not_null(FACT, "trip_key"),
    *not_null(FACT, "pickup_date_key"), *fk(FACT, "pickup_date_key", "dim_date", "date_key"),
    *not_null(FACT, "dropoff_date_key"), *fk(FACT, "dropoff_date_key", "dim_date", "date_key"),
    *not_null(FACT, "service_type_key"),
    *fk(FACT, "service_type_key", "dim_service_type", "service_type_key"),
    *not_null(FACT, "vendor_key"), *fk(FACT, "vendor_key", "dim_vendors", "vendor_key"),
    *not_null(FACT, "pu_zone_key"), *fk(FACT, "pu_zone_key", "dim_zones", "zone_key"),
    *not_null(FACT, "do_zone_key"), *fk(FACT, "do_zone_key", "dim_zones", "zone_key"),
    *not_null(FACT, "payment_type_key"),
    *fk(FACT, "payment_type_key", "dim_payment_type", "payment_type_key"),
    *not_null(FACT, "passenger_count"), *accepted(FACT, "passenger_count", GOLD_PASSENGER_COUNTS),
    *not_null(FACT, "trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount",
              "trip_time_minutes", "source_month", "service_type"),
    *accepted(FACT, "service_type", SERVICE_CODES),
    *unique("dim_date", "date_key"), *not_null("dim_date", "date_key"),
    *unique("dim_date", "date"), *not_null("dim_date", "date"),
    *unique("dim_zones", "zone_key"), *not_null("dim_zones", "zone_key", "borough", "zone_name"),
    *unique("dim_service_type", "service_type_key"), *not_null("dim_service_type", "service_type_key"),
    *not_null("dim_service_type", "service_type_code"),
    *accepted("dim_service_type", "service_type_code", SERVICE_CODES),
    *unique("dim_payment_type", "payment_type_key"), *not_null("dim_payment_type", "payment_type_key"),
    *not_null("dim_payment_type", "payment_type_name", "partition_group"),
    *accepted("dim_payment_type", "partition_group", PAYMENT_GROUPS),
    *unique("dim_vendors", "vendor_key"), *not_null("dim_vendors", "vendor_key"),
    *unique("dim_vendors", "vendor_id"), *not_null("dim_vendors", "vendor_id"),
    *not_null("dim_vendors", "vendor_name", "partition_group"),
    *accepted("dim_vendors", "partition_group", VENDOR_GROUPS),
]

# The starter model: ids 1 and NULL, both columns tested unique + not_null.
EXAMPLE_TESTS = [
    *unique("example_first_model", "id"), *not_null("example_first_model", "id"),
    *unique("example_second_model", "id"), *not_null("example_second_model", "id"),
]
