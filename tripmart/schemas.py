"""Declared schemas and the fixed lookup values of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# dim_service_type: (service_type_key, service_type_name, service_type_code, partition_group)
SERVICE_TYPES = [
    (1, "Yellow Taxi", "yellow", "yellow"),
    (2, "Green Taxi", "green", "green"),
]

# dim_payment_type: (payment_type_key, payment_type_name, partition_group)
PAYMENT_TYPES = [
    (0, "Flex Fare", "flex"),
    (1, "Credit Card", "card"),
    (2, "Cash", "cash"),
    (3, "No Charge", "other/unknown"),
    (4, "Dispute", "other/unknown"),
    (5, "Unknown", "other/unknown"),
    (6, "Voided Trip", "other/unknown"),
]

# dim_vendors: (vendor_key, vendor_id, vendor_name, vendor_code, vendor_group,
#               description, partition_group)
VENDORS = [
    (1, 1, "Creative Mobile Technologies, LLC", "CMT", "Creative",
     "Creative Mobile Technologies - TPEP provider", "creative"),
    (2, 2, "Curb Mobility, LLC", "CURB", "Curb", "Curb Mobility (formerly Verifone)", "curb"),
    (3, 6, "Myle Technologies Inc", "MYLE", "Myle", "Myle Technologies Inc", "myle"),
    (4, 7, "Helix", "HELIX", "Helix", "Helix", "helix"),
    (5, 99, "Other", "OTH", "Other", "Other or unknown vendors", "other"),
]

# Fallbacks applied while building the fact.
DEFAULT_VENDOR_ID = 99          # NULL VendorID
DEFAULT_PAYMENT_TYPE_ID = 5     # NULL payment type
DEFAULT_VENDOR_KEY = 5          # vendor id missing from dim_vendors
DEFAULT_PAYMENT_TYPE_KEY = 5    # payment id missing from dim_payment_type
SERVICE_TYPE_KEYS = {"yellow": 1, "green": 2}
SERVICE_TYPE_KEY_ELSE = 2

# Zone attribute defaults.
UNKNOWN_BOROUGH = "Unknown Borough"
UNKNOWN_ZONE = "Unknown Zone"
UNKNOWN_SERVICE_ZONE = "Unknown"

# Overflow guard on the four amounts at bronze.
AMOUNT_GUARD = "99999999.99"

# Strings that pandas.read_csv turns into NaN by default (zone lookup CSV).
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Ordering used by the weekday and borough reports.
WEEKDAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
BOROUGH_ORDER = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island"]

# Time-of-day blocks of the peak-hour summary: (first hour, last hour, label).
TIME_BLOCKS = [
    (6, 9, "Morning Rush (6-9)"),
    (10, 15, "Midday (10-15)"),
    (16, 19, "Evening Rush (16-19)"),
    (20, 23, "Night (20-23)"),
]
TIME_BLOCK_ELSE = "Late Night (0-5)"

# Backfill grid services (years are parameters: Params.grid_first_year/last_year).
GRID_SERVICES = ["yellow", "green"]

# Gold fact column order (the partition-converted schema).
FACT_COLUMNS = [
    "trip_key", "pickup_date", "pickup_date_key", "dropoff_date_key",
    "service_type_key", "vendor_key", "pu_zone_key", "do_zone_key", "payment_type_key",
    "passenger_count", "trip_distance", "fare_amount", "tip_amount", "tolls_amount",
    "total_amount", "trip_time_minutes", "tip_percentage", "speed_mph",
    "pickup_location_id", "dropoff_location_id", "payment_type_id", "vendor_id",
    "source_month", "service_type", "ingest_ts",
]

# The ten columns whose order defines the dense-rank trip key.
TRIP_KEY_ORDER = [
    "vendor_id", "pickup_ts", "dropoff_ts", "pickup_location_id", "dropoff_location_id",
    "passenger_count", "trip_distance", "total_amount", "service_type", "source_month",
]

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

NTZ = T.TimestampNTZType()

# Landing table (raw.taxi_trips after harmonisation of the two services).
LANDING = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("lpep_pickup_datetime", NTZ),
    T.StructField("lpep_dropoff_datetime", NTZ),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.DoubleType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("payment_type", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("trip_type", T.DoubleType()),
    T.StructField("ehail_fee", T.DoubleType()),
    T.StructField("ingest_ts", NTZ),
    T.StructField("source_month", T.StringType()),
    T.StructField("service_type", T.StringType()),
])

ZONES_CSV = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

CHECKPOINT_EVENTS = T.StructType([
    T.StructField("year_month", T.StringType(), False),
    T.StructField("service_type", T.StringType(), False),
    T.StructField("event", T.StringType(), False),  # started | processing | completed | failed
    T.StructField("event_ts", NTZ, False),
    T.StructField("rows_ingested", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("run_id", T.StringType()),  # the run that claimed the slice
])
