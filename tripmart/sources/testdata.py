"""Adapter: trip-shaped landing data derived from the driver's TPC-H tables.

The driver provides TPC-H-like tables, not taxi trips. Every trip below is
one ``lineitem`` row joined to its order, customer and supplier, so the
work grows with the tables. The mapping is fixed and written the same way
in the DuckDB oracle (``tripmart.oracle``):

====================  ==========================================================
trip column           derived from
====================  ==========================================================
VendorID              l_linenumber (1, 2, 6, 7 are known vendors; 3-5 are not)
pickup time           o_orderdate + (o_orderkey % 24) h + (o_custkey % 60) min
dropoff time          l_shipdate + (l_partkey % 24) h + (l_suppkey % 60) min
passenger_count       l_quantity / 10, NULL when l_quantity = 7
trip_distance         l_quantity
RatecodeID            1, 2 for returnflag R, 3 for returnflag A
PULocationID          c_nationkey (0-24)
DOLocationID          s_nationkey + 1 (1-25; 25 has no zone)
payment_type          first digit of o_orderpriority
fare_amount           l_extendedprice
tip_amount            round(fare * l_discount, 2), exact decimal maths
tolls_amount          round(fare * l_tax, 2); NULL when l_tax = 0
total_amount          fare + tip + tolls
service_type          yellow when l_linestatus = 'F', else green
source_month          month of the pickup; month of the ship date for
                      1-URGENT orders (exercises the month filter)
trip_type             1 for returnflag N, else 2 (green only)
====================  ==========================================================

Zones come from ``nation`` joined to ``region``: location = nation key,
borough = region name (empty for nation 24), zone = nation name ('N/A' for
nation 23), service zone by region.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.columns import ntz_lit, year_month

# Lineage timestamp stamped on adapter rows (files are "downloaded" once).
DEFAULT_INGEST_TS = dt.datetime(2026, 1, 1, 0, 0, 0)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landing_trips(spark: SparkSession, sf_dir: str,
                  ingest_ts: dt.datetime = DEFAULT_INGEST_TS) -> DataFrame:
    """Harmonised landing rows (the shape of the raw trips table)."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    o = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    # No broadcast hints: customer and supplier grow with the scale factor,
    # so the join strategy is left to the size checks of Catalyst and AQE.
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, o.o_custkey == c.c_custkey)
           .join(s, li.l_suppkey == s.s_suppkey))

    fare = F.col("l_extendedprice").cast("decimal(15,2)")
    tip = F.round(fare * F.col("l_discount").cast("decimal(4,2)"), 2)
    tolls = F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(
        F.round(fare * F.col("l_tax").cast("decimal(4,2)"), 2))
    total = fare + tip + F.coalesce(tolls, F.lit(0))
    pickup = F.expr("timestampadd(MINUTE, (o_orderkey % 24) * 60 + o_custkey % 60, o_orderdate)")
    dropoff = F.expr("timestampadd(MINUTE, (l_partkey % 24) * 60 + l_suppkey % 60, l_shipdate)")
    service = F.when(F.col("l_linestatus") == "F", "yellow").otherwise("green")

    return j.select(
        F.col("l_linenumber").cast("int").alias("VendorID"),
        pickup.alias("lpep_pickup_datetime"),
        dropoff.alias("lpep_dropoff_datetime"),
        F.when(F.col("l_quantity") == 7, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity") / 10).alias("passenger_count"),
        F.col("l_quantity").cast("double").alias("trip_distance"),
        F.when(F.col("l_returnflag") == "R", 2.0).when(F.col("l_returnflag") == "A", 3.0)
         .otherwise(1.0).alias("RatecodeID"),
        F.col("c_nationkey").cast("int").alias("PULocationID"),
        (F.col("s_nationkey") + 1).cast("int").alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("payment_type"),
        fare.cast("double").alias("fare_amount"),
        tip.cast("double").alias("tip_amount"),
        tolls.cast("double").alias("tolls_amount"),
        total.cast("double").alias("total_amount"),
        F.when(service == "green",
               F.when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)).alias("trip_type"),
        F.lit(None).cast("double").alias("ehail_fee"),
        ntz_lit(ingest_ts).alias("ingest_ts"),
        F.when(F.col("o_orderpriority") == "1-URGENT", year_month("l_shipdate"))
         .otherwise(year_month("o_orderdate")).alias("source_month"),
        service.alias("service_type"),
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup rows as strings, as a CSV reader would hand them over."""
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("n_nationkey").cast("int").alias("LocationID"),
        F.when(F.col("n_nationkey") == 24, F.lit("")).otherwise(F.col("r_name")).alias("Borough"),
        F.when(F.col("n_nationkey") == 23, F.lit("N/A")).otherwise(F.col("n_name")).alias("Zone"),
        F.when(F.col("n_regionkey") == 0, "Boro Zone")
         .when(F.col("n_regionkey") == 1, "Yellow Zone")
         .when(F.col("n_regionkey") == 2, "Airports")
         .when(F.col("n_regionkey") == 3, "EWR")
         .otherwise("N/A").alias("service_zone"),
    )


def stage_landing_files(spark: SparkSession, sf_dir: str, landing_dir: str) -> None:
    """Write adapter trips as monthly landing files, each service in its own
    file layout: ``{landing_dir}/service_type=S/source_month=M/part-*.parquet``.

    Used by tests and the benchmark to exercise the file-based ingest.
    """
    landing = landing_trips(spark, sf_dir)
    for service in ("yellow", "green"):
        # Few files per month; AQE splits a large month over several tasks.
        (_file_rows(landing, service).hint("rebalance", "source_month")
         .write.mode("overwrite").partitionBy("source_month")
         .parquet(f"{landing_dir.rstrip('/')}/service_type={service}"))


def harmonised_landing(spark: SparkSession, sf_dir: str,
                       ingest_ts: dt.datetime = DEFAULT_INGEST_TS) -> DataFrame:
    """Landing rows rebuilt from the per-service file layouts: each service's
    rows are harmonised (P1-P3), stamped and cast to the landing schema."""
    from tripmart.operators.harmonise import conform, harmonise

    landing = landing_trips(spark, sf_dir, ingest_ts)
    parts = []
    for service in ("yellow", "green"):
        files = harmonise(_file_rows(landing, service), service)
        parts.append(conform(files.withColumns({"service_type": F.lit(service),
                                                "ingest_ts": ntz_lit(ingest_ts)})))
    return parts[0].unionByName(parts[1])


def _file_rows(landing: DataFrame, service: str) -> DataFrame:
    """Rows of one service in its file layout, keeping source_month for the folder."""
    rows = landing.where(F.col("service_type") == service).drop("ingest_ts", "service_type")
    if service == "yellow":
        rows = (rows.drop("trip_type", "ehail_fee")
                .withColumnsRenamed({"lpep_pickup_datetime": "tpep_pickup_datetime",
                                     "lpep_dropoff_datetime": "tpep_dropoff_datetime"})
                .withColumn("Airport_fee", F.lit(0.0)))
    return rows
