"""Registry of named queries over the driver's tables: name -> fn(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.operators.impute import fill_upper_median
from tripmart.params import TESTDATA
from tripmart.plans import ledger
from tripmart.plans import queries as Q
from tripmart.plans.bronze import null_audit
from tripmart.plans.checks import gold_checks, silver_checks
from tripmart.plans.gold import with_trip_key
from tripmart.plans.pipeline import testdata_bronze, testdata_tables, testdata_zones
from tripmart.plans.silver import silver_trips
from tripmart.sources import generators, testdata

Fn = Callable[[SparkSession, str], DataFrame]

IMPUTE_COLUMNS = ["passenger_count", "trip_distance", "fare_amount", "tip_amount",
                  "tolls_amount", "total_amount"]


def _ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ingestion log with every event: one entry per order, for the slice of its month."""
    o = testdata._read(spark, sf_dir, "orders")
    first = F.substring("o_orderpriority", 1, 1)
    event = F.when(first.isin("1", "5"), "started").when(first == "2", "processing").when(first == "3", "failed") \
        .otherwise("completed")
    return o.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
        F.when(F.col("o_custkey") % 7 == 0, "green").otherwise("yellow").alias("service_type"),
        event.alias("event"),
        F.expr("timestampadd(MICROSECOND, o_orderkey, o_orderdate)").cast("timestamp_ntz").alias("event_ts"),
        F.when(event == "completed", F.col("o_orderkey") % 100_000).cast("bigint").alias("rows_ingested"),
        F.when(event == "failed", F.concat(F.lit("order "), F.col("o_orderkey"))).alias("error_message"))


def _landed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.state(_ledger_events(spark, sf_dir))


def _grid(spark: SparkSession) -> DataFrame:
    p = TESTDATA
    return generators.slice_grid(spark, p.grid_first_year, p.grid_last_year, schemas.GRID_SERVICES)


def _q(fn) -> Fn:
    return lambda spark, sf_dir: fn(testdata_tables(spark, sf_dir, TESTDATA))


def _keyed_tables(spark: SparkSession, sf_dir: str) -> Q.Tables:
    t = testdata_tables(spark, sf_dir, TESTDATA)
    return Q.Tables(t.bronze, replace(t.gold, fact=with_trip_key(t.gold.fact)))


def _dim(name: str) -> Fn:
    return lambda spark, sf_dir: testdata_tables(spark, sf_dir).gold.dims()[name].df


# Registered queries all read the driver's tables. The literal dimensions
# (service types, payment types, vendors), the parameter-generated calendar
# and the column-metadata query (Q21) read no table data; they are covered by
# unit tests, by the gold data-quality query and by every query joining them.
REGISTRY: dict[str, Fn] = {
    **{name: _q(fn) for name, fn in Q.QUERIES.items()},
    "q22_fact_sample": lambda spark, sf: Q.q22_fact_sample(_keyed_tables(spark, sf)),
    "landing_harmonised": testdata.harmonised_landing,
    "bronze_trips": testdata_bronze,
    "bronze_zones": lambda spark, sf: testdata_zones(spark, sf).df,
    "silver_trips_zones": lambda spark, sf: silver_trips(
        testdata_bronze(spark, sf), testdata_zones(spark, sf), TESTDATA.max_broadcast_rows),
    "silver_null_audit": lambda spark, sf: null_audit(testdata_bronze(spark, sf)),
    "gold_dim_zones": _dim("dim_zones"),
    "gold_fct_trips": lambda spark, sf: _keyed_tables(spark, sf).gold.fact,
    "dq_silver_tests": lambda spark, sf: silver_checks(
        silver_trips(testdata_bronze(spark, sf), testdata_zones(spark, sf), TESTDATA.max_broadcast_rows),
        testdata_zones(spark, sf), TESTDATA.max_broadcast_rows),
    "dq_gold_tests": lambda spark, sf: gold_checks(_keyed_tables(spark, sf).gold),
    "i1_impute_upper_median": lambda spark, sf: fill_upper_median(
        testdata.landing_trips(spark, sf), IMPUTE_COLUMNS),
    "b2_pending_slices": lambda spark, sf: ledger.pending(_grid(spark), _landed_state(spark, sf)),
    "b4_ledger_state": _landed_state,
    "b7_coverage": lambda spark, sf: ledger.coverage(_grid(spark), _landed_state(spark, sf)),
}
