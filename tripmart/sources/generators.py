"""Generated relations: fixed dimensions (S7), calendar (S8), slice grid."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas


def service_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schemas.SERVICE_TYPES, T.StructType([
        T.StructField("service_type_key", T.IntegerType(), False),
        T.StructField("service_type_name", T.StringType(), False),
        T.StructField("service_type_code", T.StringType(), False),
        T.StructField("partition_group", T.StringType(), False),
    ]))


def payment_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schemas.PAYMENT_TYPES, T.StructType([
        T.StructField("payment_type_key", T.IntegerType(), False),
        T.StructField("payment_type_name", T.StringType(), False),
        T.StructField("partition_group", T.StringType(), False),
    ]))


def vendors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schemas.VENDORS, T.StructType([
        T.StructField("vendor_key", T.IntegerType(), False),
        T.StructField("vendor_id", T.IntegerType(), False),
        T.StructField("vendor_name", T.StringType(), False),
        T.StructField("vendor_code", T.StringType(), False),
        T.StructField("vendor_group", T.StringType(), False),
        T.StructField("description", T.StringType(), False),
        T.StructField("partition_group", T.StringType(), False),
    ]))


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both bounds inclusive (generate_series)."""
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("date"))


def calendar_days(start: dt.date, end: dt.date) -> int:
    return (end - start).days + 1


def slice_grid(spark: SparkSession, first_year: int, last_year: int,
               services: list[str]) -> DataFrame:
    """(year_month, service_type) for every month of the years x services.

    Generated with ``sequence`` and ``explode`` (years x 12 x services rows).
    """
    months = F.sequence(F.lit(dt.date(first_year, 1, 1)), F.lit(dt.date(last_year, 12, 1)),
                        F.expr("INTERVAL 1 MONTH"))
    return (spark.range(1)
            .select(F.explode(months).alias("d"))
            .select(F.date_format("d", "yyyy-MM").alias("year_month"),
                    F.explode(F.array(*[F.lit(s) for s in services])).alias("service_type")))
