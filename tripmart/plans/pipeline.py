"""Wiring of the layers for the driver's test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators.joins import Dim
from tripmart.params import TESTDATA, Params
from tripmart.plans.bronze import bronze_trips, bronze_zones
from tripmart.plans.gold import build_gold
from tripmart.plans.queries import Tables
from tripmart.sources import testdata
from tripmart.sources.files import normalise_zone_strings


def testdata_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_trips(testdata.landing_trips(spark, sf_dir))


def testdata_zones(spark: SparkSession, sf_dir: str) -> Dim:
    return Dim(bronze_zones(normalise_zone_strings(testdata.zone_lookup(spark, sf_dir))))


def testdata_tables(spark: SparkSession, sf_dir: str, p: Params = TESTDATA) -> Tables:
    """Bronze and gold planned lazily from the adapter over ``sf_dir``."""
    bronze = testdata_bronze(spark, sf_dir)
    return Tables(bronze=bronze, gold=build_gold(spark, bronze, testdata_zones(spark, sf_dir), p))
