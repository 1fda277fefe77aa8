"""Row order of the reports (the oracle comparison is order-free)."""

import pytest

from tripmart import schemas
from tripmart.params import TESTDATA
from tripmart.plans import catalog
from tripmart.plans import queries as Q
from tripmart.plans.gold import Gold
from tripmart.operators.joins import Dim

from conftest import SF001

UP, DOWN = 1, -1
DAY = {d: i for i, d in enumerate(schemas.WEEKDAY_ORDER)}

# name -> keys of the order: (column, direction), or a function of the row
ORDERS = {
    "q01_trips_per_month": [("year_month", UP)],
    "q02_trips_per_month_service": [("year_month", UP), (lambda r: r.service_type_name == "Green Taxi", UP)],
    "q03_top_pickup_zones": [("trip_count", DOWN)],
    "q04_top_dropoff_zones": [("trip_count", DOWN)],
    "q05_top_boroughs_per_month": [("year_month", UP), ("rank", UP)],
    "q06_peak_hours": [(lambda r: DAY[r.day_name], UP), ("trip_count", DOWN)],
    "q06b_time_block_summary": [("total_trips", DOWN)],
    "q07_weekday_distribution": [("rank", UP)],
    "q08_revenue_per_month": [("year_month", UP)],
    "q10_tip_pct_per_month": [("year_month", UP)],
    "q11_tip_pct_month_borough": [("year_month", UP), ("avg_tip_percentage", DOWN)],
    "q12_top_zones_by_revenue": [("total_revenue", DOWN)],
    "q13_top_zones_by_tip_pct": [("avg_tip_percentage", DOWN)],
    "q14_cash_vs_card": [("trip_count", DOWN)],
    "q15_duration_per_month": [("year_month", UP)],
    "q18_duration_percentiles_by_borough": [("p90_duration_min", DOWN)],
    "q19_top_zones_by_p90_duration": [("p90_duration_min", DOWN)],
    "q20_top_borough_routes": [("trip_count", DOWN)],
    "q22_fact_sample": [("trip_key", UP)],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_report_order(spark, name):
    rows = catalog.REGISTRY[name](spark, SF001).collect()
    keys = [tuple(way * (c(r) if callable(c) else r[c]) if not isinstance(r[c] if not callable(c) else 0, str) else r[c]
                  for c, way in ORDERS[name]) for r in rows]
    assert len(rows) > 1 or name == "q14_cash_vs_card"
    assert keys == sorted(keys)


def test_boroughs_in_their_own_order(spark):
    """The borough order of Q17 with the real names, unknown ones last by name."""
    names = ["Unknown", "Bronx", "Staten Island", "EWR", "Manhattan", "Queens", "Brooklyn"]
    fact = spark.createDataFrame(
        [("1996-05", 1, z, 12.5, 10.0, 3.0) for z in range(len(names)) for _ in range(10)],
        "source_month string, d int, pu_zone_key int, speed double, minutes double, miles double").selectExpr(
        "source_month", "DATE '1996-05-02' AS pickup_date", "pu_zone_key", "CAST(speed AS decimal(18,2)) AS speed_mph",
        "CAST(minutes AS decimal(10,2)) AS trip_time_minutes", "CAST(miles AS decimal(10,2)) AS trip_distance")
    zones = spark.createDataFrame([(i, n, n, "x") for i, n in enumerate(names)],
                                  "zone_key int, borough string, zone_name string, service_zone string")
    none = Dim(zones)
    gold = Gold(fact, none, Dim(zones), none, none, none, TESTDATA)
    rows = Q.q17_speed_by_borough(Q.Tables(fact, gold)).collect()
    assert [r.borough for r in rows] == ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown"]
