"""The business queries over the star schema (Q1-Q22 and named variants).

Each query is ``fn(tables) -> DataFrame``; results are never collected. Plans
are lazy but for the checkpoint of value counts behind exact percentiles.

Plan notes that hold for all of them:

* dimensions are joined as broadcasts behind their row bound (``Dim``);
* a year filter through ``dim_date`` or ``EXTRACT(YEAR FROM pickup_date)``
  is also stated as ``source_month BETWEEN 'Y-01' AND 'Y-12'``. The fact
  only keeps trips whose pickup month equals their file month, so the two
  are equivalent, and the second prunes the fact's month partitions;
* averages of decimals are ``round(sum/count)`` in exact decimal maths
  (Spark's ``avg`` of a decimal rounds to 6 places first);
* ties in top-k lists are broken by the group key so results are stable;
* percentiles are exact and never gather a whole group in one task
  (``operators.percentiles``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.functions.columns import (case_order, day_of_week, exact_mean, exact_mean_scaled,
                                        ntz_lit, percent_of, ratio_percent, time_block)
from tripmart.operators.percentiles import merged_counts, percentiles_of_counts, value_counts
from tripmart.plans.gold import VALUE_MEASURES, Gold, fact_from_bronze


@dataclass(frozen=True)
class Tables:
    bronze: DataFrame
    gold: Gold
    values: DataFrame | None = None  # value counts by month and pickup zone, where they are kept (``gold.value_state``)

    @property
    def p(self):
        return self.gold.params


# ------------------------------------------------------------------ helpers

def _fact_year(t: Tables) -> DataFrame:
    p = t.p
    return t.gold.fact.where(F.col("source_month").between(p.month_lo, p.month_hi))


def _fact_by_date(t: Tables) -> DataFrame:
    """Fact joined to the calendar days of the year (F8 + J1)."""
    d = t.gold.bc(t.gold.dim_date).where(F.col("year") == t.p.year)
    f = _fact_year(t)
    return f.join(d, f.pickup_date_key == d.date_key)


def _fact_year_fn(t: Tables) -> DataFrame:
    """``EXTRACT(YEAR FROM pickup_date) = Y`` (F9) with the pruning range."""
    return _fact_year(t).where(F.year("pickup_date") == t.p.year)


def _zones(t: Tables, prefix: str = "") -> DataFrame:
    z = t.gold.bc(t.gold.dim_zones)
    return z.select(*[F.col(c).alias(prefix + c) for c in z.columns])


def _by_month(df: DataFrame, *aggs, extra_keys=()) -> DataFrame:
    return df.groupBy("year_month", "month_name", "month", *extra_keys).agg(*aggs)


# ------------------------------------------------------------------ Q1-Q5

def q01_trips_per_month(t: Tables) -> DataFrame:
    return (_by_month(_fact_by_date(t), F.count(F.lit(1)).alias("trip_count"))
            .orderBy("month").select("year_month", "month_name", "trip_count"))


def _service(t: Tables) -> DataFrame:
    return t.gold.bc(t.gold.dim_service_type).select(
        F.col("service_type_key").alias("_st_key"), "service_type_name")


def q02_trips_per_month_service(t: Tables) -> DataFrame:
    f = _fact_by_date(t)
    s = _service(t)
    j = f.join(s, f.service_type_key == s._st_key)
    return (_by_month(j, F.count(F.lit(1)).alias("trip_count"),
                      extra_keys=("service_type_name", "_st_key"))
            .orderBy("month", "_st_key")
            .select("year_month", "month_name", "service_type_name", "trip_count"))


def _top_zones(t: Tables, key_col: str) -> DataFrame:
    f = _fact_by_date(t)
    z = _zones(t)
    j = f.join(z, f[key_col] == z.zone_key)
    return (j.groupBy("zone_name", "borough", "zone_key").agg(F.count(F.lit(1)).alias("trip_count"))
            .orderBy(F.desc("trip_count"), F.asc("zone_key")).limit(t.p.top_n)
            .select("zone_name", "borough", "trip_count"))


def q03_top_pickup_zones(t: Tables) -> DataFrame:
    return _top_zones(t, "pu_zone_key")


def q04_top_dropoff_zones(t: Tables) -> DataFrame:
    return _top_zones(t, "do_zone_key")


def q05_top_boroughs_per_month(t: Tables) -> DataFrame:
    f = _fact_by_date(t)
    z = _zones(t)
    counts = _by_month(f.join(z, f.pu_zone_key == z.zone_key),
                       F.count(F.lit(1)).alias("trip_count"), extra_keys=("borough",))
    # Window over the aggregate (months x boroughs rows), not over the fact.
    w = Window.partitionBy("year_month").orderBy(F.desc("trip_count"), F.asc("borough"))
    return (counts.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= t.p.top_per_group)
            .orderBy("year_month", "rank")
            .select("year_month", "month_name", "borough", "trip_count", "rank"))


# ------------------------------------------------------------------ Q6 family

def _valid_bronze(t: Tables) -> DataFrame:
    p = t.p
    b = t.bronze
    # Range predicate on pickup_ts (pushed to the scan) instead of EXTRACT(YEAR).
    return b.where(
        (F.col("pickup_ts") >= ntz_lit(p.year_start))
        & (F.col("pickup_ts") < ntz_lit(p.next_year_start))
        & F.col("pickup_ts").isNotNull() & F.col("dropoff_ts").isNotNull()
        & (F.col("pickup_ts") <= F.col("dropoff_ts"))
        & (F.col("trip_distance") >= 0) & (F.col("total_amount") >= 0)
        & (F.col("passenger_count") >= 0) & (F.col("fare_amount") >= 0)
    ).select(
        day_of_week("pickup_ts").alias("day_of_week"),
        F.hour("pickup_ts").alias("hour"),
        "trip_distance", "total_amount")


def _weekdays(t: Tables) -> DataFrame:
    """Distinct (day_of_week, day_name) of the calendar plus its date count."""
    d = t.gold.bc(t.gold.dim_date)
    return d.groupBy("day_of_week", "day_name").agg(F.count(F.lit(1)).alias("n_dates"))


def _hourly_stats(t: Tables, fan_out: bool) -> DataFrame:
    """Per weekday and hour: trips, mean distance and amount, rank in the day.

    Aggregated before the weekday join. ``fan_out`` reproduces the literal
    join on a non-unique weekday key, where every trip matches each calendar
    date of its weekday: counts scale by that number, means and ranks do not.
    """
    agg = _valid_bronze(t).groupBy("day_of_week", "hour").agg(
        F.count(F.lit(1)).alias("_n"),
        exact_mean("trip_distance").alias("avg_distance"),
        exact_mean("total_amount").alias("avg_amount"))
    wd = F.broadcast(_weekdays(t))
    j = agg.join(wd, "day_of_week")
    n = F.col("_n") * F.col("n_dates") if fan_out else F.col("_n")
    j = j.withColumn("trip_count", n.cast("bigint"))
    w = Window.partitionBy("day_of_week").orderBy(F.desc("trip_count"))
    return j.withColumn("rank_by_day", F.rank().over(w))


def _q06(t: Tables, fan_out: bool) -> DataFrame:
    top = _hourly_stats(t, fan_out).where(F.col("rank_by_day") <= t.p.top_per_group)
    daily = Window.partitionBy("day_name")
    return (top.withColumn("pct_of_daily_trips",
                           percent_of("trip_count", F.sum("trip_count").over(daily)))
            .orderBy(case_order("day_name", schemas.WEEKDAY_ORDER), "rank_by_day", "hour")
            .select("day_name", F.col("hour").cast("int").alias("peak_hour"), "trip_count",
                    "avg_distance", "avg_amount", "pct_of_daily_trips"))


def q06_peak_hours(t: Tables) -> DataFrame:
    return _q06(t, fan_out=False)


def q06_literal_weekday_join(t: Tables) -> DataFrame:
    return _q06(t, fan_out=True)


def q06b_time_block_summary(t: Tables) -> DataFrame:
    top = _hourly_stats(t, fan_out=False).where(F.col("rank_by_day") <= t.p.top_per_group)
    block = time_block("hour", schemas.TIME_BLOCKS, schemas.TIME_BLOCK_ELSE)
    return (top.groupBy(block.alias("time_block")).agg(
                F.count_distinct("day_name").alias("days_appeared"),
                F.sum("trip_count").alias("total_trips"),
                exact_mean("avg_distance").alias("avg_distance"),
                exact_mean("avg_amount").alias("avg_amount"))
            .orderBy(F.desc("total_trips"), "time_block"))


# ------------------------------------------------------------------ Q7-Q11

def q07_weekday_distribution(t: Tables) -> DataFrame:
    g = _fact_by_date(t).groupBy("day_name", "day_of_week").agg(
        F.count(F.lit(1)).alias("trip_count"))
    # Unpartitioned windows over at most 7 aggregate rows.
    everything = Window.partitionBy()
    return (g.withColumn("percentage", percent_of("trip_count", F.sum("trip_count").over(everything)))
             .withColumn("rank", F.rank().over(Window.orderBy(F.desc("trip_count"))).cast("bigint"))
             .orderBy("rank", "day_of_week")
             .select("day_name", "trip_count", "percentage", "rank"))


def q08_revenue_per_month(t: Tables) -> DataFrame:
    return (_by_month(_fact_by_date(t), F.sum("total_amount").alias("total_revenue"))
            .orderBy("month").select("year_month", "month_name", "total_revenue"))


def q09_revenue_per_month_service(t: Tables) -> DataFrame:
    f = _fact_by_date(t)
    s = _service(t)
    j = f.join(s, f.service_type_key == s._st_key)
    return (_by_month(j, F.sum("total_amount").alias("total_revenue"),
                      extra_keys=("service_type_name", "_st_key"))
            .orderBy("month", "_st_key")
            .select("year_month", "month_name", "service_type_name", "total_revenue"))


def q10_tip_pct_per_month(t: Tables) -> DataFrame:
    f = _fact_by_date(t).where(F.col("fare_amount") > 0)
    return (_by_month(f, exact_mean_scaled("tip_percentage", 100).alias("avg_tip_percentage"))
            .orderBy("month").select("year_month", "month_name", "avg_tip_percentage"))


def q11_tip_pct_month_borough(t: Tables) -> DataFrame:
    f = _fact_by_date(t).where(F.col("fare_amount") > 0)
    z = _zones(t)
    j = f.join(z, f.pu_zone_key == z.zone_key)
    return (_by_month(j, exact_mean_scaled("tip_percentage", 100).alias("avg_tip_percentage"),
                      F.count(F.lit(1)).alias("trip_count"), extra_keys=("borough",))
            .orderBy("month", F.desc("avg_tip_percentage"), "borough")
            .select("year_month", "month_name", "borough", "avg_tip_percentage", "trip_count"))


# ------------------------------------------------------------------ Q12-Q14

def _fact_zone_year(t: Tables, zone_key: str = "pu_zone_key") -> DataFrame:
    f = _fact_year_fn(t)
    z = _zones(t)
    return f.join(z, f[zone_key] == z.zone_key)


def q12_top_zones_by_revenue(t: Tables) -> DataFrame:
    return (_fact_zone_year(t).groupBy("zone_name", "borough", "zone_key").agg(
                F.sum("total_amount").alias("total_revenue"),
                F.count(F.lit(1)).alias("trip_count"),
                exact_mean("total_amount").alias("avg_revenue_per_trip"))
            .orderBy(F.desc("total_revenue"), "zone_key").limit(t.p.top_n)
            .select("zone_name", "borough", "total_revenue", "trip_count", "avg_revenue_per_trip"))


def q13_top_zones_by_tip_pct(t: Tables) -> DataFrame:
    f = _fact_zone_year(t).where((F.col("fare_amount") > 0) & (F.col("tip_amount") >= 0))
    return (f.groupBy("zone_name", "borough", "zone_key").agg(
                exact_mean_scaled("tip_percentage", 100).alias("avg_tip_percentage"),
                F.count(F.lit(1)).alias("trip_count"),
                exact_mean("fare_amount").alias("avg_fare"),
                exact_mean("tip_amount").alias("avg_tip"))
            .where(F.col("trip_count") >= t.p.q13_min_trips)
            .orderBy(F.desc("avg_tip_percentage"), "zone_key").limit(t.p.top_n)
            .select("zone_name", "borough", "avg_tip_percentage", "trip_count", "avg_fare", "avg_tip"))


def q14_cash_vs_card(t: Tables) -> DataFrame:
    f = _fact_year_fn(t)
    pt = t.gold.bc(t.gold.dim_payment_type).where(F.col("partition_group").isin("cash", "card"))
    pt = pt.select(F.col("payment_type_key").alias("_pt_key"), "payment_type_name",
                   F.col("partition_group").alias("payment_category"))
    j = f.join(pt, f.payment_type_key == pt._pt_key)
    return (j.groupBy("payment_type_name", "payment_category").agg(
                F.count(F.lit(1)).alias("trip_count"),
                F.sum("total_amount").alias("total_revenue"),
                exact_mean("total_amount").alias("avg_ticket"),
                exact_mean_scaled("tip_percentage", 100).alias("avg_tip_percentage"),
                F.sum("tip_amount").alias("total_tips"),
                ratio_percent(F.sum("tip_amount"), F.sum("fare_amount")).alias("overall_tip_rate"))
            .orderBy(F.desc("trip_count"), "payment_type_name"))


# ------------------------------------------------------------------ Q15-Q16

def q15_duration_per_month(t: Tables) -> DataFrame:
    return (_by_month(_fact_by_date(t), exact_mean("trip_time_minutes").alias("avg_duration_minutes"))
            .orderBy("month").select("year_month", "month_name", "avg_duration_minutes"))


def q16_distance_per_month(t: Tables) -> DataFrame:
    return (_by_month(_fact_by_date(t), exact_mean("trip_distance").alias("avg_distance_miles"))
            .orderBy("month").select("year_month", "month_name", "avg_distance_miles"))


# ------------------------------------------------------------------ Q17-Q20

def _value_report(counts: DataFrame, keys: list[str], pcts: dict[str, float], **names: str) -> DataFrame:
    """Per group of value counts: trip count, exact PERCENTILE_CONT values and, under the given names, mean,
    min and max of the values, rounded to 2."""
    found = percentiles_of_counts(counts, keys, pcts)
    parts = {"mean": F.col("_sum") / F.col("_count"), "min": F.col("_min"), "max": F.col("_max")}
    return found.select(*keys, F.col("_count").alias("trip_count"), *[F.round(F.col(p), 2).alias(p) for p in pcts],
                        *[F.round(parts[k], 2).alias(name) for k, name in names.items()])


def _zone_counts(t: Tables, value: str, keys: list[str], kept: F.Column) -> DataFrame:
    """Counts of ``value`` where ``kept`` (a condition on ``_v``) by keys of the pickup zone, over the year: from
    the months' kept counts, else from the fact."""
    if t.values is None:
        rows = _fact_zone_year(t).where(VALUE_MEASURES[value]).withColumn("_v", F.col(value)).where(kept)
        return value_counts(rows.drop("_v"), keys, value)
    year = t.values.where(F.col("source_month").between(t.p.month_lo, t.p.month_hi) & (F.col("measure") == value) & kept)
    z = _zones(t)
    # the type that the fact's column has, which sums and interpolation follow
    counts = year.withColumn("_v", F.col("_v").cast(t.gold.fact.schema[value].dataType))
    return merged_counts(counts.join(z, counts.pu_zone_key == z.zone_key), keys)


def _borough_order():
    return case_order("borough", schemas.BOROUGH_ORDER, len(schemas.BOROUGH_ORDER) + 1)


def _plausible_speed(t: Tables, f: DataFrame) -> DataFrame:
    return f.where(VALUE_MEASURES["speed_mph"]).where(F.col("speed_mph").between(0, t.p.q17_max_speed))


def _speed_report(t: Tables, counts: DataFrame, keys: list[str]) -> DataFrame:
    report = _value_report(counts, keys, {"median_speed_mph": 0.5},
                           mean="avg_speed_mph", min="min_speed_mph", max="max_speed_mph")
    return (report.where(F.col("trip_count") >= t.p.q17_min_trips).orderBy(_borough_order(), *keys)
            .select(*keys, "avg_speed_mph", "median_speed_mph", "trip_count", "min_speed_mph", "max_speed_mph"))


def q17_speed_by_borough(t: Tables) -> DataFrame:
    return _speed_report(t, _zone_counts(t, "speed_mph", ["borough"], F.col("_v").between(0, t.p.q17_max_speed)), ["borough"])


def q17b_speed_by_borough_time_block(t: Tables) -> DataFrame:
    """Q17 split by time-of-day block of the pickup (the split its title
    promises). The published fact has no pickup timestamp, so a written lake
    rebuilds the unkeyed fact from bronze, pruned to the year's months."""
    if "pickup_ts" not in t.gold.fact.columns:
        p = t.p
        bronze = t.bronze.where(F.col("source_month").between(p.month_lo, p.month_hi))
        t = replace(t, gold=replace(t.gold, fact=fact_from_bronze(bronze, t.gold)))
    f = _plausible_speed(t, _fact_zone_year(t)).withColumn(
        "time_block", time_block(F.hour("pickup_ts"), schemas.TIME_BLOCKS, schemas.TIME_BLOCK_ELSE))
    keys = ["borough", "time_block"]
    return _speed_report(t, value_counts(f, keys, "speed_mph"), keys)


def q18_duration_percentiles_by_borough(t: Tables) -> DataFrame:
    counts = _zone_counts(t, "trip_time_minutes", ["borough"], F.lit(True))
    return (_value_report(counts, ["borough"], {"p50_duration_min": 0.5, "p90_duration_min": 0.9})
            .orderBy(F.desc("p90_duration_min"), "borough")
            .select("borough", "trip_count", "p50_duration_min", "p90_duration_min"))


def q19_top_zones_by_p90_duration(t: Tables) -> DataFrame:
    keys = ["zone_name", "borough", "zone_key"]
    report = _value_report(_zone_counts(t, "trip_time_minutes", keys, F.lit(True)), keys, {"p90_duration_min": 0.9},
                           mean="avg_duration_min", max="max_duration_min")
    return (report.where(F.col("trip_count") >= t.p.q19_min_trips)
            .orderBy(F.desc("p90_duration_min"), "zone_key").limit(t.p.top_n)
            .select("zone_name", "borough", "trip_count", "p90_duration_min",
                    "avg_duration_min", "max_duration_min"))


def q20_top_borough_routes(t: Tables) -> DataFrame:
    f = _fact_year_fn(t)
    pu = _zones(t, "pu_")
    do = _zones(t, "do_")
    j = (f.join(pu, f.pu_zone_key == pu.pu_zone_key)
          .join(do, f.do_zone_key == do.do_zone_key))
    return (j.groupBy(F.col("pu_borough").alias("pickup_borough"),
                      F.col("do_borough").alias("dropoff_borough")).agg(
                F.count(F.lit(1)).alias("trip_count"),
                exact_mean("total_amount").alias("avg_revenue"),
                exact_mean("trip_distance").alias("avg_distance_miles"),
                exact_mean("trip_time_minutes").alias("avg_duration_min"))
            .orderBy(F.desc("trip_count"), "pickup_borough", "dropoff_borough")
            .limit(t.p.top_n))


# ------------------------------------------------------------------ Q21-Q22

def gold_table_frames(t: Tables) -> dict[str, DataFrame]:
    from tripmart.schemas import FACT_COLUMNS

    fact = t.gold.fact
    fact_cols = [c for c in FACT_COLUMNS if c in fact.columns]
    return {"fct_trips": fact.select(*fact_cols), **{k: d.df for k, d in t.gold.dims().items()}}


def q21_column_metadata(t: Tables) -> DataFrame:
    """Column name and type by ordinal position for the six gold tables.

    Schemas are plan metadata: nothing is scanned.
    """
    rows = []
    for table, df in gold_table_frames(t).items():
        for i, f in enumerate(df.schema.fields, start=1):
            rows.append((table, i, f.name, f.dataType.simpleString()))
    spark = t.gold.fact.sparkSession
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("table_name", T.StringType(), False),
        T.StructField("ordinal_position", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
    ]))


def q22_fact_sample(t: Tables, n: int = 5) -> DataFrame:
    """First ``n`` fact rows by trip key (ties broken by every column).

    The n-th smallest key, found in the key column alone, is pushed down as a
    filter; so whole rows are read from few row groups.
    """
    fact = gold_table_frames(t)["fct_trips"]
    order = ["trip_key"] if "trip_key" in fact.columns else []
    if order:
        smallest = [r[0] for r in fact.select("trip_key").orderBy(F.asc_nulls_last("trip_key")).limit(n).collect()]
        if len(smallest) == n and smallest[-1] is not None:
            fact = fact.where(F.col("trip_key") <= F.lit(smallest[-1]))
    order += [c for c in fact.columns if c not in order]
    return fact.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


QUERIES = {
    "q01_trips_per_month": q01_trips_per_month,
    "q02_trips_per_month_service": q02_trips_per_month_service,
    "q03_top_pickup_zones": q03_top_pickup_zones,
    "q04_top_dropoff_zones": q04_top_dropoff_zones,
    "q05_top_boroughs_per_month": q05_top_boroughs_per_month,
    "q06_peak_hours": q06_peak_hours,
    "q06_literal_weekday_join": q06_literal_weekday_join,
    "q06b_time_block_summary": q06b_time_block_summary,
    "q07_weekday_distribution": q07_weekday_distribution,
    "q08_revenue_per_month": q08_revenue_per_month,
    "q09_revenue_per_month_service": q09_revenue_per_month_service,
    "q10_tip_pct_per_month": q10_tip_pct_per_month,
    "q11_tip_pct_month_borough": q11_tip_pct_month_borough,
    "q12_top_zones_by_revenue": q12_top_zones_by_revenue,
    "q13_top_zones_by_tip_pct": q13_top_zones_by_tip_pct,
    "q14_cash_vs_card": q14_cash_vs_card,
    "q15_duration_per_month": q15_duration_per_month,
    "q16_distance_per_month": q16_distance_per_month,
    "q17_speed_by_borough": q17_speed_by_borough,
    "q17b_speed_by_borough_time_block": q17b_speed_by_borough_time_block,
    "q18_duration_percentiles_by_borough": q18_duration_percentiles_by_borough,
    "q19_top_zones_by_p90_duration": q19_top_zones_by_p90_duration,
    "q20_top_borough_routes": q20_top_borough_routes,
}
