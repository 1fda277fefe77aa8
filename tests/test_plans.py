"""Plan assertions over tables written by the jobs: pruning, pushdown, broadcasts."""

import pytest
from pyspark.sql import functions as F

from tripmart.params import TESTDATA
from tripmart.plans import jobs
from tripmart.plans import queries as Q
from tripmart.sources import testdata

from conftest import SF001


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    lake = jobs.Lake(f"{root}/lake")
    testdata.stage_landing_files(spark, SF001, f"{root}/landing")
    jobs.ingest_zones(spark, lake, zones=testdata.zone_lookup(spark, SF001))
    jobs.backfill(spark, lake, f"{root}/landing", TESTDATA)
    jobs.build_gold_tables(spark, lake, TESTDATA).collect()
    return jobs.load_tables(spark, lake, TESTDATA)


def _plan(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["q01_trips_per_month", "q05_top_boroughs_per_month",
                                  "q12_top_zones_by_revenue", "rows of q17",
                                  "q20_top_borough_routes"])
def test_fact_scan_is_month_pruned(tables, name):
    if name == "rows of q17":   # its only fact scan lies before the checkpoint of value counts
        plan = _plan(Q._plausible_speed(tables, Q._fact_zone_year(tables)))
    else:
        plan = _plan(Q.QUERIES[name](tables))
    assert "PartitionFilters: [isnotnull(source_month" in plan
    assert "1996-01" in plan and "1996-12" in plan
    assert "BroadcastHashJoin" in plan          # dimensions are broadcast
    assert "SortMergeJoin" not in plan


def test_column_pruning(tables):
    plan = _plan(Q.q08_revenue_per_month(tables))
    assert "ReadSchema: struct<pickup_date_key:int,total_amount:decimal(10,2)>" in plan


def test_top_k_is_take_ordered(tables):
    assert "TakeOrderedAndProject" in _plan(Q.q03_top_pickup_zones(tables))


def test_bronze_year_filter_pushed(tables):
    plan = _plan(Q.q06_peak_hours(tables))
    assert "GreaterThanOrEqual(pickup_ts" in plan and "LessThan(pickup_ts" in plan


def test_windows_run_on_aggregates(tables):
    """The top-k windows sit above the final aggregate, never on raw fact rows."""
    plan = Q.q05_top_boroughs_per_month(tables)._jdf.queryExecution().optimizedPlan().toString()
    window_at = plan.find("Window")
    assert window_at >= 0 and plan.find("Aggregate", window_at) > window_at


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _ntz_fact(tables):
    return tables.gold.fact.withColumns({"pickup_ts": F.col("pickup_date").cast("timestamp_ntz"),
                                         "dropoff_ts": F.col("pickup_date").cast("timestamp_ntz")}).drop("trip_key")


def test_trip_key_has_no_global_window_over_fact(spark, tables):
    """The only unpartitioned windows are over the table with a row for each partition."""
    from tripmart.plans.gold import with_trip_key

    plan = _optimized(with_trip_key(_ntz_fact(tables), 4))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert 0 < len(windows) <= 2 and all("windowspecdefinition(_part" in w for w in windows)
    assert not any("dense_rank" in w for w in windows)


def test_trip_key_reads_its_rows_once_and_joins_nothing_back(spark, tables):
    from tripmart import schemas
    from tripmart.operators.dense_rank import partition_ranks, with_dense_rank

    fact = _ntz_fact(tables)
    plan = _plan(partition_ranks(fact, schemas.TRIP_KEY_ORDER, 4))
    assert plan.count("Scan parquet") == _plan(fact).count("Scan parquet")
    assert "Join" not in plan
    whole = _plan(with_dense_rank(fact, schemas.TRIP_KEY_ORDER, num_partitions=4))
    assert "SortMergeJoin" not in whole and whole.count("BroadcastHashJoin") <= 2  # the offsets alone, tree and details


@pytest.mark.parametrize("name", ["q17_speed_by_borough", "q18_duration_percentiles_by_borough",
                                  "q19_top_zones_by_p90_duration"])
def test_percentiles_avoid_single_task_group_merge(tables, name):
    plan = _plan(Q.QUERIES[name](tables))
    assert "percentile(" not in plan.lower()


def test_percentiles_come_from_the_months_counts(tables):
    """The year's counts are read, of its months alone, and the fact is not; the reports are the same as from the fact."""
    from dataclasses import replace

    plan = _plan(Q._zone_counts(tables, "trip_time_minutes", ["borough"], F.lit(True)))
    assert "fct_trips_values" in plan and "/fct_trips/" not in plan and "PartitionFilters: [isnotnull(source_month" in plan
    from_fact = replace(tables, values=None)
    assert "/fct_trips/" in _plan(Q._zone_counts(from_fact, "trip_time_minutes", ["borough"], F.lit(True)))
    for name in ("q17_speed_by_borough", "q18_duration_percentiles_by_borough", "q19_top_zones_by_p90_duration"):
        kept, plain = Q.QUERIES[name](tables), Q.QUERIES[name](from_fact)
        assert kept.dtypes == plain.dtypes and kept.collect() == plain.collect() and plain.count() > 0


def test_sample_reads_the_key_column_first(tables):
    plan = _plan(Q.q22_fact_sample(tables))
    assert "LessThanOrEqual(trip_key" in plan and "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_udf_no_cartesian(tables, name):
    plan = _plan(Q.QUERIES[name](tables))
    for bad in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_gold_checks_plan_has_no_cartesian(tables):
    from tripmart.plans.checks import gold_checks

    plan = _plan(gold_checks(tables.gold))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
