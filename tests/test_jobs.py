"""Sources, sinks, ledger and batch jobs on temporary folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.params import TESTDATA
from tripmart.plans import jobs, layout, ledger, publish
from tripmart.plans.ledger import Ledger
from tripmart.sources import generators, testdata
from tripmart.sources.files import read_trip_files, read_zone_csv

from conftest import SF001

D = dt.datetime


def _yellow_file(spark, path, pc_type="double", rows=2, month=(2024, 1)):
    y, m = month
    pc = 1 if pc_type == "bigint" else 1.0
    data = [(1, D(y, m, 1, 8), D(y, m, 1, 8, 20), pc, 2.0, 1, 2, 1, 10.0, 1.0, 0.0, 11.0, 0.0)] * rows
    schema = (f"VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
              f"passenger_count {pc_type}, trip_distance double, PULocationID int, DOLocationID int, "
              f"payment_type long, fare_amount double, tip_amount double, tolls_amount double, "
              f"total_amount double, Airport_fee double")
    df = spark.createDataFrame(data, schema)
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]


def test_type_drift_read_per_footer_group(spark, scratch):
    from tripmart.sources.files import schema_groups

    a = _yellow_file(spark, f"{scratch}/yellow_tripdata_2024-01.parquet", "bigint", month=(2024, 1))
    b = _yellow_file(spark, f"{scratch}/yellow_tripdata_2024-02.parquet", "double", 3, month=(2024, 2))
    assert len(schema_groups(spark, "yellow", a + b)) == 2
    out = read_trip_files(spark, a + b)
    rows = out.groupBy("source_month", "service_type").count().collect()
    assert {(r.source_month, r.service_type, r["count"]) for r in rows} == {
        ("2024-01", "yellow", 2), ("2024-02", "yellow", 3)}
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.LANDING]
    assert out.where("trip_type IS NOT NULL").count() == 0


def test_slice_overwrite_is_idempotent(spark, scratch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([("2024-01", "yellow", 1), ("2024-01", "green", 2), ("2024-02", "yellow", 3)],
                               "source_month string, service_type string, v int")
    layout.write_slices(df, path)
    layout.write_slices(df.where("source_month = '2024-01' AND service_type = 'yellow'"), path)
    once = sorted(tuple(r) for r in spark.read.parquet(path).select("source_month", "service_type", "v").collect())
    layout.write_slices(df.where("source_month = '2024-01' AND service_type = 'yellow'"), path)
    twice = sorted(tuple(r) for r in spark.read.parquet(path).select("source_month", "service_type", "v").collect())
    assert once == twice == sorted([("2024-01", "yellow", 1), ("2024-01", "green", 2), ("2024-02", "yellow", 3)])
    layout.drop_slices(spark, path, [("2024-02", "yellow")])
    assert spark.read.parquet(path).count() == 2
    sub = layout.read_slices(spark, path, slices=[("2024-01", "green")])
    assert [r.v for r in sub.collect()] == [2]


def test_clustered_slices_skip_row_groups(spark, scratch):
    """A slice of 1996 holds trips of 1995 and 1997 here and there; files in pickup order keep them to few row groups."""
    import glob

    import pyarrow.parquet as pq

    day = F.expr("timestampadd(MINUTE, CAST(rand(3) * 43000 AS INT), timestamp_ntz'1996-05-01 00:00:00')")
    leak = F.when(F.col("id") % 97 == 0, F.lit(-12)).when(F.col("id") % 89 == 0, F.lit(12)).otherwise(F.lit(0))
    df = spark.range(40_000, numPartitions=1).select(
        F.expr("id").alias("trip"), (day + F.make_ym_interval(F.lit(0), leak)).alias("pickup_ts"),
        F.lit("1996-05").alias("source_month"), F.lit("yellow").alias("service_type"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(16 * 1024))
    try:
        layout.write_slices(df, f"{scratch}/plain")
        layout.write_slices(df, f"{scratch}/clustered", cluster="pickup_ts")
    finally:
        conf.unset("parquet.block.size")

    def groups(path):
        """Row groups in all, and those whose statistics reach into 1995."""
        total = reached = 0
        for f in glob.glob(f"{path}/*/*/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            at = meta.schema.names.index("pickup_ts")
            for k in range(meta.num_row_groups):
                total += 1
                reached += meta.row_group(k).column(at).statistics.min < D(1996, 1, 1)
        return total, reached

    total, reached = groups(f"{scratch}/plain")
    assert total > 5 and reached == total          # a leaked trip in every row group
    total, reached = groups(f"{scratch}/clustered")
    assert total > 5 and reached <= 1 + total // 20
    year = spark.read.parquet(f"{scratch}/clustered").where("pickup_ts < timestamp_ntz'1996-01-01 00:00:00'")
    assert year.count() == df.where("trip % 97 = 0").count()


def test_ledger_state_machine(spark, scratch):
    lg = Ledger(spark, f"{scratch}/events")
    s1, s2 = ("2024-01", "yellow"), ("2024-02", "green")
    lg.append([s1, s2], "started", at=D(2024, 1, 1, 0, 0))
    lg.append([s1, s2], "processing", at=D(2024, 1, 1, 0, 1))
    lg.append([s1], "failed", error="boom" * 100, at=D(2024, 1, 1, 0, 2))
    lg.append([s2], "completed", rows={s2: 42}, at=D(2024, 1, 1, 0, 2))
    lg.append([s1], "started", at=D(2024, 1, 2))
    lg.append([s1], "failed", error="again", at=D(2024, 1, 2, 0, 1))
    st = {(r.year_month, r.service_type): r for r in lg.state().collect()}
    assert st[s1].status == "failed" and st[s1].retry_count == 1 and st[s1].error_message == "again"
    assert st[s2].status == "completed" and st[s2].rows_ingested == 42 and st[s2].error_message is None
    long = "boom" * 100
    first = lg.events().where("event = 'failed'").orderBy("event_ts").first()
    assert first.error_message == long  # kept whole
    grid = generators.slice_grid(spark, 2024, 2024, ["yellow", "green"])
    pend = {(r.year_month, r.service_type) for r in ledger.pending(grid, lg.state()).collect()}
    assert len(pend) == 23 and s1 in pend and s2 not in pend
    cov = {(r.year_month, r.service_type): r.status for r in ledger.coverage(grid, lg.state()).collect()}
    assert cov[s2] == "completed" and cov[s1] == "failed" and cov[("2024-03", "green")] == "pending"
    before = sorted(tuple(r) for r in lg.state().collect())
    assert lg.compact() == 8
    assert sorted(tuple(r) for r in lg.state().collect()) == before
    # a compaction that was cut short leaves a folder that no commit names: the log is as it was
    os.makedirs(f"{scratch}/events/_gathered/events-0")
    assert sorted(tuple(r) for r in lg.state().collect()) == before
    lg.append([s1], "started", at=D(2024, 1, 3))
    lg.append([s1], "aborted", at=D(2024, 1, 3, 1))
    assert lg.compact() == 10
    again = {(r.year_month, r.service_type): r for r in lg.state().collect()}[s1]
    assert again.retry_count == 1 and again.status == "aborted"  # an aborted attempt is no retry


def test_zone_csv_na_tokens(spark, scratch):
    path = f"{scratch}/zones.csv"
    with open(path, "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n"
                "264,Unknown,NV,N/A\n265,,Outside of NYC,NA\n")
    z = {r.LocationID: r for r in read_zone_csv(spark, path).collect()}
    assert z[264].Borough == "Unknown" and z[264].service_zone is None
    assert z[265].Borough is None and z[265].service_zone is None and z[1].Zone == "Newark Airport"


def test_export_csv_and_materialise(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    layout.export_csv(df, f"{scratch}/out_csv")
    back = spark.read.option("header", True).csv(f"{scratch}/out_csv")
    assert back.columns == ["id", "v"] and back.count() == 2
    view = layout.materialise(df, "tm_view_test", "view")
    assert spark.table("tm_view_test").count() == 2 and view is df
    table = layout.materialise(df, "tm_table_test", "table", f"{scratch}/tbl")
    assert table.count() == 2


def test_ingest_backfill_and_gold_build(spark, scratch):
    """Whole flow over the sf0.01 tables with run_all, then a second backfill
    (nothing pending that has data) and a re-ingest of one slice."""
    landing, lake = f"{scratch}/landing", jobs.Lake(f"{scratch}/lake")
    testdata.stage_landing_files(spark, SF001, landing)
    res = jobs.run_all(spark, lake, landing, TESTDATA, zones=testdata.zone_lookup(spark, SF001))
    n_raw = spark.read.parquet(lake.raw_trips).count()
    assert n_raw == testdata.landing_trips(spark, SF001).count()
    st = Ledger(spark, lake.events).state()
    assert st.count() == 166 and st.where("status <> 'completed'").count() == 0
    assert st.agg(F.sum("rows_ingested")).first()[0] == n_raw

    events_before = Ledger(spark, lake.events).events().count()
    assert jobs.backfill(spark, lake, landing, TESTDATA).count() == 50  # grid slices without data
    assert Ledger(spark, lake.events).events().count() == events_before  # nothing re-ingested

    # Re-ingesting one slice replaces it (no duplicates).
    one = [f for f in jobs.landing_files(spark, landing) if "source_month=1996-03" in f]
    jobs.ingest_trips(spark, lake, one)
    assert spark.read.parquet(lake.raw_trips).count() == n_raw

    checks = {(r.table_name, r.column_name, r.test_name): r.violations for r in res["gold"].collect()}
    assert len(checks) == 50
    # Ship dates run past the calendar's end, so dropoff keys have orphans.
    assert checks[("fct_trips", "dropoff_date_key", "relationships")] > 0
    fact = jobs.load_gold(spark, lake, TESTDATA).fact
    assert checks[("fct_trips", "pickup_date_key", "relationships")] == fact.where(
        "pickup_date_key > 20001231").count()
    assert checks[("fct_trips", "trip_key", "not_null")] == 0
    assert set(fact.columns) == set(schemas.FACT_COLUMNS)
    assert {r.test_name for r in res["silver"].collect()} == {"not_null", "relationships", "accepted_values"}

    # Hash key: a full build, then an incremental rebuild of one month gives
    # the same table; other months are untouched.
    n_fact = fact.count()

    def snapshot():
        df = jobs.load_gold(spark, lake, TESTDATA).fact.drop("ingest_ts")
        return sorted(tuple(r) for r in df.collect())
    jobs.build_gold_tables(spark, lake, TESTDATA, trip_key="hash").collect()
    full = snapshot()
    jobs.build_gold_tables(spark, lake, TESTDATA, trip_key="hash", months=["1996-03"]).collect()
    assert snapshot() == full and len(full) == n_fact
    with pytest.raises(ValueError):  # the published fact has hash keys
        jobs.build_gold_tables(spark, lake, TESTDATA, months=["1996-03"])

    # Command line over the same lake.
    from tripmart.__main__ import main

    assert main(["status", "--lake", lake.root]) == 0
    out = f"{scratch}/q01_csv"
    assert main(["query", "q01_trips_per_month", "--lake", lake.root, "--year", "1996",
                 "--calendar-start", "1995-01-01", "--calendar-end", "2000-12-31", "--out", out]) == 0
    assert spark.read.option("header", True).csv(out).count() == 12


def test_generic_csv_and_partitioned_calendar(spark, scratch):
    from tripmart.sources.files import read_csv

    path = f"{scratch}/people.csv"
    with open(path, "w") as f:
        f.write("Age,Fare,Name\n22,7.25,a\n,71.28,b\n")
    df = read_csv(spark, path)
    assert dict(df.dtypes) == {"Age": "int", "Fare": "double", "Name": "string"}
    typed = read_csv(spark, path, "Age double, Fare double, Name string")
    assert typed.where("Age IS NULL").count() == 1
    from tripmart.plans.gold import dim_date
    from tripmart.params import Params
    d = dim_date(spark, Params()).df
    layout.write_list_partitioned(d, f"{scratch}/dim_date", "year_month")
    back = spark.read.parquet(f"{scratch}/dim_date")
    assert back.count() == 1461 and back.select("year_month").distinct().count() == 48


def test_added_column_merges_into_one_read(spark, scratch):
    from tripmart.sources.files import schema_groups

    a = _yellow_file(spark, f"{scratch}/yellow_tripdata_2024-01.parquet", month=(2024, 1))
    b_path = f"{scratch}/yellow_tripdata_2024-02.parquet"
    (spark.read.parquet(*a).withColumn("congestion_surcharge", F.lit(2.5))
     .coalesce(1).write.mode("overwrite").parquet(b_path))
    b = [os.path.join(b_path, f) for f in os.listdir(b_path) if f.endswith(".parquet")]
    groups = schema_groups(spark, "yellow", a + b)
    assert len(groups) == 1 and groups[0][0] == a + b and "congestion_surcharge" in groups[0][1].names
    out = read_trip_files(spark, a + b)
    assert out.count() == 4 and set(r.source_month for r in out.collect()) == {"2024-01", "2024-02"}
    assert {r.source_month: r.congestion_surcharge for r in out.collect()} == {"2024-01": None, "2024-02": 2.5}


def test_raw_keeps_every_source_column(spark, scratch):
    """Columns outside the declared layout are landed too; a type that changes between files finds a common one."""
    lake = jobs.Lake(f"{scratch}/lake")
    plain = _yellow_file(spark, f"{scratch}/plain", month=(2024, 1))
    extra = spark.read.parquet(*plain).withColumns({
        "extra": F.lit(1.5), "mta_tax": F.lit(0.5), "congestion_surcharge": F.lit(2.5),
        "store_and_fwd_flag": F.lit("N"), "improvement_surcharge": F.lit(float("nan"))})
    files = []
    for month, df in (("2024-01", extra), ("2024-02", extra.withColumn("mta_tax", F.lit(1)))):
        path = f"{scratch}/yellow_tripdata_{month}.parquet"
        df.coalesce(1).write.parquet(path)
        files += [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    jobs.ingest_trips(spark, lake, files)
    raw = spark.read.option("mergeSchema", "true").parquet(lake.raw_trips)
    assert {f.name for f in schemas.LANDING} < set(raw.columns)
    found = {(r.source_month, r.extra, r.mta_tax, r.congestion_surcharge, r.store_and_fwd_flag, r.improvement_surcharge)
             for r in raw.collect()}
    assert found == {("2024-01", 1.5, 0.5, 2.5, "N", None), ("2024-02", 1.5, 1.0, 2.5, "N", None)}
    assert "extra" not in spark.read.parquet(lake.bronze_trips).columns


def test_backfill_falls_back_per_slice(spark, scratch):
    from tripmart.params import Params

    landing, lake = f"{scratch}/landing", jobs.Lake(f"{scratch}/lake")
    _yellow_file(spark, f"{landing}/yellow_tripdata_2024-01.parquet", month=(2024, 1))
    _yellow_file(spark, f"{landing}/yellow_tripdata_2024-02.parquet", month=(2024, 2))
    os.makedirs(f"{landing}/yellow_tripdata_2024-03.parquet")
    with open(f"{landing}/yellow_tripdata_2024-03.parquet/part-0.parquet", "wb") as f:
        f.write(b"not a parquet file")
    p = Params(grid_first_year=2024, grid_last_year=2024)
    jobs.backfill(spark, lake, landing, p)
    st = {(r.year_month, r.service_type): r for r in Ledger(spark, lake.events).state().collect()}
    assert st[("2024-01", "yellow")].status == "completed"
    assert st[("2024-02", "yellow")].status == "completed"
    assert st[("2024-03", "yellow")].status == "failed" and st[("2024-03", "yellow")].error_message
    assert spark.read.parquet(lake.raw_trips).count() == 4
    assert all(r.retry_count == 0 for r in st.values())  # the aborted common run is not theirs


def test_ingest_one_service_and_month(spark, scratch):
    landing, lake = f"{scratch}/landing", jobs.Lake(f"{scratch}/lake")
    for m in (1, 2):
        _yellow_file(spark, f"{landing}/yellow_tripdata_2024-0{m}.parquet", rows=m, month=(2024, m))
    assert jobs.ingest_slice(spark, lake, landing, "yellow", "2024-02") == {("2024-02", "yellow"): 2}
    with pytest.raises(FileNotFoundError):
        jobs.ingest_slice(spark, lake, landing, "green", "2024-02")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A lake built once, for the tests that look at it or build its gold tables again."""
    root = str(tmp_path_factory.mktemp("built"))
    testdata.stage_landing_files(spark, SF001, f"{root}/landing")
    lake = jobs.Lake(f"{root}/lake")
    jobs.run_all(spark, lake, f"{root}/landing", TESTDATA, zones=testdata.zone_lookup(spark, SF001))
    return lake


def test_violations_hold_back_gold(spark, built):
    """A planted dimension or fact violation leaves the published tables as they were, and shows in the exit code."""
    from dataclasses import replace

    from tripmart.__main__ import main
    from tripmart.plans.checks import Blocked

    lake, zones = built, testdata.zone_lookup(spark, SF001)
    before = jobs.load_gold(spark, lake, TESTDATA).fact.count()
    strict = replace(TESTDATA, tolerated=())
    with pytest.raises(Blocked) as blocked:  # dropoff dates run past the calendar
        jobs.build_gold_tables(spark, lake, strict)
    assert any(r.violations and r.column_name == "dropoff_date_key" for r in blocked.value.results)
    cli = ["--lake", lake.root, "--year", "1996", "--calendar-start", "1995-01-01"]
    assert main(["build-gold", *cli, "--calendar-end", "2000-12-31"]) == 1
    assert main(["build-gold", *cli, "--calendar-end", "2003-12-31"]) == 0
    jobs.ingest_zones(spark, lake, zones=zones.union(zones.where("LocationID = 3")))  # a zone key twice
    with pytest.raises(Blocked) as blocked:
        jobs.build_gold_tables(spark, lake, TESTDATA)
    assert {r.table_name for r in blocked.value.results if r.violations} == {"dim_zones"}
    assert not any(r.table_name == "fct_trips" for r in blocked.value.results)  # the fact was not built
    assert jobs.load_gold(spark, lake, TESTDATA).fact.count() == before
    versions = publish.log(spark, lake.p("gold")).numbers()
    assert len(os.listdir(f"{lake.root}/gold/fct_trips")) == len(versions)  # what was not published is gone
    jobs.ingest_zones(spark, lake, zones=zones)


def test_sql_over_the_lake(spark, built):
    """Q1, Q6 and Q17 as SQL text over the registered views equal the DataFrame queries."""
    from tripmart.plans import queries as Q

    lake = built
    names = lake.register(spark, TESTDATA, "lake_")
    assert {"lake_raw_trips", "lake_bronze_trips", "lake_fct_trips", "lake_dim_date", "lake_dim_zones",
            "lake_ingestion_ledger", "lake_int_taxi_trips_zones_joined"} <= set(names)
    t = jobs.load_tables(spark, lake, TESTDATA)

    def same(sql, df, cols):
        rows = lambda x: sorted(tuple(str(v) for v in r) for r in x.select(*cols).collect())
        assert rows(spark.sql(sql)) == rows(df)

    same("SELECT d.year_month, count(*) AS trip_count FROM lake_fct_trips f JOIN lake_dim_date d "
         "ON f.pickup_date_key = d.date_key WHERE d.year = 1996 GROUP BY d.year_month",
         Q.q01_trips_per_month(t), ["year_month", "trip_count"])
    same("SELECT z.borough, count(*) AS trip_count, CAST(min(speed_mph) AS DECIMAL(18,2)) AS min_speed_mph "
         "FROM lake_fct_trips f JOIN lake_dim_zones z ON f.pu_zone_key = z.zone_key WHERE year(pickup_date) = 1996 "
         "AND speed_mph <= 100 AND trip_time_minutes > 0 GROUP BY z.borough HAVING count(*) >= 10",
         Q.q17_speed_by_borough(t), ["borough", "trip_count", "min_speed_mph"])
    same("""WITH s AS (SELECT date_format(pickup_ts, 'EEEE') AS day_name, hour(pickup_ts) AS peak_hour, count(*) AS trip_count
            FROM lake_bronze_trips WHERE year(pickup_ts) = 1996 AND dropoff_ts >= pickup_ts AND passenger_count >= 0
            AND trip_distance >= 0 AND total_amount >= 0 AND fare_amount >= 0 GROUP BY ALL)
            SELECT * FROM (SELECT *, rank() OVER (PARTITION BY day_name ORDER BY trip_count DESC) AS r FROM s) WHERE r <= 5""",
         Q.q06_peak_hours(t), ["day_name", "peak_hour", "trip_count"])
    # the time-of-day variant rebuilds its timestamps from bronze
    lazy = Q.q17b_speed_by_borough_time_block(t)
    assert lazy.count() > 0 and lazy.columns[:2] == ["borough", "time_block"]
