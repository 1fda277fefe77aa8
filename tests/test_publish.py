"""Published versions of the star: all or nothing, and months ranked on their own."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tripmart.params import TESTDATA
from tripmart.plans import jobs, layout, publish
from tripmart.plans.commits import CommitLog
from tripmart.sources import testdata

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.drop("ingest_ts").collect()))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("publish"))
    testdata.stage_landing_files(spark, SF, f"{root}/landing")
    lake = jobs.Lake(f"{root}/lake")
    jobs.run_all(spark, lake, f"{root}/landing", TESTDATA, zones=testdata.zone_lookup(spark, SF))
    return lake


def test_commits_are_written_once(spark, scratch):
    log = CommitLog(spark, f"{scratch}/log")
    assert log.latest() == (0, None) and log.numbers() == []
    assert log.create(1, '{"n": 1}') and not log.create(1, '{"n": 9}')
    assert log.latest() == (1, {"n": 1})
    assert log.update(lambda last: None) == (1, {"n": 1})

    def add():
        for _ in range(8):
            log.update(lambda last: {"n": last["n"] + 1})
    writers = [threading.Thread(target=add) for _ in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert log.latest() == (33, {"n": 33}) and log.numbers() == list(range(1, 34))
    assert all(f.endswith(".json") or f.startswith(".") for f in os.listdir(f"{scratch}/log"))  # no temporary files


STEPS = [(layout, "write_list_partitioned", 3, False), (layout, "write_hash_clustered", 1, True), (jobs, "gold_checks", 1, False),
         (layout, "write_fact", 1, False), (jobs, "gold_checks", 2, True), (publish, "write_runs", 1, True),
         (publish, "publish", 1, False), (CommitLog, "_place", 1, False)]


@pytest.mark.parametrize("where, name, call, after", STEPS)
def test_a_crash_at_any_step_leaves_the_star_as_it_was(spark, lake, monkeypatch, where, name, call, after):
    """A step fails before or after its work; the version before is read as before, whole."""
    root = lake.p("gold")
    before = publish.current(spark, root)
    real, calls = getattr(where, name), []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) != call:
            return real(*args, **kwargs)
        if after:
            real(*args, **kwargs)
        raise OSError("planted")

    monkeypatch.setattr(where, name, failing)
    with pytest.raises(OSError, match="planted"):
        jobs.build_gold_tables(spark, lake, TESTDATA)
    monkeypatch.undo()
    assert publish.current(spark, root) == before
    star = jobs.load_gold(spark, lake, TESTDATA)
    assert star.fact.count() > 0 and all(d.df.count() > 0 for d in star.dims().values())


def test_a_killed_build_leaves_only_unnamed_folders(spark, lake, monkeypatch):
    """Without even the cleaning up, as when the driver dies; vacuum removes what is left."""
    root = lake.p("gold")
    before, star = publish.current(spark, root), rows(jobs.load_gold(spark, lake, TESTDATA).fact)
    monkeypatch.setattr(layout, "remove_table", lambda *a: None)
    monkeypatch.setattr(publish, "publish", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        jobs.build_gold_tables(spark, lake, TESTDATA)
    monkeypatch.undo()
    assert publish.current(spark, root) == before and rows(jobs.load_gold(spark, lake, TESTDATA).fact) == star
    assert len(publish.vacuum(spark, root, keep=1)) >= 8
    assert publish.vacuum(spark, root, keep=1) == []
    assert rows(jobs.load_gold(spark, lake, TESTDATA).fact) == star


def test_readers_keep_the_version_they_resolved(spark, lake):
    old = jobs.load_gold(spark, lake, TESTDATA)
    count = old.fact.count()
    jobs.build_gold_tables(spark, lake, TESTDATA)
    assert old.fact.count() == count and all(d.df.count() for d in old.dims().values())


def test_months_ranked_alone_equal_the_full_rebuild(spark, lake):
    """A month loses half its trips and gains others; ranking it alone gives the keys of a rebuild of everything."""
    month, root = "1996-05", lake.p("gold")
    jobs.build_gold_tables(spark, lake, TESTDATA)
    raw = layout.read_slices(spark, lake.bronze_trips, slices=[(month, "yellow")]).drop("source_month", "service_type")
    changed = raw.where("pickup_location_id % 2 = 0").union(
        raw.withColumns({"VendorID": F.lit(1), "total_amount": (F.col("total_amount") + 1).cast("decimal(15,2)")}))
    full = jobs.load_gold(spark, lake, TESTDATA).fact.count()
    changed = spark.createDataFrame(changed.collect(), changed.schema)
    changed.write.mode("overwrite").parquet(layout.slice_path(lake.bronze_trips, (month, "yellow")))
    spark.catalog.refreshByPath(lake.bronze_trips)

    jobs.build_gold_tables(spark, lake, TESTDATA, months=[month])
    version = publish.current(spark, root)
    assert not version.whole and version.months[month] != version.months["1996-06"]
    alone = jobs.load_gold(spark, lake, TESTDATA).fact
    assert publish.read_runs(spark, root, version).where("move <> 0").count() > 1  # later months have moved
    got, values = rows(alone), rows(jobs.load_tables(spark, lake, TESTDATA).values)
    scan = alone.select("total_amount")._jdf.queryExecution().optimizedPlan().toString()
    assert "map" not in scan.lower().replace("mapin", "")  # queries without the key do not look anything up
    publish_limit, publish.LITERAL_RUNS = publish.LITERAL_RUNS, 0
    joined = rows(jobs.load_gold(spark, lake, TESTDATA).fact)
    publish.LITERAL_RUNS = publish_limit

    jobs.build_gold_tables(spark, lake, TESTDATA, months=[month, "1996-07"])  # again, over a version of two builds
    again = rows(jobs.load_gold(spark, lake, TESTDATA).fact)
    jobs.build_gold_tables(spark, lake, TESTDATA)
    want = jobs.load_gold(spark, lake, TESTDATA).fact
    assert publish.current(spark, root).whole and want.count() != full
    assert got == joined == again == rows(want)
    assert values == rows(jobs.load_tables(spark, lake, TESTDATA).values)  # the month's counts are refreshed with it


def test_an_emptied_month_goes(spark, lake):
    months = publish.current(spark, lake.p("gold")).months
    last = max(months)
    bronze = spark.read.parquet(lake.bronze_trips)
    assert bronze.where(F.col("source_month") == last).count() > 0
    for service in ("yellow", "green"):
        layout.drop_slices(spark, lake.bronze_trips, [(last, service)])
    spark.catalog.refreshByPath(lake.bronze_trips)
    jobs.build_gold_tables(spark, lake, TESTDATA, months=[last])
    assert set(publish.current(spark, lake.p("gold")).months) == set(months) - {last}
    alone = rows(jobs.load_gold(spark, lake, TESTDATA).fact)
    jobs.build_gold_tables(spark, lake, TESTDATA)
    assert alone == rows(jobs.load_gold(spark, lake, TESTDATA).fact)


def test_only_the_month_of_bronze_is_read(spark, lake, monkeypatch):
    plans = []
    real = layout.write_fact
    monkeypatch.setattr(layout, "write_fact", lambda fact, path: (plans.append(fact), real(fact, path))[1])
    seen = []
    monkeypatch.setattr(jobs, "with_trip_key", lambda fact: (seen.append(fact._jdf.queryExecution().executedPlan().toString()),
                                                              publish_key(fact))[1])
    from tripmart.plans.gold import with_trip_key as publish_key
    jobs.build_gold_tables(spark, lake, TESTDATA, months=["1996-05"])
    assert "source_month" in seen[0] and "PartitionFilters: [" in seen[0] and "1996-05" in seen[0].split("PartitionFilters")[1].split("]")[0]
