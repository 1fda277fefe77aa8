"""Raw trips whose columns change type, bad files, and writers that meet."""

import datetime as dt
import itertools
import os
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.operators.widen import merge, widen
from tripmart.params import Params
from tripmart.plans import jobs
from tripmart.plans.ledger import Ledger
from tripmart.plans.raw import RawTrips
from tripmart.sources import files

D = dt.datetime
BIG = 9007199254740993  # the first whole number that a double does not hold
P = Params(grid_first_year=2024, grid_last_year=2024)


def landed(spark, root, month, extra=None, rows=2, service="yellow"):
    """A monthly file of ``rows`` trips with the columns ``extra`` (name -> column); its slice folder's file."""
    y, m = map(int, month.split("-"))
    data = [(1, D(y, m, 1, 8), D(y, m, 1, 8, 20), 1.0, 2.0, 1, 2, 1, 10.0, 1.0, 0.0, 11.0)] * rows
    schema = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
              "trip_distance double, PULocationID int, DOLocationID int, payment_type long, fare_amount double, "
              "tip_amount double, tolls_amount double, total_amount double")
    path = f"{root}/{service}_tripdata_{month}.parquet"
    spark.createDataFrame(data, schema).withColumns(extra or {}).coalesce(1).write.parquet(path)
    return path


def test_types_widen_as_a_lattice():
    types = [T.NullType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
             T.DecimalType(10, 2), T.DecimalType(5, 4), T.DecimalType(38, 0), T.DateType(), T.TimestampType(),
             T.TimestampNTZType(), T.StringType(), T.BooleanType(), T.ArrayType(T.IntegerType())]
    for a, b in itertools.product(types, types):
        assert widen(a, b) == widen(b, a), (a, b)
        common, _ = widen(a, b)
        assert widen(common, a)[0] == common and widen(common, b)[0] == common, (a, b)
    assert widen(T.IntegerType(), T.LongType()) == (T.LongType(), True)
    assert widen(T.LongType(), T.DecimalType(10, 2)) == (T.DecimalType(21, 2), True)
    assert widen(T.LongType(), T.DoubleType()) == (T.DoubleType(), False)
    assert widen(T.IntegerType(), T.DoubleType()) == (T.DoubleType(), True)
    assert widen(T.DecimalType(38, 0), T.DecimalType(38, 10)) == (T.DoubleType(), False)
    assert widen(T.BooleanType(), T.IntegerType()) == (T.StringType(), False)
    left = T.StructType([T.StructField("A", T.IntegerType())])
    right = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert [(f.name, f.dataType) for f in merge(left, right)[0]] == [("A", T.LongType()), ("b", T.StringType())]


def test_whole_numbers_stay_exact(spark, scratch):
    """INT one month, BIGINT the next, landed together: 64-bit numbers come back as they were."""
    lake = jobs.Lake(f"{scratch}/lake")
    paths = [landed(spark, scratch, "2024-01", {"code": F.lit(7), "price": F.lit(1.25).cast("decimal(5,2)")}),
             landed(spark, scratch, "2024-02", {"code": F.lit(BIG), "price": F.lit("123456789012.1234").cast("decimal(20,4)")})]
    jobs.ingest_trips(spark, lake, paths)
    raw = lake.raw(spark).read()
    assert dict(raw.dtypes)["code"] == "bigint" and dict(raw.dtypes)["price"] == "decimal(20,4)"
    assert {(r.source_month, r.code, r.price) for r in raw.collect()} == {
        ("2024-01", 7, Decimal("1.2500")), ("2024-02", BIG, Decimal("123456789012.1234"))}


def test_three_drifting_ingests(spark, scratch):
    """A column is BIGINT, then DOUBLE, then STRING; every ingest, the views and a repeated ingest work."""
    lake = jobs.Lake(f"{scratch}/lake")
    first = landed(spark, scratch, "2024-01", {"congestion_surcharge": F.lit(BIG), "flag": F.lit(True)})
    jobs.ingest_trips(spark, lake, [first])
    second = landed(spark, scratch, "2024-02", {"congestion_surcharge": F.lit(2.5), "Flag": F.lit("N")}, rows=3)
    jobs.ingest_trips(spark, lake, [second])
    names = lake.register(spark, P, "drift_")
    assert "drift_raw_trips" in names and "drift_bronze_trips" in names
    sums = spark.sql("SELECT source_month, max(congestion_surcharge) AS most, count(*) AS n FROM drift_raw_trips GROUP BY 1")
    assert {tuple(r) for r in sums.collect()} == {("2024-01", float(BIG), 2), ("2024-02", 2.5, 3)}
    third = landed(spark, scratch, "2024-03", {"congestion_surcharge": F.lit("free"), "late": F.lit(1)}, rows=1)
    jobs.ingest_trips(spark, lake, [third])
    raw = lake.raw(spark).read()
    assert raw.columns[:2] == ["VendorID", "lpep_pickup_datetime"] and raw.columns[-2:] == ["source_month", "service_type"]
    assert {(r.source_month, r.congestion_surcharge, r.flag, r.late) for r in raw.collect()} == {
        ("2024-01", str(BIG), "true", None), ("2024-02", "2.5", "N", None), ("2024-03", "free", None, 1)}
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 3  # a read for each way of storing, not for each slice
    # the stored value itself is exact, whatever the table's type
    stored = spark.read.parquet(f"{lake.raw_trips}/source_month=2024-01/service_type=yellow")
    assert {r.congestion_surcharge for r in stored.collect()} == {BIG}
    lake.register(spark, P, "drift_")
    assert spark.sql("SELECT count(*) FROM drift_raw_trips").first()[0] == 6
    jobs.ingest_trips(spark, lake, [landed(spark, f"{scratch}/again", "2024-03", {"congestion_surcharge": F.lit(1.0)}, rows=4)])
    raw = lake.raw(spark).read()
    assert raw.count() == 9 and dict(raw.dtypes)["congestion_surcharge"] == "double" and "late" not in raw.columns


def test_types_without_an_exact_common_one_are_stored_apart(spark, scratch):
    lake = jobs.Lake(f"{scratch}/lake")
    paths = [landed(spark, scratch, "2024-01", {"toll": F.lit(BIG)}), landed(spark, scratch, "2024-02", {"toll": F.lit(0.5)}),
             landed(spark, scratch, "2024-03", {"toll": F.lit(3)}), landed(spark, scratch, "2024-01", {"toll": F.lit("x")}, service="green")]
    jobs.ingest_trips(spark, lake, paths)
    kinds = {}
    for s, m in (("yellow", "2024-01"), ("yellow", "2024-02"), ("yellow", "2024-03"), ("green", "2024-01")):
        df = spark.read.parquet(f"{lake.raw_trips}/source_month={m}/service_type={s}")
        kinds[s, m] = dict(df.dtypes)["toll"]
    assert kinds["yellow", "2024-01"] == "bigint" and kinds["yellow", "2024-02"] == "double" and kinds["green", "2024-01"] == "string"
    assert lake.raw(spark).read().count() == 8
    whole = files.read_trip_files(spark, paths[:2])
    assert dict(whole.dtypes)["toll"] == "double" and whole.count() == 4


def test_a_crash_between_write_and_commit_can_be_read(spark, scratch, monkeypatch):
    """The slice's new files have other types than the commit before says; readers look into them."""
    lake = jobs.Lake(f"{scratch}/lake")
    jobs.ingest_trips(spark, lake, [landed(spark, scratch, "2024-01", {"x": F.lit(1)}), landed(spark, scratch, "2024-02", {"x": F.lit(1)})])
    real = RawTrips._commit
    monkeypatch.setattr(RawTrips, "_commit", lambda self, slices, schema, gone=(): (
        real(self, slices, schema, gone) if schema is None else (_ for _ in ()).throw(OSError("planted"))))
    with pytest.raises(OSError):
        jobs.ingest_trips(spark, lake, [landed(spark, f"{scratch}/new", "2024-02", {"x": F.lit("one")})])
    monkeypatch.undo()
    assert {(r.source_month, r.x) for r in lake.raw(spark).read().collect()} == {("2024-01", "1"), ("2024-02", "one")}
    assert RawTrips(spark, lake.raw_trips, f"{scratch}/no_log").read().count() == 4  # a table without commits
    assert RawTrips(spark, f"{scratch}/none", f"{scratch}/no_log2").read().count() == 0


# ------------------------------------------------------------------ bad files

def broken(path, kind):
    os.makedirs(path, exist_ok=True)
    name = next((f for f in os.listdir(path) if f.endswith(".parquet")), "part-0.parquet")
    if kind == "text":
        data = b"not a parquet file"
    elif kind == "footer":
        data = b"PAR1" + b"x" * 100 + b"PAR1"
    else:  # a page in the middle
        data = bytearray(open(f"{path}/{name}", "rb").read())
        data[4:60] = b"\xff" * 56
    with open(f"{path}/{name}", "wb") as f:
        f.write(bytes(data))
    for f in os.listdir(path):
        if f.endswith(".crc"):
            os.remove(f"{path}/{f}")


@pytest.mark.parametrize("kinds, runs", [(("text",), 2), (("text", "footer"), 2), (("page",), 2), (("footer", "page"), 3), ((), 1)])
def test_bad_files_cost_a_run_or_two(spark, scratch, monkeypatch, kinds, runs):
    landing, lake = f"{scratch}/landing", jobs.Lake(f"{scratch}/lake")
    months = [f"2024-{m:02d}" for m in range(1, 9)]
    paths = [landed(spark, landing, m) for m in months]
    landed(spark, landing, "2024-09", rows=0)  # no rows, but sound
    for path, kind in zip(paths[3:], kinds):
        broken(path, kind)
    calls = []
    real = jobs.ingest_trips
    monkeypatch.setattr(jobs, "ingest_trips", lambda *a, **k: (calls.append(len(a[2])), real(*a, **k))[1])
    jobs.backfill(spark, lake, landing, P)
    assert len(calls) == runs and calls[0] == 9 and calls[-1] == 9 - len(kinds)
    st = {r.year_month: r for r in Ledger(spark, lake.events).state().collect()}
    bad = months[3:3 + len(kinds)]
    assert {m for m, r in st.items() if r.status == "failed"} == set(bad)
    assert {m for m, r in st.items() if r.status == "completed"} == set(months + ["2024-09"]) - set(bad)
    assert all(st[m].error_message for m in bad) and all(r.retry_count == 0 for r in st.values())
    assert lake.raw(spark).read().count() == 2 * (8 - len(kinds))


def test_other_errors_are_raised(spark, scratch, monkeypatch):
    landing, lake = f"{scratch}/landing", jobs.Lake(f"{scratch}/lake")
    landed(spark, landing, "2024-01")
    monkeypatch.setattr(jobs, "bronze_trips", lambda df: (_ for _ in ()).throw(ValueError("not a Parquet file")))
    with pytest.raises(ValueError):  # told by its condition, not by words in its text
        jobs.backfill(spark, lake, landing, P)
    assert {r.status for r in Ledger(spark, lake.events).state().collect()} == {"failed"}


# ------------------------------------------------------------------ writers that meet

def test_two_backfills_ingest_each_slice_once(spark, scratch):
    landing, lake = f"{scratch}/landing", jobs.Lake(f"{scratch}/lake")
    for m in range(1, 5):
        landed(spark, landing, f"2024-{m:02d}", rows=m)
    errors = []

    def fill():
        try:
            jobs.backfill(spark, lake, landing, P)
        except Exception as e:
            errors.append(e)
    both = [threading.Thread(target=fill) for _ in range(2)]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert errors == []
    events = Ledger(spark, lake.events).events()
    done = events.where("event = 'completed'").groupBy("year_month").count().collect()
    assert {(r.year_month, r["count"]) for r in done} == {(f"2024-{m:02d}", 1) for m in range(1, 5)}
    assert lake.raw(spark).read().count() == 10


def test_leases(spark, scratch):
    log, hour = Ledger(spark, f"{scratch}/events"), dt.timedelta(hours=1)
    s = [("2024-01", "yellow"), ("2024-02", "yellow"), ("2024-03", "yellow"), ("2024-04", "yellow")]
    assert log.claim(s[:2], "a", hour, D(2024, 1, 1, 0, 0)) == s[:2]
    assert log.claim(s[:3], "b", hour, D(2024, 1, 1, 0, 30)) == s[2:3]       # a holds the first two
    assert log.claim(s[:2], "a", hour, D(2024, 1, 1, 0, 40)) == s[:2]        # a run may claim again what it holds
    log.append(s[:1], "completed", rows={s[0]: 5}, at=D(2024, 1, 1, 0, 45), run="a")
    log.append(s[1:2], "failed", error="x", at=D(2024, 1, 1, 0, 45), run="a")
    assert log.claim(s, "c", hour, D(2024, 1, 1, 0, 50)) == [s[1], s[3]]     # failed, and never started
    assert log.claim(s, "d", hour, D(2024, 1, 1, 3)) == s[1:]                # all leases have run out
    assert log.claim(s[:1], "e", hour, D(2030, 1, 1)) == []                  # completed for good


def test_appends_and_compactions_at_once_lose_nothing(spark, scratch, monkeypatch):
    log = Ledger(spark, f"{scratch}/events")
    log.append([("2024-01", "yellow")], "started", at=D(2024, 1, 1))
    # an append between a compaction's reading and its commit
    real = log.gathered.create
    monkeypatch.setattr(log.gathered, "create", lambda n, text: (
        log.append([("2024-02", "green")], "started", at=D(2024, 1, 2)), real(n, text))[1])
    assert log.compact() == 2
    monkeypatch.undo()
    assert {r.year_month for r in log.events().collect()} == {"2024-01", "2024-02"}

    def add(k):
        mine = Ledger(spark, f"{scratch}/events")
        for m in range(1, 7):
            mine.append([(f"{2030 + k}-{m:02d}", "yellow")], ["started", "processing"])
            if m == 3 + k:
                mine.compact()
    writers = [threading.Thread(target=add, args=(k,)) for k in range(3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert log.events().count() == 2 + 3 * 12 and log.state().count() == 2 + 18
    assert log.compact() == 38 and Ledger(spark, f"{scratch}/events").events().count() == 38
    assert set(f.name for f in schemas.CHECKPOINT_EVENTS) == set(log.events().columns)
