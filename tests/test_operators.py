"""Unit tests of operators and layers on hand-made frames with edge rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.functions.columns import percent_of, to_int
from tripmart.operators.dense_rank import with_dense_rank
from tripmart.operators.harmonise import conform, harmonise
from tripmart.operators.impute import fill_upper_median, upper_medians
from tripmart.operators.joins import Dim
from tripmart.operators.quality import accepted, fk, not_null, run_tests, unique
from tripmart.params import Params
from tripmart.plans import expectations as X
from tripmart.plans.bronze import bronze_trips
from tripmart.plans.gold import build_gold, dim_date, with_trip_key
from tripmart.sources import generators

D = dt.datetime


def test_int_cast_rounds_half_even(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (3.5,), (1.7,), (-2.5,), (None,)], "x double")
    got = [r.y for r in df.select(to_int("x", T.DoubleType()).alias("y")).collect()]
    assert got == [2, 2, 4, 2, -2, None]


def test_percent_of_is_exact_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3)], "a long, b long")
    got = [r.p for r in df.select(percent_of("a", "b").alias("p")).collect()]
    assert got == [Decimal("12.50"), Decimal("33.33"), Decimal("66.67")]


def test_harmonise_yellow(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 1, 1, 0, 10), 1.0)],
                               "VendorID int, tpep_pickup_datetime timestamp_ntz, "
                               "tpep_dropoff_datetime timestamp_ntz, Airport_fee double")
    out = harmonise(df, "yellow")
    assert "lpep_pickup_datetime" in out.columns and "tpep_pickup_datetime" not in out.columns
    assert "Airport_fee" not in out.columns and "airport_fee" not in out.columns
    assert out.select("trip_type", "ehail_fee").first() == (None, None)
    lower = spark.createDataFrame([(1, 2.0)], "VendorID int, airport_fee double")
    assert harmonise(lower, "yellow").columns == ["VendorID", "trip_type", "ehail_fee"]
    green = spark.createDataFrame([(1, 2.0)], "VendorID int, ehail_fee double")
    assert harmonise(green, "green").columns == ["VendorID", "ehail_fee"]


def _landing(spark, rows):
    """rows: dicts over a subset of landing columns."""
    full = []
    for r in rows:
        base = {f.name: None for f in schemas.LANDING.fields}
        base.update({"VendorID": 1, "lpep_pickup_datetime": D(2024, 3, 1, 8, 0),
                     "lpep_dropoff_datetime": D(2024, 3, 1, 8, 30), "passenger_count": 1.0,
                     "trip_distance": 3.0, "PULocationID": 1, "DOLocationID": 2, "payment_type": 1,
                     "fare_amount": 10.0, "tip_amount": 2.0, "tolls_amount": 0.0, "total_amount": 12.0,
                     "ingest_ts": D(2024, 4, 1), "source_month": "2024-03", "service_type": "yellow"})
        base.update(r)
        full.append(tuple(base[f.name] for f in schemas.LANDING.fields))
    return spark.createDataFrame(full, schemas.LANDING)


def test_bronze_overflow_guard_drops_null_and_large(spark):
    df = _landing(spark, [
        {"fare_amount": 99999999.99},
        {"fare_amount": 100000000.00},
        {"tolls_amount": None},
        {"total_amount": 1e30},
        {},
    ])
    b = bronze_trips(df)
    assert b.count() == 2
    assert b.schema["fare_amount"].dataType == T.DecimalType(15, 2)
    assert b.schema["trip_distance"].dataType == T.DecimalType(10, 2)
    assert sorted(r.fare_amount for r in b.collect()) == [Decimal("10.00"), Decimal("99999999.99")]


def _zones(spark):
    z = spark.createDataFrame([(1, "Manhattan", "A", "Yellow Zone"), (2, None, "B", None),
                               (3, "Queens", None, "Airports")],
                              "location_id int, borough string, zone_name string, service_zone string")
    return Dim(z, 3)


def _gold(spark, rows, **pkw):
    p = Params(year=2024, **pkw)
    return build_gold(spark, bronze_trips(_landing(spark, rows)), _zones(spark), p)


def test_fact_filters_and_defaults(spark):
    rows = [
        {},                                                                   # kept
        {"lpep_dropoff_datetime": D(2024, 3, 1, 7, 0)},                       # dropoff before pickup
        {"lpep_dropoff_datetime": D(2024, 3, 1, 8, 0)},                       # zero minutes
        {"source_month": "2024-02"},                                          # month mismatch
        {"DOLocationID": 99},                                                 # no zone
        {"VendorID": None, "payment_type": None, "passenger_count": None},    # defaults
        {"VendorID": 3, "payment_type": 9},                                   # unknown keys
        {"fare_amount": 0.0, "tip_amount": 2.0, "total_amount": 2.0},         # tip ratio 0
        {"trip_distance": 0.0},                                               # distance > 0
        {"total_amount": 0.0},                                                # total > 0
        {"passenger_count": 2.5, "VendorID": 2},                              # half-even
    ]
    fact = _gold(spark, rows).fact
    got = {(r.vendor_id, r.payment_type_id, str(r.fare_amount), r.passenger_count): r
           for r in fact.collect()}
    assert len(got) == 5
    d = got[(99, 5, "10.00", 0)]
    assert (d.vendor_key, d.payment_type_key) == (5, 5)
    u = got[(3, 9, "10.00", 1)]
    assert (u.vendor_key, u.payment_type_key) == (5, 5)
    z = got[(1, 1, "0.00", 1)]
    assert z.tip_percentage == Decimal("0.0000")
    k = got[(1, 1, "10.00", 1)]
    assert k.tip_percentage == Decimal("0.2000") and k.speed_mph == Decimal("6.00")
    assert k.trip_time_minutes == Decimal("30.00") and k.pickup_date_key == 20240301
    assert k.service_type_key == 1 and k.pu_zone_key == 1 and k.do_zone_key == 2
    assert got[(2, 1, "10.00", 2)].passenger_count == 2


def test_zone_defaults(spark):
    g = _gold(spark, [{}])
    z = {r.zone_key: r for r in g.dim_zones.df.collect()}
    assert z[2].borough == "Unknown Borough" and z[2].service_zone == "Unknown"
    assert z[3].zone_name == "Unknown Zone"


def test_calendar_dimension(spark):
    d = dim_date(spark, Params())
    assert d.max_rows == 1461 and d.df.count() == 1461
    r = d.df.where("date_key = 20240303").first()
    assert (r.day_of_week, r.day_name, r.month_name, r.year_month) == (0, "Sunday", "March", "2024-03")


def test_trip_key_equals_window_dense_rank(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        base = D(2024, 3, 1) + dt.timedelta(minutes=rnd.randint(0, 300))
        rows.append({"VendorID": rnd.choice([1, 2, None]), "lpep_pickup_datetime": base,
                     "lpep_dropoff_datetime": base + dt.timedelta(minutes=rnd.randint(1, 60)),
                     "trip_distance": float(rnd.randint(1, 3)), "total_amount": float(rnd.randint(5, 7)),
                     "PULocationID": rnd.choice([1, 2]), "DOLocationID": rnd.choice([1, 2, 3])})
    rows += rows[:50]  # identical trips share a key
    fact = _gold(spark, rows).fact
    keyed = with_trip_key(fact, num_partitions=5)
    w = Window.orderBy(*schemas.TRIP_KEY_ORDER)
    expect = fact.withColumn("trip_key", F.dense_rank().over(w).cast("bigint")).select(*schemas.FACT_COLUMNS)
    assert keyed.count() == fact.count() == 450
    assert keyed.exceptAll(expect).count() == 0 and expect.exceptAll(keyed).count() == 0
    assert keyed.select("trip_key").distinct().count() < 450


def test_dense_rank_on_one_hot_key(spark):
    df = spark.createDataFrame([(1, "a")] * 300 + [(0, "b"), (2, "c")], "k int, v string")
    out = {(r.k, r.v): r.rank for r in with_dense_rank(df, ["k", "v"], num_partitions=4).collect()}
    assert out == {(0, "b"): 1, (1, "a"): 2, (2, "c"): 3}


def test_unique_tests_of_a_table_share_a_read_and_a_shuffle(spark):
    import contextlib
    import io

    df = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (1, "b", D(2024, 1, 1)), (2, "b", None), (2, "c", D(2024, 1, 2)), (None, None, None),
                                (3, "1", D(2024, 1, 1))], "k int, v string, at timestamp_ntz")
    for columns in (["k"], ["k", "v", "at"]):
        out = run_tests({"t": df.repartition(3)}, unique("t", *columns))
        assert {r.column_name: (r.violations, r.passed) for r in out.collect()} == {
            c: ({"k": 2, "v": 1, "at": 1}[c], False) for c in columns}
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        run_tests({"t": spark.range(9).selectExpr("id", "id % 2 AS a", "string(id) AS b")}, unique("t", "id", "a", "b")).explain("formatted")
    tree = buf.getvalue().split("\n(1) ")[0]
    assert tree.count("Range") == 1 and tree.count("Exchange") - tree.count("BroadcastExchange") <= 2


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dense_rank_spreads_a_hot_key(spark, parts):
    """A third of all rows share a key, NULL in part, and many are equal in full; ranks equal the window's."""
    from tripmart.operators.dense_rank import partition_ranks

    rnd = random.Random(parts)
    rows = [(None, "hot", 1)] * 700 + [(rnd.randint(0, 40), rnd.choice(["a", "b", None]), rnd.randint(0, 2)) for _ in range(1400)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v string, other int").repartition(5)
    w = Window.orderBy(F.col("k").asc_nulls_last(), F.col("v").asc_nulls_last())
    want = df.withColumn("rank", F.dense_rank().over(w).cast("bigint"))
    got = with_dense_rank(df, ["k", "v"], num_partitions=parts)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    spread = partition_ranks(df, ["k", "v"], parts).where("v = 'hot'").groupBy("_part").count().collect()
    assert parts < 3 or len(spread) > 1
    assert with_dense_rank(df.limit(0), ["k", "v"], num_partitions=parts).count() == 0


def test_upper_median(spark):
    df = spark.createDataFrame([(1.0, 5, None), (2.0, None, None), (3.0, 1, None), (10.0, 3, None),
                                (None, 2, None)], "a double, b int, c double")
    assert upper_medians(df, ["a", "b", "c"]) == {"a": 3.0, "b": 3, "c": None}
    out = fill_upper_median(df, ["a", "b", "c"]).collect()
    assert [r.a for r in out] == [1.0, 2.0, 3.0, 10.0, 3.0]
    assert [r.b for r in out] == [5, 3, 1, 3, 2]
    assert all(r.c is None for r in out)


def test_ranked_values_match_sorting(spark):
    from tripmart.operators.percentiles import ranked_values

    rnd = random.Random(3)
    vals = [rnd.choice([None, 1.5, 2.25, 7.0]) if i % 3 else rnd.random() * 100 for i in range(999)]
    vals += [42.0] * 400  # one hot value
    df = spark.createDataFrame([("g", v) for v in vals], "g string, x double")
    ordered = sorted(v for v in vals if v is not None)
    ranked = ranked_values(df, ["g"], "x", num_partitions=5).collect()
    assert all(r["_total"] == len(ordered) for r in ranked)
    for r in ranked:
        assert ordered[r["_start"]:r["_end"]] == [r["_v"]] * r["_n"]
    assert sum(r["_n"] for r in ranked) == len(ordered)
    # percentile_disc over descending values picks the upper of two middle values
    sql = df.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY x DESC)")).first()[0]
    assert upper_medians(df, ["x"])["x"] == ordered[len(ordered) // 2] == sql


def test_quality_tests_count_planted_violations(spark):
    child = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "q"), (7, "z"), (7, None)],
                                  "k int, v string")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    tests = [*not_null("c", "k", "v"), *unique("c", "k"), *accepted("c", "v", ["x", "y"]),
             *fk("c", "k", "p", "k")]
    out = {(r.column_name, r.test_name): (r.violations, r.passed) for r in
           run_tests({"c": child, "p": parent}, tests, parents={"p": Dim(parent, 2)}).collect()}
    assert out == {("k", "not_null"): (1, False), ("v", "not_null"): (1, False),
                   ("k", "unique"): (2, False), ("v", "accepted_values"): (2, False),
                   ("k", "relationships"): (2, False)}


def test_example_model_tests(spark):
    first = spark.createDataFrame([(1,), (None,)], "id int")
    second = first.where("id = 1")
    out = {(r.table_name, r.test_name): r.violations for r in run_tests(
        {"example_first_model": first, "example_second_model": second}, X.EXAMPLE_TESTS).collect()}
    assert out == {("example_first_model", "unique"): 0, ("example_first_model", "not_null"): 1,
                   ("example_second_model", "unique"): 0, ("example_second_model", "not_null"): 0}


def test_declared_test_counts():
    from collections import Counter
    c = Counter(t.table for t in X.GOLD_TESTS)
    assert c == {"fct_trips": 26, "dim_date": 4, "dim_zones": 4, "dim_service_type": 4,
                 "dim_payment_type": 5, "dim_vendors": 7}
    assert len(X.SILVER_TESTS) == 8


def test_slice_grid(spark):
    g = generators.slice_grid(spark, 2022, 2025, ["yellow", "green"])
    assert g.count() == 96
    assert g.where("year_month = '2022-01' and service_type = 'green'").count() == 1


def test_conform_turns_nan_into_null(spark):
    df = spark.createDataFrame([(float("nan"), 1.5), (2.0, float("nan"))],
                               "passenger_count double, trip_distance double")
    out = conform(df).collect()
    assert out[0].passenger_count is None and out[0].trip_distance == 1.5
    assert out[1].trip_distance is None
    assert bronze_trips(conform(df).withColumn("fare_amount", F.lit(1.0))
                        .withColumn("tip_amount", F.lit(0.0)).withColumn("tolls_amount", F.lit(0.0))
                        .withColumn("total_amount", F.lit(1.0))).count() == 2


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame([(1, "2")], "VendorID long, payment_type string")
    out = conform(df)
    assert out.columns == [f.name for f in schemas.LANDING.fields]
    assert out.first().payment_type == 2 and out.first().ehail_fee is None


@pytest.mark.parametrize("fixed", [schemas.SERVICE_TYPES, schemas.PAYMENT_TYPES, schemas.VENDORS])
def test_fixed_dimension_keys_unique(fixed):
    keys = [r[0] for r in fixed]
    assert len(keys) == len(set(keys))


def test_grouped_percentile_cont_matches_builtin(spark):
    from tripmart.operators.percentiles import grouped_percentile_cont

    rnd = random.Random(11)
    rows = [("hot", Decimal(rnd.randint(0, 5000)) / 100) for _ in range(3000)]
    rows += [(g, Decimal(rnd.randint(0, 900)) / 100) for g in ("a", "b", "c") for _ in range(rnd.randint(1, 40))]
    rows += [("one", Decimal("7.25")), ("nul", None)]
    df = spark.createDataFrame(rows, "g string, v decimal(10,2)")
    got = grouped_percentile_cont(df, ["g"], "v", {"p50": 0.5, "p90": 0.9}, num_partitions=7)
    want = df.groupBy("g").agg(F.percentile(F.col("v").cast("double"), F.lit(0.5)).alias("w50"),
                               F.percentile(F.col("v").cast("double"), F.lit(0.9)).alias("w90"))
    j = {r.g: r for r in got.join(want, "g", "full").collect()}
    assert set(j) == {"hot", "a", "b", "c", "one", "nul"}
    assert j["nul"].p50 is None and j["nul"].w50 is None   # no values: absent, NULL after a join
    for g, r in j.items():
        if g == "nul":
            continue
        assert abs(float(r.p50) - r.w50) < 1e-9 and abs(float(r.p90) - r.w90) < 1e-9, g


def test_scale_settings():
    from tripmart.session import scale_settings

    big = scale_settings(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 65536
    mid = scale_settings(1024 ** 4, 800)
    assert mid["spark.sql.shuffle.partitions"] == "4096"
    small = scale_settings(10 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_dense_rank_keeps_null_keys(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([(1, None, "a"), (None, "x", "b"), (None, None, "c"), (1, "x", "d"), (1, None, "e")],
                               "k int, v string, id string")
    got = {r.id: r.rank for r in with_dense_rank(df, ["k", "v"], num_partitions=3).collect()}
    w = Window.orderBy(F.col("k").asc_nulls_last(), F.col("v").asc_nulls_last())
    assert got == {r.id: r.rank for r in df.withColumn("rank", F.dense_rank().over(w)).collect()}
    assert len(got) == 5


def test_grouped_percentile_keeps_null_groups(spark):
    from tripmart.operators.percentiles import grouped_percentile_cont

    df = spark.createDataFrame([(None, Decimal("1.00")), (None, Decimal("4.00")), ("a", Decimal("2.50")), ("a", None)],
                               "g string, v decimal(10,2)")
    got = {r.g: r for r in grouped_percentile_cont(df, ["g"], "v", {"p50": 0.5}).collect()}
    assert set(got) == {None, "a"}
    assert got[None].p50 == Decimal("2.5") and got[None]["_count"] == 2 and got[None]["_sum"] == Decimal("5.00")
    assert got["a"].p50 == Decimal("2.5") and (got["a"]["_min"], got["a"]["_max"]) == (Decimal("2.50"), Decimal("2.50"))


def test_fixed_values_are_pinned():
    """The oracle shares these with the package, so they are stated again here."""
    assert schemas.SERVICE_TYPES == [(1, "Yellow Taxi", "yellow", "yellow"), (2, "Green Taxi", "green", "green")]
    assert [p[1] for p in schemas.PAYMENT_TYPES] == ["Flex Fare", "Credit Card", "Cash", "No Charge", "Dispute", "Unknown",
                                                     "Voided Trip"]
    assert [p[2] for p in schemas.PAYMENT_TYPES] == ["flex", "card", "cash"] + ["other/unknown"] * 4
    assert [(v[0], v[1], v[3]) for v in schemas.VENDORS] == [(1, 1, "CMT"), (2, 2, "CURB"), (3, 6, "MYLE"), (4, 7, "HELIX"),
                                                             (5, 99, "OTH")]
    assert (schemas.DEFAULT_VENDOR_ID, schemas.DEFAULT_PAYMENT_TYPE_ID, schemas.DEFAULT_VENDOR_KEY,
            schemas.DEFAULT_PAYMENT_TYPE_KEY) == (99, 5, 5, 5)
    assert schemas.AMOUNT_GUARD == "99999999.99" and len(schemas.PANDAS_NA_TOKENS) == 19
    assert [(lo, hi) for lo, hi, _ in schemas.TIME_BLOCKS] == [(6, 9), (10, 15), (16, 19), (20, 23)]
    assert schemas.WEEKDAY_ORDER[0] == "Monday" and schemas.BOROUGH_ORDER[0] == "Manhattan"
