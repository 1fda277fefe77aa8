"""Independent SQL statement of every registered query, in DuckDB's dialect.

Used as the correctness oracle: the driver (and ``tests/test_oracle.py``)
runs these next to the Spark plans over the same parquet tables. It is
written from the definitions of the layers and reports, with a structure of
its own: amounts as whole cents, one wide join of the star that every report
groups, ranks by counting.

DuckDB divides decimals in DOUBLE, where 1.005 rounds to 1.00. The
reference divides NUMERICs exactly and rounds half away from zero, so
rounded quotients are computed here on scaled integers (``_div``).
Results cast decimals to DOUBLE, as the Spark side does for comparison.
"""

from __future__ import annotations

from tripmart import schemas
from tripmart.params import TESTDATA, Params
from tripmart.plans.silver import SILVER_COLUMNS
from tripmart.sources.testdata import DEFAULT_INGEST_TS


def _div(num: str, den: str) -> str:
    """round_half_away_from_zero(num / den) on integers, den > 0."""
    return (f"(sign(CAST({num} AS HUGEINT)) * ((2 * abs(CAST({num} AS HUGEINT)) + CAST({den} AS HUGEINT))"
            f" // (2 * CAST({den} AS HUGEINT))))")


def _int(x: str, scale: int) -> str:
    """Decimal x with ``scale`` places as an integer count of 10^-scale."""
    return f"CAST(({x}) * {10 ** scale} AS HUGEINT)"


def _dec(int_expr: str, scale: int) -> str:
    return f"(CAST({int_expr} AS DECIMAL(38,0)) * {1 / 10 ** scale:.{scale}f})"


def _money(cents: str) -> str:
    return f"CAST({_dec(cents, 2)} AS DECIMAL(10,2))"


def _day_key(ts: str) -> str:
    """yyyymmdd as an integer."""
    return f"CAST(10000 * year({ts}) + 100 * month({ts}) + day({ts}) AS INTEGER)"


def mean2(x: str, scale_in: int = 2) -> str:
    """ROUND(AVG(x), 2), exact."""
    return _dec(_div(f"sum({_int(x, scale_in)})", f"count({x}) * {10 ** (scale_in - 2)}"), 2)


def mean_x100(x: str, scale_in: int = 4) -> str:
    """ROUND(AVG(x) * 100, 2), exact."""
    return _dec(_div(f"sum({_int(x, scale_in)})", f"count({x}) * {10 ** (scale_in - 4)}"), 2)


def pct2(part: str, whole: str) -> str:
    """ROUND(100.0 * part / whole, 2), exact."""
    return _dec(_div(f"10000 * ({part})", whole), 2)


def pctl2(x: str, p: float) -> str:
    return f"round(CAST(quantile_cont(CAST({x} AS DOUBLE), {p}) AS DECIMAL(38,6)), 2)"


def _values(rows, names) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(names)})"


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ------------------------------------------------------------------ layers

def base_ctes(p: Params = TESTDATA) -> str:
    na = _in_list(schemas.PANDAS_NA_TOKENS)
    guard = schemas.AMOUNT_GUARD
    ingest = DEFAULT_INGEST_TS.strftime("%Y-%m-%d %H:%M:%S")
    svc = _values(schemas.SERVICE_TYPES, ["service_type_key", "service_type_name",
                                          "service_type_code", "partition_group"])
    pay = _values(schemas.PAYMENT_TYPES, ["payment_type_key", "payment_type_name", "partition_group"])
    ven = _values(schemas.VENDORS, ["vendor_key", "vendor_id", "vendor_name", "vendor_code",
                                    "vendor_group", "description", "partition_group"])
    key_cols = ", ".join(schemas.TRIP_KEY_ORDER)
    return f"""
t_base AS (
  SELECT l.*, o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority, c.c_nationkey, s.s_nationkey,
         CAST(l.l_extendedprice AS DECIMAL(15,2)) AS x_fare,
         round(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(l.l_discount AS DECIMAL(4,2)), 2) AS x_tip,
         CASE WHEN l.l_tax = 0 THEN NULL
              ELSE round(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(l.l_tax AS DECIMAL(4,2)), 2) END AS x_tolls
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
t_landing AS (
  SELECT
    CAST(l_linenumber AS INTEGER) AS "VendorID",
    o_orderdate + to_minutes(CAST((o_orderkey % 24) * 60 + o_custkey % 60 AS BIGINT)) AS lpep_pickup_datetime,
    l_shipdate + to_minutes(CAST((l_partkey % 24) * 60 + l_suppkey % 60 AS BIGINT)) AS lpep_dropoff_datetime,
    CASE WHEN l_quantity = 7 THEN CAST(NULL AS DOUBLE) ELSE l_quantity / 10 END AS passenger_count,
    CAST(l_quantity AS DOUBLE) AS trip_distance,
    CAST(CASE WHEN l_returnflag = 'R' THEN 2 WHEN l_returnflag = 'A' THEN 3 ELSE 1 END AS DOUBLE) AS "RatecodeID",
    CAST(c_nationkey AS INTEGER) AS "PULocationID",
    CAST(s_nationkey + 1 AS INTEGER) AS "DOLocationID",
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_type,
    CAST(x_fare AS DOUBLE) AS fare_amount,
    CAST(x_tip AS DOUBLE) AS tip_amount,
    CAST(x_tolls AS DOUBLE) AS tolls_amount,
    CAST(x_fare + x_tip + coalesce(x_tolls, 0) AS DOUBLE) AS total_amount,
    CASE WHEN l_linestatus <> 'F'
         THEN CAST(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS DOUBLE) END AS trip_type,
    CAST(NULL AS DOUBLE) AS ehail_fee,
    TIMESTAMP '{ingest}' AS ingest_ts,
    CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(l_shipdate, '%Y-%m')
         ELSE strftime(o_orderdate, '%Y-%m') END AS source_month,
    CASE WHEN l_linestatus = 'F' THEN 'yellow' ELSE 'green' END AS service_type
  FROM t_base
),
t_bronze AS (
  SELECT
    CAST("VendorID" AS INTEGER) AS "VendorID",
    CAST(lpep_pickup_datetime AS TIMESTAMP) AS pickup_ts,
    CAST(lpep_dropoff_datetime AS TIMESTAMP) AS dropoff_ts,
    CAST(round_even(passenger_count, 0) AS INTEGER) AS passenger_count,
    CAST(trip_distance AS DECIMAL(10,2)) AS trip_distance,
    CAST("PULocationID" AS INTEGER) AS pickup_location_id,
    CAST("DOLocationID" AS INTEGER) AS dropoff_location_id,
    CAST(round_even("RatecodeID", 0) AS INTEGER) AS rate_code_id,
    CAST(payment_type AS INTEGER) AS payment_type_id,
    CAST(fare_amount AS DECIMAL(15,2)) AS fare_amount,
    CAST(tip_amount AS DECIMAL(15,2)) AS tip_amount,
    CAST(tolls_amount AS DECIMAL(15,2)) AS tolls_amount,
    CAST(total_amount AS DECIMAL(15,2)) AS total_amount,
    CAST(round_even(trip_type, 0) AS INTEGER) AS trip_type,
    ingest_ts, source_month, service_type,
    CAST(date_diff('microsecond', lpep_pickup_datetime, lpep_dropoff_datetime) AS DOUBLE) / 60000000.0
      AS trip_time_minutes,
    date_diff('microsecond', lpep_pickup_datetime, lpep_dropoff_datetime) AS x_us
  FROM t_landing
  WHERE CAST(fare_amount AS DECIMAL(38,10)) <= {guard}
    AND CAST(tip_amount AS DECIMAL(38,10)) <= {guard}
    AND CAST(tolls_amount AS DECIMAL(38,10)) <= {guard}
    AND CAST(total_amount AS DECIMAL(38,10)) <= {guard}
),
t_zone_lookup AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS "LocationID",
         CASE WHEN n.n_nationkey = 24 THEN '' ELSE r.r_name END AS "Borough",
         CASE WHEN n.n_nationkey = 23 THEN 'N/A' ELSE n.n_name END AS "Zone",
         CASE n.n_regionkey WHEN 0 THEN 'Boro Zone' WHEN 1 THEN 'Yellow Zone' WHEN 2 THEN 'Airports'
                            WHEN 3 THEN 'EWR' ELSE 'N/A' END AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
t_zones AS (
  SELECT "LocationID" AS location_id,
         CASE WHEN "Borough" IN ({na}) THEN NULL ELSE "Borough" END AS borough,
         CASE WHEN "Zone" IN ({na}) THEN NULL ELSE "Zone" END AS zone_name,
         CASE WHEN service_zone IN ({na}) THEN NULL ELSE service_zone END AS service_zone
  FROM t_zone_lookup
),
t_silver AS (
  SELECT t."VendorID", t.pickup_ts, t.dropoff_ts, coalesce(t.passenger_count, 0) AS passenger_count,
         t.trip_distance, t.pickup_location_id, t.dropoff_location_id, t.rate_code_id, t.payment_type_id,
         t.fare_amount, t.tip_amount, t.tolls_amount, t.total_amount, t.trip_type, t.ingest_ts,
         t.source_month, t.service_type, t.trip_time_minutes, t.x_us,
         zp.zone_name AS pickup_location_name, zd.zone_name AS dropoff_location_name
  FROM t_bronze t
  JOIN t_zones zp ON t.pickup_location_id = zp.location_id
  JOIN t_zones zd ON t.dropoff_location_id = zd.location_id
  WHERE t.pickup_location_id IS NOT NULL AND t.dropoff_location_id IS NOT NULL
),
t_dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day,
         CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
         strftime(d, '%Y-%m') AS year_month
  FROM (SELECT CAST(generate_series AS DATE) AS d
        FROM generate_series(DATE '{p.calendar_start}', DATE '{p.calendar_end}', INTERVAL 1 DAY))
),
t_dim_zones AS (
  SELECT location_id AS zone_key,
         coalesce(borough, '{schemas.UNKNOWN_BOROUGH}') AS borough,
         coalesce(zone_name, '{schemas.UNKNOWN_ZONE}') AS zone_name,
         coalesce(service_zone, '{schemas.UNKNOWN_SERVICE_ZONE}') AS service_zone
  FROM t_zones
),
t_dim_service_type AS ({svc}),
t_dim_payment_type AS ({pay}),
t_dim_vendors AS ({ven}),
t_usable AS (
  -- whole cents and microseconds, so that every quotient below is one integer division
  SELECT *, coalesce("VendorID", {schemas.DEFAULT_VENDOR_ID}) AS vendor_id,
         coalesce(payment_type_id, {schemas.DEFAULT_PAYMENT_TYPE_ID}) AS pay_id,
         {_int('trip_distance', 2)} AS i_distance, {_int('coalesce(fare_amount, 0)', 2)} AS i_fare,
         {_int('coalesce(tip_amount, 0)', 2)} AS i_tip, {_int('coalesce(tolls_amount, 0)', 2)} AS i_tolls,
         {_int('total_amount', 2)} AS i_total
  FROM t_silver
  -- least() skips NULLs, and NULL amounts count as zero
  WHERE x_us > 0 AND trip_distance > 0 AND total_amount > 0
    AND coalesce(least(fare_amount, tip_amount, tolls_amount, passenger_count), 0) >= 0
    AND date_trunc('month', pickup_ts) = strptime(source_month || '-01', '%Y-%m-%d')
),
t_fact AS (
  SELECT CAST(u.pickup_ts AS DATE) AS pickup_date, {_day_key('u.pickup_ts')} AS pickup_date_key,
         {_day_key('u.dropoff_ts')} AS dropoff_date_key,
         CASE WHEN u.service_type = 'yellow' THEN {schemas.SERVICE_TYPE_KEYS["yellow"]}
              ELSE {schemas.SERVICE_TYPE_KEY_ELSE} END AS service_type_key,
         coalesce((SELECT max(v.vendor_key) FROM t_dim_vendors v WHERE v.vendor_id = u.vendor_id),
                  {schemas.DEFAULT_VENDOR_KEY}) AS vendor_key,
         u.pickup_location_id AS pu_zone_key, u.dropoff_location_id AS do_zone_key,
         CASE WHEN u.pay_id IN (SELECT payment_type_key FROM t_dim_payment_type) THEN u.pay_id
              ELSE {schemas.DEFAULT_PAYMENT_TYPE_KEY} END AS payment_type_key,
         CAST(u.passenger_count AS INTEGER) AS passenger_count,
         {_money('i_distance')} AS trip_distance, {_money('i_fare')} AS fare_amount,
         {_money('i_tip')} AS tip_amount, {_money('i_tolls')} AS tolls_amount, {_money('i_total')} AS total_amount,
         CAST({_dec(_div('x_us', '600000'), 2)} AS DECIMAL(10,2)) AS trip_time_minutes,
         CAST(CASE i_fare WHEN 0 THEN 0 ELSE {_dec(_div('10000 * i_tip', 'greatest(i_fare, 1)'), 4)} END
              AS DECIMAL(18,4)) AS tip_percentage,
         CAST({_dec(_div('i_distance * 3600000000', 'x_us'), 2)} AS DECIMAL(18,2)) AS speed_mph,
         u.pickup_location_id, u.dropoff_location_id, u.pay_id AS payment_type_id, u.vendor_id,
         u.source_month, u.service_type, u.ingest_ts, u.pickup_ts, u.dropoff_ts
  FROM t_usable u
  WHERE u.pickup_location_id IN (SELECT zone_key FROM t_dim_zones)
    AND u.dropoff_location_id IN (SELECT zone_key FROM t_dim_zones)
),
t_trip_keys AS (
  SELECT row_number() OVER (ORDER BY {key_cols}) AS trip_key, * FROM (SELECT DISTINCT {key_cols} FROM t_fact)
),
t_fact_keyed AS (SELECT * FROM t_trip_keys JOIN t_fact USING ({key_cols})),
t_wide AS (
  -- the star joined once; the business queries only group it
  SELECT f.*, year(f.pickup_date) AS y, strftime(f.pickup_date, '%Y-%m') AS year_month,
         strftime(f.pickup_date, '%B') AS month_name, month(f.pickup_date) AS m,
         strftime(f.pickup_date, '%A') AS day_name, s.service_type_name,
         a.zone_name, a.borough, b.borough AS to_borough,
         p.payment_type_name, p.partition_group AS payment_category
  FROM t_fact f, t_dim_zones a, t_dim_zones b, t_dim_service_type s, t_dim_payment_type p
  WHERE a.zone_key = f.pu_zone_key AND b.zone_key = f.do_zone_key
    AND s.service_type_key = f.service_type_key AND p.payment_type_key = f.payment_type_key
)"""


def with_base(body: str, double_cols: list[str] = (), p: Params = TESTDATA,
              text_cols: list[str] = ()) -> str:
    """Full statement: base CTEs, then ``body``; listed columns to DOUBLE
    (decimals) or to ISO text (dates, timestamps)."""
    sql = "WITH " + base_ctes(p).strip() + "\n" + body.strip()
    repl = [f"CAST({c} AS DOUBLE) AS {c}" for c in double_cols]
    repl += [f"CAST({c} AS VARCHAR) AS {c}" for c in text_cols]
    if repl:
        sql = f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{sql}\n) AS q"
    return sql


# Date and timestamp columns of the registered outputs (compared as ISO text).
TEXT_COLUMNS = {
    "landing_harmonised": ["lpep_pickup_datetime", "lpep_dropoff_datetime", "ingest_ts"],
    "bronze_trips": ["pickup_ts", "dropoff_ts", "ingest_ts"],
    "silver_trips_zones": ["pickup_ts", "dropoff_ts", "ingest_ts"],
    "gold_fct_trips": ["pickup_date", "ingest_ts"],
    "q22_fact_sample": ["pickup_date", "ingest_ts"],
    "b4_ledger_state": ["started_at", "completed_at", "created_at", "updated_at"],
}


# ------------------------------------------------------------------ queries

BRONZE_COLS = [f'"{c}"' for c in SILVER_COLUMNS]
MONEY = ["fare_amount", "tip_amount", "tolls_amount", "total_amount"]


def query_bodies(p: Params = TESTDATA) -> dict[str, tuple[str, list[str]]]:
    """name -> (SQL after the base CTEs, columns to cast to DOUBLE)."""
    q: dict[str, tuple[str, list[str]]] = {}

    def grouped(name: str, keys: str, values: dict[str, str], doubles: str = "", where: str = "TRUE",
                having: str = "TRUE", hidden: str = "", top: str = "") -> None:
        """A report of the year's trips: ``keys`` and ``hidden`` group, ``keys`` and ``values`` are shown."""
        shown = ", ".join([keys, *(f"{sql} AS {col}" for col, sql in values.items())])
        group = ", ".join(k for k in [", ".join(x.split(" AS ")[0] for x in keys.split(", ")), hidden] if k)
        tail = f" ORDER BY {top} LIMIT {p.top_n}" if top else ""
        q[name] = (f"SELECT {shown} FROM t_wide WHERE y = {p.year} AND {where} GROUP BY {group} HAVING {having}{tail}",
                   doubles.split())

    month, trips, zone = "year_month, month_name", {"trip_count": "count(*)"}, "zone_name, borough"
    revenue = {"total_revenue": "sum(total_amount)"}
    tip = {"avg_tip_percentage": mean_x100("tip_percentage")}
    grouped("q01_trips_per_month", month, trips)
    grouped("q02_trips_per_month_service", month + ", service_type_name", trips)
    grouped("q03_top_pickup_zones", zone, trips, hidden="pu_zone_key", top="trip_count DESC, pu_zone_key")
    q["q04_top_dropoff_zones"] = (f"""
SELECT z.zone_name, z.borough, n AS trip_count
FROM (SELECT do_zone_key, count(*) AS n FROM t_wide WHERE y = {p.year} GROUP BY do_zone_key
      ORDER BY n DESC, do_zone_key LIMIT {p.top_n})
JOIN t_dim_zones z ON z.zone_key = do_zone_key""", [])
    q["q05_top_boroughs_per_month"] = (f"""
SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY trip_count DESC, borough) AS "rank"
FROM (SELECT {month}, borough, count(*) AS trip_count FROM t_wide WHERE y = {p.year} GROUP BY ALL)
QUALIFY "rank" <= {p.top_per_group}""", [])

    not_negative = " AND ".join(f"{c} >= 0" for c in ("passenger_count", "fare_amount", "trip_distance", "total_amount"))
    slots = f"""
, weekdays AS (SELECT day_of_week AS wd, min(day_name) AS day_name, count(*) AS dates FROM t_dim_date GROUP BY wd),
slots AS (
  SELECT dayofweek(pickup_ts) AS wd, CAST(hour(pickup_ts) AS INTEGER) AS h, count(*) AS n,
         sum({_int('trip_distance', 2)}) AS i_distance, sum({_int('total_amount', 2)}) AS i_amount
  FROM t_bronze
  WHERE pickup_ts >= TIMESTAMP '{p.year}-01-01' AND pickup_ts < TIMESTAMP '{p.year + 1}-01-01'
    AND dropoff_ts >= pickup_ts AND {not_negative}
  GROUP BY ALL),
peaks AS (
  SELECT wd, h, day_name, dates, n, {_dec(_div('i_distance', 'n'), 2)} AS distance, {_dec(_div('i_amount', 'n'), 2)} AS amount,
         1 + (SELECT count(*) FROM slots busier WHERE busier.wd = s.wd AND busier.n > s.n) AS place
  FROM slots s JOIN weekdays USING (wd))"""

    def peak_hours(weight: str) -> tuple[str, list[str]]:
        """``weight``: how often each trip counts; a join on the weekday alone repeats it for every date."""
        return (slots + f"""
SELECT day_name, h AS peak_hour, CAST(n * {weight} AS BIGINT) AS trip_count, distance AS avg_distance,
       amount AS avg_amount, {pct2('n', 'sum(n) OVER (PARTITION BY wd)')} AS pct_of_daily_trips
FROM peaks WHERE place <= {p.top_per_group}""", ["avg_distance", "avg_amount", "pct_of_daily_trips"])

    q["q06_peak_hours"] = peak_hours("1")
    q["q06_literal_weekday_join"] = peak_hours("dates")
    hours = ", ".join(f"({h}, '{next((t for lo, hi, t in schemas.TIME_BLOCKS if lo <= h <= hi), schemas.TIME_BLOCK_ELSE)}')"
                      for h in range(24))
    block_of = f"(VALUES {hours}) AS blocks(h, time_block)"
    q["q06b_time_block_summary"] = (slots + f"""
SELECT time_block, count(DISTINCT wd) AS days_appeared, CAST(sum(n) AS BIGINT) AS total_trips,
       {mean2('distance')} AS avg_distance, {mean2('amount')} AS avg_amount
FROM peaks JOIN {block_of} USING (h)
WHERE place <= {p.top_per_group}
GROUP BY time_block""", ["avg_distance", "avg_amount"])

    q["q07_weekday_distribution"] = (f"""
SELECT day_name, n AS trip_count, {pct2('n', 'sum(n) OVER ()')} AS percentage, rank() OVER (ORDER BY n DESC) AS "rank"
FROM (SELECT day_name, count(*) AS n FROM t_wide WHERE y = {p.year} GROUP BY day_name)""", ["percentage"])
    grouped("q08_revenue_per_month", month, revenue, "total_revenue")
    grouped("q09_revenue_per_month_service", month + ", service_type_name", revenue, "total_revenue")
    grouped("q10_tip_pct_per_month", month, tip, "avg_tip_percentage", "fare_amount > 0")
    grouped("q11_tip_pct_month_borough", month + ", borough", tip | trips, "avg_tip_percentage", "fare_amount > 0")
    grouped("q12_top_zones_by_revenue", zone, revenue | trips | {"avg_revenue_per_trip": mean2("total_amount")},
            "total_revenue avg_revenue_per_trip", hidden="pu_zone_key", top="total_revenue DESC, pu_zone_key")
    grouped("q13_top_zones_by_tip_pct", zone, tip | trips | {"avg_fare": mean2("fare_amount"), "avg_tip": mean2("tip_amount")},
            "avg_tip_percentage avg_fare avg_tip", "fare_amount > 0", f"count(*) >= {p.q13_min_trips}",
            "pu_zone_key", "avg_tip_percentage DESC, pu_zone_key")
    rate = _dec(_div(f"10000 * sum({_int('tip_amount', 2)})", f"nullif(sum({_int('fare_amount', 2)}), 0)"), 2)
    grouped("q14_cash_vs_card", "payment_type_name, payment_category",
            trips | revenue | {"avg_ticket": mean2("total_amount")} | tip
            | {"total_tips": "sum(tip_amount)", "overall_tip_rate": rate},
            "total_revenue avg_ticket avg_tip_percentage total_tips overall_tip_rate", "payment_category IN ('cash', 'card')")
    grouped("q15_duration_per_month", month, {"avg_duration_minutes": mean2("trip_time_minutes")}, "avg_duration_minutes")
    grouped("q16_distance_per_month", month, {"avg_distance_miles": mean2("trip_distance")}, "avg_distance_miles")

    speed = {"avg_speed_mph": mean2("speed_mph"), "median_speed_mph": pctl2("speed_mph", 0.5), **trips,
             "min_speed_mph": "min(speed_mph)", "max_speed_mph": "max(speed_mph)"}
    speeds = "avg_speed_mph median_speed_mph min_speed_mph max_speed_mph"
    plausible, enough = f"speed_mph <= {p.q17_max_speed} AND trip_time_minutes > 0", f"count(*) >= {p.q17_min_trips}"
    grouped("q17_speed_by_borough", "borough", speed, speeds, plausible, enough)
    block = f"(SELECT any_value(time_block) FROM {block_of} WHERE h = hour(pickup_ts))"
    shown = ", ".join(f"{sql} AS {col}" for col, sql in speed.items())
    q["q17b_speed_by_borough_time_block"] = (f"""
SELECT borough, time_block, {shown}
FROM (SELECT *, {block} AS time_block FROM t_wide WHERE y = {p.year} AND {plausible})
GROUP BY borough, time_block HAVING {enough}""", speeds.split())
    minutes = {f"p{n}_duration_min": pctl2("trip_time_minutes", n / 100) for n in (50, 90)}
    # trips of under half a hundredth of a minute round to zero and do not count
    grouped("q18_duration_percentiles_by_borough", "borough", trips | minutes, " ".join(minutes), "trip_time_minutes > 0")
    grouped("q19_top_zones_by_p90_duration", zone,
            trips | {"p90_duration_min": minutes["p90_duration_min"], "avg_duration_min": mean2("trip_time_minutes"),
                     "max_duration_min": "max(trip_time_minutes)"},
            "p90_duration_min avg_duration_min max_duration_min", "trip_time_minutes > 0",
            f"count(*) >= {p.q19_min_trips}", "pu_zone_key", "p90_duration_min DESC, pu_zone_key")
    grouped("q20_top_borough_routes", "borough AS pickup_borough, to_borough AS dropoff_borough",
            trips | {"avg_revenue": mean2("total_amount"), "avg_distance_miles": mean2("trip_distance"),
                     "avg_duration_min": mean2("trip_time_minutes")},
            "avg_revenue avg_distance_miles avg_duration_min", top="trip_count DESC, pickup_borough, dropoff_borough")

    fact_cols = ", ".join(schemas.FACT_COLUMNS)
    fact_dec = ["trip_distance", *MONEY, "trip_time_minutes", "tip_percentage", "speed_mph"]
    q["q22_fact_sample"] = (f"""
SELECT {fact_cols} FROM t_fact_keyed ORDER BY {fact_cols} LIMIT 5""", fact_dec)

    # Layers.
    q["landing_harmonised"] = ("SELECT * FROM t_landing", [])
    q["bronze_trips"] = (f"SELECT {', '.join(BRONZE_COLS)} FROM t_bronze",
                         ["trip_distance", *MONEY, "trip_time_minutes"])
    q["bronze_zones"] = ("SELECT location_id, borough, zone_name, service_zone FROM t_zones", [])
    q["silver_trips_zones"] = (
        f"SELECT {', '.join(BRONZE_COLS)}, pickup_location_name, dropoff_location_name FROM t_silver",
        ["trip_distance", *MONEY, "trip_time_minutes"])
    q["gold_dim_zones"] = ("SELECT * FROM t_dim_zones", [])
    q["gold_fct_trips"] = (f"SELECT {fact_cols} FROM t_fact_keyed", fact_dec)
    q["silver_null_audit"] = ("""
SELECT count(*) AS total_rows, count(CASE WHEN dropoff_location_id IS NULL THEN 1 END) AS null_dropoff_count
FROM t_bronze""", [])
    return q


def job_bodies(p: Params = TESTDATA) -> dict[str, tuple[str, list[str]]]:
    cols = ["passenger_count", "trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount"]
    # Upper median: element floor(n/2) (0-based) of the sorted non-NULL values.
    med = ", ".join(
        f"list_sort(list({c}) FILTER (WHERE {c} IS NOT NULL))[CAST(floor(count({c}) / 2) AS BIGINT) + 1] AS m_{c}"
        for c in cols)
    fill = ", ".join(f"coalesce(l.{c}, (SELECT m_{c} FROM m)) AS {c}" for c in cols)
    services = ", ".join(f"'{s}'" for s in schemas.GRID_SERVICES)
    # Walk each slice's log in time order; an order is one entry.
    ledger = """log AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS year_month, if(o_custkey % 7 = 0, 'green', 'yellow') AS service_type,
         o_orderdate + to_microseconds(o_orderkey) AS ts, o_orderkey AS k,
         CASE o_orderpriority[1] WHEN '2' THEN 'processing' WHEN '3' THEN 'failed' WHEN '4' THEN 'completed'
                                 ELSE 'started' END AS event
  FROM orders),
ledger AS (
  SELECT year_month, service_type, last(event ORDER BY ts) AS status,
         max(ts) FILTER (event = 'started') AS started_at, max(ts) FILTER (event = 'completed') AS completed_at,
         CAST(last(k ORDER BY ts) FILTER (event = 'completed') % 100000 AS INTEGER) AS rows_ingested,
         if(last(event ORDER BY ts) = 'failed', 'order ' || last(k ORDER BY ts), NULL) AS error_message,
         CAST(greatest(count(*) FILTER (event = 'started') - 1, 0) AS INTEGER) AS retry_count,
         min(ts) AS created_at, max(ts) AS updated_at
  FROM log GROUP BY year_month, service_type)"""
    grid = f"""
, grid AS (
  SELECT strftime(g.m, '%Y-%m') AS year_month, unnest([{services}]) AS service_type
  FROM (SELECT generate_series AS m FROM generate_series(DATE '{p.grid_first_year}-01-01',
                                                          DATE '{p.grid_last_year}-12-01', INTERVAL 1 MONTH)) g),
{ledger}"""
    return {
        "i1_impute_upper_median": (f"""
, m AS (SELECT {med} FROM t_landing)
SELECT {fill} FROM t_landing l""", []),
        "b4_ledger_state": (", " + ledger + " SELECT * FROM ledger", []),
        "b2_pending_slices": (grid + """
SELECT * FROM grid
EXCEPT SELECT year_month, service_type FROM ledger WHERE status = 'completed'""", []),
        "b7_coverage": (grid + """
SELECT year_month, service_type, coalesce(status, 'pending') AS status,
       CAST(coalesce(rows_ingested, 0) AS INTEGER) AS rows_ingested
FROM grid LEFT JOIN ledger USING (year_month, service_type)""", []),
    }


def oracle_statements(p: Params = TESTDATA) -> dict[str, str]:
    bodies = {**query_bodies(p), **dq_bodies(), **job_bodies(p)}
    return {name: with_base(body, cols, p, TEXT_COLUMNS.get(name, ()))
            for name, (body, cols) in bodies.items()}


# ------------------------------------------------------------------ data-quality tests

ORACLE_TABLES = {
    "int_taxi_trips_zones_joined": "t_silver", "stg_zones": "t_zones", "fct_trips": "t_fact_keyed",
    "dim_date": "t_dim_date", "dim_zones": "t_dim_zones", "dim_service_type": "t_dim_service_type",
    "dim_payment_type": "t_dim_payment_type", "dim_vendors": "t_dim_vendors",
}


def _lit(v) -> str:
    return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def dq_sql(tests) -> str:
    parts = []
    for t in tests:
        src, col = ORACLE_TABLES[t.table], t.column
        head = f"SELECT '{t.table}' AS table_name, '{col}' AS column_name, '{t.test}' AS test_name, "
        if t.test == "not_null":
            parts.append(head + f"CAST(count(*) AS BIGINT) AS violations FROM {src} WHERE {col} IS NULL")
        elif t.test == "unique":
            parts.append(head + f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT {col} FROM {src} "
                                f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)")
        elif t.test == "accepted_values":
            vals = ", ".join(_lit(v) for v in t.values)
            parts.append(head + f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT {col} FROM {src} "
                                f"WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}) GROUP BY {col})")
        else:
            parent = ORACLE_TABLES[t.to]
            parts.append(head + f"CAST(count(*) AS BIGINT) AS violations FROM {src} c "
                                f"LEFT JOIN {parent} p ON c.{col} = p.{t.field} "
                                f"WHERE c.{col} IS NOT NULL AND p.{t.field} IS NULL")
    union = "\nUNION ALL\n".join(parts)
    return f"SELECT *, violations = 0 AS passed FROM (\n{union}\n) AS tests"


def dq_bodies() -> dict[str, tuple[str, list[str]]]:
    from tripmart.plans import expectations as X

    return {"dq_silver_tests": (dq_sql(X.SILVER_TESTS), []),
            "dq_gold_tests": (dq_sql(X.GOLD_TESTS), [])}
