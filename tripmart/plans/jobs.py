"""Batch jobs: ingest (B1), backfill (B3), silver and gold builds.

A ``Lake`` is a root folder (shared storage on a cluster) holding:

=========================  ==================================================
raw/taxi_trips             landing rows, partitioned by slice
raw/taxi_zones             zone lookup, replaced whole
bronze/trips               typed trips, partitioned by slice
gold/<table>/build=<id>    fact (partitioned by source_month), its runs, dimensions
gold/_versions             which builds make up each published version
control/ingestion_events   ledger (append-only)
control/raw_schemas        how each raw slice is stored
=========================  ==================================================

Ingest and backfill are one Spark application over all requested files: one
read per footer schema, one dynamic-overwrite write per layer (of raw, for each
set of types that has no exact common one), ledger events around it. Nothing is
looped per slice.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.operators.joins import Dim
from tripmart.params import Params
from tripmart.plans import layout, publish
from tripmart.plans.bronze import bronze_trips, bronze_zones
from tripmart.plans.checks import Blocked, gold_checks, silver_checks, violated
from tripmart.plans.commits import UNREADABLE, has_condition, is_missing
from tripmart.plans.gold import Gold, build_gold, value_state, with_hash_trip_key, with_trip_key
from tripmart.plans.ledger import Ledger, pending
from tripmart.plans.queries import Tables
from tripmart.plans.raw import RawTrips
from tripmart.plans.silver import SILVER_COLUMNS, silver_trips
from tripmart.sources import generators
from tripmart.sources.files import list_slices, parse_trip_file, read_zone_csv, trip_file_parts, unreadable

log = logging.getLogger("tripmart.jobs")


@dataclass(frozen=True)
class Lake:
    root: str

    def p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw_trips(self): return self.p("raw", "taxi_trips")
    def raw(self, spark: SparkSession) -> RawTrips:
        return RawTrips(spark, self.raw_trips, self.p("control", "raw_schemas"))

    @property
    def raw_zones(self): return self.p("raw", "taxi_zones")
    @property
    def bronze_trips(self): return self.p("bronze", "trips")
    @property
    def events(self): return self.p("control", "ingestion_events")

    def register(self, spark: SparkSession, p: Params, prefix: str = "") -> list[str]:
        """Temporary views over every layer that has been built, for SQL text; returns their names.

        ``raw_trips`` and ``raw_zones`` (as landed), ``bronze_trips``,
        ``stg_zones``, ``int_taxi_trips_zones_joined`` (silver), the gold
        tables, ``ingestion_events`` and ``ingestion_ledger``.
        """
        def fact_and_dims():
            g = load_gold(spark, self, p)
            return {"fct_trips": g.fact, **{k: d.df for k, d in g.dims().items()}}

        layers = [lambda: {"raw_trips": self.raw(spark).read()},
                  lambda: {"raw_zones": spark.read.parquet(self.raw_zones), "stg_zones": zones_dim(spark, self).df},
                  lambda: {"bronze_trips": load_bronze(spark, self)},
                  lambda: {"int_taxi_trips_zones_joined": silver_trips(
                      load_bronze(spark, self), zones_dim(spark, self), p.max_broadcast_rows)},
                  fact_and_dims,
                  lambda: {"ingestion_events": Ledger(spark, self.events).events(),
                           "ingestion_ledger": Ledger(spark, self.events).state()}]
        names = []
        for layer in layers:
            try:
                views = layer()
            except publish.NotBuilt:
                continue
            except AnalysisException as e:
                if not is_missing(e):
                    raise
                continue  # not built yet
            for name, df in views.items():
                df.createOrReplaceTempView(prefix + name)
                names.append(prefix + name)
        return names


# ------------------------------------------------------------------ zones

def ingest_zones(spark: SparkSession, lake: Lake, csv_path: str | None = None,
                 zones: DataFrame | None = None) -> int:
    """Replace the zone lookup (K3). Returns its row count."""
    df = zones if zones is not None else read_zone_csv(spark, csv_path)
    layout.overwrite_table(df.select(*[f.name for f in schemas.ZONES_CSV.fields]), lake.raw_zones)
    return spark.read.parquet(lake.raw_zones).count()


def zones_dim(spark: SparkSession, lake: Lake) -> Dim:
    return Dim(bronze_zones(spark.read.schema(schemas.ZONES_CSV).parquet(lake.raw_zones)))


# ------------------------------------------------------------------ trips

def ingest_trips(spark: SparkSession, lake: Lake, files: list[str], ingest_ts: dt.datetime | None = None,
                 on_error: str = "failed", started: bool = False, run: str | None = None) -> dict[tuple[str, str], int]:
    """Land and type the given monthly files; returns rows per slice.

    ``on_error`` is the event that an unreadable file leaves with every slice:
    ``failed``, or ``aborted`` when another run without it follows.
    ``started`` slices were claimed before.

    Each touched slice of raw and bronze is replaced, so rerunning a slice
    (after a crash at any point) yields the same tables.
    """
    ledger, table = Ledger(spark, lake.events), lake.raw(spark)
    slices = sorted({parse_trip_file(f)[::-1] for f in files})   # (month, service)
    ledger.append(slices, ["processing"] if started else ["started", "processing"], run=run)
    try:
        table.write(trip_file_parts(spark, files, ingest_ts))
        raw = layout.read_slices(spark, lake.raw_trips, schemas.LANDING, slices=slices)
        # no column of the files is read for this: their footers tell the rows
        counts = {(r.source_month, r.service_type): r.n for r in
                  raw.groupBy(*layout.SLICE_KEYS).agg(F.count(F.lit(1)).alias("n")).collect()}
        empty = [s for s in slices if s not in counts]
        table.drop(empty)
        landed = [s for s in slices if s in counts]
        if landed:
            bronze = bronze_trips(layout.read_slices(spark, lake.raw_trips, schemas.LANDING, slices=landed))
            layout.write_slices(bronze, lake.bronze_trips, cluster="pickup_ts")
        layout.drop_slices(spark, lake.bronze_trips, empty)
        rows = {s: counts.get(s, 0) for s in slices}
        ledger.append(slices, "completed", rows=rows, run=run)
        return rows
    except Exception as e:
        ledger.append(slices, on_error if has_condition(e, UNREADABLE) else "failed", error=f"{type(e).__name__}: {e}", run=run)
        raise


def ingest_slice(spark: SparkSession, lake: Lake, landing_dir: str, service: str, month: str) -> dict[tuple[str, str], int]:
    """Ingest, or ingest again, the files of one service and month below ``landing_dir`` (B1)."""
    files = [f for f in landing_files(spark, landing_dir) if parse_trip_file(f) == (service, month)]
    if not files:
        raise FileNotFoundError(f"no {service} file for {month} below {landing_dir}")
    return ingest_trips(spark, lake, files)


def landing_files(spark: SparkSession, landing_dir: str) -> list[str]:
    """One path per monthly file or slice folder below ``landing_dir``."""
    return list_slices(spark, landing_dir)


#: How long a run holds the slices it has started, unless it ends before.
LEASE = dt.timedelta(hours=2)


def backfill(spark: SparkSession, lake: Lake, landing_dir: str, p: Params,
             isolate: bool = True, lease: dt.timedelta = LEASE) -> DataFrame:
    """Ingest every grid slice that is not completed, in one run (B2 + B3).

    The run claims the slices first, so of several backfills at once each
    slice goes to one. If a file cannot be read, the run is aborted, one job
    finds all such files (by footers, then, if a run still fails, by decoding
    them), their slices fail and the others are ingested together: however many
    files are bad, that is one more run, or two. The aborted runs are no
    retries. Other errors are raised. Returns the pending grid as it was before.
    """
    grid = generators.slice_grid(spark, p.grid_first_year, p.grid_last_year, schemas.GRID_SERVICES)
    ledger, run = Ledger(spark, lake.events), uuid.uuid4().hex
    todo = pending(grid, ledger.state())
    todo_set = {(r.year_month, r.service_type) for r in todo.collect()}  # at most the grid size
    files = [f for f in landing_files(spark, landing_dir) if parse_trip_file(f)[::-1] in todo_set]
    if not files:
        return todo
    claimed = set(ledger.claim(sorted({parse_trip_file(f)[::-1] for f in files}), run, lease))
    files = [f for f in files if parse_trip_file(f)[::-1] in claimed]
    probes = [False, True] if isolate else []
    started = True
    while files:
        try:
            ingest_trips(spark, lake, files, on_error="aborted" if probes else "failed", started=started, run=run)
            break
        except Exception as error:
            if not probes or not has_condition(error, UNREADABLE):
                raise
            bad = {}
            while probes and not bad:
                bad = unreadable(spark, files, whole=probes.pop(0))
            failed = sorted({parse_trip_file(f)[::-1] for f in bad})
            ledger.append(failed, "started", run=run)  # the attempt that the abort took back
            for f, why in bad.items():
                ledger.append([parse_trip_file(f)[::-1]], "failed", error=why, run=run)
            log.warning("backfill: %d of %d slices failed: %s", len(failed), len(claimed), failed)
            if not bad:
                raise
            files, started = [f for f in files if parse_trip_file(f)[::-1] not in failed], False
    return todo


# ------------------------------------------------------------------ silver / gold

def load_bronze(spark: SparkSession, lake: Lake) -> DataFrame:
    try:
        b = spark.read.parquet(lake.bronze_trips)
    except AnalysisException as e:
        if is_missing(e):
            raise publish.NotBuilt(
                f"no bronze trips under {lake.bronze_trips}: nothing has been ingested yet "
                "(are the landing files inside the backfill grid years?)") from e
        raise
    return b.select(*SILVER_COLUMNS)


def build_silver(spark: SparkSession, lake: Lake, p: Params) -> tuple[DataFrame, DataFrame]:
    """Silver as a view (lazy plan) plus its test results."""
    zones = zones_dim(spark, lake)
    silver = silver_trips(load_bronze(spark, lake), zones, p.max_broadcast_rows)
    silver.createOrReplaceTempView("int_taxi_trips_zones_joined")
    return silver, silver_checks(silver, zones, p.max_broadcast_rows)


def build_gold_tables(spark: SparkSession, lake: Lake, p: Params,
                      partition_dates: bool = False, trip_key: str = "rank",
                      months: list[str] | None = None) -> DataFrame:
    """Build, test and publish all gold tables; returns the test results.

    Tables are written as a new build and tested before a version names them
    (``plans.publish``). The dimensions come first: a violation in one of them
    raises ``Blocked`` and nothing is published (the fact does not wait for
    the vendor tests). Then the fact is written and tested; a violation, of
    the vendors too, raises ``Blocked`` and nothing is published.
    ``p.tolerated`` lists tests whose violations are only reported.

    ``trip_key``: ``"rank"`` (the reference's dense rank) or ``"hash"``
    (row-local digest). ``months`` builds only those months of the fact:
    bronze is read for them only (pickup month = file month in the fact), and
    the version takes all other months from the last one. Ranks of a month are
    counted through the whole fact when it is read. ``partition_dates`` lays
    the calendar out by month.
    """
    zones = zones_dim(spark, lake)
    bronze = load_bronze(spark, lake)
    if months:
        bronze = bronze.where(F.col("source_month").isin(list(months)))
    g = build_gold(spark, bronze, zones, p)
    build, root = publish.new_build(), lake.p("gold")

    def path(table: str) -> str:
        return publish.build_path(root, table, build)

    published = False
    try:
        layout.write_list_partitioned(g.dim_service_type.df, path("dim_service_type"))
        layout.write_list_partitioned(g.dim_payment_type.df, path("dim_payment_type"))
        layout.write_list_partitioned(g.dim_vendors.df, path("dim_vendors"))
        if partition_dates:
            layout.write_list_partitioned(g.dim_date.df, path("dim_date"), "year_month")
        else:
            layout.overwrite_table(g.dim_date.df, path("dim_date"))
        layout.write_hash_clustered(g.dim_zones.df, path("dim_zones"), "zone_key", 4)
        dims = dict.fromkeys(publish.DIMS, build)
        tested = _gold(spark, root, publish.Version(0, dims, {}, trip_key), p, with_fact=False)
        checks = gold_checks(tested, set(tested.dims()))
        results = checks.collect()  # one row per declared test
        if violated(results, p.tolerated, but=("dim_vendors",)):
            raise Blocked(results)
        keyed = with_trip_key(g.fact) if trip_key == "rank" else with_hash_trip_key(g.fact)
        layout.write_fact(keyed, path("fct_trips"))
        fact = spark.read.schema(keyed.schema).parquet(path("fct_trips")).select(*schemas.FACT_COLUMNS)
        results += gold_checks(replace(tested, fact=fact), {"fct_trips"}).collect()
        if violated(results, p.tolerated):
            raise Blocked(results)
        layout.write_fact(value_state(fact), path(publish.VALUES))
        present = publish.write_runs(fact, root, build, trip_key == "rank")
        publish.publish(spark, root, build, list(publish.DIMS), present, trip_key, only=months)
        published = True
    finally:
        if not published:
            for table in (*publish.DIMS, publish.FACT, publish.RUNS, publish.VALUES):
                layout.remove_table(spark, path(table))
    return spark.createDataFrame(results, checks.schema)


def run_all(spark: SparkSession, lake: Lake, landing_dir: str, p: Params,
            zones_csv: str | None = None, zones: DataFrame | None = None) -> dict[str, DataFrame]:
    """The whole flow in dependency order: zones, backfill of pending slices,
    silver and its tests, then gold and its tests. Returns the test tables;
    raises ``Blocked`` where violations hold back the next step (B5, B6)."""
    ingest_zones(spark, lake, zones_csv, zones)
    backfill(spark, lake, landing_dir, p)
    _, silver_tests = build_silver(spark, lake, p)
    silver_results = silver_tests.collect()      # small: one row per declared test
    if violated(silver_results, p.tolerated):
        raise Blocked(silver_results)
    gold_tests = build_gold_tables(spark, lake, p)
    return {"silver": spark.createDataFrame(silver_results, silver_tests.schema), "gold": gold_tests}


def load_gold(spark: SparkSession, lake: Lake, p: Params, with_fact: bool = True) -> Gold:
    """The gold tables of the last published version; all of one version."""
    root = lake.p("gold")
    return _gold(spark, root, publish.current(spark, root), p, with_fact)


def _gold(spark: SparkSession, root: str, version: publish.Version, p: Params, with_fact: bool = True) -> Gold:
    def dim(name, cols):
        return Dim(spark.read.parquet(publish.build_path(root, name, version.dims[name])).select(*cols))

    fact = publish.read_fact(spark, root, version).select(*schemas.FACT_COLUMNS) if with_fact else None
    return Gold(
        fact=fact,
        dim_date=dim("dim_date", ["date_key", "date", "year", "month", "month_name", "day",
                                  "day_of_week", "day_name", "year_month"]),
        dim_zones=dim("dim_zones", ["zone_key", "borough", "zone_name", "service_zone"]),
        dim_service_type=dim("dim_service_type", ["service_type_key", "service_type_name",
                                                  "service_type_code", "partition_group"]),
        dim_payment_type=dim("dim_payment_type", ["payment_type_key", "payment_type_name",
                                                  "partition_group"]),
        dim_vendors=dim("dim_vendors", ["vendor_key", "vendor_id", "vendor_name", "vendor_code",
                                        "vendor_group", "description", "partition_group"]),
        params=p)


def load_tables(spark: SparkSession, lake: Lake, p: Params) -> Tables:
    """Bronze and the last published version: the star and its value counts."""
    root = lake.p("gold")
    version = publish.current(spark, root)
    return Tables(bronze=load_bronze(spark, lake), gold=_gold(spark, root, version, p),
                  values=publish.read_values(spark, root, version))
