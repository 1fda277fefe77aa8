"""Command line: ``spark-submit -m tripmart <command>`` or ``python -m tripmart``.

Commands
  ingest-zones --lake L --zones-csv Z          replace the zone lookup
  backfill     --lake L --landing D            ingest every pending slice
  ingest       --lake L FILE...                ingest (or re-ingest) given files
  ingest       --lake L --landing D --service S --month M
                                               ... or those of one service and month
  build-silver --lake L                        silver view + its tests
  build-gold   --lake L [--trip-key hash] [--months 2024-01,2024-02]
                                               gold tables + their tests, or some months
  vacuum       --lake L [--keep 2]             delete builds that no recent version names
  compact      --lake L                        gather the ledger's commits in one folder
  run-all      --lake L --landing D --zones-csv Z
  status       --lake L                        ledger state per slice
  query        --lake L NAME [--out PATH]      run a business query (or 'list')
  sql          --lake L "SELECT ..."           SQL text over views of all layers

Results are printed whole, tab-separated, or written as CSV with --out.
build-silver, build-gold and run-all exit with 1 when a declared test finds
violations; gold tables are then not published.

Parameters default to the reference's (year 2024, calendar 2022-2025,
backfill grid 2022-2025, HAVING 1000/10/100); override with --year,
--calendar-start/--calendar-end, --grid-first-year/--grid-last-year.
The session's own settings (master, spark.checkpoint.dir, ...) are used as
given by spark-submit.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def _params(a):
    from tripmart.params import REFERENCE

    kw = {}
    if a.year:
        kw["year"] = a.year
    if a.calendar_start:
        kw["calendar_start"] = dt.date.fromisoformat(a.calendar_start)
    if a.calendar_end:
        kw["calendar_end"] = dt.date.fromisoformat(a.calendar_end)
    if a.grid_first_year:
        kw["grid_first_year"] = a.grid_first_year
    if a.grid_last_year:
        kw["grid_last_year"] = a.grid_last_year
    return REFERENCE.with_(**kw)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tripmart")
    ap.add_argument("command")
    ap.add_argument("args", nargs="*")
    ap.add_argument("--lake", required=True)
    ap.add_argument("--landing")
    ap.add_argument("--zones-csv")
    ap.add_argument("--out")
    ap.add_argument("--year", type=int)
    ap.add_argument("--calendar-start")
    ap.add_argument("--calendar-end")
    ap.add_argument("--grid-first-year", type=int, help="backfill grid start (default 2022)")
    ap.add_argument("--grid-last-year", type=int, help="backfill grid end (default 2025)")
    ap.add_argument("--trip-key", choices=["rank", "hash"], default="rank")
    ap.add_argument("--service", choices=["yellow", "green"])
    ap.add_argument("--month", help="yyyy-MM")
    ap.add_argument("--months", help="comma-separated yyyy-MM months to rebuild")
    ap.add_argument("--keep", type=int, default=2, help="published versions to keep (vacuum)")
    ap.add_argument("--lease-minutes", type=float, default=120, help="how long a backfill holds the slices it started")
    ap.add_argument("--input-bytes", type=int, help="input size, to size partitions")
    ap.add_argument("--total-cores", type=int, help="executor cores in the cluster")
    a = ap.parse_intermixed_args(argv)

    from tripmart.plans import jobs, publish
    from tripmart.plans import queries as Q
    from tripmart.plans.checks import Blocked, violated
    from tripmart.plans.ledger import Ledger
    from tripmart.session import ensure_checkpoint_dir, get_spark, scale_settings

    extra = scale_settings(a.input_bytes or 0, a.total_cores or 1) if a.input_bytes or a.total_cores else None
    spark = get_spark(extra=extra)
    ensure_checkpoint_dir(spark)
    lake, p = jobs.Lake(a.lake), _params(a)

    def show(df, name=None):
        if a.out:
            out = f"{a.out.rstrip('/')}/{name}" if name else a.out
            df.write.mode("overwrite").option("header", True).csv(out)
        else:
            print("\t".join(df.columns))
            for row in df.toLocalIterator():
                print("\t".join("" if v is None else str(v) for v in row))

    cmd = a.command
    if cmd == "ingest-zones":
        print(jobs.ingest_zones(spark, lake, a.zones_csv))
    elif cmd == "backfill":
        show(jobs.backfill(spark, lake, a.landing, p, lease=dt.timedelta(minutes=a.lease_minutes)))
    elif cmd == "ingest":
        if a.args:
            print(jobs.ingest_trips(spark, lake, a.args))
        else:
            print(jobs.ingest_slice(spark, lake, a.landing, a.service, a.month))
    elif cmd == "build-silver":
        tests = jobs.build_silver(spark, lake, p)[1]
        show(tests)
        return int(violated(tests.collect(), p.tolerated))
    elif cmd in ("build-gold", "run-all"):
        months = a.months.split(",") if a.months else None
        try:
            done = (jobs.run_all(spark, lake, a.landing, p, zones_csv=a.zones_csv) if cmd == "run-all"
                    else {"gold": jobs.build_gold_tables(spark, lake, p, trip_key=a.trip_key, months=months)})
        except Blocked as e:
            print(f"not published: {e}", file=sys.stderr)
            return 1
        for name, df in done.items():
            print(name)
            show(df, name)
    elif cmd == "sql":
        lake.register(spark, p)
        show(spark.sql(a.args[0]))
    elif cmd == "vacuum":
        print("\n".join(publish.vacuum(spark, lake.p("gold"), a.keep)))
    elif cmd == "compact":
        print(Ledger(spark, lake.events).compact())
    elif cmd == "status":
        show(Ledger(spark, lake.events).state().orderBy("year_month", "service_type"))
    elif cmd == "query":
        extra = {"q06b_time_block_summary": Q.q06b_time_block_summary,
                 "q21_column_metadata": Q.q21_column_metadata, "q22_fact_sample": Q.q22_fact_sample}
        registry = {**Q.QUERIES, **extra}
        if not a.args or a.args[0] == "list":
            print("\n".join(sorted(registry)))
        else:
            show(registry[a.args[0]](jobs.load_tables(spark, lake, p)))
    else:
        ap.error(f"unknown command {cmd}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
