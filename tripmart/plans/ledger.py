"""Ingestion ledger: per-slice status as an append-only event log.

The reference keeps one mutable row per (year_month, service_type). Here
every status change is an appended event; the current state is derived:

* ``status``: the latest event (``max_by`` on the event time, then an event
  order so a completion written in the same microsecond wins);
* ``started_at`` / ``completed_at``: latest start / completion;
* ``rows_ingested``: from the latest completion;
* ``error_message``: from the latest failure, only while failed;
* ``retry_count``: start events minus one (counted once per attempt), without aborted ones;
* ``created_at`` / ``updated_at``: first and last event.

Writers append data first and the ledger event last, so a crash leaves a
slice "started" and it is redone when its lease has run out (slice writes are
idempotent).

Events lie in numbered commits (``plans.commits``), so several writers can
append at once and none of them loses an event. A run claims slices by a
commit that is only made if nobody wrote since it looked: of two runs that
want a slice at the same time, one gets it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.plans.commits import CommitLog

# An aborted attempt is one that another slice's file broke: it is not the slice's failure.
EVENT_ORDER = {"started": 1, "processing": 2, "aborted": 3, "failed": 4, "completed": 5}


def _order_col() -> F.Column:
    e = F.col("event")
    expr = None
    for k, v in EVENT_ORDER.items():
        expr = F.when(e == k, v) if expr is None else expr.when(e == k, v)
    return expr.otherwise(0)


def state(events: DataFrame) -> DataFrame:
    ev = events.withColumn("_ord", F.struct("event_ts", _order_col().alias("o")))
    ev_is = lambda name: F.col("event") == name
    return ev.groupBy("year_month", "service_type").agg(
        F.max_by("event", "_ord").alias("status"),
        F.max(F.when(ev_is("started"), F.col("event_ts"))).alias("started_at"),
        F.max(F.when(ev_is("completed"), F.col("event_ts"))).alias("completed_at"),
        F.max_by(F.col("rows_ingested"), F.when(ev_is("completed"), F.col("_ord"))).alias("rows_ingested"),
        F.max_by(F.col("error_message"), F.when(ev_is("failed"), F.col("_ord"))).alias("_last_error"),
        F.greatest(F.count_if(ev_is("started")) - F.count_if(ev_is("aborted")) - 1, F.lit(0))
        .cast("int").alias("retry_count"),
        F.min("event_ts").alias("created_at"),
        F.max("event_ts").alias("updated_at"),
    ).select(
        "year_month", "service_type", "status", "started_at", "completed_at",
        F.col("rows_ingested").cast("int").alias("rows_ingested"),
        F.when(F.col("status") == "failed", F.col("_last_error")).alias("error_message"),
        "retry_count", "created_at", "updated_at")


def pending(grid: DataFrame, st: DataFrame) -> DataFrame:
    """Slices of the grid that are not completed (anti join)."""
    done = st.where(F.col("status") == "completed").select("year_month", "service_type")
    return grid.join(done, ["year_month", "service_type"], "left_anti")


def coverage(grid: DataFrame, st: DataFrame) -> DataFrame:
    """Every grid slice with its status ('pending' when never started)."""
    return (grid.join(st, ["year_month", "service_type"], "left")
            .select("year_month", "service_type",
                    F.coalesce("status", F.lit("pending")).alias("status"),
                    F.coalesce("rows_ingested", F.lit(0)).alias("rows_ingested")))


class Ledger:
    """Append-only event log: commits of JSON lines below ``path``. Times are UTC.

    ``compact`` gathers all commits so far into one Parquet folder and notes in
    a commit of its own up to which number it goes; later ones are read beside
    it. Gathered commits stay until they are deleted by hand.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, self.path)
        self.gathered = CommitLog(spark, f"{self.path}/_gathered")

    def append(self, slices: list[tuple[str, str]], event, rows: dict | None = None, error: str | None = None,
               at: dt.datetime | None = None, run: str | None = None) -> None:
        """Append one event (or several, in order, as one commit) per slice."""
        if not slices:
            return
        number = self._last() + 1
        while not self.log.create(number, self._lines(slices, event, rows, error, at, run)):
            number += 1

    @staticmethod
    def _lines(slices, event, rows=None, error=None, at=None, run=None) -> str:
        events = [event] if isinstance(event, str) else list(event)
        ts = (at or _now()).isoformat(timespec="microseconds")
        return "".join(json.dumps({"year_month": m, "service_type": s, "event": e, "event_ts": ts,
                                   "rows_ingested": (rows or {}).get((m, s)), "error_message": error, "run_id": run}) + "\n"
                       for e in events for m, s in slices)

    def _last(self) -> int:
        return max([*self.log.numbers()[-1:], self.gathered.latest()[0]])

    def events(self, up_to: int | None = None) -> DataFrame:
        """All events, or those of the commits up to a number."""
        gathered, content = self.gathered.latest()
        later = [self.log.path_of(n) for n in self.log.numbers() if n > gathered and (up_to is None or n <= up_to)]
        parts = [self.spark.read.schema(schemas.CHECKPOINT_EVENTS).parquet(content["folder"])] if gathered else []
        if later:
            parts.append(self.spark.read.schema(schemas.CHECKPOINT_EVENTS).json(later))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schemas.CHECKPOINT_EVENTS)

    def state(self) -> DataFrame:
        return state(self.events())

    def claim(self, wanted: list[tuple[str, str]], run: str, lease: dt.timedelta,
              now: dt.datetime | None = None) -> list[tuple[str, str]]:
        """Start those of ``wanted`` that are neither completed nor held by another run, and return them.

        A run holds a slice from its start until its last event there is a
        completion, a failure or older than ``lease``.
        """
        while True:
            number, since = self._last(), (now or _now()) - lease
            latest = self.events(number).groupBy("year_month", "service_type").agg(
                F.max_by(F.struct("event", "event_ts", "run_id"), F.struct("event_ts", _order_col())).alias("last"))
            taken = {(r.year_month, r.service_type) for r in latest.collect()  # at most a row for each slice
                     if r.last.event == "completed"
                     or r.last.event in ("started", "processing") and r.last.event_ts > since and r.last.run_id != run}
            free = [s for s in wanted if s not in taken]
            if not free or self.log.create(number + 1, self._lines(free, "started", at=now, run=run)):
                return free

    def compact(self) -> int:
        """Gather all commits so far in one Parquet folder. Returns the event count."""
        number = self._last()
        folder = f"{self.path}/_gathered/events-{uuid.uuid4().hex}"
        self.events(number).coalesce(1).write.parquet(folder)
        if number:
            self.gathered.create(number, json.dumps({"folder": folder}))  # another run may have gathered as far
        return self.events().count()


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
