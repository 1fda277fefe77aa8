"""Published versions of the gold star.

A build writes every table into a folder of its own (``<table>/build=<id>``)
and nothing else. Publishing is one commit that names, for one version of the
star, the build of each dimension and of each month of the fact; readers
resolve the last commit and read all six tables as it names them. So tables
never mix versions, a crash at any step leaves the version before, and nothing
is deleted or renamed. ``vacuum`` removes builds that no recent version names.

Trip keys of a rank build are dense ranks over all columns of the key order,
which begins with the vendor and the pickup time; a fact row's month is that
of its pickup. So the keys of a vendor's month are neighbours, and a build of
some months can rank them alone: for each (month, vendor) it keeps a *run*,
its first rank and number of keys. The rank in the whole fact is the rank in
the build, moved by the difference between the keys before the run in the fact
and in the build. The running total over all runs, in key order, gives that;
no other month's trips are read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.plans import layout
from tripmart.plans.commits import CommitLog

FACT, RUNS, VALUES = "fct_trips", "fct_trips_runs", "fct_trips_values"
DIMS = ("dim_date", "dim_zones", "dim_service_type", "dim_payment_type", "dim_vendors")
RUN_SCHEMA = "source_month string, vendor_id int, first bigint, keys bigint"
#: Runs whose moves are looked up in a literal; more are joined.
LITERAL_RUNS = 10_000


class NotBuilt(RuntimeError):
    """A layer that is read before it has been built."""


@dataclass(frozen=True)
class Version:
    number: int
    dims: dict[str, str]     # dimension -> build
    months: dict[str, str]   # fact month -> build
    trip_key: str            # "rank" or "hash"
    whole: bool = True       # all months are of one build that ranked them together


def new_build() -> str:
    return uuid.uuid4().hex


def build_path(root: str, table: str, build: str) -> str:
    return f"{root}/{table}/build={build}"


def log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/_versions")


def _version(number: int, content: dict) -> Version:
    return Version(number, content["dims"], content["months"], content["trip_key"], content["whole"])


def current(spark: SparkSession, root: str) -> Version:
    number, content = log(spark, root).latest()
    if content is None:
        raise NotBuilt(f"no gold tables have been published under {root}")
    return _version(number, content)


def publish(spark: SparkSession, root: str, build: str, dims: list[str], months: list[str], trip_key: str,
            only: list[str] | None = None) -> Version:
    """Commit a version with ``build`` for ``dims`` and the fact's ``months``.

    With ``only``, other months than these stay as the last version has them,
    whichever writer committed it.
    """
    def change(last: dict | None) -> dict:
        kept = {m: b for m, b in (last or {"months": {}})["months"].items() if m not in only} if only is not None else {}
        if kept and last["trip_key"] != trip_key:
            raise ValueError(f"the published fact has trip_key={last['trip_key']!r}; months of it cannot have {trip_key!r}")
        return {"dims": {**(last or {"dims": {}})["dims"], **dict.fromkeys(dims, build)},
                "months": {**kept, **dict.fromkeys(months, build)}, "trip_key": trip_key, "whole": only is None}

    return _version(*log(spark, root).update(change))


def write_runs(fact: DataFrame, root: str, build: str, ranked: bool) -> list[str]:
    """Keep the runs of a build's written ``fact`` (its months alone without ranks); returns its months."""
    spark = fact.sparkSession
    by = fact.groupBy("source_month", F.col("vendor_id").cast("int").alias("vendor_id"))
    runs = by.agg(F.min("trip_key").cast("bigint").alias("first"), (F.max("trip_key") - F.min("trip_key") + 1).cast("bigint").alias("keys")) \
        if ranked else fact.groupBy("source_month").agg(F.lit(None).cast("int").alias("vendor_id"), F.lit(None).cast("bigint").alias("first"),
                                                         F.lit(None).cast("bigint").alias("keys"))
    runs.coalesce(1).write.parquet(build_path(root, RUNS, build))
    return sorted(r.source_month for r in spark.read.schema(RUN_SCHEMA).parquet(build_path(root, RUNS, build))
                  .select("source_month").distinct().collect())


def read_values(spark: SparkSession, root: str, version: Version) -> DataFrame:
    """The value counts of a version's months (``gold.value_state``), in one scan."""
    if not version.months:
        raise NotBuilt(f"the published fact under {root} has no month")
    if version.whole:
        return spark.read.parquet(build_path(root, VALUES, *set(version.months.values())))
    return spark.read.option("basePath", f"{root}/{VALUES}").parquet(
        *[f"{build_path(root, VALUES, b)}/source_month={m}" for m, b in sorted(version.months.items())]).drop("build")


def read_runs(spark: SparkSession, root: str, version: Version) -> DataFrame:
    """The runs of a version's months, and ``move``: what to add to a rank of the build for the rank in the fact."""
    by_build: dict[str, list[str]] = {}
    for month, build in version.months.items():
        by_build.setdefault(build, []).append(month)
    runs = reduce(DataFrame.unionByName, [
        spark.read.schema(RUN_SCHEMA).parquet(build_path(root, RUNS, b)).where(F.col("source_month").isin(months))
        for b, months in sorted(by_build.items())])
    # a row for each month and vendor of the fact
    before = F.sum("keys").over(Window.orderBy("vendor_id", "source_month")) - F.col("keys")
    return runs.withColumn("move", before + 1 - F.col("first"))


def read_fact(spark: SparkSession, root: str, version: Version) -> DataFrame:
    """The fact of a version, in one scan; trip keys of rank builds count through the whole fact."""
    if not version.months:
        raise NotBuilt(f"the published fact under {root} has no month")
    if version.whole:
        return spark.read.parquet(build_path(root, FACT, *set(version.months.values())))
    months = [f"{build_path(root, FACT, b)}/source_month={m}" for m, b in sorted(version.months.items())]
    fact = spark.read.option("basePath", f"{root}/{FACT}").parquet(*months).drop("build")
    if version.trip_key != "rank":
        return fact
    runs = read_runs(spark, root, version)
    moved = runs.where("move <> 0").limit(LITERAL_RUNS + 1).collect()
    columns = fact.columns
    if len(moved) > LITERAL_RUNS:
        to = runs.select(F.col("source_month").alias("_month"), F.col("vendor_id").alias("_vendor"), "move")
        joined = fact.join(to, (F.col("source_month") == F.col("_month")) & (F.col("vendor_id") == F.col("_vendor")))
        return joined.withColumn("trip_key", F.col("trip_key") + F.col("move")).select(*columns)
    if not moved:
        return fact
    # a literal, so that queries without the trip key carry nothing of this
    by_month: dict[str, list] = {}
    for r in moved:
        by_month.setdefault(r.source_month, []).extend([F.lit(r.vendor_id), F.lit(r.move)])
    moves = F.create_map(*[x for m, vendors in sorted(by_month.items()) for x in (F.lit(m), F.create_map(*vendors))])
    move = F.coalesce(moves[F.col("source_month")][F.col("vendor_id").cast("int")], F.lit(0))
    return fact.withColumn("trip_key", F.col("trip_key") + move).select(*columns)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete builds that none of the last ``keep`` versions names; returns their folders.

    Builds that are being written are not told from left ones: run it when
    nothing is building.
    """
    commits = log(spark, root)
    used = set()
    for n in commits.numbers()[-keep:]:
        content = json.loads(commits.text(n))
        used |= set(content["dims"].values()) | set(content["months"].values())
    gone = [f for t in (*DIMS, FACT, RUNS, VALUES) for f in layout.folders(spark, f"{root}/{t}") if f.rpartition("build=")[2] not in used]
    for f in gone:
        layout.remove_table(spark, f)
    return gone
