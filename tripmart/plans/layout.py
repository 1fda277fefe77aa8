"""Sinks and table layout.

* slice tables (raw and bronze trips) are Parquet partitioned by
  ``(source_month, service_type)`` and written with dynamic partition
  overwrite: only the slices present in the frame are replaced (K2);
* the fact is partitioned by ``source_month``, which equals the pickup month
  of every fact row, i.e. a monthly range partitioning on pickup date (K5);
* small list-partitioned dimensions use ``partition_group`` (K8), zones are
  hash-clustered into 4 files on ``zone_key`` (K7);
* full replacement is a static overwrite (K3); the gold tables are replaced
  together, by ``plans.publish``; CSV export keeps a header (K10).

The fact write goes through a ``rebalance`` hint: its rows arrive hashed on
the trip key, so AQE regroups them by month, splitting a hot month over
several tasks and merging small ones (no single huge task, no file
explosion). Slice writes need no shuffle: their input is slice-aligned.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.plans.commits import is_missing

SLICE_KEYS = ("source_month", "service_type")


def _rebalanced(df: DataFrame, *cols: str) -> DataFrame:
    return df.hint("rebalance", *cols)


def write_slices(df: DataFrame, path: str, keys=SLICE_KEYS, rebalance: bool = False, cluster: str | None = None) -> None:
    """Replace exactly the slices present in ``df`` (idempotent).

    Monthly files (and the raw table) hold one slice per file, so each input
    split already writes into a single slice folder with a well-sized file:
    no shuffle is needed. Pass ``rebalance=True`` for input whose rows are
    spread over many slices per task. With ``cluster`` each file is in the
    order of that column (a sort inside the tasks), so that row groups span
    little of it and a filter on it skips most, whatever the order of arrival.
    """
    out = _rebalanced(df, *keys) if rebalance else df
    out = out.sortWithinPartitions(*keys, cluster) if cluster else out
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


def slice_path(path: str, slice_: tuple[str, str], keys=SLICE_KEYS) -> str:
    return path.rstrip("/") + "/" + "/".join(f"{k}={v}" for k, v in zip(keys, slice_))


def drop_slices(spark: SparkSession, path: str, slices: list[tuple[str, str]], keys=SLICE_KEYS) -> None:
    """Empty the given slices: a dynamic overwrite with zero rows for a slice
    leaves its old files in place, so each slice folder is overwritten with an
    empty frame of the table's data columns."""
    if not slices:
        return
    try:
        table_schema = spark.read.parquet(path).schema
    except AnalysisException as e:
        if is_missing(e):
            return
        raise
    empty = spark.createDataFrame([], T.StructType([f for f in table_schema if f.name not in keys]))
    for s in slices:
        empty.write.mode("overwrite").parquet(slice_path(path, s, keys))


def read_slices(spark: SparkSession, path: str, schema=None, slices=None,
                keys=SLICE_KEYS) -> DataFrame:
    """Read a slice table, optionally only some slices (partition pruning)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    if slices:
        # One IN over a key built from partition columns only: a partition
        # filter (pruned at planning), and cheap to plan for many slices,
        # unlike a long chain of ORs.
        wanted = sorted({f"{s[0]}|{s[1]}" for s in slices})
        df = df.where(F.concat_ws("|", F.col(keys[0]), F.col(keys[1])).isin(wanted))
    return df


def overwrite_table(df: DataFrame, path: str) -> None:
    """Full replace (delete all, then insert)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_fact(fact: DataFrame, path: str) -> None:
    """Monthly partitions of the fact, as a whole (static overwrite)."""
    (_rebalanced(fact, "source_month").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("source_month").parquet(path))


def write_list_partitioned(df: DataFrame, path: str, col: str = "partition_group") -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(col).parquet(path))


def write_hash_clustered(df: DataFrame, path: str, col: str, buckets: int = 4) -> None:
    """``buckets`` files, rows placed by hash of ``col`` (HASH modulus 4)."""
    df.repartition(buckets, col).write.mode("overwrite").parquet(path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders in ``path``; none if there is no such path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().toString() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []


def remove_table(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def materialise(df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """K4: ``table`` writes Parquet and reads it back; ``view`` registers a temp view."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table" or path is None:
        raise ValueError("kind must be 'view', or 'table' with a path")
    overwrite_table(df, path)
    out = df.sparkSession.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out
