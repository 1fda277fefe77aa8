"""File sources: monthly trip files (S1, S2), zone CSV (S3), generic CSV.

Monthly trip files are named ``{service}_tripdata_{yyyy-MM}.parquet``. Their
column types drift from month to month (a count stored as long one month and
double the next), and one multi-file read over drifting footers fails. Files
are therefore read per service, in few groups (one when their footers merge);
each group is one read, harmonised and cast to the declared landing schema.
Groups are unioned where a common type keeps all their values exactly. The
number of plan leaves follows the changes of schema, not the files.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.functions.columns import nulls_to_none, ntz_lit
from tripmart.operators.harmonise import conform, harmonise
from tripmart.operators.widen import merge
from tripmart.plans.commits import UNMERGEABLE, UNREADABLE, conditions, has_condition

TRIP_FILE_RE = r"(yellow|green)_tripdata_(\d{4}-\d{2})\.parquet"
# Landing folders may also be laid out Hive-style: service_type=X/source_month=Y/part-*.
HIVE_RE = r"service_type=(yellow|green)/source_month=(\d{4}-\d{2})(?:/|$)"
# Where landing files may lie below the landing folder.
LANDING_GLOBS = ["*_tripdata_*.parquet", "*/*_tripdata_*.parquet", "*/*/*_tripdata_*.parquet",
                 "service_type=*/source_month=*"]


def list_slices(spark: SparkSession, root: str) -> list[str]:
    """Paths of the monthly files, or of the slice folders, below ``root``.

    A listing of names: one entry per slice however many part files it has.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath().toString() for g in LANDING_GLOBS for f in fs.globStatus(path(f"{root.rstrip('/')}/{g}")) or ()]
    return sorted(p for p in found if parse_trip_file(p))


def parse_trip_file(path: str) -> tuple[str, str] | None:
    """(service_type, year_month) encoded in a landing file path."""
    import re

    m = re.search(TRIP_FILE_RE, path) or re.search(HIVE_RE, path)
    return (m.group(1), m.group(2)) if m else None


def _path_part(group: int):
    path = F.col("_metadata.file_path")
    named = F.regexp_extract(path, TRIP_FILE_RE, group)
    return F.when(named != "", named).otherwise(F.regexp_extract(path, HIVE_RE, group))


def schema_groups(spark: SparkSession, service: str, files: list[str]):
    """Paths of one service split into groups that one read can take.

    Returns ``(paths, schema)`` pairs. Normally that is a single
    ``mergeSchema`` read (Spark merges the footers in a distributed job);
    columns added in later months simply come back NULL for older files. If
    the footers cannot be merged (a column changed type, or two spellings of
    a name), the paths, in order of month, are halved until each part can:
    a few reads for every change of type, none per file.
    """
    files = sorted(files, key=lambda p: parse_trip_file(p)[1])
    try:
        return [(files, spark.read.option("mergeSchema", "true").parquet(*files).schema)]
    except Exception as e:
        if len(files) == 1 or not (has_condition(e, UNMERGEABLE) or has_condition(e, "COLUMN_ALREADY_EXISTS")):
            raise
    half = len(files) // 2
    return [*schema_groups(spark, service, files[:half]), *schema_groups(spark, service, files[half:])]


def trip_file_parts(spark: SparkSession, paths: list[str], ingest_ts=None) -> list[tuple[DataFrame, list[tuple[str, str]]]]:
    """Monthly trip files in the landing layout, as few frames as their types allow, with the slices of each.

    The declared columns come first; all other columns of the files follow.
    Files go together where one type holds all values of a column exactly; the
    files of one slice always do. ``source_month`` and ``service_type`` come
    from each row's file path (``_metadata.file_path``), so one read serves
    many files.
    """
    by_service: dict[str, list[str]] = defaultdict(list)
    for p in paths:
        parsed = parse_trip_file(p)
        if parsed is None:
            raise ValueError(f"not a monthly trip file name: {p}")
        by_service[parsed[0]].append(p)

    parts: list[tuple[list[DataFrame], T.StructType, set]] = []
    for service, service_files in sorted(by_service.items()):
        for files, schema in schema_groups(spark, service, service_files):
            df = harmonise(spark.read.schema(schema).parquet(*files), service)
            df = df.withColumns({
                "ingest_ts": F.localtimestamp() if ingest_ts is None else ntz_lit(ingest_ts),
                "source_month": _path_part(2),
                "service_type": _path_part(1),
            })
            df = conform(df, schemas.LANDING, keep_extra=True)
            frames, common, slices = [df], df.schema, {parse_trip_file(f)[::-1] for f in files}
            apart = []
            for other in parts:
                merged, exact = merge(common, other[1])
                if exact or slices & other[2]:
                    frames, common, slices = other[0] + frames, merged, slices | other[2]
                else:
                    apart.append(other)
            parts = [*apart, (frames, common, slices)]
    return [(union_as(frames, common), sorted(slices)) for frames, common, slices in parts]


def read_trip_files(spark: SparkSession, paths: list[str], ingest_ts=None) -> DataFrame:
    """Monthly trip files as one frame in the landing layout, each column of the widest type it has."""
    parts = [df for df, _ in trip_file_parts(spark, paths, ingest_ts)]
    if not parts:
        return spark.createDataFrame([], schemas.LANDING)
    return union_as(parts, reduce(lambda a, b: merge(a, b)[0], [p.schema for p in parts]))


def union_as(parts: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Union of all parts by name, cast to ``schema``; columns that a part lacks are NULL there."""
    def cast(df: DataFrame) -> DataFrame:
        have = {f.name.lower(): f.name for f in df.schema.fields}
        return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
                           .cast(f.dataType).alias(f.name) for f in schema.fields])

    return reduce(DataFrame.unionByName, map(cast, parts))


def unreadable(spark: SparkSession, paths: list[str], whole: bool = False) -> dict[str, str]:
    """Those of ``paths`` (files or slice folders) that hold a file which cannot be read, and why.

    One job opens every file on the executors, passing over those that fail.
    It reads the footers, or with ``whole`` decodes every column; a file that
    then gives fewer rows than its footer tells is unreadable. Files whose
    footer gave no row are empty or unreadable: those alone are opened one
    folder at a time.
    """
    footers = _rows_by_file(spark, paths, T.StructType([T.StructField("_no_such_column", T.IntegerType())]))
    bad = {}
    if whole:
        for service in sorted({parse_trip_file(p)[0] for p in paths}):
            for files, schema in schema_groups(spark, service, [p for p in paths if parse_trip_file(p)[0] == service]):
                decoded = _rows_by_file(spark, files, schema)
                for path in files:
                    short = [f for f in part_files(spark, path) if decoded.get(f, 0) < footers.get(f, 0)]
                    bad.update({path: f"{short[0]} gave {decoded.get(short[0], 0)} of {footers[short[0]]} rows"} if short else {})
        return bad
    for path in (p for p in paths if not footers.keys() >= set(part_files(spark, p))):
        try:
            spark.read.option("mergeSchema", "true").parquet(path).schema
        except Exception as e:
            if not has_condition(e, UNREADABLE, "UNABLE_TO_INFER_SCHEMA"):
                raise
            bad[path] = f"{path}: {', '.join(conditions(e))}"
    return bad


def _rows_by_file(spark: SparkSession, paths: list[str], schema: T.StructType) -> dict[str, int]:
    """Rows that each file gives, all columns of ``schema`` decoded, until the first that cannot be read."""
    df = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths)
    rows = df.select(F.col("_metadata.file_path").alias("file"), F.xxhash64(*[F.col(f"`{c}`") for c in schema.names]).alias("hash"))
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.max("hash"))
    return {_plain(r.file): r.n for r in counts.collect()}  # a row for each file


def _plain(path: str) -> str:
    """A path without scheme, authority and escapes."""
    return unquote(urlparse(path).path)


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The data files at a path or in its folder, without scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return [_plain(f.getPath().toString()) for f in found
            if f.isFile() and not f.getPath().getName().startswith(("_", "."))]


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with header; pandas' default NA strings become NULL.

    'Unknown' is a real borough value and is kept.
    """
    raw = (spark.read.option("header", True).option("nullValue", None)
           .schema("LocationID string, Borough string, Zone string, service_zone string")
           .csv(path))
    return normalise_zone_strings(raw)


def normalise_zone_strings(df: DataFrame) -> DataFrame:
    tokens = schemas.PANDAS_NA_TOKENS
    return df.select(
        F.trim(nulls_to_none(F.col("LocationID").cast("string"), tokens)).try_cast("int").alias("LocationID"),
        nulls_to_none("Borough", tokens).alias("Borough"),
        nulls_to_none("Zone", tokens).alias("Zone"),
        nulls_to_none("service_zone", tokens).alias("service_zone"),
    )


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Generic CSV with a header (S4). Pass a schema for a typed read."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)
