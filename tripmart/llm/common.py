"""Helpers shared by the corpus operators: tables, lineage cuts, Arrow row maps, hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import ensure_checkpoint_dir

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage behind ``df`` with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet below the session's checkpoint folder and read it back.

    Smaller on disk than a checkpoint when rows carry long binaries. The table
    lives as long as the checkpoint folder it lies in.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, schema: str, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
             slice_bytes: int | None = None) -> DataFrame:
    """``mapInArrow`` for functions that yield dicts of columns (lists or arrays)."""
    out = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(slices(batches, slice_bytes)):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type)
                 for c, f in ((cols[f.name], f) for f in arrow)], schema=arrow)
        give_back()

    return df.mapInArrow(run, out)


class Recent(dict):
    """Results of ``make`` by key. At most ``most`` keys are held, and as many of the time before
    them, from which a key that comes again is taken over; so frequent keys stay."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = out
        return out


#: Bytes of a batch that is handled at once in a Python worker; a single longer row is handled alone.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` (SLICE_BYTES), so that texts are not all unpacked at once."""
    for b in batches:
        step = max(1, b.num_rows * (size or SLICE_BYTES) // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def give_back() -> None:
    """Hand freed memory back to the system; Python workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


#: Marked rows (an id and a hash each) up to this count are broadcast, about 10 MB; more are joined by shuffle.
BROADCAST_MARKS = 200_000


def filter_rows(df: DataFrame, keep: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` of a function that only leaves out rows; all columns stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from keep(slices(batches))
        give_back()

    return df.mapInArrow(run, df.schema)


#: Estimated bytes up to which a frame is broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 16 << 20


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, marked for broadcast if its counted rows of about ``row_bytes`` fit. Cut its lineage first."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` has it (names do not tell case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_marked(docs: DataFrame, id_col: str, mark: Column, judged: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``judged`` (doc_id, mark, kept; one row per row) keeps, with all columns.

    ``mark`` is a function of the row's text that ``judged`` has too. Of rows
    with the same id and mark one stays if any is kept.
    """
    own, odd_id, odd_mark = (fresh(n, docs) for n in ("_mark", "_odd_id", "_odd_mark"))
    pairs = judged.groupBy("doc_id", "mark").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    odd = materialise(pairs.where("NOT kept OR n > 1"))
    again = odd.where("kept").select(F.col("doc_id").alias(odd_id), F.col("mark").alias(odd_mark))
    gone = odd.select(F.col("doc_id").alias(odd_id), F.col("mark").alias(odd_mark))
    same = F.col(id_col).eqNullSafe(F.col(odd_id)) & F.col(own).eqNullSafe(F.col(odd_mark))
    marked = docs.withColumn(own, mark)
    kept = marked.join(F.broadcast(gone) if gone.count() <= BROADCAST_MARKS else gone, same, "left_anti")
    if not again.isEmpty():
        kept = kept.union(marked.join(again, same, "left_semi").dropDuplicates([id_col, own]))
    return kept.drop(own)


def as_bytes(col: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return col.cast(pa.binary()).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a uint64 over all bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x
