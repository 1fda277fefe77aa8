"""Global DENSE_RANK over many columns without a single-task window.

``DENSE_RANK() OVER (ORDER BY k1..kn)`` with no PARTITION BY makes Spark
move the whole table into one task. Here the rows are read once and none is
joined back:

1. range-partition the rows on the order and a row tie-break, so a key that a
   third of all rows share spreads over several partitions;
2. rank inside each partition (a window over the partition's number), and cut
   lineage with a reliable ``checkpoint()``, so that the partitions stay as
   they are even if an executor is lost and tasks rerun;
3. the first key, last key and number of keys of every partition (one row
   each) give its offset: the keys of the partitions before it, less one for
   each partition that begins with the key that the one before ends with;
4. rank = offset + rank inside the partition; the offsets, one row for each
   partition, are broadcast.

The tie-break is the row's place in its task after a sort by the hash of all
its columns. A task that is run again finds the same rows, whatever their
order, and gives them the same places (but for rows that are equal in full),
so it sends each to the partition it went to before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import ensure_checkpoint_dir


def partition_ranks(df: DataFrame, order_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``_part``, a number that follows the order, and ``_local``, the dense rank among its rows."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    placed = (df.withColumn("_tie", F.xxhash64(*df.columns)).sortWithinPartitions("_tie")
              .withColumn("_tie", F.monotonically_increasing_id()))
    ranged = placed.repartitionByRange(n, *order, "_tie").withColumn("_part", F.spark_partition_id()).drop("_tie")
    local = F.dense_rank().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_local", local.cast("bigint"))


def with_dense_rank(df: DataFrame, order_cols: list[str], rank_col: str = "rank",
                    num_partitions: int | None = None) -> DataFrame:
    """``df`` with the dense rank of its ``order_cols``, NULLs last."""
    ensure_checkpoint_dir(df.sparkSession)
    ranked = partition_ranks(df, order_cols, num_partitions).checkpoint(eager=True)
    key = F.struct(*order_cols)
    parts = ranked.groupBy("_part").agg(
        F.max("_local").alias("_keys"), F.min_by(key, "_local").alias("_first"), F.max_by(key, "_local").alias("_last"))
    # one row a partition: these windows are as small as the list of partitions
    by_part = Window.orderBy("_part")
    joined = parts.withColumn("_off_less", F.coalesce(
        F.lag("_last").over(by_part).eqNullSafe(F.col("_first")) & (F.lag("_part").over(by_part).isNotNull()), F.lit(False)).cast("int"))
    offsets = joined.select("_part", (F.sum(F.col("_keys") - F.col("_off_less")).over(by_part) - F.col("_keys")).alias("_off"))
    return ranked.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_off") + F.col("_local")).alias(rank_col))
