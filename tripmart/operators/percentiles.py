"""Exact grouped PERCENTILE_CONT that stays bounded when one group is huge.

Spark's ``percentile`` aggregate keeps a value -> count hash map per group
and merges a group's maps in one task, without spilling. When one borough
holds most trips, that task holds all of its distinct values. Here:

1. value counts per (group, value), map-side combined;
2. range-partition them on (group, value) so a hot group is spread over many
   partitions, tag rows with their partition and cut lineage with a reliable
   ``checkpoint()`` (the partitioning must be the same for both passes);
3. per (partition, group) totals give each partition's rank offset within
   its group (one row per partition and group);
4. a running count inside each (partition, group) window (bounded by the
   range partition size) gives each distinct value its rank interval;
5. the values at ranks floor(h) and ceil(h), h = p * (n - 1), are picked
   with a partial + final aggregate and interpolated in exact decimals for
   decimal inputs: ``v_lo + (h - floor(h)) * (v_hi - v_lo)``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.session import ensure_checkpoint_dir


def value_counts(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """``group_cols``, ``_v`` and ``_n``: how often each non-NULL value occurs in its group, map-side combined.

    Counts are the state of an exact percentile: those of parts of the rows,
    kept apart, merge by adding them up (``merged_counts``).
    """
    v = F.col(value_col)
    return df.where(v.isNotNull()).groupBy(*group_cols, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def merged_counts(counts: DataFrame, group_cols: list[str]) -> DataFrame:
    """The counts of all parts together, by ``group_cols`` (coarser ones than the parts' will do)."""
    return counts.groupBy(*group_cols, "_v").agg(F.sum("_n").cast("bigint").alias("_n"))


def ranked_values(df: DataFrame, group_cols: list[str], value_col: str,
                  num_partitions: int | None = None) -> DataFrame:
    """``ranked_counts`` of the values in ``df``."""
    return ranked_counts(value_counts(df, group_cols, value_col), group_cols, num_partitions)


def ranked_counts(vc: DataFrame, group_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """``group_cols``, ``_v``, ``_n`` and the ranks ``_start`` (inclusive) to ``_end`` (exclusive) of every
    distinct value in its group of ``_total`` values. A NULL group is a group."""
    spark = vc.sparkSession
    ensure_checkpoint_dir(spark)
    parts = [num_partitions] if num_partitions else []
    ranged = (vc.repartitionByRange(*parts, *group_cols, "_v")
                .withColumn("_pid", F.spark_partition_id())
                .checkpoint(eager=True))

    # Fresh names on the offsets side: both sides come from one checkpoint.
    og = [f"_o{i}" for i in range(len(group_cols))]
    totals = ranged.groupBy(F.col("_pid").alias("_opid"),
                            *[F.col(c).alias(o) for c, o in zip(group_cols, og)]) \
        .agg(F.sum("_n").alias("_t"))
    by_group = Window.partitionBy(*og)   # rows: partitions x groups
    offsets = totals.select(
        "_opid", *og,
        (F.sum("_t").over(by_group.orderBy("_opid")) - F.col("_t")).alias("_off"),
        F.sum("_t").over(by_group).alias("_total"))

    local = Window.partitionBy("_pid", *group_cols).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cond = F.col("_pid") == F.col("_opid")
    for c, o in zip(group_cols, og):
        cond = cond & F.col(c).eqNullSafe(F.col(o))
    end = F.col("_off") + F.col("_cum")
    return (ranged.withColumn("_cum", F.sum("_n").over(local)).join(offsets, cond)
            .select(*group_cols, "_v", "_n", (end - F.col("_n")).alias("_start"), end.alias("_end"), "_total"))


def grouped_percentile_cont(df: DataFrame, group_cols: list[str], value_col: str,
                            percentiles: dict[str, float],
                            num_partitions: int | None = None) -> DataFrame:
    """``group_cols`` + one column per entry of ``percentiles`` (name -> p), and from the same value
    counts ``_count``, ``_sum``, ``_min`` and ``_max`` of the values, so a report needs one pass."""
    return percentiles_of_counts(value_counts(df, group_cols, value_col), group_cols, percentiles, num_partitions)


def percentiles_of_counts(counts: DataFrame, group_cols: list[str], percentiles: dict[str, float],
                          num_partitions: int | None = None) -> DataFrame:
    """The same from value counts (``group_cols``, ``_v``, ``_n``), one row for each value of a group."""
    vtype = counts.schema["_v"].dataType
    exact = isinstance(vtype, T.DecimalType)
    ranked = ranked_counts(counts, group_cols, num_partitions)

    # The type that summing the values themselves would give.
    total = F.sum(F.col("_v") * F.col("_n").cast("decimal(20,0)") if exact else F.col("_v") * F.col("_n"))
    if exact:
        total = total.cast(T.DecimalType(min(38, vtype.precision + 10), vtype.scale))
    picks = [F.sum("_n").alias("_count"), total.alias("_sum"), F.min("_v").alias("_min"), F.max("_v").alias("_max")]
    outs = ["_count", "_sum", "_min", "_max"]
    for i, (name, p) in enumerate(percentiles.items()):
        h = F.lit(Decimal(str(p))) * (F.col("_total") - 1)
        lo, hi = F.floor(h), F.ceil(h)
        covers = lambda r: (F.col("_start") <= r) & (r < F.col("_end"))
        picks += [F.max(F.when(covers(lo), F.col("_v"))).alias(f"_lo{i}"),
                  F.max(F.when(covers(hi), F.col("_v"))).alias(f"_hi{i}"),
                  F.max(h - lo).alias(f"_f{i}")]
        vlo, vhi, frac = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_f{i}")
        if not exact:
            frac = frac.cast("double")
        outs.append((vlo + frac * (vhi - vlo)).alias(name))
    return ranked.groupBy(*group_cols).agg(*picks).select(*group_cols, *outs)
