"""Upper-median imputation.

The median used is ``sorted(non_null)[floor(n / 2)]``: the upper of the two
middle values for an even count ({1, 2, 3, 10} -> 3). In SQL terms that is
``percentile_disc(0.5) WITHIN GROUP (ORDER BY x DESC)``.

All columns of one type are unpivoted to (column, value) and ranked in one
pass, without any task holding all values of a column
(``percentiles.ranked_values``). The medians are one scalar per column,
applied as literals (no join). An all-NULL column has no median and stays NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.percentiles import ranked_values

NUMERIC_PREFIXES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t.startswith(NUMERIC_PREFIXES)]


def upper_medians(df: DataFrame, cols: list[str]) -> dict:
    """Upper median per column; one read per distinct column type."""
    types, medians = dict(df.dtypes), dict.fromkeys(cols)
    for kind in dict.fromkeys(types[c] for c in cols):
        mine = [F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in cols if types[c] == kind]
        values = df.select(F.explode(F.array(*mine)).alias("x")).select("x.c", "x.v")
        ranked = ranked_values(values, ["c"], "v")
        middle = F.floor(F.col("_total") / 2)
        found = ranked.where((F.col("_start") <= middle) & (middle < F.col("_end"))).select("c", "_v")
        medians.update({r["c"]: r["_v"] for r in found.collect()})  # one row per column
    return medians


def fill_upper_median(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Keep ``cols`` (default: numeric columns) and fill their NULLs."""
    cols = cols or numeric_columns(df)
    medians = upper_medians(df, cols)
    types = dict(df.dtypes)
    return df.select(*[
        F.coalesce(F.col(c), F.lit(medians[c]).cast(types[c])).alias(c) if medians[c] is not None
        else F.col(c) for c in cols])
