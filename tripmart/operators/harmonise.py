"""Harmonise one service's trip file to the landing layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas

YELLOW_RENAMES = {
    "tpep_pickup_datetime": "lpep_pickup_datetime",
    "tpep_dropoff_datetime": "lpep_dropoff_datetime",
}
YELLOW_ADDED = {"trip_type": T.DoubleType(), "ehail_fee": T.DoubleType()}


def harmonise(df: DataFrame, service_type: str) -> DataFrame:
    """Yellow: rename tpep_* to lpep_* (only those present), drop one
    spelling of the airport fee, add trip_type/ehail_fee as NULL."""
    if service_type != "yellow":
        return df
    df = df.withColumnsRenamed({k: v for k, v in YELLOW_RENAMES.items() if k in df.columns})
    # Name matching is case-insensitive: this drops Airport_fee or airport_fee.
    if any(c.lower() == "airport_fee" for c in df.columns):
        df = df.drop("airport_fee")
    missing = {c: F.lit(None).cast(t) for c, t in YELLOW_ADDED.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: T.StructType = schemas.LANDING, keep_extra: bool = False) -> DataFrame:
    """Cast to the declared landing schema; absent columns become NULL.
    Columns outside it follow as they are with ``keep_extra``, else they are
    left out. Landing stores missing values as NULL, so floating NaN becomes
    NULL too."""
    have = {c.lower(): c for c in df.columns}
    types = dict((n.lower(), t) for n, t in ((f.name, f.dataType) for f in df.schema.fields))
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        c = F.col(f"`{src}`") if src else F.lit(None)
        if src and isinstance(types[src.lower()], (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        cols.append(c.cast(f.dataType).alias(f.name))
    for name in unknown_columns(df, schema) if keep_extra else []:
        c = F.col(f"`{name}`")
        if isinstance(types[name.lower()], (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        cols.append(c.alias(name))
    return df.select(*cols)


def unknown_columns(df: DataFrame, schema: T.StructType = schemas.LANDING) -> list[str]:
    known = {f.name.lower() for f in schema.fields}
    return [c for c in df.columns if c.lower() not in known]
