"""Declarative column tests returning a violations table.

Failure counts follow the usual semantics of these tests:

* ``not_null``: rows where the column is NULL;
* ``unique``: distinct non-NULL values that occur more than once;
* ``accepted_values``: distinct non-NULL values outside the list;
* ``relationships``: non-NULL child rows whose value is missing in the parent.

Per table, all tests but ``unique`` run in one scan: parent key sets are
joined to flag orphans, each row lists the tests it violates (with the value
for ``accepted_values``, whose violations are distinct values), and the lists
are counted. A clean row lists nothing, so little is shuffled. ``unique`` is
one grouped aggregate each. All results are unioned into one small DataFrame
``(table_name, column_name, test_name, violations, passed)``; nothing is
collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.joins import Dim


@dataclass(frozen=True)
class ColumnTest:
    table: str
    column: str
    test: str                      # not_null | unique | accepted_values | relationships
    values: tuple = ()             # accepted_values
    to: str | None = None          # relationships: parent table
    field: str | None = None       # relationships: parent column


def not_null(table, *cols):
    return [ColumnTest(table, c, "not_null") for c in cols]


def unique(table, *cols):
    return [ColumnTest(table, c, "unique") for c in cols]


def accepted(table, col, values):
    return [ColumnTest(table, col, "accepted_values", tuple(values))]


def fk(table, col, to, field):
    return [ColumnTest(table, col, "relationships", to=to, field=field)]


def run_tests(tables: dict[str, DataFrame], tests: list[ColumnTest],
              parents: dict[str, Dim] | None = None, broadcast_limit: int = 2_000_000) -> DataFrame:
    parents = parents or {}
    parts: list[DataFrame] = []

    def counted(df: DataFrame, mine: list[ColumnTest], counts: DataFrame) -> DataFrame:
        """A row for each test of ``mine``, with ``counts`` (test, n) by its place there, else 0."""
        declared = df.sparkSession.createDataFrame(
            [(i, t.table, t.column, t.test) for i, t in enumerate(mine)],
            "test int, table_name string, column_name string, test_name string")
        return F.broadcast(declared).join(counts, "test", "left").select(
            "table_name", "column_name", "test_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("violations"))

    for table in dict.fromkeys(t.table for t in tests):
        df = tables[table]
        mine = [t for t in tests if t.table == table]
        scan = [t for t in mine if t.test != "unique"]
        if scan:
            flagged, found = df, []
            for i, t in enumerate(scan):
                c = F.col(t.column)
                value = F.lit(None).cast("string")
                if t.test == "not_null":
                    bad = c.isNull()
                elif t.test == "accepted_values":
                    bad, value = c.isNotNull() & ~c.isin(list(t.values)), c.cast("string")
                else:
                    parent = parents.get(t.to) or Dim(tables[t.to])
                    keys = parent.df.select(F.col(t.field).alias(f"_k{i}")).where(F.col(f"_k{i}").isNotNull()).distinct()
                    keys = Dim(keys, parent.max_rows).side(broadcast_limit)
                    flagged = flagged.join(keys, c == F.col(f"_k{i}"), "left")
                    bad = c.isNotNull() & F.col(f"_k{i}").isNull()
                found.append(F.when(bad, F.struct(F.lit(i).alias("test"), value.alias("value"))))
            hits = flagged.select(F.explode(F.array_compact(F.array(*found))).alias("hit")).select("hit.test", "hit.value")
            by_value = hits.groupBy("test", "value").agg(F.count(F.lit(1)).alias("n"))
            counts = by_value.groupBy("test").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(1)).alias("n"))
            parts.append(counted(df, scan, counts))
        single = [t for t in mine if t.test == "unique"]
        if single:
            # (test, value) of all unique tests of the table in one read and one shuffle; as text, which tells
            # values of one column apart, where the columns' types differ
            kinds = {df.schema[t.column].dataType for t in single}
            kind = "string" if len(kinds) > 1 else kinds.pop()
            values = [F.struct(F.lit(i).alias("test"), F.col(t.column).cast(kind).alias("value"))
                      for i, t in enumerate(single)]
            found = df.select(F.explode(F.array(*values)).alias("x")).select("x.test", "x.value").where("value IS NOT NULL")
            twice = found.groupBy("test", "value").count().where("count > 1")
            parts.append(counted(df, single, twice.groupBy("test").agg(F.count(F.lit(1)).alias("n"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("violations") == 0)
