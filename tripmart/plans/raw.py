"""The raw trips: every source column in the type it came in.

Files change their columns' types from month to month. A slice is stored in
the types of its files (or in wider ones that hold all their values exactly,
where files are landed together), and the table's schema, the widest of all,
is applied on reading: slices that were stored alike are one read, cast to the
table's types, so a plan has as many reads as there are schemas, not slices.

Which slice is stored how is kept as numbered commits beside the table. Before
a slice is written it is marked as open; after the write its schema is
committed. Readers look into the files of open slices, so a crash between the
two leaves a table that can be read.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.operators.widen import merge
from tripmart.plans import layout
from tripmart.plans.commits import UNMERGEABLE, CommitLog, has_condition

Slice = tuple[str, str]  # month, service


def _key(slice_: Slice) -> str:
    return "|".join(slice_)


class RawTrips:
    def __init__(self, spark: SparkSession, path: str, log_path: str):
        self.spark, self.path, self.log = spark, path, CommitLog(spark, log_path)

    # ------------------------------------------------------------------ writing

    def _commit(self, slices: list[Slice], schema: T.StructType | None, gone: list[Slice] = ()) -> None:
        """Note the schema of ``slices`` (None while they are open) and forget those that are ``gone``."""
        def change(last: dict | None) -> dict:
            last = last or {"schemas": [], "slices": {}}
            kinds, places = list(last["schemas"]), dict(last["slices"])
            at = None
            if schema is not None:
                text = schema.json()
                at = kinds.index(text) if text in kinds else len(kinds)
                kinds += [text] if at == len(kinds) else []
            places.update({_key(s): at for s in slices})
            for s in gone:
                places.pop(_key(s), None)
            return {"schemas": kinds, "slices": places}

        self.log.update(change)

    def write(self, parts: list[tuple[DataFrame, list[Slice]]]) -> None:
        """Replace the slices of each part; a part is stored in its own types."""
        self._commit([s for _, slices in parts for s in slices], None)
        for df, slices in parts:
            layout.write_slices(df, self.path)
        for df, slices in parts:
            stored = T.StructType([f for f in df.schema.fields if f.name not in layout.SLICE_KEYS])
            self._commit(slices, stored)

    def drop(self, slices: list[Slice]) -> None:
        if not slices:
            return
        layout.drop_slices(self.spark, self.path, slices)
        self._commit([], None, gone=slices)

    # ------------------------------------------------------------------ reading

    def _stored(self) -> list[tuple[T.StructType, list[Slice]]]:
        """The schemas in use and the slices stored so."""
        content = self.log.latest()[1] or {"schemas": [], "slices": {}}
        by: dict[int | None, list[Slice]] = {}
        for key, at in content["slices"].items():
            by.setdefault(at, []).append(tuple(key.split("|")))
        found = [(T.StructType.fromJson(json.loads(content["schemas"][at])), slices)
                 for at, slices in sorted((k, v) for k, v in by.items() if k is not None)]
        known = {_key(s) for slices in by.values() for s in slices}
        unknown = [s for s in self._on_disk() if _key(s) not in known] if not found else []
        return found + self._looked_into(sorted(by.get(None, []) + unknown))

    def _on_disk(self) -> list[Slice]:
        """The slices that have a folder (a table without commits is read by its files)."""
        months = layout.folders(self.spark, self.path)
        return [(m.rpartition("source_month=")[2], s.rpartition("service_type=")[2])
                for m in months if "source_month=" in m for s in layout.folders(self.spark, m)]

    def _looked_into(self, slices: list[Slice]) -> list[tuple[T.StructType, list[Slice]]]:
        """The same for slices whose schema was not committed: groups whose footers merge, by halving."""
        there = [s for s in slices if self._has_files(s)]
        if not there:
            return []
        try:
            paths = [layout.slice_path(self.path, s) for s in there]
            return [(self.spark.read.option("mergeSchema", "true").parquet(*paths).schema, there)]
        except Exception as e:
            if len(there) == 1 or not has_condition(e, UNMERGEABLE):
                raise
        half = len(there) // 2
        return self._looked_into(there[:half]) + self._looked_into(there[half:])

    def _has_files(self, slice_: Slice) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(layout.slice_path(self.path, slice_) + "/*.parquet")
        return bool(path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path))

    def schema(self) -> T.StructType:
        """The table's columns: those of the landing first, each wide enough for every slice."""
        declared = T.StructType([f for f in schemas.LANDING.fields if f.name not in layout.SLICE_KEYS])
        return reduce(lambda a, b: merge(a, b)[0], [s for s, _ in self._stored()], declared)

    def read(self) -> DataFrame:
        """All slices, in the table's types, with the slice columns last."""
        stored = self._stored()
        table = self.schema()
        parts = []
        for schema, slices in stored:
            whole = T.StructType(schema.fields + [T.StructField(k, T.StringType()) for k in layout.SLICE_KEYS])
            df = layout.read_slices(self.spark, self.path, whole, slices if len(stored) > 1 else None)
            have = {f.name.lower(): f.name for f in schema.fields}
            parts.append(df.select(*[
                (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in table.fields], *layout.SLICE_KEYS))
        if not parts:
            slice_columns = [T.StructField(k, T.StringType()) for k in layout.SLICE_KEYS]
            return self.spark.createDataFrame([], T.StructType(table.fields + slice_columns))
        return reduce(DataFrame.unionByName, parts)
