"""Exact duplicates of an incoming batch against an immutable snapshot and within itself.

Texts are equal when they are identical without the characters space and
0x09-0x0D. Digests (SHA-256 of that form) of the snapshot are dealt into
buckets and each bucket gets a static binary-fuse filter, built once. Distinct
digests of the batch are screened by the filter of their bucket: negatives are
new and are grouped only among themselves; positives meet the snapshot's exact
buckets by digest. Rows that share a digest are then compared byte by byte
with their group's representative; a row that differs forms a group with those
equal to it.

Of equal texts the row with the most code points in the original text stays,
then the smallest id (null ids last), then the first of repeated rows. Null
texts are empty texts. Empty tables give empty results; other columns are not
looked at, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import U64, keep_marked, materialise, mix64, table

BLANKS = " \t\n\x0b\x0c\r"
KEYS_PER_FILTER = 50_000
#: Duplicate digests (32 bytes each) up to this count are broadcast, about 10 MB; more are joined by shuffle.
BROADCAST_DIGESTS = 200_000
ROWS_PER_SALT = 256


def normal_text(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


class BinaryFuseFilter:
    """Static three-way binary-fuse filter with 8-bit fingerprints over distinct uint64 keys."""

    def __init__(self, seed: int, segment: int, count: int, cells: np.ndarray):
        self.seed, self.segment, self.count, self.cells = seed, segment, count, cells

    @staticmethod
    def places(keys: np.ndarray, seed: int, segment: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Three cells in consecutive segments, and the fingerprint, of each key."""
        h = mix64(keys + U64(seed))
        span, mask = U64(count * segment), U64(segment - 1)
        first = ((h >> U64(32)) * span) >> U64(32)
        second = (first + U64(segment)) ^ ((h >> U64(18)) & mask)
        third = (first + U64(2 * segment)) ^ (h & mask)
        mark = (mix64(h) & U64(0xFF)).astype(np.uint8)
        return np.stack([first, second, third], axis=1).astype(np.int64), mark

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuseFilter:
        keys = np.unique(keys.astype(U64))
        n = len(keys)
        segment = 4 if n < 2 else min(1 << 18, 1 << int(np.log(n) / np.log(3.33) + 2.25))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        count = max(1, int(np.ceil(n * factor / segment)) - 2)
        for seed in range(1, 200):
            if seed % 10 == 0:
                count += 1 + count // 8  # an unlucky size: more room
            at, mark = cls.places(keys, seed, segment, count)
            order = cls._peel(at, (count + 2) * segment)
            if order is None:
                continue
            cells = np.zeros((count + 2) * segment, dtype=np.uint8).tolist()
            rows, marks = at.tolist(), mark.tolist()
            for key, cell in reversed(order):
                a, b, c = rows[key]
                cells[cell] = marks[key] ^ cells[a] ^ cells[b] ^ cells[c] ^ cells[cell]
            return cls(seed, segment, count, np.array(cells, dtype=np.uint8))
        raise RuntimeError("no filter found; are the keys 64-bit digests?")

    @staticmethod
    def _peel(at: np.ndarray, size: int) -> list[tuple[int, int]] | None:
        """Keys with a cell of their own, in an order in which each is alone when taken."""
        degree = np.bincount(at.ravel(), minlength=size)
        owner = np.zeros(size, dtype=np.int64)
        for column in at.T:
            np.bitwise_xor.at(owner, column, np.arange(len(at)))
        ready = np.flatnonzero(degree == 1).tolist()
        degree, owner, rows, order = degree.tolist(), owner.tolist(), at.tolist(), []
        while ready:
            cell = ready.pop()
            if degree[cell] != 1:
                continue
            key = owner[cell]
            order.append((key, cell))
            for other in rows[key]:
                degree[other] -= 1
                owner[other] ^= key
                if degree[other] == 1:
                    ready.append(other)
        return order if len(order) == len(rows) else None

    def __contains__(self, key: int) -> bool:
        return bool(self.contains(np.array([key], dtype=U64))[0])

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """True for every key of the set and about one in 256 others."""
        at, mark = self.places(keys.astype(U64), self.seed, self.segment, self.count)
        return (self.cells[at[:, 0]] ^ self.cells[at[:, 1]] ^ self.cells[at[:, 2]]) == mark

    def to_bytes(self) -> bytes:
        return np.array([self.seed, self.segment, self.count], dtype="<i8").tobytes() + self.cells.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> BinaryFuseFilter:
        seed, segment, count = np.frombuffer(data, "<i8", 3).tolist()
        return cls(seed, segment, count, np.frombuffer(data, np.uint8, offset=24))


def build_filters(snapshot: DataFrame) -> DataFrame:
    """(bucket, filter) from distinct (bucket, key) rows; about KEYS_PER_FILTER keys a bucket."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = BinaryFuseFilter.build(pdf["key"].to_numpy().view(U64))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "filter": [made.to_bytes()]})

    return snapshot.select("bucket", "key").groupBy("bucket").applyInPandas(build, "bucket int, filter binary")


def screen(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """(key, digest, maybe) of the batch's (bucket, key, digest) rows: may the snapshot have them?"""
    def probe(rows: pd.DataFrame, made: pd.DataFrame) -> pd.DataFrame:
        maybe = np.zeros(len(rows), dtype=bool)
        for data in made["filter"]:
            maybe |= BinaryFuseFilter.from_bytes(data).contains(rows["key"].to_numpy().view(U64))
        return pd.DataFrame({"digest": rows["digest"], "maybe": maybe})

    return (batch.select("bucket", "key", "digest").groupBy("bucket")
            .cogroup(filters.groupBy("bucket")).applyInPandas(probe, "digest binary, maybe boolean"))


def exact_groups(docs: DataFrame, incoming: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``incoming`` is true for rows of the new batch; the others are the snapshot.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         F.coalesce(incoming, F.lit(False)).alias("incoming"))
    digest = F.unhex(F.sha2(normal_text(F.col("text")), 256))
    rows = materialise(source.select(
        "doc_id", "incoming", F.coalesce(F.char_length("text"), F.lit(0)).alias("n"), digest.alias("digest"),
        F.monotonically_increasing_id().alias("row")))

    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("nameless"),
                          "doc_id", "row")).alias("best")

    def grouped(part: DataFrame) -> DataFrame:
        return part.groupBy("digest").agg(F.count("*").alias("size"), best)

    snapshot, batch = grouped(rows.where("NOT incoming")), grouped(rows.where("incoming"))
    sizes = rows.groupBy("incoming").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    key = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")
    bucket = F.pmod(F.xxhash64("digest"), F.lit(-(-sizes // KEYS_PER_FILTER) or 1)).cast("int")
    filters = build_filters(snapshot.select(bucket.alias("bucket"), key.alias("key")))
    screened = screen(batch.select(bucket.alias("bucket"), key.alias("key"), "digest"), filters)
    judged = batch.join(screened, "digest")
    new = judged.where("NOT maybe").select("digest", "size", "best")
    seen = judged.where("maybe").select("digest", F.col("size").alias("more"), F.col("best").alias("other"))
    old = snapshot.join(seen, "digest", "full_outer").select(
        "digest", (F.coalesce("size", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("size"),
        F.least("best", "other").alias("best"))
    groups = materialise(new.union(old))

    odd = materialise(_unequal_rows(source, digest, groups))
    if odd.isEmpty():
        classed, groups = rows.withColumn("other", F.lit(0).cast("long")), groups.withColumn("other", F.lit(0).cast("long"))
    else:  # equal digests of different bytes: each text its own group
        classed = rows.join(odd, rows.doc_id.eqNullSafe(odd.odd_id) & (rows.digest == odd.odd_digest), "left").select(
            rows["*"], F.coalesce("other", F.lit(0)).alias("other"))
        groups = classed.groupBy("digest", "other").agg(F.count("*").alias("size"), best)
    return classed.join(groups, ["digest", "other"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def _unequal_rows(source: DataFrame, digest: Column, groups: DataFrame) -> DataFrame:
    """Byte check: rows whose text differs from their group's representative.

    Only rows of groups of two or more move; a group's representative is
    repeated for every ROWS_PER_SALT rows, so a large group spreads.
    """
    shared = groups.where("size > 1").select(
        "digest", F.col("best.doc_id").alias("keep_id"),
        F.ceil(F.col("size") / ROWS_PER_SALT).cast("int").alias("salts"))
    if shared.count() <= BROADCAST_DIGESTS:
        shared = F.broadcast(shared)
    members = source.select("doc_id", digest.alias("digest"), normal_text(F.col("text")).alias("norm")).join(shared, "digest")
    chosen = members.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(
        F.min("norm").alias("chosen"), F.max("salts").alias("salts"))
    spread = chosen.select("digest", "chosen", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    return salted.join(spread, ["digest", "salt"]).where("norm <> chosen").select(
        F.col("doc_id").alias("odd_id"), F.col("digest").alias("odd_digest"),
        F.xxhash64("norm").alias("other")).distinct()


def half_by_hash(id_col: str = "doc_id") -> Column:
    """The incoming half of a table that is deduplicated as a whole."""
    return F.pmod(F.xxhash64(id_col), F.lit(2)) == 1


def drop_exact(docs: DataFrame, incoming: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all columns, that stay."""
    judged = exact_groups(docs, incoming, id_col, text_col).select("doc_id", F.col("text_sha256").alias("mark"), "kept")
    return keep_marked(docs, id_col, F.sha2(normal_text(F.col(text_col)), 256), judged)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, by a hash of the id, are the snapshot and the others the incoming batch."""
    return exact_groups(table(spark, sf_dir, "documents"), half_by_hash())


OP7_SQL = r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM norm
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
