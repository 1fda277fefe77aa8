"""Hard negatives: rows of other labels that score just below an anchor's positives.

Vectors are quantised to integers. Tiles of anchors and tiles of candidates are
multiplied by Strassen's recursion on int64, padded with zeros to even sides;
all additions are exact, and a leaf goes through float64 only where its sums
stay below 2 ** 53. Every task keeps for each anchor (and window) a heap of the
best rows it has seen. Heaps of different tasks merge by keeping the best of
their union.

Two searches follow each other: for an anchor's positives (best rows of its
label other than itself), then, with one window of scores for each positive,
for negatives. Each search first reads one in ``SEED_SHARE`` of the rows; the
worst entry of a full heap there is a bound that later entries must beat, so
tasks hand on few rows however many tasks there are, and none that counts is
lost. Anchors pass through the driver in blocks of at most ``BLOCK_BYTES``,
each searched against all rows before the next is fetched.

Rows with a null label, a null vector, or a null or non-finite component take
no part. Shorter vectors count as padded with zeros. A null id is never an
anchor's and comes last among ties, as id 2 ** 63 - 1. Repeated rows are rows
of their own: each is an anchor, and the others are candidates for it. Scores
are right while they fit in 64 bits. Empty tables give empty results; other
columns are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import map_rows, table, written

#: Bytes of the vectors of a block of anchors, at most (one anchor at least).
BLOCK_BYTES = 8 << 20
#: Anchors and candidates of one tile product.
TILE_ANCHORS, TILE_ROWS = 256, 2048
#: Rows of a file that the searches read; Spark puts small files together.
TASK_ROWS = 1 << 13
#: One row in so many gives the bounds that the search starts from.
SEED_SHARE = 16
LEAF = 32
NO_ID = (1 << 63) - 1
LEAST = -(1 << 63)


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of int64 matrices by Strassen's recursion until a side is at most ``leaf``."""
    return _strassen(a, b, _largest(a), _largest(b), leaf)


def _largest(a: np.ndarray) -> int:
    return max(int(a.max()), -int(a.min())) if a.size else 0


def _strassen(a: np.ndarray, b: np.ndarray, a_top: int, b_top: int, leaf: int) -> np.ndarray:
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        if k * a_top * b_top < 1 << 53:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
        return a @ b
    a, b = _even(a), _even(b)
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]

    def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return _strassen(x, y, 2 * a_top, 2 * b_top, leaf)

    p1 = times(a11 + a22, b11 + b22)
    p2 = times(a21 + a22, b11)
    p3 = times(a11, b12 - b22)
    p4 = times(a22, b21 - b11)
    p5 = times(a11 + a12, b22)
    p6 = times(a21 - a11, b11 + b12)
    p7 = times(a12 - a22, b21 + b22)
    out = np.empty((2 * r, 2 * t), np.int64)
    out[:r, :t] = p1 + p4 - p5 + p7
    out[:r, t:] = p3 + p5
    out[r:, :t] = p2 + p4
    out[r:, t:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def _even(a: np.ndarray) -> np.ndarray:
    """``a`` with a row and a column of zeros where its sides are odd."""
    m, k = a.shape
    return np.pad(a, ((0, m & 1), (0, k & 1))) if m & 1 or k & 1 else a


class Heaps:
    """For every slot the best ``most`` (score, id) with a score from ``low`` to ``high``, and not worse than its bound.

    Higher scores come first, then smaller ids. Slots are numbered through.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int, bound: tuple[np.ndarray, np.ndarray] | None = None):
        self.low, self.high, self.most = low, high, most
        self.score, self.id = bound if bound else (low.copy(), np.full(len(low), NO_ID))
        self.score, self.id = np.maximum(self.score, low), np.where(self.score < low, NO_ID, self.id)
        self.entries = tuple(np.zeros(0, np.int64) for _ in range(3))  # slots, scores, ids

    def push(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores <= self.high[slots]) & (
            (scores > self.score[slots]) | (scores == self.score[slots]) & (ids <= self.id[slots]))
        if not good.any():
            return
        slots, scores, ids = (np.concatenate([x, y[good]]) for x, y in zip(self.entries, (slots, scores, ids)))
        order = np.lexsort((ids, ~scores, slots))  # ~x falls as x rises, also at the ends of int64
        slots, scores, ids = slots[order], scores[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
        rank = np.arange(len(slots)) - np.repeat(first, np.diff(np.append(first, len(slots))))
        last = rank == self.most - 1
        self.score[slots[last]], self.id[slots[last]] = scores[last], ids[last]
        kept = rank < self.most
        self.entries = slots[kept], scores[kept], ids[kept]


@dataclass
class Anchors:
    """A block of anchors: row numbers, labels, vectors, and ``width`` windows of scores each."""
    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray  # (anchors, width)
    high: np.ndarray
    same: bool  # look for rows of the anchor's label, or of any other

    @property
    def width(self) -> int:
        return self.low.shape[1]


def matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows of int64 of ``size`` from lists, shorter ones padded with zeros."""
    lengths = vectors.value_lengths().to_numpy()
    out = np.zeros((len(vectors), size), np.int64)
    out[np.arange(size) < lengths[:, None]] = vectors.flatten().to_numpy()
    return out


def prepared(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
             label: Column | None = None, scale: float = 256.0) -> DataFrame:
    """(id, label, vector) of the rows that take part, components quantised to floor(``scale`` * x).

    ``label`` replaces the labels of rows that have one.
    """
    x = F.col(vector_col)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    taking_part = vectors.where(F.col(label_col).isNotNull() & x.isNotNull() & whole)
    return taking_part.select(
        F.col(id_col).cast("bigint").alias("id"), (F.col(label_col) if label is None else label).cast("bigint").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint")).alias("vector"))


def _search(rows: DataFrame, anchors: Anchors, most: int, size: int,
            bound: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """(slot, score, id, place): the best ``most`` rows of every slot, over all rows."""
    width, slots = anchors.width, anchors.low.size

    def run(batches):
        heaps = []
        for at in range(0, len(anchors.rows), TILE_ANCHORS):
            cut = slice(at * width, min(at + TILE_ANCHORS, len(anchors.rows)) * width)
            heaps.append(Heaps(anchors.low.reshape(-1)[cut], anchors.high.reshape(-1)[cut], most,
                               bound and (bound[0][cut].copy(), bound[1][cut].copy())))
        for b in batches:
            for at in range(0, b.num_rows, TILE_ROWS):
                tile = b.slice(at, TILE_ROWS)
                number, ids, labels = (tile.column(k).to_numpy(zero_copy_only=False) for k in range(3))
                _push_tile(anchors, heaps, number, ids, labels, matrix(tile.column(3), size))
        for k, h in enumerate(heaps):
            found, scores, ids = h.entries
            yield {"slot": found + k * TILE_ANCHORS * width, "score": scores, "id": ids}

    found = map_rows(rows.select("row", F.coalesce("id", F.lit(NO_ID)).alias("id"), "label", "vector"),
                     "slot bigint, score bigint, id bigint", run)
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return found.select("*", F.row_number().over(order).alias("place")).where(F.col("place") <= most)


def _push_tile(anchors: Anchors, heaps: list[Heaps], number: np.ndarray, ids: np.ndarray, labels: np.ndarray,
               vectors: np.ndarray) -> None:
    """Multiply the tile with all anchors, those of one label at a time where only its rows count."""
    width = anchors.width
    for k, h in enumerate(heaps):
        own = slice(k * TILE_ANCHORS, (k + 1) * TILE_ANCHORS)
        parts = [(np.arange(len(anchors.labels[own])), np.arange(len(ids)))]
        if anchors.same:
            parts = [(np.flatnonzero(anchors.labels[own] == v), np.flatnonzero(labels == v))
                     for v in np.intersect1d(anchors.labels[own], labels)]
        for mine, theirs in parts:
            products = strassen(anchors.vectors[own][mine], vectors[theirs].T)
            lowest = h.score.reshape(-1, width)[mine].min(axis=1)
            highest = h.high.reshape(-1, width)[mine].max(axis=1)
            wanted = (products >= lowest[:, None]) & (products <= highest[:, None])
            if anchors.same:
                wanted &= anchors.rows[own][mine][:, None] != number[theirs]
            else:
                wanted &= anchors.labels[own][mine][:, None] != labels[theirs]
            a, c = np.nonzero(wanted)
            scores, found = products[a, c], ids[theirs][c]
            slots = mine[a] * width
            for p in range(width):
                h.push(slots + p, scores, found)


def _bounded_search(rows: DataFrame, anchors: Anchors, most: int, size: int) -> DataFrame:
    """``_search`` over all rows, from the bounds that a share of the rows gives."""
    some = _search(rows.where(F.pmod(F.xxhash64("row"), F.lit(SEED_SHARE)) == 0), anchors, most, size)
    full = some.where(F.col("place") == most).select("slot", "score", "id").toArrow()
    bound = np.full(anchors.low.size, LEAST), np.full(anchors.low.size, NO_ID)
    at = full["slot"].to_numpy()
    bound[0][at], bound[1][at] = full["score"].to_numpy(), full["id"].to_numpy()
    return _search(rows, anchors, most, size, bound)


def windows(scores: np.ndarray, low: tuple[int, int], high: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores s with low[0] * score <= low[1] * s and high[1] * s <= high[0] * score."""
    least = [-(-low[0] * int(s) // low[1]) for s in scores.reshape(-1)]
    most = [high[0] * int(s) // high[1] for s in scores.reshape(-1)]
    return np.array(least, np.int64).reshape(scores.shape), np.array(most, np.int64).reshape(scores.shape)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
         low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (id, label, vector).

    A negative's score is from low[0] / low[1] to high[0] / high[1] of the positive's.
    """
    spark = rows.sparkSession
    count, size = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    size = max(1, size or 1)
    dealt = rows.repartition(max(1, -(-count // TASK_ROWS)))
    rows = written(dealt.withColumn("row", F.monotonically_increasing_id()), "vectors")
    chosen = rows.where(is_anchor & F.col("id").isNotNull())
    blocks = max(1, -(-chosen.count() * size * 8 * 5 // (BLOCK_BYTES * 4)))  # a fifth of room for uneven hashes
    chosen = written(chosen.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).sort("block", "row"), "anchors")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    parts = [p for k in range(blocks) if (p := _mine_block(rows, chosen.where(F.col("block") == k), size, positives, negatives, low, high))]
    out = spark.createDataFrame([], schema)
    for p in parts:
        out = out.unionByName(p)
    return out


def _mine_block(rows: DataFrame, block: DataFrame, size: int, positives: int, negatives: int,
                low: tuple[int, int], high: tuple[int, int]) -> DataFrame | None:
    """The result for one block of anchors, written to the shared folder; None for an empty block."""
    own = block.select("row", "id", "label", "vector").toArrow().combine_chunks()
    if not own.num_rows or not size:
        return None
    number, ids, labels = (own[c].to_numpy() for c in ("row", "id", "label"))
    vectors = matrix(own["vector"].combine_chunks(), size)
    whole = np.full((len(ids), 1), LEAST), np.full((len(ids), 1), NO_ID)
    first = _bounded_search(rows, Anchors(number, labels, vectors, *whole, same=True), positives, size).toArrow()

    # empty windows where an anchor has fewer positives
    slot = first["slot"].to_numpy() * positives + first["place"].to_numpy() - 1
    least, most = np.full(len(ids) * positives, 0), np.full(len(ids) * positives, -1)
    least[slot], most[slot] = windows(first["score"].to_numpy(), low, high)
    shape = (len(ids), positives)
    found = _bounded_search(rows, Anchors(number, labels, vectors, least.reshape(shape), most.reshape(shape), same=False),
                            negatives, size)
    pairs = rows.sparkSession.createDataFrame(pa.table({
        "slot": slot, "anchor_id": ids[first["slot"].to_numpy()], "positive_id": first["id"], "positive_score": first["score"]}))

    def known(c: str) -> Column:
        return F.when(F.col(c) < NO_ID, F.col(c)).alias(c)

    found = found.select("slot", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return written(found.join(F.broadcast(pairs), "slot").select(
        "anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score"), "negatives")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(prepared(table(spark, sf_dir, "embeddings"), label=moved), F.col("id") % 100 == 0)


OP11_SQL = """
WITH q AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r, a.vec_id AS anchor_id, a.label AS own, c.r AS other, c.vec_id, c.label,
         list_dot_product(a.v, c.v)::BIGINT AS score
  FROM q a JOIN q c ON a.vec_id % 100 = 0 AND a.r <> c.r),
positive AS (
  SELECT * FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.score DESC, n.vec_id NULLS LAST)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.r = p.r AND n.label <> n.own
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""
