"""SimHash near-duplicates: exact radius search by bit-sliced comparison, then components.

Fingerprints of equal value are one node. For radius r the 64 bits are cut
into r + 2 blocks; two fingerprints within r bits agree on at least two of
them, so every pair of blocks is a table of buckets. A bucket's fingerprints
are stored as bit planes (bit k of 64 fingerprints in one word) and compared
with a query by carry-save counters over the planes, 64 distances at a time;
a block of 64 is abandoned once all its distances exceed the radius. Of each
bucket only the links to its component's smallest member leave the task,
never all pairs; buckets above ``tile`` members are cut into tiles and
every pair of tiles is compared, so no task holds a whole large bucket.

Null and empty texts have fingerprint zero and link like any other. Rows with
a null id get a fingerprint and the component of their group, but never name
a component unless all ids of the group are null. Repeated rows give repeated
results; other columns are not looked at.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import U64, as_bytes, keep_marked, map_rows, materialise, table
from tripmart.llm.components import component_roots

ONES = U64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles (repeats included) of UTF-8 ``text``, A-Z lower-cased."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(grams), 1 << 18):
        h = np.array([digest(g, seed) for g in grams[at:at + (1 << 18)]], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(grams), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, fp): fp holds the fingerprint's bits as a signed long, mark a hash of the text."""
    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in as_bytes(b.column(1))], dtype=U64)
            yield {"doc_id": b.column(0), "mark": b.column(2), "fp": pa.array(fps.view(np.int64))}

    return map_rows(narrow, f"doc_id {kind}, mark bigint, fp bigint", run)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, n / 64) words: bit l of word [k, b] is bit k of values[64 * b + l]; n is a multiple of 64."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def within(planes: np.ndarray, queries: np.ndarray, query: np.ndarray, block: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit-sliced distances of ``queries[query[i]]`` to the 64 lanes of ``block[i]``.

    Returns (query, block, mask): the lanes within ``radius`` bits, for the
    comparisons that have any.
    """
    width = max(1, int(radius).bit_length())
    counters = [np.zeros(len(query), dtype=U64) for _ in range(width)]
    over = np.zeros(len(query), dtype=U64)
    for k in range(64):
        flip = ONES * ((queries[query] >> U64(k)) & U64(1))
        carry = planes[k, block] ^ flip
        for i in range(width):  # carry-save: add one bit to 64 counters at once
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over |= carry
        if k % 8 == 7:  # abandon blocks of which every distance exceeds the radius
            alive = (over | _above(counters, radius)) != ONES
            if not alive.all():
                query, block, over = query[alive], block[alive], over[alive]
                counters = [c[alive] for c in counters]
            if not len(query):
                break
    mask = ~(over | _above(counters, radius))
    hit = mask != 0
    return query[hit], block[hit], mask[hit]


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter, read across the words, is greater than ``radius``."""
    more, same = np.zeros_like(counters[0]), np.full_like(counters[0], ONES)
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            same &= counters[i]
        else:
            more |= same & counters[i]
            same &= ~counters[i]
    return more


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of a[i] and b[i]; ``label`` points each row to a smaller or equal row."""
    while len(a):
        la, lb = label[a], label[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        differ = low != high
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(label, high[differ], low[differ])
        while not np.array_equal(jump := label[label], label):
            label[:] = jump


def bucket_links(run: np.ndarray, values: np.ndarray, radius: int, chunk: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Links inside buckets: rows of equal ``run`` lie together. Returns (row, row of its component's first)."""
    n = len(values)
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, n])
    blocks = (sizes + 63) // 64
    first_block = np.r_[0, np.cumsum(blocks)]
    of = np.repeat(np.arange(len(starts)), sizes)
    lane = first_block[of] * 64 + (np.arange(n) - starts[of])
    padded = np.zeros(first_block[-1] * 64, dtype=U64)
    padded[lane] = values
    row_of = np.full(len(padded), -1, dtype=np.int64)
    row_of[lane] = np.arange(n)
    planes, label = bit_planes(padded), np.arange(n)
    todo = np.flatnonzero(sizes[of] > 1)
    # every query meets the blocks of its own bucket from its own block on
    own = lane // 64
    left = first_block[of + 1] - own
    ends = np.cumsum(left[todo])
    at = 0
    while at < len(todo):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + chunk, side="right")))
        q = todo[at:stop]
        query = np.repeat(q, left[q])
        offset = np.arange(len(query)) - np.repeat(np.cumsum(left[q]) - left[q], left[q])
        query, block, mask = within(planes, values, query, own[query] + offset, radius)
        bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        pair, bit = np.nonzero(bits)
        other = row_of[block[pair] * 64 + bit]
        mine = query[pair]
        real = other > mine
        _hook(label, mine[real], other[real])
        at = stop
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def near_links(values: DataFrame, radius: int = 2, tile: int = 4096) -> DataFrame:
    """Star links (u, v) that connect all distinct longs ``fp`` of ``values`` within ``radius`` bits.

    Null fingerprints link to nothing.
    """
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    spans = [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(radius + 2)]

    def bits(at: int, width: int):
        return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1))

    tables = [F.xxhash64(F.lit(n), bits(*a), bits(*b)).alias("key") for n, (a, b) in enumerate(combinations(spans, 2))]
    nodes = values.where("fp IS NOT NULL").select("fp").distinct()
    keyed = nodes.select("fp", F.explode(F.array(*tables)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # buckets of one tile stay whole; larger ones go to every pair of their tiles
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit("tile")), F.col("tiles")).cast("int")
    dealt = (keyed.join(sizes, "key").withColumn("tiles", tiles).withColumn("mine", mine)
             .select("key", "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
             .select("fp", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("bucket")))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "fp")

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def flush(bucket, fp):
            row, root = bucket_links(bucket, fp.view(U64), radius)
            return {"u": pa.array(fp[row]), "v": pa.array(fp[root])}

        for b in batches:
            held.append((b.column(1).to_numpy(), b.column(0).to_numpy()))
            rows += len(b)
            if rows >= 65536:
                bucket, fp = (np.concatenate(x) for x in zip(*held))
                last = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                if last:
                    yield flush(bucket[:last], fp[:last])
                held, rows = [(bucket[last:], fp[last:])], len(bucket) - last
        if rows:
            yield flush(*(np.concatenate(x) for x in zip(*held)))

    return map_rows(dealt, "u bigint, v bigint", run)


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, mark, fp, root, component_id) of every row: root is the component's smallest fingerprint,
    component_id the smallest id reachable."""
    marked = materialise(fingerprints(docs, shingle, id_col, text_col))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = component_roots(near_links(nodes, radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    placed = materialise(nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "low"))
    names = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    return marked.join(placed.join(names, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "mark", "fp", "root", "component_id")


def drop_near(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all columns: of each component the smallest id (null last, then the smallest hash)."""
    found = simhash_components(docs, shingle, radius, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")
    first = found.groupBy("root").agg(F.min(place).alias("first"))
    judged = found.join(first, "root").select("doc_id", "mark", place.eqNullSafe(F.col("first")).alias("kept"))
    return keep_marked(docs, id_col, F.xxhash64(F.col(text_col).cast("string")), judged)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
