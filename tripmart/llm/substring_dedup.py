"""Repeated passages by level-wise doubling of word windows.

A window of ``window`` consecutive words is a repeat if its word sequence also
starts in a document with a smaller id; every word that a repeat covers is
removed. Windows are judged on the input, not on what is left.

Lengths double from ``start`` to ``window``. A window stands for itself at a
shorter length by the smallest hash among its sub-windows of that length
(equal windows have equal ones), so a level exchanges few hashes per document.
Only windows whose sub-window occurs in two or more documents are extended to
twice the length; the loop ends when none survive. At the full length all
surviving windows are compared by two independent 64-bit hashes. Documents of
the same word sequence count once: of them all but the smallest id are repeats
as a whole.

Null texts have no words. Rows with a null id lose nothing and make nothing a
repeat. Rows that repeat an id are judged by that id. Texts shorter than the
window lose nothing; very long ones are judged whole. An empty table gives no
rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import U64, as_bytes, map_rows, materialise, mix64, table, written

#: Ids up to this count (8 bytes each) are broadcast to thin out a scan, about 8 MB; more are joined by shuffle.
BROADCAST_IDS = 500_000
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=U64, count=len(words))


def window_hashes(hashes: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of every run of ``length`` words: a polynomial mod 2**64 over the word hashes, mixed."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, dtype=U64)
    inverse = pow(base, -1, 1 << 64)
    up = np.multiply.accumulate(np.r_[U64(1), np.full(n - 1, base, dtype=U64)])
    down = np.multiply.accumulate(np.r_[U64(1), np.full(n - length, inverse, dtype=U64)])
    sums = np.r_[U64(0), np.cumsum(hashes * up, dtype=U64)]
    return mix64((sums[length:] - sums[:-length]) * down)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by runs of doubling length."""
    if len(values) < width:
        return values[:0]
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:-(width - have)], values[width - have:]) if have < width else values


def stand_ins(hashes: np.ndarray, length: int, window: int) -> np.ndarray:
    """For every window the smallest hash among its sub-windows of ``length``."""
    return sliding_min(window_hashes(hashes, length), window - length + 1)


def lengths_of(start: int, window: int) -> list[int]:
    """Lengths below ``window`` that are compared before it."""
    if not 1 <= start <= window:
        raise ValueError("start must lie between 1 and the window")
    lengths = []
    while start < window:
        lengths.append(start)
        start *= 2
    return lengths


def _surviving(hashes: np.ndarray, lengths: list[int], known: list[np.ndarray], window: int) -> np.ndarray:
    """Mask of windows whose stand-ins at all ``lengths`` so far are among the repeated ones."""
    masks = [np.isin(stand_ins(hashes, n, window), np.asarray(k, dtype=np.int64).view(U64)) for n, k in zip(lengths, known)]
    return reduce(np.logical_and, masks)


def _longs(values: np.ndarray) -> np.ndarray:
    return np.unique(values).view(np.int64)


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur with two ids or more, with the smallest id."""
    return rows.groupBy(*keys).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where(
        "low < high").select(*keys, "low")


def _with_text(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``source`` joined with ``wanted`` on the id; few ids thin out the scan before the shuffle."""
    if wanted.count() <= BROADCAST_IDS:
        source = source.join(F.broadcast(wanted.select("doc_id")), "doc_id", "left_semi")
    return source.join(wanted, "doc_id")


def remove_repeats(docs: DataFrame, window: int = 50, start: int = 25, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined by a
    space; null where nothing was removed) and kept_sha256 (of the words left, in either case)."""
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lengths = lengths_of(start, window)

    def scan(batches):
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
                words = text.split() if text else []
                known = stand_ins(word_hashes(words), (lengths or [window])[0], window) if len(words) >= window else ()
                out.append((doc_id, len(words), hashlib.sha256(b" ".join(words)).digest(), _longs(np.asarray(known, dtype=U64))))
            yield dict(zip(("doc_id", "n_words", "sha", "found"), map(list, zip(*out)))) if out else {
                "doc_id": [], "n_words": [], "sha": [], "found": []}

    rows = written(map_rows(source, f"doc_id {kind}, n_words bigint, sha binary, found array<bigint>", scan), "windows")
    first = rows.groupBy("sha").agg(F.min("doc_id").alias("first"))
    placed = rows.select("doc_id", "n_words", "sha").join(first, "sha")
    own = rows.join(first.where("first IS NOT NULL"), "sha").where("doc_id = first")

    states = None  # doc_id, and for every level so far the repeated stand-ins that its windows have
    found = own.select("doc_id", F.explode("found").alias("key"))
    for level in range(len(lengths)):
        alive = found.join(_repeated(found, ["key"]).select("key"), "key").groupBy("doc_id").agg(
            F.collect_set("key").alias(f"known_{level}"))
        states = materialise(alive if states is None else states.join(alive, "doc_id"))
        if states.isEmpty():
            break
        if level + 1 < len(lengths):
            found = written(_extended(source, states, kind, lengths[:level + 1], lengths[level + 1], window), "longer")

    if states is None:  # no shorter level: every window is a candidate
        states = own.select("doc_id").distinct()
    exact = written(_exact_windows(source, states, kind, lengths, window), "exact")
    repeats = exact.join(_repeated(exact, ["a", "b"]), ["a", "b"]).where("doc_id > low").groupBy("doc_id").agg(
        F.collect_set("a").alias("repeats"))
    cut = materialise(_cut(source, materialise(repeats), kind, window))
    cut = cut.groupBy("doc_id", "sha").agg(F.first("n_removed").alias("n_removed"), F.first("kept").alias("kept"),
                                           F.first("kept_sha").alias("kept_sha"))
    whole = (F.col("n_words") >= window) & F.col("doc_id").isNotNull() & (F.col("doc_id") > F.col("first"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return placed.join(cut, ["doc_id", "sha"], "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, nothing).otherwise(F.coalesce("kept_sha", F.lower(F.hex("sha")))).alias("kept_sha256"))


def _extended(source: DataFrame, states: DataFrame, kind: str, lengths: list[int], longer: int, window: int) -> DataFrame:
    """(doc_id, key): stand-ins at the next length of the windows that survive so far."""
    def run(batches):
        for b in batches:
            for doc_id, text, *known in zip(*(c.to_pylist() for c in b.columns)):
                hashes = word_hashes(text.encode().split())
                keys = _longs(stand_ins(hashes, longer, window)[_surviving(hashes, lengths, known, window)])
                yield {"doc_id": [doc_id] * len(keys), "key": keys}

    names = [f"known_{k}" for k in range(len(lengths))]
    return map_rows(_long_enough(_with_text(source, states), window).select("doc_id", "text", *names),
                    f"doc_id {kind}, key bigint", run)


def _exact_windows(source: DataFrame, states: DataFrame, kind: str, lengths: list[int], window: int) -> DataFrame:
    """(doc_id, a, b): two hashes of every surviving window at full length, once per document."""
    names = [c for c in states.columns if c.startswith("known_")]
    lengths = lengths[:len(names)]

    def run(batches):
        for b in batches:
            out: list[list] = [[], [], []]
            for doc_id, text, *known in zip(*(c.to_pylist() for c in b.columns)):
                hashes = word_hashes(text.encode().split())
                if len(hashes) < window:
                    continue
                first, second = (window_hashes(hashes, window, base) for base in BASES)
                if lengths:
                    mask = _surviving(hashes, lengths, known, window)
                    first, second = first[mask], second[mask]
                first, at = np.unique(first, return_index=True)
                out[0].append(np.full(len(first), doc_id, dtype=object))
                out[1].append(first.view(np.int64))
                out[2].append(second[at].view(np.int64))
            if out[0]:
                yield {n: np.concatenate(x) for n, x in zip(("doc_id", "a", "b"), out)}

    return map_rows(_long_enough(_with_text(source, states), window).select("doc_id", "text", *names),
                    f"doc_id {kind}, a bigint, b bigint", run)


def _long_enough(rows: DataFrame, window: int) -> DataFrame:
    return rows.where(F.length("text") >= 2 * window - 1)


def _cut(source: DataFrame, repeats: DataFrame, kind: str, window: int) -> DataFrame:
    """(doc_id, sha, n_removed, kept, kept_sha) of the texts that hold repeats."""
    def run(batches):
        for b in batches:
            out = []
            for doc_id, text, known in zip(*(c.to_pylist() for c in b.columns)):
                words = text.encode().split()
                hit = np.isin(window_hashes(word_hashes(words), window), np.asarray(known, dtype=np.int64).view(U64))
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                starts = np.flatnonzero(hit)
                edge[starts] += 1
                np.subtract.at(edge, starts + window, 1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                out.append((doc_id, hashlib.sha256(b" ".join(words)).digest(), int(gone.sum()), kept.decode(),
                            hashlib.sha256(kept).hexdigest()))
            if out:
                yield dict(zip(("doc_id", "sha", "n_removed", "kept", "kept_sha"), map(list, zip(*out))))

    return map_rows(_long_enough(_with_text(source, repeats), window).select("doc_id", "text", "repeats"),
                    f"doc_id {kind}, sha binary, n_removed bigint, kept string, kept_sha string", run)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP3_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (
  SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word,
         unnest([CASE WHEN k + 49 <= len(ws) THEN md5(array_to_string(ws[k:k + 49], ' ')) END
                 FOR k IN range(1, len(ws) + 1)]) AS win
  FROM docs),
starts AS (
  SELECT *, win IS NOT NULL AND min(doc_id) OVER (PARTITION BY win) < doc_id AS again FROM words),
marked AS (
  SELECT doc_id, i, word,
         bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM starts),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""
