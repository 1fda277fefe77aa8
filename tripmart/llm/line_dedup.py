"""Near-equal lines across documents by a deletion-neighbourhood join; the earliest stays.

Lines are the parts of a text between line feeds, compared as word sequences.
A line is removed if an earlier line (by document id, then place) is within
``edits`` word edits of it; lines of under ``least_words`` words must be equal.
With five words at least and one edit, removed lines are 0.8 alike or more.
Lines without words always stay. Lines are judged on the input, so what makes
a line a repeat may be removed itself.

Equal lines are grouped first, so a very common line is one row from then on.
One edit leaves either the first or the second half of the shorter line as it
was; only distinct lines that share a half with another go on, and an edit is
looked for in the other half alone. Each emits, as hashed keys, itself and the
variants with one word deleted there. Two lines of equal length with the same
variant at the same place differ by a substitution, a line and an equal
variant of a longer one by an insertion. So the earliest of a key's other side
is a partner, no pairs are listed, and each line keeps its earliest partner;
the edit distance of that pair is then checked on the words.

Null texts have no lines. Rows with a null id lose nothing and make nothing a
repeat; rows that repeat an id are judged by that id and the line's place.
Very long texts are cut into lines whole; an empty table gives no rows. Other
columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import (BROADCAST_BYTES, U64, as_bytes, map_rows, materialise, mix64, small_side, table,
                                 written)
from tripmart.llm.decontaminate import edit_distance
from tripmart.llm.substring_dedup import BASES, _with_text, word_hashes

FULL, SHORTER, SAME = 0, 1, 2  # what a variant key stands for


def half_keys(words: list[bytes]) -> list[int]:
    """Keys of the halves that a line within one edit shares: first and second half when this line is the
    shorter of the two or as long, then both when it is the longer."""
    import xxhash

    keys = []
    for n in (len(words), len(words) - 1):  # words of the shorter line
        first, second = words[:n // 2], words[len(words) - (n - n // 2):]
        keys.append(xxhash.xxh64_intdigest(b" ".join(first), 2 * n) - (1 << 63))
        keys.append(xxhash.xxh64_intdigest(b" ".join(second), 2 * n + 1) - (1 << 63))
    return keys


def variant_keys(words: list[bytes], shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(role, a, b) of a line: itself, and the variants without one word of the halves that may differ.

    ``shared`` has bit k set if another line has the k-th of the line's ``half_keys``.
    """
    hashes, n = word_hashes(words), len(words)
    places = []
    for long, m in ((0, n), (1, n - 1)):  # deletions for a substitution, and for an insertion in this line
        in_second = shared >> 2 * long & 1  # first halves are alike
        in_first = shared >> 2 * long + 1 & 1
        cut = (m // 2, n - (m - m // 2))  # the first half ends, the second begins
        places.append(np.arange(0 if in_first else cut[0], n if in_second else cut[1]) if in_first or in_second
                      else np.zeros(0, dtype=np.int64))
    same, shorter = places
    keys = []
    for base in BASES:
        powers = np.multiply.accumulate(np.r_[U64(1), np.full(n, base, dtype=U64)])
        sums = np.r_[U64(0), np.cumsum(hashes * powers[:-1], dtype=U64)]
        # the words after the deleted one move up by one place
        without = sums[:-1] + (sums[-1] - sums[1:]) * U64(pow(base, -1, 1 << 64))
        keys.append(np.r_[mix64(sums[-1:] + U64(n)), mix64(without[shorter] + U64(n - 1)),
                          mix64(mix64(without[same] + U64(n)) + same.astype(U64) + U64(1))])
    role = np.r_[FULL, np.full(len(shorter), SHORTER), np.full(len(same), SAME)]
    return role, keys[0].view(np.int64), keys[1].view(np.int64)


def line_key(joined: bytes) -> tuple[int, int]:
    import xxhash

    d = xxhash.xxh3_128_intdigest(joined)
    return (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)


def text_mark(text: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def dedup_lines(docs: DataFrame, edits: int = 1, least_words: int = 5, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, kept (text of the lines that stay; null
    where nothing was removed) and kept_sha256 (of that text, in either case). ``edits`` is 0 or 1."""
    if edits not in (0, 1):
        raise ValueError("edits must be 0 or 1")
    if least_words < 2:
        raise ValueError("lines of one word are all within one edit of each other")
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches):
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
                lines = []
                for k, line in enumerate(text.split(b"\n") if text is not None else []):
                    words = line.split()
                    if words and doc_id is not None:
                        near = edits and len(words) >= least_words
                        lines.append((k, *line_key(b" ".join(words)), half_keys(words) if near else None))
                out.append((doc_id, text.count(b"\n") + 1 if text is not None else 0, text_mark(text or b""),
                            hashlib.sha256(text or b"").digest(), lines))
            names = ("doc_id", "n_lines", "mark", "sha", "lines")
            yield dict(zip(names, map(list, zip(*out)))) if out else {n: [] for n in names}

    rows = written(map_rows(source, f"doc_id {kind}, n_lines bigint, mark bigint, sha binary, "
                            "lines array<struct<line:int,k1:bigint,k2:bigint,halves:array<bigint>>>", scan), "lines")
    every = rows.select("doc_id", "mark", F.explode("lines").alias("l")).select(
        "doc_id", "mark", "l.line", "l.k1", "l.k2", "l.halves")
    lines = written(every.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "line")).alias("first")), "first")
    near = _near_lines(source, every, lines, kind) if edits else None
    judged = lines.withColumn("near", F.lit(None).cast("boolean"))
    if near is not None:
        judged = lines.join(small_side(near, 48), ["k1", "k2"], "left")
    removed = every.select("doc_id", "mark", "line", "k1", "k2").join(judged, ["k1", "k2"]).where(
        F.coalesce("near", F.lit(False)) | (F.struct("doc_id", "line") > F.col("first")))
    per_doc = written(removed.groupBy("doc_id", "mark").agg(F.collect_set("line").alias("removed")), "removed")
    size = per_doc.agg(F.sum(F.size("removed") * 4 + 40)).first()[0] or 0
    cut = _cut(source, per_doc, size, kind).groupBy("doc_id", "mark").agg(
        F.first("n_removed").alias("n_removed"), F.first("kept").alias("kept"), F.first("kept_sha").alias("kept_sha"))
    return rows.select("doc_id", "n_lines", "mark", "sha").join(cut, ["doc_id", "mark"], "left").select(
        "doc_id", "n_lines", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"), "kept",
        F.coalesce("kept_sha", F.lower(F.hex("sha"))).alias("kept_sha256"))


def _near_lines(source: DataFrame, every: DataFrame, lines: DataFrame, kind: str) -> DataFrame:
    """(k1, k2, near = true) of the distinct lines that an earlier one is within one edit of."""
    halves = every.select("k1", F.posexplode("halves").alias("at", "half"))
    shared = materialise(halves.groupBy("half").agg(F.min("k1").alias("low"), F.max("k1").alias("high"))
                         .where("low < high").select("half"))
    likely = materialise(halves.join(small_side(shared, 16), "half").groupBy("k1").agg(
        F.bit_or(F.expr("shiftleft(1, at)")).alias("shared")))
    firsts = lines.join(small_side(likely, 24), "k1").select(
        F.col("first.doc_id").alias("doc_id"), F.struct("first.line", "k1", "k2", "shared").alias("line"))
    wanted = materialise(firsts.groupBy("doc_id").agg(F.collect_list("line").alias("wanted")))

    def texts(batches):
        for b in batches:
            for doc_id, text, own in zip(*(c.to_pylist() for c in b.columns)):
                found, out = text.split("\n"), []
                for w in own:
                    words = b" ".join(found[w["line"]].encode().split()) if w["line"] < len(found) else b""
                    # a row that repeats the id with another text may have another line there
                    if line_key(words) == (w["k1"], w["k2"]):
                        out.append((doc_id, w["line"], w["k1"], w["k2"], w["shared"], words.decode()))
                names = ("doc_id", "line", "k1", "k2", "shared", "words")
                yield dict(zip(names, map(list, zip(*out)))) if out else {n: [] for n in names}

    fetched = map_rows(_with_text(source, wanted).select("doc_id", "text", "wanted"),
                       f"doc_id {kind}, line int, k1 bigint, k2 bigint, shared int, words string", texts)
    # a number for every line that grows with its place
    known = written(fetched.dropDuplicates(["k1", "k2"]).repartitionByRange("doc_id", "line")
                    .sortWithinPartitions("doc_id", "line").withColumn("at", F.monotonically_increasing_id()), "near-lines")

    def emit(batches):
        for b in batches:
            for at, words, shared in zip(*(c.to_pylist() for c in b.columns)):
                role, a, c = variant_keys(words.encode().split(), shared)
                yield {"at": np.full(len(role), at), "role": role, "a": a, "b": c}

    variants = written(map_rows(known.select("at", "words", "shared"),
                                "at bigint, role int, a bigint, b bigint", emit), "variants")
    role = F.col("role")
    earliest = variants.groupBy("a", "b").agg(
        F.min(F.when(role == FULL, F.col("at"))).alias("full"), F.min(F.when(role == SHORTER, F.col("at"))).alias("shorter"),
        F.min(F.when(role == SAME, F.col("at"))).alias("same"), F.min("at").alias("low"), F.max("at").alias("high"))
    earliest = materialise(earliest.where("low < high").drop("low", "high"))
    partner = F.when(role == FULL, F.col("shorter")).when(role == SHORTER, F.col("full")).otherwise(F.col("same"))
    best = variants.join(small_side(earliest, 64), ["a", "b"]).select("at", partner.alias("partner")).where(
        "partner < at").groupBy("at").agg(F.min("partner").alias("partner"))
    both = best.join(known.select("at", "k1", "k2", "words"), "at").join(
        known.select(F.col("at").alias("partner"), F.col("words").alias("earlier")), "partner")

    def verify(batches):
        for b in batches:
            keys = [(k1, k2) for k1, k2, x, y in zip(*(c.to_pylist() for c in b.columns))
                    if edit_distance(x.encode().split(), y.encode().split(), 1) <= 1]
            yield {"k1": [k for k, _ in keys], "k2": [k for _, k in keys], "near": [True] * len(keys)}

    return materialise(map_rows(both.select("k1", "k2", "words", "earlier"), "k1 bigint, k2 bigint, near boolean", verify))


def _cut(source: DataFrame, per_doc: DataFrame, size: int, kind: str) -> DataFrame:
    """(doc_id, mark, n_removed, kept, kept_sha) of the texts that lose lines."""
    def run(batches):
        for b in batches:
            out = []
            for doc_id, text, mark, gone in zip(*(c.to_pylist() for c in b.columns)):
                if text is None or text_mark(text.encode()) != mark:
                    continue  # another row of that id
                gone = set(gone)
                kept = "\n".join([x for k, x in enumerate(text.split("\n")) if k not in gone])
                out.append((doc_id, mark, len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
            if out:
                yield dict(zip(("doc_id", "mark", "n_removed", "kept", "kept_sha"), map(list, zip(*out))))

    joined = source.join(F.broadcast(per_doc), "doc_id") if size <= BROADCAST_BYTES else _with_text(source, per_doc)
    return map_rows(joined.select("doc_id", "text", "mark", "removed"),
                    f"doc_id {kind}, mark bigint, n_removed bigint, kept string, kept_sha string", run)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "kept_sha256")
