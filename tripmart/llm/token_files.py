"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Documents are encoded once. The ids are counted over the whole corpus and
ranked by falling frequency, so frequent ids get small numbers. A number takes
one to four bytes; the byte counts, two bits each, are kept apart in control
bytes (four numbers each). Shards of up to a million ids hold the documents in
ascending id order (null ids first; repeated ids in the order of their ids'
bytes); files are Parquet, written by Spark, so any store it writes to will
do, and a lost executor's files are written again. A folder holds ``shards``
and ``ranks`` (the ids by rank, at most the vocabulary).

Reading decodes a shard with numpy: a table of 256 rows turns control bytes
into byte counts. Null and empty texts are the end id alone. Other columns are
not looked at; an empty table gives an empty folder of the same layout.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import map_rows, table, written
from tripmart.llm.encoder import ENCODED_BYTES, TextEncoder, as_binary, worker_encoder
from tripmart.session import ensure_checkpoint_dir

SHARD_IDS = 1 << 20
IDS_PER_PARTITION = 1 << 24

#: Byte counts of the four numbers that a control byte tells of.
LENGTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], dtype=np.uint8)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of uint32 numbers."""
    numbers = numbers.astype("<u4")
    codes = (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    quads = np.zeros(-(-len(numbers) // 4) * 4, dtype=np.uint8)
    quads[:len(numbers)] = codes
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= codes[:, None]
    return control.astype(np.uint8).tobytes(), numbers.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_numbers(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[at].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        out |= raw[at + k].astype(np.uint32) << np.uint32(8 * k)
    return out & MASKS[lengths]


def _encoded(docs: DataFrame, kind: str, tokenizer_file: str, end_id: int) -> DataFrame:
    """(doc_id, n, ids): ids of every document, and with n = -1 one histogram of ids a task."""
    def run(batches):
        encoder = worker_encoder(tokenizer_file)
        counts = np.zeros(0, dtype=np.int64)
        for b in batches:
            ids, bounds = encoder.encode_column(b.column(1), end_id)
            seen = np.bincount(ids, minlength=len(counts))
            seen[:len(counts)] += counts
            counts = seen
            yield {"doc_id": b.column(0), "n": np.diff(bounds), "ids": as_binary(ids, bounds)}
        yield {"doc_id": [None], "n": [-1], "ids": [counts.astype("<i8").tobytes()]}

    return map_rows(docs, f"doc_id {kind}, n bigint, ids binary", run, ENCODED_BYTES)


def _ranked(encoded: DataFrame) -> DataFrame:
    """(rank, id) by falling count, then id; at most the vocabulary."""
    def run(batches):
        for b in batches:
            for data in b.column(0).to_pylist():
                counts = np.frombuffer(data, "<i8")
                ids = np.flatnonzero(counts)
                yield {"id": ids, "n": counts[ids]}

    counts = map_rows(encoded.where("n < 0").select("ids"), "id bigint, n bigint", run).groupBy("id").agg(F.sum("n").alias("n"))
    return counts.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).alias("rank"), "id")


def flat_binary(column: pa.Array, width: str) -> np.ndarray:
    """The numbers of all binaries of a column one after the other."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(width)


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the corpus below ``path``, which must not exist; the tokenizer file lies on every machine."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    encoded = written(_encoded(narrow, kind, tokenizer_file, end_id), "token-ids")
    _ranked(encoded).write.parquet(f"{path}/ranks")
    ids = np.array([r["id"] for r in docs.sparkSession.read.parquet(f"{path}/ranks").orderBy("rank").collect()], dtype=np.int64)
    rank = np.zeros(int(ids.max(initial=-1)) + 1, dtype=np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)
    width = TextEncoder(tokenizer_file, 1).dtype.str

    rows = encoded.where("n >= 0")
    total = rows.agg(F.sum("n")).first()[0] or 0
    ordered = rows.repartitionByRange(max(1, -(-total // IDS_PER_PARTITION)), "doc_id").sortWithinPartitions("doc_id", "ids")

    def run(batches):
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []  # doc_ids, sizes and ids of rows one after the other
        size = 0

        def flush():
            nonlocal shard, before, held, size
            control, data = encode_numbers(np.concatenate([rank[ids] for _, _, ids in held]))
            row = {"part": [part], "shard": [shard], "before": [before], "doc_ids": [[d for docs, _, _ in held for d in docs]],
                   "sizes": [np.concatenate([n for _, n, _ in held])], "control": [control], "data": [data]}
            shard, before, held, size = shard + 1, before + size, [], 0
            return row

        for b in batches:
            doc_ids, sizes, ids = b.column(0).to_pylist(), b.column(1).to_numpy(), flat_binary(b.column(2), width)
            ends = np.cumsum(sizes)
            at = 0
            while at < len(sizes):  # rows up to the one that fills the shard
                done = ends[at - 1] if at else 0
                to = min(len(sizes), int(np.searchsorted(ends, done + SHARD_IDS - size)) + 1)
                held.append((doc_ids[at:to], sizes[at:to], ids[done:ends[to - 1]]))
                size += int(ends[to - 1] - done)
                at = to
                if size >= SHARD_IDS:
                    yield flush()
        if held:
            yield flush()

    shards = map_rows(ordered.select("doc_id", "n", "ids"),
                      f"part int, shard int, before bigint, doc_ids array<{kind}>, sizes array<bigint>, "
                      "control binary, data binary", run)
    shards.write.option("compression", "zstd").parquet(f"{path}/shards")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    shards = spark.read.parquet(f"{path}/shards")
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    ids = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], dtype="<u4")

    def run(batches):
        for b in batches:
            for part, before, doc_ids, sizes, control, data in zip(*(c.to_pylist() for c in b.columns)):
                found = ids[decode_numbers(control, data, sum(sizes))]
                ends = np.cumsum(sizes)
                starts = ends - sizes
                yield {"doc_id": doc_ids, "part": [part] * len(sizes), "at": starts + before, "n_tokens": sizes,
                       "ids_crc32": [zlib.crc32(found[a:e].tobytes()) for a, e in zip(starts, ends)]}

    found = map_rows(shards.select("part", "before", "doc_ids", "sizes", "control", "data"),
                     f"doc_id {kind}, part int, at bigint, n_tokens bigint, ids_crc32 bigint", run)
    # one row a written partition, so this window is as small as the list of files
    sizes = shards.select("part", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    first = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    return found.join(F.broadcast(first), "part").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{ensure_checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path)
