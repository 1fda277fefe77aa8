import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from tripmart.llm import packing as P
from tripmart.llm.encoder import TextEncoder, as_binary
from tripmart.llm.token_files import flat_binary

FILE = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text, end):
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids + [end]


def checked(rows, texts, capacity, end=2):
    """Every id in one piece, sequences gapless and within capacity; returns the padding's share."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    padding = total = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(whole_ids(t, end))
    assert set(by_doc) == set(want)
    for i, pieces in by_doc.items():
        if len(want[i]) > 1:  # repeated ids: only the sums can be told apart
            assert sum(r.length for r in pieces) == sum(map(len, want[i]))
            continue
        ids, at = want[i][0], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return padding / max(1, total)


def test_encoder_equals_the_library():
    rng = random.Random(5)
    letters = " \n\t  aeiou the日é.,'<>/s0123 　\U0001f600́ABCİΣςÀßſKÅ<|endoftext|>\x85\x1c|’"
    encoder = TextEncoder(FILE, 50)
    for _ in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert encoder.encode(t.encode()) == encoder.whole(t)
    assert encoder.encode(None) == encoder.encode(b"") == b""


def test_columns_of_texts_equal_the_library():
    rng = random.Random(6)
    letters = "abcXYZéßÉłİıſǅ.,;:!?$%&*#'<|> \n0129́日-_/@"
    texts = [None, "", " ", "\n a\t", *("".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000))]
    encoder = TextEncoder(FILE, 60)
    assert encoder.by_word and encoder.shortcut
    slow = TextEncoder(FILE, 60)
    slow.by_word = False
    for e in (encoder, slow):
        ids, bounds = e.encode_column(pa.array(texts).slice(1), 2)
        rows = as_binary(ids, bounds).to_pylist()
        assert rows == [e.whole(t or "") + e.pack([2]) for t in texts[1:]]
    assert flat_binary(as_binary(ids, bounds).slice(5, 40), encoder.dtype.str).tobytes() == b"".join(rows[5:45])
    ids, bounds = encoder.encode_column(pa.array([], pa.string()), 2)
    assert len(ids) == 0 and bounds.tolist() == [0]


def test_packer_space_and_fit():
    rng, packer, done = random.Random(1), P.Packer(64, 4, 5), []
    for k in range(400):
        n = rng.randint(1, 150)
        done += packer.add(P.Piece(k, 0, np.arange(n, dtype="<u2"), n))
        assert len(packer.open) == len(packer.free) <= 4
    for s in done:
        assert 64 - 5 < sum(len(p.ids) for p in s) <= 64
    tail = [sum(len(p.ids) for p in s) for s in packer.tail()]
    assert all(n == 64 or n & (n - 1) == 0 for n in tail)


def test_levels_of_leftovers(spark, docs, monkeypatch):
    monkeypatch.setattr(P, "FAN_IN", 2)
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice(["tea", "coffee", "milk", "sugar"]) for _ in range(rng.randint(0, 90)))) for i in range(200)]
    rows = P.pack(docs(texts).repartition(9), FILE, 2, capacity=128, windows=3, least=8).collect()
    assert checked(rows, texts, 128) < 0.05
    assert len({r.sequence_id >> 56 for r in rows}) > 2  # packed on several levels


def test_edge_rows(spark, docs, edge_texts):
    assert checked(P.pack(docs(edge_texts), FILE, 2).collect(), edge_texts, 4096) < 0.05
    assert P.pack(docs([]), FILE, 2).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert checked(P.op6_packing(spark, sf).collect(), texts, 4096) < 0.02
