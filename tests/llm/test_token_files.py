import uuid
import zlib

import numpy as np
import pytest

from tripmart.llm import token_files as T

from .test_packing import FILE, whole_ids


@pytest.mark.parametrize("top", [1, 1 << 8, 1 << 16, 1 << 24, 1 << 32])
def test_number_code_round_trip(top):
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 1001):
        numbers = np.r_[rng.integers(0, top, n)].astype(np.uint32)
        control, data = T.encode_numbers(numbers)
        assert len(control) == -(-n // 4)
        assert T.decode_numbers(control, data, n).tolist() == numbers.tolist()
    edges = np.array([0, 255, 256, 65535, 65536, 16777215, 16777216, 4294967295], dtype=np.uint32)
    control, data = T.encode_numbers(edges)
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4
    assert T.decode_numbers(control, data, 8).tolist() == edges.tolist()


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_edge_rows(spark, docs, edge_texts, scratch, monkeypatch):
    monkeypatch.setattr(T, "IDS_PER_PARTITION", 1000)
    monkeypatch.setattr(T, "SHARD_IDS", 50)
    path = f"{scratch}/{uuid.uuid4().hex}"
    T.write_token_files(docs(edge_texts), path, FILE, 1)
    rows = sorted(T.read_token_files(spark, path).collect(), key=lambda r: r.start)
    want = [(i, whole_ids(t, 1)) for i, t in edge_texts]
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == sorted((repr(i), len(x), crc(x)) for i, x in want)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    empty = f"{scratch}/{uuid.uuid4().hex}"
    T.write_token_files(docs([]), empty, FILE, 1)
    assert T.read_token_files(spark, empty).count() == 0


def test_ranks_follow_frequency(spark, docs, scratch):
    path = f"{scratch}/{uuid.uuid4().hex}"
    T.write_token_files(docs([(i, "tea tea milk") for i in range(5)] + [(9, "sugar")]), path, FILE, 1)
    ranks = [r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]
    tea, milk, sugar, end = (whole_ids(w, 1)[0] for w in ("tea", "milk", "sugar", ""))
    assert ranks == [tea, end, milk, sugar]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    at, want = 0, {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = whole_ids(r.text, 1)
        want[r.doc_id] = (at, len(ids), crc(ids))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.op10_token_files(spark, sf).collect()} == want
