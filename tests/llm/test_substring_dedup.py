import hashlib
import random

import duckdb
import numpy as np
import pytest

from tripmart.llm import substring_dedup as D

from .conftest import prose


def brute(texts, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in texts]
    for i, w in split:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        left = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((repr(i), len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def got(frame):
    return sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect())


def test_sliding_min_and_hashes():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 40, 60).astype(np.uint64)
    for width in (1, 2, 3, 7, 8, 26, 60, 61):
        assert D.sliding_min(v, width).tolist() == [min(v[i:i + width]) for i in range(60 - width + 1)]
    words = [b"a", b"b", b"a", b"b", b"c", b"a", b"b"]
    h = D.window_hashes(D.word_hashes(words), 2)
    assert h[0] == h[2] == h[5] and len(set(h.tolist())) == 4
    assert D.lengths_of(25, 50) == [25] and D.lengths_of(2, 9) == [2, 4, 8] and D.lengths_of(9, 9) == []


@pytest.mark.parametrize("window,start", [(6, 3), (7, 2), (5, 5)])
def test_equals_brute_force(spark, docs, window, start):
    rng = random.Random(window)
    passages = [prose(rng, rng.randint(3, 14), 9) for _ in range(8)]
    texts = [(i, " \n".join(rng.choice(passages + [prose(rng, 5)]) for _ in range(rng.randint(0, 7)))) for i in range(60)]
    texts += [(3, texts[5][1]), (None, texts[5][1]), (70, None), (70, texts[9][1])] + [(80 + i, texts[2][1]) for i in range(5)]
    assert got(D.remove_repeats(docs(texts), window, start)) == brute(texts, window)


def test_edge_rows(spark, docs, edge_texts):
    assert got(D.remove_repeats(docs(edge_texts))) == brute(edge_texts, 50)
    assert D.remove_repeats(docs([])).count() == 0


def test_kept_text(spark, docs):
    passage = prose(random.Random(1), 60, 999)
    rows = {r.doc_id: r for r in D.remove_repeats(docs([(1, passage), (2, f"before {passage}\nafter")])).collect()}
    assert rows[1].kept is None and rows[1].n_removed == 0
    assert rows[2].kept == "before after" and rows[2].n_removed == 60


def test_whole_table_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.sql(D.OP3_SQL).fetchall()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in D.op3_substring_dedup(spark, sf).collect()} == want
