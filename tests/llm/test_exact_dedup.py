import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import exact_dedup as E


def norm(t):
    return re.sub("[\x20\x09-\x0d]", "", t or "")


def brute(texts):
    groups = {}
    for k, (i, t) in enumerate(texts):
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, k))
    return groups


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 20000])
def test_filter(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    f = E.BinaryFuseFilter.from_bytes(E.BinaryFuseFilter.build(keys).to_bytes())
    assert f.contains(keys).all()
    other = rng.integers(1 << 63, (1 << 64) - 1, 20000, dtype=np.uint64)
    assert f.contains(other).mean() < 0.02
    if n >= 1000:
        assert len(f.cells) < 1.6 * n


def test_equals_brute_force(spark, docs, edge_texts):
    rng = random.Random(1)
    texts = edge_texts + [(100 + k, rng.choice(["a b", "ab", "a\tb ", "c", " c", "", "é"]) * rng.randint(1, 2)) for k in range(150)]
    groups = brute(texts)
    best = {t: min(g) for t, g in groups.items()}
    for incoming in (E.half_by_hash(), F.lit(True), F.lit(False), F.lit(None).cast("boolean")):
        rows = E.exact_groups(docs(texts), incoming).collect()
        assert len(rows) == len(texts)
        by_hash = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
        for r in rows:
            t = by_hash[r.text_sha256]
            assert r.group_size == len(groups[t])
            assert r.keep_id == (None if best[t][1] else best[t][2])
        kept = [r for r in rows if r.kept]
        assert sorted(r.text_sha256 for r in kept) == sorted(by_hash) and all(r.doc_id == r.keep_id for r in kept)


def test_edge_tables(spark, docs, edge_texts):
    assert E.exact_groups(docs([]), E.half_by_hash()).count() == 0
    table = docs(edge_texts)
    kept = E.drop_exact(table, E.half_by_hash())
    assert kept.columns == table.columns
    groups = brute(edge_texts)
    want = sorted(repr(None if min(g)[1] else min(g)[2]) for g in groups.values())
    assert sorted(repr(r.doc_id) for r in kept.collect()) == want
    assert E.drop_exact(docs([]), E.half_by_hash()).count() == 0


def test_byte_check_tells_equal_digests_apart(spark, docs):
    """With a digest that is the same for all, the check still finds the rows unlike their representative."""
    source = docs([(1, "aa"), (2, "a a"), (3, "b"), (4, "b ")]).select("doc_id", "text")
    digest = F.unhex(F.lit("00"))
    groups = spark.createDataFrame([(1,)], "id bigint").select(
        digest.alias("digest"), F.lit(4).cast("bigint").alias("size"), F.struct(F.col("id").alias("doc_id")).alias("best"))
    odd = E._unequal_rows(source, digest, groups).collect()
    assert sorted(r.odd_id for r in odd) == [3, 4] and len({r.other for r in odd}) == 1


def test_shuffled_digests_give_the_same(spark, docs, edge_texts, monkeypatch):
    monkeypatch.setattr(E, "BROADCAST_DIGESTS", 0)
    monkeypatch.setattr(E, "KEYS_PER_FILTER", 3)
    rows = E.exact_groups(docs(edge_texts), E.half_by_hash()).collect()
    assert sorted(r.group_size for r in rows) == sorted(len(g) for g in brute(edge_texts).values() for _ in g)


def test_whole_table_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.sql(E.OP7_SQL).fetchall()}
    assert {r.doc_id: tuple(r)[1:] for r in E.op7_exact_dedup(spark, sf).collect()} == want
