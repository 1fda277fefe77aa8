import random

import numpy as np
import xxhash

from tripmart.llm import simhash as S
from tripmart.llm.common import U64
from tripmart.llm.components import component_roots


def slow_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_values(rng, n):
    base = [rng.getrandbits(64) for _ in range(max(1, n // 12))]
    out = set()
    while len(out) < n:
        v = rng.choice(base)
        for _ in range(rng.randrange(5)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return sorted(out)


def test_fingerprint(edge_texts):
    for _, t in edge_texts + [(0, "A b"), (0, "ÄB c D e"), (0, "one")]:
        assert S.fingerprint(t.encode() if t else None) == slow_fingerprint(t)


def test_bit_sliced_buckets_equal_brute_force():
    rng = random.Random(3)
    for radius in (0, 1, 2, 3, 6):
        values = near_values(rng, 300)
        rng.shuffle(values)
        run = np.sort(np.array([rng.randrange(7) for _ in values]))
        v = np.array(values, dtype=U64)
        row, root = S.bucket_links(run, v, radius, chunk=64)
        label = dict(zip(row.tolist(), root.tolist()))
        for k in range(7):
            at = np.flatnonzero(run == k).tolist()
            want = roots_of(at, lambda a, b: (values[a] ^ values[b]).bit_count() <= radius)
            assert {a: label.get(a, a) for a in at} == want


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r.u: r.v for r in component_roots(spark.createDataFrame(edges + [(None, 3)], "u bigint, v bigint")).collect()}
    linked = set(edges) | {(b, a) for a, b in edges}
    want = roots_of(sorted({x for e in edges for x in e}), lambda a, b: (a, b) in linked)
    assert got == {n: r for n, r in want.items() if n != r}
    assert component_roots(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_links_with_tiles_connect_all_near_values(spark):
    values = near_values(random.Random(8), 400)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values] + [(None,)]
    frame = spark.createDataFrame(signed, "fp bigint")
    want = roots_of(values, lambda a, b: (a ^ b).bit_count() <= 2)
    for tile in (4096, 8):
        links = [(r.u % (1 << 64), r.v % (1 << 64)) for r in S.near_links(frame, 2, tile).collect()]
        assert all((a ^ b).bit_count() <= 2 or want[a] == want[b] for a, b in links)
        pairs = set(links) | {(b, a) for a, b in links}
        assert roots_of(values, lambda a, b: (a, b) in pairs) == want


def test_edge_rows(spark, docs, edge_texts):
    rows = S.simhash_components(docs(edge_texts)).collect()
    assert len(rows) == len(edge_texts)
    by_text = {}
    for i, t in edge_texts:
        by_text.setdefault(slow_fingerprint(t), []).append(i)
    names = {f: min((x for x in ids if x is not None), default=None) for f, ids in by_text.items()}
    root = roots_of(sorted(names), lambda a, b: (a ^ b).bit_count() <= 2)
    for r in rows:
        mine = [names[f] for f in names if root[f] == root[r.fp % (1 << 64)]]
        assert r.component_id == min((x for x in mine if x is not None), default=None)
    assert S.simhash_components(docs([])).count() == 0


def test_one_of_each_group_stays(spark, docs, edge_texts):
    table = docs(edge_texts)
    kept = S.drop_near(table)
    assert kept.columns == table.columns
    ids = sorted(r.doc_id for r in kept.collect())
    groups = {r.root: r.component_id for r in S.simhash_components(table).collect()}
    assert ids == sorted(groups.values())
    assert S.drop_near(docs([])).count() == 0


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    fps = {r.doc_id: slow_fingerprint(r.text) for r in table}
    root = roots_of(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.op8_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: (f"{f:016x}", root[i]) for i, f in fps.items()}
