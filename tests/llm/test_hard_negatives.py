import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, score bigint, slot int, `row` string, id string, vector string"


def vectors(spark, rows):
    """(vec_id, embedding, label) with further columns of clashing names."""
    return spark.createDataFrame([(*r, 7, 1, "x", "y", "z") for r in rows], SCHEMA)


def brute(rows, anchor, positives=5, negatives=10):
    taking = [(i, [int(np.floor(256 * float(x))) for x in v], y) for i, v, y in rows
              if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]

    def product(v, w):
        return sum(a * b for a, b in zip(v, w))

    def first(scored, n):
        return sorted(scored, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:n]

    out = []
    for a, (i, v, y) in enumerate(taking):
        if i is None or not anchor(i):
            continue
        same = [(product(v, w), j) for b, (j, w, z) in enumerate(taking) if z == y and b != a]
        other = [(product(v, w), j) for j, w, z in taking if z != y]
        for score, j in first(same, positives):
            inside = [(s, k) for s, k in other if 30 * score <= 100 * s <= 90 * score]
            out += [(i, j, r, k, score, s) for r, (s, k) in enumerate(first(inside, negatives), 1)]
    return out


def order(rows):
    return sorted(tuple(r) for r in rows) if None not in {x for r in rows for x in r} else sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (64, 64, 64), (65, 33, 71), (130, 100, 257), (0, 4, 3)])
def test_strassen_equals_the_plain_product(shape):
    m, k, n = shape
    rng = np.random.default_rng(sum(shape))
    for top in (3, 1 << 20, 1 << 28):
        a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
        assert (H.strassen(a, b, leaf=8) == a @ b).all()


def test_heaps_merge():
    rng = np.random.default_rng(3)
    slots, scores, ids = rng.integers(0, 4, 900), rng.integers(-20, 20, 900), rng.permutation(900)
    low, high = np.array([-20, 0, 5, 1]), np.array([20, 10, 4, 1])
    whole, parts = H.Heaps(low, high, 6), [H.Heaps(low, high, 6) for _ in range(3)]
    for at in range(0, 900, 100):
        cut = slice(at, at + 100)
        whole.push(slots[cut], scores[cut], ids[cut])
        parts[at // 100 % 3].push(slots[cut], scores[cut], ids[cut])
    merged = H.Heaps(low, high, 6)
    for p in parts:
        merged.push(*p.entries)
    want = sorted((s, -x, i) for s, x, i in zip(slots, scores, ids) if low[s] <= x <= high[s])
    want = [w for s in range(4) for w in [x for x in want if x[0] == s][:6]]
    for h in (whole, merged):
        assert [(s, -x, i) for s, x, i in zip(*h.entries)] == want


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, -0.1, 0.0, 0.004, 0.3, 0.31]) for _ in range(6)], rng.choice([0, 0, 1, 2])) for i in range(160)]
    hot = [(1000 + i, [0.3] * 6, 0) for i in range(90)]  # one vector and label holds a third of the rows
    odd = [(500, None, 1), (510, [0.1] * 6, None), (520, [0.1, None] + [0.1] * 4, 1), (530, [float("nan")] * 6, 0),
           (540, [float("inf")] + [0.0] * 5, 0), (550, [0.3, 0.3], 1), (560, [], 2), (None, [0.31] * 6, 0), (None, [0.3] * 6, 2),
           (20, [0.3] * 6, 1), (20, [0.3] * 6, 1), (570, [0.2] * 6, 9)]
    rows += hot + odd
    table = vectors(spark, rows)
    want = brute(rows, lambda i: i % 10 == 0)
    found = H.mine(H.prepared(table), F.col("id") % 10 == 0).collect()
    assert order(found) == order(want)
    # anchors in blocks, tiles and files of few rows give the same
    monkeypatch.setattr(H, "BLOCK_BYTES", 6 * 8 * 9)
    monkeypatch.setattr(H, "TILE_ANCHORS", 4)
    monkeypatch.setattr(H, "TILE_ROWS", 16)
    monkeypatch.setattr(H, "TASK_ROWS", 100)
    assert order(H.mine(H.prepared(table), F.col("id") % 10 == 0).collect()) == order(want)


def test_empty_tables(spark):
    for rows in ([], [(1, [0.1], 0)], [(100, None, 0)], [(100, [], 0), (200, [], 1)], [(100, [0.5], 0)]):
        found = H.mine(H.prepared(vectors(spark, rows)), F.col("id") % 100 == 0)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert found.collect() == []


def test_zero_and_negative_positives(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [-1.0, 0.0], 0), (3, [0.0, -1.0], 1), (4, [1.0, 1.0], 1)]
    found = H.mine(H.prepared(vectors(spark, rows)), F.col("id") == 0).collect()
    assert order(found) == order(brute(rows, lambda i: i == 0)) == [(0, 1, 1, 3, 0, 0)]
