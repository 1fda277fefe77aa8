import hashlib
import random

import pytest

from tripmart.llm import line_dedup as L

from .conftest import prose


def one_edit(a, b):
    """True if two word sequences differ by at most one insertion, deletion or substitution."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute(texts, least=5, edits=1):
    lines = [(i, k, x.encode().split()) for i, t in texts if i is not None and t is not None for k, x in enumerate(t.split("\n"))]
    out = []
    for i, t in texts:
        kept, gone = [], 0
        for k, x in enumerate(t.split("\n") if t is not None else []):
            w = x.encode().split()
            again = i is not None and w and any(
                (j, m) < (i, k) and (v == w or edits and min(len(v), len(w)) >= least and one_edit(v, w)) for j, m, v in lines)
            gone += bool(again)
            kept += [] if again else [x]
        out.append((repr(i), len(t.split("\n")) if t is not None else 0, gone, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def got(frame):
    return sorted((repr(r.doc_id), r.n_lines, r.n_removed, r.kept_sha256) for r in frame.collect())


@pytest.mark.parametrize("edits", [0, 1])
def test_equals_brute_force(spark, docs, edits):
    rng = random.Random(edits)
    base = [prose(rng, rng.randint(1, 9), 30) for _ in range(25)]

    def line():
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(words) + 1)
            words[at:at + rng.randrange(2)] = [f"w{rng.randrange(30)}"] * rng.randrange(2)
            words = words or ["w1"]
        return rng.choice(["", "  "]) + " ".join(words)

    texts = [(i, "\n".join(line() for _ in range(rng.randint(0, 8)))) for i in range(60)]
    texts += [(5, texts[9][1]), (None, texts[3][1]), (61, None), (62, "\n\n"), (62, texts[1][1])]
    assert got(L.dedup_lines(docs(texts), edits)) == brute(texts, edits=edits)


def test_chains_of_edits_and_common_lines(spark, docs):
    words = [f"a{i}" for i in range(12)]
    texts = [(0, " ".join(words))]
    for i in range(1, 40):  # each one edit from the line before
        words = [*words[:i % 12], f"b{i}", *words[i % 12 + 1:]] if i % 3 else [*words, f"c{i}"] if i % 2 else words[1:]
        texts.append((i, "a very common line of words\n" + " ".join(words)))
    assert got(L.dedup_lines(docs(texts))) == brute(texts)


def test_edge_rows(spark, docs, edge_texts):
    assert got(L.dedup_lines(docs(edge_texts))) == brute(edge_texts)
    assert L.dedup_lines(docs([])).count() == 0
    with pytest.raises(ValueError):
        L.dedup_lines(docs([]), edits=2)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(L.op5_line_dedup(spark, sf)) == brute(texts)
