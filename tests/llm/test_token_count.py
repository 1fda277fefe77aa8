import random

import public_tokenizers
import pytest
import sentencepiece

from tripmart.llm import token_count as C

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_equal_the_library(library):
    rng, merger = random.Random(5), C.PairMerger.from_model(MODEL)
    letters = " \n\t  aeiou the▁日é.,'<>/s0123 　\U0001f600́ABC"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    assert [merger.count(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_bounded_caches_change_nothing(library):
    rng = random.Random(6)
    merger = C.PairMerger(C.PairMerger.from_model(MODEL).rank, max_cached=20)
    texts = ["\n".join(" ".join(f"word{rng.randrange(200)}x" for _ in range(9)) for _ in range(5)) for _ in range(50)]
    assert [merger.count(t) for t in texts] == [len(x) for x in library.encode(texts)]
    assert len(merger.words) <= 20 and len(merger.words.old) <= 20 and len(merger.parts) <= 10


def test_other_vocabulary_kinds_are_refused():
    with pytest.raises((ValueError, OSError, RuntimeError)):
        C.PairMerger.from_model(public_tokenizers.path("word_bpe_49k.json"))


def test_edge_rows(spark, docs, edge_texts, library):
    rows = C.token_counts(docs(edge_texts), MODEL, limit=20).collect()
    want = sorted((repr(i), len((t or "").encode()), len(library.encode(t or ""))) for i, t in edge_texts)
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 20) for r in rows)
    assert C.token_counts(docs([]), MODEL).count() == 0


def test_whole_table(spark, library):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: len(library.encode(r.text or "")) for r in table.collect()}
    assert {r.doc_id: r.n_tokens for r in C.op2_token_counts(spark, "/root/testdata/sf0.001").collect()} == want
