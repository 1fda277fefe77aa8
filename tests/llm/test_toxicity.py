import random
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from tripmart.llm import toxicity as X

LEXICON = X.Lexicon({"idiot": 5.0, "trash": 4.0, "clown": 4.0}, ("trash can", "clown fish"), 0.5, 2.0, -6.0)


def test_folding():
    fold = X.Folder()
    assert fold("You 1D10T!") == " you idiot "
    assert fold("іdіоt, ｉｄｉｏｔ ïdïöt id​iot tr@$h") == " idiot idiot idiot idiot trash "
    assert fold("") == fold(None) == fold(" .,!? ") == ""


def test_matches_whole_words_outside_exceptions():
    m = X.Matcher(LEXICON)
    hits = [m.level(t)[1] for t in ("an idiot", "idiots", "the trash can", "trash, trash can", "Clown-fish", "IDIOT", "1d1ot\nidiot", None)]
    assert hits == [1, 0, 0, 1, 0, 1, 2, 0]


def test_longer_texts_need_more():
    m = X.Matcher(LEXICON)
    levels = [m.level("idiot" + " word" * n)[0] for n in (0, 10, 100, 1000)]
    assert levels == sorted(levels, reverse=True) and len(set(levels)) == 4


def naive_hits(text, lexicon):
    """Weights of lexicon words outside all exceptions, by trying every place of the folded text."""
    words = X.Folder()(text).split()
    inside = set()
    for phrase in lexicon.exceptions:
        p = phrase.split()
        for k in range(len(words)):
            if words[k:k + len(p)] == p:
                inside |= set(range(k, k + len(p)))
    return sorted(lexicon.weights[w] for k, w in enumerate(words) if w in lexicon.weights and k not in inside), len(words)


def test_matcher_equals_a_scan_of_all_places():
    rng = random.Random(8)
    lexicon = X.Lexicon({"idiot": 5.0, "trash": 4.0, "clown": 3.5, "fool": 3.0},
                        ("trash can", "clown fish", "big trash can", "can fool", "fool moon", "the fool"))
    words = ["idiot", "trash", "can", "clown", "fish", "big", "fool", "moon", "the", "a", "IDIOT!", "tr4sh", "Clown-fish"]
    matcher = X.Matcher(lexicon)
    for _ in range(400):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 14)))
        hits, n = naive_hits(text, lexicon)
        level, count, found = matcher.level(text)
        assert (count, found) == (len(hits), n), text
        assert np.isclose(level, np.log1p(100 * sum(hits) / max(n, 1) ** 0.5)), text


def test_long_texts_take_time_in_proportion():
    matcher = X.Matcher(LEXICON)
    text = "trash can idiot " * 8_000
    began = time.process_time()
    assert matcher.level(text)[1:] == (8_000, 24_000)
    assert time.process_time() - began < 1


def slow_learn(rows, least_ratio=16.0, least_phrase=5):
    """Words and exceptions by plain loops over all contexts."""
    fold, contexts, phrases = X.Folder(), {}, {}
    for text, toxic in rows:
        seq, own = fold(text).split(), {}
        for left, word, right in zip([""] + seq, seq, seq[1:] + [""]):
            own[word] = min(own.get(word, 1 << 63), X.hash_text(f"{left} {word} {right}"))
        for word, c in own.items():
            seen = contexts.setdefault(word, {})
            seen[c] = seen.get(c, False) or toxic
    a_all, b_all = sum(t for _, t in rows), sum(not t for _, t in rows)
    share, weights = a_all / (a_all + b_all), {}
    for word, seen in contexts.items():
        a, b = sum(seen.values()), sum(not t for t in seen.values())
        part = lambda x, e: x * np.log(x / e) if x else 0.0
        ratio = 2 * (part(a, (a + b) * share) + part(b, (a + b) * (1 - share)))
        odds = np.log((a + 0.5) / (a_all + 1)) - np.log((b + 0.5) / (b_all + 1))
        if ratio >= least_ratio and odds >= 2:
            weights[word] = odds
    for text, toxic in rows:
        seq = fold(text).split()
        for phrase in {f"{x} {y}" for x, y in zip(seq, seq[1:]) if x in weights or y in weights}:
            phrases.setdefault(phrase, []).append(toxic)
    return weights, sorted(p for p, t in phrases.items() if not any(t) and len(t) >= least_phrase)


def test_learning_equals_plain_loops(spark, docs):
    rng = random.Random(12)
    texts = []
    for i in range(500):
        words = [f"w{rng.randrange(150)}" for _ in range(20)]
        if i % 4 == 0:
            for k in rng.sample(range(19), 2):
                words[k] = rng.choice(["zork", "blarg", "quux"])
        elif i % 40 == 1:
            words[4:6] = ["zork", "garden"]
        texts.append((i, " ".join(words)))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in texts], "doc_id bigint, toxic int")
    again = [(i, "again " + t) for i, t in texts[:40] for _ in range(3)]  # repeated ids: one text each, the greatest
    by_id = {i: t for i, t in texts}
    for i, t in again:
        by_id[i] = max(by_id[i], t)
    found = X.learn(docs(texts + again), labels, least_phrase=3)
    rows = [(t, i % 4 == 0) for i, t in by_id.items() if zlib.crc32(str(i).encode()) % 3 != 1]
    weights, phrases = slow_learn(rows, least_phrase=3)
    assert found.weights.keys() == weights.keys() >= {"zork"} and list(found.exceptions) == phrases
    assert all(np.isclose(found.weights[w], weights[w]) for w in weights)


def test_curve_orders_scores():
    slope, bias = X.fit_curve(np.array([0.0] * 90 + [3.0] * 10), np.array([False] * 90 + [True] * 10))
    c = X.Lexicon(slope=slope, bias=bias).curve(np.array([0.0, 3.0]))
    assert c[0] < 0.1 and c[1] > 0.9
    assert X.fit_curve(np.zeros(0), np.zeros(0, dtype=bool)) == (1.0, -4.0)


def test_edge_rows_and_no_labels(spark, docs, edge_texts):
    table = docs(edge_texts)
    rows = X.toxicity_scores(table, LEXICON).collect()
    assert len(rows) == len(edge_texts) and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    empty = spark.createDataFrame([], "doc_id bigint, toxic int, text string, score double")
    assert X.learn(table, empty) == X.Lexicon()
    labels = spark.createDataFrame([(1, None, "x", 0.0), (None, 1, "x", 0.0), (4, 0, "x", 0.0), (4, 0, "x", 0.0)], empty.schema)
    assert X.learn(table, labels).weights == {}
    assert X.toxicity_scores(docs([]), X.Lexicon()).count() == 0


def test_drop_toxic_keeps_columns_and_clean_rows(spark, docs):
    table = docs([(1, "you idiot " * 5), (2, "a fine day"), (None, "trash can"), (3, None), (4, "idiot " * 3), (4, "fine")])
    kept = X.drop_toxic(table, LEXICON)
    assert kept.columns == table.columns
    assert sorted((repr(r.doc_id), r.text) for r in kept.collect() if r.text) == [("2", "a fine day"), ("4", "fine"), ("None", "trash can")]


def test_learns_words_and_exceptions_but_not_copies(spark, docs):
    texts, labels = [], []
    for i in range(300):
        words = [f"w{(i * 7 + k * k) % 211}" for k in range(30)]
        toxic = i % 3 == 0
        if toxic:
            words[i % 25] = words[(i + 9) % 25] = "zork"
        elif i % 25 == 0:
            words[3:5] = ["zork", "garden"]
        texts.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    copy = "copied text of many words that no other document has at all"
    texts += [(1000 + i, copy) for i in range(80)]
    labels += [(1000 + i, 1) for i in range(80)]
    frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = X.learn(docs(texts), frame, least_phrase=3)
    assert set(found.weights) == {"zork"} and "zork garden" in found.exceptions
    small = X.learn(docs(texts), frame, max_labelled=0)
    assert small.weights == {}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = X.op1_toxicity(spark, sf).where("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_held_out_rows():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = spark.range(50).select("id", X.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)
