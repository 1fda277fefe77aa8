import math
import re
import unicodedata
import zlib

import numpy as np
from pyspark.sql import functions as F

from tripmart.llm import quality as Q


def described(text):
    """The statistics of one text, character by character."""
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in re.split("[\n\r]", text) if x]
    kinds = [unicodedata.category(c) for c in text]
    blank = [c in " \t\n\x0b\x0c\r" for c in text]
    signs = [not b and k[0] not in "LMN" for k, b in zip(kinds, blank)]
    runs = [s and (k > 0 and signs[k - 1] or signs[k + 1:k + 2] == [True]) for k, s in enumerate(signs)]
    n, size = len(words), len(text)
    share = lambda a, b: a / b if b else 0.0
    return [n, share(size - sum(blank), n), share(len(set(words)), n), share(sum(a == b for a, b in zip(words, words[1:])), n),
            share(sum(k == "Lu" for k in kinds), size), share(sum(signs), size), share(sum(k[0] == "N" for k in kinds), size),
            share(sum(runs), size), share(sum(c in ".!?" for c in text), n), share(sum(c in ",;:" for c in text), n),
            len(lines), share(len(set(lines)), len(lines))]


def test_statistics_of_many_texts_at_once(spark, docs, edge_texts):
    texts = [t for _, t in edge_texts] + ["!!", "?", "a!!", "!!b", "É́é ß２ 　x", "one\r\none\n\ntwo", "𝔸𝔹 ①​", "a a a b b"]
    found = Q.Describer()([None if t is None else t.encode() for t in texts])
    assert list(found) == Q.STATISTICS
    for k, t in enumerate(texts):
        assert np.allclose([found[s][k] for s in Q.STATISTICS], described(t)), t and t[:50]
    table = docs([(k, t) for k, t in enumerate(texts)])
    out, names = Q.with_statistics(table, table.columns)
    assert out.columns == table.columns + list(names.values())
    for r in out.collect():
        assert np.allclose([r[names[s]] for s in Q.STATISTICS], described(r.text))


def test_tree_paths_become_rules():
    tree = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=2
  If (feature 0 <= 0.5)
   If (feature 0 <= 1.0E-4)
    Predict: 0.0
   Else (feature 0 > 1.0E-4)
    Predict: 1.0
  Else (feature 0 > 0.5)
   Predict: 1.0
"""
    inf = math.inf
    assert [r.bounds for r in Q.tree_rules(tree, ["a", "b"])] == [
        (("a", -inf, 0.5),), (("a", -inf, 1e-4),), (("a", 1e-4, 0.5),), (("a", 0.5, inf),)]


def test_compiled_rules_equal_numpy(spark):
    rng = np.random.default_rng(1)
    rows = rng.random((200, 2)).round(1)
    rules = tuple(Q.Rule((("a", lo, hi), ("b", lo / 2, math.inf)), w) for lo, hi, w in [(0.1, 0.5, 1.5), (-math.inf, 0.3, -2.0), (0.7, math.inf, 0.25)])
    model = Q.RuleEnsemble(rules, -0.3)
    frame = spark.createDataFrame(rows.tolist(), "x double, y double")
    got = [r[0] for r in frame.select(model.score({"a": "x", "b": "y"})).collect()]
    odds = model.bias + sum(r.weight * r.holds({"a": rows[:, 0], "b": rows[:, 1]}) for r in rules)
    assert np.allclose(got, 1 / (1 + np.exp(-odds)))


def test_lasso_reaches_the_optimum():
    """At the optimum the slope of the loss is -lasso * sign for weights in use, and within lasso for others."""
    rng = np.random.default_rng(4)
    held = rng.random((600, 12)) < 0.4
    held[:, 11] = held[:, 0]
    good = (rng.random(600) < 1 / (1 + np.exp(-(2.0 * held[:, 0] - 1.5 * held[:, 1] + 0.2)))).astype(float)
    for lasso in (0.001, 0.02, 1.0):
        w, bias = Q.fit_lasso(held, good, lasso, steps=20_000)
        slope = held.T @ (1 / (1 + np.exp(-(held @ w + bias))) - good) / len(good)
        used = np.abs(w) > 1e-6
        assert np.allclose(slope[used], -lasso * np.sign(w[used]), atol=2e-4) and (np.abs(slope) <= lasso + 2e-4).all()
    assert not w.any() and math.isclose(bias, math.log(good.mean() / (1 - good.mean())), abs_tol=1e-3)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, text string, score double")


def test_edge_rows_and_labels(spark, docs, edge_texts):
    table = docs(edge_texts)
    model = Q.learn(table, labels(spark, []))
    assert model == Q.RuleEnsemble(bias=0.0)
    rows = Q.quality_scores(table, model).collect()
    assert len(rows) == len(edge_texts) and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    one_kind = Q.learn(table, labels(spark, [(i, 1, "x", 0.0) for i in (4, 6, 7, 8, None)] + [(9, None, "x", 0.0)]))
    assert one_kind.rules == () and one_kind.bias > 0
    assert Q.quality_scores(docs([]), model).count() == 0
    assert Q.keep_good(docs([]), model).columns == table.columns


def test_learning_is_bounded_and_the_same_each_time(spark, docs):
    rows, known = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, " ".join(f"w{(i * k) % 97}" + ("%%" if bad else "") for k in range(1, 30))))
        known.append((i, int(not bad), "x", 0.0))
    rows += [(5, "again and again")] * 50  # rows that repeat an id count once
    table = docs(rows)
    assert Q.labelled_statistics(table, labels(spark, known), 100).count() == 100
    model = Q.learn(table, labels(spark, known))
    assert model.rules and model == Q.learn(table.repartition(3), labels(spark, known))
    out = Q.keep_good(table, model)
    assert out.columns == table.columns
    assert sorted(r.doc_id for r in out.collect() if r.doc_id != 5) == [i for i in range(400) if i % 4 and i != 5]


def test_held_out_rows(spark):
    rows = spark.range(60).select("id", Q.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = Q.op13_quality_rules(spark, sf).where("held_out").join(known, "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
    assert sum(r.predicted for r in bad) <= 0.05 * len(bad)
