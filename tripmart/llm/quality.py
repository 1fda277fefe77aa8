"""Quality scores from a sparse ensemble of rules over text statistics.

A text is described by statistics of its whole length (shares of capitals,
signs, digits, repeated words and lines, lengths), computed with numpy for many
texts at a time. A random forest of shallow trees is fitted on labelled texts;
every path from a root to a node below it is a conjunction of bounds on
statistics, one rule. A lasso logistic regression weighs the rules and leaves
out most of them; those left are compiled into one Spark column expression, so
scoring is a projection.

Learning reads at most ``max_labelled`` labelled rows, those with the smallest
hashes of their ids, one text for each id (of repeated ids the one with the
greatest statistics); all documents are scored, whole.

Null texts are empty texts; empty and blank texts have zero in every statistic
and are scored by the same rules. Very long texts are scored whole. Null ids
are scored, never learned from; repeated rows and ties get equal scores. With
no labels every score is 0.5, with labels of one kind their share (pulled in
by one row of each kind). Empty tables give empty results. Other columns are
not looked at, whatever their names.
"""

from __future__ import annotations

import math
import operator
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import as_bytes, fresh, give_back, slices, table, written

#: Labelled rows that the rules are fitted on, at most.
MAX_LABELLED = 20_000
THRESHOLD = 0.3
SEED = 13

STATISTICS = ["words", "word_length", "distinct_words", "repeated_words", "capitals", "signs", "digits", "signs_in_runs",
              "stops", "commas", "lines", "distinct_lines"]
BLANK, CAPITAL, DIGIT, SIGN, STOP, COMMA = (1 << k for k in range(6))


def _kind(char: str) -> int:
    """What ``char`` counts as; letters and marks other than capitals as nothing."""
    if char in " \t\n\x0b\x0c\r":
        return BLANK
    if (c := unicodedata.category(char)) == "Lu":
        return CAPITAL
    if c[0] == "N":
        return DIGIT
    return 0 if c[0] in "LM" else SIGN | STOP * (char in ".!?") | COMMA * (char in ",;:")


class Describer:
    """Statistics of texts, many at a time."""

    def __init__(self, known: int = 0x3000):
        self.kinds = np.zeros(0x110000, np.uint8)  # kinds of characters, filled in when first met
        self.known = known
        self.kinds[:known] = [_kind(chr(c)) for c in range(known)]
        self.met: set[int] = set()

    def classes(self, codes: np.ndarray) -> np.ndarray:
        rare = np.unique(codes[codes >= self.known])
        for c in set(rare.tolist()) - self.met:
            self.kinds[c] = _kind(chr(c))
            self.met.add(c)
        return self.kinds[codes]

    def __call__(self, raws: list[bytes | None]) -> dict[str, np.ndarray]:
        raws = [r or b"" for r in raws]
        texts = [r.decode("utf-8", "replace") for r in raws]
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        bounds = np.concatenate([np.zeros(1, np.int64), ends])
        kind = self.classes(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"))
        total = np.zeros(len(kind) + 1, np.int64)

        def count(mask: np.ndarray) -> np.ndarray:
            np.cumsum(mask, out=total[1:])
            return np.diff(total[bounds]).astype(float)

        sign = (kind & SIGN) > 0
        joined = sign[1:] & sign[:-1]
        inner = bounds[1:-1]
        joined[inner[(inner > 0) & (inner < len(kind))] - 1] = False  # neighbours of two texts
        in_run = np.zeros(len(kind), bool)
        in_run[1:] |= joined
        in_run[:-1] |= joined

        words = [r.split() for r in raws]
        lines = [[x for x in r.splitlines() if x] for r in raws]
        n, size = np.array([len(w) for w in words], float), np.diff(bounds).astype(float)
        n_lines = np.array([len(x) for x in lines], float)

        def share(part, whole):
            return np.divide(part, whole, out=np.zeros(len(raws)), where=whole > 0)

        return {
            "words": n,
            "word_length": share(size - count(kind & BLANK), n),
            "distinct_words": share(np.array([len(set(w)) for w in words], float), n),
            "repeated_words": share(np.array([sum(map(operator.eq, w, w[1:])) for w in words], float), n),
            "capitals": share(count((kind & CAPITAL) > 0), size),
            "signs": share(count(sign), size),
            "digits": share(count((kind & DIGIT) > 0), size),
            "signs_in_runs": share(count(in_run), size),
            "stops": share(count((kind & STOP) > 0), n),
            "commas": share(count((kind & COMMA) > 0), n),
            "lines": n_lines,
            "distinct_lines": share(np.array([len(set(x)) for x in lines], float), n_lines),
        }


def with_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The columns ``keep`` with one more for every statistic, and the statistics' names to their columns' names."""
    names = {k: fresh(f"_stat_{k}", docs) for k in STATISTICS}
    text = fresh("_text", docs)
    source = docs.select(*keep, F.col(text_col).cast("string").alias(text))
    schema = T.StructType(source.schema.fields[:-1] + [T.StructField(c, T.DoubleType()) for c in names.values()])

    def run(batches):
        describe = Describer()
        for b in slices(batches):
            found = describe(as_bytes(b.column(len(keep))))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *[pa.array(found[k]) for k in names]],
                                             names=[*b.schema.names[:-1], *names.values()])
        give_back()

    return source.mapInArrow(run, schema), names


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics (above, up to), all of which hold, and what they add to the log odds."""
    bounds: tuple[tuple[str, float, float], ...]
    weight: float = 0.0

    def column(self, names: dict[str, str]) -> Column:
        held = F.lit(True)
        for name, above, up_to in self.bounds:
            if above > -math.inf:
                held = held & (F.col(names[name]) > above)
            if up_to < math.inf:
                held = held & (F.col(names[name]) <= up_to)
        return held

    def holds(self, found: dict[str, np.ndarray]) -> np.ndarray:
        return np.all([(found[name] > above) & (found[name] <= up_to) for name, above, up_to in self.bounds], axis=0)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules and the log odds of a text that none of them holds for."""
    rules: tuple[Rule, ...] = ()
    bias: float = 0.0

    def score(self, names: dict[str, str]) -> Column:
        odds = F.lit(float(self.bias))
        for r in self.rules:
            odds = odds + F.when(r.column(names), F.lit(r.weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-odds))


SPLIT = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) ([^)\s]+)\)")


def tree_rules(described: str, features: list[str]) -> list[Rule]:
    """The paths from the root to every node below it, of a tree's description."""
    path: list[tuple[int, str, str, float]] = []
    out = []
    for line in described.splitlines():
        if not (m := SPLIT.match(line)):
            continue
        depth, sign, at = len(m[1]), m[4], float(m[5])
        path = [p for p in path if p[0] < depth] + [(depth, features[int(m[3])], sign, at)]
        bounds: dict[str, tuple[float, float]] = {}
        for _, name, sign, at in path:
            above, up_to = bounds.get(name, (-math.inf, math.inf))
            bounds[name] = (max(above, at), up_to) if sign == ">" else (above, min(up_to, at))
        out.append(Rule(tuple((name, *bounds[name]) for name in sorted(bounds))))
    return out


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def labelled_statistics(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id",
                        text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(_id, label, statistics...) of the learnable labelled ids, ``max_labelled`` rows at most."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("double").alias("label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(known), F.col("_doc") == F.col("_id")).select("_id", "label", "text")
    sample, names = with_statistics(sample, ["_id", "label"])
    found = F.struct(*[F.col(c).alias(k) for k, c in names.items()])
    one = sample.select("_id", "label", found.alias("found")).groupBy("_id", "label").agg(F.max("found").alias("found"))
    return one.select("_id", "label", "found.*")


def fit_lasso(held: np.ndarray, good: np.ndarray, lasso: float, steps: int = 3000) -> tuple[np.ndarray, float]:
    """Weights of 0/1 columns and bias that minimise mean log loss + ``lasso`` * the sum of absolute weights.

    Accelerated proximal steps over the distinct rows, each weighed by how often it occurs.
    """
    patterns, at = np.unique(np.packbits(held, axis=1), axis=0, return_inverse=True)
    at = at.reshape(-1)
    x = np.ones((len(patterns), held.shape[1] + 1))
    x[:, :-1] = np.unpackbits(patterns, axis=1, count=held.shape[1])
    times = np.bincount(at, minlength=len(patterns)) / len(good)
    hits = np.bincount(at, weights=good, minlength=len(patterns)) / len(good)
    step = 1.0 / (0.25 * np.linalg.eigvalsh((x * times[:, None]).T @ x).max())
    w = np.zeros(x.shape[1])
    ahead, t = w, 1.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-(x @ ahead)))
        new = ahead - step * (x.T @ (times * p - hits))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * lasso, 0.0)
        t_new = (1.0 + math.sqrt(1.0 + 4.0 * t * t)) / 2.0
        ahead = new + (t - 1.0) / t_new * (new - w)
        moved, w, t = np.abs(new - w).max(), new, t_new
        if moved < 1e-7:
            break
    return w[:-1], float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, trees: int = 30, depth: int = 3,
          lasso: float = 5e-4, seed: int = SEED) -> RuleEnsemble:
    """Rules and weights from at most ``max_labelled`` labelled rows."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    # the same rows in the same partitions each time, so that the trees are the same each time
    sample = labelled_statistics(docs, labels, max_labelled).repartition(8, "_id").sortWithinPartitions("_id")
    sample = written(sample, "quality-sample")
    found = sample.toArrow()  # at most max_labelled rows of numbers
    good = found["label"].to_numpy()
    known = RuleEnsemble(bias=math.log((good.sum() + 1) / (len(good) - good.sum() + 1)))
    if not 0 < good.sum() < len(good):
        return known
    rows = VectorAssembler(inputCols=STATISTICS, outputCol="statistics").transform(sample).select("label", "statistics")
    forest = RandomForestClassifier(labelCol="label", featuresCol="statistics", numTrees=trees, maxDepth=depth, maxBins=64,
                                    minInstancesPerNode=5, subsamplingRate=0.7, seed=seed).fit(rows)
    rules = list(dict.fromkeys(r for t in forest.trees for r in tree_rules(t.toDebugString, STATISTICS)))
    if not rules:
        return known
    columns = {k: found[k].to_numpy() for k in STATISTICS}
    weights, bias = fit_lasso(np.stack([r.holds(columns) for r in rules], axis=1), good, lasso)
    return RuleEnsemble(tuple(Rule(r.bounds, float(w)) for r, w in zip(rules, weights) if w), bias)


def quality_scores(docs: DataFrame, model: RuleEnsemble, threshold: float = THRESHOLD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score, predicted (1 from ``threshold`` on)."""
    described, names = with_statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ["doc_id"])
    scored = described.select("doc_id", model.score(names).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: RuleEnsemble, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all columns, that score ``threshold`` or more."""
    described, names = with_statistics(docs, docs.columns, text_col)
    return described.where(model.score(names) >= threshold).select(*docs.columns)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_scores(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
