"""Toxicity scores from a weighted lexicon matched by Aho-Corasick on folded text.

Folding decomposes accents, maps look-alike letters of other scripts and digit
or sign substitutions to plain letters, and turns the rest into single spaces.
The automaton finds lexicon words and exception phrases in one pass; a lexicon
word inside a found exception phrase does not count. The weights of the words
found are summed and divided by a power of the text's length in words; a
logistic curve turns that into a score from 0 to 1.

The lexicon is learned from labelled rows: words whose contexts in toxic texts
are far more frequent than in others, by the likelihood ratio, weighted by
their log odds. Contexts (previous word, word, next word) are counted once
over all rows and once a row, so copies of a text do not make its words
suspicious. Phrases of a lexicon word and a neighbour that occur only in
clean texts become exceptions. Learning reads at most ``max_labelled`` rows,
those with the smallest hashes of their ids, one text for each id (the greatest
where an id is repeated); all words and phrases that pass the tests are used.

Null and empty texts have no words and get the curve's lowest score, as do
all texts when there are no labels. Null ids are scored, never learned from.
Very long texts are matched whole, in time proportional to their length.
Repeated rows and ties get equal scores; empty tables give empty results;
other columns are not looked at.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import filter_rows, map_rows, materialise, table

#: Labelled rows that the lexicon and the curve are fitted on, at most.
MAX_LABELLED = 20_000
THRESHOLD = 0.7

#: Substitutions of digits and signs for letters.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"}
#: Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "γ": "y", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ɑ": "a",
    "ɡ": "g", "ⅼ": "l", "ℓ": "l",
}
#: Signs that end a word or stand alone.
LONE_SIGNS = re.compile(r"(?<!\w)[!|]+|[!|]+(?!\w)")
#: Zero-width characters, which hide a word from a plain match.
HIDDEN = "​‌‍⁠﻿­"


def _folds() -> dict[int, str]:
    """Characters to what they fold to, for all below 0x3000; others fold when first met."""
    return {c: _folded(chr(c)) for c in range(0x3000)}


def _folded(char: str) -> str:
    if char in HIDDEN:
        return ""
    out = []
    for c in unicodedata.normalize("NFKD", char).lower():
        if unicodedata.combining(c):
            continue
        c = LOOKALIKES.get(c, SIGNS.get(c, c))
        out.append(c if c.isalnum() else " ")
    return "".join(out)


class Folder:
    """Folds texts; a sign only stands for a letter next to one ("idiot!" ends a word)."""

    def __init__(self):
        class Table(dict):
            def __missing__(self, code):
                self[code] = out = _folded(chr(code))
                return out

        self.table = Table(_folds())

    def __call__(self, text: str | None) -> str:
        """`` word word `` with single spaces, and one at both ends; empty when there is no word."""
        if not text:
            return ""
        if "!" in text or "|" in text:
            text = LONE_SIGNS.sub(" ", text)
        words = text.translate(self.table).split()
        return f" {' '.join(words)} " if words else ""


@dataclass(frozen=True)
class Lexicon:
    """Weights of folded words, exception phrases, and the curve over the normalised sum."""
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    power: float = 0.5  # a text of n words divides its sum by n ** power
    slope: float = 1.0
    bias: float = -4.0

    def curve(self, level):
        return 1.0 / (1.0 + np.exp(-(self.bias + self.slope * level)))


class Matcher:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon, self.fold = lexicon, Folder()
        self.automaton = ahocorasick.Automaton()
        for word, weight in lexicon.weights.items():
            self.automaton.add_word(f" {word} ", (weight, len(word)))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(f" {phrase} ", (None, len(phrase)))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def level(self, text: str | None) -> tuple[float, int, int]:
        """Normalised weight of the lexicon words found, how many, and the words of the text."""
        folded = self.fold(text)
        if not folded or self.empty:
            return 0.0, 0, max(0, folded.count(" ") - 1)
        n = folded.count(" ") - 1
        found = [(end - size, end, weight) for end, (weight, size) in self.automaton.iter(folded)]
        if not found:
            return 0.0, 0, n
        hits = outside(found)
        # a few per mille of the words count as much in any text; sums grow on a log scale
        return float(np.log1p(100.0 * sum(hits) / n ** self.lexicon.power)), len(hits), n


def outside(found: list[tuple[int, int, float | None]]) -> list[float]:
    """Weights of the words found (from, to, weight) that lie in no exception found (weight None); one sorted pass."""
    hits, furthest = [], -1
    # at the same start exceptions come first; a word lies in one that starts no later if any of those ends no sooner
    for _, is_word, end, weight in sorted((a, w is not None, b, w) for a, b, w in found):
        if not is_word:
            furthest = max(furthest, end)
        elif end > furthest:
            hits.append(weight)
    return hits


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
                    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(text, toxic) of the learnable labelled ids, at most ``max_labelled`` rows: one text for each id."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).alias("toxic"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(known), F.col("_doc") == F.col("_id"))
    return found.groupBy("_id", "toxic").agg(F.max("text").alias("text")).select("text", "toxic")


def _word_contexts(sample: DataFrame) -> DataFrame:
    """(word, context, toxic): for each text and distinct word the smallest hash of its contexts."""
    def run(batches):
        fold = Folder()
        for b in batches:
            words, contexts, toxic = [], [], []
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seq = fold(text).split()
                seen: dict[str, int] = {}
                for left, word, right in zip([""] + seq, seq, seq[1:] + [""]):
                    c = hash_text(f"{left} {word} {right}")
                    if c < seen.get(word, 1 << 63):
                        seen[word] = c
                words += seen.keys()
                contexts += seen.values()
                toxic += [label] * len(seen)
            yield {"word": words, "context": contexts, "toxic": toxic}

    return map_rows(sample.select("text", "toxic"), "word string, context bigint, toxic boolean", run)


def hash_text(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) >> 1


def _word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean): distinct contexts of every word by label."""
    seen = _word_contexts(sample).repartition("word").groupBy("word", "context").agg(F.max("toxic").alias("toxic"))
    return seen.groupBy("word").agg(F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("clean"))


def _suspicious(counts: DataFrame, toxic: int, clean: int, least_ratio: float) -> dict[str, float]:
    """Words far more frequent in toxic texts, by the likelihood ratio, with their log odds."""
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    share = F.lit(toxic / (toxic + clean))

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    ratio = 2 * (part(a, (a + b) * share) + part(b, (a + b) * (1 - share)))
    odds = F.log((a + 0.5) / (toxic + 1.0)) - F.log((b + 0.5) / (clean + 1.0))
    found = counts.select("word", ratio.alias("ratio"), odds.alias("odds")).where(
        (F.col("ratio") >= least_ratio) & (F.col("odds") >= 2.0)).orderBy("word")
    return {r["word"]: float(r["odds"]) for r in found.collect()}


def _benign_phrases(sample: DataFrame, weights: dict[str, float], least: int) -> tuple[str, ...]:
    """Phrases of a lexicon word and a neighbour that at least ``least`` clean texts and no toxic one hold."""
    known = frozenset(weights)

    def run(batches):
        fold = Folder()
        for b in batches:
            phrases, toxic = [], []
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seq = fold(text).split()
                own = {f"{x} {y}" for x, y in zip(seq, seq[1:]) if x in known or y in known}
                phrases += own
                toxic += [label] * len(own)
            yield {"phrase": phrases, "toxic": toxic}

    counts = map_rows(sample.select("text", "toxic"), "phrase string, toxic boolean", run).groupBy("phrase").agg(
        F.count_if(~F.col("toxic")).alias("clean"), F.max("toxic").alias("toxic"))
    found = counts.where((F.col("clean") >= least) & ~F.col("toxic")).orderBy("phrase")
    return tuple(r["phrase"] for r in found.collect())


def fit_curve(levels: np.ndarray, toxic: np.ndarray, ridge: float = 1e-4) -> tuple[float, float]:
    """Slope and bias of a logistic curve, by Newton steps."""
    if not len(levels) or toxic.all() or not toxic.any():
        return 1.0, -4.0
    x = np.stack([levels, np.ones(len(levels))], axis=1)
    weight = np.full(len(levels), 1.0 / len(levels))
    w = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-(x @ w)))
        grad = x.T @ (weight * (p - toxic)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
          least_ratio: float = 16.0, least_phrase: int = 5) -> Lexicon:
    """Lexicon, exceptions and curve from at most ``max_labelled`` labelled rows."""
    sample = materialise(labelled_sample(docs, labels, max_labelled))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return Lexicon()
    weights = _suspicious(_word_counts(sample), toxic, clean, least_ratio)
    lexicon = Lexicon(weights, _benign_phrases(sample, weights, least_phrase))

    def run(batches):
        matcher = Matcher(lexicon)
        for b in batches:
            yield {"level": [matcher.level(t)[0] for t in b.column(0).to_pylist()], "toxic": b.column(1)}

    fitted = map_rows(sample.select("text", "toxic"), "level double, toxic boolean", run).toArrow()
    slope, bias = fit_curve(fitted["level"].to_numpy(), fitted["toxic"].to_numpy(zero_copy_only=False))
    return Lexicon(lexicon.weights, lexicon.exceptions, lexicon.power, slope, bias)


def toxicity_scores(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score, predicted (1 from ``threshold`` on), n_hits, n_words."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        matcher = Matcher(lexicon)  # travels with the function; bounded by the sample it was learned from
        for b in batches:
            found = [matcher.level(t) for t in b.column(1).to_pylist()]
            level, hits, words = (np.array(x) for x in zip(*found)) if found else (np.zeros(0),) * 3
            score = matcher.lexicon.curve(level.astype(float))
            yield {"doc_id": b.column(0), "score": pa.array(score), "predicted": (score >= threshold).astype(int),
                   "n_hits": hits.astype(int), "n_words": words.astype(int)}

    return map_rows(narrow, f"doc_id {kind}, score double, predicted int, n_hits int, n_words int", run)


def drop_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all columns, that score below ``threshold``."""
    at = docs.columns.index(text_col)

    def run(batches):
        matcher = Matcher(lexicon)
        for b in batches:
            yield b.filter(pa.array([bool(matcher.lexicon.curve(matcher.level(t)[0]) < threshold)
                                     for t in b.column(at).to_pylist()], pa.bool_()))

    return filter_rows(docs, run)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity_scores(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_hits", "n_words")
