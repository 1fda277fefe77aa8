"""Benchmark passages in documents, found by a CGK embedding and bit-sampling LSH.

Words are lower-cased and cut at ASCII punctuation. A document holds an item
of n words if one of its spans, of any length, is within ``k = floor(edits * n)``
word edits (insertions, deletions, substitutions) of it. Such spans have n - k
to n + k words.

The CGK random walk copies a window's symbols: at step j it writes the symbol
it stands on and moves on or stays by a random bit of (j, symbol), so that a
small edit distance becomes a small Hamming distance of the walks. LSH keys
are a few sampled coordinates of the walk; ``REPEATS`` walks with their own
bits and samples reach the target recall (measured in the tests). Items are
walked in pieces of at most ``PIECE_WORDS`` words, since walks drift apart with
length; of the pieces of an item within its bound, one is within its own.
Around each window that shares a key with a piece the span nearest to the whole
item is looked for, by exact edit distance.

Before the walks, windows that cannot be near any item are passed over: by the
q-gram lemma a span within k edits of a piece of n words shares at least
n - 2 - 3k of the benchmark's word triples, and counting those in n + k words
is cheap.
Nothing that the edit bound allows is lost by it.

The benchmark is walked in blocks of bounded size, each against all documents.
Null and empty texts, on either side, hold nothing. Null ids of documents are
results like others. Equal items are each reported; repeated documents give
repeated results. Very long documents are searched whole. Without items, or
without documents, nothing is found. Other columns are not looked at.
"""

from __future__ import annotations

import string
from array import array
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import U64, filter_rows, map_rows, mix64, table

EDITS = 0.2
REPEATS = 24
SAMPLES = 3
#: Words of the longest piece of an item that is walked as one.
PIECE_WORDS = 19
#: Benchmark text of one block, which travels to every task.
BLOCK_CHARS = 8_000_000
#: Words of documents walked at once.
CHUNK_WORDS = 1 << 18

_APART = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(_APART).split() if text else []


def edit_distance(a, b, most: int) -> int:
    """Edit distance of two sequences; ``most + 1`` if it is above ``most``."""
    over = most + 1
    if abs(len(a) - len(b)) > most:
        return over
    row = [min(j, over) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        low, high = max(1, i - most), min(len(b), i + most)  # cells further off the diagonal are over
        before, row = row, [over] * (len(b) + 1)
        row[0] = min(i, over)
        for j in range(low, high + 1):
            row[j] = min(before[j - 1] + (x != b[j - 1]), before[j] + 1, row[j - 1] + 1, over)
        if min(row[low - 1:high + 1]) == over:
            return over
    return row[-1]


def nearest_span(a, b, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the span of ``b`` nearest to ``a``, if within ``most``: the first end of
    the least distance, and of the spans that end there the one most like ``a`` in length."""
    def distances(a, b, free: int) -> Iterator[int]:
        """Edit distance of ``a`` and b[:j], or with ``free`` the best b[i:j], for each j (Myers' bit vectors)."""
        masks: dict = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << i
        full, last, now = (1 << len(a)) - 1, len(a) - 1, len(a)
        up, down = full, 0
        yield now
        for y in b:
            same = masks.get(y, 0)
            across = ((same & up) + up ^ up) | same
            plus, minus = down | full & ~(across | up), up & across
            now += (plus >> last & 1) - (minus >> last & 1)
            plus, minus, same = plus << 1 | (not free), minus << 1, same | down
            up, down = full & (minus | ~(same | plus)), full & plus & same
            yield now

    least, end = min((d, j) for j, d in enumerate(distances(a, b, True)))
    if least > most:
        return None
    back = enumerate(distances(a[::-1], b[max(0, end - len(a) - least):end][::-1], False))
    _, size = min((abs(j - len(a)), j) for j, d in back if d == least)
    return least, end - size, end


class Walks:
    """CGK walks of all repetitions over symbol arrays; equal on items and documents."""

    def __init__(self, symbols: int, longest: int, repeats: int = REPEATS, samples: int = SAMPLES, seed: int = 11):
        self.steps, self.repeats, self.symbols = 2 * longest, repeats, symbols
        base = mix64(np.arange(symbols, dtype=U64) + U64(seed << 32))
        self.base = base
        self.where = np.random.default_rng(seed).random((repeats, samples))

    def bits(self, repeat: int, block: int) -> np.ndarray:
        """64 random bits of every symbol, for steps 64 * block on."""
        return mix64(self.base + U64((repeat + 1) * 0x9E3779B97F4A7C15 + block * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1))

    def tables(self) -> np.ndarray:
        return np.stack([np.stack([self.bits(r, k) for k in range(-(-self.steps // 64))]) for r in range(self.repeats)])

    def walk(self, ids: np.ndarray, starts: np.ndarray, table_: np.ndarray) -> np.ndarray:
        """(steps, starts): where each walk stands at each step."""
        at, out = starts.copy(), np.empty((self.steps, len(starts)), dtype=np.int64)
        for j in range(self.steps):
            out[j] = at
            at += ((table_[j >> 6][ids[at]] >> U64(j & 63)) & U64(1)).astype(np.int64)
        return out

    def keys(self, ids: np.ndarray, starts: np.ndarray, walk: np.ndarray, own: np.ndarray, repeat: int,
             size: int, ends: np.ndarray) -> np.ndarray:
        """LSH key of the windows of ``size`` symbols, cut at ``ends``, at ``starts[own]``: sampled coordinates
        of their walks."""
        starts, last = starts[own], np.minimum(starts[own] + size, ends[own])
        key = np.full(len(own), repeat * 1000003 + size, dtype=U64)
        for j in np.sort((self.where[repeat] * 2 * size).astype(np.int64)):
            at = walk[j, own]
            symbol = np.where(at < last, ids[at], self.symbols)
            key = mix64(key * U64(31) + symbol.astype(U64))
        return key


class Benchmark:
    """Items of a block as symbols, their triples and the LSH keys of their pieces.

    With ``spans`` texts hold an item by a span of any length, else only by one of as many words as the item,
    which is then one piece.
    """

    def __init__(self, items: list[tuple[object, str | None]], edits: float = EDITS, repeats: int = REPEATS,
                 samples: int = SAMPLES, spans: bool = False):
        self.spans = spans
        self.vocabulary: dict[bytes, int] = {}
        known = [(i, words_of(t)) for i, t in items]
        known = [(i, w) for i, w in known if w]
        self.names = [i for i, _ in known]
        self.items = [np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w], dtype=np.int64)
                      for _, w in known]
        cuts = [np.linspace(0, len(x), -(-len(x) // PIECE_WORDS) + 1 if spans else 2).astype(np.int64) for x in self.items]
        self.owner = np.repeat(np.arange(len(cuts)), [len(c) - 1 for c in cuts])  # of each piece: its item
        self.offset = np.concatenate([c[:-1] for c in cuts] or [np.zeros(0, dtype=np.int64)])  # and place there
        self.sizes = np.concatenate([np.diff(c) for c in cuts] or [np.zeros(0, dtype=np.int64)])
        self.bound = [int(edits * len(x)) for x in self.items]
        self.most = {int(n): int(edits * n) for n in np.unique(self.sizes)}
        self.shared = {n: n - 2 - 3 * k for n, k in self.most.items()}
        # words of the shortest and the longest span that a piece of n words may be held by
        self.short = {n: max(1, n - k) if spans else n for n, k in self.most.items()}
        self.long = {n: n + min(n, k) if spans else n for n, k in self.most.items()}
        if not self.items:
            return
        self.longest = int(self.sizes.max())
        pad = np.zeros(2 * self.longest + 1, dtype=np.int64)
        ids = np.concatenate([np.r_[self.items[i][o:o + n], pad] for i, o, n in zip(self.owner, self.offset, self.sizes)])
        starts = np.cumsum(np.r_[0, self.sizes[:-1] + len(pad)])
        self.triples = np.unique(np.concatenate([self.triple(x) for x in self.items]))
        self.walks = Walks(len(self.vocabulary) + 1, self.longest, repeats, samples)
        self.tables = self.walks.tables()
        self.buckets = {}  # (repeat, size): sorted keys and their pieces
        for r in range(repeats):
            walk = self.walks.walk(ids, starts, self.tables[r])
            for n in self.most:
                own = np.flatnonzero(self.sizes == n)
                keys = self.walks.keys(ids, starts, walk, own, r, n, starts + self.sizes)
                order = np.argsort(keys, kind="stable")
                self.buckets[r, n] = keys[order], own[order]

    def triple(self, ids: np.ndarray) -> np.ndarray:
        """Code of every three symbols in a row; negative where one is not of the benchmark."""
        base = len(self.vocabulary) + 1
        a, b, c = ids[:-2], ids[1:-1], ids[2:]
        return np.where((a > 0) & (b > 0) & (c > 0), (a * base + b) * base + c, -1)

    def candidates(self, ids: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], int]:
        """(start, piece) -> number of shared LSH keys, over all windows of ``ids``.

        ``ends[p]`` is the end of the document that position p is in; ``ids``
        ends with room for a whole walk.
        """
        usable = len(ids) - 2 * self.longest - 1
        codes = self.triple(ids)
        seeds = np.zeros(len(ids) + 1, dtype=np.int32)
        seen = codes >= 0
        seen[seen] = np.isin(codes[seen], self.triples)
        seeds[1:len(seen) + 1] = np.cumsum(seen)
        seeds[len(seen) + 1:] = seeds[len(seen)]
        passing: dict[int, np.ndarray] = {}

        def narrow(sizes: list[int], start: np.ndarray) -> None:
            """Starts whose longest span has the fewest triples that any of ``sizes`` needs; then by halves."""
            least = min(self.shared[n] for n in sizes)
            if least > 0:
                start = start[seeds[start + self.long[max(sizes)] - 2] - seeds[start] >= least]
            if len(start) and len(sizes) > 1:
                narrow(sizes[:len(sizes) // 2], start)
                narrow(sizes[len(sizes) // 2:], start)
            elif len(start):
                own = start[start + self.short[sizes[0]] <= ends[start]]
                if len(own):
                    passing[sizes[0]] = own

        start = np.arange(usable)
        if min(self.shared.values()) > 0:  # the same, over all positions at once
            reach = self.long[self.longest] - 2
            start = np.flatnonzero(seeds[reach:usable + reach] - seeds[:usable] >= min(self.shared.values()))
        narrow(sorted(self.shared), start)
        if not passing:
            return {}
        hits = []
        every = np.unique(np.concatenate(list(passing.values())))
        step = max(64, (1 << 22) // self.walks.steps)
        for a in range(0, len(every), step):
            part = every[a:a + step]
            inside = {n: np.searchsorted(part, own[(own >= part[0]) & (own <= part[-1])]) for n, own in passing.items()}
            for r in range(self.walks.repeats):
                walk = self.walks.walk(ids, part, self.tables[r])
                for n, at in inside.items():
                    if not len(at):
                        continue
                    keys = self.walks.keys(ids, part, walk, at, r, n, ends[part])
                    known, pieces = self.buckets[r, n]
                    low, high = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
                    many = high - low
                    if many.any():
                        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                        hits.append(np.repeat(part[at], many) * len(self.owner) + pieces[np.repeat(low, many) + nth])
        pairs, count = np.unique(np.concatenate(hits or [np.zeros(0, dtype=np.int64)]), return_counts=True)
        return {divmod(p, len(self.owner)): n for p, n in zip(pairs.tolist(), count.tolist())}


def nearest_around(starts: list[int], own: list[int], ids: np.ndarray, begin: int, end: int,
                   most: int) -> tuple[int, int] | None:
    """(distance, first word) of the span nearest to the item ``own`` around the windows at ``starts`` of
    the document ids[begin:end], the first of the nearest; None if none is within ``most``."""
    best, upto = None, begin
    starts = sorted(starts)
    for k, start in enumerate(starts):
        # up to ``most`` edits lie before a piece, and its window may be as many words off, on either side
        low, high = max(begin, start - 2 * most), min(end, start + len(own) + 2 * most)
        if k == 0 or low > upto:
            first = low
        upto = high
        if k + 1 < len(starts) and starts[k + 1] - 2 * most <= high:
            continue  # one region with the next
        near = nearest_span(own, ids[first:upto].tolist(), most)
        if near and (best is None or near[0] < best[0]):
            best = near[0], int(first - begin + near[1])
    return best


def find_items(texts: list[str | None], bench: Benchmark) -> list[tuple[int, object, int, int]]:
    """(text, item, first word, distance) of every item that a text holds."""
    out = []
    get, queue = bench.vocabulary.get, list(enumerate(texts))[::-1]
    while queue:
        part, lengths, symbols = [], [], array("q")
        while queue and len(symbols) < CHUNK_WORDS:
            k, text = queue.pop()
            before = len(symbols)
            symbols.extend(map(get, words_of(text), repeat(0)))
            part.append(k)
            lengths.append(len(symbols) - before)
        lengths = np.array(lengths)
        begins = np.cumsum(lengths) - lengths
        ids = np.r_[np.frombuffer(symbols, dtype=np.int64), np.zeros(2 * bench.longest + 1, dtype=np.int64)]
        ends = np.repeat(begins + lengths, lengths)
        hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for (start, piece), n in bench.candidates(ids, ends).items():
            item, offset = int(bench.owner[piece]), int(bench.offset[piece])
            hits.setdefault((int(np.searchsorted(begins, start, "right")) - 1, item), []).append((-n, start - offset))
        for (k, item), starts in sorted(hits.items()):
            size = len(bench.items[item])
            most, own = bench.bound[item], bench.items[item].tolist()
            if bench.spans:
                if near := nearest_around([s for _, s in starts], own, ids, begins[k], begins[k] + lengths[k], most):
                    out.append((part[k], bench.names[item], near[1], near[0]))
                continue
            for _, start in sorted(starts):  # most shared keys first; one window within the bound will do
                if (d := edit_distance(own, ids[start:start + size].tolist(), most)) <= most:
                    out.append((part[k], bench.names[item], int(start - begins[k]), d))
                    break
    return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, distance) of every item that a document holds."""
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, start_word bigint, distance int"
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def walked(known: list[tuple]) -> DataFrame:
        def run(batches):
            bench = Benchmark(known, edits, spans=True)
            for b in batches:
                ids = b.column(0).to_pylist()
                found = find_items(b.column(1).to_pylist(), bench) if bench.items else []
                yield {"doc_id": [ids[k] for k, *_ in found], "item_id": [i for _, i, *_ in found],
                       "start_word": [s for _, _, s, _ in found], "distance": [d for *_, d in found]}

        return map_rows(narrow, schema, run)

    return reduce(DataFrame.union, map(walked, item_blocks(benchmark, item_col, item_text_col)))


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple]]:
    """The items, in blocks of about BLOCK_CHARS that are fetched one at a time; at least one block."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield [(r["item"], r["text"]) for r in own.orderBy("item", "text").collect()]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all columns, that hold no item."""
    at = docs.columns.index(text_col)

    def clean(docs: DataFrame, known: list[tuple]) -> DataFrame:
        def run(batches):
            bench = Benchmark(known, edits, spans=True)
            for b in batches:
                hit = {k for k, *_ in find_items(b.column(at).to_pylist(), bench)} if bench.items else set()
                yield b.filter(pa.array([k not in hit for k in range(len(b))], pa.bool_()))

        return filter_rows(docs, run)

    return reduce(clean, item_blocks(benchmark, item_col, item_text_col), docs)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only documents that hold an item have rows."""
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
