"""Token counts by heap-and-linked-list byte-pair merging, without making ids.

A piece of text starts as a linked list of symbols (characters). A heap holds
the adjacent pairs that the vocabulary knows; the best-ranked pair (leftmost of
equals) is popped and merged until none is left. The count is the number of
initial symbols minus the merges; a character the vocabulary lacks counts as
its UTF-8 bytes, as byte fallback writes them.

Merges never cross two neighbouring characters that no piece holds side by
side, so text is cut there and counts of the parts are added; counts of words
and of parts are kept in bounded caches.

Null and empty texts have no bytes and no tokens. A null id stays null,
repeated rows give repeated results, and other columns are not looked at.
Very long texts are counted whole, part by part; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import Recent, map_rows, table

SPACE = "▁"  # how the pieces write a space

#: Texts on which a model must agree with this code before it is used.
PROBES = ["", " ", "a", "  a  b ", "a\nb", "\n", "<s>x</s>", "　x", "ﬁ é é", "A\tB\x00",
          "▁x", "x▁▁", "don't 3.14, 日本 \U0001f600‍", "the quick  brown fox\n\n jumped"]


@dataclass
class PairMerger:
    """Counts tokens of whole texts for a byte-pair vocabulary with space marks and byte fallback."""
    rank: dict[str, float]  # piece -> rank, lower merges first
    adjacent: set[str] = field(default_factory=set)  # two characters side by side in some piece
    max_cached: int = 300_000

    def __post_init__(self):
        self.adjacent = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        # Spaces only ever lead a piece and line ends are in none, so words and lines are apart.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.rank)
        self.by_line = not any("\n" in p for p in self.rank)
        self.words = Recent(lambda word: self.apart(SPACE + word), self.max_cached)
        self.starts = Recent(self.apart, self.max_cached // 8)
        self.parts = Recent(self.merge, self.max_cached // 2)

    @classmethod
    def from_model(cls, model_file: str) -> PairMerger:
        """Of a sentencepiece byte-pair model; ValueError if it needs what this code has not."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        own = cls({sp.id_to_piece(i): -sp.get_score(i) for i in range(sp.get_piece_size())
                   if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))})
        for text in PROBES:
            if own.count(text) != len(sp.encode(text)):
                raise ValueError(f"{model_file}: another kind of model (differs on {text!r})")
        return own

    def merge(self, text: str) -> int:
        """Symbols left of ``text`` after all merges."""
        rank, n = self.rank, len(text)
        tokens = sum(1 if c in rank else len(c.encode("utf-8", "surrogatepass")) for c in text)
        if n < 2:
            return tokens
        end = list(range(1, n + 1))  # symbol at i is text[i:end[i]]; end[i] is also its right neighbour
        before = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(text[i:i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, stop = pop(heap)
            mid = end[i]
            if mid < 0 or mid >= n or end[mid] != stop:
                continue  # one of the two has been merged meanwhile
            end[i], end[mid] = stop, -1
            before[stop] = i
            tokens -= 1
            left = before[i]
            if left >= 0 and (r := rank.get(text[left:stop])) is not None:
                push(heap, (r, left, stop))
            if stop < n and (r := rank.get(text[i:end[stop]])) is not None:
                push(heap, (r, i, end[stop]))
        return tokens

    def apart(self, text: str) -> int:
        """Count of ``text``, cut where no merge can cross."""
        adjacent, total, start = self.adjacent, 0, 0
        for i in range(1, len(text) + 1):
            if i == len(text) or text[i - 1:i + 1] not in adjacent:
                part = text[start:i]
                n = self.parts[part] if len(part) <= 64 else self.merge(part)
                total += n
                start = i
        return total

    def count(self, text: str | None) -> int:
        """Tokens of a whole text, which a space precedes unless it is empty."""
        if not text:
            return 0
        if not (self.by_word and self.by_line) or SPACE in text:
            return self.apart(SPACE + text.replace(" ", SPACE))
        lines = text.split("\n")
        total = len(lines) - 1 if "\n" not in self.rank else 0
        for k, line in enumerate(lines):
            words = line.split(" ")
            if "" in words[1:] or k == 0 and not words[0] and words[1:]:  # runs of spaces merge among themselves
                line = " " + line if k == 0 else line
                total += sum(self.apart(w.replace(" ", SPACE)) for w in re.findall(r" *[^ ]+| +", line))
                continue
            total += sum(map(self.words.__getitem__, words if k == 0 else words[1:]))
            if k and words[0]:
                total += self.starts[words[0]]
        return total


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``model_file`` lies at the same path on every machine.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def counted(batches):
        merger = PairMerger.from_model(model_file)
        for b in batches:
            texts = b.column(1)
            n = [merger.count(t.as_py()) for t in texts]
            yield {"doc_id": b.column(0), "n_bytes": [0 if t is None else len(t) for t in texts.cast("binary").to_pylist()],
                   "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_rows(narrow, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean", counted)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
