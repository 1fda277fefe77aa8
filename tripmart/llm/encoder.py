"""Whole-text token ids of a ``tokenizers`` file, word by word with bounded caches.

Where white space only separates (the file's pre-tokeniser drops it), the ids
of a text are those of its words in order, so the distinct words of a batch are
looked up, or encoded, once and the ids of its texts gathered by array. Ids of
words met before are kept in caches, one encoder a Python worker and file.
Whether a file behaves so is tested on probe texts when it is loaded; other
files encode whole texts.
"""

from __future__ import annotations

import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tripmart.llm.common import Recent

PROBES = ["", " ", "a b", "Hello, World.  x\ny\tz", "don't we'll 3.14 42", "naïve Ünïcode ßtraße Ñandú", "é ́e",
          "<|startoftext|> a<|endoftext|>b", "a b  c\x85d \x1ce", "İ ΑΣ ς ﬁ \U0001f600!?", "日本 語", "x.y ... 'S",
          "Some%%% words,*** WITH!! ### &&marks.$$$ #tag É.&&& ÿ?", "ĳ ŉ ǅungla Ǉ ſs ŁÓDŹ ƁƏ ɏ"]
#: Words of Latin letters, composed ones too, and marks at their end: one or two pre-tokens.
PLAIN = "^(?P<stem>[A-Za-zÀ-ÖØ-öø-įı-ɏ]+)(?P<mark>[.,;:!?$%&*#]*)$"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


#: Texts encoded at once; the more there are, the more of their words are the same.
ENCODED_BYTES = 4 << 20


def worker_encoder(tokenizer_file: str) -> TextEncoder:
    """The encoder of this Python process for a file; workers live on between tasks, and so do its caches."""
    # functions travel by value with globals of their own, so the encoders are kept apart from them
    kept = sys.modules.setdefault("_worker_encoders", types.ModuleType("_worker_encoders")).__dict__
    if tokenizer_file not in kept:
        kept[tokenizer_file] = TextEncoder(tokenizer_file)
    return kept[tokenizer_file]


class TextEncoder:
    """Ids of texts as little-endian bytes of ``dtype`` (the smallest unsigned type for the vocabulary)."""

    def __init__(self, tokenizer_file: str, max_cached: int = 100_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model, self.byte_letters = self.tokenizer.model, _byte_letters()
        top = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
        self.code = "H" if top < 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.by_word = self.shortcut = False
        # each shortcut is used only if it agrees with the library on the probes
        for use in ("by_word", "shortcut"):
            setattr(self, use, use == "by_word" or self.by_word)
            self.words, self.plain = Recent(self.whole, max(1, max_cached // 4)), Recent(self.pre_token, max_cached)
            setattr(self, use, getattr(self, use) and all(self.joined(p) == self.whole(p) for p in PROBES))
        self.words, self.plain = Recent(self.whole, max(1, max_cached // 4)), Recent(self.pre_token, max_cached)

    def pre_token(self, text: str) -> bytes:
        """Ids of one pre-token, straight from the merges."""
        mapped = text if text.isascii() else "".join([self.byte_letters[b] for b in text.encode()])
        return self.pack([t.id for t in self.model.tokenize(mapped)])

    def pack(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def joined(self, text: str) -> bytes:
        """Ids of a text by its words."""
        return self.encode_column(pa.array([text]), None)[0].tobytes()

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and how many each has."""
        pieces: list[bytes] = [b""]
        at = np.zeros((len(words), 2), np.int64)  # two pieces a word, the first of them empty at most
        other = np.ones(len(words), bool)
        if self.shortcut:
            parts = pc.extract_regex(words, PLAIN)
            other = parts.is_null().to_numpy(zero_copy_only=False)
            parts = parts.drop_null()
            for k, part in enumerate((pc.utf8_lower(parts.field("stem")), parts.field("mark"))):
                found = part.dictionary_encode()
                at[~other, k] = found.indices.to_numpy() + len(pieces)
                pieces += [self.plain[x] if x else b"" for x in found.dictionary.to_pylist()]
        rest = words.filter(pa.array(other)).to_pylist()
        at[other, 0] = np.arange(len(rest)) + len(pieces)
        pieces += [self.words[w] if w else b"" for w in rest]
        size = np.array([len(x) for x in pieces], np.int64) // self.dtype.itemsize
        ids = np.frombuffer(b"".join(pieces), self.dtype)
        return gather(ids, size, at.reshape(-1)), size[at].sum(axis=1)

    def encode(self, text: bytes | None) -> bytes:
        """Ids of UTF-8 ``text``; null is empty."""
        if not text:
            return b""
        return self.joined(text.decode()) if self.by_word else self.whole(text.decode())

    def encode_column(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end_id``, and where each text's begin (and the last's end)."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self.by_word:
            words = pc.ascii_split_whitespace(texts)
            found = words.flatten().dictionary_encode()
            at = found.indices.to_numpy()
            known, size = self.distinct(found.dictionary)
            ids, bounds = gather(known, size, at), np.concatenate([[0], np.cumsum(size[at])])[words.offsets.to_numpy()]
        else:
            parts = [self.whole(t) for t in texts.to_pylist()]
            ids = np.frombuffer(b"".join(parts), self.dtype)
            bounds = np.concatenate([[0], np.cumsum([len(p) // self.dtype.itemsize for p in parts], dtype=np.int64)])
        if end_id is None:
            return ids, bounds
        out = np.insert(ids, bounds[1:], end_id)
        return out, bounds + np.arange(len(bounds))


#: Pieces gathered at once; their places take more room than their ids.
GATHERED = 1 << 17


def gather(ids: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ids of the pieces ``at``, one after the other, of pieces that lie in ``ids`` with these sizes."""
    first = np.cumsum(size) - size
    out = np.empty(size[at].sum(), ids.dtype)
    done = 0
    for k in range(0, len(at), GATHERED):
        some = at[k:k + GATHERED]
        count = size[some]
        before = np.cumsum(count) - count
        n = int(count.sum())
        out[done:done + n] = ids[np.repeat(first[some] - before, count) + np.arange(n)]
        done += n
    return out


def as_binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The pieces of ``data`` between ``bounds`` as binaries, without copying them one by one."""
    offsets = (bounds * data.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
