"""Token ids of whole texts by a public tokenizer, much faster than one call a text.

White space always separates the default tokenizer's pieces, so a text's ids are the ids of its white-space chunks in
order. Any other tokenizer file (known by its content, not its name) encodes whole texts by the library alone.
Arrow splits and numbers the chunks of a batch; each distinct word of them is encoded once and kept in a bounded
table of the worker process. Chunks of plain Latin letters, digits and ASCII punctuation go to the library's merge
model piece by piece; every other chunk goes through the library's whole pipeline.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stratiform.llm.common import ragged, split_words

DEFAULT_FILE = "word_bpe_49k.json"
#: Fixed value: SHA-256 of the file whose pieces never reach over white space.
DEFAULT_SHA256 = "53fa9d558ea625daafcd57cd61e7be7b3c7043ea584b22d09575cf5ea9131b0a"
#: Bytes of the table, about, before it starts anew; bounds a worker's memory.
TABLE_BYTES = 40 << 20
#: What an entry takes beside its chunk's bytes: dictionary slot, key and place objects, start and count.
_ENTRY_BYTES = 150
#: A chunk that is one run of Latin letters and at most one full stop or comma.
_SIMPLE = "^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,]?)$"
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: Fixed value: the tokenizer file's split pattern, restricted to the characters of _PLAIN after lower-casing.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


class ChunkEncoder:
    """Encodes texts through a table of chunk ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        with open(path, "rb") as f:
            self.fast = hashlib.sha256(f.read()).hexdigest() == DEFAULT_SHA256
        self.letters = self._byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.table: dict[bytes, int] = {}
        self.starts = np.zeros(1 << 16, np.int64)
        self.counts = np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.used = self.held = 0

    @staticmethod
    def _byte_letters() -> dict[int, str]:
        """Latin-1 letters as the byte-level alphabet writes their UTF-8 bytes: printable bytes stand for themselves, the rest follow from U+0100."""
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in set(printable))
        letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}

    def _encode(self, chunk: str) -> list[int]:
        if not _PLAIN.fullmatch(chunk) or "<|" in chunk:
            return self.whole.encode(chunk, add_special_tokens=False).ids
        tokenize, letters = self.model.tokenize, self.letters
        if chunk.isalpha():
            chunk = chunk.lower()
            return [t.id for t in tokenize(chunk if chunk.isascii() else chunk.translate(letters))]
        return [t.id for piece in _PIECES.findall(chunk.lower()) for t in tokenize(piece if piece.isascii() else piece.translate(letters))]

    def _learn(self, chunks: list[bytes]) -> None:
        ids = [self._encode(c.decode()) for c in chunks]
        counts = np.fromiter(map(len, ids), np.int32, len(ids))
        n, m, total = len(self.table), len(chunks), int(counts.sum())
        while n + m > len(self.starts):
            self.starts, self.counts = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.counts, 2 * len(self.counts))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.starts[n : n + m] = self.used + np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int64)])
        self.counts[n : n + m] = counts
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.used += total
        self.held += m * _ENTRY_BYTES + sum(map(len, chunks)) + 4 * total
        self.table.update(zip(chunks, range(n, n + m), strict=True))

    def _places(self, keys: pa.Array) -> np.ndarray:
        """Each key's place in the table; learns new ones."""
        coded = keys.dictionary_encode()
        chunks = coded.dictionary.cast(pa.binary()).to_pylist()
        if new := [c for c in chunks if c not in self.table]:
            self._learn(new)
        return np.fromiter(map(self.table.__getitem__, chunks), np.int64, len(chunks))[coded.indices.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts as uint32, and the n+1 offsets of each text's ids."""
        if not self.fast:
            ids = [np.array(e.ids, np.uint32) for e in self.whole.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([*ids, np.empty(0, np.uint32)]), np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
        flat, offsets = split_words(texts, lower=False)
        if not len(flat):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = flat.dictionary_encode()
        chunks = coded.dictionary
        if self.held > TABLE_BYTES:
            self._clear()
        parts = pc.extract_regex(chunks, _SIMPLE)
        simple = pc.is_valid(parts)
        words = self._places(pc.if_else(simple, pc.utf8_lower(parts.field("word")), chunks))
        tails = self._places(pc.if_else(simple, parts.field("tail"), ""))
        places = np.stack([words, tails], axis=1).ravel()
        sizes = self.counts[places]
        local = self.flat[ragged(self.starts[places], sizes)]
        counts = sizes[::2] + sizes[1::2]
        starts = np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int64)])
        at = coded.indices.to_numpy()
        counts = counts[at]
        ids = local[ragged(starts[at], counts)]
        ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        return ids, ends[offsets]


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """The worker process's encoder of a tokenizer file."""
    return ChunkEncoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text's own."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    counts = np.diff(offsets)
    out[ragged(offsets[:-1] + np.arange(n), counts)] = ids
    return out, offsets + np.arange(n + 1)


def as_lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(flat))


def byte_blobs(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value for each text: its slice of a contiguous array's bytes."""
    flat = np.ascontiguousarray(flat)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * flat.itemsize).astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())]).cast(pa.binary())


__all__ = ["ChunkEncoder", "as_lists", "byte_blobs", "default_path", "encoder", "pc", "with_end"]
