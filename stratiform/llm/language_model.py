"""Operator 3: language-model scores from an Elias-Fano n-gram trie with quantised smoothed probabilities.

Tokens are words (A-Z folded) and one end a text; the end of the text before is the context of a text's first word.
Level 1 is the vocabulary, in shards by the leading bits of a word's 64-bit hash, each one memory-mapped file:

* ``words``: Elias-Fano of the sorted hashes, found by successor search; a word's id is its place;
* ``counts``: exact, for the base score alone;
* ``codes``: two bytes a word, indices into the shard's 256 evenly spaced values of log10(count + 1), its smoothed
  probability but for a constant, and of log10(count + MU), its back-off weight as a context but for a constant.

Level 2 is in shards by a hash of the word pair, so a frequent context is spread over all of them. A shard is a trie of
its own, in one memory-mapped file:

* ``contexts``: Elias-Fano of its context ids;
* ``pointers``: Elias-Fano of where each context's successors begin;
* ``successors``: Elias-Fano of successor ids relative to their context: each plus the last value before the
  context, so the level is one increasing sequence. A query adds its context's base to the word's id and asks for
  the next value at least that large (successor search), which must lie in the context's range and be equal;
* ``codes``: one byte a pair, an index into the shard's 256 evenly spaced log10 values of count(pair) / (count(context) + MU).

P(word | context) = that ratio + MU / (count(context) + MU) * P(word), P(word) = (count + 1) / (tokens + vocabulary + 1),
all three read as quantised values.

Spark counts: each task counts its own words or pairs first, packs them into one blob a shard, and a shard's blobs
meet in one task; the numbers of shards follow the corpus, so a task's share is bounded. All training texts are
counted whole, without a cut-off. Workers map the files instead of holding them.

Defined results: null and empty texts are one end; unseen words have count 0; repeated rows count as often as they
occur; a null doc_id counts as the empty id for the fold; an empty table gives no rows; without training texts
every probability is 1; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import bucketed, by_bucket, crc_bucket, documents, gathered, hash_values, joined_blob, mix, ragged, read_array, scratch, ship, split_words, staged, text_column, write_bytes
from stratiform.llm.elias_fano import EliasFano

MU = 300.0
FOLDS, HELD_OUT = 7, 2
#: Text bytes for each vocabulary shard and for each pair shard.
WORD_SHARD_BYTES, PAIR_SHARD_BYTES = 64 << 20, 24 << 20
END = np.uint64(0)
_BLOB = "bucket int, keys binary, counts binary"


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word hashes with END first, each token's place among them, and the n+1 offsets of texts; an end closes each text."""
    flat, offsets = split_words(texts)
    n = len(texts)
    ends = offsets + np.arange(n + 1)
    at = np.zeros(int(ends[-1]), np.int64)
    if not len(flat):
        return np.array([END]), at, ends
    coded = flat.dictionary_encode()
    hashes = hash_values(coded.dictionary)
    hashes[hashes == END] = 1
    at[ragged(ends[:-1], np.diff(offsets))] = coded.indices.to_numpy() + 1
    return np.concatenate([[END], hashes]), at, ends


def _blobs(bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    bucket, keys, counts = bucket[order], keys[order], counts[order].astype(np.uint32)
    cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts[:-1]], pa.int32()), pa.array([keys[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
        names=["bucket", "keys", "counts"],
    )


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    heads = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1]) if len(keys) else np.empty(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(keys) else counts


def _count_words(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in gathered(batches):
        hashes, at, _ = _tokens(text_column(batch))
        counts = np.bincount(at, minlength=len(hashes))
        bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
        yield _blobs(bucket, hashes, counts)


def _write_words(batches: Iterator[pa.RecordBatch], folder: str, bits: int, mu: float) -> Iterator[pa.RecordBatch]:
    for bucket, table in by_bucket(batches):
        keys, counts = _summed(joined_blob(table.column("keys"), np.uint64), joined_blob(table.column("counts"), np.uint32))
        write_bytes(folder, f"words-{bucket}", *(part.tobytes() for part in build_words(keys, counts, bits, mu)))
        yield pa.RecordBatch.from_pydict({"bucket": [bucket], "n": [len(keys)], "total": [int(counts.sum())]}, schema=pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("total", pa.int64())]))


def _quantised(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """256 evenly spaced values and the nearest one's index for each number, as arrays of 64-bit words."""
    steps = np.linspace(logs.min(), logs.max(), 256)
    codes = np.rint((logs - steps[0]) / max(steps[1] - steps[0], 1e-12)).astype(np.uint8)
    return steps.view(np.uint64), np.concatenate([codes, np.zeros(-len(codes) % 8, np.uint8)]).view(np.uint64)


def build_words(hashes: np.ndarray, counts: np.ndarray, bits: int, mu: float = MU) -> list[np.ndarray]:
    """The parts of a vocabulary shard from its sorted hashes, which share their leading ``bits``."""
    rest = hashes & np.uint64((1 << (64 - bits)) - 1)
    return [EliasFano.encode(rest, 1 << (64 - bits)), counts.astype(np.uint64), *_quantised(np.log10(counts + 1)), *_quantised(np.log10(counts + mu))]


class Words:
    """Reads a vocabulary shard."""

    def __init__(self, data: np.ndarray, bits: int):
        self.mask = np.uint64((1 << (64 - bits)) - 1)
        self.hashes = EliasFano(data)
        n, at = self.hashes.n, self.hashes.size
        self.counts, at = data[at : at + n], at + n
        self.levels = []
        for _ in range(2):
            steps, codes = data[at : at + 256].view(np.float64), data[at + 256 : at + 256 - (-n // 8)].view(np.uint8)
            self.levels.append((steps, codes))
            at += 256 - (-n // 8)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which sorted hashes are there, and the places of those."""
        at, value = self.hashes.next_geq(hashes & self.mask)
        hit = value == hashes & self.mask
        return hit, at[hit]

    def level(self, k: int, at: np.ndarray) -> np.ndarray:
        steps, codes = self.levels[k]
        return steps[codes[at]]


class Vocabulary:
    """Ids, counts and quantised logarithms of word hashes; shards are mapped when they are asked for."""

    def __init__(self, folder: str, bits: int, sizes: dict[int, int], total: int):
        self.folder, self.bits, self.total = folder, bits, total
        self.n = sum(sizes.values())
        starts = np.cumsum([0, *(sizes.get(k, 0) for k in range(1 << bits))])
        self.starts, self.sizes = starts, sizes

    def shard(self, k: int) -> Words:
        return Words(read_array(self.folder, f"words-{k}", np.uint64), self.bits)

    def look_up(self, hashes: np.ndarray, mu: float = MU) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each distinct hash's id (the vocabulary's size if unseen), count, and log10 of count + 1 and of count + mu as quantised."""
        ids, counts = np.full(len(hashes), self.n, np.int64), np.zeros(len(hashes), np.int64)
        single, weight = np.zeros(len(hashes)), np.full(len(hashes), np.log10(mu))
        order = np.argsort(hashes)
        held = hashes[order]
        cuts = np.searchsorted(held, np.array([k << (64 - self.bits) for k in range(1 << self.bits)], np.uint64))
        cuts = np.append(cuts, len(held))
        for k in range(1 << self.bits):
            own = held[cuts[k] : cuts[k + 1]]
            if len(own) and self.sizes.get(k):
                words = self.shard(k)
                hit, at = words.find(own)
                place = order[cuts[k] : cuts[k + 1]][hit]
                ids[place] = self.starts[k] + at
                counts[place] = words.counts[at]
                single[place], weight[place] = words.level(0, at), words.level(1, at)
        return ids, counts, single, weight


@lru_cache(maxsize=2)
def _vocabulary(folder: str, bits: int, sizes: tuple[tuple[int, int], ...], total: int) -> Vocabulary:
    return Vocabulary(folder, bits, dict(sizes), total)


def _pairs(at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each token's context: the token before in its text, or END (place 0)."""
    context = np.concatenate([[0], at[:-1]]) if len(at) else at
    context[offsets[:-1]] = 0
    return context


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(keys) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _count_pairs(batches: Iterator[pa.RecordBatch], vocabulary: tuple, shards: int) -> Iterator[pa.RecordBatch]:
    words = _vocabulary(*vocabulary)
    for batch in gathered(batches):
        hashes, at, offsets = _tokens(text_column(batch))
        ids = words.look_up(hashes)[0].astype(np.uint64)
        keys, counts = _summed(ids[_pairs(at, offsets)] << np.uint64(32) | ids[at], np.ones(len(at), np.int64))
        yield _blobs(_shard(keys, shards), keys, counts)


def build_trie(keys: np.ndarray, counts: np.ndarray, context_counts: np.ndarray, mu: float = MU) -> list[np.ndarray]:
    """The parts of a shard's trie from its sorted pairs (context << 32 | word) and the counts of their contexts."""
    contexts, heads = np.unique(keys >> np.uint64(32), return_index=True)
    words = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint64) + np.uint64(1)
    pointers = np.append(heads, len(keys))
    # value = word + the last value of the contexts before: the sums of each context's largest word
    largest = words[pointers[1:] - 1]
    base = np.concatenate([[0], np.cumsum(largest)[:-1]]).astype(np.uint64)
    values = words + np.repeat(base, np.diff(pointers))
    return [EliasFano.encode(contexts), EliasFano.encode(pointers), EliasFano.encode(values), *_quantised(np.log10(counts / (context_counts + mu)))]


class Trie:
    """Reads a shard."""

    def __init__(self, data: np.ndarray):
        self.contexts = EliasFano(data)
        self.pointers = EliasFano(data[self.contexts.size :])
        at = self.contexts.size + self.pointers.size
        self.successors = EliasFano(data[at:])
        at += self.successors.size
        self.steps, self.codes = data[at : at + 256].view(np.float64), data[at + 256 :].view(np.uint8)

    def log10(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 of each pair's ratio; minus infinity for pairs that are not there. Queries are best sorted by context."""
        out = np.full(len(context), -np.inf)
        heads = np.concatenate([[True], context[1:] != context[:-1]])
        distinct, of = context[heads], np.cumsum(heads) - 1
        place, value = self.contexts.next_geq(distinct)
        there = value == distinct
        first, last = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        first[there] = self.pointers.get(place[there])
        last[there] = self.pointers.get(place[there] + 1)
        base = np.zeros(len(distinct), np.uint64)
        some = there & (first > 0)
        base[some] = self.successors.get(first[some] - 1)
        rows = np.flatnonzero(there[of])
        if len(rows):
            wanted = base[of[rows]] + word[rows] + np.uint64(1)
            at, value = self.successors.next_geq(wanted)
            hit = (value == wanted) & (at < last[of[rows]])
            out[rows[hit]] = self.steps[self.codes[at[hit]]]
        return out


def _write_pairs(batches: Iterator[pa.RecordBatch], vocabulary: tuple, mu: float) -> Iterator[pa.RecordBatch]:
    words = _vocabulary(*vocabulary)
    for bucket, table in by_bucket(batches):
        keys, counts = _summed(joined_blob(table.column("keys"), np.uint64), joined_blob(table.column("counts"), np.uint32))
        context, of = np.unique(keys >> np.uint64(32), return_inverse=True)
        parts = build_trie(keys, counts, _counts_of(words, context)[of], mu)
        write_bytes(words.folder, f"pairs-{bucket}", *(p.tobytes() for p in parts))
        yield pa.RecordBatch.from_pydict({"bucket": [bucket], "n": [len(keys)]}, schema=pa.schema([("bucket", pa.int32()), ("n", pa.int64())]))


def _counts_of(words: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Counts of sorted ids."""
    out = np.zeros(len(ids), np.int64)
    cuts = np.searchsorted(ids, words.starts)
    for k in range(len(words.starts) - 1):
        if cuts[k + 1] > cuts[k]:
            out[cuts[k] : cuts[k + 1]] = words.shard(k).counts[ids[cuts[k] : cuts[k + 1]].astype(np.int64) - words.starts[k]]
    return out


@lru_cache(maxsize=4096)
def _trie(folder: str, shard: int) -> Trie:
    return Trie(read_array(folder, f"pairs-{shard}", np.uint64))


_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(batches: Iterator[pa.RecordBatch], vocabulary: tuple, shards: int, have: frozenset[int], mu: float) -> Iterator[pa.RecordBatch]:
    words = _vocabulary(*vocabulary)
    n, v = words.total, words.n
    for batch in gathered(batches):
        hashes, at, offsets = _tokens(text_column(batch))
        ids, counts, single, weight = words.look_up(hashes, mu)
        base = np.log10((counts + 1) / (n + v + 1))
        context = _pairs(at, offsets)
        keys = ids[context].astype(np.uint64) << np.uint64(32) | ids[at].astype(np.uint64)
        order = np.argsort(keys, kind="stable")
        heads = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
        distinct, of = keys[order][heads], np.empty(len(keys), np.int64)
        of[order] = np.cumsum(heads) - 1
        shard = _shard(distinct, shards)
        ratio = np.zeros(len(distinct))
        by = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[by], np.arange(shards + 1))
        for k in range(shards):
            own = by[cuts[k] : cuts[k + 1]]
            if len(own) and k in have:
                ratio[own] = 10.0 ** _trie(words.folder, k).log10(distinct[own] >> np.uint64(32), distinct[own] & np.uint64(0xFFFFFFFF))
        p = np.log10(ratio[of] + mu / (n + v + 1) * 10.0 ** (single[at] - weight[context]))
        sums = [np.add.reduceat(x, offsets[:-1]) for x in ((counts > 0)[at].astype(np.int64), base[at], p)]
        size = np.diff(offsets)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(size, pa.int64()), pa.array(sums[0], pa.int64()), pa.array(np.full(len(size), n), pa.int64()), pa.array(sums[1]), pa.array(sums[2])],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )


def score_documents(docs: DataFrame, mu: float = MU) -> DataFrame:
    """Scores of all documents by the model of those outside the held-out fold."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_bucket("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string").alias("text"))
    train = texts.where("not held_out").select("text")
    size = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(1, (size // WORD_SHARD_BYTES).bit_length())
    shards = max(1, -(-size // PAIR_SHARD_BYTES))
    folder = scratch(spark, "trie")
    listed = staged(bucketed(train.mapInArrow(lambda b: _count_words(b, bits), _BLOB), 1 << bits).mapInArrow(lambda b: _write_words(b, folder, bits, mu), "bucket int, n long, total long"), "words")
    rows = listed.collect()  # one a shard
    vocabulary = (folder, bits, tuple(sorted((x["bucket"], x["n"]) for x in rows)), sum(x["total"] for x in rows))
    pairs = bucketed(train.mapInArrow(lambda b: _count_pairs(b, vocabulary, shards), _BLOB), shards).mapInArrow(lambda b: _write_pairs(b, vocabulary, mu), "bucket int, n long")
    have = frozenset(x["bucket"] for x in staged(pairs, "pairs").collect())
    return texts.mapInArrow(lambda b: _score(b, vocabulary, shards, have, mu), _SCHEMA)


def op3_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
