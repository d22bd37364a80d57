"""Operator 4: benchmark decontamination by SimHash windows and multi-index Hamming search.

For an item of n words every window of n words of a text is a candidate. Its 256-bit SimHash sums the signed bits of its
5-word shingles, weighted by their counts. Fingerprints are found by a multi-index: 16 blocks of 16 bits; a pair
within RADIUS = 63 bits has a block with 3 differing bits at most, and those are all found (the index holds each
block's values within 2 bits, a probe asks for those within 1). A found pair within the radius is verified by the exact
weighted Jaccard similarity of its shingle counts (sum of least counts over sum of largest), 0.75 at least.

Windows that cannot reach that are skipped without loss: they need 6/7 of their shingles among the items' shingles.
At similarity 0.75 a pair lies beyond the radius with probability below 0.001. Items of one to four words match windows
equal to them. Items are a stated query set: they are searched in blocks of BLOCK_ITEMS, each broadcast with its index
(bounded by the block), so any number of items works; texts are scanned in place, without a shuffle.

Defined results: null and empty texts and items match nothing; repeated documents and items are reported each;
null doc_ids stay null; an empty table gives no rows; extra columns are ignored; of equally similar windows the first
is reported.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import SHINGLE_WORDS, documents, mix, ragged, ship, shingles, slices, text_column, word_hashes

BITS, BLOCKS = 256, 16
RADIUS = 63
SIMILARITY = (75, 100)
BLOCK_ITEMS = 4000
_TWO = np.array([0, *(1 << i for i in range(16)), *(1 << i | 1 << j for i, j in combinations(range(16), 2))], dtype=np.uint16)
_ONE = np.array([0, *(1 << i for i in range(16))], dtype=np.uint16)


def signed_bits(hashes: np.ndarray) -> np.ndarray:
    """256 signs of each shingle hash."""
    words = np.stack([mix(hashes + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15 >> 8)) for k in range(BITS // 64)], axis=1)
    return np.unpackbits(words.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Rows of 16 blocks of 16 bits."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


class Index:
    """Items of one block: their shingles, fingerprints, and the multi-index."""

    def __init__(self, item_ids: list[int], texts: list[str]):
        words, offsets = word_hashes(pa.array(texts, pa.string()))
        hashes, ends = shingles(words, offsets)
        sizes = np.diff(offsets)
        self.ids = item_ids
        self.sizes = sizes
        self.short: dict[int, dict[int, list[int]]] = {}
        for k in np.flatnonzero((sizes > 0) & (sizes < SHINGLE_WORDS)):
            self.short.setdefault(int(sizes[k]), {}).setdefault(int(hashes[ends[k]]), []).append(int(k))
        self.long = np.flatnonzero(sizes >= SHINGLE_WORDS)
        self.counts = {int(k): Counter(hashes[ends[k] : ends[k + 1]].tolist()) for k in self.long}
        own = np.repeat(np.arange(len(sizes)), np.diff(ends))
        keep = sizes[own] >= SHINGLE_WORDS
        order = np.argsort(hashes[keep], kind="stable")
        self.shingles, self.owners = hashes[keep][order], own[keep][order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.shingles & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        self.prints = np.zeros((len(sizes), BLOCKS), np.uint16)
        for k in self.long:
            self.prints[k] = fingerprints(signed_bits(hashes[ends[k] : ends[k + 1]]).sum(axis=0, dtype=np.int32)[None, :])[0]
        self.tables = []
        for b in range(BLOCKS):
            values = (self.prints[self.long, b][:, None] ^ _TWO[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            self.tables.append((np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << 16))]).astype(np.int32), np.repeat(self.long, len(_TWO))[order].astype(np.int32)))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (row, item) whose fingerprints differ in RADIUS bits at most."""
        if not len(self.long):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = []
        for b, (offsets, items) in enumerate(self.tables):
            probe = (prints[:, b][:, None] ^ _ONE[None, :]).ravel()
            n = offsets[probe.astype(np.int64) + 1] - offsets[probe]
            rows = np.repeat(np.repeat(np.arange(len(prints)), len(_ONE)), n)
            keys.append(np.unique(rows * len(self.sizes) + items[ragged(offsets[probe], n)]))
        pairs = np.unique(np.concatenate(keys))
        rows, items = pairs // len(self.sizes), pairs % len(self.sizes)
        distance = np.bitwise_count(prints[rows] ^ self.prints[items]).sum(axis=1)
        return rows[distance <= RADIUS], items[distance <= RADIUS]

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Which shingles are some item's."""
        out = self.seen[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            place = np.minimum(np.searchsorted(self.shingles, hashes[at]), len(self.shingles) - 1)
            out[at] = self.shingles[place] == hashes[at]
        return out

    def search(self, hashes: np.ndarray, hit: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Items found in one text of five words or more: item -> (similarity, first word of the best window, windows)."""
        found: dict[int, tuple[float, int, int]] = {}
        low = np.searchsorted(self.shingles, hashes[hit], "left")
        high = np.searchsorted(self.shingles, hashes[hit], "right")
        owners = np.unique(self.owners[ragged(low, high - low)])
        total = np.concatenate([[0], np.cumsum(hit)])
        for size in np.unique(self.sizes[owners]):
            n = int(size) - SHINGLE_WORDS + 1
            starts = np.arange(len(hashes) - n + 1)
            part, whole = SIMILARITY
            # common / (2n - common) >= part / whole
            starts = starts[(part + whole) * (total[starts + n] - total[starts]) >= 2 * part * n] if len(starts) else starts
            for a in range(0, len(starts), 512):
                self._verify(hashes, starts[a : a + 512], n, found)
        return found

    def _verify(self, hashes: np.ndarray, starts: np.ndarray, n: int, found: dict[int, tuple[float, int, int]]) -> None:
        first, last = int(starts[0]), int(starts[-1]) + n
        used = np.unique(ragged(starts, np.full(len(starts), n))) if last - first > 8 * n else np.arange(first, last)
        bits = np.zeros((len(used) + 1, BITS), np.int32)
        np.cumsum(signed_bits(hashes[used]), axis=0, dtype=np.int32, out=bits[1:])
        at = np.searchsorted(used, starts)
        rows, items = self.near(fingerprints(bits[at + n] - bits[at]))
        part, whole = SIMILARITY
        for row in np.unique(rows):
            start = int(starts[row])
            window = Counter(hashes[start : start + n].tolist())
            for k in items[rows == row].tolist():
                if self.sizes[k] - SHINGLE_WORDS + 1 != n:
                    continue
                common = sum(min(c, window[h]) for h, c in self.counts[k].items() if h in window)
                if whole * common >= part * (2 * n - common):
                    score, best, windows = found.get(k, (-1.0, 0, 0))
                    now = common / (2 * n - common)
                    found[k] = (now, start, windows + 1) if now > score else (score, best, windows + 1)


def _matches(batch: pa.RecordBatch, index: Index) -> list[dict[int, tuple[float, int, int]]]:
    words, offsets = word_hashes(text_column(batch))
    hashes, ends = shingles(words, offsets)
    sizes = np.diff(offsets)
    hit = index.hits(hashes)
    some = np.add.reduceat(np.append(hit, False), np.minimum(ends[:-1], len(hit))) if len(hit) else np.zeros(len(sizes))
    out: list[dict[int, tuple[float, int, int]]] = [{} for _ in sizes]
    for d in np.flatnonzero((some > 0) & (sizes >= SHINGLE_WORDS)):
        out[d] = index.search(hashes[ends[d] : ends[d + 1]], hit[ends[d] : ends[d + 1]])
    for n, wanted in index.short.items():
        for d in np.flatnonzero(sizes >= n):
            own = words[offsets[d] : offsets[d + 1]]
            windows, _ = shingles(np.lib.stride_tricks.sliding_window_view(own, n).ravel(), np.arange(0, (len(own) - n + 2) * n, n))
            for h in np.intersect1d(windows, np.array(list(wanted), np.uint64)):
                at = np.flatnonzero(windows == h)
                for k in wanted[int(h)]:
                    out[d][k] = (1.0, int(at[0]), len(at))
    return out


def _search(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        ids = batch.column("doc_id").to_pylist()
        rows = [(ids[d], index.ids[k], *found) for d, m in enumerate(_matches(batch, index)) for k, found in sorted(m.items())]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "similarity", "start_word", "n_windows"])


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The index of each block of items; holds one block at a time."""
    ids, texts = [], []
    for x in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").toLocalIterator():
        ids.append(x["item_id"])
        texts.append(x["text"])
        if len(ids) == BLOCK_ITEMS:
            yield Index(ids, texts)
            ids, texts = [], []
    if ids:
        yield Index(ids, texts)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item found in it."""
    spark = docs.sparkSession
    ship(spark)
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, similarity double, start_word long, n_windows long"
    out = None
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)
        found = columns.mapInArrow(lambda b, s=shared: _search(b, s.value), schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any benchmark item, all columns."""
    spark = docs.sparkSession
    ship(spark)
    names = docs.columns
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], s=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                keep = pa.array([not m for m in _matches(batch, s.value)], pa.bool_())
                yield pa.RecordBatch.from_arrays([pc.filter(c, keep) for c in batch.columns], names=names)

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op4_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
