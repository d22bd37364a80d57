"""Operator 8: MinHash near-duplicate classes (Jaccard of distinct 5-word shingles at least 0.75).

1. Each text's shingle set is hashed; texts with equal sets are one class, named by its least doc_id.
2. One-permutation hashing: a set's hashes fall into 128 bins, each keeps its least; an empty bin takes the value of
   a bin picked by its own hash sequence (optimal densification). 32 bands of 4 bins are the buckets: a pair at
   similarity 0.75 shares no bucket with probability below 1e-5.
3. Star-shaped candidates: each bucket links its members to its least doc_id; a link is confirmed on the full sets.
   While that halves the pairs left, all members but the centre star the same bucket again. Then the members outside
   a bucket's largest component (the outliers) are compared with all its members on the full sets, in cells of about
   2 * BLOCK sets: outliers times members, not members squared. So every pair that shares a bucket is compared or
   already in one component.
4. Components by alternating large and small stars.

Bucket counts and centres are map-side combined, joins on centres and buckets are equi-joins whose skewed
partitions adaptive execution can split; no group is gathered in one task. Sets are made only for documents that share
a bucket. The ids of those are broadcast only while they are few (MOST_BROADCAST), else joined by shuffle.

Defined results: null, empty and white-space texts have n_shingles 0 and stand alone; texts of one to four words have
one shingle, the whole sequence; rows of equal doc_id are one node that holds the texts of all of them, so they get
the same component; a null doc_id stands alone with component null and kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import discard, documents, mix, ship, shingles, slices, staged, text_column, word_hashes
from stratiform.llm.tokens import byte_blobs

BINS, BAND_BINS = 128, 4
BANDS = BINS // BAND_BINS
SIMILARITY = (75, 100)
MOST_BROADCAST = 1_000_000
#: Members of a bucket are compared pair by pair in cells of two blocks of about this many.
BLOCK = 256
#: With more pairs left than this the buckets are starred again, as long as that halves them.
MANY_PAIRS = 2_000_000
#: Shingles counted at once when a cell's sets are compared.
_COLUMNS = 4096
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_EDGES = (np.arange(BINS, dtype=np.uint64) << np.uint64(57)).astype(np.uint64)


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """One-permutation minima of sorted non-empty sets, densified: one row of BINS values a set."""
    out = np.full((len(sets), BINS), _EMPTY)
    for row, s in zip(out, sets, strict=True):
        at = np.searchsorted(s, _EDGES)
        ends = np.append(at[1:], len(s))
        full = at < ends
        row[full] = s[at[full]]
    filled = out != _EMPTY
    rows, bins = np.nonzero(~filled)
    attempt = 0
    while len(rows):
        attempt += 1
        pick = (mix(bins.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt << 32)) >> np.uint64(57)).astype(np.int64)
        hit = filled[rows, pick]
        out[rows[hit], bins[hit]] = out[rows[hit], pick[hit]]
        rows, bins = rows[~hit], bins[~hit]
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One key for each band of each signature."""
    parts = signatures.reshape(len(signatures), BANDS, BAND_BINS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(BAND_BINS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key


def _sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, offsets = shingles(*word_hashes(texts))
    return [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = _sets(text_column(batch))
        some = [s for s in sets if len(s)]
        keys = iter(band_keys(signature(some)).view(np.int64)) if some else iter(())
        digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        bands = [next(keys) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_key", "bands"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = _sets(text_column(batch))
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), byte_blobs(np.concatenate(sets), offsets)], names=["doc_id", "shingles"])


def _confirm(batches: Iterator[pa.RecordBatch], similarity: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    part, whole = similarity
    for batch in batches:
        kept = []
        for a, b in zip(batch.column("sa"), batch.column("sb"), strict=True):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            common = int((y[at] == x).sum())
            kept.append(whole * common >= part * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(kept, pa.bool_())], names=["a", "b", "linked"])


def _small(df: DataFrame, n: int) -> DataFrame:
    """The frame, to be broadcast if it has few enough rows of a few numbers; else it is joined by shuffle."""
    return F.broadcast(df) if n <= MOST_BROADCAST else df


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): node and the least node reachable, for all nodes but the least ones."""
    current = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    while True:
        before = current
        n = current.count()
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every neighbour above a node, and the node itself, to the node's least neighbour
        large = both.join(_small(least, 2 * n), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.where("u != m").select("u", F.col("m").alias("v"))).where("u != v").distinct()
        large = staged(large, "edges")
        # small star: the neighbours below a node to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(_small(least, 2 * n), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        current = staged(small, "edges")
        discard(before)
        discard(large)
        # done when every node has one edge, to a node that has none
        twice = current.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("v"))
        roots = twice.select(F.col("u").alias("v"))
        if twice.where("n > 1").isEmpty() and current.join(_small(roots, current.count()), "v", "left_semi").isEmpty():
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, component) brought up to date with more links (a, b)."""
    n = labels.count()
    named = links
    for x in ("a", "b"):
        named = named.join(_small(labels.select(F.col("node").alias(x), F.col("component").alias(f"{x}_")), n), x, "left").withColumn(x, F.coalesce(f"{x}_", x)).drop(f"{x}_")
    new = components(named).select(F.col("node").alias("component"), F.col("component").alias("to"))
    m = new.count()
    old = labels.join(_small(new, m), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return staged(old.unionByName(new.select(F.col("component").alias("node"), F.col("to").alias("component"))).groupBy("node").agg(F.min("component").alias("component")), "labels")


def _open(rows: DataFrame) -> DataFrame:
    """Members of buckets that hold two components at least, with the bucket's size, its largest component, its pairs across components and its least doc."""
    parts = rows.groupBy("bucket", "last", "c").agg(F.count("*").alias("k"), F.min("doc").alias("least"))
    largest = F.max(F.struct(F.col("k").alias("most"), F.col("c").alias("main"))).alias("top")
    whole = parts.groupBy("bucket", "last").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("k")).alias("own"), F.min("least").alias("centre"), F.count("*").alias("parts"), largest).where("parts > 1")
    whole = staged(whole.select("bucket", "last", "n", "top.most", "top.main", ((F.col("n") * F.col("n") - F.col("own")) / 2).alias("pairs"), "centre"), "open")
    return rows.join(_small(whole, whole.count()), ["bucket", "last"])


def _across(cell: pa.Table, similarity: tuple[int, int]) -> pa.Table:
    """The links between a cell's outliers and its members in other components; a pair counts in the first bucket it shares, two outliers once."""
    part, whole = similarity
    doc, c, outlier, listed = (cell.column(x).to_numpy() for x in ("doc", "c", "outlier", "listed"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in cell.column("shingles").combine_chunks()]
    sizes, last = np.array([len(s) for s in sets]), cell.column("last")[0].as_py()
    bands = band_keys(signature(sets))[:, :last]
    rows, cols = np.flatnonzero(listed), np.flatnonzero(~listed)
    least, most = np.minimum.outer(sizes[rows], sizes[cols]), np.maximum.outer(sizes[rows], sizes[cols])
    tried = (c[rows][:, None] != c[cols][None, :]) & (least * whole >= most * part)
    tried &= ~outlier[cols][None, :] | (doc[rows][:, None] < doc[cols][None, :])
    for k in range(last):
        tried &= bands[rows, k][:, None] != bands[cols, k][None, :]
    if tried.any():
        common = _common(sets, sizes, rows, cols)
        tried &= whole * common >= part * (np.add.outer(sizes[rows], sizes[cols]) - common)
    x, y = np.nonzero(tried)
    return pa.table({"a": pa.array(doc[rows[x]], pa.int64()), "b": pa.array(doc[cols[y]], pa.int64())})


def _common(sets: list[np.ndarray], sizes: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """The number of common shingles of each set of rows with each of cols."""
    _, at, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    column = (np.cumsum(shared) - 1)[at]
    keep = shared[at]
    column, member = column[keep], np.repeat(np.arange(len(sets)), sizes)[keep]
    order = np.argsort(column, kind="stable")
    column, member = column[order], member[order]
    out = np.zeros((len(rows), len(cols)), np.int64)
    for start in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [start, start + _COLUMNS])
        has = np.zeros((len(sets), _COLUMNS), np.float32)
        has[member[a:b], column[a:b] - start] = 1
        out += (has[rows] @ has[cols].T).astype(np.int64)
    return out


def _all_pairs(rows: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The links (a, b) across components of each bucket: its outliers, in blocks, with all members, in blocks."""
    outlier = F.col("c") != F.col("main")
    few, many = F.ceil((F.col("n") - F.col("most")) / BLOCK), F.ceil(F.col("n") / BLOCK)
    own = lambda blocks: F.pmod(F.xxhash64("doc"), blocks)
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    names = ["bucket", "last", "low", "high", "listed", outlier.alias("outlier"), F.col("doc").alias("doc_id"), "c"]
    listed = rows.where(outlier).select("*", own(few).alias("low"), every(many).alias("high"), F.lit(True).alias("listed"))
    members = rows.select("*", own(many).alias("high"), every(few).alias("low"), F.lit(False).alias("listed"))
    cells = staged(listed.select(names).unionByName(members.select(names)), "cells")
    full = sets.join(_small(cells, cells.count()), "doc_id").withColumnRenamed("doc_id", "doc")
    return full.groupBy("bucket", "last", "low", "high").applyInArrow(lambda cell: _across(cell, similarity), "a long, b long")


def _confirmed(edges: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The edges (a, b) whose full sets are similar."""
    edges = staged(edges.distinct(), "edges")
    n = edges.count()
    centres = edges.select(F.col("a").alias("doc_id")).distinct()
    part, whole = similarity
    sb = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")).join(_small(edges, n), "b")
    sa = sets.join(_small(centres, n), "doc_id").select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    size = F.octet_length("sa"), F.octet_length("sb")
    pairs = sb.join(sa, "a").where(F.least(*size) * whole >= F.greatest(*size) * part).select("a", "b", "sa", "sb")
    return pairs.mapInArrow(lambda x: _confirm(x, similarity), "a long, b long, linked boolean").where("linked").select("a", "b")


def near_duplicates(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = staged(texts.mapInArrow(_profile, "doc_id long, n_shingles long, set_key binary, bands array<long>"), "profile")
    classes = staged(profile.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    named = profile.where("doc_id is not null").select("set_key", "doc_id", "bands").join(classes, "set_key")
    reps = staged(named.where("doc_id = rep").dropDuplicates(["set_key"]).select("doc_id", "bands"), "reps")
    rows = reps.select(F.col("doc_id").alias("doc"), F.posexplode("bands").alias("last", "bucket")).distinct()
    # Rows of one doc_id with several texts: their classes are linked.
    several = named.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    same = staged(named.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")).where("a != b").distinct(), "same")
    # The first stars need no components: the least doc of each bucket with two members.
    firsts = rows.groupBy("bucket", "last").agg(F.min("doc").alias("centre"), F.max("doc").alias("most")).where("most > centre").drop("most")
    members = staged(rows.join(firsts, ["bucket", "last"]), "buckets")
    ids = members.select(F.col("doc").alias("doc_id")).distinct()
    few = ids.count() <= MOST_BROADCAST
    sets = staged(texts.join(F.broadcast(ids) if few else ids, "doc_id").mapInArrow(_full_sets, "doc_id long, shingles binary").where("octet_length(shingles) > 0").distinct(), "sets")
    labels, before = None, None
    while True:
        links = staged(_confirmed(members.where("doc != centre").select(F.col("centre").alias("a"), F.col("doc").alias("b")), sets, similarity), "links")
        if labels is None:
            labels = components(links.unionByName(same))
        elif not links.isEmpty():
            labels = _merged(labels, links)
        # A bucket goes on with all members but the centre, which has been compared with every member outside its component.
        named = members.where("doc != centre").select("bucket", "last", "doc")
        named = named.join(_small(labels.select(F.col("node").alias("doc"), F.col("component").alias("c")), labels.count()), "doc", "left")
        rest = named.select("bucket", "last", "doc", F.coalesce("c", "doc").alias("c"))
        old, members = members, staged(_open(rest), "buckets")
        discard(old)
        pairs = members.where("doc = centre").agg(F.sum("pairs")).first()[0] or 0
        if pairs <= MANY_PAIRS or (before is not None and 2 * pairs > before):
            break
        before = pairs
    if pairs:
        labels = _merged(labels, staged(_all_pairs(members, sets, similarity), "links"))
    for done in (members, sets, reps, same):
        discard(done)
    nodes = labels.select(F.col("node").alias("rep"), "component")
    resolved = classes.join(nodes, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    out = profile.join(resolved, "set_key", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row of each near-duplicate class, that of the least doc_id, with all columns; of rows with equal doc_id one stays."""
    near = staged(near_duplicates(docs, similarity), "near")
    gone = near.where("not kept").select("doc_id").distinct()
    few = gone.count() <= MOST_BROADCAST
    out = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(docs.columns)
    again = near.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if again.isEmpty():
        return out
    return out.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(out.join(again, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"]))


def op8_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
