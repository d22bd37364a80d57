"""Shared plumbing of the corpus operators: the shared folder, Arrow word splitting, 64-bit hashes.

A *word* is a maximal run of characters outside space and U+0009..U+000D; folding touches A-Z only.
Both choices are ASCII rules, so they can be applied to UTF-8 bytes without decoding.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a Python worker.
BATCH_BYTES = 2 << 20
#: Odd multipliers that combine the hashes of neighbouring words into one shingle hash.
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
SHINGLE_WORDS = 5


# --- session -----------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a local master gets a folder of its own; any other master raises, since executors would not see it.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="stratiform-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of any Hadoop file system."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read back; survives the loss of executors. ``options`` go to the writer."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a staged frame that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)


def free(spark: SparkSession) -> None:
    """Have the driver find that shuffles are no longer referred to, so that executors delete their files."""
    gc.collect()
    spark._jvm.System.gc()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once for each application."""
    sc = spark.sparkContext
    bytes_a_batch = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bytes_a_batch) == "67108864b":  # where it was left at its default: a batch lies in the executor and in its worker
        spark.conf.set(bytes_a_batch, f"{BATCH_BYTES}b")
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- Arrow -------------------------------------------------------------------


def settle() -> None:
    """Give freed memory back: a worker is kept for later tasks, of other stages too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        return


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that no piece of over one row holds more than ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        start = 0
        while start < len(size):
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
    settle()


def gathered(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 8 * BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``: joins small batches, cuts large ones."""
    held, size = [], 0
    for piece in slices(batches, column, limit):
        n = pc.sum(pc.binary_length(piece.column(column))).as_py() or 0
        if held and size + n > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(piece)
        size += n
    if held:
        yield pa.concat_batches(held)


def text_column(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column as UTF-8 strings with nulls as ''."""
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and the n+1 offsets of each text's words."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts) if lower else texts)
    lists = pc.ascii_split_whitespace(trimmed)
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    empty = pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
    if empty.any():
        flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
        counts = np.diff(offsets)
        counts[empty] = 0
        offsets = np.concatenate([[0], np.cumsum(counts)])
    return flat, offsets


def hash_values(values: pa.Array) -> np.ndarray:
    """XXH3 of each value's bytes as unsigned 64-bit numbers; values should be distinct."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, values.cast(pa.binary()).to_pylist()), dtype=np.uint64, count=len(values))


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the offsets of each text's words; hashes each distinct word once."""
    flat, offsets = split_words(texts, lower)
    if not len(flat):
        return np.empty(0, np.uint64), offsets
    coded = flat.dictionary_encode()
    return hash_values(coded.dictionary)[coded.indices.to_numpy()], offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, offsets: np.ndarray, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word shingles, and their offsets for each text.

    A text of fewer than n words, but some, has its whole sequence as its one shingle; a text without words has none.
    """
    counts = np.diff(offsets)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out_offsets = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(int(out_offsets[-1]), dtype=np.uint64)
    if len(words) >= n:
        rolled = np.zeros(len(words) - n + 1, dtype=np.uint64)
        for j in range(n):
            rolled += words[j : len(words) - n + 1 + j] * _ODD[j]
        long = np.flatnonzero(counts >= n)
        out_at, word_at = ragged(out_offsets[long], made[long]), ragged(offsets[long], made[long])
        out[out_at] = mix(rolled[word_at])
    for d in np.flatnonzero((counts > 0) & (counts < n)):
        own = words[offsets[d] : offsets[d + 1]]
        out[out_offsets[d]] = mix((own * _ODD[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))[0]
    return out, out_offsets


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... for each (start, count), one after another."""
    counts = np.asarray(counts, dtype=np.int64)
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    keep = counts > 0
    starts, counts = np.asarray(starts, dtype=np.int64)[keep], counts[keep]
    steps = np.ones(total, dtype=np.int64)
    heads = np.concatenate([[0], np.cumsum(counts)[:-1]])
    steps[heads] = starts - np.concatenate([[0], (starts + counts - 1)[:-1]])
    return np.cumsum(steps)


def crc_bucket(column: str, modulus: int):
    """crc32 of the column as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


# --- blobs: many numbers in one row -------------------------------------------


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """Rows of a bucket side by side, for ``by_bucket``."""
    return df.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """All rows of each bucket; what a bucket holds is bounded by the number of buckets."""
    now, held = None, []
    for batch in batches:
        keys = batch.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                if held and keys[a] != now:
                    yield now, pa.Table.from_batches(held)
                    held = []
                now = int(keys[a])
                held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)
        held = []
    settle()


def joined_blob(column: pa.ChunkedArray, kind) -> np.ndarray:
    """The numbers of all blobs, one after another."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def read_array(folder: str, name: str, kind) -> np.ndarray:
    """An array of a file in a shared folder: memory-mapped where the folder is a local path, else read."""
    import pyarrow.fs as pafs

    fs, base = pafs.FileSystem.from_uri(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        with pa.memory_map(f"{base}/{name}") as m:
            return np.frombuffer(m.read_buffer(), kind)
    with fs.open_input_file(f"{base}/{name}") as f:
        return np.frombuffer(f.read(), kind)


def write_bytes(folder: str, name: str, *parts: bytes) -> None:
    """Write a file of a shared folder under a temporary name, then move it into place: a retried task leaves no half."""
    import pyarrow.fs as pafs

    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base)
    own = f"{base}/{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        for p in parts:
            out.write(p)
    fs.move(own, f"{base}/{name}")
