"""Operator 9: token-id files with frequency-ranked ids in byte-aligned variable-length coding.

Format of a folder: ``ranks.u32`` (the id of each rank, little-endian uint32; rank 0 is the most frequent id of the
corpus, ties by id) and one ``part-NNNNNN-A.ids`` for each doc_id range, in ascending order. A part file is a row
of blocks: a header of six little-endian int64 (magic, documents, ids, control bytes, data bytes, 0), the doc_ids
(int64, the least int64 for null), the ids of each document (uint32), the control bytes (2 bits an id: its length in
bytes less one, four ids a byte, low bits first), and the data bytes (each rank in 1 to 4 bytes, low byte first).
numpy decodes a block by a 256 x 4 table of lengths.

Plan: tokenise once to a staged table; count ids there (the vocabulary bounds what reaches the driver); order by a
range shuffle of the ids, not of the text; each task writes its file, then only the files are read. A retried task
writes a new file; the list of files names those of the tasks that ended.

Defined results: null or empty text is the end id alone; equal doc_ids (and null ones, which come first) keep all
their rows, ordered by crc and length; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import discard, documents, gathered, ragged, remove, scratch, ship, slices, staged, text_column
from stratiform.llm.tokens import byte_blobs, default_path, encoder, with_end

END_ID = 2
MAGIC = 0x53565442
NULL_ID = np.iinfo(np.int64).min
#: Ids of a part file at the least, and the most part files; together they bound the list of files.
FILE_IDS, MOST_FILES = 8 << 20, 100_000
_HEADER = struct.Struct("<6q")
#: Lengths in bytes of the four ids of each control byte.
LENGTHS = (np.arange(256)[:, None] >> (2 * np.arange(4)) & 3).astype(np.uint8) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes."""
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    at = np.cumsum(size, dtype=np.int64) - size
    data = np.empty(int(size.sum(dtype=np.int64)), np.uint8)
    data[at] = ranks & 0xFF
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        data[at[more] + k] = ranks[more] >> 8 * k & 0xFF
    return control, data


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    size = LENGTHS[control].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    ranks = data[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        if len(more):
            ranks[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def pack_block(doc_ids: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = encode_ranks(ranks)
    head = _HEADER.pack(MAGIC, len(doc_ids), len(ranks), len(control), len(data), 0)
    return b"".join((head, doc_ids.astype("<i8").tobytes(), counts.astype("<u4").tobytes(), control.tobytes(), data.tobytes()))


def blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """doc_ids, ids of each document, and ranks of each block."""
    while head := stream.read(_HEADER.size):
        magic, docs, n, c, d, _ = _HEADER.unpack(head)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        doc_ids = np.frombuffer(stream.read(8 * docs), "<i8")
        counts = np.frombuffer(stream.read(4 * docs), "<u4").astype(np.int64)
        control, data = np.frombuffer(stream.read(c), np.uint8), np.frombuffer(stream.read(d), np.uint8)
        yield doc_ids, counts, decode_ranks(control, data, n)


def _tokenise(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode
    for batch in gathered(batches):
        ids, offsets = with_end(*encode(text_column(batch)), end_id)
        wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        blob = byte_blobs(ids.astype("<u4" if wide else "<u2"), offsets)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(crc, pa.int64()), pa.array(np.diff(offsets), pa.int64()), blob], names=["doc_id", "crc", "n_tokens", "ids"])


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a staged batch, and the count of each row."""
    counts = batch.column("n_tokens").to_numpy().astype(np.int64)
    column = batch.column("ids").cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(column) else np.empty(0, np.uint8)
    size = np.diff(ends)
    if (size == 2 * counts).all():
        return raw.view("<u2").astype(np.uint32), counts
    parts = [raw[a - ends[0] : b - ends[0]].view("<u2" if b - a == 2 * c else "<u4").astype(np.uint32) for a, b, c in zip(ends[:-1], ends[1:], counts, strict=True)]
    return np.concatenate(parts), counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, np.int64)
    for batch in slices(batches, "ids"):
        n = np.bincount(_ids(batch)[0])
        if len(n) > len(total):
            n, total = total, n.astype(np.int64)
        total[: len(n)] += n
    kept = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(total[kept], pa.int64())], names=["id", "n"])


def _write(batches: Iterator[pa.RecordBatch], folder: str, rank_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    fs, base = pafs.FileSystem.from_uri(folder)
    task = TaskContext.get()
    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
    docs = n = size = 0
    out = None
    for batch in slices(batches, "ids", 4 << 20):
        ids, counts = _ids(batch)
        doc_ids = batch.column("doc_id").fill_null(int(NULL_ID)).to_numpy()
        out = out or fs.open_output_stream(f"{base}/{name}")
        block = pack_block(doc_ids, counts, rank_of[ids])
        out.write(block)
        docs, n, size = docs + len(counts), n + len(ids), size + len(block)
    if out:
        out.close()
        yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "file": [name], "n_docs": [docs], "n_ids": [n], "n_bytes": [size]}, schema=pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))


def write_token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> tuple[str, DataFrame]:
    """Write the folder; returns its path and the list of its files (part, file, n_docs, n_ids, n_bytes)."""
    spark, path = docs.sparkSession, tokenizer or default_path()
    ship(spark)
    ids = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lambda b: _tokenise(b, path, end_id), "doc_id long, crc long, n_tokens long, ids binary"), "ids")
    counted = ids.select("n_tokens", "ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    order = counted.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)
    rank_of = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    folder = scratch(spark, "token-files")
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base)
    with fs.open_output_stream(f"{base}/ranks.u32") as out:
        out.write(order.astype("<u4").tobytes())
    files = min(MOST_FILES, max(1, -(-int(counted["n"].sum()) // FILE_IDS)))
    table = spark.sparkContext.broadcast(rank_of)
    listed = ids.repartitionByRange(files, "doc_id", "crc", "n_tokens").sortWithinPartitions("doc_id", "crc", "n_tokens").mapInArrow(lambda b: _write(b, folder, table.value), "part long, file string, n_docs long, n_ids long, n_bytes long")
    listed = staged(listed, "token-files-list")
    discard(ids)
    return folder, listed


def _read(batches: Iterator[pa.RecordBatch], folder: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{base}/ranks.u32") as s:
        order = np.frombuffer(s.read(), "<u4")
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    for batch in batches:
        for name, start in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
            with fs.open_input_stream(f"{base}/{name}") as stream:
                for doc_ids, counts, ranks in blocks(stream):
                    ids = np.ascontiguousarray(order[ranks], "<u4")
                    ends = np.concatenate([[0], np.cumsum(counts)])
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    columns = [pa.array(doc_ids, pa.int64(), mask=doc_ids == NULL_ID), pa.array(start + ends[:-1], pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    start += int(counts.sum())


def read_token_files(spark: SparkSession, folder: str, listed: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the folder: doc_id, start, n_tokens, ids_crc32; ``with_ids`` adds the ids."""
    ship(spark)
    # At most MOST_FILES rows.
    files = listed.orderBy("part").select("file", "n_ids").toPandas()
    before = (files["n_ids"].cumsum() - files["n_ids"]).tolist()
    table = spark.createDataFrame(list(zip(range(len(files)), files["file"].tolist(), before, strict=True)), "k long, file string, before long")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return table.repartition(max(1, len(files))).select("file", "before").mapInArrow(lambda b: _read(b, folder, with_ids), schema)


def op9_ranked_varbyte_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, listed = write_token_files(documents(spark, sf_dir))
    return read_token_files(spark, folder, listed)


__all__ = ["decode_ranks", "encode_ranks", "op9_ranked_varbyte_ids", "ragged", "read_token_files", "remove", "write_token_files"]
