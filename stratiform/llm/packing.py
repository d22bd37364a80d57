"""Operator 10: sum-of-squares online packing of token sequences.

Every document is its token ids and an end id. Full windows of ``length`` ids are cut off first; the rest of a
document is one item. An item goes to the open window level (fill) that minimises the sum of squared counts of open
windows by level; a level array holds those counts. When a partition ends, the least filled open windows are cut to
fill the gaps of the fullest, so at most one window of a partition is padded.

Each scan partition packs its own rows: no shuffle, no state shared between tasks, memory bounded by a partition's
open windows. A sequence id is ``partition * 2**33 + number in the partition``.

Defined results: null or empty text is one piece, the end id alone; repeated rows are packed again as rows of their
own; a null doc_id stays null; an empty table gives no rows; extra columns are ignored. Ties between levels go to
the fullest level.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import documents, ship, slices, text_column
from stratiform.llm.tokens import default_path, encoder, with_end

LENGTH = 2048
END_ID = 1
#: Ids of unfinished windows that a task holds before it closes them all; bounds its memory, and pads one window more.
OPEN_IDS = 1 << 21


class SumOfSquares:
    """Packs items one by one; a window is a list of (item, start in the item, length)."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.levels = np.zeros(length + 1, dtype=np.int64)  # open windows by fill; 0 and `length` stay empty
        self.open: dict[int, list[list[tuple[int, int, int]]]] = {}

    def put(self, item: int, start: int, size: int) -> list[tuple[int, int, int]] | None:
        """Place an item of 1 to length - 1 ids; returns the window if it is full now."""
        n, top = self.levels, self.length
        # Moving a window from level h to h + size changes the sum of squares by 2(n[h + size] - n[h]) + 2; a full window leaves it.
        gain = n[size : top + 1] - n[: top + 1 - size]
        gain[-1] = -n[top - size]
        change = np.where(n[: top + 1 - size] > 0, 2 * gain + 2, np.iinfo(np.int64).max)
        change[-1] = 1 - 2 * n[top - size] if n[top - size] else np.iinfo(np.int64).max
        change[0] = 2 * n[size] + 1
        best = len(change) - 1 - int(np.argmin(change[::-1]))
        if best:
            window = self.open[best].pop()
            n[best] -= 1
        else:
            window = []
        window.append((item, start, size))
        if best + size == top:
            return window
        self.open.setdefault(best + size, []).append(window)
        n[best + size] += 1
        return None

    def close(self) -> list[list[tuple[int, int, int]]]:
        """All open windows; the least filled are cut to fill the others, so that at most one is not full."""
        left = sorted(((h, w) for h, ws in self.open.items() for w in ws), key=lambda x: -x[0])
        self.levels[:] = 0
        self.open = {}
        out, low = [], len(left) - 1
        for k in range(len(left)):
            if k > low:
                break
            fill, window = left[k]
            while fill < self.length and low > k:
                h, donor = left[low]
                item, start, size = donor.pop()
                take = min(size, self.length - fill)
                window.append((item, start + size - take, take))
                if take < size:
                    donor.append((item, start, size - take))
                fill += take
                left[low] = (h - take, donor)
                if not donor:
                    low -= 1
            out.append(window)
        return out


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padding long"


def _pack(batches: Iterator[pa.RecordBatch], path: str, length: int, end_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encode, packer = encoder(path).encode, SumOfSquares(length)
    base, made = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33, 0
    held: dict[int, tuple[int | None, np.ndarray]] = {}
    used: dict[int, int] = {}
    waiting = item = 0
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padding", *["ids"] * with_ids]
    rows: list[list] = [[] for _ in names]

    def emit(window: list[tuple[int, int, int]]) -> None:
        nonlocal made, waiting
        total = sum(x[2] for x in window)
        padding = 0 if total & (total - 1) == 0 else length - total
        offset = 0
        for k, start, size in window:
            doc, ids = held[k]
            piece = ids[start : start + size]
            for column, value in zip(rows, (doc, start, size, zlib.crc32(piece), len(ids), base + made, offset, padding, piece), strict=False):
                column.append(value)
            offset += size
            used[k] -= size
            waiting -= size
            if not used[k]:
                del held[k], used[k]
        made += 1

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in rows[:8]]
        if with_ids:
            ends = np.concatenate([[0], np.cumsum([len(x) for x in rows[8]])])
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*rows[8], np.empty(0, np.uint32)]), pa.int64())))
        for c in rows:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in slices(batches):
        ids, offsets = with_end(*encode(text_column(batch)), end_id)
        for doc, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            held[item] = (doc, ids[a:b].copy())
            used[item] = b - a
            waiting += b - a
            whole = (b - a) // length * length
            for start in range(0, whole, length):
                emit([(item, start, length)])
            if b - a > whole and (window := packer.put(item, whole, b - a - whole)):
                emit(window)
            item += 1
        if waiting > OPEN_IDS:
            for window in packer.close():
                emit(window)
        yield flush()
    for window in packer.close():
        emit(window)
    yield flush()


def pack_documents(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of packed sequences; ``with_ids`` adds each piece's ids as an array."""
    path = tokenizer or default_path()
    ship(docs.sparkSession)
    schema = _SCHEMA + (", ids array<long>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lambda b: _pack(b, path, length, end_id, with_ids), schema)


def op10_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
