"""Operator 7: removal of repeated 50-byte strings by a sparse suffix array with deep-shallow sorting.

A byte goes if a 50-byte string over it also starts in a document of smaller doc_id (strings judged on the input).

1. Exact copies of a text need no sorting: all but the least doc_id lose every byte (of 50 bytes at least).
2. Anchors: every 50-byte window names the 16-byte string in it of least hash (the leftmost such). Equal windows have
   the same anchor at the same place, so windows that occur twice have anchors that occur twice. About one position in
   18 is an anchor. Each batch sends the anchors of one of its texts with that text's key, and those of several as one
   count, to the anchor's bucket (blobs of hashes); what two texts share goes back to a bucket of the text's key, and the
   texts are joined with their shared anchors. Every shuffle is linear in the anchors.
3. The stretch of windows around each such anchor goes to the anchor's bucket. Stretches that are equal bytes in a task
   are one: only the least doc_id's travels, the others' windows are known to go.
4. In a bucket, a suffix array of the stretches' suffixes at the anchor, and one of the reversed prefixes before it.
   Sorting is deep-shallow: multikey quicksort, eight bytes a key and all groups partitioned three ways in each
   vectorised step, to depth SHALLOW; the groups that still share a prefix are ordered by blind tries. The longest common prefixes
   give the classes of equal strings at any depth, so a window that begins o bytes before the anchor is the pair
   (class of the prefixes at depth o, class of the suffixes at depth 50 - o); its least doc_id keeps its bytes.
5. Each document's intervals are joined back to its text.

Anchors shared by very many texts meet as one stretch a task where the bytes around them are equal; only the ends of a
shared passage differ between texts. Anchors of more than HOT texts (more where the corpus is so large that over
MOST_HOT anchors could be) are spread by window instead: each window travels alone, to a bucket of its own hash. Those
anchors are broadcast; they number MOST_HOT at most.

Defined results: null and empty texts have 0 bytes and the hash of nothing; texts under 50 bytes keep all; rows of
equal doc_id do not remove each other; a null doc_id neither removes nor loses bytes; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import bucketed, by_bucket, discard, documents, free, joined_blob, mix, ragged, ship, slices, staged, text_column

LENGTH, KMER = 50, 16
SPAN = LENGTH - KMER + 1
SHALLOW = 32
BUCKET_BYTES = 16 << 20
MOST_BROADCAST = 1_000_000
#: Bytes of a row group of the written stretches.
BLOCK_BYTES = 16 << 20
#: Texts that share an anchor from which its windows travel alone, and the most such anchors.
HOT, MOST_HOT = 20_000, 1_000_000
#: Bytes of text for each anchor, about.
ANCHOR_BYTES = 18
_HEAD = np.dtype([("g", "<u8"), ("doc", "<i8"), ("tx", "<i8"), ("start", "<u4"), ("windows", "u1"), ("before", "u1")])
_SPAN = np.dtype([("doc", "<i8"), ("tx", "<i8"), ("start", "<u4"), ("end", "<u4")])
_ROW = "bucket int, spans boolean, heads binary, bytes binary"
#: 48 bits of an anchor's hash with the key of its text, or with the number of texts that have it. Two anchors that agree
#: in those bits bring stretches along that nobody shares; sorting finds that out.
_SINGLE = np.dtype([("low", "<u4"), ("high", "<u2"), ("key", "<i8")])
_SEVERAL = np.dtype([("low", "<u4"), ("high", "<u2"), ("n", "<u2")])
_BITS = np.uint64((1 << 48) - 1)
_ASKED = "bucket int, ready boolean, asks binary, shared binary"


def _kmer_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the KMER bytes from each position."""
    x = data.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | x[step:] << np.uint64(8 * step)
    return mix(x[:-8] * np.uint64(0x9E3779B97F4A7C15) + x[8:] * np.uint64(0xC2B2AE3D27D4EB4F | 1))


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchor position, first and last window, and the anchor's mixed hash."""
    none = np.empty(0, np.int64)
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    if not len(long):
        return none, none, none, np.empty(0, np.uint64)
    h = _kmer_hashes(data)
    w, width = h, 1
    while 2 * width <= SPAN:
        w = np.minimum(w[:-width], w[width:])
        width *= 2
    w = np.minimum(w[: len(w) - (SPAN - width)], w[SPAN - width :])
    new = np.ones(len(w), bool)
    new[1:] = w[1:] != w[:-1]
    new[offsets[long]] = True
    closed = np.zeros(len(w) + 1, bool)
    closed[offsets[long + 1] - LENGTH + 1] = True
    new |= closed[:-1]
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(w))
    valid = np.zeros(len(w) + 1, np.int8)
    np.add.at(valid, offsets[long], 1)
    np.add.at(valid, offsets[long + 1] - LENGTH + 1, -1)
    keep = np.cumsum(valid)[low] > 0
    low, high = low[keep], high[keep]
    out = []
    while len(low):
        value, at = w[low], np.full(len(low), -1)
        left = np.arange(len(low))
        for j in range(SPAN):
            hit = h[low[left] + j] == value[left]
            at[left[hit]] = low[left[hit]] + j
            left = left[~hit]
            if not len(left):
                break
        out.append((at, low, np.minimum(high - 1, at)))
        more = high - 1 > at  # the same string again, further on
        low, high = at[more] + 1, high[more]
    at, low, high = (np.concatenate(x) for x in zip(*out, strict=True))
    return at, low, high, mix(h[at] + np.uint64(0x165667B19E3779F9))


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = texts.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8)[ends[0] : ends[-1]] if raw.buffers()[2] else np.empty(0, np.uint8)
    return data, ends - ends[0]


def _bucket(g: np.ndarray, buckets: int) -> np.ndarray:
    return ((g >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of equal keys, and the run of each."""
    head = np.ones(len(sorted_keys), bool)
    head[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(head), np.cumsum(head) - 1


def _message(buckets: np.ndarray, blobs: list[bytes], ready: bool) -> pa.RecordBatch:
    column, none = pa.array(blobs, pa.binary()), pa.nulls(len(blobs), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array([ready] * len(blobs), pa.bool_()), none if ready else column, column if ready else none], names=["bucket", "ready", "asks", "shared"])


def _ask_blobs(g: np.ndarray, key: np.ndarray, n: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Anchors in order of their hash, as one blob a bucket: the number of single ones, those, then the others."""
    bucket = _bucket(g, buckets)
    heads, _ = _runs(bucket)
    cuts, blobs = np.append(heads, len(bucket)), []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        one = n[a:b] == 1
        single, several = np.zeros(int(one.sum()), _SINGLE), np.zeros(int((~one).sum()), _SEVERAL)
        for rows, chosen in ((single, one), (several, ~one)):
            rows["low"], rows["high"] = g[a:b][chosen].astype(np.uint32), (g[a:b][chosen] >> np.uint64(32)).astype(np.uint16)
        single["key"], several["n"] = key[a:b][one], np.minimum(n[a:b][~one], 65535)
        blobs.append(np.uint32(len(single)).tobytes() + single.tobytes() + several.tobytes())
    return _message(bucket[heads], blobs, False)


def _read_asks(blob: pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """48 bits, key and number of texts of each ask."""
    raw = np.frombuffer(blob, np.uint8)
    cut = 4 + _SINGLE.itemsize * int(raw[:4].copy().view(np.uint32)[0])
    single, several = raw[4:cut].copy().view(_SINGLE), raw[cut:].copy().view(_SEVERAL)
    g = [x["low"].astype(np.uint64) | x["high"].astype(np.uint64) << np.uint64(32) for x in (single, several)]
    return np.concatenate(g), np.concatenate([single["key"], np.zeros(len(several), np.int64)]), np.concatenate([np.ones(len(single), np.int64), several["n"].astype(np.int64)])


def _shared_blobs(key: np.ndarray, g: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Texts with their shared anchors, one blob a bucket of texts: the number of texts, keys, counts, and 32 bits of each anchor.

    Two anchors of a text that agree in those bits may bring a stretch along that nobody shares; sorting finds that out.
    """
    bucket = _key_bucket(key, buckets)
    order = np.lexsort((key, bucket))
    key, g, bucket = key[order], g[order].astype(np.uint32), bucket[order]
    heads, _ = _runs(bucket)
    cuts, blobs = np.append(heads, len(bucket)), []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        first, _ = _runs(key[a:b])
        blobs.append(b"".join((np.uint32(len(first)).tobytes(), key[a:b][first].tobytes(), np.diff(np.append(first, b - a)).astype(np.uint32).tobytes(), g[a:b].tobytes())))
    return _message(bucket[heads], blobs, True)


def _read_shared(blob: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    """The key and the anchor bits of each entry."""
    raw = np.frombuffer(blob, np.uint8)
    n = int(raw[:4].copy().view(np.uint32)[0])
    keys, counts = raw[4 : 4 + 8 * n].copy().view(np.int64), raw[4 + 8 * n : 4 + 12 * n].copy().view(np.uint32)
    return np.repeat(keys, counts), raw[4 + 12 * n :].copy().view(np.uint32)


def _key_bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return _bucket(mix(key.astype(np.uint64)), buckets)


def _ask(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Anchors of one text of the batch with its key, those of several as a count; the latter are known to be shared."""
    for batch in slices(batches):
        data, offsets = _buffer(text_column(batch))
        at, _, _, g = anchors(data, offsets)
        if not len(g):
            continue
        key = batch.column("key").to_numpy()[np.searchsorted(offsets, at, side="right") - 1]
        order = np.lexsort((key, g))
        g, key = g[order], key[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (key[1:] != key[:-1])
        g, key = g[new], key[new]
        heads, run = _runs(g)
        texts = np.diff(np.append(heads, len(g)))
        yield _ask_blobs(g[heads], key[heads], texts, buckets)
        several = texts[run] > 1
        if several.any():
            yield _shared_blobs(key[several], g[several], buckets)


def _answer(batches: Iterator[pa.RecordBatch], buckets: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The anchors of two texts or more, to their texts' buckets, and those of more than ``limit`` texts to bucket -1."""
    for bucket, table in by_bucket(batches):
        known = [x.as_py() for x in table.filter(table.column("ready").combine_chunks()).column("shared")]
        if known:
            yield _message(np.full(len(known), bucket), known, True)
        asks = [_read_asks(x.as_buffer()) for x in table.column("asks") if x.is_valid]
        if not asks:
            continue
        g, key, n = (np.concatenate(x) for x in zip(*asks, strict=True))
        order = np.argsort(g, kind="stable")
        g, key, n = g[order], key[order], n[order]
        heads, run = _runs(g)
        total = np.add.reduceat(n, heads)
        single = (n == 1) & (total[run] > 1)
        if single.any():
            yield _shared_blobs(key[single], g[single], buckets)
        many = total > limit
        if many.any():
            yield _message(np.array([-1]), [g[heads][many].tobytes()], True)


def _per_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a text with all its shared anchors."""
    for _, table in by_bucket(batches):
        key, g = (np.concatenate(x) for x in zip(*(_read_shared(x.as_buffer()) for x in table.column("shared")), strict=True))
        order = np.lexsort((g, key))
        key, g = key[order], g[order]
        heads, _ = _runs(key)
        ends = np.append(heads, len(key))
        for a in range(0, len(heads), 10_000):
            own = range(a, min(a + 10_000, len(heads)))
            yield pa.RecordBatch.from_arrays([pa.array(key[heads[a : a + 10_000]]), pa.array([g[ends[k] : ends[k + 1]].tobytes() for k in own], pa.binary())], names=["key", "gs"])


def _among(g: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of g are among sorted values."""
    return values[np.minimum(np.searchsorted(values, g), len(values) - 1)] == g if len(values) else np.zeros(len(g), bool)


def _stretches(batches: Iterator[pa.RecordBatch], buckets: int, hot_anchors: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, offsets = _buffer(text_column(batch))
        at, low, high, g = anchors(data, offsets)
        doc = np.searchsorted(offsets, at, side="right") - 1
        by_place = np.argsort(doc, kind="stable")
        cuts = np.searchsorted(doc[by_place], np.arange(batch.num_rows + 1))
        shared = np.zeros(len(g), bool)
        for k, gs in enumerate(batch.column("gs")):
            own = by_place[cuts[k] : cuts[k + 1]]
            shared[own] = _among(g[own].astype(np.uint32), np.frombuffer(gs.as_buffer(), np.uint32))
        hot = _among(g & _BITS, hot_anchors)
        shared &= ~hot
        single = ragged(low[hot], high[hot] - low[hot] + 1)  # windows that travel alone
        size = (high - low + 1)[hot]
        at, low, high, g = (np.concatenate([x[shared], y]) for x, y in ((at, np.repeat(at[hot], size)), (low, single), (high, single), (g, np.repeat(g[hot], size))))
        if not len(at):
            continue
        print_ = _prints(data, low, high - low + LENGTH)
        alone = np.zeros(len(at), bool)
        alone[len(at) - len(single) :] = True
        g = np.where(alone, mix(g ^ print_), g)
        doc = np.searchsorted(offsets, at, side="right") - 1
        heads = np.zeros(len(at), _HEAD)
        heads["g"], heads["doc"], heads["tx"] = g, batch.column("doc_id").to_numpy()[doc], batch.column("tx").to_numpy()[doc]
        heads["start"], heads["windows"], heads["before"] = low - offsets[doc], high - low + 1, at - low
        # Equal stretches of this batch: the least document's travels; later ones' windows go.
        order = np.lexsort((heads["doc"], print_, g))
        first, run = _runs(mix(g[order] ^ print_[order]))
        least = heads["doc"][order][first][run]
        travels = order[heads["doc"][order] == least]
        gone = order[heads["doc"][order] > least]
        yield from _spans(heads, gone, buckets)
        bucket = _bucket(g[travels], buckets)
        travels, bucket = travels[np.argsort(bucket, kind="stable")], np.sort(bucket)
        chosen, length = heads[travels], (high - low + LENGTH)[travels]
        body = data[ragged(low[travels], length)]
        ends = np.concatenate([[0], np.cumsum(length)])
        some, _ = _runs(bucket)
        cuts = np.append(some, len(bucket))
        yield pa.RecordBatch.from_arrays([pa.array(bucket[some], pa.int32()), pa.array([False] * len(some)), pa.array([chosen[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), pa.array([body[ends[a] : ends[b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], names=["bucket", "spans", "heads", "bytes"])


def _prints(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch (50 to 84 bytes), from the hashes of 16-byte strings that cover it."""
    h = _kmer_hashes(data)
    out = mix(length.astype(np.uint64))
    for at in (0, 16, 32, 48, 64):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[start + np.minimum(at, length - KMER)])
    return mix(out ^ h[start + length - KMER])


def _spans(heads: np.ndarray, rows: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    out = np.zeros(len(rows), _SPAN)
    out["doc"], out["tx"], out["start"] = heads["doc"][rows], heads["tx"][rows], heads["start"][rows]
    out["end"] = out["start"] + heads["windows"][rows] + (LENGTH - 1)
    yield from _span_blobs(out, buckets)


def _span_blobs(spans: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Merged spans, packed by a hash of the document."""
    if len(spans):
        out = _merged(spans)
        bucket = _key_bucket(out["doc"], buckets)
        order = np.argsort(bucket, kind="stable")
        some, _ = _runs(bucket[order])
        cuts = np.append(some, len(order))
        yield pa.RecordBatch.from_arrays([pa.array(bucket[order[some]], pa.int32()), pa.array([True] * len(some)), pa.array([out[order[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), pa.nulls(len(some), pa.binary())], names=["bucket", "spans", "heads", "bytes"])


def _merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans of a text as one."""
    spans = spans[np.lexsort((spans["start"], spans["tx"], spans["doc"]))]
    text = np.ones(len(spans), bool)
    text[1:] = (spans["doc"][1:] != spans["doc"][:-1]) | (spans["tx"][1:] != spans["tx"][:-1])
    place = np.cumsum(text).astype(np.int64) << 33
    reach = np.maximum.accumulate(place + spans["end"])
    head = np.ones(len(spans), bool)
    head[1:] = (place + spans["start"])[1:] > reach[:-1]
    first = np.flatnonzero(head)
    out = spans[first].copy()
    out["end"] = (reach - place)[np.append(first[1:], len(spans)) - 1]
    return out


# --- deep-shallow sorting -----------------------------------------------------


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """The order of distinct strings of one length by a blind trie: nodes keep a depth and the bytes there."""
    root: int | list = 0
    size = len(strings[0])
    for i in range(1, len(strings)):
        s = strings[i]
        node = root
        while not isinstance(node, int):  # blind descent: only branching bytes are looked at
            node = node[1].get(s[node[0]]) if s[node[0]] in node[1] else next(iter(node[1].values()))
        t = strings[node]
        depth = size - ((int.from_bytes(s) ^ int.from_bytes(t)).bit_length() + 7) // 8
        parent, node = None, root
        while not isinstance(node, int) and node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        if not isinstance(node, int) and node[0] == depth:
            node[1][s[depth]] = i
            continue
        new = [depth, {t[depth]: node, s[depth]: i}]
        if parent is None:
            root = new
        else:
            parent[1][s[parent[0]]] = new
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, int):
            out.append(node)
        else:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
    return out


def multikey_quicksort(words: np.ndarray, group: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by (group, the first ``columns`` words), and the number of each row's run of equals.

    Every segment is split three ways by the median of three of its keys at its depth; the middle part goes on one
    word deeper. All segments are split in the same step, in time linear in their rows.
    """
    order = np.argsort(group, kind="stable")
    start, _ = _runs(group[order])
    end, depth = np.append(start[1:], len(order)), np.zeros(len(start), np.int64)
    head = np.zeros(len(order), bool)
    while len(start):
        head[start] = True
        live = (end - start > 1) & (depth < columns)
        start, end, depth = start[live], end[live], depth[live]
        if not len(start):
            break
        size = end - start
        first = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(start)), size)
        rows = order[ragged(start, size)]
        key = words[rows, depth[segment]]
        a, b, c = key[first], key[first + size // 2], key[first + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[segment]
        at, parts = start, [start]
        for part in (key < pivot, key == pivot, key > pivot):
            ranks = np.cumsum(part)
            before = ranks[first] - part[first]
            own = np.flatnonzero(part)
            order[at[segment[own]] + ranks[own] - 1 - before[segment[own]]] = rows[own]
            at = at + np.add.reduceat(part.astype(np.int64), first)
            parts.append(at)
        start, end, depth = np.concatenate(parts[:3]), np.concatenate(parts[1:]), np.concatenate([depth, depth + 1, depth])
        some = end > start
        start, end, depth = start[some], end[some], depth[some]
    return order, np.cumsum(head) - 1


def deep_shallow_sort(group: np.ndarray, strings: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of equal-length byte rows by (group, string), and the common prefix with the row before (-1: another group)."""
    n, size = strings.shape
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    words = np.ascontiguousarray(np.pad(strings, ((0, 0), (0, -size % 8)))).view(">u8").astype(np.uint64)
    order, run = multikey_quicksort(words, group, -(-min(shallow, size) // 8))
    if size > shallow:
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        ends = np.append(starts[1:], n)
        rest = words[:, shallow // 8 :]
        for k in np.flatnonzero(ends - starts > 1):
            own = order[starts[k] : ends[k]]
            if (rest[own] == rest[own[0]]).all():
                continue
            raw = strings[own]
            members: dict[bytes, list[int]] = {}
            for row, s in zip(own.tolist(), map(bytes, raw), strict=True):
                members.setdefault(s, []).append(row)
            distinct = list(members)
            order[starts[k] : ends[k]] = [row for i in blind_trie_order(distinct) for row in members[distinct[i]]]
    a, b = strings[order[1:]], strings[order[:-1]]
    differ = a != b
    lcp = np.full(n, -1, np.int64)
    lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
    lcp[1:][group[order[1:]] != group[order[:-1]]] = -1
    return order, lcp


def repeated_windows(heads: np.ndarray, body: np.ndarray) -> np.ndarray:
    """For each stretch, which of its windows (at most SPAN) start in a smaller document's stretch too."""
    n = len(heads)
    length = heads["windows"].astype(np.int64) + LENGTH - 1
    starts = np.concatenate([[0], np.cumsum(length)[:-1]])
    before = heads["before"].astype(np.int64)
    most = before  # a window begins at most so many bytes before the anchor
    least = before - heads["windows"].astype(np.int64) + 1
    padded = np.concatenate([np.zeros(LENGTH, np.uint8), body, np.zeros(LENGTH, np.uint8)])
    columns = np.arange(LENGTH)
    right = padded[(starts + before + LENGTH)[:, None] + columns]
    right[columns[None, :] >= (LENGTH - least)[:, None]] = 0
    left = padded[(starts + before + LENGTH - 1)[:, None] - columns[None, : SPAN - 1]]
    left[columns[None, : SPAN - 1] >= most[:, None]] = 0
    r_order, r_lcp = deep_shallow_sort(heads["g"], right)
    l_order, l_lcp = deep_shallow_sort(heads["g"], left, SHALLOW // 2)
    out = np.zeros((n, SPAN), bool)
    doc = heads["doc"]
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(SPAN):
        rows = np.flatnonzero((least <= o) & (o <= most))
        if len(rows) < 2:
            continue
        r_class[r_order] = np.cumsum(r_lcp < LENGTH - o)
        l_class[l_order] = np.cumsum(l_lcp < o)
        key = r_class[rows] * (n + 1) + l_class[rows]
        order = np.argsort(key, kind="stable")
        first, run = _runs(key[order])
        if len(first) == len(rows):
            continue
        lowest = np.minimum.reduceat(doc[rows[order]], first)
        out[rows[order], o] = doc[rows[order]] > lowest[run]
    return out


def _resolve(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for _, table in by_bucket(batches):
        ready = np.array(table.column("spans").to_pylist(), bool)
        spans = [joined_blob(table.filter(pa.array(ready)).column("heads"), _SPAN)]
        rest = table.filter(pa.array(~ready))
        heads, body = joined_blob(rest.column("heads"), _HEAD), joined_blob(rest.column("bytes"), np.uint8)
        for part, own in _groups(heads, body):
            windows = repeated_windows(part, own)
            # out[:, o] is the window that begins o before the anchor: turn to ascending starts, then cut into runs
            flags = np.zeros((len(part), SPAN + 2), np.int8)
            flags[:, 1:-1] = windows[:, ::-1]
            step = np.diff(flags, axis=1)
            rows, a = np.nonzero(step == 1)
            _, b = np.nonzero(step == -1)
            out = np.zeros(len(rows), _SPAN)
            anchor = part["start"][rows].astype(np.int64) + part["before"][rows]
            out["doc"], out["tx"] = part["doc"][rows], part["tx"][rows]
            out["start"], out["end"] = anchor - (SPAN - 1) + a, anchor - (SPAN - 1) + b - 1 + LENGTH
            spans.append(out)
        yield from _span_blobs(np.concatenate(spans), buckets)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a text with all its spans, from the blobs of all buckets."""
    for _, table in by_bucket(batches):
        out = _merged(joined_blob(table.column("heads"), _SPAN))
        packed = out["start"].astype(np.int64) << 32 | out["end"].astype(np.int64)
        head = np.ones(len(out), bool)
        head[1:] = (out["doc"][1:] != out["doc"][:-1]) | (out["tx"][1:] != out["tx"][:-1])
        text = np.flatnonzero(head)
        ends = np.append(text, len(out)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(out["doc"][text]), pa.array(out["tx"][text]), pa.ListArray.from_arrays(pa.array(ends), pa.array(packed))], names=["doc_id", "tx", "spans"])


def _groups(heads: np.ndarray, body: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The stretches of anchors that two documents share, some hundred thousand at a time, whole anchors together."""
    if not len(heads):
        return
    order = np.argsort(heads["g"], kind="stable")
    first, run = _runs(heads["g"][order])
    doc = heads["doc"][order]
    differ = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
    order, run = order[differ[run]], run[differ[run]]
    length = heads["windows"].astype(np.int64) + LENGTH - 1
    starts = np.concatenate([[0], np.cumsum(length)[:-1]])
    at = 0
    while at < len(order):
        end = min(at + most, len(order))
        end = int(np.searchsorted(run, run[end - 1], side="right"))
        own = order[at:end]
        yield heads[own], body[ragged(starts[own], length[own])]
        at = end


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows: list[list] = [[], [], [], [], []]
        for text, lists in zip(text_column(batch).cast(pa.binary()), batch.column("spans").to_pylist(), strict=True):
            raw = text.as_py()
            pieces, at, removed, n = [], 0, 0, 0
            end = -1
            for x in sorted(lists or ()):
                a, b = x >> 32, x & 0xFFFFFFFF
                if a > end:
                    n += 1
                a = max(a, at)
                if b > a:
                    pieces.append(raw[at:a])
                    removed += b - a
                    at = b
                end = max(end, b)
            pieces.append(raw[at:])
            kept = b"".join(pieces)
            for column, value in zip(rows, (len(raw), removed, n, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                column.append(value)
        arrays = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in rows[:3]), pa.array(rows[3], pa.string()), *([pa.array(rows[4], pa.binary())] if with_text else [])]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text])


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Figures of every document; ``with_text`` adds the remaining bytes."""
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text, F.octet_length(text)).alias("tx")).withColumn("key", F.xxhash64("doc_id", "tx"))
    marks = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text, F.octet_length(text)).alias("tx"), F.md5(text.cast("binary")).alias("digest"), F.octet_length(text).cast("long").alias("n")), "marks").where(f"doc_id is not null and n >= {LENGTH}")
    least = staged(marks.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("most > least").select("digest", "least"), "least")
    copies = staged(marks.join(F.broadcast(least) if least.count() <= MOST_BROADCAST else least, "digest").where("doc_id > least").select("doc_id", "tx", "n").distinct(), "copies")
    few = copies.count() <= MOST_BROADCAST
    ids = copies.select("doc_id", "tx")
    reps = texts.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).join(F.broadcast(ids) if few else ids, ["doc_id", "tx"], "left_anti").select("doc_id", "tx", "key", "text")
    total = marks.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    limit = max(HOT, total // ANCHOR_BYTES // MOST_HOT)
    asked = bucketed(reps.mapInArrow(lambda b: _ask(b, buckets), _ASKED), buckets).mapInArrow(lambda b: _answer(b, buckets, limit), _ASKED)
    answers = staged(asked, "answers")
    del asked
    free(spark)
    found = joined_blob(answers.where("bucket = -1").select("shared").toArrow().column("shared"), np.uint64)  # about MOST_HOT at most
    hot = spark.sparkContext.broadcast(np.sort(found))
    shared = bucketed(answers.where("bucket >= 0"), buckets).mapInArrow(_per_text, "key long, gs binary")
    sharing = reps.join(shared, "key").select("doc_id", "tx", "text", "gs")
    # written, so that the shuffles of anchors and of texts go before the stretches' begins; small row groups bound a reader's memory
    stretches = staged(sharing.mapInArrow(lambda b: _stretches(b, buckets, hot.value), _ROW), "stretches", **{"parquet.block.size": str(BLOCK_BYTES)})
    discard(answers)
    del answers, shared, sharing, reps
    free(spark)
    spans = bucketed(stretches, buckets).mapInArrow(lambda b: _resolve(b, buckets), _ROW)
    spans = bucketed(spans, buckets).mapInArrow(_gather, "doc_id long, tx long, spans array<long>")
    spans = staged(spans.unionByName(copies.select("doc_id", "tx", F.array("n").alias("spans"))), "spans")
    for done in (stretches, copies, least, marks):
        discard(done)
    del stretches, copies, ids, least, marks
    free(spark)
    joined = texts.join(spans, ["doc_id", "tx"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(lambda b: _cut(b, with_text), _RESULT + (", kept binary" if with_text else ""))


def op7_suffix_array_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))
