"""Operator 6: quality rules and an n-gram perplexity filter with language-specific bands.

The model is a modified Kneser-Ney model of bytes (order 5) for each language: no folding, so any script and any mark
counts as itself, and an n-gram is a number of 40 bits whose contexts and suffixes are shifts and masks of it. Spark
counts the n-grams of every text (each task adds up its own first), and each order is a table: continuation counts by
suffix, discounts from the counts of counts, totals and back-off weights by context, interpolation by a join on the
suffix. The model lives in sorted hash arrays, one for each order: 64-bit hashes of (language, n-gram) with the log10
probability or back-off weight beside them, searched by halving. A model of at most MOST_BROADCAST entries travels to the
workers as such arrays; a larger one stays a table and the texts' distinct n-grams are joined to it.

A document has two perplexities, 10 ** (-log10 probability / words) and the same by bytes. Each language has a lower and
an upper band for both, from the histograms of all its documents: the quartiles, widened by BAND times their distance.
Single documents stray more the shorter they are, so that width grows with sqrt(1 + PRIOR_WORDS / words). A language's
quartiles are averaged with those of all documents, which weigh as much as PRIOR_DOCS documents, so small languages lean
on the pool by degrees. A document outside a band is rejected; so is one whose base rules fail.

Defined results: null and empty texts have no words, no perplexity, and fail the base rule; a null language is a language
of its own; a text's start counts as zero bytes; repeated rows count as often as they occur; a null doc_id stays null; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.common import documents, hash_values, mix, ship, slices, split_words, staged, text_column

ORDER = 5
#: The rules' limits.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, (20, 100), 5
SYMBOLS = "[#*$%&|<>]"
BIN = 0.002
BAND, PRIOR_WORDS, PRIOR_DOCS = 1.75, 50, 20
#: Entries of a model that is broadcast: about 12 bytes each.
MOST_BROADCAST = 4_000_000
#: Languages whose discounts are broadcast, so that a language's n-grams need not meet.
MOST_LANGUAGES = 100_000
#: Distinct n-grams that a task holds before it passes them on.
FLUSH = 1_000_000
_MASK = [(1 << 8 * k) - 1 for k in range(ORDER + 1)]
_LANG = "coalesce(concat(':', lang), '') AS l"  # null is '', any other value begins with a colon


def grams_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of ORDER bytes that ends at each byte, and the n+1 offsets of each text's."""
    raw = texts.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8)[ends[0] : ends[-1]] if raw.buffers()[2] else np.empty(0, np.uint8)
    offsets = ends - ends[0]
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = data.astype(np.int64)
    for k in range(1, ORDER):
        out[k:] |= np.where(place[k:] >= k, data[:-k], 0).astype(np.int64) << 8 * k if len(data) > k else 0
    return out, offsets


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    coded = batch.column("l").dictionary_encode()
    of = coded.indices.to_numpy()
    for k, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, np.flatnonzero(of == k)


def _rows(lang: str, codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(codes), 100_000):
        own = codes[a : a + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(n[a : a + 100_000])], names=["l", "code", "n"])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(codes)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in slices(batches):
        texts = text_column(batch)
        for lang, own in _by_language(batch):
            codes, n = np.unique(grams_of(texts.take(pa.array(own)))[0], return_counts=True)
            parts = held.setdefault(lang, [])
            parts.append((codes, n))
            while len(parts) > 1 and len(parts[-2][0]) < 2 * len(parts[-1][0]):  # merged sizes at least halve along the list
                parts.append(_merged([parts.pop(), parts.pop()]))
        if sum(len(p[0]) for parts in held.values() for p in parts) > FLUSH:
            for lang, parts in held.items():
                yield from _rows(lang, *_merged(parts))
            held = {}
    for lang, parts in held.items():
        yield from _rows(lang, *_merged(parts))


def _discounted(level: DataFrame, few_languages: bool) -> DataFrame:
    """Each n-gram with its modified Kneser-Ney discount, from its language's counts of counts."""
    t = [F.sum((F.col("n") == k).cast("double")).alias(f"t{k}") for k in (1, 2, 3, 4)]
    some = F.least("t1", "t2", "t3", "t4") > 0
    y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))
    cut = [F.when(some, F.least(F.greatest(k - (k + 1) * y * F.try_divide(F.col(f"t{k + 1}"), F.col(f"t{k}")), F.lit(0.05)), F.lit(k - 0.05))).otherwise(flat).alias(f"d{k}") for k, flat in ((1, 0.5), (2, 0.75), (3, 0.9))]
    by_language = level.groupBy("l").agg(*t).select("l", *cut)
    return level.join(F.broadcast(by_language) if few_languages else by_language, "l").withColumn("d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))


def fit_model(docs: DataFrame) -> DataFrame:
    """The model as rows (l, slot, code, value): log10 probabilities of orders 1 to ORDER, then log10 back-off weights of contexts of 0 to ORDER - 1 bytes."""
    ship(docs.sparkSession)
    columns = docs.select(F.col("text").cast("string").alias("text"), F.expr(_LANG))
    levels = {ORDER: staged(columns.mapInArrow(_count, "l string, code long, n long").groupBy("l", "code").agg(F.sum("n").alias("n")), "grams")}
    for order in range(ORDER - 1, 0, -1):  # continuation counts: the distinct bytes before an n-gram
        levels[order] = staged(levels[order + 1].groupBy("l", F.col("code").bitwiseAND(_MASK[order]).alias("code")).agg(F.count("*").alias("n")), "grams")
    below, model, few = None, None, levels[1].select("l").distinct().count() <= MOST_LANGUAGES
    for order in range(1, ORDER + 1):
        context = Window.partitionBy("l", "context")
        rows = _discounted(levels[order], few).withColumn("context", F.shiftright("code", 8))
        rows = rows.withColumn("total", F.sum("n").over(context)).withColumn("weight", F.sum("d").over(context) / F.col("total")).withColumn("first", F.min("code").over(context) == F.col("code"))
        rows = rows.withColumn("suffix", F.col("code").bitwiseAND(_MASK[order - 1]))
        lower = F.lit(1 / 256)
        if below is not None:
            rows, lower = rows.join(below.select("l", F.col("code").alias("suffix"), F.col("p").alias("lower")), ["l", "suffix"]), F.col("lower")
        below = staged(rows.select("l", "code", "context", "weight", "first", ((F.col("n") - F.col("d")) / F.col("total") + F.col("weight") * lower).alias("p")), "level")
        probabilities = below.select("l", F.lit(order - 1).alias("slot"), "code", F.log10("p").cast("float").alias("value"))
        weights = below.where("first").select("l", F.lit(ORDER + order - 1).alias("slot"), F.col("context").alias("code"), F.log10("weight").cast("float").alias("value"))
        both = probabilities.unionByName(weights)
        model = both if model is None else model.unionByName(both)
    return model


class Model:
    """Sorted hash arrays of each slot: hashes and log10 values."""

    def __init__(self, rows: pa.Table):
        slot, code, value = (rows.column(c).to_numpy() for c in ("slot", "code", "value"))
        langs = rows.column("l").combine_chunks().dictionary_encode()
        known = langs.dictionary.to_pylist()
        self.langs = dict(zip(known, hash_values(pa.array(known, pa.string())) if known else [], strict=True))
        of = np.array(list(self.langs.values()), np.uint64)[langs.indices.to_numpy()] if len(langs) else np.empty(0, np.uint64)
        self.arrays = []
        for k in range(2 * ORDER):
            own = np.flatnonzero(slot == k)
            keys = mix(code[own].astype(np.uint64) ^ of[own])
            order = np.argsort(keys)
            self.arrays.append((keys[order], value[own][order].astype(np.float32)))

    def find(self, slot: int, lang: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the codes (0 where there is none), and which were there."""
        have, values = self.arrays[slot]
        if not len(have) or lang not in self.langs:
            return np.zeros(len(codes), np.float32), np.zeros(len(codes), bool)
        keys = mix(codes.astype(np.uint64) ^ self.langs[lang])
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        hit = have[at] == keys
        return np.where(hit, values[at], np.float32(0)), hit

    def log10(self, lang: str, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each n-gram's last byte after the others."""
        out, left, backoff = np.zeros(len(codes)), np.arange(len(codes)), np.zeros(len(codes))
        for order in range(ORDER, 0, -1):
            suffix = codes[left] & _MASK[order]
            value, hit = self.find(order - 1, lang, suffix)
            out[left[hit]] = value[hit] + backoff[left[hit]]
            left, suffix = left[~hit], suffix[~hit]
            backoff[left] += self.find(ORDER + order - 1, lang, suffix >> 8)[0]
        out[left] = backoff[left] - np.log10(256)
        return out


# --- base rules --------------------------------------------------------------


def base_rules(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    flat, offsets = split_words(texts, lower=False)
    chars = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64) if len(flat) else np.empty(0, np.int64)
    total = np.concatenate([[0], np.cumsum(chars)])
    coded = flat.dictionary_encode() if len(flat) else None
    ids = coded.indices.to_numpy().astype(np.int64) if coded is not None else np.empty(0, np.int64)
    symbols = pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64)
    return {"n_words": np.diff(offsets), "word_chars": total[offsets[1:]] - total[offsets[:-1]], "n_symbols": symbols, "n_dup_lines": _dup_lines(texts), "n_repeat_words": _repeat_words(ids, offsets, len(coded.dictionary) if coded is not None else 1)}


def _dup_lines(texts: pa.Array) -> np.ndarray:
    lines = pc.split_pattern(texts, "\n")
    flat, doc = lines.flatten(), pc.list_parent_indices(lines).to_numpy().astype(np.int64)
    some = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    key = doc[some] * max(1, len(coded.dictionary)) + coded.indices.to_numpy()[some]
    distinct = np.unique(key) // max(1, len(coded.dictionary))
    return np.bincount(doc[some], minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def _repeat_words(ids: np.ndarray, offsets: np.ndarray, n_ids: int) -> np.ndarray:
    """Words inside windows of WINDOW words that occur twice or more in their text."""
    out = np.zeros(len(offsets) - 1, np.int64)
    if len(ids) < WINDOW:
        return out
    doc = np.repeat(np.arange(len(out)), np.diff(offsets))
    m = len(ids) - WINDOW + 1
    whole = doc[:m] == doc[WINDOW - 1 :]
    key = mix(doc[:m].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for j in range(WINDOW):  # exact enough to find candidates; equal windows always agree
        key = mix(key + ids[j : m + j].astype(np.uint64))
    key = key[whole]
    at = np.flatnonzero(whole)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covered, at[twice], 1)
    np.add.at(covered, at[twice] + WINDOW, -1)
    words = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return words[offsets[1:]] - words[offsets[:-1]]


# --- scores and verdicts -----------------------------------------------------

_FIGURES = "doc_id long, l string, key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_bytes long"


def _figures(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    """The base rules' figures, and with a model the log10 probability of each text."""
    for batch in slices(batches):
        texts = text_column(batch)
        rules = base_rules(texts)
        columns = [batch.column("doc_id"), batch.column("l"), batch.column("key"), *(pa.array(v, pa.int64()) for v in rules.values()), pc.binary_length(texts).cast(pa.int64())]
        names = ["doc_id", "l", "key", *rules, "n_bytes"]
        if model:
            total = np.zeros(len(texts))
            for lang, own in _by_language(batch):
                codes, offsets = grams_of(texts.take(pa.array(own)))
                distinct, at = np.unique(codes, return_inverse=True)
                sums = np.concatenate([[0.0], np.cumsum(model.log10(lang, distinct)[at])])
                total[own] = sums[offsets[1:]] - sums[offsets[:-1]]
            columns.append(pa.array(total))
            names.append("log10_p")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each text with their counts."""
    for batch in slices(batches):
        codes, offsets = grams_of(text_column(batch))
        doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        order = np.lexsort((codes, doc))
        doc, codes = doc[order], codes[order]
        head = np.ones(len(codes), bool)
        head[1:] = (doc[1:] != doc[:-1]) | (codes[1:] != codes[:-1])
        first = np.flatnonzero(head)
        at = pa.array(doc[first])
        yield pa.RecordBatch.from_arrays([batch.column("key").take(at), batch.column("l").take(at), pa.array(codes[first]), pa.array(np.diff(np.append(first, len(codes))))], names=["key", "l", "code", "n"])


def _joined(columns: DataFrame, model: DataFrame) -> DataFrame:
    """The figures and log10 probabilities by joins with a model too large to broadcast; equal texts are scored once."""
    grams = staged(columns.mapInArrow(_grams, "key long, l string, code long, n long").groupBy("key", "l", "code").agg(F.max("n").alias("n")), "text-grams")
    asked = grams.select("l", "code").distinct()
    value = F.lit(float(-np.log10(256)))
    for order in range(1, ORDER + 1):
        suffix = F.col("code").bitwiseAND(_MASK[order])
        asked = asked.withColumn("s", suffix).join(model.where(F.col("slot") == order - 1).select("l", F.col("code").alias("s"), F.col("value").cast("double").alias(f"p{order}")), ["l", "s"], "left").drop("s")
        asked = asked.withColumn("s", F.shiftright(suffix, 8)).join(model.where(F.col("slot") == ORDER + order - 1).select("l", F.col("code").alias("s"), F.col("value").cast("double").alias(f"w{order}")), ["l", "s"], "left").drop("s")
        value = F.coalesce(F.col(f"p{order}"), F.coalesce(F.col(f"w{order}"), F.lit(0.0)) + value)
    asked = asked.select("l", "code", value.alias("value"))
    sums = grams.join(asked, ["l", "code"]).groupBy("key").agg(F.sum(F.col("n") * F.col("value")).alias("log10_p"))
    return columns.mapInArrow(lambda b: _figures(b, None), _FIGURES).join(sums, "key", "left").withColumn("log10_p", F.coalesce("log10_p", F.lit(0.0)))


def _quartiles(bins: DataFrame, by: list[str]) -> DataFrame:
    """The quartiles and the number of documents of each group, from a histogram (bin, k) of a few thousand bins a group."""
    bins = bins.groupBy(*by, "bin").agg(F.sum("k").alias("k"))
    group = Window.partitionBy(*by)
    bins = bins.withColumn("through", F.sum("k").over(group.orderBy("bin"))).withColumn("n", F.sum("k").over(group))
    at = lambda share: F.min(F.when(F.col("through") >= share * F.col("n"), (F.col("bin") + 0.5) * BIN))
    return bins.groupBy(*by).agg(at(0.25).alias("q1"), at(0.75).alias("q3"), F.max("n").alias("n"))


def bands(scored: DataFrame) -> DataFrame:
    """One row a language: the quartiles of both perplexities (log10), leaning on those of all documents."""
    both = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.floor(F.col(x) / BIN).alias("bin")) for x in ("by_word", "by_byte")])).alias("v")
    # Written, so that the tasks' partial counts are summed by bin before a language's bins meet.
    bins = staged(scored.select("l", both).groupBy("l", "v.x", "v.bin").agg(F.count("*").alias("k")), "histogram")
    pool = _quartiles(bins, ["x"]).select("x", F.col("q1").alias("all1"), F.col("q3").alias("all3"))
    lean = lambda q, pooled: (F.col("n") * F.col(q) + PRIOR_DOCS * F.col(pooled)) / (F.col("n") + PRIOR_DOCS)
    own = _quartiles(bins, ["l", "x"]).join(F.broadcast(pool), "x").select("l", "x", lean("q1", "all1").alias("q1"), lean("q3", "all3").alias("q3"))
    pick = lambda x, q: F.max(F.when(F.col("x") == x, F.col(q))).alias(f"{x}_{q}")
    return own.groupBy("l").agg(*[pick(x, q) for x in ("by_word", "by_byte") for q in ("q1", "q3")])


def apply_rules(docs: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The rules' figures, the perplexities and the verdict of every document."""
    spark = docs.sparkSession
    model = fit_model(docs)
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.expr(_LANG))
    columns = columns.withColumn("key", F.xxhash64(F.coalesce("text", F.lit("")), "l"))
    if model.count() <= most_broadcast:
        arrays = spark.sparkContext.broadcast(Model(model.toArrow()))
        scored = columns.mapInArrow(lambda b: _figures(b, arrays.value), _FIGURES + ", log10_p double")
    else:
        scored = _joined(columns, model)
    some = F.col("n_words") > 0
    scored = staged(scored.withColumn("by_word", F.try_divide(-F.col("log10_p"), F.col("n_words"))).withColumn("by_byte", F.when(some, F.try_divide(-F.col("log10_p"), F.col("n_bytes")))), "rules")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * MOST_REPEATED[1] > F.col("n_words") * MOST_REPEATED[0])
    inside = F.lit(True)
    for x in ("by_word", "by_byte"):
        low, high = F.col(f"{x}_q1"), F.col(f"{x}_q3")
        width = BAND * F.greatest(high - low, F.lit(BIN)) * F.sqrt(1 + PRIOR_WORDS / F.greatest("n_words", F.lit(1)))
        inside = inside & F.coalesce(F.col(x).between(low - width, high + width), F.lit(True))
    return (
        scored.join(bands(scored.where(some)), "l", "left")
        .withColumn("base_failed", failed)
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"), F.pow(F.lit(10.0), "by_word").alias("perplexity"), F.pow(F.lit(10.0), "by_byte").alias("byte_perplexity"))
    )


def op6_kneser_ney_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(documents(spark, sf_dir))
