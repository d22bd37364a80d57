"""Operator 5: attention-based multiple-instance quality classifier.

A document is a bag of passages (runs of PASSAGE_WORDS words, the last one shorter). Every passage is encoded as
FEATURES numbers: shares of character kinds, word lengths, repetition inside the passage, and signed counts of hashed
word shapes and letter pairs. Gated attention learns, from document labels only, how much each passage counts:

    a_i = softmax_i( w . (tanh(V h_i) * sigmoid(U h_i)) ),  h_i = tanh(E x_i),  score = sigmoid(c . sum_i a_i h_i + d)

The model is fitted on the driver from a sample of whole labelled documents, crc32(doc_id as text) mod 5 not 0: the first
in a hash order of doc_id, at most SAMPLE of them and as many as have SAMPLE_PASSAGES passages together; both bounds are
parameters. Fitting and scoring use every passage of every text. Labels, language, source and doc_id are never features.

Scoring is one pass over the texts without a shuffle; the model (about 20,000 numbers) travels with the tasks.

Defined results: null and empty texts are one passage of zeros; repeated rows get equal scores; a null doc_id is
scored like any other; contradicting labels of one document are all used; without labels of both kinds every score is
the share of label 1 (0.5 if there are none); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.common import crc_bucket, documents, ship, slices, split_words, staged, text_column

PASSAGE_WORDS = 64
SHAPES, PAIRS = 32, 64
DENSE = 20
FEATURES = DENSE + SHAPES + PAIRS
HIDDEN, GATE = 48, 24
SAMPLE, SAMPLE_PASSAGES = 6000, 120_000
EPOCHS, BATCH, RATE, SEED = 30, 64, 0.004, 7
CUT = 0.3
#: Kinds of bytes: 0 lower, 1 upper, 2 digit, 3 full stop or comma, 4 other ASCII mark, 5 symbol, 6 beyond ASCII.
_KINDS = np.full(256, 6, np.uint8)
for _c in range(128):
    _KINDS[_c] = 0 if chr(_c).islower() else 1 if chr(_c).isupper() else 2 if chr(_c).isdigit() else 3 if chr(_c) in ".," else 5 if chr(_c) in "#*$%&|<>@^~=+_" else 4


def passages(texts: pa.Array, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The features of every passage, and the n+1 offsets of each text's passages; each text has one at least."""
    flat, offsets = split_words(texts, lower=False)
    counts = np.diff(offsets)
    n = np.maximum(1, -(-counts // size))
    bags = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros((int(bags[-1]), FEATURES), np.float32)
    if not len(flat):
        return out, bags
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(flat)) - offsets[doc]
    passage = bags[doc] + place // size
    coded = flat.dictionary_encode()
    word_features, shape, pairs = _words(coded.dictionary)
    at = coded.indices.to_numpy()
    words = np.bincount(passage, minlength=len(out)).astype(np.float32)
    some = np.maximum(words, 1)
    sums = np.stack([np.bincount(passage, weights=f[at], minlength=len(out)) for f in word_features], axis=1)
    chars = np.maximum(sums[:, :7].sum(axis=1), 1)
    out[:, 0:7] = sums[:, :7] / chars[:, None]
    out[:, 7] = chars / some / 10
    out[:, 8:13] = sums[:, 7:12] / some[:, None]
    key = passage.astype(np.int64) * len(coded.dictionary) + at
    out[:, 13] = np.bincount(np.unique(key) // len(coded.dictionary), minlength=len(out)) / some
    again = np.zeros(len(at), bool)
    again[1:] = (at[1:] == at[:-1]) & (passage[1:] == passage[:-1])
    out[:, 14] = np.bincount(passage, weights=again, minlength=len(out)) / some
    later = np.zeros(len(at), bool)
    later[2:] = (at[2:] == at[:-2]) & (passage[2:] == passage[:-2])
    out[:, 15] = np.bincount(passage, weights=later, minlength=len(out)) / some
    out[:, 16] = np.log1p(words) / 5
    out[:, 17] = np.log1p(n.repeat(n)) / 5
    out[:, 18] = words < size
    out[:, 19] = np.sqrt(np.maximum(sums[:, 12] / some - (chars / some) ** 2, 0)) / 10
    out[:, DENSE : DENSE + SHAPES] = np.sqrt(np.bincount(passage * SHAPES + shape[at], minlength=out.shape[0] * SHAPES).reshape(-1, SHAPES) / some[:, None])
    _add_pairs(out, passage, at, pairs, some)
    return out, bags


def _words(dictionary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct word: sums of character kinds and flags, its shape class, and the buckets of its first and last letter pairs."""
    raw = dictionary.cast(pa.binary())
    ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    size = np.diff(ends)
    word = np.repeat(np.arange(len(size)), size)
    kinds = _KINDS[data]
    counts = np.bincount(word * 7 + kinds, minlength=7 * len(size)).reshape(-1, 7)
    chars = counts.sum(axis=1)
    first, last = kinds[ends[:-1]], kinds[ends[1:] - 1]
    upper = (counts[:, 1] > 1) & (counts[:, 0] == 0)
    features = np.stack([*counts.T, first == 1, upper, last == 3, counts[:, 5] > 0, size == 1, chars**2]).astype(np.float64)
    shape = first.astype(np.int64) * 7 + last
    shape = (shape * 2 + upper) * 2654435761 % (1 << 32) % SHAPES
    head = data[ends[:-1]].astype(np.int64) * 256 + data[np.minimum(ends[:-1] + 1, ends[1:] - 1)]
    tail = data[np.maximum(ends[1:] - 2, ends[:-1])].astype(np.int64) * 256 + data[ends[1:] - 1]
    pairs = np.stack([head * 2654435761 % (1 << 32) >> 20, (tail + 65536) * 2654435761 % (1 << 32) >> 20], axis=1) % PAIRS
    return features, shape, pairs


def _add_pairs(out: np.ndarray, passage: np.ndarray, at: np.ndarray, pairs: np.ndarray, some: np.ndarray) -> None:
    total = sum(np.bincount(passage * PAIRS + pairs[:, k][at], minlength=out.shape[0] * PAIRS) for k in range(2))
    out[:, DENSE + SHAPES :] = np.sqrt(total.reshape(-1, PAIRS) / some[:, None])


@dataclass
class Mil:
    """The fitted network; ``prior`` replaces it where there was nothing to learn."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] | None
    prior: float = 0.5

    def score(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """The score of each bag."""
        if self.weights is None:
            return np.full(len(bags) - 1, self.prior)
        return _forward(self.weights, (x - self.mean) / self.scale, bags)["p"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["E"] + w["e"])
    t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    logit = (t * s) @ w["w"]
    starts = bags[:-1]
    bag = np.repeat(np.arange(len(starts)), np.diff(bags))
    a = np.exp(logit - np.maximum.reduceat(logit, starts)[bag])
    a /= np.add.reduceat(a, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": p, "bag": bag}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, bags)
    h, t, s, a, bag = (f[k] for k in ("h", "t", "s", "a", "bag"))
    dl = (f["p"] - y) / len(y)
    dz = dl[:, None] * w["c"]
    inner = (h * dz[bag]).sum(axis=1)
    dlogit = a * (inner - np.add.reduceat(a * inner, bags[:-1])[bag])
    dt, ds = dlogit[:, None] * w["w"] * s * (1 - t**2), dlogit[:, None] * w["w"] * t * s * (1 - s)
    dh = (a[:, None] * dz[bag] + dt @ w["V"].T + ds @ w["U"].T) * (1 - h**2)
    return {"E": x.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ dlogit, "c": f["z"].T @ dl, "d": np.array(dl.sum())}


def fit(x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Mil:
    """Fit by Adam on batches of whole bags."""
    mean, scale = x.mean(axis=0) if len(x) else np.zeros(FEATURES), (x.std(axis=0) if len(x) else np.ones(FEATURES)) + 0.05
    if not len(y) or y.min() == y.max():
        return Mil(mean, scale, None, float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    x = ((x - mean) / scale).astype(np.float32)
    w = {"E": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "e": np.zeros(HIDDEN), "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "w": rng.normal(0, GATE**-0.5, GATE), "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.array(np.log(y.mean() / (1 - y.mean())))}
    m, v, step = {k: np.zeros_like(p) for k, p in w.items()}, {k: np.zeros_like(p) for k, p in w.items()}, 0
    sizes = np.diff(bags)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for a in range(0, len(order), BATCH):
            chosen = np.sort(order[a : a + BATCH])
            rows = np.concatenate([np.arange(bags[k], bags[k + 1]) for k in chosen])
            step += 1
            for k, g in _gradients(w, x[rows], np.concatenate([[0], np.cumsum(sizes[chosen])]), y[chosen]).items():
                g = g + (1e-4 * w[k] if k != "d" else 0)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g**2
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Mil(mean.astype(np.float32), scale.astype(np.float32), {k: p.astype(np.float32) for k, p in w.items()})


def _encode_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        x, bags = passages(text_column(batch))
        rows = [x[a:b].astype(np.float32).tobytes() for a, b in zip(bags[:-1], bags[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary()), pa.array(np.diff(bags), pa.int64())], names=["doc_id", "quality", "x", "n"])


def fit_from_tables(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = SAMPLE_PASSAGES) -> Mil:
    """Fit on at most ``sample`` labelled documents outside the held-out fifth."""
    ship(docs.sparkSession)
    # A top-k of a hash order: each task keeps `sample` rows at most.
    chosen = labels.where((crc_bucket("doc_id", 5) != 0) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = staged(texts.join(F.broadcast(chosen), "doc_id").mapInArrow(_encode_sample, "doc_id long, quality int, x binary, n long"), "sample")
    place = F.struct(F.xxhash64("doc_id"), "doc_id", "quality", F.xxhash64("x"))
    # Whole rows in hash order while their passages fit; many rows may share one labelled doc_id.
    first = encoded.select(place.alias("place"), "n").orderBy("place").limit(sample)
    ahead = first.withColumn("upto", F.sum("n").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))  # of at most `sample` rows
    last = ahead.where(F.col("upto") <= most).agg(F.max("place").alias("last")).first()["last"]
    if last is not None:
        encoded = encoded.where(place <= F.struct(*[F.lit(v).cast(t) for v, t in zip(last, ("long", "long", "int", "long"), strict=True)]))
    rows = encoded.select("doc_id", "quality", "x").limit(sample).toArrow() if last is not None else encoded.select("doc_id", "quality", "x").limit(0).toArrow()
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in rows.column("x").to_pylist()]
    order = sorted(range(len(bags)), key=lambda k: (rows.column("doc_id")[k].as_py(), rows.column("quality")[k].as_py(), bags[k].tobytes()))
    bags = [bags[k] for k in order]
    y = rows.column("quality").to_numpy()[order].astype(np.float64) if order else np.empty(0)
    return fit(np.concatenate(bags) if bags else np.empty((0, FEATURES), np.float32), np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64), y)


def _score(batches: Iterator[pa.RecordBatch], model: Mil) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=1 << 21):
        p = model.score(*passages(text_column(batch))).astype(np.float64)
        rest = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(p)], names=[*(n for n in batch.schema.names if n != "text"), "score"])


def score_documents(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit_from_tables(docs, labels))
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = columns.mapInArrow(lambda b: _score(b, model.value), "doc_id long, score double")
    return scored.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows that the classifier accepts, all columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit_from_tables(docs, labels))
    names = docs.columns

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 21):
            good = model.value.score(*passages(text_column(batch))) >= cut
            yield pa.RecordBatch.from_arrays([pc.filter(c, pa.array(good)) for c in batch.columns], names=names)

    return docs.mapInArrow(edit, docs.schema)


def op5_attention_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
