"""Operator 1: K-d tree sharding of documents by metadata, with near-equal bytes (law ``bytes``).

A tree node holding s shards is split along its widest metadata dimension (language, source, size, doc_id; widths
relative to the whole table's) at the distributed weighted quantile floor(s/2)/s of its bytes, until every leaf is one
shard: the leaves reach the target of total bytes / shards. Each dimension is a 51-bit key: the value in 16 bits,
then 35 bits of a hash of the row, so that equal values (one source may hold a third of all rows) split anywhere. The
value of a language or source is its rank among the distinct ones; with more than MOST_VALUES of them, a number made of
its first six bytes. Rows equal in every column are numbered (in their scan partition, after the counts of the partitions
before) and hashed with their number, so a group of copies splits like any other rows.

All of it is DataFrame operations over one written table of keys, without the texts. The tree is a CASE expression of
literals: a level costs one aggregation for the widths and two histogram rounds (BINS a node) that narrow each node's cut
to 2**-32 of its width, where running sums find the cut; the driver sees one row a node. Slots come from counts of hash
buckets, so no shard is one task.

Defined results: size is the UTF-8 bytes plus 16 (null text: 16, crc of the empty text); null metadata counts as the
empty string or 0; equal rows are spread like others and may swap places; fewer rows than shards leave shards empty; an
empty table gives no rows; extra columns are ignored; ``grown_shard`` is null by this law.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.common import documents, staged

SHARDS = 40
OVERHEAD = 16
BINS = 65_536
VALUE_BITS, HASH_BITS = 16, 35
MOST_VALUES = 1 << VALUE_BITS
#: Rows of a slot bucket, about.
BUCKET_ROWS = 65_536
DIMENSIONS = ("v0", "v1", "v2", "v3")


def _metadata(docs: DataFrame) -> DataFrame:
    """The rows without their texts, written."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.spark_partition_id().alias("part"),
    )
    return staged(rows.withColumn("row", F.xxhash64("doc_id", "lang", "source", "text_crc32", "size")), "shard-metadata")


def _hashed(rows: DataFrame) -> DataFrame:
    """The rows with HASH_BITS bits of a hash that differs between repeated rows too."""
    counts = rows.groupBy("row", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("row").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    repeated = counts.select("row", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("row")).alias("total")).where("total > 1")
    own = F.row_number().over(Window.partitionBy("row", "part").orderBy("doc_id")) - 1
    again = rows.join(repeated, ["row", "part"]).withColumn("k", F.col("before") + own).drop("before", "total")
    once = rows.join(repeated.select("row", "part"), ["row", "part"], "left_anti").withColumn("k", F.lit(0).cast("long"))
    return again.unionByName(once).withColumn("h", F.shiftrightunsigned(F.xxhash64("row", "k"), 64 - HASH_BITS))


def _keyed(rows: DataFrame) -> DataFrame:
    """Each dimension as a key: its value scaled to the whole table's range, then the hash."""
    number = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("double"), F.lit(0.0))
    prefix = lambda c: number(F.conv(F.rpad(F.hex(F.substring(F.col(c).cast("binary"), 1, 6)), 12, "0"), 16, 10))
    values = {"v0": prefix("lang"), "v1": prefix("source"), "v2": F.log2(F.col("size").cast("double")), "v3": number("doc_id")}
    sides = [f(c).alias(f"{f.__name__}_{v}") for v, c in values.items() for f in (F.min, F.max)]
    bounds = rows.agg(*sides, F.countDistinct("lang").alias("n_v0"), F.countDistinct("source").alias("n_v1")).first().asDict()
    plain, rows = rows, _hashed(rows)
    for v, name in (("v0", "lang"), ("v1", "source")):
        if bounds[f"n_{v}"] <= MOST_VALUES:
            ranks = plain.select(name).distinct().select(name, F.row_number().over(Window.orderBy(name)).cast("double").alias(v))  # of at most MOST_VALUES rows
            rows, values[v] = rows.join(F.broadcast(ranks), name), F.col(v)
            bounds |= {f"min_{v}": 1.0, f"max_{v}": float(bounds[f"n_{v}"])}

    def key(c: str) -> Column:
        low, high = bounds[f"min_{c}"] or 0.0, bounds[f"max_{c}"] or 0.0
        value = F.floor((values[c] - low) / (high - low) * (2**VALUE_BITS - 1)) if high > low else F.lit(0)
        return (value.cast("long") * 2**HASH_BITS + F.col("h")).alias(c)

    return rows.select("doc_id", "size", "text_crc32", "h", *[key(c) for c in DIMENSIONS])


Tree = dict[int, tuple[int, int]]  # node -> the dimension it is split along and the last key of its left child


def _at(tree: Tree, leaf: Callable[[int], Column], node: int = 1) -> Column:
    """The value of ``leaf`` for the node that a row falls into."""
    if node not in tree:
        return leaf(node)
    dim, cut = tree[node]
    return F.when(F.col(DIMENSIONS[dim]) > cut, _at(tree, leaf, 2 * node + 1)).otherwise(_at(tree, leaf, 2 * node))


def _crossings(keys: DataFrame, tree: Tree, bins: dict[int, tuple[int, int, int]], wanted: dict[int, Column]) -> dict[int, tuple[int, int, int, float]]:
    """For each node, with its (dimension, low, step): the bin where its running bytes reach the wanted ones, the bytes before it, in it, and wanted."""

    def place(node: int) -> Column:
        if node not in bins:
            return F.lit(None).cast("struct<node:int,bin:long>")
        dim, low, step = bins[node]
        return F.struct(F.lit(node).alias("node"), F.floor((F.col(DIMENSIONS[dim]) - low) / step).cast("long").alias("bin"))

    placed = keys.select(_at(tree, place).alias("at"), "size").where("at is not null and at.bin < " + str(BINS) + " and at.bin >= 0")
    sums = placed.groupBy("at.node", "at.bin").agg(F.sum("size").alias("bytes"))
    node = Window.partitionBy("node")
    sums = sums.withColumn("through", F.sum("bytes").over(node.orderBy("bin"))).withColumn("total", F.sum("bytes").over(node))
    goal = F.coalesce(*[F.when(F.col("node") == n, c) for n, c in wanted.items()])
    # The last bin counts where rounding leaves the goal above the total.
    reached = sums.withColumn("goal", goal).where((F.col("through") >= F.col("goal")) | (F.col("through") == F.col("total")))
    found = reached.groupBy("node").agg(F.min(F.struct("bin", (F.col("through") - F.col("bytes")).alias("before"), "bytes", "goal")).alias("x")).select("node", "x.*")
    return {x["node"]: (x["bin"], x["before"], x["bytes"], x["goal"]) for x in found.collect()}  # one row a node


def _cuts(keys: DataFrame, tree: Tree, split: dict[int, tuple[int, int, int, float]]) -> Tree:
    """For each node (dimension, low, high, share): the dimension, and the key up to which the node's bytes come nearest to the share."""
    bins = {n: (dim, low, -(-(high - low + 1) // BINS)) for n, (dim, low, high, _) in split.items()}
    first = _crossings(keys, tree, bins, {n: F.col("total") * split[n][3] for n in split})
    finer, wanted = {}, {}
    for n, (k, before, _, goal) in first.items():
        dim, low, step = bins[n]
        finer[n] = (dim, low + k * step, -(-step // BINS))
        wanted[n] = F.lit(float(goal - before))
    # Rows of other coarse bins lie outside a finer range, which ends where its coarse bin ends or a little later.
    ends = {n: bins[n][1] + (first[n][0] + 1) * bins[n][2] for n in first}
    inside = keys.where(_at(tree, lambda n: F.col(DIMENSIONS[bins[n][0]]) < ends[n] if n in first else F.lit(False)))
    out = {}
    for n, (k, before, size, goal) in _crossings(inside, tree, finer, wanted).items():
        dim, low, step = finer[n]
        nearer = goal - before < before + size - goal
        out[n] = (dim, low + k * step - 1 if nearer else low + (k + 1) * step - 1)
    return out


def kd_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All documents with their shard and slot."""
    keys = staged(_keyed(_metadata(docs)), "shard-keys")
    leaf, tree = {1: (0, shards)}, {}  # node -> its first shard and its number of shards
    while big := [n for n, (_, s) in leaf.items() if s > 1]:
        widths = keys.groupBy(_at(tree, F.lit).alias("node")).agg(*[f(c).alias(f"{f.__name__}_{c}") for c in DIMENSIONS for f in (F.min, F.max)])
        split = {}
        for x in widths.where(F.col("node").isin(big)).collect():  # one row a node
            widest = max(range(len(DIMENSIONS)), key=lambda d: ((x[f"max_{DIMENSIONS[d]}"] - x[f"min_{DIMENSIONS[d]}"]) >> HASH_BITS, -d))
            s = leaf[x["node"]][1]
            split[x["node"]] = (widest, x[f"min_{DIMENSIONS[widest]}"], x[f"max_{DIMENSIONS[widest]}"], (s // 2) / s)
        for n in big:
            first, s = leaf.pop(n)
            leaf |= {2 * n: (first, s // 2), 2 * n + 1: (first + s // 2, s - s // 2)} if n in split else {}
        if split:
            tree |= _cuts(keys, tree, split)
    return _slotted(keys.select("doc_id", "size", "text_crc32", "h", _at(tree, lambda n: F.lit(leaf[n][0] if n in leaf else 0)).alias("shard")))


def _slotted(rows: DataFrame) -> DataFrame:
    """Number each shard's rows by (hash, doc_id): rows are numbered in hash buckets, after the counts of the buckets before."""
    n = rows.count()
    buckets = max(16, -(-n // (SHARDS * BUCKET_ROWS)))
    rows = rows.withColumn("bucket", F.floor(F.col("h") * buckets / 2**HASH_BITS).cast("long"))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    in_order = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("before"))
    own = Window.partitionBy("shard", "bucket").orderBy("h", "doc_id", "size", "text_crc32")
    return (
        rows.withColumn("k", F.row_number().over(own) - 1)
        .join(before, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("k")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )


def op1_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(documents(spark, sf_dir))
