"""Mixing sources to target weights with packed blocks.

The words of a source, document after document by id, are one stream, packed into blocks of fixed
length (64 blocks at least, so that a small source mixes finely too). A source's target becomes a
number of slots. The slots are spread over output shards: a group of shards gets its exact part, and
within it the source counts of one shard after another are a multinomial draw, conditioned on what
the group has left. The i-th slot of a source takes the block at place i of a pseudorandom
permutation of its blocks, then of a second one; slots and blocks meet in a join by block index.

A hot source is many blocks and shards like any other; only one row per source (and per range of
ids) is ever gathered.

Targets: sources in code-point order, null last, weigh 3, 1, 2 and again; together they share 150 %
of all words; a target stops at twice its source's size and the excess is shared by weight.

Defined results: null text has no words and is never taken; a null source is a source; rows are kept
one to one, repeated rows and null ids included (ties in the stream's order are cut by text hash);
an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.operators.ranking import prefix_sum
from tidewatch.session import settle

WORD = r"[^\x20\x09-\x0D]+"
#: Fixed values of the weighting.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
BLOCK_WORDS, LEAST_BLOCKS = 128, 64
SHARD_SLOTS, GROUP_SHARDS = 4096, 64
SEED = 11


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: its number in the order, size and target; all over one row per source."""
    every = W.partitionBy(F.lit(0))
    ranked = sizes.withColumn("number", F.row_number().over(
        every.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.withColumn("weight", F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int")).cast(
        "double")).withColumn("most", MOST * F.col("source_size"))
    # by rising ratio of limit and weight: a source stops if the level of the rest would exceed it
    by_ratio = every.orderBy(F.col("most") / F.col("weight"), "number")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    staged = weighed.withColumns({
        "whole": SHARE * F.sum("source_size").over(every),
        "used": F.coalesce(F.sum("most").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(rest)})
    level = (F.col("whole") - F.col("used")) / F.col("open")
    staged = staged.withColumn("stops", level * F.col("weight") >= F.col("most"))
    free = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(every)
    gone = F.coalesce(F.sum(F.when(F.col("stops"), F.col("most"))).over(every), F.lit(0.0))
    return staged.select("source", "number", "source_size", F.when(
        F.col("stops"), F.col("most")).otherwise(
        (F.col("whole") - gone) / free * F.col("weight")).alias("target"))


def plan(sources: DataFrame) -> DataFrame:
    """Blocks of each source, words in a block, and slots to fill."""
    blocks = F.greatest(F.ceil(F.col("source_size") / BLOCK_WORDS), F.lit(1),
                        F.least(F.col("source_size"), F.lit(LEAST_BLOCKS)))
    planned = sources.withColumn("words", F.greatest(
        F.lit(1), F.ceil(F.col("source_size") / blocks)).cast("long"))
    planned = planned.withColumn("blocks", F.ceil(F.col("source_size") / F.col("words")))
    return planned.withColumn("slots", F.when(F.col("source_size") > 0, F.round(
        F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0).cast("long"))


def draw(quota: np.ndarray, groups: int, group: int, shards: int, seed: int):
    """(shard, source, first slot, number of slots) of one group of output shards."""
    upto = quota * group // groups
    left = quota * (group + 1) // groups - upto
    rng = np.random.default_rng([seed, group])
    for k in range(shards):
        total = int(left.sum())
        n = -(-total // (shards - k))
        counts = rng.multivariate_hypergeometric(left, n) if 0 < n < total else left.copy()
        for s in np.flatnonzero(counts):
            yield group * shards + k, int(s), int(upto[s]), int(counts[s])
        upto, left = upto + counts, left - counts


def permuted(index: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Images of `index` under a pseudorandom permutation of range(size): a Feistel network over
    the next even number of bits, walked until the image is in range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for turn in range(4):
            key = np.uint64((seed * 4 + turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            mixed = (right + key) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while (far := out >= np.uint64(size)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def slots_of(planned: DataFrame, seed: int = SEED) -> DataFrame:
    """(shard, number, slot, pass, block): what fills every slot of every output shard."""
    spark = planned.sparkSession
    # one row per source
    rows = sorted(planned.select("number", "blocks", "slots").collect())
    quota = np.array([r["slots"] for r in rows], dtype=np.int64)
    blocks = np.array([r["blocks"] for r in rows], dtype=np.int64)
    shards = max(1, -(-int(quota.sum()) // SHARD_SLOTS))
    groups = -(-shards // GROUP_SHARDS)
    own = -(-shards // groups)
    shared = spark.sparkContext.broadcast((quota, blocks))

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quota, blocks = shared.value
        for batch in batches:
            for group in batch.column("id").to_pylist():
                for shard, s, first, n in draw(quota, groups, group, own, seed):
                    slot = np.arange(first, first + n)
                    turn, place = slot // blocks[s], slot % blocks[s]
                    block = np.empty(n, dtype=np.int64)
                    for t in np.unique(turn):
                        block[turn == t] = permuted(place[turn == t], int(blocks[s]),
                                                    (seed * 31 + int(s)) * 8 + int(t))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, shard)), pa.array(np.full(n, s, dtype=np.int32)),
                         pa.array(slot), pa.array(turn.astype(np.int32)), pa.array(block)],
                        names=["shard", "number", "slot", "pass", "block"])

    return spark.range(groups).mapInArrow(
        fill, "shard long, number int, slot long, pass int, block long")


def placed_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with their words' place in the stream of the source, and the plan by source."""
    sized = settle(docs.select(
        "doc_id", "source", F.xxhash64("text").alias("tie"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    planned = settle(plan(targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")))))
    placed = prefix_sum(sized, ["doc_id", "tie"], {"upto": F.col("size")}, group=["source"],
                        key=F.col("doc_id"))
    # one row per source
    return placed.join(planned.withColumnRenamed("source", "__s"),
                       F.col("source").eqNullSafe(F.col("__s"))).drop("__s"), planned


def taken_words(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per row: `doc_id`, `tie` (text hash), `size`, `source_size`, `target` and `taken`."""
    placed, planned = placed_documents(docs)
    start = F.col("upto") - F.col("size")
    first, last = F.floor(start / F.col("words")), F.floor((F.col("upto") - 1) / F.col("words"))
    # an empty document keeps its row, with a block that no slot has
    pieces = placed.withColumn("block", F.explode(F.when(
        F.col("size") > 0, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))))
    # Spark can't know how many slots a group row makes, so it is told not to broadcast them
    used = slots_of(planned, seed).groupBy("number", "block").agg(
        F.count("*").alias("times")).hint("merge")
    overlap = F.least("upto", (F.col("block") + 1) * F.col("words")) - F.greatest(
        start, F.col("block") * F.col("words"))
    row = ["doc_id", "tie", "number", "upto", "size", "source_size", "target"]
    return _rows(pieces.join(used, ["number", "block"], "left").groupBy(*row).agg(
        F.sum(overlap * F.coalesce("times", F.lit(0))).alias("taken"), F.sum(
            F.when(F.col("block") < 0, 1).otherwise(0)).alias("__empty")))


def _rows(summed: DataFrame) -> DataFrame:
    """Empty rows of equal place were counted; give each its row back."""
    return summed.withColumn("__k", F.explode(F.sequence(
        F.lit(1), F.greatest(F.col("__empty"), F.lit(1)).cast("int")))).select(
        "doc_id", "tie", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("taken")).otherwise(0).cast("long").alias("taken"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents of the mix with their columns, each as often as it is taken.

    A document that the mix takes for t of its n words comes floor(t / n) times, and once more with
    the chance of the fraction, drawn from its id.
    """
    taken = taken_words(docs, seed).where("taken > 0")
    share = F.col("taken") / F.col("size")
    chance = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "tie"), F.lit(1 << 30)) / float(1 << 30)
    copies = taken.withColumn("copies", (F.floor(share) + (
        chance < share - F.floor(share)).cast("int")).cast("int")).groupBy("doc_id", "tie").agg(
        F.max("copies").alias("__copies")).where("__copies > 0")
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__t"))
    return docs.join(copies.withColumnsRenamed({"doc_id": "__d", "tie": "__t"}), same).withColumn(
        "__k", F.explode(F.sequence(F.lit(1), "__copies"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
