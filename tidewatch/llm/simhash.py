"""SimHash near-duplicates, searched with BK-trees.

A fingerprint has bit b if more than half of the XXH64 hashes (seed 42) of a text's three-word
shingles have it. Documents whose fingerprints differ in at most three bits are linked, and
components of links are classes.

Search works on distinct fingerprints. Two that differ in at most three of 64 bits agree in at least
two of five bands of 13 or 12 bits, so each of the ten pairs of bands is a key, and fingerprints of
equal key form a shard. A shard is a BK-tree - children keyed by their distance to the parent - and
only edges within the radius are followed; a subtree that already belongs to the class of the
fingerprint searched for is skipped. A shard returns a spanning forest, never all its pairs, which
loses no class. Shards meet their queries by a shuffle: a driver-made broadcast of all trees would
grow with the corpus.

Defined results: words are split at ASCII white space and only A-Z are lower-cased; with one or two
words the whole sequence is the shingle; null and empty texts have fingerprint zero and are linked
like any other; repeated rows and null ids are kept, a class of null ids alone has a null component;
an empty table gives no rows. Columns other than `doc_id` and `text` play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.components import components
from tidewatch.session import settle

RADIUS = 3
SEED = 42
WIDTH = 3
#: First bit and number of bits of five bands that cover 64 bits.
BANDS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
CHUNK_SHINGLES = 200_000


def shingle_hashes(data: bytes) -> list[int]:
    words = data.lower().split()
    if len(words) < WIDTH:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    begin = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(
        begin[:1 - WIDTH].tolist(), ends[WIDTH - 1:].tolist(), strict=True)]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes; a run of none gives zero."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        first = (np.cumsum(sizes) - sizes)[full]
        sums = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        set_bits = (2 * sums > sizes[full, None]).astype(np.uint8)
        out[full] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        done, sizes, hashes, size = [], [], [], 0
        for data in texts:
            own = shingle_hashes(data or b"")
            hashes.append(np.array(own, dtype=np.uint64))
            sizes.append(len(own))
            size += len(own)
            if size > CHUNK_SHINGLES:
                done.append(majority(np.concatenate(hashes), np.array(sizes)))
                sizes, hashes, size = [], [], 0
        if sizes:
            done.append(majority(np.concatenate(hashes), np.array(sizes)))
        values = np.concatenate(done) if done else np.array([], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(values.view(np.int64))],
            names=[*batch.schema.names[:-1], "fp"])


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, and `fp`, the fingerprint as a signed 64-bit integer."""
    kept = [f for f in docs.schema.fields if f.name not in (text, "fp")]
    return docs.select(*[f"`{f.name}`" for f in kept],
                       F.col(text).cast("binary").alias("__text")).mapInArrow(
        fingerprints, T.StructType([*kept, T.StructField("fp", T.LongType())]))


class BKTree:
    """A shard's fingerprints, with the classes found so far."""

    def __init__(self):
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []   # union-find over nodes
        self.above: list[int] = []    # tree edges
        self.whole: list[int] = []    # a node of the class that owns the whole subtree, or -1
        self.refreshed = 0

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def refresh(self) -> None:
        """Find out anew which subtrees lie in one class; children come after their parents."""
        for i in range(len(self.value) - 1, -1, -1):
            root = self.find(i)
            self.whole[i] = root if all(
                self.whole[c] >= 0 and self.find(self.whole[c]) == root
                for c in self.children[i].values()) else -1
        self.refreshed = len(self.value)

    def add(self, value: int) -> None:
        """Link a fingerprint with all classes in the radius, then hang it into the tree."""
        new = len(self.value)
        self.value.append(value)
        self.children.append({})
        self.parent.append(new)
        self.above.append(-1)
        self.whole.append(new)
        if not new:
            return
        stack = [0]
        while stack:
            at = stack.pop()
            if self.whole[at] >= 0 and self.find(self.whole[at]) == self.find(new):
                continue
            d = (value ^ self.value[at]).bit_count()
            if d <= RADIUS:
                a, b = self.find(at), self.find(new)
                self.parent[max(a, b)] = min(a, b)
            own = self.children[at]
            if len(own) <= 2 * RADIUS:
                stack.extend(c for k, c in own.items() if -RADIUS <= k - d <= RADIUS)
            else:
                stack.extend(own[k] for k in range(d - RADIUS, d + RADIUS + 1) if k in own)
        at, root = 0, self.find(new)
        while True:
            if self.whole[at] >= 0 and self.find(self.whole[at]) != root:
                self.whole[at] = -1
            d = (value ^ self.value[at]).bit_count()
            if d not in self.children[at]:
                self.children[at][d] = new
                self.above[new] = at
                break
            at = self.children[at][d]
        if len(self.value) > 1.3 * self.refreshed + 16:
            self.refresh()

    def forest(self) -> list[tuple[int, int]]:
        return [(self.value[r], self.value[i]) for i in range(len(self.value))
                if (r := self.find(i)) != i]


def shard_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of consecutive rows of equal key; rows come sorted by key."""
    key, members = None, []

    def close() -> list[tuple[int, int]]:
        if len(members) < 2:
            return []
        tree = BKTree()
        for value in members:
            tree.add(value)
        return tree.forest()

    for batch in batches:
        keys, values = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
        if not len(keys):
            continue
        cuts = np.flatnonzero(np.diff(keys)) + 1
        begin, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
        found = []
        # runs of one row inside a batch have no partner
        inner = (end - begin > 1) | (begin == 0) | (end == len(keys))
        for a, b in zip(begin[inner].tolist(), end[inner].tolist(), strict=True):
            if keys[a] != key:
                found += close()
                key, members = keys[a], []
            members += (values[a:b].view(np.uint64)).tolist()
        yield _links(found)
    yield _links(close())


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                      names=["src", "dst"])


def links(distinct: DataFrame) -> DataFrame:
    """(src, dst): links that connect all of `fp` within the radius, as spanning forests."""
    def band(k: int):
        first, bits = BANDS[k]
        return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1))

    # the pair of bands in the top bits, then the values of the two
    keys = F.array(*[
        F.lit(n << 32) + F.shiftleft(band(a), 13) + band(b)
        for n, (a, b) in enumerate(combinations(range(len(BANDS)), 2))])
    rows = distinct.select(F.explode(keys).alias("key"), "fp")
    return rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
        shard_links, "src long, dst long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id`, `fingerprint` and `component_id` for every row."""
    printed = settle(with_fingerprint(docs.select("doc_id", "text")))
    return classes_of(printed).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def classes_of(printed: DataFrame) -> DataFrame:
    """Add to rows with `fp` the class `c`, named by one of its fingerprints, and `component_id`, the
    smallest `doc_id` of the class. Classes without an id, or that share one, differ by `c` only."""
    distinct = settle(printed.groupBy("fp").agg(F.min("doc_id").alias("first")))
    joined = distinct.join(components(links(distinct.select("fp"))), F.col("fp") == F.col("node"),
                           "left").select("fp", "first", F.coalesce("component", "fp").alias("c"))
    lowest = joined.groupBy("c").agg(F.min("first").alias("component_id"))
    by_print = joined.join(lowest, "c").select(F.col("fp").alias("__fp"), "c", "component_id")
    return printed.join(by_print, F.col("fp") == F.col("__fp")).drop("__fp")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class, with its columns: the one with the smallest id, null ids last.

    A class is what its links make it; ids choose its row, so classes may share an id or have none.
    Classes are found on ids, text hashes and fingerprints alone; texts are read again at the end.
    """
    key = {"__i": F.coalesce("doc_id", F.lit(0)), "__n": F.col("doc_id").isNull(),
           "__h": F.xxhash64("text")}
    printed = settle(with_fingerprint(docs.select(
        "doc_id", "text", *[c.alias(k) for k, c in key.items()])))
    chosen = classes_of(printed).groupBy("c").agg(
        F.min(F.struct("__n", "__i", "__h")).alias("k")).select("k.*")
    # the join leaves equal keys together, so repeated rows fall without another shuffle
    return docs.withColumns(key).join(chosen, list(key), "left_semi").dropDuplicates(
        list(key)).select(*docs.columns)
