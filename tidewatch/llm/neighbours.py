"""Approximate nearest neighbours by cosine: stable projections, kd-trees and a chi-square stop.

Unit vectors are projected to a few dimensions by a matrix of normal (2-stable) entries, so the
squared projected length of a difference over its squared length follows a chi-square law. A search
takes projected neighbours in rising distance and verifies them on the original vectors; it stops
when the law says that a vector as near as the k-th found would, with probability `CERTAINTY`, have
been met already.

The upper kd-tree is fitted on a bounded sample and cuts the projected space into cells; every row
is indexed. Cells are split by id hash into shards of bounded size, each with a kd-tree of its own.
A query first searches its home cell; the distance found decides, with the same test, which other
cells it visits. Queries stream past a shard's tree in Arrow batches, so neither queries nor rows
are gathered.

Defined results: rows with a null id, null, zero or non-finite vectors or of another dimension than
most take no part; of equal vectors the smallest ids are kept, as many as a result can show, so
copies cannot fill a shard; fewer candidates than k give fewer rows; ties go to the smaller id; an
empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.session import settle

DIMENSIONS = 8
CERTAINTY = 0.97
#: Bound of the sample that the upper tree is fitted on, its cells, rows of a shard and of a leaf.
SAMPLE, CELLS, SHARD_ROWS, LEAF_ROWS = 4096, 64, 8192, 128
SEED = 5
ROW = "id long, vector array<float>, place array<double>, cell int"
FOUND = "query_id long, vec_id long, score double"


def chi_square(x: np.ndarray) -> np.ndarray:
    """Distribution function for `DIMENSIONS` (even) degrees of freedom."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, DIMENSIONS // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


@cache
def reach() -> float:
    """The chi-square value at which the search stops: the quantile of `CERTAINTY`."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle) < CERTAINTY else (low, middle)
    return high


def unmet(squared: np.ndarray, bound: float | np.ndarray) -> np.ndarray:
    """Where a vector within the bound may still lie at this squared projected distance."""
    return squared < reach() * np.maximum(bound, 1e-12)


def matrix(lists: pa.Array, kind=np.float64) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(lists), -1)


def project(vectors: np.ndarray) -> np.ndarray:
    normal = np.random.default_rng(SEED).normal(size=(vectors.shape[1], DIMENSIONS))
    return (vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]) @ normal


def halves(points: np.ndarray, rows: np.ndarray, leaf: int) -> Iterator[tuple]:
    """Median cuts along the widest dimension: ('cut', dimension, value) or ('leaf', rows), in the
    order of a walk through the tree."""
    if len(rows) <= leaf:
        yield "leaf", rows
        return
    own = points[rows]
    axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
    order = np.argsort(own[:, axis], kind="stable")
    middle = len(rows) // 2
    yield "cut", axis, float(own[order[middle], axis])
    yield from halves(points, rows[order[:middle]], leaf)
    yield from halves(points, rows[order[middle:]], leaf)


def cells_of(points: np.ndarray, walk: list[tuple]) -> np.ndarray:
    """Cell of each point: descend the cuts of the upper tree."""
    out = np.zeros(len(points), dtype=np.int32)
    steps = iter(walk)
    leaves = iter(range(len(walk)))

    def descend(rows: np.ndarray) -> None:
        step = next(steps)
        if step[0] == "leaf":
            out[rows] = next(leaves)
            return
        low = points[rows, step[1]] < step[2]
        descend(rows[low])
        descend(rows[~low])

    descend(np.arange(len(points)))
    return out


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of points to boxes: (points, boxes)."""
    gap = np.maximum(0, np.maximum(low - point[:, None], point[:, None] - high))
    return (gap * gap).sum(axis=2)


@dataclass
class Shard:
    ids: np.ndarray
    vectors: np.ndarray
    places: np.ndarray

    def __post_init__(self):
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.leaves = [step[1] for step in halves(self.places, np.arange(len(self.ids)), LEAF_ROWS)
                       if step[0] == "leaf"]
        self.low = np.array([self.places[r].min(axis=0) for r in self.leaves])
        self.high = np.array([self.places[r].max(axis=0) for r in self.leaves])

    def search(self, query_id: int, vector: np.ndarray, place: np.ndarray, away: np.ndarray,
               bound: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the k nearest found; `away` are the leaves' box distances."""
        ids, scores = np.array([], dtype=np.int64), np.array([])
        norm, stop = float(np.sqrt(vector @ vector)), reach() * max(bound, 1e-12)
        near = np.flatnonzero(away < stop)
        for leaf in near[np.argsort(away[near], kind="stable")].tolist():
            if away[leaf] >= stop:
                break
            rows = self.leaves[leaf]
            gap = self.places[rows] - place
            rows = rows[(np.einsum("ij,ij->i", gap, gap) < stop) & (self.ids[rows] != query_id)]
            if not len(rows):
                continue
            # summed row by row, so equal vectors get equal scores wherever they lie
            cosine = (self.vectors[rows] * vector).sum(axis=1) / (self.norms[rows] * norm)
            if len(ids) == k:
                better = cosine >= scores[-1]
                if not better.any():
                    continue
                rows, cosine = rows[better], cosine[better]
            ids, scores = np.append(ids, self.ids[rows]), np.append(scores, cosine)
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                stop = min(stop, reach() * max(2 - 2 * scores[-1], 1e-12))
        return ids, scores


def search_shards(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell and shard, a shard's own rows before its queries."""
    current, parts, shard = None, [], None
    for batch in batches:
        key = np.stack([batch.column("cell").to_numpy(), batch.column("shard").to_numpy(),
                        batch.column("bound").is_valid().to_numpy(zero_copy_only=False)])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        out: list[list] = [[], [], []]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            run = batch.slice(a, b - a)
            if (place := (int(key[0, a]), int(key[1, a]))) != current:
                current, parts, shard = place, [], None
            columns = (run.column("id").to_numpy(), matrix(run.column("vector")),
                       matrix(run.column("place")))
            if not key[2, a]:
                parts.append(columns)
                continue
            if shard is None and parts:
                shard = Shard(*[np.concatenate(c) for c in zip(*parts, strict=True)])
                parts = []
            if shard is None:
                continue
            away = box_distance(columns[2], shard.low, shard.high)
            for i, bound in enumerate(run.column("bound").to_numpy()):
                ids, scores = shard.search(int(columns[0][i]), columns[1][i], columns[2][i],
                                           away[i], float(bound), k)
                out[0] += [columns[0][i]] * len(ids)
                out[1] += ids.tolist()
                out[2] += scores.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
             pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])


def usable(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, vector): rows that take part, of equal vectors and ids one."""
    v = F.col(vector)
    rows = df.select(F.col(id_column).alias("id"), v.cast("array<float>").alias("vector")).where(
        F.col("id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0))
    # one row per dimension that occurs
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(
        F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0]["n"] if sizes else 0))


def nearest(df: DataFrame, queries, k: int = 5, id_column: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """`query_id`, `rank`, `vec_id` and `score`: the k nearest found of every row that the column
    condition `queries` (over `id`) picks."""
    spark = df.sparkSession
    rows = usable(df, id_column, vector)
    copies = W.partitionBy("vector").orderBy("id")
    # k + 1: a query's own row is none of its neighbours; the limit acts before the shuffle too
    wanted = rows.distinct().withColumn("__n", F.row_number().over(copies)).where(
        F.col("__n") <= k + 1).drop("__n")
    asked = rows.where(queries).distinct()

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(project(matrix(batch.column("vector"))).tolist(),
                                              pa.list_(pa.float64()))],
                    names=["id", "vector", "place"])

    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).mapInArrow(
        place, "id long, vector array<float>, place array<double>").select("id", "place").toArrow()
    points = matrix(sample.sort_by("id").column("place").combine_chunks()) if len(
        sample) else np.zeros((0, DIMENSIONS))
    walk = list(halves(points, np.arange(len(points)), max(1, -(-len(points) // CELLS))))

    def index(batches):
        for batch in place(batches):
            cells = cells_of(matrix(batch.column("place")), walk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)],
                                             names=["id", "vector", "place", "cell"])

    indexed = settle(wanted.mapInArrow(index, ROW))
    asked = settle(asked.mapInArrow(index, ROW))
    # at most one row per cell
    boxes = sorted(indexed.groupBy("cell").agg(
        F.count("*"), *[f(F.element_at("place", i + 1)) for f in (F.min, F.max)
                        for i in range(DIMENSIONS)]).collect())
    cells = np.array([b[0] for b in boxes], dtype=np.int32)
    low = np.array([b[2:2 + DIMENSIONS] for b in boxes]).reshape(-1, DIMENSIONS)
    high = np.array([b[2 + DIMENSIONS:] for b in boxes]).reshape(-1, DIMENSIONS)
    shards = F.create_map(*[F.lit(int(x)) for b in boxes for x in (
        b[0], -(-b[1] // SHARD_ROWS))]) if boxes else F.create_map(F.lit(0), F.lit(1))

    stored = indexed.withColumn("shard", F.pmod(F.xxhash64("id"), F.try_element_at(
        shards, "cell")).cast("int")).withColumn("bound", F.lit(None).cast("double"))

    def visit(routed: DataFrame) -> DataFrame:
        sent = routed.withColumn("shard", F.explode(F.sequence(
            F.lit(0), F.coalesce(F.try_element_at(shards, "cell"), F.lit(1)) - 1)))
        both = stored.unionByName(sent.select(*stored.columns))
        return both.repartition("cell", "shard").sortWithinPartitions(
            "cell", "shard", F.col("bound").isNotNull(), "id").mapInArrow(
            lambda batches: search_shards(batches, k), FOUND)

    def best(found: DataFrame) -> DataFrame:
        order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.distinct().withColumn("rank", F.row_number().over(order)).where(
            F.col("rank") <= k)

    home = settle(best(visit(asked.withColumn("bound", F.lit(float("inf"))))))
    kth = home.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("kth"))
    bounds = asked.join(kth, F.col("id") == F.col("query_id"), "left").select(
        "id", "vector", "place", "cell", F.when(F.col("kth").isNull(), float("inf")).otherwise(
            F.greatest(F.lit(0.0), 2 - 2 * F.col("kth"))).alias("bound"))

    def route(batches):
        """The cells, besides its own, that a query has to visit."""
        for batch in batches:
            if not batch.num_rows:
                continue
            away = box_distance(matrix(batch.column("place")), low, high)
            goes = unmet(away, batch.column("bound").to_numpy()[:, None]) & (
                cells != batch.column("cell").to_numpy()[:, None])
            at, to = np.nonzero(goes)
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns[:3], pa.array(cells[to]), taken.column("bound")],
                names=["id", "vector", "place", "cell", "bound"])

    away = visit(bounds.mapInArrow(route, f"{ROW}, bound double"))
    return best(home.select("query_id", "vec_id", "score").unionByName(away)).select(
        "query_id", "rank", "vec_id", "score")
