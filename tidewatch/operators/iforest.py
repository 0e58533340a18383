"""Isolation Forest as a Spark ML estimator.

Sampling, grouping and scoring are Spark's; the per-tree construction sees one bounded sample,
and the fitted forest is a node table whose size depends on trees and sample size only.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
    MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidewatch.functions.hashing import hash_u32
from tidewatch.session import settle

EULER_GAMMA = 0.5772156649015329  # fixed value
NODE_SCHEMA = ("tree int, node int, left int, right int, feature int, threshold double, "
               "n long, depth int")


def expected_path(n) -> np.ndarray:
    """Average path length of an unsuccessful search among `n` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, value))


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Random splits on columns that still vary; rows are (node, left, right, feature,
    threshold, n, depth), leaves point to themselves."""
    rows, todo = [], [(0, np.arange(len(x)), 0)]
    free = 1
    while todo:
        node, idx, depth = todo.pop()
        part = x[idx]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(low < high)
        if depth >= max_depth or len(idx) < 2 or not len(usable):
            rows.append((node, node, node, 0, 0.0, len(idx), depth))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        if cut >= high[feature]:  # keeps both sides filled
            cut = float(low[feature])
        below = part[:, feature] <= cut
        rows.append((node, free, free + 1, feature, cut, len(idx), depth))
        todo += [(free, idx[below], depth + 1), (free + 1, idx[~below], depth + 1)]
        free += 2
    return rows


def draw_samples(df: DataFrame, key: str, trees: int, max_samples: int,
                 seed: int) -> tuple[DataFrame, int]:
    """(tree, …) rows: every tree gets `psi` rows without replacement; returns also `psi`.

    The input is thinned by hash to little more than trees * psi rows (to all rows, if it has
    fewer) and settled; these are shuffled once per round by hash and dealt out in blocks of psi.
    """
    n = df.count()
    if n == 0:
        raise ValueError("no normal row to learn from")
    psi = min(max_samples, n)
    need = trees * psi
    share = (need * 1.05 + 10 * math.sqrt(need) + 100) / n
    pool = settle(df.where(hash_u32(f"{seed}-pool", key) < int(min(1.0, share) * 2**32)))
    size = pool.count()
    per_round = max(size // psi, 1)
    rounds = math.ceil(trees / per_round)
    dealt = pool.withColumn("__r", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    order = W.partitionBy("__r").orderBy(hash_u32(seed, "__r", key), key)
    dealt = dealt.withColumn("__b", F.floor((F.row_number().over(order) - 1) / psi).cast("int"))
    return dealt.where(F.col("__b") < per_round).withColumn(
        "tree", F.col("__r") * per_round + F.col("__b")).where(F.col("tree") < trees).drop(
        "__r", "__b"), psi


def matrix_of(column: pa.Array) -> np.ndarray:
    """Rows of an array column as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Forest:
    """Flat node arrays, shipped to the executors once."""

    def __init__(self, nodes: pd.DataFrame, psi: int):
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        sizes = nodes.groupby("tree").size().to_numpy()
        base = np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        self.root = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.feature = nodes["feature"].to_numpy(np.int64)
        self.threshold = nodes["threshold"].to_numpy(float)
        self.child = np.empty(2 * len(nodes), np.int64)  # [right, left] per node
        self.child[0::2] = nodes["right"].to_numpy(np.int64) + base
        self.child[1::2] = nodes["left"].to_numpy(np.int64) + base
        self.path = nodes["depth"].to_numpy(float) + expected_path(nodes["n"].to_numpy())
        self.steps = int(nodes["depth"].max()) if len(nodes) else 0
        self.psi = psi

    def mean_path(self, x: np.ndarray, chunk: int = 512) -> np.ndarray:
        out = np.empty(len(x))
        width = x.shape[1]
        for start in range(0, len(x), chunk):
            part = np.ascontiguousarray(x[start:start + chunk])
            flat, offset = part.ravel(), (np.arange(len(part)) * width)[:, None]
            at = np.broadcast_to(self.root, (len(part), len(self.root)))
            for _ in range(self.steps):
                below = flat[offset + self.feature[at]] <= self.threshold[at]
                at = self.child[2 * at + below]
            out[start:start + chunk] = self.path[at].mean(axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        norm = float(expected_path(self.psi)) or 1.0
        return np.power(2.0, -self.mean_path(x) / norm)


class _ForestParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column",
                        typeConverter=TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "output column",
                     typeConverter=TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "column that identifies a row",
                   typeConverter=TypeConverters.toString)
    numTrees = Param(Params._dummy(), "numTrees", "trees", typeConverter=TypeConverters.toInt)
    maxSamples = Param(Params._dummy(), "maxSamples", "rows per tree",
                       typeConverter=TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", typeConverter=TypeConverters.toInt)
    offset = Param(Params._dummy(), "offset", "subtracted from the raw score",
                   typeConverter=TypeConverters.toFloat)

    def _defaults(self):
        self._setDefault(featuresCol="features", scoreCol="score", keyCol="row_id", numTrees=300,
                         maxSamples=256, seed=42, offset=0.5)


class IsolationForest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):

    @keyword_only
    def __init__(self, *, featuresCol="features", scoreCol="score", keyCol="row_id", numTrees=300,
                 maxSamples=256, seed=42, offset=0.5):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "IsolationForestModel":
        g = self.getOrDefault
        seed, trees = g(self.seed), g(self.numTrees)
        rows = df.select(F.col(g(self.keyCol)).alias("k"),
                         vector_to_array(g(self.featuresCol)).alias("x"))
        samples, psi = draw_samples(rows, "k", trees, g(self.maxSamples), seed)
        depth = math.ceil(math.log2(max(psi, 2)))

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iloc[0])
            pdf = pdf.sort_values("k")
            grown = grow_tree(np.stack(pdf["x"].to_numpy()), np.random.default_rng([seed, tree]),
                              depth)
            out = pd.DataFrame(grown, columns=["node", "left", "right", "feature", "threshold",
                                               "n", "depth"])
            out.insert(0, "tree", tree)
            return out

        # the samples are small in bytes but not in work: keep adaptive execution from
        # putting all trees into one task
        slots = max(1, min(trees, 4 * df.sparkSession.sparkContext.defaultParallelism))
        nodes = samples.repartition(slots, "tree").groupBy("tree").applyInPandas(
            build, NODE_SCHEMA).toPandas()
        model = IsolationForestModel(nodes, psi)
        return self._copyValues(model)


class IsolationForestModel(Model, _ForestParams, MLReadable, MLWritable):

    psi = Param(Params._dummy(), "psi", "rows each tree has seen",
                typeConverter=TypeConverters.toInt)

    def __init__(self, nodes: pd.DataFrame | None = None, psi: int = 0):
        super().__init__()
        self._defaults()
        self._set(psi=psi)
        self.nodes = nodes

    def node_table(self, spark) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)

    def forest(self) -> Forest:
        return Forest(self.nodes, self.getOrDefault(self.psi))

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.forest())
        offset = self.getOrDefault(self.offset)

        @F.arrow_udf("double")
        def score(column: pa.Array) -> pa.Array:
            if not len(column):
                return pa.array([], pa.float64())
            return pa.array(shared.value.score(matrix_of(column)) - offset)

        return df.withColumn(self.getOrDefault(self.scoreCol), score(
            vector_to_array(self.getOrDefault(self.featuresCol))))

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader(cls)


class _ForestWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.node_table(self.sparkSession).coalesce(1).write.parquet(f"{path}/nodes")


class _ForestReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path}/nodes").toPandas())
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def score_boxes(df: DataFrame, boxes: DataFrame, psi: int, offset: float = 0.5,
                score: str = "score") -> DataFrame:
    """Same score for a forest given as leaf boxes (tree, leaf, feature, lo, hi, depth, n).

    A row lies in a leaf when lo < x <= hi for every listed feature; null bounds are open. The
    boxes are a model, so their number does not depend on the scored rows.
    """
    table = boxes.toPandas()
    names = sorted(table["feature"].dropna().unique())
    leaves = []
    for _, part in table.groupby(["tree", "leaf"], sort=True):
        bounds = [(names.index(r.feature), -np.inf if pd.isna(r.lo) else r.lo,
                   np.inf if pd.isna(r.hi) else r.hi)
                  for r in part.itertuples() if isinstance(r.feature, str)]
        leaves.append((bounds, float(part["depth"].iloc[0]) + float(
            expected_path(part["n"].iloc[0]))))
    trees = table["tree"].nunique()
    norm = float(expected_path(psi)) or 1.0

    @F.arrow_udf("double")
    def from_boxes(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.float64())
        x = matrix_of(column)
        total = np.zeros(len(x))
        for bounds, path in leaves:
            inside = np.ones(len(x), bool)
            for f, lo, hi in bounds:
                inside &= (x[:, f] > lo) & (x[:, f] <= hi)
            total += inside * path
        return pa.array(np.power(2.0, -(total / trees) / norm) - offset)

    return df.withColumn(score, from_boxes(
        F.array(*[F.col(c).cast(T.DoubleType()) for c in names])))
