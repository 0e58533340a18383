"""Additive attributions of linear models, forests and boosted trees."""

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.clean import seeded_sample
from tidewatch.operators.iforest import IsolationForestModel, expected_path, matrix_of
from tidewatch.operators.ranking import melt
from tidewatch.session import scratch_path


def linear_attribution(df: DataFrame, weights: dict[str, float], background: DataFrame,
                       key: str = "row_id", intercept: float = 0.0) -> DataFrame:
    """(key, feature, attribution, base): w (x - mean of the background); base + sum = margin."""
    cols = list(weights)
    means = background.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}")
                             for i, c in enumerate(cols)]).first()
    mean = {c: means[f"m{i}"] or 0.0 for i, c in enumerate(cols)}
    base = intercept + sum(weights[c] * mean[c] for c in cols)
    parts = df.select(key, *[
        (F.lit(float(weights[c])) * (F.col(f"`{c}`").cast("double") - F.lit(mean[c]))).alias(c)
        for c in cols])
    return melt(parts, [key], cols, "feature", "attribution").withColumn("base", F.lit(base))


def background_rows(df: DataFrame, key: str = "row_id", n: int = 100, seed=42) -> DataFrame:
    return seeded_sample(df, n, key, seed)


def fitted_linear_attribution(model: LogisticRegressionModel, df: DataFrame, background: DataFrame,
                              names: Sequence[str], key: str = "row_id") -> DataFrame:
    """(key, feature, attribution, base) of a fitted model's margin, one row per slot of its vector.

    `df` and `background` hold the assembled vector; `names` are its slots. Base plus attributions
    is the margin of a row.
    """
    column = model.getFeaturesCol()
    weights = model.coefficients.toArray()
    if len(names) != len(weights):
        raise ValueError(f"{len(names)} names for {len(weights)} slots")
    means = background.agg(Summarizer.mean(F.col(column)).alias("m")).first()["m"]
    mean = means.toArray() if means is not None else np.zeros(len(weights))
    base = float(model.intercept + weights @ mean)
    slots = F.arrays_zip(
        F.array(*map(F.lit, names)).alias("feature"), vector_to_array(column).alias("x"),
        F.array(*map(F.lit, weights.tolist())).alias("w"), F.array(*map(F.lit, mean.tolist())).alias("m"))
    part = F.col("s.w") * (F.col("s.x") - F.col("s.m"))
    return df.select(key, F.explode(slots).alias("s")).select(
        key, F.col("s.feature").alias("feature"), part.alias("attribution"),
        F.lit(base).alias("base"))


def leaf_paths(nodes: pd.DataFrame):
    """Per leaf: value, and per feature on its path the test it must pass and the share of samples
    kept. A test is an interval (low, high] or, for a categorical feature, a set of categories.

    `nodes` has tree, node, left, right, feature, threshold, n, value, and optionally `categories`,
    the ones that go left, with `size`, how many there are. A leaf is its own left child.
    """
    leaves = []
    for _, tree in nodes.groupby("tree", sort=True):
        at = tree.set_index("node").to_dict("index")
        todo = [(0, {})]
        while todo:
            node, path = todo.pop()
            row = at[node]
            if row["left"] == node:
                leaves.append((row["value"], path))
                continue
            f = int(row["feature"])
            go_left = row.get("categories")
            if go_left is not None:
                known, share = path.get(f, (frozenset(range(int(row["size"]))), 1.0))
                parts = (known & go_left, known - go_left)
            else:
                (lo, hi), share = path.get(f, ((-np.inf, np.inf), 1.0))
                cut = row["threshold"]
                parts = ((lo, min(hi, cut)), (max(lo, cut), hi))
            for child, test in zip((row["left"], row["right"]), parts, strict=True):
                keep = share * at[child]["n"] / row["n"]
                todo.append((int(child), {**path, f: (test, keep)}))
    return leaves


class PathAttribution:
    """Path-dependent Shapley values of a sum of trees.

    A leaf counts with the product over its features of "row inside" or "sample share"; the
    Shapley sum of such a product is a weighted sum of polynomial coefficients.
    """

    def __init__(self, nodes: pd.DataFrame, width: int):
        leaves = leaf_paths(nodes)
        self.width = width
        d = max([len(p) for _, p in leaves] + [1])
        # unused slots belong to a player that changes nothing
        self.feature = np.zeros((len(leaves), d), np.int64)
        self.lo = np.full((len(leaves), d), -np.inf)
        self.hi = np.full((len(leaves), d), np.inf)
        self.share = np.ones((len(leaves), d))
        self.value = np.array([v for v, _ in leaves], dtype=float)
        sets: dict[frozenset, int] = {}
        self.listed = np.full((len(leaves), d), -1)  # which set of categories, if any
        for i, (_, path) in enumerate(leaves):
            for j, (f, (test, share)) in enumerate(path.items()):
                self.feature[i, j], self.share[i, j] = f, share
                if isinstance(test, frozenset):
                    self.listed[i, j] = sets.setdefault(test, len(sets))
                else:
                    self.lo[i, j], self.hi[i, j] = test
        most = max([max(s, default=0) for s in sets] + [0]) + 1
        # the last category stands for all that no set holds
        self.sets = np.zeros((max(len(sets), 1), most + 1), dtype=bool)
        for s, i in sets.items():
            self.sets[i, sorted(s)] = True
        self.base = float((self.value * self.share.prod(axis=1)).sum())
        self.weight = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d)
                       for k in range(d)]

    def inside(self, rows: np.ndarray) -> np.ndarray:
        """rows x leaves x slots: whether the row passes the leaf's test."""
        value = rows[:, self.feature]
        out = (value > self.lo) & (value <= self.hi)
        leaf, slot = np.nonzero(self.listed >= 0)
        if len(leaf):
            category = np.clip(value[:, leaf, slot], 0, self.sets.shape[1] - 1).astype(np.int64)
            out[:, leaf, slot] = self.sets[self.listed[leaf, slot], category]
        return out

    def margin(self, x: np.ndarray, chunk: int = 64) -> np.ndarray:
        """The value of the trees themselves: that of the one leaf a row lies in, per tree."""
        return np.concatenate([self.inside(x[i:i + chunk]).all(axis=2) @ self.value
                               for i in range(0, len(x), chunk)]) if len(x) else np.zeros(0)

    def explain(self, x: np.ndarray, chunk: int = 16) -> np.ndarray:
        """Attribution per row and feature; `chunk` rows times all leaves are held at once."""
        d = self.feature.shape[1]
        out = np.zeros((len(x), self.width))
        for start in range(0, len(x), chunk):
            rows = x[start:start + chunk]
            inside = self.inside(rows)
            poly = np.zeros((d + 1, *inside.shape[:2]))
            poly[0] = 1.0
            for j in range(d):
                z, o = self.share[:, j], inside[:, :, j]
                poly[1:] = poly[1:] * z + poly[:-1] * o
                poly[0] *= z
            for j in range(d):
                z, o = self.share[:, j], inside[:, :, j]
                # divide the factor of slot j out again
                total, q = np.zeros(o.shape), np.zeros(o.shape)
                for k in range(d - 1, -1, -1):
                    q = np.where(o, poly[k + 1] - z * q, poly[k] / z)
                    total += self.weight[k] * q
                part = self.value * (o - z) * total
                for r in range(len(rows)):
                    out[start + r] += np.bincount(self.feature[:, j], part[r],
                                                  minlength=self.width)
        return out


class PatternAttribution:
    """Values of a `PathAttribution` from a table per leaf: what a row adds to the features depends
    only on which of the leaf's tests it passes, at most 2 ** depth patterns.

    A row's value of a feature counts by its place among the thresholds (or categories) of that
    feature, so the patterns of all leaves are sums of one line of bits per feature.
    """

    BLOCK, KEPT = 1 << 17, 1 << 24  # table entries computed at once and kept by a task

    def __init__(self, paths: PathAttribution):
        leaves, d = paths.feature.shape
        self.width, self.base, kind = paths.width, paths.base, np.min_scalar_type(2 ** d - 1)
        used = np.isfinite(paths.lo) | np.isfinite(paths.hi) | (paths.listed >= 0)
        # larger tables are computed anew for each batch, block by block
        self.keep = leaves * 2 ** d * (d + 1) <= self.KEPT
        self.step = max(1, self.BLOCK // (2 ** d * (d + 1)))
        self.paths, self.kept = paths, {}
        self.places: list[tuple] = []
        for f in range(self.width):
            leaf, slot = np.nonzero(used & (paths.feature == f))
            if not len(leaf):
                continue
            listed, bit = paths.listed[leaf, slot], (1 << slot).astype(kind)
            if (listed >= 0).any():
                cuts, inside = None, paths.sets[listed].T
            else:
                lo, hi = paths.lo[leaf, slot], paths.hi[leaf, slot]
                cuts = np.unique(np.concatenate([lo, hi]))
                cuts = cuts[np.isfinite(cuts)]
                place = np.arange(len(cuts) + 1)[:, None]
                low = np.where(np.isneginf(lo), -1, np.searchsorted(cuts, lo))
                high = np.where(np.isposinf(hi), len(cuts), np.searchsorted(cuts, hi))
                inside = (place > low) & (place <= high)
            bits = np.zeros((len(inside), leaves), kind)
            bits[:, leaf] = inside * bit
            self.places.append((f, cuts, bits))
        self.free = (~used * (1 << np.arange(d))).sum(axis=1).astype(kind)

    def table(self, start: int) -> np.ndarray:
        """(leaf, pattern) x (slots, then the value itself) of one block of leaves."""
        if start in self.kept:
            return self.kept[start]
        p, part = self.paths, slice(start, start + self.step)
        share, value = p.share[part][:, None], p.value[part][:, None]
        d = share.shape[2]
        inside = np.arange(2 ** d)[:, None] >> np.arange(d) & 1 == 1
        out = np.empty((len(share), 2 ** d, d + 1))
        poly = np.zeros((d + 1, len(share), 2 ** d))
        poly[0] = 1.0
        for j in range(d):
            poly[1:] = poly[1:] * share[:, :, j] + poly[:-1] * inside[:, j]
            poly[0] *= share[:, :, j]
        for j in range(d):
            z, o = share[:, :, j], inside[:, j]
            total, q = np.zeros(poly.shape[1:]), np.zeros(poly.shape[1:])
            for k in range(d - 1, -1, -1):
                q = np.where(o, poly[k + 1] - z * q, poly[k] / z)
                total += p.weight[k] * q
            out[:, :, j] = value * (o - z) * total
        out[:, :, d] = value * inside.all(axis=1)
        out = out.reshape(-1, d + 1)
        if self.keep:
            self.kept[start] = out
        return out

    def explain(self, x: np.ndarray, chunk: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Attribution per row and feature, and the margin per row."""
        leaves, d = self.paths.feature.shape
        wide = self.width + 1
        sums = np.zeros((len(x), wide))
        at = [np.searchsorted(cuts, x[:, f]) if cuts is not None else
              np.clip(np.nan_to_num(x[:, f], nan=len(bits)), 0, len(bits) - 1).astype(np.int64)
              for f, cuts, bits in self.places]
        slots = np.concatenate([self.paths.feature, np.full((leaves, 1), self.width)], axis=1)
        for start in range(0, len(x), chunk):
            size = min(chunk, len(x) - start)
            pattern = np.tile(self.free, (size, 1))
            for place, (_, _, bits) in zip(at, self.places, strict=True):
                pattern += bits.take(place[start:start + size], axis=0)
            row = np.arange(size)[:, None] * wide
            for first in range(0, leaves, self.step):  # a block of tables fits a core's cache
                part = slice(first, first + self.step)
                line = (np.arange(len(slots[part])) << d) + pattern[:, part]
                added = self.table(first).take(line.ravel(), axis=0)
                sums[start:start + size] += np.bincount(
                    (row + slots[part].ravel()).ravel(), added.ravel(), minlength=size * wide
                ).reshape(size, wide)
        return sums[:, :-1], sums[:, -1]


def _explained(df: DataFrame, explain, shared, names: list[str], features: str, key: str,
               total: str) -> DataFrame:
    """(key, feature, attribution, base, total) by Arrow batches; the trees go out once.

    `explain` gives attributions per row and feature, and the total per row, of the broadcast
    `shared`. A batch returns one list per row; names are added in generated code.
    """
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(shared)
    kind = dict(df.dtypes)[key]

    def explained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, margin = explain(sent.value, matrix_of(batch.column("x")))
            ends = np.arange(len(parts) + 1, dtype=np.int32) * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.ListArray.from_arrays(ends, pa.array(parts.ravel())),
                 pa.array(margin)], names=[key, "parts", total])

    rows = df.select(key, vector_to_array(features).alias("x")).mapInArrow(
        explained, f"`{key}` {kind}, parts array<double>, `{total}` double")
    return rows.select(key, total, F.posexplode("parts").alias("i", "attribution")).select(
        key, F.get(F.array(*map(F.lit, names)), F.col("i")).alias("feature"), "attribution",
        F.lit(shared.base).alias("base"), total)


def boosted_nodes(model: GBTClassificationModel) -> pd.DataFrame:
    """The node table of boosted trees; a leaf's value is its share of the margin.

    It is read from the model's saved form, in the shared scratch folder; its size depends on the
    number of trees and their depth only.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "boosted")
    model.write().save(path)
    n = F.col("nodeData")
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("feature"),
        n["split"]["leftCategoriesOrThreshold"].alias("test"), n["split"]["numCategories"].alias("size"),
        n["rawCount"].cast("double").alias("n"), n["prediction"].alias("value")).toPandas()
    leaf = rows["left"] < 0
    rows.loc[leaf, ["left", "right"]] = rows.loc[leaf, "node"]
    listed = ~leaf & (rows["size"] >= 0)
    rows["threshold"] = [t[0] if len(t) and not c else np.nan
                         for t, c in zip(rows["test"], listed, strict=True)]
    rows["categories"] = pd.Series([frozenset(map(int, t)) if c else None for t, c in zip(
        rows["test"], listed, strict=True)], dtype=object)
    rows["value"] *= np.array(model.treeWeights)[rows["tree"]]
    return rows.drop(columns="test")


def boosted_attribution(model: GBTClassificationModel, df: DataFrame, names: Sequence[str],
                        key: str = "row_id") -> DataFrame:
    """(key, feature, attribution, base, margin) of boosted trees, in margin space."""
    names = list(names)
    trees = PatternAttribution(PathAttribution(boosted_nodes(model), len(names)))
    return _explained(df, PatternAttribution.explain, trees, names, model.getFeaturesCol(), key,
                      "margin")


def tree_attribution(model: IsolationForestModel, df: DataFrame, names: Sequence[str],
                     key: str = "row_id") -> DataFrame:
    """(key, feature, attribution, base, path_length) of the mean path length per row."""
    names = list(names)
    nodes = model.nodes.assign(value=(model.nodes["depth"] + expected_path(model.nodes["n"]))
                               / model.nodes["tree"].nunique())
    return _explained(df, lambda paths, x: (paths.explain(x), paths.margin(x)),
                      PathAttribution(nodes, len(names)), names,
                      model.getOrDefault(model.featuresCol), key, "path_length")


def importance(attributions: DataFrame) -> DataFrame:
    return attributions.groupBy("feature").agg(
        F.avg(F.abs("attribution")).alias("mean_abs")).orderBy(F.desc("mean_abs"), "feature")
