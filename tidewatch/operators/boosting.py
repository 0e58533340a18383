"""Spark's gradient boosted trees, grown in one barrier stage instead of two stages per tree level.

Split candidates come from Spark's own code; split rule, pseudo-residuals and the model are Spark's as
well. Only the way of the sums differs: each task keeps its rows' bins and margins, and the tasks
exchange the histograms of a level among themselves, so a level costs no job, no task start and no
pass over cached rows. The bins of all rows have to fit the tasks' memory, some 100 bytes a row.
"""

import json
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark import BarrierTaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.iforest import matrix_of
from tidewatch.session import scratch_path

PACKED = 1024  # cells of a joint histogram of several columns
PURE = 2.0 ** -52  # variance below which Spark splits no further
DATA_SCHEMA = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, "
               "impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, "
               "rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: "
               "array<double>, numCategories: int>>")
NODE_SCHEMA = ("tree int, node int, n double, s double, ss double, gain double, feature int, "
               "test array<double>, size int")


class Bins:
    """Thresholds of continuous columns and numbers of categories; both count as bins."""

    def __init__(self, cuts: list[np.ndarray], categories: dict[int, int]):
        self.cuts, self.categories = cuts, categories
        self.sizes = np.array([categories.get(f, len(c) + 1) for f, c in enumerate(cuts)])
        self.kind = np.min_scalar_type(int(self.sizes.max(initial=1)) - 1)
        # a column with one bin has no split
        self.used = np.flatnonzero(self.sizes > 1)
        self.packs: list[list[int]] = []
        held = PACKED + 1
        for f in self.used:
            if held * self.sizes[f] > PACKED:
                self.packs.append([])
                held = 1
            self.packs[-1].append(int(f))
            held *= int(self.sizes[f])

    def of(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, self.kind)
        for f, cuts in enumerate(self.cuts):
            out[:, f] = x[:, f] if f in self.categories else np.searchsorted(cuts, x[:, f])
        return out


class Histograms:
    """Rows, sums and sums of squares per node and bin over a task's rows, several columns at a time.

    Rows are added in their order, as Spark does, so that equal gains are mostly equal in both.
    """

    def __init__(self, bins: Bins, rows: np.ndarray):
        self.bins, self.sizes = bins, [int(np.prod(bins.sizes[p])) for p in bins.packs]
        self.codes = []
        for pack in bins.packs:
            code = np.zeros(len(rows), np.int64)
            for f in pack:
                code = code * bins.sizes[f] + rows[:, f]
            self.codes.append(code.astype(np.int32))
        self.width = int(bins.sizes[bins.used].sum())

    def of(self, slot: np.ndarray, nodes: int, residual: np.ndarray, square: np.ndarray) -> np.ndarray:
        """(3, nodes, bins of all used columns) of the rows whose slot is not negative."""
        out = np.empty((3, nodes, self.width))
        rows = None if len(slot) and slot.min() >= 0 else np.flatnonzero(slot >= 0)
        own, *weights = (slot, residual, square) if rows is None else (
            v[rows] for v in (slot, residual, square))
        at = 0
        for pack, size, code in zip(self.bins.packs, self.sizes, self.codes, strict=True):
            cell = own * size + (code if rows is None else code.take(rows))
            shape = (nodes, *self.bins.sizes[pack])
            every = [np.bincount(cell, w, minlength=nodes * size).reshape(shape)
                     for w in (None, *weights)]
            for i, f in enumerate(pack):
                others = tuple(j + 1 for j in range(len(pack)) if j != i)
                for k in range(3):
                    out[k, :, at:at + self.bins.sizes[f]] = every[k].sum(axis=others)
                at += int(self.bins.sizes[f])
        return out


def variance(n, s, ss):
    return (ss - s * s / n) / n


class Splitter:
    """The best split of each node from its histogram, by Spark's rule.

    Only operations of one order are used, so that all tasks come to the same split.
    """

    def __init__(self, bins: Bins):
        self.bins, self.sizes = bins, bins.sizes[bins.used]
        most = int(self.sizes.max(initial=1))
        first = np.concatenate([[0], np.cumsum(self.sizes)])
        place = np.arange(most)
        self.real = place < self.sizes[:, None]
        self.cell = np.where(self.real, first[:-1, None] + place, first[-1])
        self.listed = np.array([int(f) in bins.categories for f in bins.used], dtype=bool)

    def best(self, found: np.ndarray, given: list) -> list[tuple | None]:
        """Per node (gain, feature, bins that go left, sums on the left, sums on the right) or None.

        `given` has the sums of each node as its parent's split left them; none for the root.
        """
        nodes = found.shape[1]
        sums = np.concatenate([found, np.zeros((3, nodes, 1))], axis=2)[:, :, self.cell]
        order = np.broadcast_to(np.arange(sums.shape[3]), sums.shape[1:]).copy()
        if self.listed.any():
            n, s, _ = sums[:, :, self.listed]
            with np.errstate(invalid="ignore", divide="ignore"):
                mean = np.where(n > 0, s / n, np.finfo(float).max)
            mean = np.where(self.real[self.listed], mean, np.inf)
            order[:, self.listed] = np.argsort(mean, axis=2, kind="stable")
            sums = np.take_along_axis(sums, order[None], 3)
        sums = np.cumsum(sums, axis=3)
        left = sums[..., :-1]
        right = sums[..., -1:] - left
        own = np.array([g if g is not None else left[:, i, 0, 0] + right[:, i, 0, 0]
                        for i, g in enumerate(given)]).T
        ln, rn = left[0], right[0]
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = variance(*own)[:, None, None] - ln / (ln + rn) * np.where(
                ln > 0, variance(*left), 0) - rn / (ln + rn) * np.where(rn > 0, variance(*right), 0)
        gain[~((ln >= 1) & (rn >= 1) & self.real[:, 1:])] = -np.inf
        flat = gain.reshape(nodes, -1)
        out: list[tuple | None] = []
        for i, spot in enumerate(np.argmax(flat, axis=1)):
            f, k = divmod(int(spot), gain.shape[2])
            out.append((float(flat[i, spot]), int(self.bins.used[f]), order[i, f, :k + 1],
                        left[:, i, f, k], right[:, i, f, k]) if flat[i, spot] > 0 else None)
        return out


def grow(bins: Bins, rows: np.ndarray, sign: np.ndarray, trees: int, depth: int, step: float,
         total) -> Iterator[tuple]:
    """Rows of `NODE_SCHEMA`; nodes are numbered as in a heap, the root is 1. `total` adds an array up
    over all tasks."""
    histograms, splitter = Histograms(bins, rows), Splitter(bins)
    margin, size, width = np.zeros(len(rows)), 2 ** (depth + 1), bins.sizes.max(initial=1)
    line = np.arange(len(rows))
    for tree in range(trees):
        residual = sign if not tree else 4 * sign / (1 + np.exp(2 * sign * margin))
        square = residual * residual
        sums, gains, splits = {1: None}, {}, {}
        at, active = np.ones(len(rows), np.int64), [1]
        for _ in range(depth):
            slot = np.full(size, -1)
            slot[active] = np.arange(len(active))
            found = total(histograms.of(slot[at], len(active), residual, square).ravel())
            best = splitter.best(found.reshape(3, len(active), -1), [sums[h] for h in active])
            if sums[1] is None:  # of the root: its first column
                sums[1] = np.cumsum(found.reshape(3, -1)[:, :bins.sizes[bins.used[0]]], axis=1)[:, -1]
            feature, left = np.zeros(size, np.int64), np.full((size, width), -1, np.int8)
            following = []
            for h, split in zip(active, best, strict=True):
                if split is None:
                    continue
                gain, f, low, *sides = split
                listed = bins.categories.get(f, -1)
                splits[h] = (f, sorted(map(float, low)) if listed >= 0 else
                             [float(bins.cuts[f][len(low) - 1])], listed)
                gains[h] = gain
                feature[h], left[h], left[h, low] = f, 0, 1
                for child, side in zip((2 * h, 2 * h + 1), sides, strict=True):
                    sums[child] = side
                    if not abs(variance(*side)) < PURE:
                        following.append(child)
            go = left[at, rows[line, feature[at]]]
            at = np.where(go >= 0, 2 * at + 1 - go, at)
            active = following
            if not active:
                break
        value = np.zeros(size)
        for h, (n, s, ss) in sums.items():
            value[h] = s / n
            yield (tree, h, float(n), float(s), float(ss), gains.get(h, -1.0),
                   *splits.get(h, (-1, [], -1)))
        margin += (step if tree else 1.0) * value[at]


class Exchange:
    """Sums of arrays over the tasks of a barrier stage, by files in the shared scratch folder.

    `allGather` waits by the second, which a histogram per tree level can't afford; it is used once, to
    agree on a fresh folder. A task drops its file when all have read it, two rounds later.
    """

    def __init__(self, root: str, context: BarrierTaskContext, patience: float = 600.0):
        self.tasks, self.own = len(context.getTaskInfos()), context.partitionId()
        folder = context.allGather(uuid.uuid4().hex)[0]
        self.store, base = pa_fs.FileSystem.from_uri(root) if "://" in root or root.startswith(
            "file:") else (pa_fs.LocalFileSystem(), root)
        self.base, self.round, self.patience = f"{base}/{folder}", 0, patience
        self.store.create_dir(self.base, recursive=True)

    def name(self, number: int, task: int) -> str:
        return f"{self.base}/{number}-{task}"

    def total(self, part: np.ndarray) -> np.ndarray:
        if self.tasks == 1:
            return part
        with self.store.open_output_stream(f"{self.name(self.round, self.own)}.part") as out:
            out.write(part.tobytes())
        self.store.move(f"{self.name(self.round, self.own)}.part", self.name(self.round, self.own))
        out = np.zeros(len(part))
        for task in range(self.tasks):
            out += part if task == self.own else self.read(task)
        if self.round:
            self.store.delete_file(self.name(self.round - 1, self.own))
        self.round += 1
        return out

    def read(self, task: int) -> np.ndarray:
        name, wait, until = self.name(self.round, task), 0.0005, time.monotonic() + self.patience
        while True:
            try:
                with self.store.open_input_file(name) as given:
                    return np.frombuffer(given.read())
            except FileNotFoundError:
                if time.monotonic() > until:
                    raise TimeoutError(f"task {task} did not bring round {self.round}") from None
            time.sleep(wait)
            wait = min(2 * wait, 0.02)


class BoostedTrees(GBTClassifier):
    """`GBTClassifier` whose `fit` runs as one barrier stage; weights and a validation column are not
    taken. Where barriers are not to be had (dynamic allocation), Spark's own fit runs."""

    def _fit(self, df: DataFrame) -> GBTClassificationModel:
        spark = df.sparkSession
        if spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
            return super()._fit(df)
        column, label = self.getFeaturesCol(), self.getLabelCol()
        df = df.select(column, label)
        bins, root = self._bins(df), scratch_path(spark, "exchange")
        width = len(bins.cuts)
        if not len(bins.used):  # no column has a split: a tree is one leaf
            return super()._fit(df)
        trees, depth, step = self.getMaxIter(), self.getMaxDepth(), self.getStepSize()

        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = bins.of(matrix_of(batch.column("x")).reshape(batch.num_rows, width))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in x], pa.binary()), batch.column("y")],
                    names=["x", "y"])

        def boosted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, signs = [np.empty((0, width), bins.kind)], [np.empty(0)]
            for batch in batches:
                if batch.num_rows:
                    ends = batch.column("x").buffers()[2]
                    first = batch.column("x").offset * width * bins.kind.itemsize
                    parts.append(np.frombuffer(ends, bins.kind, batch.num_rows * width,
                                               first).reshape(-1, width).copy())
                    signs.append(2 * batch.column("y").to_numpy() - 1)
            context = BarrierTaskContext.get()
            grown = list(grow(bins, np.concatenate(parts), np.concatenate(signs), trees, depth, step,
                              Exchange(root, context).total))
            if context.partitionId() == 0:
                names = [c.split(" ")[0] for c in NODE_SCHEMA.split(", ")]
                kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.int32(),
                         pa.list_(pa.float64()), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*grown, strict=True), kinds, strict=True)],
                    names=names)

        context = spark.sparkContext._jsc.sc()
        slots = context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())
        parts = df.rdd.getNumPartitions()
        tasks = max(1, min(slots, parts))
        # a barrier stage starts at a shuffle: its rows are a few bytes per column, in their order
        nodes = df.select(vector_to_array(column).alias("x"), F.col(label).cast("double").alias("y")
                          ).mapInArrow(binned, "x binary, y double").select(
            "x", "y", F.monotonically_increasing_id().alias("at"),
            F.floor(F.spark_partition_id() * F.lit(tasks) / F.lit(max(parts, 1))).cast("int").alias("task")
        ).repartitionById(tasks, "task").sortWithinPartitions("at").select("x", "y").mapInArrow(
            boosted, NODE_SCHEMA, barrier=True).collect()
        return self._model(spark, nodes, width)

    def _bins(self, df: DataFrame) -> Bins:
        """Spark's split candidates."""
        jvm = df.sparkSession.sparkContext._jvm

        def static(package, name: str):
            return getattr(getattr(package, f"{name}$"), "MODULE$")

        ml, mllib = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib
        self._transfer_params_to_java()
        instances = static(ml.util, "DatasetUtils").extractInstances(
            self._java_obj, df._jdf, jvm.scala.Option.apply(2))
        listed = static(ml.util, "MetadataUtils").getCategoricalFeatures(
            df._jdf.schema().apply(self.getFeaturesCol()))
        strategy = self._java_obj.getOldBoostingStrategy(
            listed, static(mllib.tree.configuration, "Algo").Classification()).getTreeStrategy()
        strategy.setAlgo("Regression")
        impl = ml.tree.impl
        metadata = static(impl, "DecisionTreeMetadata").buildMetadata(instances, strategy)
        splits = static(impl, "RandomForest").findSplits(instances, metadata, self.getSeed())
        categories = {f: listed.apply(f) for f in range(len(splits)) if listed.contains(f)}
        cuts = [np.empty(0) if f in categories else np.array([s.threshold() for s in of], float)
                for f, of in enumerate(splits)]
        return Bins(cuts, categories)

    def _model(self, spark: SparkSession, nodes: list, width: int) -> GBTClassificationModel:
        """The nodes in Spark's saved form, loaded as a model."""
        path, stamp = scratch_path(spark, "boosted"), int(time.time() * 1000)
        trees: dict[int, dict] = {}
        for r in nodes:
            trees.setdefault(r["tree"], {})[r["node"]] = r
        data = [row for t, tree in trees.items() for row in saved_tree(t, tree)]

        def params(given: dict) -> dict:
            return {p.name: v for p, v in given.items()}

        own, tree = DecisionTreeRegressor(), params(self._paramMap)
        info = {"timestamp": stamp, "sparkVersion": spark.version}
        single = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel",
                  "paramMap": {k: v for k, v in tree.items() if own.hasParam(k)},
                  "defaultParamMap": params(own._defaultParamMap), **info}
        whole = {"class": "org.apache.spark.ml.classification.GBTClassificationModel",
                 "uid": self.uid, "paramMap": tree, "defaultParamMap": params(self._defaultParamMap),
                 "numFeatures": width, "numTrees": len(trees), **info}
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(
            f"{path}/metadata")
        spark.createDataFrame([
            (t, json.dumps({"uid": f"dtr_{uuid.uuid4().hex[:12]}", **single}),
             self.getStepSize() if t else 1.0) for t in trees], "_1 int, _2 string, _3 double"
        ).coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(data, DATA_SCHEMA).coalesce(1).write.parquet(f"{path}/data")
        return GBTClassificationModel.load(path)


def saved_tree(tree: int, nodes: dict) -> list[tuple]:
    """A tree as Spark saves it: in preorder, two leaves of one prediction merged into their parent."""
    def mean(h: int) -> float:
        return nodes[h]["s"] / nodes[h]["n"]

    leaf = {h: r["feature"] < 0 for h, r in nodes.items()}
    for h in sorted(nodes, reverse=True):
        if not leaf[h] and leaf[2 * h] and leaf[2 * h + 1] and mean(2 * h) == mean(2 * h + 1):
            leaf[h] = True
    out: list = []

    def visit(h: int) -> int:
        r, own = nodes[h], len(out)
        out.append(None)
        below, split = (-1, -1), (-1, [], -1)
        if not leaf[h]:
            below = (visit(2 * h), visit(2 * h + 1))
            split = (r["feature"], list(r["test"]), r["size"])
        variance = (r["ss"] - r["s"] * r["s"] / r["n"]) / r["n"]
        out[own] = (tree, (own, mean(h), variance, [r["n"], r["s"], r["ss"]], int(r["n"]),
                           -1.0 if leaf[h] else r["gain"], *below, split))
        return own

    visit(1)
    return out
