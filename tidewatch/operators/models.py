"""Pipelines, model bundles, scoring and cross-validation."""

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import stages as ST
from tidewatch.operators.boosting import BoostedTrees
from tidewatch.operators.clean import stratified_kfold
from tidewatch.operators.iforest import IsolationForest
from tidewatch.operators.metrics import evaluate
from tidewatch.operators.ranking import melt
from tidewatch.schemas import CATEGORICAL, LIVE_FEATURES, RAW_FEATURES
from tidewatch.session import settle_wide
from tidewatch.sources.tables import require_columns

KINDS = ("iforest", "logreg", "gbt")
ROWS_A_TASK = 200_000  # of iterative training, whose thousands of short jobs cost a start per task


def one_hot_stages(cols: Sequence[str]) -> list:
    """One-hot vectors `<col>_vec`; a category not seen in training gives all zeros.

    Unseen values share one extra index, which the encoder's dropped last slot absorbs.
    """
    return [*index_stages(cols), *([OneHotEncoder(
        inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_vec" for c in cols],
        dropLast=True)] if cols else [])]


def index_stages(cols: Sequence[str]) -> list:
    return [StringIndexer(inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols],
                          handleInvalid="keep", stringOrderType="alphabetAsc")] if cols else []


class DetectionPipeline(Estimator, ST._Columns, ST._Saved):
    """Engineering, selection, imputation, scaling, encoding and a model, fitted once.

    Later stages are built from what the selection kept, so the result is a plain PipelineModel.
    `select=False` is the short contract: robust scaling, no derived features, no selection.
    """

    kind = Param(Params._dummy(), "kind", "iforest, logreg or gbt",
                 typeConverter=TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "rank correlation that is redundant",
                      typeConverter=TypeConverters.toFloat)
    select = Param(Params._dummy(), "select", "whether to engineer and select features",
                   typeConverter=TypeConverters.toBoolean)
    trees = Param(Params._dummy(), "trees", "trees of the forest", typeConverter=TypeConverters.toInt)
    iterations = Param(Params._dummy(), "iterations", "boosting rounds",
                       typeConverter=TypeConverters.toInt)
    keyCol = Param(Params._dummy(), "keyCol", "column that identifies a row",
                   typeConverter=TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0 or 1", typeConverter=TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, kind="iforest", inputCols=None, threshold=0.90, select=True, trees=300,
                 iterations=250, keyCol="row_id", labelCol="label", seed=42):
        super().__init__()
        if kind not in KINDS:
            raise ValueError(kind)
        self._set(kind=kind, threshold=threshold, select=select, trees=trees, iterations=iterations,
                  keyCol=keyCol, labelCol=labelCol, seed=seed,
                  inputCols=list(inputCols or (RAW_FEATURES if select else LIVE_FEATURES)))

    def settings(self) -> dict:
        return {p.name: self.getOrDefault(p) for p in self.params}

    def _fit(self, df: DataFrame) -> PipelineModel:
        o, kind, raw = self.settings(), self.getOrDefault(self.kind), self.columns()
        df = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*raw, o["keyCol"], o["labelCol"]])
                         if c in raw or c in df.columns])
        if kind == "iforest":
            df = df.where(F.col(o["labelCol"]) == 0)
        fitted: list = []

        def step(stage, frame: DataFrame) -> DataFrame:
            model = stage.fit(frame) if isinstance(stage, Estimator) else stage
            fitted.append(model)
            return model.transform(frame)

        if not o["select"]:
            cats = [c for c in raw if c in CATEGORICAL]
            nums = [c for c in raw if c not in CATEGORICAL]
            current = step(ST.ExactRobustScaler(inputCols=nums), df)
        else:
            current = step(ST.NetworkFeatures(inputCols=raw), df)
            # selection reads the engineered rows several times, a few columns at a time
            current = settle_wide(current, "engineered")
            engineered = [c for c in current.columns
                          if c not in df.columns or c in raw]
            current = step(ST.CorrelationSelector(inputCols=engineered,
                                                  threshold=o["threshold"]), current)
            cats = fitted[-1].categorical_features()
            nums = fitted[-1].numeric_features()
            if kind != "gbt":
                current = step(ST.PopStandardScaler(inputCols=nums), current)
        encode = index_stages(cats) if kind == "gbt" else one_hot_stages(cats)
        for stage in encode:
            current = step(stage, current)
        suffix = "_idx" if kind == "gbt" else "_vec"
        current = step(VectorAssembler(inputCols=[*nums, *[f"{c}{suffix}" for c in cats]],
                                       outputCol="features", handleInvalid="keep"), current)
        vectors = current.select(*dict.fromkeys(
            ["features", o["keyCol"] if kind == "iforest" else o["labelCol"]]))
        size = 0
        if kind != "iforest":  # a forest reads them once
            # iterative training reads the vectors again and again, but nothing else of a row
            size = vectors.count()
            slots = df.sparkSession.sparkContext.defaultParallelism
            vectors = vectors.coalesce(max(slots, math.ceil(size / ROWS_A_TASK))).persist(
                StorageLevel.MEMORY_AND_DISK)
        model = self._estimator(size, cats, fitted).fit(vectors)
        fitted.append(model)
        if kind != "iforest":
            vectors.unpersist()
        return PipelineModel(stages=fitted)

    def _estimator(self, rows: int, cats: list[str], fitted: list) -> Estimator:
        o, kind = self.settings(), self.getOrDefault(self.kind)
        if kind == "iforest":
            return IsolationForest(numTrees=o["trees"], seed=o["seed"], keyCol=o["keyCol"])
        if kind == "logreg":
            # a penalty of C = 1 on the summed loss is 1 / n on Spark's mean loss
            return LogisticRegression(featuresCol="features", labelCol=o["labelCol"],
                                      regParam=1.0 / max(rows, 1), elasticNetParam=0.0,
                                      standardization=False, maxIter=3000)
        sizes = [len(v) + 1 for m in fitted if isinstance(m, StringIndexerModel)
                 for v in m.labelsArray]
        return BoostedTrees(featuresCol="features", labelCol=o["labelCol"],
                            maxIter=o["iterations"], maxDepth=6, stepSize=0.08, seed=o["seed"],
                            maxBins=max([32, *sizes]))


def selected_features(pipeline: PipelineModel) -> list[str]:
    for s in pipeline.stages:
        if isinstance(s, ST.CorrelationSelectorModel):
            return s.selected_features()
        if isinstance(s, VectorAssembler):
            return list(s.getInputCols())
    return []


def output_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the assembled vector's slots, from the column's own metadata."""
    attrs = df.schema[features].metadata["ml_attr"]["attrs"]
    slots = [a for group in attrs.values() for a in group]
    return [a["name"] for a in sorted(slots, key=lambda a: a["idx"])]


def score_with(pipeline: PipelineModel, df: DataFrame, kind: str) -> DataFrame:
    """`df` as it is plus `score`: the anomaly score, or the probability of an attack.

    The stages scale columns in place, so the input row travels beside them.
    """
    given = [c for c in df.columns if c != "score"]
    out = pipeline.transform(df.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in given])))
    score = F.col("score") if kind == "iforest" else vector_to_array("probability")[1]
    return out.select(*[F.col("__row")[c].alias(c) for c in given], score.alias("score"))


@dataclass
class ModelBundle:
    """A fitted pipeline with its threshold and contract."""

    pipeline: PipelineModel
    kind: str
    threshold: float
    raw_features: list[str]
    metadata: dict = field(default_factory=dict)

    def __post_init__(self):
        if not math.isfinite(self.threshold):
            raise ValueError(f"threshold {self.threshold} is no finite number")

    def predict(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.raw_features)
        carried = [c for c in ("row_id", "label", "attack_type") if c in df.columns]
        narrow = df.select(*dict.fromkeys([*carried, *self.raw_features]))
        return add_prediction(score_with(self.pipeline, narrow, self.kind), self.threshold).select(
            *carried, "score", "prediction")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.pipeline.write().save(f"{path}/pipeline")
        text = json.dumps({"kind": self.kind, "threshold": self.threshold,
                           "raw_features": self.raw_features, "metadata": self.metadata,
                           "selected_features": selected_features(self.pipeline)}, sort_keys=True)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/bundle")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ModelBundle":
        info = json.loads(spark.read.text(f"{path}/bundle").first()[0])
        return ModelBundle(PipelineModel.load(f"{path}/pipeline"), info["kind"],
                           info["threshold"], info["raw_features"], info["metadata"])


def add_prediction(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.withColumn("prediction", (F.col("score") >= F.lit(threshold)).cast("int"))


def inference_summary(predictions: DataFrame, kind: str) -> DataFrame:
    return predictions.agg(F.lit(kind).alias("kind"), F.count("*").alias("rows"),
                           F.coalesce(F.sum("prediction"), F.lit(0)).alias("alerts"))


def cross_validate(df: DataFrame, kind: str = "iforest", k: int = 5, seed: int = 42,
                   key: str = "row_id", **options) -> DataFrame:
    """fold, roc_auc, average_precision, n_features; the whole pipeline is refitted per fold."""
    raw = DetectionPipeline(kind=kind, **options).columns()
    # every fold reads all rows twice
    folds = settle_wide(stratified_kfold(
        df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*raw, key, "label"])]), key, k, seed),
        "folds")
    out = None
    for fold in range(1, k + 1):
        train, held = folds.where(F.col("fold") != fold), folds.where(F.col("fold") == fold)
        model = DetectionPipeline(kind=kind, keyCol=key, seed=seed + fold, **options).fit(train)
        line = evaluate(score_with(model, held, kind), 0.0, pvalue=False).select(
            F.lit(fold).alias("fold"), "roc_auc", "average_precision",
            F.lit(len(selected_features(model))).alias("n_features"))
        out = line if out is None else out.unionByName(line)
    return out


def cv_summary(rows: DataFrame, metrics: Sequence[str] = ("roc_auc", "average_precision"),
               by: Sequence[str] = ()) -> DataFrame:
    """mean, sample deviation, min and max over folds, long form."""
    long = melt(rows, by, metrics, "metric", "value")
    return long.groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))


__all__ = ["DetectionPipeline", "ModelBundle", "cross_validate", "cv_summary",
           "inference_summary", "one_hot_stages", "score_with", "selected_features"]
