"""Ranking DNS windows against a baseline capture."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.evidence import top_windows
from tidewatch.operators.iforest import IsolationForest
from tidewatch.schemas import DNS_WINDOW_FEATURES

MIN_BASELINE = 8


def score_windows(baseline: DataFrame, period: DataFrame, seed: int = 42,
                  trees: int = 200) -> DataFrame:
    """`period` windows with the raw forest score; only the baseline is fitted, labels unused."""
    if baseline.limit(MIN_BASELINE).count() < MIN_BASELINE or period.isEmpty():
        raise ValueError(
            f"fewer than {MIN_BASELINE} windows to compare with, or none to rank")
    assemble = VectorAssembler(inputCols=DNS_WINDOW_FEATURES, outputCol="features")
    key = F.concat_ws("|", "client", F.format_number("window_start", 6))
    model = IsolationForest(numTrees=trees, seed=seed, keyCol="window_key", offset=0.0,
                            scoreCol="anomaly_score").fit(
        assemble.transform(baseline.withColumn("window_key", key)))
    return model.transform(assemble.transform(period)).drop("features")


def rank_windows(baseline: DataFrame, period: DataFrame, top: int = 5, seed: int = 42,
                 trees: int = 200) -> DataFrame:
    return top_windows(score_windows(baseline, period, seed, trees), top)
