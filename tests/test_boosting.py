"""Boosted trees of one barrier stage against Spark's own, and attributions of all rows."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from tidewatch.operators import attribution as A
from tidewatch.operators.boosting import BoostedTrees

SETTINGS = dict(maxDepth=4, stepSize=0.08, seed=42, labelCol="label")


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    data = [(i, "abcdefg"[rng.integers(7)], float(rng.normal()), float(rng.integers(4)), 1.0)
            for i in range(700)]
    data = [(*r, int((r[1] in "bdf") != (r[2] + 0.3 * r[3] > 0.4) if rng.random() < 0.9 else r[0] % 2))
            for r in data]
    df = spark.createDataFrame(data, "row_id long, kind string, x double, y double, flat double, label int")
    df = StringIndexer(inputCols=["kind"], outputCols=["kind_idx"], handleInvalid="keep",
                       stringOrderType="alphabetAsc").fit(df).transform(df.repartition(3, "row_id"))
    return VectorAssembler(inputCols=["kind_idx", "x", "y", "flat"], outputCol="features").transform(
        df).select("row_id", "features", "label").cache()


def margins(model, df):
    return {r["row_id"]: r["m"] for r in model.transform(df).select(
        "row_id", vector_to_array("rawPrediction")[1].alias("m")).collect()}


def test_trees_are_those_of_spark(spark, vectors, tmp_path):
    ours = BoostedTrees(maxIter=8, **SETTINGS).fit(vectors)
    theirs = GBTClassifier(maxIter=8, **SETTINGS).fit(vectors)
    assert margins(ours, vectors) == pytest.approx(margins(theirs, vectors), abs=1e-9)
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees]
    assert ours.treeWeights == theirs.treeWeights and ours.getMaxDepth() == 4
    ours.write().save(str(tmp_path / "m"))
    assert margins(GBTClassificationModel.load(str(tmp_path / "m")), vectors) == margins(ours, vectors)
    with pytest.raises(Exception, match="(?i)label"):
        BoostedTrees(maxIter=2, **SETTINGS).fit(vectors.withColumn("label", F.lit(3)))


def test_jobs_do_not_grow_with_the_trees(spark, vectors):
    def jobs(n):
        spark.sparkContext.setJobGroup(f"boost-{n}", "count the jobs")
        BoostedTrees(maxIter=n, **SETTINGS).fit(vectors)
        found = spark.sparkContext.statusTracker().getJobIdsForGroup(f"boost-{n}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(found)

    jobs(2)  # the first reads of the cached rows
    assert jobs(12) <= jobs(3)


def test_columns_without_a_split(spark):
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(20).select(F.lit(1.0).alias("x"), (F.col("id") % 2).cast("int").alias("label")))
    assert BoostedTrees(maxIter=2, **SETTINGS).fit(df).trees[0].numNodes == 1


def test_patterns_equal_polynomials(spark, vectors, monkeypatch):
    nodes = A.boosted_nodes(BoostedTrees(maxIter=6, **SETTINGS).fit(vectors))
    paths = A.PathAttribution(nodes, 4)
    x = np.array([r["x"] for r in vectors.select(vector_to_array("features").alias("x")).collect()])
    x[0, 0] = 50.0  # a category of no set
    for block, kept in ((1 << 17, 1 << 24), (40, 0)):
        monkeypatch.setattr(A.PatternAttribution, "BLOCK", block)
        monkeypatch.setattr(A.PatternAttribution, "KEPT", kept)
        parts, margin = A.PatternAttribution(paths).explain(x)
        assert parts == pytest.approx(paths.explain(x), abs=1e-9)
        assert margin == pytest.approx(paths.margin(x), abs=1e-9)


def test_every_row_is_attributed(spark, vectors, monkeypatch):
    from pyspark.ml import PipelineModel
    from tidewatch.plans import model_queries as Q
    model = PipelineModel(stages=[BoostedTrees(maxIter=3, **SETTINGS).fit(vectors)])
    monkeypatch.setattr(Q, "fitted", lambda *_, **__: (vectors, model))
    got = Q.q_boosted(spark, None).groupBy("row_id").agg(
        F.count("*").alias("n"), (F.first("base") + F.sum("attribution") - F.first("margin")).alias("off"))
    rows = got.collect()
    assert {r["row_id"] for r in rows} == set(range(700))
    assert all(r["n"] == 4 and abs(r["off"]) < 1e-9 for r in rows)
