"""Attributions of fitted models against the definition of Shapley values."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from tidewatch.operators import attribution as A

NAMES = ["kind_idx", "x", "y"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    data = []
    for i in range(600):
        kind, x, y = "abcdefg"[rng.integers(7)], float(rng.normal()), float(rng.integers(4))
        label = float((kind in "bdf") != (x + 0.3 * y > 0.4) if rng.random() < 0.9 else i % 2)
        data.append((i, kind, x, y, label))
    df = spark.createDataFrame(data, "row_id long, kind string, x double, y double, label double")
    indexed = StringIndexer(inputCol="kind", outputCol="kind_idx", handleInvalid="keep").fit(
        df).transform(df)
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(indexed).cache()


def expectation(at, node, row, known):
    """A tree's value if only the known features of the row are seen."""
    n = at[node]
    if n["left"] == node:
        return n["value"]
    f = int(n["feature"])
    if f in known:
        go = (int(row[f]) in n["categories"] if n["categories"] is not None
              else row[f] <= n["threshold"])
        return expectation(at, int(n["left"] if go else n["right"]), row, known)
    return sum(at[int(n[c])]["n"] / n["n"] * expectation(at, int(n[c]), row, known)
               for c in ("left", "right"))


def shapley(trees, row, width):
    out = np.zeros(width)
    value = {s: sum(expectation(at, 0, row, s) for at in trees) for k in range(width + 1)
             for s in map(frozenset, itertools.combinations(range(width), k))}
    for f in range(width):
        for s, v in value.items():
            if f not in s:
                weight = math.factorial(len(s)) * math.factorial(width - len(s) - 1) / math.factorial(width)
                out[f] += weight * (value[s | {f}] - v)
    return out


def test_boosted_trees_by_definition(spark, rows):
    model = GBTClassifier(maxIter=6, maxDepth=4, seed=1, labelCol="label").fit(rows)
    nodes = A.boosted_nodes(model)
    assert nodes["categories"].notna().any() and nodes["threshold"].notna().any()
    trees = [t.set_index("node").to_dict("index") for _, t in nodes.groupby("tree")]
    sample = rows.where("row_id % 29 = 0")
    margins = {r["row_id"]: r["m"] for r in model.transform(sample).select(
        "row_id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    got = A.boosted_attribution(model, sample, NAMES).toPandas()
    vectors = {r["row_id"]: r["features"].toArray() for r in sample.collect()}
    assert set(got["row_id"]) == set(vectors)
    for row_id, part in got.groupby("row_id"):
        values = part.set_index("feature")["attribution"][NAMES].to_numpy()
        assert values == pytest.approx(shapley(trees, vectors[row_id], 3), abs=1e-9)
        assert part["base"].iloc[0] + values.sum() == pytest.approx(margins[row_id])
        assert part["margin"].iloc[0] == pytest.approx(margins[row_id])


def test_fitted_linear_model(spark, rows):
    model = LogisticRegression(regParam=0.01).fit(rows)
    got = A.fitted_linear_attribution(model, rows, rows.where("row_id % 3 = 0"), NAMES)
    per = {r["row_id"]: r["m"] for r in got.groupBy("row_id").agg(
        (F.first("base") + F.sum("attribution")).alias("m")).collect()}
    margins = {r["row_id"]: r["m"] for r in model.transform(rows).select(
        "row_id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    assert per == pytest.approx(margins)
    mean = got.where("row_id % 3 = 0").groupBy("feature").agg(F.avg("attribution").alias("a"))
    assert [r["a"] for r in mean.collect()] == pytest.approx([0, 0, 0], abs=1e-9)
    with pytest.raises(ValueError, match="names for"):
        A.fitted_linear_attribution(model, rows, rows, ["x"])
