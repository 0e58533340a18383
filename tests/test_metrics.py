import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import bootstrap as B
from tidewatch.operators import metrics as M
from tidewatch.operators import ranking as R


def frame(spark, y, s):
    return spark.createDataFrame(
        [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))],
        "row_id long, label int, score double")


def test_tied_scores_choose_the_silent_threshold(spark):
    df = frame(spark, [0, 0, 0, 1, 1], [0.5] * 5)
    best = M.choose_threshold(M.threshold_table(df), 0.05).first()
    assert best["threshold"] > 0.5 and best["fpr"] == 0


def test_auc_with_a_hot_score(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 600)
    s = np.where(rng.random(600) < 0.35, 0.5, rng.random(600) + 0.2 * y)
    got = M.evaluate(frame(spark, y, s), 0.6).first()
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert got["tp"] == int(((s >= 0.6) & (y == 1)).sum())
    grid = np.unique(s)
    ks = max(abs((neg <= t).mean() - (pos <= t).mean()) for t in grid)
    assert got["ks"] == pytest.approx(ks, abs=1e-12)


def test_no_alert_gives_zero_precision_and_one_class_is_null(spark):
    row = M.evaluate(frame(spark, [0, 0], [0.1, 0.2]), 0.9).first()
    assert row["precision"] == 0 and row["roc_auc"] is None and row["fnr"] is None


def test_quantile_threshold_by_definition(spark):
    rng = np.random.default_rng(5)
    y = (rng.random(400) < 0.3).astype(int)
    s = np.round(rng.normal(size=400) + 1.5 * y, 2)
    best = None
    for t in np.unique(np.quantile(s, np.linspace(0.01, 0.99, 400))):
        hit = s >= t
        tp, fp = (hit & (y == 1)).sum(), (hit & (y == 0)).sum()
        f1 = 2 * tp / (2 * tp + fp + (~hit & (y == 1)).sum())
        if fp / (y == 0).sum() <= 0.05 and (best is None or f1 > best[0] + 1e-15):
            best = (f1, t)
    assert M.quantile_threshold(frame(spark, y, s)).first()[0] == pytest.approx(best[1], abs=1e-9)


def test_bootstrap_is_seeded_and_brackets_the_estimate(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 200)
    df = frame(spark, y, rng.random(200) + 0.5 * y)
    a = B.bootstrap_ci(df, 0.7, 30, metrics=["roc_auc"]).first()
    b = B.bootstrap_ci(df.repartition(5), 0.7, 30, metrics=["roc_auc"]).first()
    assert a == b and a["low_95"] < a["estimate"] < a["high_95"] and a["replicates"] == 30
    weights = B.resample(df, 3).groupBy("rep").agg(F.sum("w").alias("n")).collect()
    assert [r["n"] for r in weights] == [200] * 3
    with pytest.raises(ValueError, match="no rows to draw from"):
        B.resample(df.limit(0), 3)


def every_order(p, n):
    """How often each D occurs over all orders of both samples."""
    import itertools
    out = []
    for places in itertools.combinations(range(p + n), p):
        i = np.cumsum(np.isin(np.arange(p + n), places))
        out.append(np.abs(i / p - (np.arange(1, p + n + 1) - i) / n).max())
    return np.array(out)


@pytest.mark.parametrize(("p", "n"), [(1, 1), (3, 3), (4, 6), (5, 3), (7, 2), (6, 6)])
def test_exact_ks_counts_orders(p, n):
    ds = every_order(p, n)
    for d in np.unique(np.round(ds, 12)):
        assert M.ks_exact(d, p, n) == pytest.approx((ds >= d - 1e-9).mean(), rel=1e-12)
    assert M.ks_exact(0.0, p, n) == 1.0


def test_exact_ks_by_sample_size(spark):
    """Small samples are counted, down to very small values; large ones follow the series."""
    separate = frame(spark, np.repeat([0, 1], 200), np.arange(400.0))
    got = M.evaluate(separate, 0.5).first()
    assert got["ks"] == 1.0
    # two of all orders separate the samples
    assert got["ks_pvalue"] == pytest.approx(2 / math.comb(400, 200), rel=1e-9)
    ks, p, n = 0.02, 9_000, 8_000
    lam = ks * math.sqrt(p * n / (p + n))
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert M.ks_exact(round(ks * 72_000) / 72_000, p, n) == pytest.approx(series, rel=0.05)
    row = spark.createDataFrame([(0.02, 20_000, 8_000)], "ks double, p long, n long").select(
        M.ks_pvalue(F.col("ks"), F.col("p"), F.col("n")).alias("v")).first()
    lam = 0.02 * math.sqrt(20_000 * 8_000 / 28_000)
    assert row["v"] == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam)
                                             for k in range(1, 101)))


def test_cell_counts_are_multinomial(spark):
    """Means, deviations and dependence of the drawn counts, for cells of very different size."""
    sizes = [3000, 500, 40, 8, 1, 1]
    rows = [(i % 2, float(i)) for i, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(rows, "label int, score double")
    reps, n = 1500, sum(sizes)
    w = np.zeros((reps, len(sizes)))
    for r in B.resample(df, reps).collect():
        w[r["rep"], int(r["score"])] = r["w"]
    assert (w.sum(axis=1) == n).all()
    p = np.array(sizes) / n
    deviation = np.sqrt(n * p * (1 - p))
    assert (np.abs(w.mean(axis=0) - n * p) < 4 * deviation / np.sqrt(reps)).all()
    assert w.std(axis=0) == pytest.approx(deviation, rel=0.1)
    assert np.corrcoef(w[:, 0], w[:, 1])[0, 1] == pytest.approx(
        -np.sqrt(p[0] * p[1] / ((1 - p[0]) * (1 - p[1]))), abs=0.1)


def test_intervals_equal_those_of_resampled_rows(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 600)
    s = np.round(rng.normal(size=600) + y, 1)
    draws = []
    for _ in range(2000):
        pick = rng.integers(0, 600, 600)
        hit = s[pick] >= 0.5
        draws.append([hit[y[pick] == 1].mean(), hit[y[pick] == 0].mean()])
    low, high = np.quantile(draws, [0.025, 0.975], axis=0)
    got = {r["metric"]: r for r in B.bootstrap_ci(frame(spark, y, s), 0.5, 800,
                                                  metrics=["recall", "fpr"]).collect()}
    for i, m in enumerate(("recall", "fpr")):
        assert got[m]["low_95"] == pytest.approx(low[i], abs=0.01)
        assert got[m]["high_95"] == pytest.approx(high[i], abs=0.01)


def test_prefix_sum_with_a_hot_value(spark):
    rows = [(i, 7 if i % 3 == 0 else i % 50, 1 + i % 4) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k long, v long")
    got = {r["id"]: r["c"] for r in R.prefix_sum(df, ["k", "id"], {"c": F.col("v")},
                                                 buckets=16).collect()}
    total = 0
    for i, _, v in sorted(rows, key=lambda r: (r[1], r[0])):
        total += v
        assert got[i] == total


def test_prefix_sum_restarts_per_group_and_keeps_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, 6)], "g string, k long")
    got = sorted((r["g"] or "", r["k"], r["c"], r["all"]) for r in R.prefix_sum(
        df, ["k"], {"c": F.col("k")}, group=["g"], totals={"all": "c"}).collect())
    assert got == [("", 5, 5, 11), ("", 6, 11, 11), ("a", 1, 1, 3), ("a", 2, 3, 3)]


def test_row_number_with_a_third_of_rows_tied(spark):
    rows = [(i, 0.5 if i % 3 == 0 else (i * 37 % 101) / 100) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, score double")
    got = {r["row_id"]: r["rn"] for r in R.global_row_number(df, "score", "row_id", "rn").collect()}
    want = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), 1)}
    assert got == want


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(11)
    x = np.where(rng.random(333) < 0.4, 1.0, rng.normal(size=333))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    row = R.exact_quantiles(df, ["x"], {"a": 0.05, "b": 0.5, "c": 0.95}).first()
    assert [row[c] for c in "abc"] == pytest.approx(list(np.quantile(x, [0.05, 0.5, 0.95])))
    probs = [i / 50 for i in range(51)]
    assert R.quantile_grid(df, "x", probs) == pytest.approx(list(np.quantile(x, probs)))


def test_replicates_are_lists_not_rows(spark, monkeypatch):
    """Replicates are summed from lists, with missing scores and labels and both labels of a score."""
    rows = [(None if i % 17 == 3 else int(i % 3 == 0), None if i % 29 == 5 else float(i % 11) / 10)
            for i in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    cuts = [-0.7, -0.3]
    want = {r["rep"]: r for r in M.evaluate(
        B.resample(df, 20), 0.5, ["rep"], True, weight=F.col("w"), cuts=cuts, pvalue=False).collect()}
    sums = B.replicate_sums(B.drawn(df, 20), 20, 0.5, True, cuts)
    for r in M.suite(sums, ["rep"], True).collect():
        for name in (*M.METRICS, "log_loss", "brier", "tp", "fp", "fn", "tn", "p", "n"):
            assert r[name] == pytest.approx(want[r["rep"]][name]), name
    monkeypatch.setattr(B, "resample", None)  # one row per draw is not made
    assert B.bootstrap_ci(df, 0.5, 20, metrics=["roc_auc"]).first()["replicates"] == 20
