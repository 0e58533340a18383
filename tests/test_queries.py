"""Every registered query against its SQL twin (smallest data)."""

import bisect
import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


# its statement has the asymptotic p-value, which the operator takes for larger samples only
@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"ks_statistic"}))
def test_oracle(spark, con, name):
    problems = [p for p in compare(entry.queries()[name](spark, SF), con, ORACLES[name])
                if p != "empty result"]
    assert not problems


def rows_of(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_ks_statement_and_exact_value(spark, con):
    from tidewatch.operators import metrics as M
    (row,) = rows_of(spark, "ks_statistic")
    ks, asymptotic = con.execute(
        f"SELECT ks, ks_pvalue FROM ({ORACLES['ks_statistic']}) q").fetchone()
    from tidewatch.plans.views import view
    p, n = view(spark, SF, "scored").selectExpr("count_if(label = 1)", "count_if(label = 0)").first()
    assert row["ks"] == ks
    want = M.ks_exact(ks, p, n) if max(p, n) <= M.EXACT_KS else asymptotic
    assert row["ks_pvalue"] == pytest.approx(want, abs=1e-6)


def test_file_digests(spark):
    """The written files are unknown, so the statement is about all but the one given as wrong."""
    rows = rows_of(spark, "file_digest")
    assert len(rows) > 1 and [r["matches"] for r in rows].count(False) == 1
    assert all(len(r["actual"]) == 64 and r["matches"] == (r["actual"] == r["expected"]) for r in rows)


def test_pca_equals_numpy(spark):
    import numpy as np
    from tidewatch.plans.data_queries import clean_rows
    cols = ["src_bytes", "dst_bytes", "duration", "conn_count", "serror_rate"]
    pdf = clean_rows(spark, SF).select("row_id", "label", *cols).toPandas()
    x = pdf[cols].to_numpy(dtype=float)
    normal = (pdf["label"] == 0).to_numpy()
    spread = x[normal].std(axis=0)
    x = (x - x[normal].mean(axis=0)) / np.where(spread > 0, spread, 1)
    centre = x[normal].mean(axis=0)
    _, size, axes = np.linalg.svd(x[normal] - centre, full_matrices=False)
    axes = axes[:2] * np.sign([a[np.abs(a).argmax()] for a in axes[:2]])[:, None]
    want = dict(zip(pdf["row_id"], (x - centre) @ axes.T, strict=True))
    share = size**2 / (size**2).sum()
    rows = rows_of(spark, "pca_projection")
    assert len(rows) == len(want)
    for r in rows:
        assert (r["pc1"], r["pc2"]) == pytest.approx(tuple(want[r["row_id"]]), abs=2e-6)
        assert (r["pc1_ratio"], r["pc2_ratio"]) == pytest.approx(tuple(share[:2]), abs=2e-6)


def test_routing_follows_the_schema(spark):
    from tidewatch import schemas as S
    from tidewatch.operators.select import select_columns
    from tidewatch.plans.data_queries import labelled
    from tidewatch.plans.feature_queries import NUMERIC
    kept, _, _ = select_columns(labelled(spark, SF), [*S.CATEGORICAL, *NUMERIC])
    assert {r["feature"]: r["route"] for r in rows_of(spark, "column_routing")} == {
        c: "categorical" if c in S.CATEGORICAL else "numeric" for c in kept}


def walked(nodes, vectors, psi):
    """Mean path length and score of each vector, node by node."""
    import numpy as np
    from tidewatch.operators.iforest import expected_path
    trees = [t.set_index("node").to_dict("index") for _, t in nodes.groupby("tree")]
    out = []
    for x in vectors:
        paths = []
        for at in trees:
            node = 0
            while at[node]["left"] != node:
                n = at[node]
                node = n["left"] if x[n["feature"]] <= n["threshold"] else n["right"]
            paths.append(at[node]["depth"] + float(expected_path(at[node]["n"])))
        out.append(2 ** (-np.mean(paths) / float(expected_path(psi))))
    return out


def test_forest_scores_by_a_walk(spark):
    from tidewatch.plans import model_queries as Q
    data, model = Q.fitted(spark, SF, "iforest")
    forest = model.stages[-1]
    sample = model.transform(data).select("row_id", "features").orderBy("row_id").limit(40).collect()
    want = walked(forest.nodes, [r["features"].toArray() for r in sample],
                  forest.getOrDefault(forest.psi))
    got = {r["row_id"]: r["score"] for r in rows_of(spark, "iforest_score")}
    assert len(got) == data.count()
    assert [got[r["row_id"]] for r in sample] == pytest.approx([w - 0.5 for w in want], abs=1e-9)


def test_ranked_windows_are_the_highest(spark):
    from tidewatch.plans.behavior import score_windows
    from tidewatch.plans.rule_queries import baseline, period, windows_of
    every = score_windows(windows_of(baseline(spark, SF)), windows_of(period(spark, SF))).collect()
    assert all(0 < r["anomaly_score"] < 1 for r in every)
    best = sorted((r["anomaly_score"] for r in every), reverse=True)
    rows = rows_of(spark, "window_anomaly_rank")
    assert [r["anomaly_score"] for r in rows] == pytest.approx(best[:len(rows)]) and rows


def test_forest_has_all_trees(spark):
    nodes = rows_of(spark, "iforest_fit")
    assert {r["tree"] for r in nodes} == set(range(300))


@pytest.mark.parametrize("name", ["logreg_fit", "gbt_fit"])
def test_fitted_scores_rank_attacks_first(spark, name):
    rows = rows_of(spark, name)
    assert all(0 <= r["score"] <= 1 for r in rows)
    positive = [r["score"] for r in rows if r["label"] == 1]
    negative = sorted(r["score"] for r in rows if r["label"] == 0)
    wins = sum(bisect.bisect_left(negative, s) for s in positive)
    assert wins / (len(positive) * len(negative)) > 0.7


def test_selector_over_all_columns(spark):
    report = rows_of(spark, "correlation_selector_all")
    removed = {r["removed"] for r in report}
    assert all(r["retained"] not in removed for r in report)
    assert all(abs(r["correlation"]) >= 0.9 for r in report if r["reason"] == "Spearman")


def test_pipeline_slots(spark):
    rows = rows_of(spark, "feature_pipeline")
    assert [r["slot"] for r in rows] == list(range(len(rows))) and any(r["selected"] for r in rows)


def test_saved_models_score_alike(spark):
    (row,) = rows_of(spark, "save_load_model")
    assert row["rows"] > 0 and row["max_diff"] < 1e-12 and row["changed_predictions"] == 0
    scored = rows_of(spark, "predict_bundle")
    assert scored and all(r["prediction"] == int(r["score"] >= 0.05) for r in scored)


def test_folds_and_report(spark):
    assert [r["fold"] for r in rows_of(spark, "cross_validate")] == [1, 2, 3, 4, 5]
    parts = {}
    for r in rows_of(spark, "train_report"):
        parts.setdefault(r["part"], {})[r["item"], r["metric"]] = r["value"]
    assert set(parts) == {"splits", "report", "intervals", "folds", "cv", "importance"}
    for (item, metric), value in parts["intervals"].items():
        if metric == "low_95":
            assert value <= parts["intervals"][item, "high_95"]


def test_attributions_add_up(spark):
    sums, length = {}, {}
    for r in rows_of(spark, "tree_attribution"):
        sums[r["row_id"]] = sums.get(r["row_id"], r["base"]) + r["attribution"]
        length[r["row_id"]] = r["path_length"]
    assert len(sums) == min(200, len(sums)) and sums == pytest.approx(length)


def test_boosted_attributions_add_up(spark):
    sums, margin = {}, {}
    for r in rows_of(spark, "boosted_attribution"):
        sums[r["row_id"]] = sums.get(r["row_id"], r["base"]) + r["attribution"]
        margin[r["row_id"]] = r["margin"]
    assert sums and sums == pytest.approx(margin)


def test_fitted_linear_attributions_add_up(spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F
    from tidewatch.plans import model_queries as Q
    got = entry.queries()["fitted_linear_attribution"](spark, SF).groupBy("row_id").agg(
        (F.first("base") + F.sum("attribution")).alias("m"))
    data, model = Q.fitted(spark, SF, "logreg")
    want = model.transform(data).select("row_id", vector_to_array("rawPrediction")[1].alias("raw"))
    assert got.join(want, "row_id").where(F.abs(F.col("m") - F.col("raw")) > 1e-6).isEmpty()
    assert got.count() == data.count()


def test_detection_stream_equals_batch(spark):
    from tidewatch.operators import windows as WN
    from tidewatch.plans.telemetry_queries import LIVE
    from tidewatch.plans.views import view
    from tidewatch.schemas import LIVE_FEATURES
    logs = WN.merge_sources(view(spark, SF, "dns_log"), view(spark, SF, "http_log"), ["orig_p"])
    batch = WN.live_features(logs, LIVE, ["orig_p"]).where("event_id IS NOT NULL").collect()
    rows = rows_of(spark, "detect_stream")
    plain = lambda r: (r["event_id"], *[v if isinstance(v, str) else round(float(v), 9)
                                        for v in (r[c] for c in LIVE_FEATURES)])
    assert sorted(map(plain, rows)) == sorted(map(plain, batch))
    assert all(r["prediction"] == int(r["score"] >= r["threshold"]) for r in rows)
