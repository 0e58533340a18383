"""Models, scoring, cross-validation, persistence and attribution."""

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.operators import attribution as A
from tidewatch.operators import evidence as E
from tidewatch.operators import models as M
from tidewatch.operators.clean import clean_vectors, label_connections, stratified_kfold
from tidewatch.operators.clean import seeded_sample
from tidewatch.operators.iforest import score_boxes
from tidewatch.operators.metrics import evaluate
from tidewatch.plans.common import cum_sql, r6, rounded, suite_sql
from tidewatch.plans.data_queries import ranked_sql
from tidewatch.plans.rule_queries import baseline, period, windows_of
from tidewatch.plans.training import train
from tidewatch.plans.views import ctes, view
from tidewatch.session import scratch_path

# columns of the fixed linear scorer's rows; every fitted model takes the whole contract
RAW = ["duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "count",
       "srv_count", "serror_rate", "same_srv_rate", "num_outbound_cmds"]
THRESHOLD = 0.35
EXPLAINED = 200  # rows of a forest explained
REPORT_REPLICATES = 500
# a fixed linear scorer, exact in both engines
WEIGHTS = {"src_bytes": 0.0003, "duration": 0.05, "serror_rate": 0.16, "dst_bytes": -0.0002}


def rows(spark, d):
    """Clean, labelled connections under their contract names."""
    named = label_connections(view(spark, d, "conn").withColumnRenamed("conn_count", "count"))
    return clean_vectors(named, RAW, "row_id")


def rows41(spark, d):
    return label_connections(view(spark, d, "conn41"))


def fit_rows(spark, d):
    """Clean rows with all 41 columns of the contract."""
    return clean_vectors(rows41(spark, d), S.RAW_FEATURES, "row_id")


def q_iforest_fit(spark, d):
    return fitted(spark, d, "iforest")[1].stages[-1].node_table(spark)


def q_iforest_score(spark, d):
    return scored(spark, d, "iforest")


BOXES = [  # tree, leaf, feature, lo, hi, depth, n: three small trees
    (0, 0, "src_bytes", None, 400.0, 1, 180), (0, 1, "src_bytes", 400.0, 800.0, 2, 70),
    (0, 2, "src_bytes", 800.0, None, 2, 6),
    (1, 0, "duration", None, 0.5, 1, 200), (1, 1, "duration", 0.5, None, 2, 50),
    (1, 1, "serror_rate", None, 0.3, 2, 50), (1, 2, "duration", 0.5, None, 2, 6),
    (1, 2, "serror_rate", 0.3, None, 2, 6),
    (2, 0, "serror_rate", None, 0.1, 1, 90), (2, 1, "serror_rate", 0.1, 0.4, 2, 165),
    (2, 2, "serror_rate", 0.4, None, 2, 1),
]


def q_boxes(spark, d):
    boxes = spark.createDataFrame(
        BOXES, "tree int, leaf int, feature string, lo double, hi double, depth int, n long")
    return rounded(score_boxes(view(spark, d, "conn_scored").drop("score"), boxes, 256).select(
        "row_id", "score"))


def fitted(spark, d, kind, **options):
    data = fit_rows(spark, d)
    return data, M.DetectionPipeline(kind=kind, inputCols=S.RAW_FEATURES, **options).fit(data)


def scored(spark, d, kind):
    data, model = fitted(spark, d, kind)
    return M.score_with(model, data.select("row_id", "label", *S.RAW_FEATURES), kind).select(
        "row_id", "label", "score")


def q_logreg(spark, d):
    return scored(spark, d, "logreg")


def q_gbt(spark, d):
    return scored(spark, d, "gbt")


def q_pipeline(spark, d):
    data = rows41(spark, d)
    model = M.DetectionPipeline(kind="iforest").fit(data)
    out = model.transform(data)
    names = M.output_names(out)
    kept = set(M.selected_features(model))
    return spark.createDataFrame(
        [(i, n, n in kept) for i, n in enumerate(names)], "slot int, name string, selected boolean")


def linear(df):
    total = F.lit(0.1)
    for c, w in WEIGHTS.items():
        total = total + F.col(c).cast("double") * F.lit(w)
    return df.withColumn("score", total)


def q_predict(spark, d):
    return rounded(M.add_prediction(linear(rows(spark, d)), THRESHOLD).select(
        "row_id", "label", "attack_type", "score", "prediction"))


def q_predict_bundle(spark, d):
    """A saved bundle over the whole contract of 41 columns, loaded again and used to score."""
    data = rows41(spark, d)
    model = M.DetectionPipeline(kind="iforest", inputCols=S.RAW_FEATURES).fit(data)
    path = scratch_path(spark, "bundle")
    M.ModelBundle(model, "iforest", 0.05, list(S.RAW_FEATURES)).save(path)
    return rounded(M.ModelBundle.load(spark, path).predict(data))


def q_summary(spark, d):
    return M.inference_summary(M.add_prediction(linear(rows(spark, d)), THRESHOLD), "linear")


def q_cv(spark, d):
    return rounded(M.cross_validate(fit_rows(spark, d), "iforest", 5, inputCols=S.RAW_FEATURES))


def q_cv_summary(spark, d):
    folds = stratified_kfold(view(spark, d, "conn_scored"), "row_id", 5)
    per = evaluate(folds, THRESHOLD, ["fold"], pvalue=False)
    return rounded(M.cv_summary(per))


def q_save_load(spark, d):
    """Largest score difference and differing predictions between a model and its reload."""
    data, model = fitted(spark, d, "iforest")
    bundle = M.ModelBundle(model, "iforest", 0.05, list(S.RAW_FEATURES), {"rows": "normal only"})
    path = scratch_path(spark, "bundle")
    bundle.save(path)
    again = M.ModelBundle.load(spark, path)
    a = bundle.predict(data).select("row_id", "score", "prediction")
    b = again.predict(data).select("row_id", F.col("score").alias("s2"),
                                   F.col("prediction").alias("p2"))
    return a.join(b, "row_id").agg(
        F.count("*").alias("rows"), F.max(F.abs(F.col("score") - F.col("s2"))).alias("max_diff"),
        F.count_if(F.col("prediction") != F.col("p2")).alias("changed_predictions"))


def q_train(spark, d):
    """All tables of a report in long form: (part, item, metric, value)."""
    result = train(fit_rows(spark, d), list(S.RAW_FEATURES), iterations=REPORT_REPLICATES, rows_explained=EXPLAINED)
    parts = []
    for part, item, frame in (
            ("splits", F.col("split"), result["splits"]), ("report", F.col("split"), result["report"]),
            ("intervals", F.col("metric"), result["intervals"].withColumnRenamed("replicates", "n")),
            ("folds", F.col("fold").cast("string"), result["folds"]),
            ("cv", F.col("metric"), result["cv"]),
            ("importance", F.col("feature"), result["importance"])):
        named = frame.withColumn("__item", item)
        values = [c for c, t in frame.dtypes if t not in ("string",) and c != "fold"]
        parts.append(named.select(F.lit(part).alias("part"), F.col("__item").alias("item"),
                                  *[F.col(c).cast("double") for c in values]).unpivot(
            ["part", "item"], values, "metric", "value"))
    return rounded(reduce(lambda a, b: a.unionByName(b), parts))


def q_rank_windows(spark, d):
    from tidewatch.plans.behavior import rank_windows
    return rank_windows(windows_of(baseline(spark, d)), windows_of(period(spark, d)), top=5)


def attributions(spark, d):
    data = rows(spark, d)
    return A.linear_attribution(data, WEIGHTS, A.background_rows(data), intercept=0.1)


def q_linear(spark, d):
    return rounded(attributions(spark, d))


def q_tree(spark, d):
    data, model = fitted(spark, d, "iforest")
    sample = model.transform(seeded_sample(data, EXPLAINED, "row_id").repartition(8))
    return A.tree_attribution(model.stages[-1], sample, M.output_names(sample))


def q_boosted(spark, d):
    data, model = fitted(spark, d, "gbt")
    rows = PipelineModel(model.stages[:-1]).transform(data)
    return A.boosted_attribution(model.stages[-1], rows, M.output_names(rows))


def q_fitted_linear(spark, d):
    data, model = fitted(spark, d, "logreg")
    out = model.transform(data)
    return A.fitted_linear_attribution(model.stages[-1], out, A.background_rows(out),
                                       M.output_names(out))


def q_importance(spark, d):
    return rounded(A.importance(attributions(spark, d)))


QUERIES = {
    "iforest_fit": q_iforest_fit,
    "iforest_score": q_iforest_score,
    "forest_score_boxes": q_boxes,
    "logreg_fit": q_logreg,
    "gbt_fit": q_gbt,
    "feature_pipeline": q_pipeline,
    "predict_table": q_predict,
    "predict_bundle": q_predict_bundle,
    "inference_summary": q_summary,
    "cross_validate": q_cv,
    "cross_validate_summary": q_cv_summary,
    "save_load_model": q_save_load,
    "train_report": q_train,
    "window_anomaly_rank": q_rank_windows,
    "linear_attribution": q_linear,
    "tree_attribution": q_tree,
    "boosted_attribution": q_boosted,
    "fitted_linear_attribution": q_fitted_linear,
    "mean_abs_importance": q_importance,
}

VEC = ", ".join(c if c != "count" else "conn_count" for c in RAW)
ROWS = f"""{ctes('conn')}, lab AS (SELECT * EXCLUDE (attack_type), rtrim(attack_type, '.') AS attack_type,
 CAST(CASE WHEN rtrim(attack_type, '.') <> 'normal' THEN 1 ELSE 0 END AS TINYINT) AS label FROM conn),
rws AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {VEC} ORDER BY row_id) AS rn,
  min(label) OVER (PARTITION BY {VEC}) AS lo, max(label) OVER (PARTITION BY {VEC}) AS hi FROM lab) q
  WHERE rn = 1 AND lo = hi)"""
LINEAR = "0.1::DOUBLE + " + " + ".join(f"CAST({c} AS DOUBLE) * ({w})::DOUBLE"
                                       for c, w in WEIGHTS.items())


def _c_sql(n: str) -> str:
    return (f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln({n} - 1) + "
            f"0.5772156649015329::DOUBLE) - 2 * ({n} - 1)::DOUBLE / {n} END")


def _box_case(tree: int) -> str:
    leaves: dict[int, list] = {}
    for t, leaf, *rest in BOXES:
        if t == tree:
            leaves.setdefault(leaf, []).append(rest)
    whens = []
    for parts in leaves.values():
        cond = " AND ".join(
            f"{f} > {'-1e300' if lo is None else lo} AND {f} <= {'1e300' if hi is None else hi}"
            for f, lo, hi, _, _ in parts)
        depth, n = parts[0][3], parts[0][4]
        whens.append(f"WHEN {cond} THEN {depth} + {_c_sql(f'{n}::DOUBLE')}")
    return "CASE " + " ".join(whens) + " END"


ATTR = f"""{ROWS}, bg AS (SELECT {', '.join(f'avg({c}) AS m_{c}' for c in WEIGHTS)}
  FROM ({ranked_sql('rws', 42, False)}) q WHERE rk <= 100),
attr AS (""" + " UNION ALL ".join(
    f"""SELECT row_id, '{c}' AS feature, ({w})::DOUBLE * ({c} - m_{c}) AS attribution,
  0.1::DOUBLE + {' + '.join(f'({v})::DOUBLE * m_{k}' for k, v in WEIGHTS.items())} AS base
  FROM rws, bg""" for c, w in WEIGHTS.items()) + ")"

ORACLES = {
    "forest_score_boxes": f"""WITH {ctes('conn_scored')} SELECT row_id,
 {r6(f"pow(2, -(({' + '.join(_box_case(t) for t in range(3))}) / 3) / ({_c_sql('256::DOUBLE')})) - 0.5",
     'score')} FROM conn_scored""",
    "predict_table": f"""WITH {ROWS} SELECT row_id, label, attack_type, {r6(LINEAR, 'score')},
 CAST({LINEAR} >= {THRESHOLD} AS INT) AS prediction FROM rws""",
    "inference_summary": f"""WITH {ROWS} SELECT 'linear' AS kind, count(*) AS rows,
 count(*) FILTER ({LINEAR} >= {THRESHOLD}) AS alerts FROM rws""",
    "cross_validate_summary": f"""WITH {ctes('conn_scored')}, folds AS (SELECT *, (rk * 5 + size - 1) // size AS fold
  FROM ({ranked_sql('conn_scored', 42)}) q), {cum_sql('folds', 'fold')},
per AS ({suite_sql('cum', str(THRESHOLD), 'fold')}) """ + " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, {r6(f'avg({m})', 'mean')}, {r6(f'stddev_samp({m})', 'std')},
 {r6(f'min({m})', 'min')}, {r6(f'max({m})', 'max')} FROM per"""
        for m in ("roc_auc", "average_precision")),
    "linear_attribution": f"""WITH {ATTR} SELECT row_id, feature, {r6('attribution', 'attribution')},
 {r6('base', 'base')} FROM attr""",
    "mean_abs_importance": f"""WITH {ATTR} SELECT feature, {r6('avg(abs(attribution))', 'mean_abs')}
 FROM attr GROUP BY 1""",
}
