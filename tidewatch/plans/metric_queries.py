"""Thresholds, curves, metric suite, slices and intervals over scored rows."""

from pyspark.sql import functions as F

from tidewatch.operators import bootstrap as B
from tidewatch.operators import metrics as M
from tidewatch.plans.common import RATES_SQL, cum_sql, r6, rounded, suite_sql
from tidewatch.plans.views import ctes, view

THRESHOLD = 0.62  # for `scored`
CONN_THRESHOLD = 0.35  # for `conn_scored`
REPLICATES = 500
EDGES = [-0.5, -0.25, -0.1, 0, 0.05, 0.1, 0.2, 0.4, 0.8, 2.0]  # fixed values: bucket bounds


def scored(spark, d):
    return view(spark, d, "scored")


def conn(spark, d):
    return view(spark, d, "conn_scored")


def by_split(spark, d):
    """Two score columns as two models, three splits by row number."""
    rows = conn(spark, d).withColumn("split", F.element_at(
        F.array(F.lit("test"), F.lit("train"), F.lit("validation")),
        (F.col("row_id") % 3 + 1).cast("int")))
    one = rows.select(F.lit("linear").alias("model"), "split", "label", "score")
    two = rows.select(F.lit("bytes").alias("model"), "split", "label",
                      (F.col("src_bytes").cast("double") / 1700).alias("score"))
    return one.unionByName(two)


BY_SPLIT = f"""{ctes('conn_scored')}, sp AS (SELECT *, CASE row_id % 3 WHEN 0 THEN 'test'
  WHEN 1 THEN 'train' ELSE 'validation' END AS split FROM conn_scored),
by_split AS (SELECT 'linear' AS model, split, label, score FROM sp UNION ALL
  SELECT 'bytes', split, label, CAST(src_bytes AS DOUBLE) / 1700 FROM sp)"""


def q_threshold_table(spark, d):
    return rounded(M.threshold_table(scored(spark, d)), 6)


def q_choose(spark, d):
    return rounded(M.choose_threshold(M.threshold_table(scored(spark, d))))


def q_quantile(spark, d):
    return rounded(M.quantile_threshold(conn(spark, d)))


def q_confusion(spark, d):
    return rounded(M.row_normalised(M.confusion_matrix(scored(spark, d), THRESHOLD)))


def q_metrics(spark, d):
    m = M.confusion_matrix(scored(spark, d), THRESHOLD)
    rates = M.confusion_rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return rounded(m.select(*[e.alias(k) for k, e in rates.items()], "tn", "fp", "fn", "tp"))


def q_auc(spark, d):
    return rounded(M.evaluate(scored(spark, d), THRESHOLD).select("roc_auc", "gini"))


def q_ap(spark, d):
    return rounded(M.evaluate(scored(spark, d), THRESHOLD).select("average_precision"))


def q_ks(spark, d):
    return rounded(M.evaluate(scored(spark, d), THRESHOLD).select(
        "ks", "ks_pvalue"))


def q_losses(spark, d):
    return rounded(M.prob_losses(scored(spark, d).withColumn("score", F.col("score") / 1.3)))


def q_roc(spark, d):
    """All points, the origin with a null score included."""
    return rounded(M.roc_curve(by_split(spark, d), ["model", "split"]).withColumn(
        "score", F.when(F.col("score") < float("inf"), F.col("score"))))


def q_pr(spark, d):
    return rounded(M.pr_curve(by_split(spark, d), ["model", "split"]))


def q_report(spark, d):
    return rounded(M.classification_report(scored(spark, d), THRESHOLD))


def q_by_split(spark, d):
    return rounded(M.evaluate(by_split(spark, d), 0.35, ["model", "split"], True).drop(
        "ks_pvalue", "p", "n"))


BOOT = ["roc_auc", "average_precision", "precision", "recall", "f1", "fpr", "ks"]


def q_bootstrap(spark, d):
    return rounded(B.bootstrap_ci(conn(spark, d), CONN_THRESHOLD, REPLICATES, metrics=BOOT))


def q_attack_recall(spark, d):
    return rounded(M.recall_by(conn(spark, d), "attack_type", CONN_THRESHOLD))


def q_segments(spark, d):
    return rounded(M.segment_metrics(scored(spark, d), ["protocol_type", "service"], THRESHOLD))


def q_errors(spark, d):
    return M.misclassified_rows(conn(spark, d), CONN_THRESHOLD).select(
        "row_id", "protocol_type", "service", "attack_type", "label", "prediction", "score",
        "src_bytes", "dst_bytes")


def q_outcomes(spark, d):
    return M.outcome_representatives(conn(spark, d), CONN_THRESHOLD).select(
        "outcome", "present", "row_id", "label", "score")


def q_histogram(spark, d):
    return M.score_histogram(view(spark, d, "predictions"), EDGES)


QUERIES = {
    "threshold_table": q_threshold_table,
    "choose_threshold": q_choose,
    "quantile_threshold": q_quantile,
    "confusion_matrix": q_confusion,
    "classification_metrics": q_metrics,
    "roc_auc": q_auc,
    "average_precision": q_ap,
    "ks_statistic": q_ks,
    "log_loss_brier": q_losses,
    "roc_curve": q_roc,
    "pr_curve": q_pr,
    "classification_report": q_report,
    "evaluate_by_split": q_by_split,
    "bootstrap_ci": q_bootstrap,
    "attack_type_recall": q_attack_recall,
    "segment_metrics": q_segments,
    "misclassified_rows": q_errors,
    "outcome_representatives": q_outcomes,
    "score_histogram": q_histogram,
}

SCORED = f"{ctes('scored')}, {cum_sql('scored')}"
TABLE = f"""{SCORED}, tt AS (SELECT score AS threshold, tp / (tp + fp) AS precision, tp / p AS recall,
  2 * (tp / (tp + fp)) * (tp / p) / greatest(tp / (tp + fp) + tp / p, 1e-15::DOUBLE) AS f1,
  fp / n AS fpr FROM cum
 UNION ALL SELECT nextafter(max(score), 'Infinity'::DOUBLE), 0, 0, 0, 0 FROM cum)"""
R5 = ", ".join(r6(c, c) for c in ("threshold", "precision", "recall", "f1", "fpr"))
SUITE = f"{SCORED}, suite AS ({suite_sql('cum', str(THRESHOLD))})"
COUNTS = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("tn", "fp", "fn", "tp"))
RATES = ", ".join(r6(e, k) for k, e in RATES_SQL.items())


def _loss(prob: str = "score") -> tuple[str, str]:
    p = f"greatest(2.220446049250313e-16, least({prob}, 1 - 2.220446049250313e-16::DOUBLE))"
    return (f"-avg(label * ln({p}) + (1 - label) * ln(1 - {p}))",
            f"avg(({prob} - label) * ({prob} - label))")


LL, BRIER = _loss("(score / 1.3::DOUBLE)")
LL_S, BRIER_S = _loss("score")
CONN = ctes("conn_scored")
PRED = f"CAST(score >= {CONN_THRESHOLD} AS INT)"


def _report_sql() -> str:
    p1, r1 = "tp / (tp + fp)", "tp / (tp + fn)"
    p0, r0 = "tn / (tn + fn)", "tn / (tn + fp)"
    f1, f0 = "2 * tp / (2 * tp + fp + fn)", "2 * tn / (2 * tn + fp + fn)"
    acc = "(tp + tn) / (p + n)"
    lines = [("normal", p0, r0, f0, "n"), ("attack", p1, r1, f1, "p"),
             ("accuracy", acc, acc, acc, "p + n"),
             ("macro avg", *[f"({a} + {b}) / 2" for a, b in ((p0, p1), (r0, r1), (f0, f1))], "p + n"),
             ("weighted avg", *[f"({a} * n + {b} * p) / (p + n)"
                                for a, b in ((p0, p1), (r0, r1), (f0, f1))], "p + n")]
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS class, {r6(a, 'precision')}, {r6(b, 'recall')}, {r6(c, 'f1')}, "
        f"CAST({s} AS BIGINT) AS support FROM suite" for name, a, b, c, s in lines)


QT = f"""{CONN}, cand AS (SELECT DISTINCT t AS threshold FROM (SELECT unnest(quantile_cont(score,
  list_transform(range(400), lambda i: 0.01::DOUBLE + 0.98::DOUBLE * i / 399))) AS t FROM conn_scored) q),
judged AS (SELECT threshold, sum(label) FILTER (score >= threshold) AS tp,
  sum(1 - label) FILTER (score >= threshold) AS fp, sum(label) AS p, sum(1 - label) AS n
  FROM cand, conn_scored GROUP BY threshold),
best AS (SELECT threshold FROM judged WHERE fp / greatest(n, 1) <= 0.05
  ORDER BY 2.0::DOUBLE * tp / (tp + fp + p) DESC, threshold LIMIT 1)"""

ORACLES = {
    "threshold_table": f"WITH {TABLE} SELECT {R5} FROM tt",
    "choose_threshold": f"""WITH {TABLE} SELECT {R5} FROM tt WHERE fpr <= 0.05
 ORDER BY f1 DESC, fpr, threshold LIMIT 1""",
    "quantile_threshold": f"""WITH {QT} SELECT {r6('''coalesce((SELECT threshold FROM best),
  (SELECT quantile_cont(score, 0.95) FROM conn_scored WHERE label = 0))''', 'threshold')}""",
    "confusion_matrix": f"""WITH {SUITE} SELECT {COUNTS}, {r6('tn / n', 'tn_share')},
 {r6('fp / n', 'fp_share')}, {r6('fn / p', 'fn_share')}, {r6('tp / p', 'tp_share')} FROM suite""",
    "classification_metrics": f"WITH {SUITE} SELECT {COUNTS}, {RATES} FROM suite",
    "roc_auc": f"WITH {SUITE} SELECT {r6('roc_auc', 'roc_auc')}, {r6('2 * roc_auc - 1', 'gini')} FROM suite",
    "average_precision": f"WITH {SUITE} SELECT {r6('average_precision', 'average_precision')} FROM suite",
    "ks_statistic": f"""WITH {SUITE}, l AS (SELECT ks, ks * sqrt(p * n / (p + n)) AS lam FROM suite)
 SELECT {r6('ks', 'ks')}, {r6("""CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
 list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END)::DOUBLE
 * exp(-2.0 * k * k * lam * lam))))) END""", 'ks_pvalue')} FROM l""",
    "log_loss_brier": f"""WITH {ctes('scored')} SELECT {r6(LL, 'log_loss')}, {r6(BRIER, 'brier')}
 FROM scored""",
    "roc_curve": f"""WITH {BY_SPLIT}, {cum_sql('by_split', 'model, split')} SELECT model, split,
 {r6('score', 'score')}, {r6('fp / n', 'fpr')}, {r6('tp / p', 'tpr')} FROM cum
 UNION ALL SELECT DISTINCT model, split, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM by_split""",
    "pr_curve": f"""WITH {BY_SPLIT}, {cum_sql('by_split', 'model, split')} SELECT model, split,
 {r6('score', 'score')}, {r6('tp / (tp + fp)', 'precision')}, {r6('tp / p', 'recall')} FROM cum
 UNION ALL SELECT DISTINCT model, split, NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM by_split""",
    "classification_report": f"WITH {SUITE} {_report_sql()}",
    "evaluate_by_split": f"""WITH {BY_SPLIT}, {cum_sql('by_split', 'model, split')},
suite AS ({suite_sql('cum', '0.35', 'model, split')}),
loss AS (SELECT model, split, {LL_S} AS ll, {BRIER_S} AS br FROM by_split GROUP BY 1, 2)
SELECT model, split, {r6('roc_auc', 'roc_auc')}, {r6('average_precision', 'average_precision')},
 {r6('2 * roc_auc - 1', 'gini')}, {r6('ks', 'ks')}, {RATES}, {r6('ll', 'log_loss')},
 {r6('br', 'brier')}, {COUNTS} FROM suite JOIN loss USING (model, split)""",
    "attack_type_recall": f"""WITH {CONN} SELECT attack_type, count(*) AS n,
 count(*) FILTER ({PRED} = 1) AS detected, count(*) FILTER ({PRED} = 0) AS missed,
 {r6(f'avg({PRED})', 'recall')} FROM conn_scored WHERE label = 1 GROUP BY 1""",
    "segment_metrics": f"""WITH {ctes('scored')}, long AS (
 SELECT 'protocol_type' AS "column", protocol_type AS segment, label, score FROM scored
 UNION ALL SELECT 'service', service, label, score FROM scored)
SELECT "column", segment, count(*) AS n, count(*) FILTER (label = 0) AS normal_n,
 count(*) FILTER (label = 1) AS attack_n,
 {r6(f'avg(CAST(score >= {THRESHOLD} AS INT)) FILTER (label = 0)', 'fpr')},
 {r6(f'avg(CAST(score >= {THRESHOLD} AS INT)) FILTER (label = 1)', 'recall')}
 FROM long GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 25""",
    "misclassified_rows": f"""WITH {CONN} SELECT row_id, protocol_type, service, attack_type, label,
 {PRED} AS prediction, score, src_bytes, dst_bytes FROM conn_scored WHERE label <> {PRED}
 ORDER BY row_id LIMIT 12""",
    "outcome_representatives": f"""WITH {CONN}, o AS (SELECT *, CASE
 WHEN label = 1 AND {PRED} = 1 THEN 'TP' WHEN label = 0 AND {PRED} = 0 THEN 'TN'
 WHEN label = 0 THEN 'FP' ELSE 'FN' END AS outcome FROM conn_scored),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY row_id) AS rn
 FROM o) q WHERE rn = 1)
SELECT e.outcome, row_id IS NOT NULL AS present, row_id, label, score
 FROM (VALUES ('TP'), ('TN'), ('FP'), ('FN')) e(outcome) LEFT JOIN f USING (outcome)""",
    "score_histogram": f"WITH {ctes('predictions')} " + "\nUNION ALL\n".join(
        f"SELECT CAST('{e}' AS DOUBLE) AS le, count(*) FILTER (score <= CAST('{e}' AS DOUBLE)) AS n"
        " FROM predictions" for e in [*EDGES, "Infinity"]),
}
