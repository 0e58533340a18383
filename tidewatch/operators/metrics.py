"""Threshold tables, curves and the metric suite over (label, score[, group]) rows.

Everything starts from one aggregation to distinct scores with running counts; raw rows are
never sorted.
"""

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.ranking import (
    exact_quantiles, melt, order_bucket, prefix_sum, quantile_grid)
from tidewatch.session import settle

METRICS = ["roc_auc", "average_precision", "gini", "accuracy", "balanced_accuracy", "precision",
           "recall", "f1", "specificity", "fpr", "fnr", "mcc", "ks"]


def score_cells(scored: DataFrame, by: Sequence[str] = (), label: str = "label",
                score: str = "score", weight: Column | None = None,
                cuts: list[float] | None = None) -> DataFrame:
    """One row per (by, score): pos, neg, tp/fp of `score >= t`, class totals p/n.

    `cuts` are ready cut points of the negated score.
    """
    by = list(by)
    weight = weight if weight is not None else F.lit(1)
    counts = settle(scored.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, weight).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 0, weight).otherwise(0)).alias("neg")))
    return prefix_sum(counts, [F.col("score").desc()],
                      {"tp": F.col("pos"), "fp": F.col("neg")}, group=by,
                      key=-F.col("score"), cuts=cuts, totals={"p": "tp", "n": "fp"})


@F.pandas_udf(T.DoubleType())
def next_float(x: pd.Series) -> pd.Series:
    return pd.Series(np.nextafter(x.to_numpy(dtype=float), math.inf))


def _f1(precision: Column, recall: Column, floor: float) -> Column:
    return 2 * precision * recall / F.greatest(precision + recall, F.lit(floor))


def threshold_table(scored: DataFrame, by: Sequence[str] = (), **names) -> DataFrame:
    """Every distinct score as threshold plus the no-alert row just above the maximum."""
    by = list(by)
    cells = score_cells(scored, by, **names)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("p")), F.lit(1.0))
    rows = cells.select(*by, F.col("score").alias("threshold"), precision.alias("precision"),
                        recall.alias("recall"), _f1(precision, recall, 1e-15).alias("f1"),
                        F.try_divide(F.col("fp"), F.col("n")).alias("fpr"))
    top = cells.groupBy(*by).agg(F.max("score").alias("m"))
    silent = top.select(*by, next_float("m").alias("threshold"), *[
        F.lit(0.0).alias(c) for c in ("precision", "recall", "f1", "fpr")])
    return rows.unionByName(silent)


def choose_threshold(table: DataFrame, max_fpr: float = 0.05,
                     by: Sequence[str] = ()) -> DataFrame:
    """Highest F1 within the FPR limit; ties prefer the lower FPR, then the lower threshold."""
    feasible = table.where(F.col("fpr") <= max_fpr)
    if not by:
        return feasible.orderBy(F.desc("f1"), "fpr", "threshold").limit(1)
    rank = F.struct((-F.col("f1")).alias("a"), F.col("fpr").alias("b"),
                    F.col("threshold").alias("c"))
    rest = [c for c in table.columns if c not in by]
    return feasible.groupBy(*by).agg(F.min_by(F.struct(*rest), rank).alias("r")).select(
        *by, "r.*")


def quantile_threshold(scored: DataFrame, max_fpr: float = 0.05, candidates: int = 400,
                       label: str = "label", score: str = "score") -> DataFrame:
    """Best of `candidates` score quantiles between 1% and 99%, or the normals' quantile.

    A quantile lies between two scores that are next to each other, so `score >= t` counts are
    those of the smallest distinct score not below it.
    """
    probs = [0.01 + 0.98 * i / (candidates - 1) for i in range(candidates)]
    edges = sorted(set(quantile_grid(scored, score, probs)))  # at most `candidates` numbers
    if not edges:
        raise ValueError("No scores to choose a threshold from")
    cells = score_cells(scored, label=label, score=score)
    # bucket k holds the scores caught by the first k candidates
    located = order_bucket(cells, "score", "k", cuts=edges)
    per = located.groupBy("k", "p", "n").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    caught = per.where("k > 0").select(
        "p", "n", "pos", "neg", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("i")
    ).groupBy("i", "p", "n").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp")).withColumn(
        "threshold", F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("i")))
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("p")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    fpr = F.col("fp") / F.greatest(F.col("n"), F.lit(1))
    best = caught.select("threshold", f1.alias("f1"), fpr.alias("fpr")).where(
        F.col("fpr") <= max_fpr).orderBy(F.desc("f1"), "threshold").limit(1)
    fallback = exact_quantiles(scored.where(F.col(label) == 0), [score],
                               {"threshold": 1.0 - max_fpr}).select("threshold")
    both = best.select("threshold", F.lit(0).alias("pref")).unionByName(
        fallback.select("threshold", F.lit(1).alias("pref")))
    return both.orderBy("pref").limit(1).select("threshold")


def confusion_rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    zero = F.lit(0.0)
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    precision = F.coalesce(F.try_divide(tp, tp + fp), zero)
    recall = F.coalesce(F.try_divide(tp, tp + fn), zero)
    specificity, sensitivity = F.try_divide(tn, tn + fp), F.try_divide(tp, tp + fn)
    spread = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return {
        "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn),
        "balanced_accuracy": (F.coalesce(sensitivity, specificity)
                              + F.coalesce(specificity, sensitivity)) / 2,
        "precision": precision,
        "recall": recall,
        "f1": F.coalesce(F.try_divide(2 * precision * recall, precision + recall), zero),
        "specificity": specificity,
        "fpr": F.try_divide(fp, tn + fp),
        "fnr": F.try_divide(fn, fn + tp),
        "mcc": F.coalesce(F.try_divide(tp * tn - fp * fn, spread), zero),
    }


def _flag(threshold, score: str) -> Column:
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.col(score) >= threshold


def confusion_matrix(scored: DataFrame, threshold, by: Sequence[str] = (),
                     label: str = "label", score: str = "score") -> DataFrame:
    hit, pos = _flag(threshold, score), F.col(label) == 1
    return scored.groupBy(*by).agg(
        F.count_if(~pos & ~hit).alias("tn"), F.count_if(~pos & hit).alias("fp"),
        F.count_if(pos & ~hit).alias("fn"), F.count_if(pos & hit).alias("tp"))


def row_normalised(confusion: DataFrame) -> DataFrame:
    normal, attack = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    return confusion.select(
        "*", F.try_divide("tn", normal).alias("tn_share"),
        F.try_divide("fp", normal).alias("fp_share"),
        F.try_divide("fn", attack).alias("fn_share"), F.try_divide("tp", attack).alias("tp_share"))


#: Sample sizes up to which the distribution of the KS statistic is counted, not approximated.
EXACT_KS = 10_000


def ks_exact(ks: float, p: int, n: int) -> float:
    """P(D >= ks) for two samples of one continuous distribution, by lattice paths.

    An order of both samples is a path from (0, 0) to (p, n), all of them alike; D is the largest
    |i / p - j / n| on it. Walking back from the end, the last step of a path to (i, j) came from
    (i - 1, j) with probability i / (i + j), so the share of paths that have met the bound so far
    follows along the diagonals i + j, without differences of large numbers.
    """
    if p == 0 or n == 0:
        return math.nan
    unit = math.lcm(p, n)
    bound = round(ks * unit)
    if bound <= 0:
        return 1.0
    i = np.arange(p + 1)
    met = np.zeros(p + 1)
    for total in range(1, p + n + 1):
        low, high = max(0, total - n), min(p, total)
        at = i[low:high + 1]
        share = np.zeros(p + 1)
        from_left = at[at > 0]
        share[from_left] = met[from_left - 1] * (from_left / total)
        share[low:high + 1] += met[low:high + 1] * ((total - at) / total)
        outside = np.abs(at * (unit // p) - (total - at) * (unit // n)) >= bound
        share[at[outside]] = 1.0
        met = share
    return float(met[p])


@F.pandas_udf(T.DoubleType())
def _ks_exact(ks: pd.Series, p: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([ks_exact(*x) if pd.notna(x[0]) else math.nan
                      for x in zip(ks, p.astype(int), n.astype(int), strict=True)], dtype=float)


def ks_pvalue(ks: Column, p: Column, n: Column, exact: bool = True) -> Column:
    """Two-sample p-value: counted if neither sample has more than `EXACT_KS` rows, else the
    Kolmogorov series. The statistic is that of one row per group, so few values are counted."""
    lam = ks * F.sqrt(p * n / (p + n))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam))
    limit = F.when(lam < 0.2, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
    if not exact:
        return limit
    few = (F.greatest(p, n) <= EXACT_KS) & ks.isNotNull()
    # the counting sees only the rows that need it: the others are passed as a path of one step
    counted = _ks_exact(F.when(few, ks).otherwise(0.0), F.when(few, p).otherwise(1),
                        F.when(few, n).otherwise(1))
    return F.when(few, counted).otherwise(limit)


def evaluate(scored: DataFrame, threshold, by: Sequence[str] = (), probabilities: bool = False,
             label: str = "label", score: str = "score", weight: Column | None = None,
             cuts: list[float] | None = None, pvalue: bool = True) -> DataFrame:
    """The whole metric suite, one row per `by`; one aggregation over distinct scores."""
    by = list(by)
    cells = score_cells(scored, by, label, score, weight, cuts)
    hit = _flag(threshold, "score")
    eps = 2.220446049250313e-16  # fixed value: probability clip
    prob = F.greatest(F.lit(eps), F.least(F.col("score"), F.lit(1 - eps)))
    aggs = [
        F.sum(F.col("pos") * (F.col("n") - F.col("fp") + F.col("neg") / 2)).alias("__u"),
        F.sum(F.coalesce(F.try_divide(F.col("pos") * F.col("tp"),
                                      F.col("tp") + F.col("fp")), F.lit(0.0))).alias("__ap"),
        F.max(F.abs(F.try_divide(F.col("tp"), F.col("p"))
                    - F.try_divide(F.col("fp"), F.col("n")))).alias("ks"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("fp"),
    ]
    if probabilities:
        aggs += [
            (-F.sum(F.col("pos") * F.ln(prob) + F.col("neg") * F.ln(1 - prob))).alias("__ll"),
            F.sum(F.col("pos") * F.pow(F.col("score") - 1, 2)
                  + F.col("neg") * F.pow(F.col("score"), 2)).alias("__br"),
        ]
    return suite(cells.groupBy(*by, "p", "n").agg(*aggs), by, probabilities, pvalue)


def suite(base: DataFrame, by: Sequence[str] = (), probabilities: bool = False,
          pvalue: bool = True) -> DataFrame:
    """The metrics of one row of sums per `by`: p, n, tp, fp, ks, __u, __ap (and __ll, __br)."""
    base = base.withColumn("fn", F.col("p") - F.col("tp")).withColumn(
        "tn", F.col("n") - F.col("fp"))
    p, n = F.col("p"), F.col("n")
    auc = F.try_divide(F.col("__u"), p.cast("double") * n)
    rates = confusion_rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    out = [auc.alias("roc_auc"), F.try_divide("__ap", p).alias("average_precision"),
           (2 * auc - 1).alias("gini"), *[e.alias(k) for k, e in rates.items()], F.col("ks")]
    if probabilities:
        out += [F.try_divide("__ll", p + n).alias("log_loss"),
                F.try_divide("__br", p + n).alias("brier")]
    if pvalue:
        out.append(ks_pvalue(F.col("ks"), p, n).alias("ks_pvalue"))
    return base.select(*by, *out, "tn", "fp", "fn", "tp", "p", "n")


def prob_losses(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Log loss with clipped probabilities and Brier score."""
    eps = 2.220446049250313e-16  # fixed value: probability clip
    y, q = F.col(label).cast("double"), F.col(score).cast("double")
    prob = F.greatest(F.lit(eps), F.least(q, F.lit(1 - eps)))
    return scored.agg((-F.avg(y * F.ln(prob) + (1 - y) * F.ln(1 - prob))).alias("log_loss"),
                      F.avg(F.pow(q - y, 2)).alias("brier"))


def roc_curve(scored: DataFrame, by: Sequence[str] = (), **names) -> DataFrame:
    """Curve points from the origin (no alert) to the lowest score."""
    cells = score_cells(scored, by, **names)
    points = cells.select(*by, "score", F.try_divide("fp", "n").alias("fpr"),
                          F.try_divide("tp", "p").alias("tpr"))
    start = cells.select(*by).distinct() if by else cells.select("p").distinct()
    return points.unionByName(start.select(
        *by, F.lit(float("inf")).alias("score"), F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr")))


def pr_curve(scored: DataFrame, by: Sequence[str] = (), **names) -> DataFrame:
    """Precision and recall at each distinct score plus the closing (1, 0) point."""
    cells = score_cells(scored, by, **names)
    points = cells.select(*by, "score", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias(
        "precision"), F.coalesce(F.try_divide("tp", "p"), F.lit(1.0)).alias("recall"))
    start = cells.select(*by).distinct() if by else cells.select("p").distinct()
    return points.unionByName(start.select(
        *by, F.lit(None).cast("double").alias("score"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall")))


def classification_report(scored: DataFrame, threshold, label: str = "label",
                          score: str = "score") -> DataFrame:
    """Per-class rows, accuracy, macro and weighted averages, all from one confusion row."""
    m = confusion_matrix(scored, threshold, label=label, score=score)
    pos = confusion_rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    neg = confusion_rates(*[F.col(c) for c in ("tn", "fn", "fp", "tp")])
    three = ("precision", "recall", "f1")
    n0, n1 = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")

    def line(name, values, support):
        return F.struct(F.lit(name).alias("class"), *[v.alias(k) for k, v in values.items()],
                        support.cast("bigint").alias("support"))

    total = n0 + n1
    lines = [
        line("normal", {k: neg[k] for k in three}, n0),
        line("attack", {k: pos[k] for k in three}, n1),
        line("accuracy", {k: pos["accuracy"] for k in three}, total),
        line("macro avg", {k: (neg[k] + pos[k]) / 2 for k in three}, total),
        line("weighted avg", {k: (neg[k] * n0 + pos[k] * n1) / total for k in three}, total),
    ]
    return m.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def recall_by(scored: DataFrame, col: str, threshold, label: str = "label",
              score: str = "score") -> DataFrame:
    hit = _flag(threshold, score)
    return scored.where(F.col(label) == 1).groupBy(col).agg(
        F.count("*").alias("n"), F.count_if(hit).alias("detected"),
        F.count_if(~hit).alias("missed"), F.avg(hit.cast("double")).alias("recall"))


def segment_metrics(scored: DataFrame, cols: Sequence[str], threshold, top: int = 25,
                    label: str = "label", score: str = "score") -> DataFrame:
    """FPR and recall per value of several columns; null where the class is absent."""
    staged = scored.select(*cols, F.col(label).alias("__y"),
                           _flag(threshold, score).cast("double").alias("__hit"))
    long = melt(staged, ["__y", "__hit"], cols, "column", "segment", cast="string")
    normal, attack = F.col("__y") == 0, F.col("__y") == 1
    return long.groupBy("column", "segment").agg(
        F.count("*").alias("n"), F.count_if(normal).alias("normal_n"),
        F.count_if(attack).alias("attack_n"), F.avg(F.when(normal, F.col("__hit"))).alias("fpr"),
        F.avg(F.when(attack, F.col("__hit"))).alias("recall")).orderBy(
        F.desc("n"), "column", "segment").limit(top)


def misclassified_rows(scored: DataFrame, threshold, n: int = 12, key: str = "row_id",
                       label: str = "label", score: str = "score") -> DataFrame:
    staged = scored.withColumn("prediction", _flag(threshold, score).cast("int"))
    return staged.where(F.col(label) != F.col("prediction")).orderBy(key).limit(n)


def outcome(threshold, label: str = "label", score: str = "score") -> Column:
    hit, pos = _flag(threshold, score), F.col(label) == 1
    return (F.when(pos & hit, "TP").when(~pos & ~hit, "TN").when(~pos & hit, "FP")
            .otherwise("FN"))


def outcome_representatives(scored: DataFrame, threshold, key: str = "row_id",
                            label: str = "label", score: str = "score") -> DataFrame:
    """First row of each outcome; outcomes that never occur keep a row without values."""
    rest = [c for c in scored.columns]
    first = scored.withColumn("outcome", outcome(threshold, label, score)).groupBy(
        "outcome").agg(F.min_by(F.struct(*rest), key).alias("r"))
    every = scored.sparkSession.createDataFrame(
        [("TP",), ("TN",), ("FP",), ("FN",)], "outcome string")
    return every.join(first, "outcome", "left").select("outcome", "r.*").withColumn(
        "present", F.col(key).isNotNull())


def score_histogram(scored: DataFrame, edges: Sequence[float], score: str = "score") -> DataFrame:
    """Cumulative `le` buckets, the last one unbounded; one aggregation, no explosion of rows."""
    counts = scored.agg(*[F.count_if(F.col(score) <= float(e)).alias(f"b{i}")
                          for i, e in enumerate(edges)], F.count("*").alias("all"))
    pairs = [F.struct(F.lit(float(e)).alias("le"), F.col(f"b{i}").alias("n"))
             for i, e in enumerate(edges)]
    pairs.append(F.struct(F.lit(float("inf")).alias("le"), F.col("all").alias("n")))
    return counts.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")
