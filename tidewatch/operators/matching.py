"""Matching ground truth with predictions, and running counters."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranking import prefix_sum
from tidewatch.session import settle


def usable_truth(truth: DataFrame) -> DataFrame:
    return truth.where(F.coalesce("delivered", F.lit(True)) & F.col("event_id").isNotNull()
                       & (F.col("event_id") != ""))


def match_events(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row per event id known on both sides, in any arrival order.

    The pair is judged at the moment the second side first appears, with the latest record seen
    of each side by then; later records change nothing.
    """
    none = F.lit(None).cast("int")
    pred = predictions.where(F.col("event_id").isNotNull() & (F.col("event_id") != ""))
    arrivals = usable_truth(truth).select(
        "event_id", "seq", "ts", F.col("label").cast("int").alias("y"), none.alias("z")
    ).unionByName(pred.select("event_id", "seq", "ts", none.alias("y"),
                              F.col("prediction").cast("int").alias("z")))
    is_truth, is_pred = F.col("y").isNotNull(), F.col("z").isNotNull()
    moment = arrivals.groupBy("event_id").agg(
        F.greatest(F.min(F.when(is_truth, F.col("seq"))),
                   F.min(F.when(is_pred, F.col("seq")))).alias("t"),
        (F.count_if(is_truth) * F.count_if(is_pred)).alias("both")).where("both > 0")
    return arrivals.join(moment.select("event_id", "t"), "event_id").where(
        F.col("seq") <= F.col("t")).groupBy("event_id", "t").agg(
        F.max_by("y", F.when(is_truth, F.col("seq"))).alias("label"),
        F.max_by("z", F.when(is_pred, F.col("seq"))).alias("prediction"),
        F.max_by("ts", "seq").alias("ts"))


def cell(label: int, prediction: int) -> Column:
    return ((F.col("label") == label) & (F.col("prediction") == prediction)).cast("bigint")


def live_rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Precision, recall, F1 and FPR with the guards of a live gauge."""
    one = F.lit(1)
    precision = tp / F.greatest(tp + fp, one)
    recall = tp / F.greatest(tp + fn, one)
    return {"precision": precision, "recall": recall,
            "f1": 2 * precision * recall / F.greatest(precision + recall, F.lit(1e-12)),
            "fpr": fp / F.greatest(fp + tn, one)}


CELLS = ("tp", "fp", "fn", "tn")


def running_metrics(matched: DataFrame) -> DataFrame:
    """Cumulative confusion after every matched event, in match order `t` (unique)."""
    run = prefix_sum(settle(matched), ["t"], {"tp": cell(1, 1), "fp": cell(0, 1), "fn": cell(1, 0),
                                      "tn": cell(0, 0)})
    rates = live_rates(*[F.col(c) for c in CELLS])
    return run.select("event_id", "t", "ts", *CELLS, *[e.alias(k) for k, e in rates.items()])


def total_metrics(matched: DataFrame) -> DataFrame:
    """The final state of the running counters, as one aggregation."""
    total = matched.agg(*[F.coalesce(F.sum(cell(y, z)), F.lit(0)).alias(n) for n, y, z in (
        ("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))])
    return total.select(*CELLS, *[e.alias(k) for k, e in live_rates(
        *[F.col(c) for c in CELLS]).items()])


def prediction_counters(predictions: DataFrame, records: DataFrame) -> DataFrame:
    """Predictions per (prediction, source), skipped records per source, last event time."""
    made = predictions.groupBy(
        F.when(F.col("prediction") == 1, "attack").otherwise("normal").alias("kind"),
        "source").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))
    skipped = records.where(F.col("event_id").isNull()).groupBy(
        F.lit("skipped").alias("kind"), "source").agg(
        F.count("*").alias("n"), F.lit(None).cast("double").alias("last_ts"))
    return made.unionByName(skipped)


def traffic_counters(truth: DataFrame) -> DataFrame:
    """Delivered events per (label, service, attack type) and delivery errors per service."""
    ok = F.coalesce("delivered", F.lit(True))
    sent = truth.where(ok).groupBy("label", "service", "attack_type").agg(
        F.count("*").alias("n")).withColumn("counter", F.lit("events"))
    errors = truth.where(~ok).groupBy("service").agg(F.count("*").alias("n")).select(
        F.lit(None).cast("int").alias("label"), "service",
        F.lit(None).cast("string").alias("attack_type"), "n", F.lit("errors").alias("counter"))
    return sent.unionByName(errors)
