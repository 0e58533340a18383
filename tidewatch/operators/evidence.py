"""Evidence against a baseline: novel names, unusual windows, candidate conditions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.functions import telemetry as T
from tidewatch.operators.ranking import exact_quantiles, melt, one_row
from tidewatch.schemas import DNS_WINDOW_FEATURES, HYPOTHESIS_FEATURES


def safe_dns_events(df: DataFrame, order: str | None = None) -> DataFrame:
    """Allow-listed projection; nothing else of the input is ever forwarded.

    `order` keeps one position column for operators that need the input order.
    """
    return df.where(F.col("query").isNotNull() & (F.col("query") != "")).select(
        *([order] if order else []), "ts", T.client_key().alias("client"),
        T.clean_qname("query").alias("query"),
        F.coalesce("rcode_name", F.lit("")).alias("rcode_name"))


def ioc_candidates(period: DataFrame, baseline: DataFrame | None = None, n: int = 12,
                   limit_after: bool = False, check: bool = False) -> DataFrame:
    """The `n` longest names of the period that the baseline has not seen, with their counts.

    The limit applies before the baseline is removed, so a novel short name can be lost;
    `limit_after` removes the baseline first.
    """
    counts = safe_dns_events(period).groupBy("query").agg(F.count("*").alias("count"))
    seen = safe_dns_events(baseline).select("query") if baseline is not None else None
    longest = [F.desc(F.length("query")), F.col("query")]
    if seen is not None and limit_after:
        names = counts.join(seen.distinct(), "query", "left_anti").orderBy(*longest).limit(n)
    else:
        names = counts.orderBy(*longest).limit(n)
        if seen is not None:
            # only baseline rows with one of the n names travel further
            known = seen.join(F.broadcast(names.select("query")), "query", "left_semi").distinct()
            names = names.join(known, "query", "left_anti")
    if check and names.isEmpty():
        raise ValueError("No novel name: every name of the period occurs in the baseline")
    return names


def ioc_examples(period: DataFrame, names: DataFrame, order: str = "seq") -> DataFrame:
    """First event in input order of every candidate name."""
    events = safe_dns_events(period, order).join(F.broadcast(names.select("query")), "query",
                                                 "left_semi")
    first = events.groupBy("query").agg(
        F.min_by(F.struct("ts", "client", "rcode_name"), order).alias("r"))
    return first.select("query", "r.ts", "r.client", "r.rcode_name")


def baseline_stats(windows: DataFrame, digits: int = 4) -> DataFrame:
    """Median and 95th percentile per window feature."""
    stats = exact_quantiles(windows, DNS_WINDOW_FEATURES, {"median": 0.5, "p95": 0.95})
    return stats.select("feature", F.round("median", digits).alias("median"),
                        F.round("p95", digits).alias("p95"))


def top_windows(scored: DataFrame, n: int = 5, score: str = "anomaly_score") -> DataFrame:
    """The `n` most anomalous windows with their rank; ties by window and client."""
    top = scored.orderBy(F.desc(score), "window_start", "client").limit(n)
    return top.withColumn("rank", F.row_number().over(
        W.partitionBy(F.lit(0)).orderBy(F.desc(score), "window_start", "client")))


def candidate_conditions(stats: DataFrame, top: DataFrame, check: bool = False) -> DataFrame:
    """`field > (p95 + max) / 2` for the hypothesis features that exceed the baseline."""
    peaks = melt(top, [], HYPOTHESIS_FEATURES).groupBy("feature").agg(F.max("value").alias("peak"))
    out = stats.join(F.broadcast(peaks), "feature").where(F.col("peak") > F.col("p95")).select(
        F.col("feature").alias("field"), F.lit("gt").alias("operator"),
        F.round((F.col("p95") + F.col("peak")) / 2, 4).alias("value"))
    if check and out.count() < 2:
        raise ValueError("fewer than two features exceed the baseline")
    return out


def window_examples(top: DataFrame, events: DataFrame, width: float, per: int = 2,
                    n: int = 5, order: str = "seq") -> DataFrame:
    """Per top window the `per` longest queries of its client, first `n` overall in rank order."""
    safe = safe_dns_events(events, order)
    spans = F.broadcast(top.select("rank", "client", "window_start"))  # a top-n list
    inside = safe.join(spans, "client").where(
        (F.col("ts") >= F.col("window_start")) & (F.col("ts") < F.col("window_start") + width))
    place = F.row_number().over(W.partitionBy("rank").orderBy(F.desc(F.length("query")), order))
    return inside.withColumn("place", place).where(F.col("place") <= per).orderBy(
        "rank", "place").limit(n).select("rank", "place", "ts", "client", "query", "rcode_name")


def holds(condition) -> Column:
    """Predicate of one (field, operator, value) condition on a window row."""
    field, operator, value = condition
    if operator not in ("gt", "gte"):
        raise ValueError(f"{operator} compares no numbers")
    return F.col(field) > value if operator == "gt" else F.col(field) >= value


def all_hold(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & holds(c)
    return out


def behavioral_review(conditions, baseline: DataFrame, top: DataFrame) -> DataFrame:
    """Evidence-only sanity check of at most a handful of conditions: one row per condition."""
    conditions = list(conditions)
    fields = [c[0] for c in conditions]
    hit = all_hold(conditions)
    base = baseline.agg(F.count_if(hit).alias("baseline_windows_matching"),
                        F.count("*").alias("baseline_windows"))
    tops = top.agg(F.count_if(hit).alias("top_windows_matching"),
                   F.count("*").alias("top_windows"))
    p95 = exact_quantiles(baseline, fields, {"p": 0.95}).select(
        "feature", F.round("p", 4).alias("baseline_p95"))
    peak = melt(top, [], fields).groupBy("feature").agg(
        F.round(F.max("value"), 4).alias("top_max"))
    asked = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(o).alias("operator"),
                 F.lit(float(v)).alias("threshold")) for f, o, v in conditions]))
    counts = one_row(base, tops)
    spec = counts.select(asked.alias("c"), *counts.columns).select("c.*", *counts.columns)
    return spec.join(p95, "feature", "left").join(peak, "feature", "left").withColumnRenamed(
        "feature", "field")


def compare_window(top: DataFrame, stats: DataFrame) -> DataFrame:
    """The top window with most unique subdomains next to the baseline medians."""
    one = top.orderBy(F.desc("unique_subdomains"), "rank").limit(1)
    long = melt(one, ["rank"], DNS_WINDOW_FEATURES, "feature", "selected")
    return stats.select("feature", F.col("median").alias("baseline_median")).join(
        F.broadcast(long), "feature")


def period_summary(truth: DataFrame, period: str = "scenario") -> DataFrame:
    return truth.groupBy(period).agg(
        F.count("*").alias("events"), F.min("ts").alias("started"), F.max("ts").alias("ended"),
        F.avg(F.col("label").cast("double")).alias("suspicious_fraction"),
        F.count_if(F.coalesce("delivered", F.lit(True))).alias("delivered"))


def suffix_rules(candidates: DataFrame) -> DataFrame:
    """One allowed suffix condition per observed name; the leading dot keeps the apex out."""
    return candidates.select(F.lit("dns.query").alias("field"), F.lit("endswith").alias("operator"),
                             F.concat(F.lit("."), "query").alias("value"))
