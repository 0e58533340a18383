"""Sustained alert conditions over event time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.operators.ranking import prefix_sum
from tidewatch.session import settle

DAY = 86_400


def silence(df: DataFrame, gap: float = 60, hold: float = 60, ts: str = "ts",
            until: float | None = None) -> DataFrame:
    """Stretches without events for longer than `gap + hold` seconds.

    Only the first and last event of each second can border a gap, so events are reduced to
    seconds first; days are then put in order by their first event, one row per day.
    """
    per_sec = df.where(F.col(ts).isNotNull()).groupBy(
        F.floor(F.col(ts)).alias("sec")).agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    per_sec = per_sec.withColumn("day", F.floor(F.col("sec") / DAY))
    days = per_sec.groupBy("day").agg(F.min("first").alias("day_first")).withColumn(
        "next_day_first", F.lead("day_first").over(W.partitionBy(F.lit(0)).orderBy("day")))
    inside = per_sec.withColumn("next_sec", F.lead("first").over(
        W.partitionBy("day").orderBy("sec")))
    end = F.lit(None).cast("double") if until is None else F.lit(float(until))
    nxt = inside.join(F.broadcast(days.select("day", "next_day_first")), "day").select(
        F.col("last").alias("silent_from"),
        F.coalesce("next_sec", "next_day_first", end).alias("silent_until"))
    return nxt.where(F.col("silent_until") - F.col("silent_from") > gap + hold).withColumn(
        "fired_at", F.col("silent_from") + F.lit(float(gap + hold)))


def rate_alert(df: DataFrame, window: int = 120, step: int = 5, limit: float = 0.5,
               hold: int = 120, ts: str = "ts", flag: str = "prediction") -> DataFrame:
    """Runs of evaluation steps whose attack share over the trailing window exceeds `limit`.

    Events are counted per step once; only those step rows are spread over the windows they
    belong to.
    """
    if window % step:
        raise ValueError("window must be a multiple of step")
    k = window // step
    per_step = df.groupBy(F.floor(F.col(ts) / step).alias("b")).agg(
        F.count("*").alias("n"), F.sum(F.col(flag).cast("bigint")).alias("a"))
    share = per_step.select(F.explode(F.sequence(F.col("b") + 1, F.col("b") + k)).alias("s"),
                            "n", "a").groupBy("s").agg(F.sum("n").alias("n"),
                                                       F.sum("a").alias("a"))
    hot = settle(share.where(F.col("a") / F.col("n") > limit))
    placed = prefix_sum(hot, ["s"], {"rn": F.lit(1)})
    runs = placed.groupBy((F.col("s") - F.col("rn")).alias("run")).agg(
        F.min("s").alias("lo"), F.max("s").alias("hi"), F.max(F.col("a") / F.col("n")).alias("peak"))
    return runs.where((F.col("hi") - F.col("lo")) * step >= hold).select(
        (F.col("lo") * step).alias("started_at"), (F.col("lo") * step + hold).alias("fired_at"),
        (F.col("hi") * step).alias("ended_at"), F.col("peak").alias("peak_share"))


def recall_alert(running: DataFrame, limit: float = 0.6, hold: float = 180) -> DataFrame:
    """Stretches where the running recall stays below `limit` for at least `hold` seconds.

    A value holds until the next matched event; the last stretch may still be open.
    """
    good = (F.col("recall") >= limit).cast("bigint")
    runs = prefix_sum(settle(running.select("t", "ts", "recall")), ["t"], {"island": good})
    low = runs.where(F.col("recall") < limit).groupBy("island").agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("last_seen"), F.count("*").alias("events"),
        F.min("recall").alias("lowest"))
    ends = runs.where(F.col("recall") >= limit).select(
        (F.col("island") - 1).alias("island"), F.col("ts").alias("recovered_at"))
    out = low.join(ends, "island", "left").withColumn(
        "ended_at", F.coalesce("recovered_at", "last_seen"))
    return out.where(F.col("ended_at") - F.col("started_at") >= hold).select(
        "started_at", (F.col("started_at") + F.lit(float(hold))).alias("fired_at"), "ended_at",
        F.col("recovered_at").isNull().alias("open"), "events", "lowest")
