"""Paired bootstrap intervals over cell counts."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.metrics import METRICS, evaluate, suite
from tidewatch.operators.ranking import cut_points, order_bucket
from tidewatch.session import settle, settle_wide

#: Groups of cells; a replicate first shares its draws out among them.
GROUPS = 1024
#: Draws that a task hands on or sums up at once.
NUMBERS_AT_ONCE = 1_000_000


def _tasks(df: DataFrame) -> int:
    return 4 * df.sparkSession.sparkContext.defaultParallelism


def drawn(scored: DataFrame, iterations: int, seed: int = 42, label: str = "label",
          score: str = "score") -> DataFrame:
    """(label, score, w): a list per distinct pair, how often each replicate draws it.

    Drawing n of n rows with replacement draws a multinomial count for every distinct pair, so a
    replicate costs as many numbers as there are pairs, however many rows stand behind them. The
    counts are conditioned: a replicate's draws are shared out among `GROUPS` groups of pairs
    (iterations x GROUPS numbers), then each group's among its pairs, where the group lies.
    """
    cells = settle(scored.groupBy(F.col(label).alias("label"), F.col(score).cast("double").alias(
        "score")).agg(F.count("*").alias("c")).withColumn(
        "g", F.pmod(F.xxhash64("label", "score"), F.lit(GROUPS)).cast("int")))
    sizes = np.zeros(GROUPS, dtype=np.int64)
    for r in cells.groupBy("g").agg(F.sum("c").alias("c")).collect():  # at most GROUPS rows
        sizes[r["g"]] = r["c"]
    n = int(sizes.sum())
    if n == 0:
        raise ValueError("no rows to draw from")
    shares = np.stack([np.random.default_rng([seed, rep]).multinomial(n, sizes / n)
                       for rep in range(iterations)])
    shared = scored.sparkSession.sparkContext.broadcast(shares)
    whole = "int" if n < 2 ** 31 else "bigint"

    def draws(group: int, pairs: pa.Table) -> Iterator[pa.RecordBatch]:
        count = pairs.column("c").to_numpy()
        odds = count / count.sum()
        w = np.empty((len(odds), iterations), np.min_scalar_type(-n))
        for rep in range(iterations):
            w[:, rep] = np.random.default_rng([seed, rep, group]).multinomial(
                shared.value[rep, group], odds)
        at_once = max(1, NUMBERS_AT_ONCE // iterations)
        for first in range(0, len(odds), at_once):
            part = w[first:first + at_once]
            ends = np.arange(len(part) + 1, dtype=np.int32) * iterations
            rows = pairs.slice(first, len(part))
            yield pa.RecordBatch.from_arrays(
                [rows.column("label").combine_chunks(), rows.column("score").combine_chunks(),
                 pa.ListArray.from_arrays(ends, pa.array(part.ravel(), pa.int32() if whole == "int"
                                                         else pa.int64()))],
                names=["label", "score", "w"])

    def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None
        for batch in batches:
            own = batch.column("g").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for first, end in zip(edges[:-1], edges[1:], strict=True):
                if first == end:
                    continue
                if own[first] != group and held:
                    yield from draws(group, pa.Table.from_batches(held))
                    held = []
                group = int(own[first])
                held.append(batch.slice(first, end - first))
        if held:
            yield from draws(group, pa.Table.from_batches(held))

    kind = cells.schema["label"].dataType.simpleString()
    # a given number of tasks: pairs are few in bytes but not in work, so they must not be put together
    return cells.repartition(_tasks(cells), "g").sortWithinPartitions("g", "label", "score").mapInArrow(
        by_group, f"label {kind}, score double, w array<{whole}>")


def resample(scored: DataFrame, iterations: int, seed: int = 42, label: str = "label",
             score: str = "score") -> DataFrame:
    """(rep, label, score, w): how often each distinct pair is drawn in each replicate; pairs that
    are not drawn have no row."""
    return drawn(scored, iterations, seed, label, score).select(
        "label", "score", F.posexplode("w").alias("rep", "w")).where("w > 0").select(
        "rep", "label", "score", F.col("w").cast("bigint").alias("w"))


def replicate_sums(lists: DataFrame, iterations: int, threshold: float, probabilities: bool,
                   cuts: list[float]) -> DataFrame:
    """What `suite` needs of each replicate, from the lists of `drawn`: one row per `rep`.

    Scores are cut into ranges, highest first. A first pass counts each range's draws by replicate,
    a second one runs through a range from the counts of those above; a block of scores is a matrix of
    scores x replicates, so no row stands for a single draw.
    """
    spark = lists.sparkSession
    none = F.array_repeat(F.lit(0), iterations).cast(lists.schema["w"].dataType)

    def of(value: int):
        return F.coalesce(F.first(F.when(F.col("label") == value, F.col("w")), True), none)

    eps = 2.220446049250313e-16  # fixed value: probability clip
    prob = F.greatest(F.lit(eps), F.least(F.col("score"), F.lit(1 - eps)))
    rows = lists.groupBy("score").agg(of(1).alias("pos"), of(0).alias("neg")).withColumn(
        "__key", -F.col("score"))
    held = settle_wide(order_bucket(rows, "__key", "__range", cuts=cuts).select(
        # a missing score lies above all others, as in `prefix_sum`
        F.coalesce(F.col("__range") + 1, F.lit(0)).alias("__range"), "score", "pos", "neg",
        F.coalesce(F.col("score") >= F.lit(float(threshold)), F.lit(False)).alias("hit"),
        F.ln(prob).alias("lp"), F.ln(1 - prob).alias("lq"),
        F.pow(F.col("score") - 1, 2).alias("bp"), F.pow(F.col("score"), 2).alias("bq")), "draws")

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, iterations).astype(np.int64)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            own = batch.column("__range").to_numpy()
            pos, neg = matrix(batch.column("pos")), matrix(batch.column("neg"))
            for r in np.unique(own).tolist():
                at = own == r
                found[r] = found.get(r, 0) + np.stack([pos[at].sum(axis=0), neg[at].sum(axis=0)])
        for r, both in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(iterations, r, np.int32)), pa.array(np.arange(iterations, dtype=np.int32)),
                 pa.array(both[0]), pa.array(both[1])], names=["r", "rep", "pos", "neg"])

    # ranges x replicates numbers
    above = np.zeros((2, len(cuts) + 4, iterations), np.int64)
    for r in held.select("__range", "pos", "neg").mapInArrow(
            counted, "r int, rep int, pos bigint, neg bigint").groupBy("r", "rep").agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect():
        above[:, r["r"] + 1, r["rep"]] = r["pos"], r["neg"]
    above = above.cumsum(axis=1)
    shared = spark.sparkContext.broadcast(above)
    names = ["__u", "__ap", "ks", "tp", "fp", "__ll", "__br"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, (p, n) = shared.value, shared.value[:, -1].astype(float)
        running: dict[int, np.ndarray] = {}
        total = np.zeros((len(names), iterations))
        some = False
        for whole in batches:
            at_once = max(1, NUMBERS_AT_ONCE // iterations)
            for batch in (whole.slice(i, at_once) for i in range(0, whole.num_rows, at_once)):
                some = True
                own = batch.column("__range").to_numpy()
                pos, neg = matrix(batch.column("pos")), matrix(batch.column("neg"))
                # a missing score has no loss
                hit, lp, lq, bp, bq = (batch.column(c).cast(pa.float64()).fill_null(0.0).to_numpy()
                                       for c in ("hit", "lp", "lq", "bp", "bq"))
                for r in np.unique(own).tolist():
                    at = own == r
                    a, b = pos[at], neg[at]
                    start = running.get(r, before[:, r])
                    tp, fp = a.cumsum(axis=0) + start[0], b.cumsum(axis=0) + start[1]
                    running[r] = np.stack([tp[-1], fp[-1]])
                    with np.errstate(invalid="ignore", divide="ignore"):
                        part = [(a * (n - fp + b / 2)).sum(axis=0),
                                np.where(tp + fp > 0, a * tp / (tp + fp), 0.0).sum(axis=0),
                                np.abs(tp / p - fp / n).max(axis=0), hit[at] @ a, hit[at] @ b,
                                -(lp[at] @ a + lq[at] @ b), bp[at] @ a + bq[at] @ b]
                    for i, c in enumerate(names):
                        total[i] = np.fmax(total[i], part[i]) if c == "ks" else total[i] + part[i]
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(iterations, dtype=np.int32)), *map(pa.array, total)],
                names=["rep", *names])

    sums = held.repartition(_tasks(held), "__range").sortWithinPartitions(
        "__range", F.col("score").desc()).mapInArrow(
        summed, "rep int, " + ", ".join(f"`{c}` double" for c in names)).groupBy("rep").agg(*[
            (F.max if c == "ks" else F.sum)(f"`{c}`").alias(c) for c in names])
    sizes = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(above[:, -1].T)],
                                  "rep int, p bigint, n bigint")
    return sums.join(F.broadcast(sizes), "rep").withColumns(
        {c: F.col(c).cast("bigint") for c in ("tp", "fp")})


def bootstrap_ci(scored: DataFrame, threshold: float, iterations: int = 300, seed: int = 42,
                 probabilities: bool = False, metrics: Sequence[str] | None = None,
                 low: float = 0.025, high: float = 0.975, label: str = "label",
                 score: str = "score") -> DataFrame:
    """metric, estimate, low_95, high_95, replicates; one-class replicates are skipped."""
    names = list(metrics or METRICS + (["log_loss", "brier"] if probabilities else []))
    cuts = cut_points(scored.select((-F.col(score).cast("double")).alias("k")), "k")
    reps = suite(replicate_sums(drawn(scored, iterations, seed, label, score), iterations, threshold,
                                probabilities, cuts), ["rep"], probabilities, pvalue=False
                 ).where("p > 0 AND n > 0")
    # at most `iterations` rows reach the percentiles
    spread = reps.agg(F.count("*").alias("replicates"), *[
        F.percentile(m, F.array(F.lit(low), F.lit(high))).alias(m) for m in names])
    point = evaluate(scored, threshold, (), probabilities, label, score, cuts=cuts, pvalue=False)

    def long(df, extra=()):
        return df.select(*extra, F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in names])).alias("r")
        ).select(*extra, "r.*")

    bounds = long(spread, ["replicates"])
    return long(point).withColumnRenamed("v", "estimate").join(bounds, "metric").select(
        "metric", "estimate", F.col("v")[0].alias("low_95"), F.col("v")[1].alias("high_95"),
        "replicates")
