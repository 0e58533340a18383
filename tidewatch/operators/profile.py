"""Profiling aggregates: dictionaries, distributions, associations, projections."""

from collections.abc import Sequence

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranking import (
    exact_quantiles, global_row_number, melt, null_safe_join, prefix_sum)
from tidewatch.session import settle


def _canonical_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every column as text with one spelling per value (no negative zero)."""
    kinds = dict(df.dtypes)
    return df.select(*[
        (F.col(f"`{c}`") + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(f"`{c}`"))
        .cast("string").alias(c) for c in cols])


def column_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, n) over all columns; duplicates are combined before the shuffle."""
    long = melt(_canonical_text(df, cols), [], cols, cast=None)
    return long.groupBy("feature", "value").agg(F.count("*").alias("n"))


def feature_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    out = column_values(df, cols).groupBy("feature").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.count("value").alias("unique_values"))
    dtype = F.create_map(*[F.lit(x) for c in cols for x in (c, kinds[c])])
    return out.withColumn("dtype", dtype[F.col("feature")])


def describe_features(df: DataFrame, numeric: Sequence[str],
                      categorical: Sequence[str]) -> DataFrame:
    """count/mean/std/min/quartiles/max for numbers, unique/top/freq for strings."""
    long = melt(df, [], numeric)
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    quartiles = exact_quantiles(df, numeric, {"q25": .25, "q50": .5, "q75": .75}).drop("size")
    numbers = moments.join(quartiles, "feature", "left").select(
        "feature", "count", F.lit(None).cast("bigint").alias("unique_values"),
        F.lit(None).cast("string").alias("top"), F.lit(None).cast("bigint").alias("freq"),
        "mean", "std", "min", "q25", "q50", "q75", "max")
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value")))
    none = [F.lit(None).cast("double").alias(c)
            for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    words = column_values(df, categorical).where(F.col("value").isNotNull()).groupBy(
        "feature").agg(F.sum("n").alias("count"), F.count("*").alias("unique_values"),
                       best.alias("b")).select(
        "feature", "count", "unique_values", F.col("b.value").alias("top"),
        (-F.col("b.neg")).alias("freq"), *none)
    return numbers.unionByName(words)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), col)


def attack_rate_by(df: DataFrame, col: str, top: int | None = None,
                   label: str = "label") -> DataFrame:
    out = df.groupBy(F.col(col).alias("segment")).agg(
        F.count("*").alias("rows"), F.avg(F.col(label).cast("double")).alias("attack_rate")
    ).withColumn("column", F.lit(col))
    return out.orderBy(F.desc("rows"), "segment").limit(top) if top else out


def equal_width_histogram(df: DataFrame, col: str, bins: int = 60,
                          by: str | None = None) -> DataFrame:
    """Counts per equal-width bin, last bin closed; with `by`, densities per class."""
    value = F.col(col).cast("double")
    bounds = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    data = df.where(value.isNotNull()).select(
        *([by] if by else []), value.alias("x"), lo.alias("lo"), hi.alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.when(F.col("hi") > F.col("lo"), F.least(
        F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    keys = [by] if by else []
    out = data.groupBy(*keys, index.cast("int").alias("bin"), "lo", width.alias("width")).agg(
        F.count("*").alias("n"))
    if by:
        sizes = out.groupBy(by).agg(F.sum("n").alias("size"))
        out = null_safe_join(out, sizes, [by]).withColumn(
            "density", F.try_divide(F.col("n"), F.col("size") * F.col("width"))).drop("size")
    return out.withColumn("left_edge", F.col("lo") + F.col("bin") * F.col("width")).drop(
        "lo", "width")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table."""
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """sqrt(chi2 / (n (min(r, c) - 1))), no continuity correction; null for a single category."""
    joint = crosstab(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b).select(
        F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"), "n")
    rows = joint.groupBy("a").agg(F.sum("n").alias("row_n"))
    cols = joint.groupBy("b").agg(F.sum("n").alias("col_n"))
    # zero cells add nothing to sum(o^2 / (r c)), so only observed cells are needed
    cell = joint.join(rows, "a").join(cols, "b")
    total = cell.agg(
        F.sum(F.col("n") * F.col("n").cast("double") / (F.col("row_n").cast("double")
                                                        * F.col("col_n"))).alias("s"),
        F.sum("n").alias("n"), F.count_distinct("a").alias("r"), F.count_distinct("b").alias("c"))
    smaller = F.least("r", "c") - 1
    # chi2 = n (s - 1), so n cancels
    return total.select(
        F.lit(a).alias("left_column"), F.lit(b).alias("right_column"),
        F.when(smaller > 0, F.sqrt(F.greatest(F.col("s") - 1, F.lit(0.0)) / smaller))
        .alias("cramers_v"))


def ecdf(scored: DataFrame, by: str = "label", score: str = "score") -> DataFrame:
    """Empirical distribution function per class at each distinct score."""
    counts = settle(scored.groupBy(by, score).agg(F.count("*").alias("n")))
    run = prefix_sum(counts, [score], {"upto": F.col("n")}, group=[by], totals={"size": "upto"})
    return run.select(
        by, score, (F.col("upto") / F.col("size")).alias("ecdf"))


def score_rank_curve(scored: DataFrame, threshold: float, key: str = "row_id",
                     score: str = "score") -> DataFrame:
    """Position of every row when sorted by score, with the predicted flag."""
    return global_row_number(scored, score, key, "rank").withColumn(
        "predicted", (F.col(score) >= F.lit(threshold)).cast("int"))


def pca_projection(fit_df: DataFrame, df: DataFrame, cols: Sequence[str], keep: Sequence[str],
                   k: int = 2) -> tuple[DataFrame, list[float]]:
    """Project `df` on the first components of `fit_df`; centred, sign fixed by loading.

    Returns the projected frame and the explained variance ratios.
    """
    cols = list(cols)
    means = fit_df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}")
                         for i, c in enumerate(cols)]).first()
    assembler = VectorAssembler(inputCols=[f"__c{i}" for i in range(len(cols))],
                                outputCol="__v")

    def centred(frame: DataFrame, extra=()) -> DataFrame:
        return assembler.transform(frame.select(*extra, *[
            (F.col(f"`{c}`").cast("double") - F.lit(means[f"m{i}"])).alias(f"__c{i}")
            for i, c in enumerate(cols)]))

    model = PCA(k=k, inputCol="__v", outputCol="__p").fit(centred(fit_df))
    loadings = model.pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    parts = vector_to_array("__p")
    out = model.transform(centred(df, keep)).select(
        *keep, *[(parts[i] * F.lit(signs[i])).alias(f"pc{i + 1}") for i in range(k)])
    return out, [float(v) for v in model.explainedVariance.toArray()]
