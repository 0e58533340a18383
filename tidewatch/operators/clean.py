"""Labelling, deduplication, contradiction removal, sampling and splitting."""

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranking import hash_cuts, null_safe_join, up_to_cut


def label_connections(df: DataFrame) -> DataFrame:
    """Strip trailing dots from the attack name and derive the binary label."""
    name = F.rtrim(F.col("attack_type"), F.lit("."))
    return df.withColumn("attack_type", name).withColumn(
        "label", (F.col("attack_type") != "normal").cast("tinyint"))


def dedupe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def vector_profile(df: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """One row per feature vector: row count and label range (combined before the shuffle)."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.min(label).alias("label_min"),
                                 F.max(label).alias("label_max"))


def drop_conflicts(df: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """Exclude every row whose feature vector carries more than one label.

    Only contradictory vectors travel to the join, so a vector that holds a large share of the
    rows without contradiction costs nothing there.
    """
    bad = vector_profile(df, keys, label).where("label_min <> label_max").select(*keys)
    return null_safe_join(df, bad, keys, "left_anti")


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First row in input order for each key; min_by combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c)
                           for c in df.columns])


def clean_vectors(df: DataFrame, keys: Sequence[str], order: str,
                  label: str = "label") -> DataFrame:
    """Contradiction removal and first-row deduplication in one aggregation.

    Every other column is an aggregate of its own, all of the same row: what is not read later is
    not carried, and numbers alone are aggregated by hash, without a sort of whole vectors.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        *[F.min_by(f"`{c}`", order).alias(c) for c in rest],
        F.min(label).alias("__lo"), F.max(label).alias("__hi")).where("__lo = __hi")
    return picked.select(*[F.col(f"`{c}`") for c in df.columns])


def cleaning_audit(df: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    clash = F.col("label_min") != F.col("label_max")
    out = vector_profile(df, keys, label).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("source_rows"),
        F.count_if(~clash).alias("unique_feature_rows"),
        F.coalesce(F.sum(F.when(clash, F.col("rows"))), F.lit(0)).alias("conflicting_label_rows"))
    return out.withColumn("redundant_rows_removed", F.col("source_rows")
                          - F.col("conflicting_label_rows") - F.col("unique_feature_rows"))


def balanced_sample(df: DataFrame, rows: int, key: Sequence[str] | str, seed=42,
                    label: str = "label") -> DataFrame:
    """`rows // 2` normal rows and the rest attacks, drawn without replacement."""
    quota = {0: rows // 2, 1: rows - rows // 2}
    have = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    for value, need in quota.items():
        if have.get(value, 0) < need:
            raise ValueError(f"{label}={value}: {have.get(value, 0)} rows, {need} wanted")
    kinds = dict(df.dtypes)
    cuts = hash_cuts(df, key, seed, {v: [lambda _, q=q: q] for v, q in quota.items()}, label)
    inside = [(F.col(label) == v) & up_to_cut(key, seed, cuts[v][1][0], kinds)
              for v in quota if v in cuts]
    return df.where(reduce(lambda a, b: a | b, inside))


def stratified_split(df: DataFrame, key: Sequence[str] | str,
                     fractions: dict[str, float] | None = None, seed=42,
                     label: str = "label") -> DataFrame:
    """Add `split`, 60/20/20 inside every label by default."""
    fractions = fractions or {"train": 0.6, "validation": 0.2, "test": 0.2}
    if abs(sum(fractions.values()) - 1) > 1e-9:
        raise ValueError("the shares of the splits do not add up to 1")
    names, steps, upto = list(fractions), [], 0.0
    for name in names[:-1]:
        upto += fractions[name]
        steps.append(lambda n, u=upto: math.floor(n * u + 1e-9))
    return _parts_of(df, key, seed, label, "split", names, steps)


def _parts_of(df: DataFrame, key, seed, label: str, out: str, names: list, steps: list) -> DataFrame:
    """Add `out`: the first of `names` whose rank in the label's seeded shuffle is not passed yet."""
    kinds = dict(df.dtypes)
    cuts = hash_cuts(df, key, seed, {"*": steps}, label)
    part = F.lit(names[-1])
    for value, (_, places) in cuts.items():
        own = F.lit(names[-1])
        for name, cut in reversed(list(zip(names[:-1], places, strict=True))):
            own = F.when(up_to_cut(key, seed, cut, kinds), name).otherwise(own)
        part = F.when(F.col(label).eqNullSafe(F.lit(value)), own).otherwise(part)
    return df.withColumn(out, part)


def stratified_kfold(df: DataFrame, key: Sequence[str] | str, k: int = 5, seed=42,
                     label: str = "label") -> DataFrame:
    """Add `fold` in 1..k: equal cuts of the seeded shuffle inside every label."""
    steps = [lambda n, i=i: n * i // k for i in range(1, k)]
    return _parts_of(df, key, seed, label, "fold", list(range(1, k + 1)), steps)


def seeded_sample(df: DataFrame, n: int, key: Sequence[str] | str, seed=42) -> DataFrame:
    """`n` rows without replacement, the same ones for the same seed."""
    cuts = hash_cuts(df, key, seed, {"*": [lambda _: n]})
    if not cuts:
        return df
    return df.where(up_to_cut(key, seed, cuts[0][1][0], dict(df.dtypes)))


def normal_rows(df: DataFrame, label: str = "label", check: bool = True) -> DataFrame:
    normal = df.where(F.col(label) == 0)
    if check and normal.isEmpty():
        raise ValueError("no normal row to learn from")
    return normal


def split_leakage(df: DataFrame, keys: Sequence[str], split: str = "split") -> DataFrame:
    """Vectors seen in more than one split, and whether the split sizes add up."""
    per = df.groupBy(*keys).agg(F.min(split).alias("__lo"), F.max(split).alias("__hi"),
                                F.count(split).alias("__in"), F.count("*").alias("__n"))
    return per.agg(F.count_if(F.col("__lo") != F.col("__hi")).alias("leaking_vectors"),
                   F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
                   F.coalesce(F.sum("__in"), F.lit(0)).alias("assigned_rows"))


def split_summary(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    return df.groupBy(split).agg(
        F.count("*").alias("rows"), F.count_if(F.col(label) == 0).alias("normal"),
        F.count_if(F.col(label) == 1).alias("attack"),
        F.avg(F.col(label).cast("double")).alias("attack_rate"))
