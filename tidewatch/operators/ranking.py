"""Global order without a single-task window.

`Window.orderBy` with no partition moves every row to one task. The helpers here cut the order
into literal, quantile-based ranges instead: ranges are summed, the few range totals are
accumulated, and the running sum inside each range is shifted by its offset. The cut points only
decide the balance of the ranges, never the result.
"""

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.functions.hashing import hash_u32
from tidewatch.session import settle

HASH_BITS = 32


def _default_buckets(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(2 * parts, 4000))


def cut_points(df: DataFrame, key: str, buckets: int | None = None) -> list[float]:
    """At most `buckets` literal cut points that spread the rows evenly along `key`."""
    n = buckets or _default_buckets(df)
    cuts = df.approxQuantile(key, [i / n for i in range(1, n)], 1 / (4 * n))
    return sorted({c for c in cuts if c == c and abs(c) != float("inf")})


def order_bucket(df: DataFrame, key: str, name: str, buckets: int | None = None,
                 cuts: list[float] | None = None) -> DataFrame:
    """Add `name`, a bucket number that never decreases as the numeric column `key` grows."""
    if cuts is None:
        cuts = cut_points(df, key, buckets)
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [-float("inf"), *cuts, float("inf")]
    staged = Bucketizer(splits=splits, inputCol=key, outputCol=name,
                        handleInvalid="keep").transform(df)
    return staged.withColumn(name, F.col(name).cast("int"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join on `keys` where null equals null; the right keys are not kept."""
    renamed = right.select(
        *[F.col(f"`{k}`").alias(f"__r_{i}") for i, k in enumerate(keys)],
        *[F.col(f"`{c}`") for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [
        left[f"`{k}`"].eqNullSafe(renamed[f"__r_{i}"]) for i, k in enumerate(keys)])
    return left.join(renamed, cond, how).drop(*[f"__r_{i}" for i in range(len(keys))])


def prefix_sum(df: DataFrame, order: Sequence, sums: dict[str, Column],
               group: Sequence[str] = (), key: Column | None = None,
               buckets: int | None = None, cuts: list[float] | None = None,
               totals: dict[str, str] | None = None) -> DataFrame:
    """Add inclusive running totals `sums` in `order`, restarted for every `group`.

    `key` is a numeric expression that never decreases along `order`; by default the first
    order column. No task ever holds more than one range of one group. `cuts` may bring ready
    cut points for `key`; otherwise one pass over `df` finds them. `totals` adds the
    whole sum of a group under a new name: {new name: name in sums}.
    """
    group = list(group)
    key = key if key is not None else F.col(order[0])
    staged = order_bucket(df.withColumn("__key", key.cast("double")), "__key", "__range",
                          buckets, cuts).drop("__key")
    part = [*group, "__range"]
    per_range = staged.groupBy(*part).agg(*[
        F.sum(e).alias(f"__t_{n}") for n, e in sums.items()])
    whole = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = whole.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(*part, *[
        F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums],
        *[F.sum(f"__t_{n}").over(whole).alias(t) for t, n in (totals or {}).items()])
    inside = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    running = staged.withColumns({n: F.sum(e).over(inside) for n, e in sums.items()})
    # without groups the offsets are one row per range, at most `buckets` of them
    joined = null_safe_join(running, offsets if group else F.broadcast(offsets), part)
    return joined.withColumns({n: F.col(n) + F.col(f"__o_{n}") for n in sums}).drop(
        "__range", *[f"__o_{n}" for n in sums])


def global_row_number(df: DataFrame, first: str, key: str, name: str) -> DataFrame:
    """1-based position in the order (`first`, `key`); `key` is a unique number.

    Equal `first` values may hold any share of the rows, so ties are cut by ranges of `key`.
    """
    staged = order_bucket(df, key, "__tie")
    cells = settle(staged.groupBy(first, "__tie").agg(F.count("*").alias("__n")))
    placed = prefix_sum(cells, [first, "__tie"], {"__upto": F.col("__n")})
    offsets = placed.select(first, "__tie", (F.col("__upto") - F.col("__n")).alias("__before"))
    inside = W.partitionBy(first, "__tie").orderBy(key)
    return null_safe_join(staged, offsets, [first, "__tie"]).withColumn(
        name, F.col("__before") + F.row_number().over(inside)).drop("__tie", "__before")


def hash_rank(df: DataFrame, key: Sequence[str] | str, seed, group: Sequence[str] = (),
              bits: int = 8, name: str = "draw_rank", total: str | None = None) -> DataFrame:
    """1-based position of every row in a seeded shuffle, per `group`.

    `key` identifies a row. The hash is uniform, so its leading `bits` are balanced ranges and
    no sampling pass is needed; raise `bits` with the row count.
    """
    keys = [key] if isinstance(key, str) else list(key)
    group = list(group)
    staged = df.withColumn("__h", hash_u32(seed, *keys))
    staged = staged.withColumn("__range", F.shiftright("__h", HASH_BITS - bits).cast("int"))
    part = [*group, "__range"]
    counts = staged.groupBy(*part).agg(F.count("*").alias("__n"))
    base = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = base.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"),
        *([F.sum("__n").over(base).alias(total)] if total else []))
    inside = W.partitionBy(*part).orderBy("__h", *keys)
    ranked = staged.withColumn("__rn", F.row_number().over(inside))
    joined = null_safe_join(ranked, offsets if group else F.broadcast(offsets), part)
    return joined.withColumn(name, F.col("__rn") + F.col("__o")).drop(
        "__h", "__range", "__rn", "__o")


PREFIX_BITS = 16


def hash_cuts(df: DataFrame, key: Sequence[str] | str, seed, ranks: dict, group: str | None = None
              ) -> dict:
    """Places in a seeded shuffle without moving the rows.

    `ranks` has, per value of `group`, functions of the group's size that give wanted 1-based ranks.
    Returns {group: (size, [cut, ...])}; a cut is the literal (hash, key, ...) of the row at that
    rank, or None for a rank below 1. Groups, hashes and keys are settled as a narrow table, which is
    counted by hash prefix (2^16 per group); only the rows of a prefix that holds a cut are put in
    order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    name = F.col(f"`{group}`") if group else F.lit(0)
    # settled, so the source behind it and its hashes are computed once
    staged = settle(df.select(name.alias("__g"), hash_u32(seed, *keys).alias("__h"), *keys).withColumn(
        "__p", F.shiftright("__h", HASH_BITS - PREFIX_BITS)))
    counts: dict = {}
    for r in staged.groupBy("__g", "__p").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r["__g"], {})[r["__p"]] = r["n"]
    wanted, out = [], {}
    for g, per in counts.items():
        size = sum(per.values())
        cuts = [min(size, int(f(size))) for f in ranks.get(g, ranks.get("*", []))]
        out[g] = (size, [None] * len(cuts))
        for i, rank in enumerate(cuts):
            before = 0
            for p in sorted(per):
                if before < rank <= before + per[p]:
                    wanted.append((g, p, rank - before, i))
                    break
                before += per[p]
    if wanted:
        kind = staged.schema["__g"].dataType.simpleString()
        spots = df.sparkSession.createDataFrame(wanted, f"__g {kind}, __p long, __n int, __i int")
        order = W.partitionBy("__g", "__p").orderBy("__h", *keys)
        held = null_safe_join(staged, F.broadcast(spots.select("__g", "__p").distinct()),
                              ["__g", "__p"]).withColumn("__n", F.row_number().over(order))
        for r in null_safe_join(held, F.broadcast(spots), ["__g", "__p", "__n"]).collect():
            out[r["__g"]][1][r["__i"]] = (r["__h"], *[r[k] for k in keys])
    return out


def up_to_cut(key: Sequence[str] | str, seed, cut: tuple | None, kinds: dict[str, str]) -> Column:
    """Whether a row stands at or before a cut of `hash_cuts`: a comparison with literals."""
    keys = [key] if isinstance(key, str) else list(key)
    if cut is None:
        return F.lit(False)
    own = F.struct(hash_u32(seed, *keys), *[F.col(k) for k in keys])
    return own <= F.struct(F.lit(cut[0]).cast("bigint"), *[
        F.lit(v).cast(kinds[k]) for k, v in zip(keys, cut[1:], strict=True)])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str],
         variable: str = "feature", value: str = "value", cast: str | None = "double") -> DataFrame:
    """Wide to long; one projection, no shuffle."""
    ids = [F.col(f"`{i}`") for i in ids]
    vals = [F.col(f"`{v}`").cast(cast).alias(v) if cast else F.col(f"`{v}`") for v in values]
    return df.select(*ids, *vals).unpivot(
        ids, [F.col(f"`{v}`") for v in values], variable, value)


def plain_doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as doubles without negative zero, named by their place; missing stays missing."""
    return df.select(*[(F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias(f"c{i}")
                       for i, c in enumerate(cols)])


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, n) of the numbers of each column; a batch counts its own values first."""
    names = list(cols)

    def counts(batches):
        for batch in batches:
            found = []
            for column in batch.columns:
                x = column.drop_null().to_numpy(zero_copy_only=False)
                found.append(np.unique(x[~np.isnan(x)], return_counts=True))
            at = np.repeat(np.arange(len(found), dtype=np.int32), [len(v) for v, _ in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(np.concatenate([v for v, _ in found]), pa.float64()),
                 pa.array(np.concatenate([n for _, n in found]), pa.int64())],
                names=["i", "value", "n"])

    if not names:
        return df.sparkSession.createDataFrame([], "feature string, value double, n long")
    return plain_doubles(df, names).mapInArrow(counts, "i int, value double, n long").groupBy(
        "i", "value").agg(F.sum("n").alias("n")).select(
        F.get(F.array(*map(F.lit, names)), F.col("i")).alias("feature"), "value", "n")


def value_ranks(df: DataFrame, cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """(group, feature, value, n, upto, nth, size, distinct): distinct numeric values with
    running counts of rows and values."""
    if group:
        long = melt(df, group, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
        counted = long.groupBy(*group, "feature", (F.col("value") + F.lit(0.0)).alias("value")
                               ).agg(F.count("*").alias("n"))
    else:
        counted = value_counts(df, cols)
    counted = settle(counted)
    return prefix_sum(counted, ["value"], {"upto": F.col("n"), "nth": F.lit(1)},
                      group=[*group, "feature"], totals={"size": "upto", "distinct": "nth"})


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: dict[str, float],
                    group: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated exact quantiles: one row per (group, feature).

    Works on distinct values with running counts, so no group's values meet in one task.
    """
    return quantiles_of(value_ranks(df, cols, group), probs, group)


def quantiles_of(ranked: DataFrame, probs: dict[str, float],
                 group: Sequence[str] = ()) -> DataFrame:
    """Quantiles from a `value_ranks` table."""
    group = list(group)
    start = F.col("upto") - F.col("n")

    def at(index: Column) -> Column:
        return F.max(F.when((start <= index) & (index < F.col("upto")), F.col("value")))

    picks = []
    for name, p in probs.items():
        pos = (F.col("size") - 1) * F.lit(float(p))
        picks += [at(F.floor(pos)).alias(f"__lo_{name}"), at(F.ceil(pos)).alias(f"__hi_{name}")]
    picked = ranked.groupBy(*group, "feature", "size").agg(*picks)
    out = []
    for name, p in probs.items():
        pos = (F.col("size") - 1) * F.lit(float(p))
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return picked.select(*group, "feature", "size", *out)


def quantile_grid(df: DataFrame, col: str, probs: Sequence[float]) -> list[float]:
    """Exact quantiles of one column for many probabilities, as plain numbers.

    Only the distinct values that sit on a wanted position leave the executors, at most two
    per probability.
    """
    ranked = value_ranks(df.select(F.col(col).cast("double").alias("x")), ["x"])
    first = ranked.select("size").first()
    if first is None:
        return []
    size = first["size"]
    spots = [(size - 1) * p for p in probs]
    wanted = sorted({i for s in spots for i in (math.floor(s), math.ceil(s))})
    edges = [float(w) for w in wanted]
    at = ranked.withColumn("__a", F.col("upto") - F.col("n") - 0.5).withColumn(
        "__b", F.col("upto") - 0.5)
    at = order_bucket(order_bucket(at, "__a", "__ka", cuts=edges), "__b", "__kb", cuts=edges)
    hits = at.where("__kb > __ka").select("value", "__ka", "__kb").collect()
    value = {wanted[i]: r["value"] for r in hits for i in range(r["__ka"], r["__kb"])}
    out = []
    for s in spots:
        lo, hi = value[math.floor(s)], value[math.ceil(s)]
        out.append(lo + (hi - lo) * (s - math.floor(s)))
    return out


def one_row(*frames: DataFrame) -> DataFrame:
    """Several one-row aggregates with different columns as one row, without a join."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])
