"""Rank correlation and redundancy: which columns carry nothing new."""

import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranking import plain_doubles, prefix_sum, quantiles_of, value_ranks
from tidewatch.session import settle, settle_wide

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
HEAVY = 1_000  # a value with at least this share (1 / HEAVY) of the rows is looked up, not joined


def numeric_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [c for c in cols if kinds[c] in NUMERIC_TYPES or kinds[c].startswith("decimal")]


def _tied_rank():
    """Tie-averaged rank of a distinct value, centred and scaled, so that squares stay small."""
    return (F.col("upto") - (F.col("n") - 1) / 2 - (F.col("size") + 1) / 2) / F.col("size")


def _rank_matrix(df: DataFrame, cols: list[str],
                 ranked: DataFrame | None = None) -> dict[tuple[str, str], float | None]:
    """Pearson correlation of tie-averaged ranks for columns without missing values.

    A value that holds at least 1 / `HEAVY` of the rows is heavy: there are at most `HEAVY` of them
    per column, so their ranks go to every task, which sums the products of all column pairs of its
    rows at once. Only rows with other cells travel: these get their ranks by a join, in which no
    value is hot, and return to their rows.
    """
    names = list(cols)
    slots = [f"c{i}" for i in range(len(names))]
    data = settle_wide(plain_doubles(df, names).select(
        F.monotonically_increasing_id().alias("__row"), *slots), "ranks")
    if ranked is None:
        ranked = value_ranks(df, names)
    ranks = ranked.where(F.col("feature").isin(names)).select(
        "feature", "value", "n", "size", "distinct", _tied_rank().alias("rank"))
    heavy = F.col("n") * HEAVY >= F.col("size")
    listed = ranks.where(heavy).toPandas().sort_values(["feature", "value"])
    kinds = ranks.groupBy("feature").agg(F.max("distinct").alias("distinct"),
                                         F.count_if(~heavy).alias("light")).collect()
    varied = {r["feature"] for r in kinds if r["distinct"] > 1}
    shared = df.sparkSession.sparkContext.broadcast({
        c: (g["value"].to_numpy(), g["rank"].to_numpy()) for c, g in listed.groupby("feature")})

    def looked_up(batch) -> np.ndarray:
        """Ranks of the heavy cells, one line per column; the others are missing."""
        out = np.full((len(names), batch.num_rows), np.nan)
        for i, c in enumerate(names):
            if c in shared.value:
                values, rank = shared.value[c]
                x = batch.column(slots[i]).to_numpy()
                at = np.minimum(np.searchsorted(values, x), len(values) - 1)
                out[i] = np.where(values[at] == x, rank[at], np.nan)
        return out

    def light_cells(batches):
        for batch in batches:
            i, at = np.nonzero(np.isnan(looked_up(batch)))
            cells = np.stack([batch.column(c).to_numpy() for c in slots])[i, at]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__row").take(pa.array(at)), pa.array(i.astype(np.int32)),
                 pa.array(cells)], names=["__row", "i", "value"])

    def open_rows(batches):
        for batch in batches:
            yield batch.filter(pa.array(np.isnan(looked_up(batch)).any(axis=0)))

    left, right = np.triu_indices(len(names))

    def summed(total) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"i": pa.array(left, pa.int32()),
                                           "j": pa.array(right, pa.int32()),
                                           "s": pa.array(total[left, right])})

    def products(batches):
        total = np.zeros((len(names), len(names)))
        for batch in batches:
            cells = looked_up(batch)
            cells = cells[:, ~np.isnan(cells).any(axis=0)]
            total += cells @ cells.T
        yield summed(total)

    def open_products(batches):
        total = np.zeros((len(names), len(names)))
        for batch in batches:
            cells = looked_up(batch)
            at = batch.column("__i")
            sizes = pc.list_value_length(at).to_numpy()
            cells[at.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), sizes)] = (
                batch.column("__rank").flatten().to_numpy())
            total += cells @ cells.T
        yield summed(total)

    sums = data.mapInArrow(products, "i int, j int, s double")
    if any(r["light"] for r in kinds):
        number = F.array_position(F.array(*map(F.lit, names)), F.col("feature")).cast("int") - 1
        light = ranks.where(~heavy).select(number.alias("i"), "value", "rank")
        found = data.mapInArrow(light_cells, "__row long, i int, value double").join(
            light, ["i", "value"]).groupBy("__row").agg(
            F.collect_list("i").alias("__i"), F.collect_list("rank").alias("__rank"))
        sums = sums.unionByName(data.mapInArrow(open_rows, data.schema).join(
            found, "__row").mapInArrow(open_products, "i int, j int, s double"))
    sums = sums.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    gram = {(r["i"], r["j"]): r["s"] for r in sums}
    return {(cols[i], cols[j]): _bounded(gram[i, j], gram[i, i], gram[j, j])
            if {cols[i], cols[j]} <= varied else None
            for i, j in combinations(range(len(cols)), 2)}


def _bounded(product: float, left: float, right: float) -> float:
    return max(-1.0, min(1.0, product / math.sqrt(left * right)))


def _gapped_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> dict:
    """Correlations of pairs over the rows that have both values; all pairs in one plan."""
    def number(c: str):
        return F.nanvl(F.col(f"`{c}`").cast("double") + F.lit(0.0), F.lit(None))

    cells = settle(df.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("pair"), number(a).alias("x"), number(b).alias("y"))
        for k, (a, b) in enumerate(pairs)])).alias("c")).select("c.*").where(
        F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy("pair", "x", "y").agg(
        F.count("*").alias("times")))
    sides = {}
    for side in ("x", "y"):
        # distinct values with counts, so the times of a combination stand for its rows
        counted = cells.groupBy("pair", F.col(side).alias("value")).agg(F.sum("times").alias("n"))
        sides[side] = settle(prefix_sum(
            counted, ["value"], {"upto": F.col("n")}, group=["pair"], totals={"size": "upto"}).select(
            "pair", F.col("value").alias(side), "n", _tied_rank().alias(f"r{side}")))
    own = {side: {r["pair"]: r["s"] for r in t.groupBy("pair").agg(
        F.sum(F.col("n") * F.pow(f"r{side}", 2)).alias("s")).collect()} for side, t in sides.items()}
    both = cells.join(sides["x"].drop("n"), ["pair", "x"]).join(
        sides["y"].drop("n"), ["pair", "y"]).groupBy("pair").agg(
        F.sum(F.col("times") * F.col("rx") * F.col("ry")).alias("s")).collect()
    found = {r["pair"]: r["s"] for r in both}
    return {p: _bounded(found[k], own["x"][k], own["y"][k])
            if own["x"].get(k) and own["y"].get(k) else None for k, p in enumerate(pairs)}


def spearman(df: DataFrame, cols: Sequence[str],
             facts: dict | None = None,
             ranked: DataFrame | None = None) -> dict[tuple[str, str], float | None]:
    """Pairwise-complete Spearman correlation, one entry per pair in column order.

    Columns without gaps share one matrix; a pair with gaps is ranked on its complete rows.
    """
    cols = list(cols)
    if len(cols) < 2:
        return {}
    facts = facts or column_facts(df, cols)
    whole = [c for c in cols if facts[c]["gaps"] == 0]
    known = _rank_matrix(df, whole, ranked) if len(whole) > 1 else {}
    gapped = [p for p in combinations(cols, 2) if p not in known]
    if gapped:
        known |= _gapped_pairs(df, gapped)
    return {pair: known[pair] for pair in combinations(cols, 2)}


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full matrix in long form; the diagonal of a varying column is 1."""
    cols = list(cols)
    rho = spearman(df, cols)
    flat = {c for c in constant_columns(df, cols)}
    rows = []
    for a in cols:
        for b in cols:
            value = (None if a in flat else 1.0) if a == b else rho.get((a, b), rho.get((b, a)))
            rows.append((a, b, value))
    return df.sparkSession.createDataFrame(rows, "left string, right string, rho double")


def _plain(df: DataFrame):
    """Comparable form of a column: numbers as doubles without negative zero, gaps as null."""
    numeric = set(numeric_columns(df, df.columns))

    def plain(c: str):
        if c not in numeric:
            return F.col(f"`{c}`")
        x = F.col(f"`{c}`").cast("double") + F.lit(0.0)
        return F.when(~F.isnan(x), x)

    return plain, numeric


def column_facts(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """rows, gaps, lowest, highest and a checksum per column; a task hands on one row per column."""
    cols = list(cols)
    plain, _ = _plain(df)
    numbers = numeric_columns(df, cols)
    out: dict[str, dict] = {}

    def mixed(x):
        """A 64-bit hash of each double."""
        z = x.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (z ^ (z >> np.uint64(31))).view(np.int64)

    def facts(batches):
        rows, gaps = 0, [0] * len(numbers)
        low, high, total = [None] * len(numbers), [None] * len(numbers), [0] * len(numbers)
        for batch in batches:
            rows += batch.num_rows
            for i, column in enumerate(batch.columns):
                x = column.drop_null().to_numpy(zero_copy_only=False)
                x = x[~np.isnan(x)]
                gaps[i] += batch.num_rows - len(x)
                if len(x):
                    low[i] = float(x.min()) if low[i] is None else min(low[i], float(x.min()))
                    high[i] = float(x.max()) if high[i] is None else max(high[i], float(x.max()))
                    total[i] ^= int(np.bitwise_xor.reduce(mixed(x)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(numbers)), pa.int32()), pa.array([rows] * len(numbers), pa.int64()),
             pa.array(gaps, pa.int64()), pa.array(low, pa.float64()), pa.array(high, pa.float64()),
             pa.array(total, pa.int64())], names=["i", "rows", "gaps", "lo", "hi", "sum"])

    if numbers:
        found = {r["i"]: r for r in plain_doubles(df, numbers).mapInArrow(
            facts, "i int, rows long, gaps long, lo double, hi double, sum long").groupBy("i").agg(
            F.sum("rows").alias("rows"), F.sum("gaps").alias("gaps"), F.min("lo").alias("lo"),
            F.max("hi").alias("hi"), F.bit_xor("sum").alias("sum")).collect()}
        none = {"rows": 0, "gaps": 0, "lo": None, "hi": None, "sum": None}
        out |= {c: {k: found.get(i, none)[k] for k in none} for i, c in enumerate(numbers)}
    rest = [c for c in cols if c not in out]
    for part in (rest[i:i + 20] for i in range(0, len(rest), 20)):
        aggs = [F.count("*").alias("rows")]
        for i, c in enumerate(part):
            x = plain(c)
            aggs += [F.count_if(x.isNull()).alias(f"gaps{i}"), F.min(x).alias(f"lo{i}"),
                     F.max(x).alias(f"hi{i}"), F.bit_xor(F.xxhash64(x)).alias(f"sum{i}")]
        row = df.agg(*aggs).first()
        out |= {c: {"rows": row["rows"], "gaps": row[f"gaps{i}"], "lo": row[f"lo{i}"],
                    "hi": row[f"hi{i}"], "sum": row[f"sum{i}"]} for i, c in enumerate(part)}
    return out


def constant_columns(df: DataFrame, cols: Sequence[str], facts: dict | None = None) -> list[str]:
    """Columns with at most one value, null counted as a value."""
    facts = facts or column_facts(df, cols)
    return [c for c in cols if facts[c]["gaps"] == facts[c]["rows"]
            or (facts[c]["gaps"] == 0 and facts[c]["lo"] == facts[c]["hi"])]


def duplicate_columns(df: DataFrame, cols: Sequence[str],
                      facts: dict | None = None) -> list[tuple[str, str]]:
    """Pairs of columns equal in every row, nulls included.

    A per-column checksum leaves the few pairs that are then compared row by row.
    """
    facts = facts or column_facts(df, cols)
    plain, numeric = _plain(df)
    pairs = [(a, b) for a, b in combinations(list(cols), 2)
             if facts[a]["sum"] == facts[b]["sum"] and (a in numeric) == (b in numeric)]
    if not pairs:
        return []
    same = df.agg(*[F.bool_and(plain(a).eqNullSafe(plain(b))).alias(f"p{i}")
                    for i, (a, b) in enumerate(pairs)]).first()
    return [pair for i, pair in enumerate(pairs) if same[f"p{i}"]]


REASONS = ("duplicate", "Spearman")


def resolve(cols: Sequence[str], redundant: dict[tuple[str, str], str]) -> dict[str, tuple]:
    """Which columns go, and for whose sake: {removed: (retained, reason)}.

    `redundant` has the reason for each pair (earlier, later). Pairs are taken by the later column,
    then by reason, then by the earlier column; a pair acts if both of its columns still stand. All
    pairs that could remove the earlier one come before.
    """
    at = {c: i for i, c in enumerate(cols)}
    gone: dict[str, tuple] = {}
    for earlier, later in sorted(redundant, key=lambda p: (
            at[p[1]], REASONS.index(redundant[p]), at[p[0]])):
        if earlier not in gone and later not in gone:
            gone[later] = (earlier, redundant[earlier, later])
    return gone


def select_columns(df: DataFrame, cols: Sequence[str], threshold: float = 0.90):
    """(kept, report rows, medians of kept numbers); the earlier of two redundant columns stays.

    The statistics come from Spark; the driver sees one entry per pair of columns.
    """
    cols = list(cols)
    facts = column_facts(df, cols)
    flat = set(constant_columns(df, cols, facts))
    rest = [c for c in cols if c not in flat]
    varying = numeric_columns(df, rest)
    ranked = value_ranks(df, varying) if varying else None
    rho = spearman(df, varying, facts, ranked)
    redundant = {p: "Spearman" for p, r in rho.items() if r is not None and abs(r) >= threshold}
    redundant |= dict.fromkeys(duplicate_columns(df, rest, facts), "duplicate")
    gone = resolve(rest, redundant)
    report = [(c, None, None, "constant") if c in flat else
              (c, gone[c][0], rho.get((gone[c][0], c)), gone[c][1])
              for c in cols if c in flat or c in gone]
    kept = [c for c in rest if c not in gone]
    medians = {}
    if ranked is not None:
        wanted = ranked.where(F.col("feature").isin([c for c in kept if c in varying]))
        medians = {r["feature"]: r["m"] for r in quantiles_of(wanted, {"m": 0.5}).collect()}
    return kept, report, medians


REPORT_SCHEMA = "removed string, retained string, correlation double, reason string"
