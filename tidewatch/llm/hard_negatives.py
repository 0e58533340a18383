"""Hard negatives by inner product: length buckets and feasible ranges of focus coordinates.

Integer vectors are filed by length: a bucket holds rows whose lengths are within a twelfth of each
other, split by hash to a bounded number of rows, with every coordinate of the unit vectors as a
sorted list. For an anchor and the score it must reach, a bucket whose longest row is too short is
never visited. In a visited one the score becomes the least cosine; the angle it allows around the
anchor bounds each coordinate of a row. The anchor's largest coordinates are its focus: the ranges
feasible for them are cut out of the sorted lists, the shortest cut is intersected with the other
ranges, and what is left is verified by its exact inner product. Where the ranges leave most of a
bucket, its rows are verified in one matrix product.

The score to reach comes from rounds: every eighth shard of each length class is searched with what
is known before (nothing for positives, the lower bound for negatives), the rest with the last score
found there. Anchors travel to the buckets in packed groups; from a bucket they take no more rows
than a result can show, so no row is moved for every anchor and no anchor's rows are gathered.

Defined results: rows with a null id, label or vector or with a null component take no part; missing
components of shorter vectors count as zero; rows that are equal in id, label and vector count once,
other rows of one id are rows of their own; copies of a vector under other ids are candidates like
any row; ties go to the smaller id; fewer rows than asked for give fewer; anchors without positives
and positives without negatives give no rows; an empty table gives none; other columns play no part.
Scores are exact if they fit 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.session import scratch_path

FOCUS = 4
#: Length classes per doubling; rows of a shard, anchors of a group, at most on average.
CLASSES, SHARD_ROWS, GROUP_ROWS = 8, 131_072, 256
FIRST_ROUND = 8
#: Share of a bucket from which one matrix product is cheaper than picking rows.
DENSE = 0.25
#: Slack for rounding in cosines and angles: a range may only be too wide.
SLACK = 1e-9
EXACT = 2.0 ** 53
ANCHORS = ("array<struct<row:bigint,label:bigint,vector:array<bigint>,length:double,"
           "ranges:array<struct<positive:bigint,low:bigint,high:bigint>>>>")
FOUND = "anchor long, positive long, row long, id long, score long"
LOWEST, HIGHEST = -2**63, 2**63 - 1


def _matrix(lists: list[pa.Array]) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros."""
    sizes = np.concatenate([np.diff(x.offsets.to_numpy()) for x in lists])
    flat = np.concatenate([x.flatten().to_numpy() for x in lists])
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


class Bucket:
    """Rows of similar length, their unit vectors, and sorted coordinate lists made on demand."""

    def __init__(self, rows, ids, labels, vectors: np.ndarray):
        self.rows, self.ids, self.labels, self.vectors = rows, ids, labels, vectors
        self.real = vectors.astype(np.float64)
        lengths = np.sqrt((self.real * self.real).sum(axis=1))
        self.longest = lengths.max(initial=0.0)
        self.unit = self.real / np.where(lengths > 0, lengths, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.verified = 0

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        if coordinate not in self.lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self.lists[coordinate] = order, self.unit[order, coordinate]
        return self.lists[coordinate]

    def feasible(self, anchor: np.ndarray, least: int) -> np.ndarray | None:
        """Rows that may score `least` or more; None for all."""
        length = math.sqrt(float((anchor * anchor).sum()))
        if length * self.longest * (1 + SLACK) < least:
            return np.zeros(0, dtype=np.int64)
        if not length or not self.longest or least <= -length * self.longest:
            return None
        # rows are no longer than the longest, so a positive score asks for this cosine at least;
        # a negative one allows every angle up to that of the shortest row
        if least <= 0:
            return None
        widest = math.acos(min(1.0, least / (length * self.longest) * (1 - SLACK)))
        unit = anchor / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        angles = np.arccos(np.clip(unit[focus], -1, 1))
        low = np.cos(np.minimum(math.pi, angles + widest)) - SLACK
        high = np.cos(np.maximum(0.0, angles - widest)) + SLACK
        cuts = []
        for f, a, b in zip(focus.tolist(), low, high, strict=True):
            if f < self.unit.shape[1]:
                values = self.sorted_list(f)[1]
                cuts.append((int(np.searchsorted(values, a)), int(np.searchsorted(values, b, "right")),
                             f, a, b))
            elif a > 0 or b < 0:  # the coordinate is zero in all rows
                return np.zeros(0, dtype=np.int64)
        if not cuts:
            return None
        begin, end, first, _, _ = min(cuts, key=lambda c: c[1] - c[0])
        if end - begin > DENSE * len(self.ids):
            inside = np.ones(len(self.ids), dtype=bool)
            for _, _, f, a, b in cuts:
                inside &= (self.unit[:, f] >= a) & (self.unit[:, f] <= b)
            chosen = np.flatnonzero(inside)
            return None if len(chosen) > DENSE * len(self.ids) else chosen
        chosen = self.lists[first][0][begin:end]
        for _, _, f, a, b in cuts:
            if f != first:
                chosen = chosen[(self.unit[chosen, f] >= a) & (self.unit[chosen, f] <= b)]
        return chosen

    def scores(self, anchor: np.ndarray, chosen: np.ndarray | None) -> np.ndarray:
        n = min(self.vectors.shape[1], len(anchor))
        real = self.real if chosen is None else self.real[chosen]
        self.verified += len(real)
        if math.sqrt(float((anchor * anchor).sum())) * self.longest < EXACT:
            return (real[:, :n] @ anchor[:n]).astype(np.int64)
        whole = self.vectors if chosen is None else self.vectors[chosen]
        return whole[:, :n] @ anchor[:n].astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by id, then row."""
    places = np.arange(len(scores))
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    return places[np.lexsort((rows[places], ids[places], -scores[places]))[:k]]


def search_bucket(bucket: Bucket, anchors: list[dict], same: bool, k: int) -> Iterator[tuple]:
    """(anchor, positive, row, id, score): the k best rows in each of an anchor's score ranges."""
    for a in anchors:
        ranges = a["ranges"]
        least = min(r["low"] for r in ranges)
        vector = np.array(a["vector"], dtype=np.float64)
        chosen = bucket.feasible(vector, least)
        labels = bucket.labels if chosen is None else bucket.labels[chosen]
        fits = labels == a["label"] if same else labels != a["label"]
        if same:
            fits &= (bucket.rows if chosen is None else bucket.rows[chosen]) != a["row"]
        chosen = np.flatnonzero(fits) if chosen is None else chosen[fits]
        if not len(chosen):
            continue
        if len(chosen) == len(bucket.ids):
            score = bucket.scores(np.array(a["vector"]), None)
        else:
            score = bucket.scores(np.array(a["vector"]), chosen)
        ids, rows = bucket.ids[chosen], bucket.rows[chosen]
        for r in ranges:
            own = np.flatnonzero((score >= r["low"]) & (score <= r["high"]))
            for i in own[best(score[own], ids[own], rows[own], k)]:
                yield a["row"], r["positive"], int(rows[i]), int(ids[i]), int(score[i])


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                      names=["anchor", "positive", "row", "id", "score"])


def _search(batches, same: bool, k: int):
    """A stream sorted by bucket: its rows, then the groups of anchors that visit it."""
    current, waiting, bucket, out = None, [], None, []
    for batch in batches:
        column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023
        keys = column("bucket").to_numpy() * 2 + column("visit").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if keys[a] // 2 != current:
                current, waiting, bucket = keys[a] // 2, [], None
            if keys[a] % 2 == 0:
                waiting.append([column(c)[a:b] for c in ("row", "id", "label", "vector")])
                continue
            if not waiting:
                continue
            if bucket is None:
                parts = list(zip(*waiting, strict=True))
                bucket = Bucket(*[np.concatenate([x.to_numpy() for x in p]) for p in parts[:3]],
                                _matrix(parts[3]))
            for group in column("anchors")[a:b].to_pylist():
                out.extend(search_bucket(bucket, group, same, k))
                if len(out) > 10_000:
                    yield _found(out)
                    out = []
    if out:
        yield _found(out)


def _visits(anchors: DataFrame, classes: DataFrame, first: bool) -> DataFrame:
    """Groups of anchors at every bucket of the round whose rows are long enough for one of them.

    `classes` is one row: its array has an entry per length class, of which doubles allow 17,000.
    """
    groups = anchors.groupBy(F.pmod(F.xxhash64("row"), "groups").alias("group")).agg(
        F.collect_list(F.struct("row", "label", "vector", "length", "ranges")).cast(ANCHORS).alias(
            "anchors"))
    reach = lambda c: F.exists("anchors", lambda a: a["length"] * c["longest"] * (1 + SLACK)
                               >= F.array_min(F.transform(a["ranges"], lambda r: r["low"])))
    listed = groups.crossJoin(F.broadcast(classes)).select("anchors", F.explode(F.filter(
        "classes", reach)).alias("c"))
    shard = F.explode(F.filter(F.sequence(F.lit(0), F.col("c.shards") - 1), lambda s: (
        s % FIRST_ROUND == 0) == F.lit(first)))
    return listed.select("anchors", "c.class", shard.alias("shard"))


def _round(rows: DataFrame, anchors: DataFrame, classes: DataFrame, first: bool, same: bool,
           k: int) -> DataFrame:
    bucket = lambda: F.pmod(F.xxhash64("class", "shard"), F.lit(2**62)).alias("bucket")
    none = lambda kind: F.lit(None).cast(kind)
    held = rows.where((F.col("shard") % FIRST_ROUND == 0) == F.lit(first)).select(
        bucket(), F.lit(0).alias("visit"), "row", "id", "label", "vector", none(ANCHORS).alias("anchors"))
    asking = _visits(anchors, classes, first).select(
        bucket(), F.lit(1).alias("visit"), none("long").alias("row"), none("long").alias("id"),
        none("long").alias("label"), none("array<bigint>").alias("vector"), "anchors")
    return held.unionByName(asking).repartition("bucket").sortWithinPartitions(
        "bucket", "visit").mapInArrow(lambda batches: _search(batches, same, k), FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(rows: DataFrame, classes: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor, positive, row, id, score, rank): the k best rows in every score range of an anchor.

    Of the same label as the anchor, or of any other. `anchors` has row, label, vector, length,
    groups and ranges.
    """
    spark = rows.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    early = written(_top(_round(rows, anchors, classes, True, same, k), k), "mined-first")
    # a range with k rows needs no score below the last of them any more
    last = early.where(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(
        F.struct("positive", "score"))).alias("last"))
    raised = F.transform("ranges", lambda r: F.struct(
        r["positive"].alias("positive"),
        F.greatest(r["low"], F.try_element_at("last", r["positive"])).alias("low"),
        r["high"].alias("high")))
    later = anchors.join(last, F.col("row") == F.col("anchor"), "left").withColumn(
        "ranges", raised).drop("anchor", "last")
    return written(_top(early.drop("rank").unionByName(
        _round(rows, later, classes, False, same, k)), k), "mined")


def filed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rows with their length class and shard, and the one-row table of classes."""
    spark = rows.sparkSession
    whole = F.expr("forall(vector, x -> x IS NOT NULL)")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    path = scratch_path(spark, "mined-rows")
    rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                F.col("vector").cast("array<bigint>").alias("vector")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & whole).dropDuplicates().select(
        F.monotonically_increasing_id().alias("row"), "*", length.alias("length")).withColumn(
        "class", F.when(F.col("length") > 0, F.floor(F.log2("length") * CLASSES)).otherwise(
            F.lit(-2**40))).write.parquet(path)
    kept = spark.read.parquet(path)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per = kept.groupBy("class").agg(F.count("*").alias("n"), F.max("length").alias("longest"))
    total = per.agg(F.sum("n").alias("total"), F.collect_list(F.struct(
        "class", "n", "longest")).alias("listed"))
    # small tables are spread over all partitions, large ones cut to bounded shards
    size = F.ceil(F.col("total") / F.greatest(F.lit(parts), F.ceil(F.col("total") / SHARD_ROWS)))
    classes = total.select(F.transform("listed", lambda c: F.struct(
        c["class"].alias("class"), c["longest"].alias("longest"),
        F.ceil(c["n"] / size).cast("int").alias("shards"))).alias("classes"))
    lookup = classes.select(F.explode("classes").alias("c")).select("c.class", "c.shards")
    placed = kept.join(F.broadcast(lookup), "class").withColumn(
        "shard", F.pmod(F.xxhash64("row", "id"), "shards").cast("int")).drop("shards")
    return placed, classes


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` has `id`, `label` and an integer `vector`. Positives are an anchor's best rows of its
    label; negatives of a positive are the best rows of other labels whose scores are `low` to
    `high` percent of the positive's.
    """
    placed, classes = filed(rows)
    chosen = placed.where(is_anchor)
    count = chosen.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / GROUP_ROWS)).alias("groups"))
    anchors = chosen.crossJoin(F.broadcast(count)).select("row", "id", "label", "vector", "length",
                                                         "groups")
    one = F.array(F.struct(F.lit(0).cast("long").alias("positive"), F.lit(LOWEST).alias("low"),
                           F.lit(HIGHEST).alias("high")))
    best_of_label = search(placed, classes, anchors.withColumn("ranges", one), True, positives)
    score = F.col("score")
    pairs = best_of_label.select(
        "anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id"),
        score.alias("positive_score"),
        F.expr(f"-((-{low} * score - pmod(-{low} * score, 100)) div 100)").alias("low"),
        F.expr(f"({high} * score - pmod({high} * score, 100)) div 100").alias("high"))
    ranges = pairs.where("low <= high").groupBy("anchor").agg(
        F.collect_list(F.struct("positive", "low", "high")).alias("ranges"))
    asking = anchors.join(ranges, F.col("row") == F.col("anchor")).drop("anchor")
    found = search(placed, classes, asking, False, negatives)
    ids = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(pairs.drop("low", "high"), ["anchor", "positive"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def integer_rows(embeddings: DataFrame) -> DataFrame:
    """The query's rows: components as floor(256 x), every seventh id under the next label."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").alias("id"), moved.alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vector"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
            AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
