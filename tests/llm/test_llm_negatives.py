"""Hard negatives against all pairs, in one process and in SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tidewatch.llm import hard_negatives as hn
from tidewatch.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, row int, score string"


def plain(rows, anchor, positives=5, negatives=10):
    kept = {}
    for vec_id, e, label in rows:
        if vec_id is None or label is None or e is None or any(
                x is None or not math.isfinite(x) for x in e):
            continue
        if vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        kept[vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in e)] = None
    kept = list(kept)
    out = []
    for a in kept:
        if not anchor(a[0]):
            continue
        score = lambda b: sum(x * y for x, y in zip(a[2], b[2]))  # noqa: B023
        scored = sorted(((-score(b), b[0], b[1]) for b in kept if b is not a))
        for s, p, _ in [x for x in scored if x[2] == a[1]][:positives]:
            fits = [x for x in scored if x[2] != a[1] and -30 * s <= -100 * x[0] <= -90 * s]
            out += [(a[0], p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fits[:negatives])]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = hn.mine(hn.integer_rows(df), F.col("id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(map(tuple, got.collect()))


def test_against_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        scale = rng.choice([0.1, 1, 1, 1, 30])
        rows.append((i, [rng.gauss(0, 1) * scale + 0.4 for _ in range(6)], rng.randrange(4)))
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(300)]  # copies of one vector, ties
    rows += [rows[5], rows[100], (2000, [0.0] * 6, 1), (2100, [1.0, 2.0], 2),
             (None, [1.0] * 6, 1), (2200, None, 1), (2300, [1.0] * 6, None), (2400, [], 1),
             (2500, [None] + [1.0] * 5, 1), (2600, [math.nan] + [1.0] * 5, 1),
             (2700, [math.inf] + [1.0] * 5, 1), (2800, [-0.5] * 6, -3), (2900, [3e6] * 6, 0)]
    want = plain(rows, lambda i: i % 100 == 0)
    assert len(want) > 200
    assert mined(spark, rows) == want
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []


def test_ranges_lose_no_row():
    """Every row that reaches the score is among the feasible ones, and they are fewer than all."""
    rng = np.random.default_rng(1)
    fewer = 0
    for i in range(200):
        # a few large coordinates leave narrow ranges, even ones leave nearly all rows
        vectors = rng.normal(size=(300, 8)) ** (1 if i % 4 == 0 else 5)
        if i % 2:  # rows of a length class
            vectors *= rng.uniform(1, 1.09, 300)[:, None] / np.linalg.norm(vectors, axis=1)[:, None]
        vectors = np.round(vectors * 1000).astype(np.int64)
        bucket = hn.Bucket(np.arange(300), np.arange(300), np.zeros(300), vectors)
        anchor = vectors[rng.integers(300)].astype(np.float64) + rng.normal(size=8).round()
        scores = vectors @ anchor.astype(np.int64)
        least = int(np.sort(scores)[-rng.integers(1, 20)])
        chosen = bucket.feasible(anchor, least)
        if chosen is not None:
            fewer += 1
            assert set(np.flatnonzero(scores >= least)) <= set(chosen.tolist())
    assert fewer > 50


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_query_and_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    got = queries.QUERIES["op13_hard_negatives"](spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    want = con.execute(hn.ORACLE_SQL)
    assert [c[0] for c in want.description] == got.columns
    want = sorted(want.fetchall())
    assert want and sorted(map(tuple, got.collect())) == want
