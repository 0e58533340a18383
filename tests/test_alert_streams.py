"""Alerts on streams against the batch operators over the same events."""

import json
import random

import pytest
from pyspark.sql import functions as F
from tidewatch.operators import alerts as AL
from tidewatch.sources import jsonl as J
from tidewatch.streaming import alerts as SA
from tidewatch.streaming import queries as ST

SCHEMA = "source string, ts double, prediction int"


def write(path, rows):
    path.mkdir(exist_ok=True)
    n = len(list(path.iterdir()))
    (path / f"part-{n:03d}.log").write_text("".join(json.dumps(r) + "\n" for r in rows))


@pytest.fixture
def timers(spark):
    with SA.timers(spark):
        yield spark


def run(spark, tmp_path, portions, make):
    from pyspark.sql.types import _parse_datatype_string
    src = tmp_path / "in"
    for part in portions:
        write(src, part)
        ST.run_available(make(J.stream_jsonl(spark, str(src), _parse_datatype_string(SCHEMA))),
                         str(tmp_path / "out"), str(tmp_path / "ck"))
    return spark.read.parquet(str(tmp_path / "out"))


def test_silence_fires_without_events(timers, tmp_path):
    spark = timers
    rng = random.Random(1)
    rows = [{"source": "busy", "ts": float(t), "prediction": 0} for t in range(0, 1500, 2)]
    rows += [{"source": "dns", "ts": t + rng.random() / 3, "prediction": 0} for t in
             [*range(0, 200, 7), *range(400, 500, 3), *range(560, 700, 9)]]
    rows.sort(key=lambda r: r["ts"])
    # neighbours arrive in turned order, within the delay
    for i in range(0, len(rows) - 1, 5):
        rows[i], rows[i + 1] = rows[i + 1], rows[i]
    cut = [rows[i:i + 180] for i in range(0, len(rows), 180)]
    got = run(spark, tmp_path, cut, lambda s: SA.silence_stream(s, "source", delay=10)).collect()
    fired = sorted(tuple(r) for r in got if r["silent_until"] is None)
    ended = sorted(tuple(r) for r in got if r["silent_until"] is not None)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    want = sorted(("dns", r["silent_from"], r["fired_at"], r["silent_until"]) for r in AL.silence(
        df.where("source = 'dns'")).collect() if r["silent_until"] is not None)
    assert ended == want and len(want) == 1
    # the second alert is still open: its source never came back
    last = max(r["ts"] for r in rows if r["source"] == "dns")
    assert [f[:3] for f in fired] == [*[w[:3] for w in want], ("dns", last, last + 120)]


def test_rate_alert_equals_batch(timers, tmp_path):
    spark = timers
    rng = random.Random(2)
    rows = []
    for t in range(0, 3000):
        hot = 400 <= t < 900 or 1500 <= t < 1700 or 2300 <= t < 2750
        if not 1900 <= t < 2200:
            rows.append({"source": "dns", "ts": t + rng.random() / 2,
                         "prediction": int(rng.random() < (0.9 if hot else 0.1))})
    # the last windows close
    rows.append({"source": "dns", "ts": 9000.0, "prediction": 0})
    rows.append({"source": "dns", "ts": 9500.0, "prediction": 0})
    cut = [rows[i:i + 700] for i in range(0, len(rows), 700)]
    got = run(spark, tmp_path, cut, lambda s: SA.rate_alert_stream(s, "source")).collect()
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    want = sorted((r["started_at"], r["fired_at"], r["ended_at"], r["peak_share"])
                  for r in AL.rate_alert(df).collect())
    ended = sorted((r["started_at"], r["fired_at"], r["ended_at"], r["peak_share"])
                   for r in got if r["ended_at"] is not None)
    assert len(want) >= 2 and [e[:3] for e in ended] == [pytest.approx(w[:3]) for w in want]
    assert [e[3] for e in ended] == pytest.approx([w[3] for w in want])
    assert sorted(r["fired_at"] for r in got if r["ended_at"] is None) == [w[1] for w in want]


def test_silence_keeps_runs_not_events():
    """A long busy stretch ahead of the watermark is one run of the state, in any order of parts."""
    class Kept:
        value = None
        exists = lambda self: self.value is not None
        get = lambda self: self.value

        def update(self, value):
            self.value = value

    class Handle:
        listTimers = lambda self: []
        registerTimer = lambda self, t: None

    class Mark:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    p = SA._Silence(120, ["source", "silent_from", "fired_at", "silent_until"])
    p.kept, p.handle = Kept(), Handle()
    times = [*map(float, range(0, 5_000)), *[9_000.0 + i / 4 for i in range(8_000)]]
    random.Random(3).shuffle(times)
    parts = [SA.pd.DataFrame({"ts": times[i:i + 1_000]}) for i in range(0, len(times), 1_000)]
    rows = lambda frames: [tuple(r) for f in frames for r in f.itertuples(index=False)]
    assert rows(p.handleInputRows(("a",), iter(parts), Mark(0))) == []
    assert len(p.kept.value[2]) == 2
    assert rows(p.handleExpiredTimer(("a",), Mark(2_500_000), None)) == []
    got = rows(p.handleExpiredTimer(("a",), Mark(12_000_000), None))
    assert [g[:3] for g in got] == [("a", 4_999.0, 5_119.0)] * 2 + [("a", 10_999.75, 11_119.75)]
    assert got[1][3] == 9_000.0 and len(p.kept.value[2]) == 0
