"""Growing, cut and replaced files between triggers."""

import json

from pyspark.sql import types as T
from tidewatch.sources import tail
from tidewatch.streaming import queries as ST

KIND = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])


def line(n, text="x"):
    return json.dumps({"n": n, "t": text}) + "\n"


def poll(spark, path, root, **options):
    """What one restart of the query adds."""
    out, seen = root / "out", root / "seen"
    before = spark.read.parquet(str(out)).count() if out.exists() else 0
    ST.run_available(tail.tail_jsonl(spark, str(path), KIND, **options), str(out), str(root / "ck"))
    rows = [r["n"] for r in spark.read.parquet(str(out)).collect()] if any(
        out.glob("*.parquet")) else []
    old = json.loads(seen.read_text()) if seen.exists() else []
    seen.write_text(json.dumps(rows))
    for n in old:
        rows.remove(n)
    assert before == len(old)
    return sorted(rows)


def test_growth_truncation_and_half_lines(spark, tmp_path):
    log, root = tmp_path / "eve.json", tmp_path / "q"
    root.mkdir()
    log.write_text(line(1) + line(2))
    assert poll(spark, log, root) == [1, 2]
    assert poll(spark, log, root) == []
    with log.open("a") as out:
        out.write(line(3) + "broken\n[1]\n" + line(4)[:9])
    assert poll(spark, log, root) == [3]
    with log.open("a") as out:
        out.write(line(4)[9:])
    assert poll(spark, log, root) == [4]
    log.write_text(line(10))  # shorter than before
    assert poll(spark, log, root) == [10]
    log.write_text("".join(line(n, "other") for n in range(20, 40)))  # longer, but another file
    assert poll(spark, log, root) == list(range(20, 40))
    log.write_text("")
    assert poll(spark, log, root) == []
    with log.open("a") as out:
        out.write(line(50))
    assert poll(spark, log, root) == [50]


def test_folders_and_files_that_come_and_go(spark, tmp_path):
    folder, root = tmp_path / "logs", tmp_path / "q"
    folder.mkdir()
    root.mkdir()
    assert poll(spark, folder, root) == []
    (folder / "a.log").write_text(line(1))
    (folder / "_hidden").write_text(line(99))
    assert poll(spark, folder, root) == [1]
    (folder / "b.log").write_text(line(2))
    (folder / "a.log").rename(tmp_path / "gone")
    assert poll(spark, folder, root) == [2]
    (folder / "a.log").write_text(line(3))
    assert poll(spark, folder, root) == [3]


def test_ranges_cover_every_line_once(spark, tmp_path):
    """Whatever bytes a task takes; with invalid UTF-8 and a line longer than a step."""
    log = tmp_path / "x.log"
    body = [line(n, "é" * (n % 37)).encode() for n in range(400)]
    body[7] = b"\xff\xfe\n"
    long = [line(400, "y" * (3 * tail.STEP_BYTES)).encode(), line(401).encode()]
    for lines, sizes in ((body, (13, 501, 10**9)), (body + long, (1_000_000, 10**9))):
        log.write_bytes(b"".join(lines))
        for size in sizes:
            reader = tail.TailReader(str(log), size)
            parts = reader.partitions({}, reader.latestOffset())
            got = [(v, p) for part in parts for b in reader.read(part) for v, p in zip(
                b.column("value").to_pylist(), b.column("position").to_pylist(), strict=True)]
            assert [v + b"\n" for v, _ in got] == lines
            at = 0
            for (_, place), text in zip(got, lines, strict=True):
                assert place == at
                at += len(text)
    want = [n for n in range(402) if n != 7]
    root = tmp_path / "q"
    root.mkdir()
    assert poll(spark, log, root, task_bytes=500_000) == want
