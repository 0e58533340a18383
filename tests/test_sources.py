import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.operators import matching as MT
from tidewatch.operators import windows as WN
from tidewatch.sources import jsonl as J
from tidewatch.sources import tables as TB
from tidewatch.streaming import queries as ST

LOG = "ts double, query string"


def schema(text):
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(text)


def test_parts_of_a_log_merge_by_whole_record(spark, tmp_path):
    lines = {
        "part-a": ['{"ts": 5, "query": "late.example", "uid": "C1"}',
                   '{"query": "late.example", "uid": "C1", "ts": 5}', "# a note"],
        "part-b": ['{"ts": 5, "query": "late.example", "uid": "C2"}', "",
                   '{"ts": 3.5, "query": "early.example"}'],
        "part-c": ['{"ts": 5, "query": "late.example", "uid": "C2"}', '{"query": "timeless.example"}']}
    for name, rows in lines.items():
        (tmp_path / f"{name}.jsonl").write_text("\n".join(rows))
    got = [tuple(r) for r in J.merge_logs(spark, str(tmp_path / "part-*"), schema(LOG)).collect()]
    assert got == [(None, "timeless.example"), (3.5, "early.example"), (5.0, "late.example"),
                   (5.0, "late.example")]


def test_input_ordinals_run_through_gz_files_by_path(spark, tmp_path):
    import gzip

    kinds = schema("name string, n int")
    want = []
    for part, size in (("b.gz", 400), ("a.gz", 3), ("c.gz", 50)):
        with gzip.open(tmp_path / part, "wt") as out:
            out.writelines(f"{part},{i}\n" for i in range(size))
    for part, size in (("a.gz", 3), ("b.gz", 400), ("c.gz", 50)):
        want += [(part, i) for i in range(size)]
    rows = TB.read_connections(spark, str(tmp_path), kinds, row_id="at").orderBy("at").collect()
    assert [(r["name"], r["n"], r["at"]) for r in rows] == [(*w, k) for k, w in enumerate(want)]


def test_strict_and_tolerant_reading(spark, tmp_path):
    path = tmp_path / "x.log"
    path.write_bytes(b'{"ts":1,"query":"a"}\n{"ts":2,\n\xff\xfe\n{"ts":3,"query":"b\xff"}\n')
    good = J.read_jsonl(spark, str(path), schema(LOG), "drop").orderBy("ts").collect()
    assert [(r["ts"], r["query"]) for r in good] == [(1.0, "a"), (3.0, "b�")]
    with pytest.raises(Exception):
        J.read_jsonl(spark, str(path), schema(LOG)).collect()
    with pytest.raises(Exception):
        J.read_jsonl(spark, str(tmp_path / "missing"), schema(LOG)).collect()


def test_canonical_json(spark):
    df = spark.sql("SELECT 2 AS b, named_struct('z', 1, 'a', CAST(NULL AS INT)) AS a")
    assert df.select(J.canonical_json(df)).first()[0] == '{"a":{"a":null,"z":1},"b":2}'


def test_digest_contract_and_manifest(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"payload")
    want = hashlib.sha256(b"payload").hexdigest()
    expected = spark.createDataFrame([("f.bin", want)], "file string, sha256 string")
    TB.require_digest(spark, str(tmp_path / "*.bin"), expected)
    with pytest.raises(ValueError, match="checksum"):
        TB.require_digest(spark, str(tmp_path / "*.bin"), expected.withColumn("sha256", F.lit("0")))
    with pytest.raises(ValueError, match="ordered features"):
        TB.require_exact(["b", "a"], ["a", "b"])
    rows = spark.createDataFrame([(0, "train")], "label int, split string")
    manifest = spark.createDataFrame([("train", 2), ("test", 1)], "split string, rows long")
    got = {r["split"]: r["matches"] for r in TB.audit_manifest(rows, manifest).collect()}
    assert got == {"train": False, "test": False}


def test_digests_of_files_of_any_size(spark, tmp_path):
    """Several pieces, no bytes, and more than a row can hold (a sparse file)."""
    folder = tmp_path / "many files"
    folder.mkdir()
    sizes = {"a.bin": 0, "b.bin": 3 * TB.DIGEST_BYTES + 7, "c.bin": 2**31 + 11}
    want = {}
    for name, size in sizes.items():
        with (folder / name).open("wb") as out:
            out.write(name.encode() if size else b"")
            out.truncate(size)
        state = hashlib.sha256(name.encode() if size else b"")
        left = size - (len(name) if size else 0)
        while left > 0:
            state.update(bytes(min(left, 1 << 24)))
            left -= 1 << 24
        want[name] = size, state.hexdigest()
    got = {r["file"]: (r["bytes"], r["sha256"])
           for r in TB.file_digests(spark, str(folder)).collect()}
    assert got == want


def write(path, rows):
    path.mkdir(exist_ok=True)
    n = len(list(path.iterdir()))
    (path / f"part-{n:03d}.log").write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_tail_reads_only_new_files(spark, tmp_path):
    src = tmp_path / "in"
    for portion in ([{"ts": 1.0, "query": "a"}], [{"ts": 2.0, "query": "b"}, "broken"]):
        write(src, portion)
        ST.run_available(J.stream_jsonl(spark, str(src), schema(LOG)), str(tmp_path / "out"),
                         str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["query"] for r in got.collect()) == ["a", "b"]


def test_live_stream_over_triggers_equals_batch(spark, tmp_path):
    src, http = tmp_path / "dns", tmp_path / "http"
    rows = [{"seq": i, "ts": i * 0.4 + (0.4 if i % 5 == 0 else 0), "orig_p": 1 + i % 2,
             "query": f"q{i}", "rcode_name": "NXDOMAIN" if i % 3 == 0 else "NOERROR"}
            for i in range(40)]
    http.mkdir()
    rows.sort(key=lambda r: r["ts"])
    for part in (rows[:13], rows[13:26], rows[26:]):
        write(src, part)
        stream = ST.live_features_stream(
            J.stream_jsonl(spark, str(src), S.DNS_LOG_SCHEMA),
            J.stream_jsonl(spark, str(http), S.HTTP_LOG_SCHEMA), 2.0)
        ST.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    cols = ["seq", "orig_p", *S.LIVE_FEATURES]
    got = spark.read.parquet(str(tmp_path / "out")).select(*cols)
    dns = J.read_jsonl(spark, str(src), S.DNS_LOG_SCHEMA)
    empty = spark.createDataFrame([], S.HTTP_LOG_SCHEMA)
    want = WN.live_features(WN.merge_sources(dns, empty, ["orig_p"]), 2.0, ["orig_p"]).select(*cols)
    assert sorted(got.collect()) == sorted(want.collect())


def test_match_stream_over_triggers(spark, tmp_path):
    truth, pred = tmp_path / "t", tmp_path / "p"
    portions = [([{"seq": 1, "ts": 1.0, "event_id": "a", "label": 1}],
                 [{"seq": 2, "ts": 1.5, "event_id": "b", "prediction": 1}]),
                ([{"seq": 3, "ts": 2.0, "event_id": "b", "label": 0}],
                 [{"seq": 4, "ts": 2.5, "event_id": "a", "prediction": 0}]),
                ([{"seq": 5, "ts": 3.0, "event_id": "a", "label": 0}],
                 [{"seq": 6, "ts": 3.5, "event_id": "a", "prediction": 1}])]
    for t, p in portions:
        write(truth, t)
        write(pred, p)
        stream = ST.match_stream(J.stream_jsonl(spark, str(truth), S.TRUTH_SCHEMA),
                                 J.stream_jsonl(spark, str(pred), S.PREDICTION_SCHEMA), 60)
        ST.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    out = spark.read.parquet(str(tmp_path / "out"))
    got = {r["event_id"]: (r["label"], r["prediction"]) for r in out.collect()}
    assert got == {"a": (1, 0), "b": (0, 1)} and out.count() == 2
    total = MT.total_metrics(out).first()
    assert (total["fn"], total["fp"], total["tp"]) == (1, 1, 0)


def test_match_stream_judges_groups_not_ids(spark, tmp_path):
    truth, pred = tmp_path / "t", tmp_path / "p"
    write(truth, [{"seq": 2 * i, "ts": i + 1.0, "event_id": f"e{i}", "label": i % 2}
                  for i in range(200)])
    write(pred, [{"seq": 2 * i + 1, "ts": i + 1.0, "event_id": f"e{i}", "prediction": i % 3 % 2}
                 for i in range(200)] + [{"seq": 900, "ts": 1.0, "event_id": "e1", "prediction": 0}])
    stream = ST.match_stream(J.stream_jsonl(spark, str(truth), S.TRUTH_SCHEMA),
                             J.stream_jsonl(spark, str(pred), S.PREDICTION_SCHEMA), 60, groups=4)
    ST.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "slot" in plan.split("FlatMapGroupsInPandasWithState", 1)[1].splitlines()[0]
    assert got == sorted((f"e{i}", 2 * i + 1, i % 2, i % 3 % 2, i + 1.0) for i in range(200))


def test_match_stream_forgets_each_id_on_its_own(spark, tmp_path):
    truth, pred = tmp_path / "t", tmp_path / "p"
    portions = [([{"seq": 1, "ts": 1.0, "event_id": "old", "label": 1},
                  {"seq": 2, "ts": 100.0, "event_id": "new", "label": 1}], []),
                ([{"seq": 3, "ts": 150.0, "event_id": "x", "label": 0}], []),
                ([], [{"seq": 4, "ts": 121.0, "event_id": "old", "prediction": 1},
                      {"seq": 5, "ts": 122.0, "event_id": "new", "prediction": 1}])]
    for t, p in portions:
        write(truth, t)
        write(pred, p)
        stream = ST.match_stream(J.stream_jsonl(spark, str(truth), S.TRUTH_SCHEMA),
                                 J.stream_jsonl(spark, str(pred), S.PREDICTION_SCHEMA), 60, groups=1)
        ST.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["event_id"], r["t"]) for r in got] == [("new", 5)]


def test_live_stream_cuts_an_entity_into_slices(spark, tmp_path):
    src, http = tmp_path / "dns", tmp_path / "http"
    http.mkdir()
    rows = [{"seq": i, "ts": 7195.0 + i * 0.5, "orig_p": 1, "query": f"q{i}", "rcode_name": "NOERROR"}
            for i in range(24)]
    for part in (rows[:9], rows[9:]):
        write(src, part)
        stream = ST.live_features_stream(J.stream_jsonl(spark, str(src), S.DNS_LOG_SCHEMA),
                                         J.stream_jsonl(spark, str(http), S.HTTP_LOG_SCHEMA), 3.0)
        ST.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {r["seq"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {2 * i: min(i + 1, 7) for i in range(24)}
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "slice" in plan.split("FlatMapGroupsInPandasWithState", 1)[1].splitlines()[0]


def test_first_per_key_writes_as_many_files_as_tasks(spark, tmp_path, monkeypatch):
    from tidewatch.plans import source_queries as Q
    monkeypatch.setattr(Q, "scratch_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(Q, "ORDERED_ROWS", 2_000)
    Q.q_first(spark, "/root/testdata/sf0.01").collect()
    assert len(list((tmp_path / "ordered").glob("part-*"))) > 3
