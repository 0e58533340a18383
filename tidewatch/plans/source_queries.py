"""Sources and sinks as round trips, and the streaming twins."""

from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.operators import models as M
from tidewatch.operators import windows as WN
from tidewatch.operators.clean import split_summary
from tidewatch.plans.common import r6, rounded
from tidewatch.plans.data_queries import SPLIT, SUMMARY_SQL, split_rows
from tidewatch.operators.matching import match_events
from tidewatch.plans.telemetry_queries import (
    LIVE, MATCHED, RUNNING, WINDOW, WINDOW_COLS, live_sql, windows_sql)
from tidewatch.plans.views import ctes, view
from tidewatch.session import scratch_path
from tidewatch.sources import jsonl as J
from tidewatch.sources import tables as TB
from tidewatch.sources.tail import tail_jsonl
from tidewatch.streaming import queries as ST
from tidewatch.streaming.alerts import rate_alert_stream, silence_stream, timers

CONN = S.CONNECTION_COLUMNS


def conn41(spark, d):
    return view(spark, d, "conn41").select(*CONN)


def q_csv(spark, d):
    path = scratch_path(spark, "connections")
    TB.write_connections(conn41(spark, d), path)
    return rounded(TB.read_connections(spark, path))


ORDERED_ROWS = 500_000  # rows of an ordered file


def q_first(spark, d):
    """The first row of every service in input order, over gz files in path order."""
    path = scratch_path(spark, "ordered")
    rows = view(spark, d, "conn41")
    files = max(3, -(-rows.count() // ORDERED_ROWS))  # a gz file is read by one task
    ordered = rows.repartitionByRange(files, "row_id").sortWithinPartitions("row_id")
    TB.write_connections(ordered.select(*CONN), path)
    rows = TB.read_connections(spark, path, row_id="row_id")
    return rows.groupBy("service").agg(
        F.min("row_id").alias("row_id"), F.min_by("src_bytes", "row_id").alias("src_bytes"),
        F.count("*").alias("rows"))


def q_auto(spark, d):
    rows = view(spark, d, "conn").select("row_id", "service", "src_bytes", "serror_rate")
    base = scratch_path(spark, "features")
    rows.write.parquet(f"{base}.parquet")
    rows.write.option("header", True).csv(base)
    a = TB.read_features(spark, f"{base}.parquet").withColumn("format", F.lit("parquet"))
    b = TB.read_features(spark, base, rows.schema).withColumn("format", F.lit("csv"))
    return rounded(a.unionByName(b))


def dns_rows(spark, d):
    return view(spark, d, "dns_log").select(
        "seq", "ts", "orig_h", "orig_p", "qtype_name", "query", "rcode_name", "rtt",
        F.lit(None).cast("array<string>").alias("answers"))


def written_log(spark, d, broken: bool):
    """The DNS view as a JSONL folder with comments, blank and (if asked) broken lines."""
    rows = dns_rows(spark, d)
    lines = rows.select("seq", J.canonical_json(rows).alias("value"))
    extra = [F.lit("#fields"), F.lit("")]
    if broken:
        extra += [F.substring("value", 1, 40), F.lit("not json"), F.lit("[1]")]
    noise = lines.where("seq % 10 = 0").select(F.explode(F.array(*extra)).alias("value"))
    path = scratch_path(spark, "log")
    lines.select("value").unionByName(noise).write.text(path)
    return path


def q_jsonl(spark, d):
    return rounded(J.read_jsonl(spark, written_log(spark, d, False), S.DNS_LOG_SCHEMA).drop(
        "answers"))


def q_tolerant(spark, d):
    return rounded(J.read_jsonl(spark, written_log(spark, d, True), S.DNS_LOG_SCHEMA,
                                "drop").drop("answers"))


def q_stream(spark, d):
    out = scratch_path(spark, "streamed")
    stream = tail_jsonl(spark, written_log(spark, d, True), S.DNS_LOG_SCHEMA, "dns")
    ST.run_available(stream.drop("answers"), f"{out}/data", f"{out}/checkpoint")
    return rounded(spark.read.parquet(f"{out}/data"))


def q_append(spark, d):
    """Predictions appended in two portions and read back."""
    rows = view(spark, d, "predictions")
    path = scratch_path(spark, "predictions")
    J.write_jsonl(rows.where("seq % 2 = 0"), path)
    J.write_jsonl(rows.where("seq % 2 = 1"), path)
    return rounded(J.read_jsonl(spark, path, S.PREDICTION_SCHEMA))


def q_merge(spark, d):
    """Rotated parts that repeat each other's records."""
    rows = dns_rows(spark, d).drop("answers")
    base = scratch_path(spark, "rotated")
    J.write_jsonl(rows.where("seq % 3 <> 0"), f"{base}/dns.1.log")
    J.write_jsonl(rows.where("seq % 3 <> 1"), f"{base}/dns.log")
    # records that differ only in a key outside of the schema are records of their own
    J.write_jsonl(rows.where("seq % 5 = 0").withColumn("sensor", F.lit("b")), f"{base}/dns.log")
    return rounded(J.merge_logs(spark, [f"{base}/dns.1.log", f"{base}/dns.log"],
                                S.DNS_LOG_SCHEMA).drop("answers"))


def q_digest(spark, d):
    """Digests of written files against a manifest with one damaged entry."""
    path = scratch_path(spark, "digest")
    view(spark, d, "conn").repartition(4).write.parquet(path)
    actual = TB.file_digests(spark, f"{path}/*.parquet")
    first = actual.agg(F.min("file").alias("f")).scalar()
    manifest = actual.select("file", F.when(F.col("file") == first, "0").otherwise(
        F.col("sha256")).alias("sha256"))
    return TB.verify_digest(spark, f"{path}/*.parquet", manifest)


CONTRACT = ["service", "src_bytes", "protocol_type", "dst_host_count", "duration"]


def q_contract(spark, d):
    """Live columns in a table where one is missing and one has gaps."""
    rows = view(spark, d, "conn").select(
        "protocol_type", "service", "duration",
        F.when(F.col("row_id") % 7 != 0, F.col("src_bytes")).alias("src_bytes"))
    return TB.contract_report(rows, CONTRACT)


def q_report(spark, d):
    base = scratch_path(spark, "report")
    summary = split_summary(split_rows(spark, d))
    TB.write_report(summary, f"{base}/json")
    TB.write_report(summary, f"{base}/csv", "csv")
    a = spark.read.schema(summary.schema).json(f"{base}/json")
    b = spark.read.schema(summary.schema).option("header", True).csv(f"{base}/csv")
    return rounded(a.withColumn("format", F.lit("json")).unionByName(
        b.withColumn("format", F.lit("csv"))))


def log_streams(spark, d):
    """The DNS and HTTP views written as log folders and opened as streams."""
    out = []
    for name, schema in (("dns_log", S.DNS_LOG_SCHEMA), ("http_log", S.HTTP_LOG_SCHEMA)):
        rows = view(spark, d, name)
        rows = rows.select(*[c for c in schema.names if c in rows.columns])
        path = scratch_path(spark, name)
        J.write_jsonl(rows, path)
        out.append(J.stream_jsonl(spark, path, schema))
    return out


def q_live_stream(spark, d):
    dns, http = log_streams(spark, d)
    out = scratch_path(spark, "live")
    ST.run_available(ST.live_features_stream(dns, http, LIVE), f"{out}/data", f"{out}/checkpoint")
    return rounded(spark.read.parquet(f"{out}/data"))


DELAY = 3600


def q_window_stream(spark, d):
    dns, _ = log_streams(spark, d)
    out = scratch_path(spark, "windows")
    ST.run_available(ST.dns_windows_stream(dns, WINDOW, DELAY), f"{out}/data", f"{out}/checkpoint")
    return rounded(spark.read.parquet(f"{out}/data"))


def q_match_stream(spark, d):
    paths = {}
    for name in ("truth", "predictions"):
        paths[name] = scratch_path(spark, name)
        J.write_jsonl(view(spark, d, name), paths[name])
    out = scratch_path(spark, "matched")
    ST.run_available(ST.match_stream(
        J.stream_jsonl(spark, paths["truth"], S.TRUTH_SCHEMA),
        J.stream_jsonl(spark, paths["predictions"], S.PREDICTION_SCHEMA), 90 * 86400),
        f"{out}/data", f"{out}/checkpoint")
    return rounded(spark.read.parquet(f"{out}/data"))


ALERT_DELAY = 5


def prediction_stream(spark, d):
    path = scratch_path(spark, "predictions")
    J.write_jsonl(view(spark, d, "predictions"), path)
    return J.stream_jsonl(spark, path, S.PREDICTION_SCHEMA)


def q_silence_stream(spark, d):
    out = scratch_path(spark, "silence")
    with timers(spark):
        ST.run_available(silence_stream(prediction_stream(spark, d), "source", 60, 60, ALERT_DELAY),
                         f"{out}/data", f"{out}/checkpoint")
    return rounded(spark.read.parquet(f"{out}/data"))


def q_rate_stream(spark, d):
    out = scratch_path(spark, "rate")
    with timers(spark):
        ST.run_available(rate_alert_stream(prediction_stream(spark, d), "source", 3600, 300, 0.5, 900,
                                           ALERT_DELAY), f"{out}/data", f"{out}/checkpoint")
    return rounded(spark.read.parquet(f"{out}/data"))


def q_confusion_stream(spark, d):
    """The counters after the last trigger; matched pairs arrive as files."""
    matched = match_events(view(spark, d, "truth"), view(spark, d, "predictions"))
    base = scratch_path(spark, "confusion")
    matched.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(matched.schema).parquet(f"{base}/in")
    query = (ST.confusion_stream(stream).writeStream.outputMode("complete")
             .option("checkpointLocation", f"{base}/checkpoint")
             .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{base}/out"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return rounded(spark.read.parquet(f"{base}/out"))


def q_detect(spark, d):
    """A forest fitted on batch features of the first half scores the whole stream."""
    logs = WN.merge_sources(view(spark, d, "dns_log"), view(spark, d, "http_log"), ["orig_p"])
    batch = WN.live_features(logs, LIVE, ["orig_p"]).withColumn(
        "label", F.when(F.col("flag") == "REJ", 1).otherwise(0))
    first = batch.where(F.col("ts") <= batch.agg(F.percentile_approx("ts", 0.5)).scalar())
    model = M.DetectionPipeline(kind="iforest", select=False, keyCol="seq").fit(first)
    dns, http = log_streams(spark, d)
    out = scratch_path(spark, "detected")
    stream = ST.detect_stream(dns, http, lambda df: M.score_with(model, df, "iforest"), 0.05, LIVE)
    ST.run_available(stream.drop("made_at_us"), f"{out}/data", f"{out}/checkpoint", "json")
    kinds = ",".join(f"`{c}`:{'string' if c in S.CATEGORICAL else 'double'}"
                     for c in S.LIVE_FEATURES)
    return spark.read.schema(
        "event_id string, zeek_ts double, source string, score double, threshold double, "
        f"prediction int, features struct<{kinds}>").json(f"{out}/data").select(
        "event_id", "zeek_ts", "source", "score", "threshold", "prediction", "features.*")


QUERIES = {
    "scan_connections_csv": q_csv,
    "first_per_key": q_first,
    "scan_features_auto": q_auto,
    "scan_jsonl": q_jsonl,
    "scan_jsonl_tolerant": q_tolerant,
    "stream_jsonl": q_stream,
    "append_jsonl": q_append,
    "merge_rotated_logs": q_merge,
    "file_digest": q_digest,
    "schema_contract_check": q_contract,
    "write_report": q_report,
    "live_features_stream": q_live_stream,
    "dns_windows_stream": q_window_stream,
    "truth_prediction_stream": q_match_stream,
    "detect_stream": q_detect,
    "alert_silence_stream": q_silence_stream,
    "alert_rate_stream": q_rate_stream,
    "confusion_stream": q_confusion_stream,
}

LOG = f"""WITH {ctes('dns_log')} SELECT seq, {r6('ts', 'ts')}, orig_h, orig_p, qtype_name, query,
 rcode_name, {r6('rtt', 'rtt')}"""
DOUBLES = [f.name for f in S.CONNECTION_SCHEMA.fields if f.dataType.typeName() == "double"]


ORACLES = {
    "scan_connections_csv": f"WITH {ctes('conn41')} SELECT " + ", ".join(
        r6(c, c) if c in DOUBLES else f'"{c}"' for c in CONN) + " FROM conn41",
    "scan_features_auto": f"WITH {ctes('conn')} " + " UNION ALL ".join(
        f"SELECT row_id, service, src_bytes, {r6('serror_rate', 'serror_rate')}, '{f}' AS format FROM conn"
        for f in ("parquet", "csv")),
    "scan_jsonl": f"{LOG} FROM dns_log",
    "scan_jsonl_tolerant": f"{LOG} FROM dns_log",
    "stream_jsonl": f"{LOG}, 'dns' AS source FROM dns_log",
    "append_jsonl": f"""WITH {ctes('predictions')} SELECT seq, {r6('ts', 'ts')}, event_id, prediction,
 {r6('score', 'score')}, source FROM predictions""",
    "merge_rotated_logs": f"""WITH {ctes('dns_log')}, twice AS (SELECT * FROM dns_log UNION ALL
 SELECT * FROM dns_log WHERE seq % 5 = 0) SELECT seq, {r6('ts', 'ts')}, orig_h, orig_p, qtype_name,
 query, rcode_name, {r6('rtt', 'rtt')} FROM twice""",
    "first_per_key": f"""WITH {ctes('conn41')}, placed AS (SELECT *, row_number() OVER (
 ORDER BY row_id) - 1 AS place FROM conn41) SELECT service, min(place) AS row_id,
 arg_min(src_bytes, place) AS src_bytes, count(*) AS rows FROM placed GROUP BY service""",
    "schema_contract_check": f"WITH {ctes('conn')} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {i} AS required_position, {a} AS actual_position,
 {a} IS NOT NULL AS present, count(*) AS rows, {m} AS missing_values FROM conn"""
        for i, (c, a, m) in enumerate((
            ("service", 1, "count(*) - count(service)"),
            ("src_bytes", 3, "count(*) FILTER (row_id % 7 = 0 OR src_bytes IS NULL)"),
            ("protocol_type", 0, "count(*) - count(protocol_type)"),
            ("dst_host_count", "NULL::INT", "NULL::BIGINT"),
            ("duration", 2, "count(*) - count(duration)")))),
    "write_report": f"""WITH {SPLIT}, s AS ({SUMMARY_SQL}, {r6('avg(label)', 'attack_rate')}
 FROM split_rows GROUP BY split) SELECT *, 'json' AS format FROM s
 UNION ALL SELECT *, 'csv' FROM s""",
    "live_features_stream": live_sql(LIVE, "orig_p"),
    # windows that the watermark has closed by the end of the log
    "dns_windows_stream": f"""WITH {ctes('dns_log')}, {windows_sql('dns_log', WINDOW, '0')}
 SELECT {WINDOW_COLS} FROM wins WHERE window_start + {WINDOW} <=
 (SELECT max(ts) FROM dns_log WHERE qtype_name = 'A') - {DELAY}""",
    "truth_prediction_stream": f"""WITH {MATCHED} SELECT event_id, t, label, prediction,
 {r6('ts', 'ts')} FROM matched""",
    # what the watermark has passed by the end of the log
    "alert_silence_stream": f"""WITH {ctes('predictions')}, w AS (SELECT max(ts) - {ALERT_DELAY} AS w
 FROM predictions), g AS (SELECT source, ts, lead(ts) OVER (PARTITION BY source ORDER BY ts) AS nxt
 FROM predictions)
SELECT source, {r6('ts', 'silent_from')}, {r6('ts + 120', 'fired_at')}, NULL::DOUBLE AS silent_until
 FROM g, w WHERE (nxt IS NULL OR nxt - ts > 120) AND w > ts + 120
UNION ALL SELECT source, {r6('ts', 'silent_from')}, {r6('ts + 120', 'fired_at')},
 {r6('nxt', 'silent_until')} FROM g, w WHERE nxt - ts > 120 AND nxt <= w""",
    "alert_rate_stream": f"""WITH {ctes('predictions')}, w AS (SELECT max(ts) - {ALERT_DELAY} AS w
 FROM predictions), b AS (SELECT source, CAST(floor(ts / 300) AS BIGINT) AS b, prediction
 FROM predictions), s AS (SELECT source, b + k AS s, count(*) AS n, sum(prediction) AS a
 FROM b, (SELECT unnest(range(1, 13)) AS k) g GROUP BY 1, 2),
hot AS (SELECT source, s, a / n AS share,
 s - row_number() OVER (PARTITION BY source ORDER BY s) AS run FROM s, w
 WHERE a / n > 0.5 AND s * 300 <= w),
runs AS (SELECT source, min(s) * 300.0 AS lo, max(s) * 300.0 AS hi, max(share) AS peak FROM hot
 GROUP BY source, run HAVING (max(s) - min(s)) * 300 >= 900)
SELECT source, {r6('lo', 'started_at')}, {r6('lo + 900', 'fired_at')}, NULL::DOUBLE AS ended_at,
 NULL::DOUBLE AS peak_share FROM runs
UNION ALL SELECT source, {r6('lo', 'started_at')}, {r6('lo + 900', 'fired_at')},
 {r6('hi', 'ended_at')}, {r6('peak', 'peak_share')} FROM runs, w WHERE hi + 300 <= w""",
    "confusion_stream": f"""WITH {RUNNING} SELECT tp, fp, fn, tn, {r6('precision', 'precision')},
 {r6('recall', 'recall')}, {r6('f1', 'f1')}, {r6('fpr', 'fpr')} FROM running
 ORDER BY t DESC LIMIT 1""",
}
