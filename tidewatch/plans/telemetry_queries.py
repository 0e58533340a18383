"""Telemetry scalars, windows, live features, matching and alerts."""

from pyspark.sql import functions as F

from tidewatch.functions import telemetry as T
from tidewatch.operators import alerts as A
from tidewatch.operators import matching as MT
from tidewatch.operators import windows as WN
from tidewatch.plans.common import r6, rounded
from tidewatch.plans.eve import EVE_FLAT, eve_view
from tidewatch.plans.views import ctes, view
from tidewatch.schemas import LIVE_FEATURES

WINDOW = 21_600  # six hours: driver events are minutes apart
LIVE = 1_800


def dns(spark, d):
    return view(spark, d, "dns_log")


def logs(spark, d, keep=()):
    return WN.merge_sources(dns(spark, d), view(spark, d, "http_log"), keep)


def matched(spark, d):
    return MT.match_events(view(spark, d, "truth"), view(spark, d, "predictions"))


def q_event_id(spark, d):
    return WN.merge_sources(dns(spark, d), view(spark, d, "http_log")).select(
        "seq", T.event_id("query", "uri", "host").alias("event_id"))


def q_clean(spark, d):
    return dns(spark, d).select("seq", T.clean_qname("query").alias("name"))


def q_entropy(spark, d):
    names = dns(spark, d).select("seq", T.clean_qname("query").alias("name"))
    return rounded(names.select("seq", T.label_entropy(T.first_label("name")).alias("entropy")))


def q_parts(spark, d):
    names = dns(spark, d).select("seq", T.clean_qname("query").alias("name"))
    return names.select("seq", T.first_label("name").alias("first_label"),
                        T.base_domain("name").alias("base_domain"),
                        T.subdomain("name").alias("subdomain"))


def q_eve_names(spark, d):
    return eve_view(spark, d).select("seq", F.array_join(T.eve_dns_names(), ",").alias("names"))


def q_eve_ids(spark, d):
    return eve_view(spark, d).select("seq", F.explode(T.eve_event_ids()).alias("event_id"))


def q_live(spark, d):
    return rounded(WN.live_features(logs(spark, d), LIVE))


def q_live_keyed(spark, d):
    return rounded(WN.live_features(logs(spark, d, ["orig_p"]), LIVE, ["orig_p"]))


def q_windows(spark, d):
    rows = dns(spark, d)
    return rounded(WN.dns_windows(rows, WINDOW, WN.window_origin(rows)))


def q_origin(spark, d):
    rows = dns(spark, d)
    old = WN.window_origin(rows.where(f"ts < {MIDDLE}")).withColumn("period", F.lit("baseline"))
    new = WN.window_origin(rows.where(f"ts >= {MIDDLE}")).withColumn("period", F.lit("scored"))
    return rounded(old.unionByName(new))


MIDDLE = 1705363200  # middle of the thirty days of driver events


def q_match(spark, d):
    return rounded(matched(spark, d))


def q_running(spark, d):
    return rounded(MT.running_metrics(matched(spark, d)))


def q_counters(spark, d):
    records = logs(spark, d).withColumn("event_id", T.event_id("uri", "host"))
    return rounded(MT.prediction_counters(view(spark, d, "predictions"), records))


def q_traffic(spark, d):
    return MT.traffic_counters(view(spark, d, "truth"))


def q_silence(spark, d):
    return rounded(A.silence(view(spark, d, "predictions"), 60, 60))


def q_rate(spark, d):
    return rounded(A.rate_alert(view(spark, d, "predictions"), 3600, 300, 0.5, 900))


def q_recall(spark, d):
    return rounded(A.recall_alert(MT.running_metrics(matched(spark, d)), 0.9, 180))


QUERIES = {
    "extract_event_id": q_event_id,
    "clean_qname": q_clean,
    "label_entropy": q_entropy,
    "domain_parts": q_parts,
    "eve_dns_names": q_eve_names,
    "eve_event_ids": q_eve_ids,
    "live_features": q_live,
    "live_features_keyed": q_live_keyed,
    "dns_windows": q_windows,
    "window_origin": q_origin,
    "truth_prediction_join": q_match,
    "cumulative_confusion": q_running,
    "prediction_counters": q_counters,
    "traffic_counters": q_traffic,
    "alert_silence": q_silence,
    "alert_high_anomaly_rate": q_rate,
    "alert_low_recall": q_recall,
}

DNS = ctes("dns_log")
CLEANED = "regexp_replace(rtrim(lower(query), '.'), '^evt-[0-9a-f]{32}\\.', '')"
NAMES = f"{DNS}, names AS (SELECT *, {CLEANED} AS name FROM dns_log)"


def entropy_sql(label: str) -> str:
    n = f"CAST(length({label}) AS DOUBLE)"
    share = f"(length({label}) - length(replace({label}, ch, ''))) / {n}"
    return (f"coalesce(-list_sum(list_transform(list_distinct(string_split({label}, '')), "
            f"lambda ch: ({share}) * log2({share}))), 0) + 0.0")


def base_sql(name: str) -> str:
    return f"array_to_string(string_split({name}, '.')[-2:], '.')"


def sub_sql(name: str) -> str:
    return (f"CASE WHEN len(string_split({name}, '.')) > 2 THEN "
            f"array_to_string(string_split({name}, '.')[:-3], '.') ELSE '' END")


def windows_sql(source: str, width: float, origin: str) -> str:
    """CTEs `wrows`, `wins` over a dns_log-like relation."""
    return f"""wrows AS (SELECT *, {origin} + floor((ts - {origin}) / {width}) * {width}
   AS window_start, orig_h || ':' || orig_p AS client, {CLEANED} AS name
   FROM {source} WHERE query <> '' AND coalesce(qtype_name, 'A') = 'A'),
wins AS (SELECT window_start, client, count(*) AS dns_requests,
   count(DISTINCT name) AS unique_qnames, count(DISTINCT {base_sql('name')}) AS unique_base_domains,
   count(DISTINCT {sub_sql('name')}) AS unique_subdomains, avg(length(name)) AS avg_qname_length,
   max(length(name)) AS max_qname_length,
   avg(CASE WHEN rcode_name = 'NXDOMAIN' THEN 1.0::DOUBLE ELSE 0 END) AS nxdomain_ratio,
   avg({entropy_sql("string_split(name, '.')[1]")}) AS avg_label_entropy,
   max(per_sec) AS peak_requests_per_second
   FROM (SELECT *, count(*) OVER (PARTITION BY window_start, client, CAST(floor(ts) AS BIGINT))
     AS per_sec FROM wrows) q GROUP BY 1, 2)"""


WINDOW_COLS = f"""{r6('window_start', 'window_start')}, client, dns_requests, unique_qnames,
 unique_base_domains, unique_subdomains, {r6('avg_qname_length', 'avg_qname_length')},
 max_qname_length, {r6('nxdomain_ratio', 'nxdomain_ratio')},
 {r6('avg_label_entropy', 'avg_label_entropy')}, peak_requests_per_second"""

MERGED = f"""{ctes('dns_log', 'http_log')}, merged AS (
 SELECT 'dns' AS source, seq * 2 AS seq, ts, ts_us, orig_p, query AS q, NULL AS uri, NULL AS host,
  'udp' AS protocol_type, 'domain_u' AS service, CAST(rcode_name <> 'NOERROR' AS INT) AS failed,
  rtt AS duration, CAST(length(query) AS BIGINT) AS src_bytes, 0::BIGINT AS dst_bytes FROM dns_log
 UNION ALL SELECT 'http', seq * 2 + 1, ts, ts_us, orig_p, NULL, uri, host, 'tcp', 'http',
  CAST(coalesce(nullif(status_code, 0), 200) >= 400 AS INT), 0.0,
  request_body_len + length(uri), response_body_len FROM http_log)"""


def live_sql(width: int, entity: str = "") -> str:
    part = f"PARTITION BY {entity} " if entity else ""
    srv = f"PARTITION BY {entity + ', ' if entity else ''}service "
    us = width * 1_000_000

    def trailing(expr: str, by: str) -> str:
        return (f"({expr} OVER ({by}ORDER BY ts_us RANGE BETWEEN {us} PRECEDING AND CURRENT ROW)"
                f" - coalesce({expr} OVER ({by.strip() or 'PARTITION BY 1'}, ts_us ORDER BY seq"
                " ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0))")

    cols = {"count": "c", "srv_count": "s", "serror_rate": "e / c", "srv_serror_rate": "se / s",
            "rerror_rate": "failed", "same_srv_rate": "s / c", "diff_srv_rate": "1 - s / c",
            "dst_host_count": "c", "dst_host_srv_count": "s", "dst_host_same_srv_rate": "s / c"}
    ints = {"count", "srv_count", "dst_host_count", "dst_host_srv_count"}
    named = ", ".join(
        f'CAST({cols[c]} AS BIGINT) AS "{c}"' if c in ints
        else r6(cols[c], c) if c in cols
        else "CASE WHEN failed = 1 THEN 'REJ' ELSE 'SF' END AS flag" if c == "flag"
        else r6(c, c) if c == "duration" else c for c in LIVE_FEATURES)
    return f"""WITH {MERGED}, c AS (SELECT *,
 CAST({trailing('count(*)', part)} AS DOUBLE) AS c, CAST({trailing('count(*)', srv)} AS DOUBLE) AS s,
 CAST({trailing('sum(failed)', part)} AS DOUBLE) AS e,
 CAST({trailing('sum(failed)', srv)} AS DOUBLE) AS se FROM merged)
SELECT seq, {r6('ts', 'ts')}, source,
 nullif(lower(regexp_extract(concat_ws(' ', q, uri, host), '(?i)evt-([0-9a-f]{{32}})', 1)), '')
   AS event_id, {named}{', ' + entity if entity else ''} FROM c"""


MATCHED = f"""{ctes('truth', 'predictions')}, tr AS (SELECT * FROM truth WHERE delivered),
moment AS (SELECT event_id, greatest(a, b) AS t FROM
  (SELECT event_id, min(seq) AS a FROM tr GROUP BY 1) x
  JOIN (SELECT event_id, min(seq) AS b FROM predictions GROUP BY 1) y USING (event_id)),
matched AS (SELECT m.event_id, m.t,
  (SELECT arg_max(label, seq) FROM tr WHERE tr.event_id = m.event_id AND seq <= m.t) AS label,
  (SELECT arg_max(prediction, seq) FROM predictions p WHERE p.event_id = m.event_id
     AND seq <= m.t) AS prediction,
  (SELECT arg_max(ts, seq) FROM (SELECT event_id, seq, ts FROM tr UNION ALL
     SELECT event_id, seq, ts FROM predictions) u WHERE u.event_id = m.event_id AND seq <= m.t) AS ts
  FROM moment m)"""
RUNNING = f"""{MATCHED}, conf AS (SELECT event_id, t, ts,
 """ + ", ".join(
    f"CAST(sum(CAST(label = {y} AND prediction = {z} AS INT)) OVER (ORDER BY t) AS BIGINT) AS {n}"
    for n, y, z in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))) + """ FROM matched),
pr AS (SELECT *, CAST(tp AS DOUBLE) / greatest(tp + fp, 1) AS precision,
  CAST(tp AS DOUBLE) / greatest(tp + fn, 1) AS recall FROM conf),
running AS (SELECT *, 2 * precision * recall / greatest(precision + recall, 1e-12::DOUBLE) AS f1,
  CAST(fp AS DOUBLE) / greatest(fp + tn, 1) AS fpr FROM pr)"""
PREDS = ctes("predictions")

ORACLES = {
    "extract_event_id": f"""WITH {MERGED} SELECT seq, nullif(lower(regexp_extract(
 concat_ws(' ', q, uri, host), '(?i)evt-([0-9a-f]{{32}})', 1)), '') AS event_id FROM merged""",
    "clean_qname": f"WITH {NAMES} SELECT seq, name FROM names",
    "label_entropy": f"""WITH {NAMES} SELECT seq,
 {r6(entropy_sql("string_split(name, '.')[1]"), 'entropy')} FROM names""",
    "domain_parts": f"""WITH {NAMES} SELECT seq, string_split(name, '.')[1] AS first_label,
 {base_sql('name')} AS base_domain, {sub_sql('name')} AS subdomain FROM names""",
    "eve_dns_names": f"""WITH {EVE_FLAT} SELECT seq, concat_ws(',', nullif(rrname, ''), nullif(qname, ''))
 AS names FROM eve_flat""",
    "eve_event_ids": f"""WITH {EVE_FLAT} SELECT DISTINCT seq, event_id FROM (SELECT seq,
 nullif(lower(regexp_extract(t, '(?i)evt-([0-9a-f]{{32}})', 1)), '') AS event_id
 FROM (SELECT seq, unnest([rrname, qname, url, hostname]) AS t FROM eve_flat) q) z
 WHERE event_id IS NOT NULL""",
    "live_features": live_sql(LIVE),
    "live_features_keyed": live_sql(LIVE, "orig_p"),
    "dns_windows": f"""WITH {DNS}, {windows_sql('dns_log', WINDOW, '(SELECT min(ts) FROM dns_log)')}
 SELECT {WINDOW_COLS} FROM wins""",
    "window_origin": f"""WITH {DNS} SELECT CASE WHEN ts < {MIDDLE} THEN 'baseline' ELSE 'scored' END
 AS period, {r6('min(ts)', 'origin')} FROM dns_log GROUP BY 1""",
    "truth_prediction_join": f"""WITH {MATCHED} SELECT event_id, t, label, prediction,
 {r6('ts', 'ts')} FROM matched""",
    "cumulative_confusion": f"""WITH {RUNNING} SELECT event_id, t, {r6('ts', 'ts')}, tp, fp, fn, tn,
 {r6('precision', 'precision')}, {r6('recall', 'recall')}, {r6('f1', 'f1')}, {r6('fpr', 'fpr')}
 FROM running""",
    "prediction_counters": f"""WITH {PREDS}, {MERGED} SELECT CASE prediction WHEN 1 THEN 'attack'
 ELSE 'normal' END AS kind, source, count(*) AS n, {r6('max(ts)', 'last_ts')}
 FROM predictions GROUP BY 1, 2
 UNION ALL SELECT 'skipped', source, count(*), NULL::DOUBLE FROM merged WHERE source = 'dns'
 GROUP BY 2""",
    "traffic_counters": f"""WITH {ctes('truth')} SELECT 'events' AS counter, label, service,
 attack_type, count(*) AS n FROM truth WHERE delivered GROUP BY 2, 3, 4
 UNION ALL SELECT 'errors', NULL, service, NULL, count(*) FROM truth WHERE NOT delivered
 GROUP BY service""",
    "alert_silence": f"""WITH {PREDS} SELECT {r6('ts', 'silent_from')}, {r6('nxt', 'silent_until')},
 {r6('ts + 120', 'fired_at')} FROM (SELECT ts, lead(ts) OVER (ORDER BY ts) AS nxt FROM predictions) q
 WHERE nxt - ts > 120""",
    "alert_high_anomaly_rate": f"""WITH {PREDS}, b AS (SELECT CAST(floor(ts / 300) AS BIGINT) AS b,
 prediction FROM predictions), s AS (SELECT b + k AS s, count(*) AS n, sum(prediction) AS a
 FROM b, (SELECT unnest(range(1, 13)) AS k) g GROUP BY 1),
hot AS (SELECT s, a / n AS share, s - row_number() OVER (ORDER BY s) AS run FROM s
 WHERE a / n > 0.5)
SELECT min(s) * 300 AS started_at, min(s) * 300 + 900 AS fired_at, max(s) * 300 AS ended_at,
 {r6('max(share)', 'peak_share')} FROM hot GROUP BY run HAVING (max(s) - min(s)) * 300 >= 900""",
    "alert_low_recall": f"""WITH {RUNNING}, isl AS (SELECT *,
 sum(CAST(recall >= 0.9 AS INT)) OVER (ORDER BY t) AS island FROM running),
low AS (SELECT island, min(ts) AS a, max(ts) AS z, count(*) AS events, min(recall) AS lowest
 FROM isl WHERE recall < 0.9 GROUP BY 1),
o AS (SELECT low.*, g.ts AS rec FROM low LEFT JOIN
 (SELECT island - 1 AS island, ts FROM isl WHERE recall >= 0.9) g USING (island))
SELECT {r6('a', 'started_at')}, {r6('a + 180', 'fired_at')}, {r6('coalesce(rec, z)', 'ended_at')},
 rec IS NULL AS "open", events, {r6('lowest', 'lowest')} FROM o WHERE coalesce(rec, z) - a >= 180""",
}
