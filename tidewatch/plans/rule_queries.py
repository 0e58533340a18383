"""Evidence, specifications, rule matching and the quality gate."""

from pyspark.sql import functions as F

from tidewatch.functions import telemetry as T
from tidewatch.operators import evidence as E
from tidewatch.operators import gate as G
from tidewatch.operators import rules as R
from tidewatch.operators import windows as WN
from tidewatch.plans import rule_workflow as WF
from tidewatch.plans.common import r6, rounded
from tidewatch.plans.eve import EVE_FLAT, eve_view
from tidewatch.plans.telemetry_queries import CLEANED, MIDDLE, WINDOW, WINDOW_COLS, windows_sql
from tidewatch.plans.views import ctes, view
from tidewatch.schemas import DNS_WINDOW_FEATURES, HYPOTHESIS_FEATURES

NOVEL = "bad-example.test"  # left out of the baseline, so it is new in the scored period
TOP = 5


def baseline(spark, d):
    return view(spark, d, "dns_log").where(
        (F.col("ts") < MIDDLE) & ~F.col("query").contains(NOVEL))


def period(spark, d):
    return view(spark, d, "dns_log").where(F.col("ts") >= MIDDLE)


def windows_of(df):
    return WN.dns_windows(df, WINDOW, WN.window_origin(df))


def given_score(windows):
    """A fixed stand-in for the model score, so that SQL can follow."""
    return windows.withColumn("anomaly_score", F.col("unique_subdomains") * F.lit(1.0)
                              + F.col("dns_requests") / 1000)


def top(spark, d):
    return E.top_windows(given_score(windows_of(period(spark, d))), TOP)


def stats(spark, d):
    return E.baseline_stats(windows_of(baseline(spark, d)))


def names(spark, d):
    return E.ioc_candidates(period(spark, d), baseline(spark, d), 12)


def truth(spark, d):
    return view(spark, d, "truth")


def telemetry(spark, d):
    """Observed records; a few never reached the sensor."""
    return view(spark, d, "dns_log").where("seq % 401 <> 7").withColumn(
        "event_id", T.event_id("query"))


# --- specifications: one per DNS record, damaged in a rule-made way ---------------------------
VARIANTS = 20


def specs(spark, d):
    rows = view(spark, d, "dns_log").select(
        F.col("seq").alias("spec_id"), (F.col("seq") % VARIANTS).cast("int").alias("v"),
        T.clean_qname("query").alias("host"), "orig_p")
    v = F.col("v")
    numeric = v.isin(1, 10, 11, 12, 13)

    def conditions(field, op, text, number):
        return F.array(F.struct(field.alias("field"), op.alias("operator"), text.alias("value_str"),
                                number.alias("value_num")))

    none_s, none_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    native = conditions(
        F.when(v == 14, "http.host").when(v == 15, "dns.made_up").otherwise("dns.query"),
        F.when(v == 16, "startswith").when(v % 2 == 0, "endswith").otherwise("contains"),
        F.when(v == 17, F.repeat(F.lit("x"), F.lit(257))).when(v == 18, "").otherwise(
            F.concat(F.lit("."), F.col("host"))), none_d)
    aggregate = conditions(F.lit("unique_subdomains"), F.lit("gt"), none_s,
                           F.when(v == 13, -1.0).otherwise(F.col("orig_p") / 1000))
    cond = F.when(numeric, aggregate).otherwise(native)
    one = F.array(F.lit("observed"))
    return rows.select(
        "spec_id", F.when(v == 2, "").otherwise(F.concat(F.lit("candidate "), "host")).alias("name"),
        F.lit("Observed name").alias("description"),
        F.when(v == 3, F.array().cast("array<string>")).otherwise(one).alias("evidence"),
        F.lit("May be automated").alias("hypothesis"),
        F.when(numeric & (v != 10), "behavioral").otherwise("ioc").alias("rule_type"),
        F.when(v == 4, "smtp").when(v == 5, "tcp").otherwise("dns").alias("protocol"),
        F.lit("any").alias("source_scope"),
        F.when(v == 6, "home").otherwise("any").alias("destination_scope"),
        F.when(v == 7, F.array_repeat(F.element_at(cond, 1), 9)).otherwise(cond).alias("conditions"),
        F.when(v == 8, "critical").otherwise("medium").alias("severity"),
        (~numeric & (v != 9)).alias("suricata_compatible"),
        numeric.alias("requires_correlation"),
        F.when(numeric & (v != 11), "source").otherwise(none_s).alias("correlation_entity"),
        F.when((numeric & (v != 12)) | (v == 19), 60.0).otherwise(none_d).alias("window_seconds"),
        one.alias("limitations"),
        F.struct(one.alias("positive_cases"), one.alias("negative_cases")).alias("test_plan"))


VIOLATION = {  # expected code per variant
    2: "name_length", 3: "evidence_size", 4: "protocol_enum", 5: "native_conditions",
    6: "destination_scope_enum", 7: "conditions_size", 8: "severity_enum", 9: "native_flags",
    10: "aggregation_flags", 11: "entity_window", 12: "entity_window", 13: "behavioral_conditions",
    14: "native_conditions", 15: "condition_field_enum", 16: "condition_operator_enum",
    17: "native_conditions", 18: "native_conditions", 19: "native_window"}


def q_validate(spark, d):
    return R.validate_specs(specs(spark, d)).select(
        "spec_id", F.array_join("violations", ",").alias("violations"))


def responses(spark, d):
    """Stored model answers: JSON of a specification, broken in a rule-made way."""
    sound = specs(spark, d)
    text = F.to_json(F.struct(
        "name", "description", "evidence", "hypothesis", "rule_type", "protocol", "source_scope",
        "destination_scope", F.lit("@").alias("conditions"), "severity", "suricata_compatible",
        "requires_correlation", "correlation_entity", "window_seconds", "limitations",
        "test_plan"), {"ignoreNullFields": "false"})
    c = F.element_at("conditions", 1)
    listed = F.concat(F.lit('[{"field":"'), c["field"], F.lit('","operator":"'), c["operator"],
                      F.lit('","value":'), F.coalesce(F.concat(F.lit('"'), c["value_str"], F.lit('"')),
                                                      c["value_num"].cast("string")), F.lit("}]"))
    body = F.replace(text, F.lit('"@"'), listed)
    k = F.floor(F.col("spec_id") / VARIANTS) % 8
    broken = (F.when(k == 1, F.concat(F.lit("```json\n"), body))
              .when(k == 2, F.replace(body, F.lit('"severity"'), F.lit('"action"')))
              .when(k == 3, F.replace(body, F.lit('"window_seconds":'),
                                      F.lit('"extra":1,"window_seconds":')))
              .when(k == 4, F.lit(None).cast("string"))
              .when(k == 5, F.replace(body, F.lit('"medium"'), F.lit("5")))
              .otherwise(body))
    return sound.select(
        "spec_id", (k != 6).alias("done"),
        F.when(k == 7, "length").otherwise("stop").alias("done_reason"), broken.alias("response"))


PARSED = {1: "not_json", 2: "wrong_keys", 3: "wrong_keys", 4: "no_text", 5: "wrong_type",
          6: "incomplete", 7: "incomplete"}


def q_parse(spark, d):
    out = R.parse_specs(responses(spark, d))
    c = F.element_at("spec.conditions", 1)
    return out.select("spec_id", "status", F.col("spec.name").alias("name"),
                      c["operator"].alias("operator"), c["value_str"].alias("value_str"),
                      c["value_num"].alias("value_num"))


def rendered(spark, d):
    return R.render_rules(specs(spark, d).withColumn(
        "sid", F.lit(9900000) + F.col("spec_id") % 400))


def q_render(spark, d):
    return rendered(spark, d).select("spec_id", "sid", "rule", "render_error")


def q_render_hex(spark, d):
    """Values that need hex bytes, all three operators and both protocols."""
    rows = view(spark, d, "http_log").select(
        F.col("seq").alias("spec_id"), "user_agent", "uri", "host", "status_code")
    spec = rows.select(
        "spec_id", F.lit("http").alias("protocol"), F.lit(True).alias("suricata_compatible"),
        F.lit(False).alias("requires_correlation"), F.array(
            F.struct(F.lit("http.user_agent").alias("field"), F.lit("equals").alias("operator"),
                     F.concat("user_agent", F.lit(' "é";')).alias("value_str")),
            F.struct(F.lit("http.host").alias("field"), F.lit("contains").alias("operator"),
                     F.col("host").alias("value_str"))).alias("conditions"),
        (F.lit(9900000) + F.col("spec_id") % 99999).alias("sid"))
    return R.render_rules(spec).select("spec_id", "sid", "rule")


def q_sids(spark, d):
    return R.duplicate_sids(rendered(spark, d).where("rule IS NOT NULL"))


# --- evidence ---------------------------------------------------------------------------------
def q_safe(spark, d):
    return rounded(E.safe_dns_events(view(spark, d, "dns_log"), "seq"))


def q_ioc(spark, d):
    return names(spark, d)


def q_ioc_examples(spark, d):
    return rounded(E.ioc_examples(period(spark, d), names(spark, d)))


def q_stats(spark, d):
    return stats(spark, d)


def q_candidates(spark, d):
    return E.candidate_conditions(stats(spark, d), top(spark, d))


def q_examples(spark, d):
    return rounded(E.window_examples(top(spark, d), period(spark, d), WINDOW))


REVIEW = [("unique_subdomains", "gt", 3.0), ("nxdomain_ratio", "gte", 0.25)]


def q_review(spark, d):
    return rounded(E.behavioral_review(REVIEW, windows_of(baseline(spark, d)), top(spark, d)))


def q_behavioral(spark, d):
    return rounded(WF.behavioral_workflow(windows_of(baseline(spark, d)), top(spark, d), REVIEW))


def q_specification(spark, d):
    return WF.behavioral_specification(windows_of(baseline(spark, d)), top(spark, d), WINDOW)


def q_compare(spark, d):
    return rounded(E.compare_window(top(spark, d), stats(spark, d)))


def q_period(spark, d):
    rows = truth(spark, d).withColumn(
        "scenario", F.when(F.col("ts") < MIDDLE, "baseline").otherwise("A"))
    return rounded(E.period_summary(rows))


def q_suffix(spark, d):
    return E.suffix_rules(names(spark, d))


# --- rules ------------------------------------------------------------------------------------
def q_allowed(spark, d):
    return R.allowed_conditions(names(spark, d), E.candidate_conditions(
        stats(spark, d), top(spark, d)), window=WINDOW)


def q_grounded(spark, d):
    allowed = R.allowed_conditions(names(spark, d), E.candidate_conditions(
        stats(spark, d), top(spark, d)), window=WINDOW)
    # half of the sound behavioural specifications take all supplied window conditions
    supplied = E.candidate_conditions(stats(spark, d), top(spark, d)).agg(F.array_sort(
        F.collect_list(F.struct("field", "operator", F.lit(None).cast("string").alias("value_str"),
                                F.col("value").alias("value_num")))).alias("supplied"))
    takes = (F.col("spec_id") % VARIANTS == 1) & (F.floor(F.col("spec_id") / VARIANTS) % 2 == 0)
    rows = specs(spark, d).crossJoin(F.broadcast(supplied)).withColumn(  # one row
        "conditions", F.when(takes, F.col("supplied")).otherwise(F.col("conditions")))
    return R.check_grounded(rows, allowed)


def literal_rules(spark):
    """A fixed rule book, matched against whole telemetry tables."""
    book = [
        (9900001, "dns", [("dns.query", "endswith", ".Bad-Example.test")]),
        (9900002, "dns", [("dns.query", "contains", "MISSING"), ("dns.query", "endswith", ".office.test")]),
        (9900003, "http", [("http.user_agent", "equals", "curl/8.0"), ("http.uri", "contains", "evt-a")]),
        (9900004, "http", [("http.user_agent", "contains", "CURL")]),
        (9900005, "http", [("http.host", "equals", "LAB-service"), ("http.uri", "endswith", "0")]),
    ]
    return spark.createDataFrame(
        [(sid, proto, [(f, o, v) for f, o, v in cond]) for sid, proto, cond in book],
        "sid long, protocol string, conditions "
        "array<struct<field:string,operator:string,value_str:string>>")


def q_match(spark, d):
    return R.match_rules(R.native_events(view(spark, d, "dns_log"), view(spark, d, "http_log")),
                         literal_rules(spark))


def q_match_windows(spark, d):
    book = spark.createDataFrame(
        [(9900101, [("unique_subdomains", "gt", 3.0), ("nxdomain_ratio", "gte", 0.25)]),
         (9900102, [("dns_requests", "gte", 10.0)])],
        "sid long, conditions array<struct<field:string,operator:string,value_num:double>>")
    return rounded(R.match_windows(windows_of(view(spark, d, "dns_log")), book))


def q_broad(spark, d):
    events = telemetry(spark, d)
    broad = WF.broad_rule(spark)
    eve = G.replay(events.withColumn("flow_id", F.col("orig_p")),
                   R.match_rules(R.native_events(events), broad))
    return rounded(report(G.quality_report(truth(spark, d), events, eve, WF.BROAD_TEXT)))


REPORT = ["expected_attack_events", "detected_attack_events", "missed_attack_events",
          "benign_events", "benign_matches", "matched_events", "alerts_total",
          "unmatched_or_ambiguous_alerts", "capture_missing_events", "replay_missing_events",
          "alerts_per_1000_events", "precision", "decision", "status"]


def report(df):
    return df.select(*REPORT)


def q_attribution(spark, d):
    return G.attribute_alerts(eve_view(spark, d), truth(spark, d))


def q_coverage(spark, d):
    return G.coverage(truth(spark, d), telemetry(spark, d), eve_view(spark, d))


def q_quality(spark, d):
    return rounded(report(G.quality_report(truth(spark, d), telemetry(spark, d),
                                           eve_view(spark, d))))


def q_preview(spark, d):
    return rounded(G.alert_preview(eve_view(spark, d), 5))


def q_workflow(spark, d):
    out = WF.native_workflow(baseline(spark, d), period(spark, d), truth(spark, d).where(
        F.col("ts") >= MIDDLE))
    return rounded(report(out["report"]))


def q_board(spark, d):
    out = WF.native_workflow(baseline(spark, d), period(spark, d), truth(spark, d).where(
        F.col("ts") >= MIDDLE), control=True)
    return rounded(G.leaderboard({"candidate": out["report"], "broad control": out["control"]}))


QUERIES = {
    "safe_dns_events": q_safe,
    "ioc_candidates": q_ioc,
    "ioc_examples": q_ioc_examples,
    "baseline_stats": q_stats,
    "behavioral_candidates": q_candidates,
    "window_examples": q_examples,
    "behavioral_review": q_review,
    "behavioral_workflow": q_behavioral,
    "behavioral_specification": q_specification,
    "window_vs_baseline": q_compare,
    "period_summary": q_period,
    "candidate_suffix_rules": q_suffix,
    "validate_specs": q_validate,
    "parse_spec_responses": q_parse,
    "allowed_conditions": q_allowed,
    "grounded_conditions_check": q_grounded,
    "render_rules": q_render,
    "render_rules_hex": q_render_hex,
    "duplicate_sid_check": q_sids,
    "match_native_rules": q_match,
    "match_behavioral_rules": q_match_windows,
    "broad_negative_control": q_broad,
    "alert_attribution": q_attribution,
    "coverage_gaps": q_coverage,
    "quality_report": q_quality,
    "alert_preview": q_preview,
    "rule_workflow": q_workflow,
    "rule_leaderboard": q_board,
}

# --- oracles ----------------------------------------------------------------------------------
PERIODS = f"""{ctes('dns_log', 'truth')}, named AS (SELECT *, {CLEANED} AS name,
  orig_h || ':' || orig_p AS client FROM dns_log),
baseline AS (SELECT * EXCLUDE (name, client) FROM named WHERE ts < {MIDDLE} AND query NOT LIKE '%{NOVEL}%'),
period AS (SELECT * EXCLUDE (name, client) FROM named WHERE ts >= {MIDDLE})"""
IOC = f"""{PERIODS}, longest AS (SELECT name AS query, count(*) AS count FROM named WHERE ts >= {MIDDLE}
  GROUP BY 1 ORDER BY length(name) DESC, name LIMIT 12),
ioc AS (SELECT * FROM longest WHERE query NOT IN
  (SELECT name FROM named WHERE ts < {MIDDLE} AND query NOT LIKE '%{NOVEL}%'))"""


def _renamed(ctes_text: str, suffix: str) -> str:
    return ctes_text.replace("wrows AS", f"wrows_{suffix} AS").replace("FROM wrows)", f"FROM wrows_{suffix})"
                                                                       ).replace("wins AS", f"wins_{suffix} AS")


WINS = f"""{PERIODS}, {_renamed(windows_sql('baseline', WINDOW, '(SELECT min(ts) FROM baseline)'), 'b')},
{_renamed(windows_sql('period', WINDOW, '(SELECT min(ts) FROM period)'), 'p')},
topn AS (SELECT *, row_number() OVER (ORDER BY anomaly_score DESC, window_start, client) AS rank
  FROM (SELECT *, unique_subdomains * 1.0::DOUBLE + dns_requests / 1000 AS anomaly_score
    FROM wins_p) q ORDER BY rank LIMIT {TOP}),
stats AS (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.95), 4) AS p95 FROM wins_b"""
    for c in DNS_WINDOW_FEATURES) + """),
cand AS (SELECT feature AS field, 'gt' AS operator, round((p95 + peak) / 2, 4) AS value
  FROM stats JOIN (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(max({c}) AS DOUBLE) AS peak FROM topn"
    for c in HYPOTHESIS_FEATURES) + ") m USING (feature) WHERE peak > p95)"

VCASE = "CASE spec_id % 20 " + " ".join(f"WHEN {v} THEN '{c}'" for v, c in VIOLATION.items()) \
    + " ELSE '' END"
SPEC_ROWS = f"""{PERIODS}, specs AS (SELECT seq AS spec_id, name AS host, orig_p FROM named)"""
SPEC_V = f"""{SPEC_ROWS}, v AS (SELECT *, spec_id % 20 AS v, (spec_id // 20) % 8 AS k,
 spec_id % 20 IN (1, 10, 11, 12, 13) AS numeric, 9900000 + spec_id % 400 AS sid FROM specs),
one AS (SELECT *, CASE WHEN numeric THEN 'unique_subdomains' WHEN v = 14 THEN 'http.host'
  WHEN v = 15 THEN 'dns.made_up' ELSE 'dns.query' END AS field,
 CASE WHEN numeric THEN 'gt' WHEN v = 16 THEN 'startswith' WHEN v % 2 = 0 THEN 'endswith'
  ELSE 'contains' END AS operator,
 CASE WHEN v = 17 THEN repeat('x', 257) WHEN v = 18 THEN '' WHEN NOT numeric THEN '.' || host END
  AS value_str,
 CASE WHEN v = 13 THEN -1.0::DOUBLE WHEN numeric THEN CAST(orig_p AS DOUBLE) / 1000 END AS value_num
 FROM v)"""
RENDERED = "(0, 2, 3, 6, 7, 8, 19)"  # variants without a fault that rendering looks at
RULE_HEAD = 'any any -> any any (msg:"LOCAL GENERATED candidate"; '


def gate_sql(eve: str, truth_name: str, telemetry_where: str) -> str:
    """CTEs `gate` (one row) for a flat replay relation with ids per event."""
    rx = "nullif(lower(regexp_extract({t}, '(?i)evt-([0-9a-f]{{32}})', 1)), '')"
    per = ", ".join(rx.format(t=c) for c in ("rrname", "qname", "url", "hostname"))
    return f"""expd AS (SELECT event_id, arg_max(label, seq) AS label FROM {truth_name} WHERE delivered GROUP BY 1),
obs AS (SELECT DISTINCT {rx.format(t='query')} AS event_id FROM dns_log WHERE {telemetry_where}),
ev AS (SELECT *, coalesce(tx_id, dns_tx_id) AS tx,
  list_distinct(list_filter([{per}], lambda x: x IS NOT NULL)) AS ids FROM {eve}),
rep AS (SELECT DISTINCT flow_id, tx, unnest(ids) AS event_id FROM ev WHERE event_type = 'dns'),
pertx AS (SELECT flow_id, tx, count(*) AS k, min(event_id) AS event_id FROM rep
  WHERE event_id IN (SELECT event_id FROM expd) AND tx IS NOT NULL GROUP BY 1, 2),
al AS (SELECT * FROM ev WHERE event_type = 'alert' AND sid BETWEEN 9900000 AND 9999999),
att AS (SELECT seq, sid, count(e.event_id) AS n_known,
    CASE WHEN count(e.event_id) = 1 THEN min(e.event_id) END AS event_id
  FROM (SELECT seq, sid, unnest(ids) AS id FROM al WHERE len(ids) > 0) a
  LEFT JOIN expd e ON e.event_id = a.id GROUP BY 1, 2
  UNION ALL SELECT al.seq, sid, coalesce(k, 0), CASE WHEN k = 1 THEN pertx.event_id END
  FROM al LEFT JOIN pertx ON al.flow_id IS NOT DISTINCT FROM pertx.flow_id AND al.tx = pertx.tx
  WHERE len(ids) = 0),
hit AS (SELECT DISTINCT event_id FROM att WHERE event_id IS NOT NULL),
g AS (SELECT count(*) FILTER (label = 1) AS a, count(*) FILTER (label <> 1) AS b,
  count(*) FILTER (label = 1 AND event_id IN (SELECT event_id FROM hit)) AS tp,
  count(*) FILTER (label <> 1 AND event_id IN (SELECT event_id FROM hit)) AS fp,
  count(*) FILTER (event_id NOT IN (SELECT event_id FROM obs WHERE event_id IS NOT NULL)) AS cm,
  count(*) FILTER (event_id NOT IN (SELECT event_id FROM rep)) AS rm FROM expd),
h AS (SELECT count(*) AS total, count(*) FILTER (n_known <> 1) AS amb FROM att),
gate AS (SELECT *, CASE WHEN a = 0 OR b = 0 OR cm + rm + amb > 0 THEN 'REQUIRES_REVIEW'
   WHEN tp / a < 0.9 OR fp / b > 0.001 THEN 'REJECT' ELSE 'ACCEPT_CANDIDATE' END AS decision
 FROM g, h)"""


GATE_COLS = f"""a AS expected_attack_events, tp AS detected_attack_events, a - tp AS missed_attack_events,
 b AS benign_events, fp AS benign_matches, tp + fp AS matched_events, total AS alerts_total,
 amb AS unmatched_or_ambiguous_alerts, cm AS capture_missing_events, rm AS replay_missing_events,
 {r6('1000 * total / (a + b)', 'alerts_per_1000_events')},
 {r6('tp / nullif(tp + fp, 0)', 'precision')}, decision, CASE decision
 WHEN 'ACCEPT_CANDIDATE' THEN 'accepted_candidate' WHEN 'REJECT' THEN 'rejected'
 ELSE 'manual_review' END AS status"""


def replay_sql(name: str, source: str, match: str) -> str:
    """CTE with the flat replay of `source` where `match` marks the alerting rows."""
    return f"""{name} AS (SELECT seq * 2 AS seq, 'dns' AS event_type, orig_p AS flow_id, seq AS tx_id,
  NULL::BIGINT AS dns_tx_id, query AS rrname, NULL::VARCHAR AS qname, NULL::VARCHAR AS url,
  NULL::VARCHAR AS hostname, NULL::BIGINT AS sid FROM {source}
 UNION ALL SELECT seq * 2 + 1, 'alert', orig_p, seq, NULL, query, NULL, NULL, NULL, 9900001
  FROM {source} WHERE {match})"""


SEEN = "seq % 401 <> 7"
PERIOD_TRUTH = f"ptruth AS (SELECT * FROM truth WHERE ts >= {MIDDLE})"
# the candidate is the longest novel name that stays stable over the period
CANDIDATE = f"""{IOC}, pick AS (SELECT '.' || query AS suffix FROM ioc ORDER BY count DESC, query LIMIT 1),
{PERIOD_TRUTH}, {replay_sql('cand_eve', 'period', "ends_with(lower(query), (SELECT suffix FROM pick))")}"""

ORACLES = {
    "safe_dns_events": f"""WITH {PERIODS} SELECT seq, {r6('ts', 'ts')}, client, name AS query,
 rcode_name FROM named""",
    "ioc_candidates": f"WITH {IOC} SELECT * FROM ioc",
    "ioc_examples": f"""WITH {IOC} SELECT name AS query, {r6('arg_min(ts, seq)', 'ts')},
 arg_min(client, seq) AS client, arg_min(rcode_name, seq) AS rcode_name
 FROM named WHERE ts >= {MIDDLE} AND name IN (SELECT query FROM ioc) GROUP BY 1""",
    "baseline_stats": f"WITH {WINS} SELECT * FROM stats",
    "behavioral_candidates": f"WITH {WINS} SELECT * FROM cand",
    "window_examples": f"""WITH {WINS} SELECT rank, place, {r6('ts', 'ts')}, client, query, rcode_name
 FROM (SELECT t.rank, row_number() OVER (PARTITION BY t.rank ORDER BY length(n.name) DESC, n.seq)
   AS place, n.ts, n.client, n.name AS query, n.rcode_name FROM topn t JOIN named n
   ON n.client = t.client AND n.ts >= t.window_start AND n.ts < t.window_start + {WINDOW}
   AND n.ts >= {MIDDLE}) q WHERE place <= 2 ORDER BY rank, place LIMIT 5""",
    "behavioral_review": f"WITH {WINS} " + " UNION ALL ".join(
        f"""SELECT '{f}' AS field, '{o}' AS operator, {v}::DOUBLE AS threshold,
 (SELECT p95 FROM stats WHERE feature = '{f}') AS baseline_p95,
 (SELECT round(CAST(max({f}) AS DOUBLE), 4) FROM topn) AS top_max,
 (SELECT count(*) FROM wins_b WHERE unique_subdomains > 3 AND nxdomain_ratio >= 0.25)
   AS baseline_windows_matching, (SELECT count(*) FROM wins_b) AS baseline_windows,
 (SELECT count(*) FROM topn WHERE unique_subdomains > 3 AND nxdomain_ratio >= 0.25)
   AS top_windows_matching, (SELECT count(*) FROM topn) AS top_windows""" for f, o, v in REVIEW),
    "window_vs_baseline": f"WITH {WINS}, one AS (SELECT * FROM topn ORDER BY unique_subdomains DESC,"
    " rank LIMIT 1) SELECT feature, median AS baseline_median, CAST(rank AS INT) AS rank,"
    " round(selected, 6) AS selected FROM stats JOIN (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, rank, CAST({c} AS DOUBLE) AS selected FROM one"
        for c in DNS_WINDOW_FEATURES) + ") l USING (feature)",
    "period_summary": f"""WITH {ctes('truth')} SELECT CASE WHEN ts < {MIDDLE} THEN 'baseline' ELSE 'A'
 END AS scenario, count(*) AS events, {r6('min(ts)', 'started')}, {r6('max(ts)', 'ended')},
 {r6('avg(label)', 'suspicious_fraction')}, count(*) FILTER (delivered) AS delivered
 FROM truth GROUP BY 1""",
    "candidate_suffix_rules": f"""WITH {IOC} SELECT 'dns.query' AS field, 'endswith' AS operator,
 '.' || query AS value FROM ioc""",
    "validate_specs": f"WITH {SPEC_ROWS} SELECT spec_id, {VCASE} AS violations FROM specs",
    "parse_spec_responses": f"""WITH {SPEC_V}, st AS (SELECT *, CASE
 {' '.join(f"WHEN k = {i}{' AND v <> 8' if i == 5 else ''} THEN '{s}'" for i, s in PARSED.items())}
 ELSE 'parsed' END AS status FROM one)
SELECT spec_id, status, CASE WHEN status = 'parsed' THEN CASE WHEN v = 2 THEN '' ELSE
 'candidate ' || host END END AS name, CASE WHEN status = 'parsed' THEN operator END AS operator,
 CASE WHEN status = 'parsed' THEN value_str END AS value_str,
 CASE WHEN status = 'parsed' THEN value_num END AS value_num FROM st""",
    "allowed_conditions": f"""WITH {WINS}, longest AS (SELECT name AS query FROM named
  WHERE ts >= {MIDDLE} GROUP BY 1 ORDER BY length(name) DESC, name LIMIT 12)
SELECT 'dns_ioc' AS evidence_type, 'dns.query' AS field, 'endswith' AS operator,
 '.' || query AS value_str, NULL::DOUBLE AS value_num, 1 AS min_conditions, 1 AS max_conditions,
 NULL::VARCHAR AS entity, NULL::DOUBLE AS "window" FROM longest WHERE query NOT IN
  (SELECT name FROM named WHERE ts < {MIDDLE} AND query NOT LIKE '%{NOVEL}%')
UNION ALL SELECT 'dns_windows', field, operator, NULL, value, 2,
 CAST(least(3, (SELECT count(*) FROM cand)) AS INT), 'source IP and persistent UDP source port',
 {WINDOW}::DOUBLE FROM cand""",
    "grounded_conditions_check": f"""WITH {WINS}, longest AS (SELECT name AS query FROM named
  WHERE ts >= {MIDDLE} GROUP BY 1 ORDER BY length(name) DESC, name LIMIT 12),
 novel AS (SELECT query FROM longest WHERE query NOT IN
  (SELECT name FROM named WHERE ts < {MIDDLE} AND query NOT LIKE '%{NOVEL}%'))
SELECT seq AS spec_id, CASE
 WHEN seq % 20 = 1 AND (seq // 20) % 2 = 0 THEN
  (SELECT count(*) > 0 AND count(*) = count(DISTINCT field) FROM cand)
 WHEN seq % 20 IN (1, 11, 12, 13) THEN EXISTS (SELECT 1 FROM cand WHERE field = 'unique_subdomains'
  AND operator = 'gt' AND value = CASE WHEN seq % 20 = 13 THEN -1.0 ELSE orig_p / 1000.0 END)
 ELSE seq % 2 = 0 AND seq % 20 NOT IN (10, 14, 16, 18) AND name IN (SELECT query FROM novel)
 END AS grounded FROM named""",
    "render_rules": f"""WITH {SPEC_V} SELECT spec_id, sid, CASE WHEN v IN {RENDERED} THEN
 'alert dns {RULE_HEAD}' || rtrim(repeat('dns.query; content:".' || host || '"; nocase; ' ||
 CASE operator WHEN 'endswith' THEN 'endswith; ' ELSE '' END, CASE v WHEN 7 THEN 9 ELSE 1 END)) ||
 ' sid:' || sid || '; rev:1;)' END AS rule,
 CASE WHEN v IN {RENDERED} THEN NULL WHEN numeric OR v = 9 THEN 'needs_correlation'
  WHEN v IN (4, 5) THEN 'protocol' WHEN v IN (14, 15) THEN 'field' WHEN v = 16 THEN 'operator'
  ELSE 'value' END AS render_error FROM one""",
    "render_rules_hex": f"""WITH {ctes('http_log')} SELECT seq AS spec_id, 9900000 + seq % 99999 AS sid,
 'alert http {RULE_HEAD}http.user_agent; content:"|' ||
 rtrim(regexp_replace(hex(user_agent || ' "é";'), '(..)', '\\1 ', 'g')) || '|"; bsize:' ||
 strlen(user_agent || ' "é";') || '; http.host; content:"' || host ||
 '"; nocase; sid:' || (9900000 + seq % 99999) || '; rev:1;)' AS rule FROM http_log""",
    "duplicate_sid_check": f"""WITH {SPEC_V} SELECT sid, count(*) AS copies FROM one
 WHERE v IN {RENDERED} GROUP BY 1 HAVING count(*) > 1""",
    "match_native_rules": f"""WITH {ctes('dns_log', 'http_log')}
SELECT seq, 9900001::BIGINT AS sid FROM dns_log WHERE ends_with(lower(query), '.bad-example.test')
UNION ALL SELECT seq, 9900002 FROM dns_log WHERE contains(lower(query), 'missing')
 AND ends_with(lower(query), '.office.test')
UNION ALL SELECT seq, 9900003 FROM http_log WHERE user_agent = 'curl/8.0' AND contains(uri, 'evt-a')
UNION ALL SELECT seq, 9900004 FROM http_log WHERE contains(user_agent, 'CURL')
UNION ALL SELECT seq, 9900005 FROM http_log WHERE lower(host) = 'lab-service' AND ends_with(uri, '0')""",
    "match_behavioral_rules": f"""WITH {ctes('dns_log')},
 {windows_sql('dns_log', WINDOW, '(SELECT min(ts) FROM dns_log)')}
SELECT {r6('window_start', 'window_start')}, client, 9900101::BIGINT AS sid FROM wins
 WHERE unique_subdomains > 3 AND nxdomain_ratio >= 0.25
UNION ALL SELECT {r6('window_start', 'window_start')}, client, 9900102 FROM wins
 WHERE dns_requests >= 10""",
    "broad_negative_control": f"""WITH {PERIODS},
 seen AS (SELECT * FROM dns_log WHERE {SEEN}),
 {replay_sql('beve', 'seen', "ends_with(query, '.test')")},
 {gate_sql('beve', 'truth', SEEN)} SELECT {GATE_COLS} FROM gate""",
    "alert_attribution": f"""WITH {EVE_FLAT}, {ctes('truth')}, {gate_sql('eve_flat', 'truth', SEEN)}
 SELECT seq, sid, n_known, event_id FROM att""",
    "coverage_gaps": f"""WITH {EVE_FLAT}, {ctes('truth')}, {gate_sql('eve_flat', 'truth', SEEN)}
 SELECT a + b AS expected_events, cm AS capture_missing_events, rm AS replay_missing_events
 FROM gate""",
    "quality_report": f"""WITH {EVE_FLAT}, {ctes('truth')}, {gate_sql('eve_flat', 'truth', SEEN)}
 SELECT {GATE_COLS} FROM gate""",
    "alert_preview": f"""WITH {EVE_FLAT} SELECT {r6('ts', 'timestamp')}, sid,
 'LOCAL GENERATED candidate' AS message FROM eve_flat WHERE event_type = 'alert'
 ORDER BY seq LIMIT 5""",
    "rule_workflow": f"""WITH {CANDIDATE}, {gate_sql('cand_eve', 'ptruth', f'ts >= {MIDDLE}')}
 SELECT {GATE_COLS} FROM gate""",
}
ORACLES["behavioral_workflow"] = f"""SELECT *, 'REQUIRES_REVIEW' AS decision,
 'manual_review' AS status, 'conditions on windows are no single-event rule' AS reason
 FROM ({ORACLES["behavioral_review"]}) q"""
LONG_B, LONG_T = (f"(SELECT * FROM (SELECT window_start, client, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in HYPOTHESIS_FEATURES) + f" FROM {t}) UNPIVOT (v FOR field IN ("
    + ", ".join(HYPOTHESIS_FEATURES) + ")))" for t in ("wins_b", "topn"))
MEETS = """(SELECT count(*) FROM (SELECT window_start, client FROM {long} l JOIN pick USING (field)
  WHERE l.v > pick.value GROUP BY 1, 2 HAVING count(*) = (SELECT count(*) FROM pick)) q)"""
ORACLES["behavioral_specification"] = f"""WITH {WINS}, pick AS (SELECT field, operator, value
 FROM cand JOIN stats ON feature = field
 ORDER BY (value - p95) / greatest(p95, 0.0001) DESC, field LIMIT {WF.MOST_CONDITIONS})
SELECT CAST({WF.PROPOSED_SID} AS BIGINT) AS spec_id,
 string_agg(field || ' ' || operator || ' ' || format('{{:.4f}}', value), '; ' ORDER BY field)
  AS conditions, '' AS violations, true AS grounded,
 {MEETS.format(long=LONG_B)} AS baseline_windows_matching,
 {MEETS.format(long=LONG_T)} AS top_windows_matching, 'REQUIRES_REVIEW' AS decision FROM pick
HAVING count(*) >= {WF.LEAST_CONDITIONS}"""
ORACLES["rule_leaderboard"] = f"""WITH {CANDIDATE},
 {gate_sql('cand_eve', 'ptruth', f'ts >= {MIDDLE}')},
 broad AS (SELECT count(*) FILTER (label = 1) AS tp, count(*) FILTER (label <> 1) AS fp,
  bool_or(event_id NOT IN (SELECT event_id FROM obs)) AS gap FROM expd
  WHERE event_id IN (SELECT {'md5(CAST(seq AS VARCHAR))'} FROM period WHERE ends_with(query, '.test')))
SELECT 'candidate' AS candidate, true AS syntax_valid, tp AS detected_attack_events,
 fp AS benign_matches, {r6('tp / nullif(tp + fp, 0)', 'precision')}, decision FROM gate
UNION ALL SELECT 'broad control', true, tp, fp, {r6('tp / nullif(tp + fp, 0)')},
 (SELECT CASE WHEN max(n) > 0 THEN 'REQUIRES_REVIEW' ELSE 'REJECT' END FROM (
   SELECT count(*) AS n FROM period WHERE ends_with(query, '.test')
   AND md5(CAST(seq AS VARCHAR)) NOT IN (SELECT event_id FROM expd)) u) FROM broad"""
