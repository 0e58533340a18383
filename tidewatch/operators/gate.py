"""Attribution of alerts to events and the quality gate of a rule."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import telemetry as T
from tidewatch.operators.ranking import null_safe_join, one_row
from tidewatch.schemas import SID_MAX, SID_MIN
from tidewatch.session import settle

# fixed values: gate limits and report wording
MIN_DETECTION_RATE, MAX_BENIGN_MATCH_RATE = 0.9, 0.001
STATUS = {"ACCEPT_CANDIDATE": "accepted_candidate", "REJECT": "rejected",
          "REQUIRES_REVIEW": "manual_review"}
DEPLOYMENT = "none; human approval required"


def expected_events(truth: DataFrame) -> DataFrame:
    """Last delivered truth record per event id."""
    return truth.where(F.coalesce("delivered", F.lit(True))).groupBy("event_id").agg(
        F.max_by("label", "seq").alias("label"))


def candidate_alerts(eve: DataFrame) -> DataFrame:
    return eve.where((F.col("event_type") == "alert")
                     & F.coalesce(F.col("alert.signature_id"), F.lit(0)).between(SID_MIN, SID_MAX))


def replay_ids(eve: DataFrame) -> DataFrame:
    """(flow_id, tx, event_id) of replayed transactions."""
    return eve.where(F.col("event_type").isin("dns", "http")).select(
        "flow_id", T.eve_transaction().alias("tx"),
        F.explode(T.eve_event_ids()).alias("event_id")).distinct()


def attribute_alerts(eve: DataFrame, truth: DataFrame) -> DataFrame:
    """One row per candidate alert: (seq, sid, n_known, event_id), `event_id` only when exactly
    one known id fits.

    An alert without ids takes those of its (flow, transaction), never of its flow alone. Each
    transaction is reduced to its number of known ids before alerts see it.
    """
    known = expected_events(truth).select("event_id")
    alerts = candidate_alerts(eve).select(
        "seq", F.col("alert.signature_id").alias("sid"), "flow_id",
        T.eve_transaction().alias("tx"), T.eve_event_ids().alias("ids"))
    named = alerts.where(F.size("ids") > 0).select(
        "seq", "sid", F.explode("ids").alias("event_id"))
    own = named.join(known.withColumn("k", F.lit(1)), "event_id", "left").groupBy("seq", "sid").agg(
        F.count("k").alias("n_known"),
        F.min(F.when(F.col("k") == 1, F.col("event_id"))).alias("event_id"))
    per_tx = replay_ids(eve).join(known, "event_id", "left_semi").groupBy("flow_id", "tx").agg(
        F.count("*").alias("n_known"), F.min("event_id").alias("event_id")).where(
        F.col("tx").isNotNull())
    bare = alerts.where(F.size("ids") == 0).select("seq", "sid", "flow_id", "tx")
    lent = null_safe_join(bare.where(F.col("tx").isNotNull()), per_tx, ["flow_id", "tx"],
                          "left").select(
        "seq", "sid", F.coalesce("n_known", F.lit(0)).cast("bigint").alias("n_known"), "event_id")
    # alerts without a transaction share no key and are not joined
    alone = bare.where(F.col("tx").isNull()).select(
        "seq", "sid", F.lit(0).cast("bigint").alias("n_known"),
        F.lit(None).cast("string").alias("event_id"))
    return own.unionByName(lent).unionByName(alone).withColumn(
        "event_id", F.when(F.col("n_known") == 1, F.col("event_id")))


def _ids(df: DataFrame, tag: str, label: Column | None = None) -> DataFrame:
    tags = ("expected", "observed", "replayed", "matched")
    return df.select("event_id", *[F.lit(1 if t == tag else 0).alias(t) for t in tags],
                     (label if label is not None else F.lit(None)).cast("int").alias("label"))


def event_flags(truth: DataFrame, telemetry: DataFrame, eve: DataFrame,
                matched: DataFrame) -> DataFrame:
    """Expected events with what happened to them; all sides meet in one aggregation by id."""
    seen = telemetry.select(F.col("event_id")).where(F.col("event_id").isNotNull())
    every = _ids(expected_events(truth), "expected", F.col("label")).unionByName(
        _ids(seen, "observed")).unionByName(_ids(replay_ids(eve), "replayed")).unionByName(
        _ids(matched, "matched"))
    return every.groupBy("event_id").agg(
        *[F.max(c).alias(c) for c in ("expected", "observed", "replayed", "matched", "label")]
    ).where("expected = 1")


def coverage(truth: DataFrame, telemetry: DataFrame, eve: DataFrame) -> DataFrame:
    """How many delivered events are missing from telemetry and from the replay."""
    none = telemetry.select("event_id").limit(0)
    return event_flags(truth, telemetry, eve, none).agg(
        F.count("*").alias("expected_events"),
        F.count_if(F.col("observed") == 0).alias("capture_missing_events"),
        F.count_if(F.col("replayed") == 0).alias("replay_missing_events"))


def quality_report(truth: DataFrame, telemetry: DataFrame, eve: DataFrame, rule: str = "",
                   syntax_valid: bool = True, min_detection: float = MIN_DETECTION_RATE,
                   max_benign: float = MAX_BENIGN_MATCH_RATE) -> DataFrame:
    """The one-row gate report of the alerts in `eve`; `telemetry` has an `event_id` column."""
    # one row per alert, read for the matches and for the alert counts
    attributed = settle(attribute_alerts(eve, truth))
    matched = attributed.where(F.col("event_id").isNotNull()).select("event_id")
    flags = event_flags(truth, telemetry, eve, matched)
    attack, benign, hit = F.col("label") == 1, F.col("label") != 1, F.col("matched") == 1
    counts = flags.agg(
        F.count_if(attack).alias("expected_attack_events"),
        F.count_if(attack & hit).alias("detected_attack_events"),
        F.count_if(attack & ~hit).alias("missed_attack_events"),
        F.count_if(benign).alias("benign_events"), F.count_if(benign & hit).alias("benign_matches"),
        F.count_if(hit).alias("matched_events"),
        F.count_if(F.col("observed") == 0).alias("capture_missing_events"),
        F.count_if(F.col("replayed") == 0).alias("replay_missing_events"))
    alerts = attributed.agg(
        F.count("*").alias("alerts_total"),
        F.count_if(F.col("n_known") != 1).alias("unmatched_or_ambiguous_alerts"))
    row = one_row(counts, alerts)
    total = F.col("expected_attack_events") + F.col("benign_events")
    recall = F.try_divide("detected_attack_events", "expected_attack_events")
    benign_rate = F.try_divide("benign_matches", "benign_events")
    incomplete = (F.col("capture_missing_events") + F.col("replay_missing_events")
                  + F.col("unmatched_or_ambiguous_alerts")) > 0
    decision = (F.when(F.lit(not syntax_valid), "REJECT")
                .when((F.col("expected_attack_events") == 0) | (F.col("benign_events") == 0)
                      | incomplete, "REQUIRES_REVIEW")
                .when((recall < min_detection) | (benign_rate > max_benign), "REJECT")
                .otherwise("ACCEPT_CANDIDATE"))
    status = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    out = row.select(
        F.lit(rule).alias("generated_rule"), F.lit(syntax_valid).alias("syntax_valid"), "*",
        F.try_divide(1000 * F.col("alerts_total"), total).alias("alerts_per_1000_events"),
        F.try_divide(F.col("detected_attack_events"), F.col("detected_attack_events")
                     + F.col("benign_matches")).alias("precision"), decision.alias("decision"),
        F.lit(DEPLOYMENT).alias("deployment"),
        F.lit(min_detection).alias("min_detection_rate"),
        F.lit(max_benign).alias("max_benign_match_rate"))
    return out.withColumn("status", status[F.col("decision")])


def leaderboard(reports: dict[str, DataFrame]) -> DataFrame:
    """Reports of several rules side by side."""
    out = None
    for name, report in reports.items():
        line = report.select(F.lit(name).alias("candidate"), "syntax_valid",
                             "detected_attack_events", "benign_matches", "precision", "decision")
        out = line if out is None else out.unionByName(line)
    return out


def alert_preview(eve: DataFrame, n: int = 5) -> DataFrame:
    return eve.where(F.col("event_type") == "alert").orderBy("seq").limit(n).select(
        F.col("ts").alias("timestamp"), F.col("alert.signature_id").alias("sid"),
        F.col("alert.signature").alias("message"))


def replay(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Replay events of telemetry (seq, ts, flow_id, query) and one alert per rule match.

    Transactions keep even positions, their alerts follow at odd ones.
    """
    def layout(df, kind, sid):
        return df.select(
            (F.col("seq") * 2 + (1 if kind == "alert" else 0)).alias("seq"),
            F.lit(kind).alias("event_type"), "ts", "flow_id", F.col("seq").alias("tx_id"),
            F.struct(sid.cast("bigint").alias("signature_id"),
                     F.lit("LOCAL GENERATED candidate").alias("signature")).alias("alert"),
            F.struct(F.col("query").alias("rrname"),
                     F.lit(None).cast("array<struct<rrname:string>>").alias("queries"),
                     F.lit(None).cast("bigint").alias("tx_id")).alias("dns"),
            F.struct(F.lit(None).cast("string").alias("url"),
                     F.lit(None).cast("string").alias("hostname")).alias("http"))

    rows = layout(events, "dns", F.lit(None))
    alerts = layout(events.join(matches, "seq"), "alert", F.col("sid"))
    return rows.unionByName(alerts)
