"""End to end: evidence, candidate rule, matching, gate."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import telemetry as T
from tidewatch.operators import evidence as E
from tidewatch.operators import gate as G
from tidewatch.operators import rules as R
from tidewatch.session import settle

# fixed value: the deliberately broad control
BROAD_TEXT = ('alert dns any any -> any any (msg:"LOCAL overly broad negative control"; '
              'dns.query; content:".test"; endswith; sid:9900002; rev:1;)')


def broad_rule(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(9900002, "dns", [("dns.query", "endswith", ".test")])],
        "sid long, protocol string, conditions "
        "array<struct<field:string,operator:string,value_str:string>>")


def candidate_rule(names: DataFrame, sid: int = 9900001) -> DataFrame:
    """The most frequent novel name as one suffix rule."""
    best = names.orderBy(F.desc("count"), "query").limit(1)
    cond = F.struct(F.lit("dns.query").alias("field"), F.lit("endswith").alias("operator"),
                    F.concat(F.lit("."), "query").alias("value_str"))
    return best.select(F.lit(sid).cast("bigint").alias("sid"), F.lit("dns").alias("protocol"),
                       F.lit(True).alias("suricata_compatible"),
                       F.lit(False).alias("requires_correlation"),
                       F.array(cond).alias("conditions"))


def judge(dns: DataFrame, truth: DataFrame, rules: DataFrame, text: str = "", **limits) -> DataFrame:
    """Replay rules over telemetry and gate the resulting alerts."""
    events = dns.withColumn("event_id", T.event_id("query")).withColumn("flow_id", F.col("orig_p"))
    # read by the attribution and twice by the event flags
    eve = settle(G.replay(events, R.match_rules(R.native_events(dns), rules)))
    return G.quality_report(truth, events, eve, text, **limits)


def native_workflow(baseline: DataFrame, period: DataFrame, truth: DataFrame,
                    control: bool = False, **limits) -> dict[str, DataFrame]:
    """Candidate from novel names and its gate report; with `control`, the broad rule's too.

    Without a novel name there is no evidence and no rule. A rule that can't be rendered, takes a
    used SID or goes beyond the observed names ends the workflow.
    """
    names = settle(E.ioc_candidates(period, baseline))  # a dozen names, used by every step
    rule = settle(R.render_rules(candidate_rule(names)))
    faults = rule.where("render_error IS NOT NULL").select("sid", "render_error").first()
    if rule.isEmpty():
        raise ValueError("no name of the period is new; nothing to write a rule from")
    if faults is not None:
        raise ValueError(f"rule {faults['sid']} can't be written: {faults['render_error']}")
    R.require_unique_sids(rule)
    spec = rule.select(F.col("sid").alias("spec_id"), F.lit("ioc").alias("rule_type"), F.transform(
        "conditions", lambda c: F.struct(
            c["field"].alias("field"), c["operator"].alias("operator"),
            c["value_str"].alias("value_str"),
            F.lit(None).cast("double").alias("value_num"))).alias("conditions"))
    if not R.check_grounded(spec, R.allowed_conditions(names)).where("NOT grounded").isEmpty():
        raise ValueError("a rule asks for something that was not observed")
    out = {"names": names, "rule": rule, "report": judge(period, truth, rule, **limits)}
    if control:
        out["control"] = judge(period, truth, broad_rule(period.sparkSession), BROAD_TEXT, **limits)
    return out


def behavioral_workflow(baseline: DataFrame, top: DataFrame, conditions) -> DataFrame:
    """Aggregations are never deployed as native rules: evidence review and manual decision."""
    return E.behavioral_review(conditions, baseline, top).withColumns({
        "decision": F.lit("REQUIRES_REVIEW"), "status": F.lit("manual_review"),
        "reason": F.lit("conditions on windows are no single-event rule")})


PROPOSED_SID, LEAST_CONDITIONS, MOST_CONDITIONS = 9900101, 2, 3


def propose_behavioral(candidates: DataFrame, stats: DataFrame, window: float,
                       entity: str = "source IP and persistent UDP source port") -> DataFrame:
    """One specification of the conditions that rise furthest above the baseline's 95th percentile.

    Fewer than two such conditions are no evidence, and give no row.
    """
    rise = (F.col("value") - F.col("p95")) / F.greatest(F.col("p95"), F.lit(0.0001))
    best = candidates.join(stats.select(F.col("feature").alias("field"), "p95"), "field").orderBy(
        rise.desc(), "field").limit(MOST_CONDITIONS)
    none = F.lit(None)
    condition = F.struct("field", "operator", none.cast("string").alias("value_str"),
                         F.col("value").alias("value_num"))
    observed = F.concat_ws(" ", "field", F.lit("above"), F.col("p95").cast("string"))
    one = best.agg(F.array_sort(F.collect_list(condition)).alias("conditions"),
                   F.array_sort(F.collect_list(observed)).alias("evidence"))
    text = lambda x: F.lit(x)
    return one.where(F.size("conditions") >= LEAST_CONDITIONS).select(
        F.lit(PROPOSED_SID).cast("long").alias("spec_id"),
        text("unusual name lookups of one client").alias("name"),
        text("A client's windows exceed what the baseline shows in all listed features").alias(
            "description"), "evidence",
        text("Lookups carry data or are generated").alias("hypothesis"),
        text("behavioral").alias("rule_type"), text("dns").alias("protocol"),
        text("any").alias("source_scope"), text("any").alias("destination_scope"), "conditions",
        text("medium").alias("severity"), F.lit(False).alias("suricata_compatible"),
        F.lit(True).alias("requires_correlation"), text(entity).alias("correlation_entity"),
        F.lit(float(window)).alias("window_seconds"),
        F.array(text("thresholds follow one baseline")).alias("limitations"),
        F.struct(F.array(text("the most anomalous windows")).alias("positive_cases"),
                 F.array(text("all windows of the baseline")).alias("negative_cases")).alias("test_plan"))


def behavioral_specification(baseline: DataFrame, top: DataFrame, window: float) -> DataFrame:
    """From evidence to a judged specification: conditions, violations, groundedness and matches.

    The proposal passes the same validation and grounding as any specification and is matched against
    the windows it came from and those of the baseline. A sound one is left to a person, since windows
    are no single-event rule; any other is refused.
    """
    stats = settle(E.baseline_stats(baseline))
    candidates = settle(E.candidate_conditions(stats, top))
    spec = settle(R.validate_specs(propose_behavioral(candidates, stats, window)))
    grounded = R.check_grounded(spec, R.allowed_conditions(candidates=candidates, window=window))
    rules = spec.select(F.col("spec_id").alias("sid"), "conditions")
    counts = [R.match_windows(w, rules).agg(F.count("*").alias(n)) for w, n in (
        (baseline, "baseline_windows_matching"), (top, "top_windows_matching"))]
    sound = (F.size("violations") == 0) & F.col("grounded")
    listed = F.array_join(F.transform("conditions", lambda c: F.concat_ws(
        " ", c["field"], c["operator"], F.format_string("%.4f", c["value_num"]))), "; ")
    return spec.join(F.broadcast(grounded), "spec_id").crossJoin(F.broadcast(counts[0])).crossJoin(
        F.broadcast(counts[1])).select(  # all of them one row
        "spec_id", listed.alias("conditions"), F.array_join("violations", ",").alias("violations"),
        "grounded", "baseline_windows_matching", "top_windows_matching",
        F.when(sound, "REQUIRES_REVIEW").otherwise("REJECT").alias("decision"))
