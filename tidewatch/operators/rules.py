"""Detection specifications: validation, parsing, rendering and matching."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidewatch.operators.ranking import melt
from tidewatch.session import settle
from tidewatch.schemas import DNS_WINDOW_FEATURES, NATIVE_FIELDS, SID_MAX, SID_MIN, SPEC_SCHEMA

# fixed values: the allowed vocabulary and limits of a specification
RULE_TYPES = ["signature", "ioc", "behavioral"]
PROTOCOLS = ["dns", "http", "tcp", "udp", "tls", "other"]
SEVERITIES = ["low", "medium", "high"]
STRING_OPERATORS = ["contains", "equals", "endswith"]
NUMBER_OPERATORS = ["gt", "gte"]
TEXT_LIMITS = {"name": 120, "description": 1500, "hypothesis": 1500}
LIST_LIMITS = {"evidence": 12, "conditions": 8, "limitations": 10}
CASE_LIMIT = 10
VALUE_LIMIT = 256
PLAIN_CONTENT = "^[A-Za-z0-9._/-]+$"
RULE_MESSAGE = "LOCAL GENERATED candidate"
# end of fixed values


def _outside(col: Column, allowed) -> Column:
    return col.isNull() | ~col.isin(*allowed)


def _size_outside(col: Column, limit: int) -> Column:
    return col.isNull() | (F.size(col) < 1) | (F.size(col) > limit)


def structural_violations() -> Column:
    """Array of codes for fields that break their own limits."""
    cond = F.col("conditions")

    def number_bad(c):
        return F.isnan(c["value_num"]) | (F.abs(c["value_num"]) == float("inf"))

    checks = {f"{c}_length": F.col(c).isNull() | ~F.length(c).between(1, n)
              for c, n in TEXT_LIMITS.items()}
    checks |= {f"{c}_size": _size_outside(F.col(c), n) for c, n in LIST_LIMITS.items()}
    checks |= {
        "rule_type_enum": _outside(F.col("rule_type"), RULE_TYPES),
        "protocol_enum": _outside(F.col("protocol"), PROTOCOLS),
        "severity_enum": _outside(F.col("severity"), SEVERITIES),
        "source_scope_enum": _outside(F.col("source_scope"), ["any"]),
        "destination_scope_enum": _outside(F.col("destination_scope"), ["any"]),
        "flags_missing": F.col("suricata_compatible").isNull()
        | F.col("requires_correlation").isNull(),
        "condition_field_enum": F.exists(cond, lambda c: _outside(
            c["field"], NATIVE_FIELDS + DNS_WINDOW_FEATURES)),
        "condition_operator_enum": F.exists(cond, lambda c: _outside(
            c["operator"], STRING_OPERATORS + NUMBER_OPERATORS)),
        "condition_value": F.exists(cond, lambda c: (
            c["value_str"].isNull() == c["value_num"].isNull())
            | F.coalesce(number_bad(c), F.lit(False))),
        "window_value": F.coalesce(F.isnan("window_seconds")
                                   | (F.abs(F.col("window_seconds")) == float("inf")),
                                   F.lit(False)),
        "positive_cases_size": _size_outside(F.col("test_plan.positive_cases"), CASE_LIMIT),
        "negative_cases_size": _size_outside(F.col("test_plan.negative_cases"), CASE_LIMIT),
    }
    return F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(False)), F.lit(code)) for code, bad in checks.items()]))


def capability_violation() -> Column:
    """First conflict between rule type, flags, window and conditions; null when consistent."""
    cond = F.col("conditions")
    behavioral = (F.col("rule_type") == "behavioral") | F.exists(
        cond, lambda c: c["field"].isin(*DNS_WINDOW_FEATURES) | c["operator"].isin(*NUMBER_OPERATORS))
    compatible, correlated = F.col("suricata_compatible"), F.col("requires_correlation")
    entity, window = F.col("correlation_entity"), F.col("window_seconds")
    no_window = F.coalesce(entity, F.lit("")) == ""
    not_aggregate = F.exists(cond, lambda c: ~c["field"].isin(*DNS_WINDOW_FEATURES)
                             | ~c["operator"].isin(*NUMBER_OPERATORS)
                             | c["value_num"].isNull() | (c["value_num"] < 0))
    not_native = F.exists(cond, lambda c: ~F.startswith(
        c["field"], F.concat(F.col("protocol"), F.lit(".")))
        | ~c["operator"].isin(*STRING_OPERATORS) | c["value_str"].isNull()
        | ~F.length(c["value_str"]).between(1, VALUE_LIMIT))
    aggregate = (F.when((F.col("rule_type") != "behavioral") | compatible | ~correlated,
                        "aggregation_flags")
                 .when(no_window | window.isNull() | (window <= 0), "entity_window")
                 .when(not_aggregate, "behavioral_conditions"))
    native = (F.when(correlated | ~compatible, "native_flags")
              .when(entity.isNotNull() | window.isNotNull(), "native_window")
              .when(~F.col("protocol").isin("dns", "http") | not_native, "native_conditions"))
    return F.when(behavioral, aggregate).otherwise(native)


def validate_specs(specs: DataFrame) -> DataFrame:
    """Add `violations` (codes, empty when valid); capability is judged on sound fields only."""
    staged = specs.withColumn("violations", structural_violations())
    capability = capability_violation()
    return staged.withColumn("violations", F.when(
        (F.size("violations") == 0) & capability.isNotNull(), F.array(capability)).otherwise(
        F.col("violations")))


# --- parsing of stored responses -------------------------------------------------------------
_WIRE_CONDITION = T.StructType([T.StructField("field", T.StringType()),
                                T.StructField("operator", T.StringType()),
                                T.StructField("value", T.VariantType())])


def _wire_schema() -> T.StructType:
    """Specification as it appears in JSON: the condition value is a string or a number."""
    out = T.StructType()
    for f in SPEC_SCHEMA.fields:
        if f.name == "conditions":
            out.add("conditions", T.ArrayType(_WIRE_CONDITION))
        elif f.name != "spec_id":
            out.add(f)
    return out


SPEC_KEYS = [f.name for f in SPEC_SCHEMA.fields if f.name != "spec_id"]
CONDITION_KEYS = ["field", "operator", "value"]
PLAN_KEYS = ["positive_cases", "negative_cases"]


# JSON kinds a key may have; a list of nothing is caught later by the size limits
_TEXT, _FLAG = ("STRING",), ("BOOLEAN",)
_LIST, _NUMBER = ("ARRAY<STRING>", "ARRAY<VOID>"), ("BIGINT", "DOUBLE")
KINDS = {
    **{k: _TEXT for k in ("name", "description", "hypothesis", "rule_type", "protocol",
                          "source_scope", "destination_scope", "severity")},
    **{k: _LIST for k in ("evidence", "limitations")},
    **{k: _FLAG for k in ("suricata_compatible", "requires_correlation")},
    "correlation_entity": (*_TEXT, "VOID"),
    "window_seconds": (*_NUMBER, "VOID"),
}


def _of_kind(value: Column, allowed) -> Column:
    kind = F.schema_of_variant(value)
    ok = kind.isin(*allowed)
    return ok | F.startswith(kind, F.lit("DECIMAL")) if "DOUBLE" in allowed else ok


def parse_specs(responses: DataFrame) -> DataFrame:
    """(…, status, spec): strict reading of (done, done_reason, response) rows.

    Missing or additional keys are refused at every level, as are strings in place of numbers.
    """
    text = F.col("response")
    # null for anything that is not one JSON document
    tree = F.try_parse_json(text)
    kind = F.schema_of_variant(tree)
    plain = F.from_json(text, _wire_schema(), {"mode": "PERMISSIVE"})
    value = lambda c: F.schema_of_variant(c["value"])
    loose = F.from_json(text, ", ".join(f"{k} variant" for k in KINDS))
    cases = F.from_json(F.get_json_object(text, "$.test_plan"),
                        ", ".join(f"{k} variant" for k in PLAN_KEYS))
    terms = F.from_json(F.get_json_object(text, "$.conditions"),
                        "array<struct<field:variant,operator:variant,value:variant>>")
    sound = F.forall(terms, lambda c: _of_kind(c["field"], _TEXT) & _of_kind(c["operator"], _TEXT)
                     & _of_kind(c["value"], (*_TEXT, *_NUMBER)))
    for k, kinds in KINDS.items():
        sound = sound & _of_kind(loose[k], kinds)
    for k in PLAN_KEYS:
        sound = sound & _of_kind(cases[k], _LIST)

    def keys_differ(keys: Column, allowed) -> Column:
        want = F.array(*[F.lit(k) for k in allowed])
        return (F.size(F.array_except(keys, want)) > 0) | (F.size(F.array_except(want, keys)) > 0)

    top_keys = F.json_object_keys(text)
    plan_keys = F.json_object_keys(F.get_json_object(text, "$.test_plan"))
    raw_conditions = F.from_json(F.get_json_object(text, "$.conditions"), "array<variant>")
    condition_keys = F.transform(raw_conditions, lambda v: F.json_object_keys(F.to_json(v)))
    bad_keys = (keys_differ(top_keys, SPEC_KEYS) | keys_differ(plan_keys, PLAN_KEYS)
                | F.exists(condition_keys, lambda k: keys_differ(k, CONDITION_KEYS)))
    status = (F.when(~F.coalesce("done", F.lit(False)) | (F.coalesce("done_reason", F.lit(""))
                                                          == "length"), "incomplete")
              .when(text.isNull(), "no_text")
              .when(tree.isNull(), "not_json")
              .when(~F.startswith(kind, F.lit("OBJECT")), "not_object")
              .when(F.coalesce(bad_keys, F.lit(True)), "wrong_keys")
              .when(~F.coalesce(sound, F.lit(False)), "wrong_type")
              .otherwise("parsed"))
    condition = F.transform(plain["conditions"], lambda c: F.struct(
        c["field"].alias("field"), c["operator"].alias("operator"),
        F.when(value(c) == "STRING", F.try_variant_get(c["value"], "$", "string")
               ).alias("value_str"),
        F.when(value(c) != "STRING", F.try_variant_get(c["value"], "$", "double")
               ).alias("value_num")))
    spec = F.struct(*[condition.alias("conditions") if k == "conditions" else plain[k].alias(k)
                      for k in SPEC_KEYS])
    return responses.withColumn("status", status).withColumn(
        "spec", F.when(F.col("status") == "parsed", spec))


# --- allowed and grounded conditions ----------------------------------------------------------
def allowed_conditions(names: DataFrame | None = None, candidates: DataFrame | None = None,
                       entity: str = "source IP and persistent UDP source port",
                       window: float | None = None) -> DataFrame:
    """What a specification may contain, per kind of evidence."""
    none_s, none_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    parts = []
    if names is not None:
        parts.append(names.select(
            F.lit("dns_ioc").alias("evidence_type"), F.lit("dns.query").alias("field"),
            F.lit("endswith").alias("operator"), F.concat(F.lit("."), "query").alias("value_str"),
            none_d.alias("value_num"), F.lit(1).alias("min_conditions"),
            F.lit(1).alias("max_conditions"), none_s.alias("entity"), none_d.alias("window")))
    if candidates is not None:
        size = candidates.agg(F.count("*").cast("int").alias("n")).scalar()
        parts.append(candidates.select(
            F.lit("dns_windows").alias("evidence_type"), "field", "operator",
            none_s.alias("value_str"), F.col("value").alias("value_num"),
            F.lit(2).alias("min_conditions"), F.least(F.lit(3), size).alias("max_conditions"),
            F.lit(entity).alias("entity"),
            F.lit(None if window is None else float(window)).cast("double").alias("window")))
    if not parts:
        raise ValueError("neither names nor window conditions to allow")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_grounded(specs: DataFrame, allowed: DataFrame) -> DataFrame:
    """(spec_id, grounded): IOC specs use one observed suffix, behavioral ones a subset of the
    supplied conditions on distinct fields."""
    behavioral = F.col("rule_type") == "behavioral"
    flat = specs.select("spec_id", F.when(behavioral, "dns_windows").otherwise("dns_ioc").alias(
        "evidence_type"), F.explode_outer("conditions").alias("c")).select(
        "spec_id", "evidence_type", "c.*")
    keys = ["evidence_type", "field", "operator", "value"]
    value = F.coalesce("value_str", F.col("value_num").cast("string"))
    known = allowed.select(*keys[:3], value.alias("value")).distinct().withColumn(
        "known", F.lit(1))
    checked = flat.select("spec_id", *keys[:3], value.alias("value")).join(known, keys, "left")
    per = checked.groupBy("spec_id", "evidence_type").agg(
        F.count("field").alias("n"), F.count("known").alias("ok"),
        F.count_distinct("field").alias("fields"))
    return per.select("spec_id", F.when(
        F.col("evidence_type") == "dns_ioc", (F.col("n") == 1) & (F.col("ok") == 1)).otherwise(
        (F.col("ok") == F.col("n")) & (F.col("fields") == F.col("n"))).alias("grounded"))


# --- rendering --------------------------------------------------------------------------------
def spaced_hex(value: Column) -> Column:
    return F.regexp_replace(F.hex(F.encode(value, "UTF-8")), "(..)(?!$)", "$1 ")


def _render_condition(c: Column, protocol: Column) -> Column:
    value = c["value_str"]
    content = F.when(value.rlike(PLAIN_CONTENT) & ~F.contains(value, F.lit("\n")), value).otherwise(
        F.concat(F.lit("|"), spaced_hex(value), F.lit("|")))
    nocase = (protocol == "dns") | (c["field"] == "http.host")
    tail = F.when(c["operator"] == "equals", F.concat(
        F.lit("bsize:"), F.octet_length(value).cast("string"), F.lit(";"))).when(
        c["operator"] == "endswith", "endswith;")
    return F.concat_ws(" ", F.concat(c["field"], F.lit(";")),
                       F.concat(F.lit('content:"'), content, F.lit('";')),
                       F.when(nocase, "nocase;"), tail)


def render_rules(specs: DataFrame) -> DataFrame:
    """Add `rule` (one alert line) or `render_error`; needs `sid`, never emits another action."""
    cond, protocol = F.col("conditions"), F.col("protocol")
    no = F.lit(False)
    error = (F.when(F.coalesce(~F.col("sid").between(SID_MIN, SID_MAX), ~no), "sid_range")
             .when(F.coalesce(~F.col("suricata_compatible") | F.col("requires_correlation"), ~no),
                   "needs_correlation")
             .when(F.coalesce(~protocol.isin("dns", "http"), ~no), "protocol")
             .when(F.exists(cond, lambda c: ~c["field"].isin(*NATIVE_FIELDS) | ~F.startswith(
                 c["field"], F.concat(protocol, F.lit(".")))), "field")
             .when(F.exists(cond, lambda c: ~c["operator"].isin(*STRING_OPERATORS)), "operator")
             .when(F.exists(cond, lambda c: c["value_str"].isNull() | ~F.length(
                 c["value_str"]).between(1, VALUE_LIMIT)), "value"))
    body = F.array_join(F.transform(cond, lambda c: _render_condition(c, protocol)), " ")
    rule = F.concat(F.lit("alert "), protocol, F.lit(f' any any -> any any (msg:"{RULE_MESSAGE}"; '),
                    body, F.lit(" sid:"), F.col("sid").cast("string"), F.lit("; rev:1;)"))
    staged = specs.withColumn("render_error", error)
    return staged.withColumn("rule", F.when(F.col("render_error").isNull(), rule))


def duplicate_sids(rules: DataFrame) -> DataFrame:
    return rules.groupBy("sid").agg(F.count("*").alias("copies")).where("copies > 1")


def require_unique_sids(rules: DataFrame) -> DataFrame:
    twice = duplicate_sids(rules).orderBy("sid").first()
    if twice is not None:
        raise ValueError(f"SID {twice['sid']} is given to several rules")
    return rules


# --- matching ---------------------------------------------------------------------------------
def folded(field: Column, value: Column) -> Column:
    """DNS names and host names compare without case."""
    return F.when(field.isin("dns.query", "http.host"), F.lower(value)).otherwise(value)


def rule_conditions(rules: DataFrame) -> DataFrame:
    """(sid, n_conditions, field, operator, needle) of the distinct conditions of each rule."""
    distinct = F.array_distinct(F.transform("conditions", lambda c: F.struct(
        c["field"].alias("field"), c["operator"].alias("operator"),
        folded(c["field"], c["value_str"]).alias("needle"))))
    listed = rules.select("sid", distinct.alias("c"))
    return listed.select("sid", F.size("c").alias("n_conditions"),
                         F.explode("c").alias("c")).select("sid", "n_conditions", "c.*")


GRAM = 3
#: Characters of a value that are cut into grams together: finding a place in a text takes time in
#: proportion to the place.
PIECE = 512
#: Values that the frequency of grams is estimated on; they decide where a needle waits, no result.
SAMPLED = 1000
#: Slots of the probe filter, by the number of probes: one byte each.
LEAST_SLOTS, MOST_SLOTS = 1 << 10, 1 << 22
#: Text of a rule book up to which its conditions are broadcast.
BROADCAST_BYTES = 64 << 20


def _grams(value: Column, n: int) -> Column:
    """All texts of n neighbouring characters."""
    size = F.length(value)
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), size), F.lit(PIECE)),
                         lambda p: F.substring(value, p, PIECE + n - 1))
    return F.flatten(F.transform(F.filter(pieces, lambda p: F.length(p) >= n), lambda p: F.transform(
        F.sequence(F.lit(1), F.length(p) - n + 1), lambda i: F.substring(p, i, n))))


def _ending(length: Column) -> Column:
    """The largest power of two up to a length: the endings that a value offers have such lengths."""
    return F.greatest(F.lit(0), *[F.when(length >= 1 << k, 1 << k) for k in range(31)])


def _slot(field: Column, operator: Column, probe: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(field, operator, probe), F.lit(slots)).cast("int")


def rule_index(events: DataFrame, cond: DataFrame) -> DataFrame:
    """`cond` with `probe`, the text under which a condition waits.

    An `equals` needle waits under itself, an `endswith` needle under its ending of a power of two of
    characters, a `contains` needle under that of its grams which fewest sampled values hold; one
    shorter than a gram under itself.
    """
    inside = (F.col("operator") == "contains") & (F.length("needle") >= GRAM)
    direct = cond.where(~inside).withColumn("probe", F.when(
        F.col("operator") == "endswith", F.right(F.col("needle"), _ending(F.length("needle")))
    ).otherwise(F.col("needle")))
    filed = cond.where(inside).withColumn("gram", F.explode(F.array_distinct(
        _grams(F.col("needle"), GRAM))))
    fields = [f for f in NATIVE_FIELDS if f in events.columns]
    # at most SAMPLED rows, read from the first partitions
    sampled = melt(events.select(*[F.col(f"`{f}`") for f in fields]).limit(SAMPLED), [], fields,
                   "field", "value", cast="string").where(F.col("value").isNotNull())
    seen = sampled.select("field", F.explode(F.array_distinct(_grams(
        folded(F.col("field"), F.col("value")), GRAM))).alias("gram")).groupBy(
        "field", "gram").agg(F.count("*").alias("seen"))
    rarest = filed.join(F.broadcast(seen), ["field", "gram"], "left").groupBy(*cond.columns).agg(
        F.min_by("gram", F.struct(F.coalesce("seen", F.lit(0)), "gram")).alias("probe"))
    return direct.unionByName(rarest)


def match_rules(events: DataFrame, rules: DataFrame, key: str = "seq") -> DataFrame:
    """(key, sid) of every event that fulfils all conditions of a rule.

    `events` has a column per native field. Text tests become equalities: an event has its whole
    value, its endings of a power of two of characters and its three-letter grams as probes, and a
    condition waits under one of them (`rule_index`). The probes of the rule book are a literal filter
    of bounded size, tested by the same generated code that cuts the probes out of the value, so what
    no rule waits for never leaves the scan's task; what is left looks the conditions up and is
    verified on the value. The rule book is small beside the events: local SIDs bound it, and its text
    is measured before it is broadcast.
    """
    # read more than once below
    cond = settle(rule_index(events, rule_conditions(rules)))
    wanted = {r["field"]: r for r in cond.groupBy("field").agg(  # one row per field
        F.bool_or(F.col("operator") == "equals").alias("eq"),
        F.collect_set(F.when(F.col("operator") == "endswith", F.length("probe"))).alias("ends"),
        F.collect_set(F.when(F.col("operator") == "contains", F.length("probe"))).alias("grams")
    ).collect() if r["field"] in events.columns}
    total = cond.agg(F.count("*"), F.sum(F.octet_length("needle") + F.octet_length("probe"))).first()
    slots = LEAST_SLOTS
    while slots < min(16 * total[0], MOST_SLOTS):
        slots *= 2
    # a rule book's probes, at most MOST_SLOTS numbers
    taken = bytearray(slots)
    for r in cond.select(_slot(F.col("field"), F.col("operator"), F.col("probe"), slots).alias(
            "slot")).distinct().collect():
        taken[r["slot"]] = 1
    if not wanted:
        return events.select(key).join(cond.select("sid"), F.lit(False))
    probe, value, size = F.col("probe"), F.col("value"), F.length("value")
    is_inside, is_end = F.col("operator") == "contains", F.col("operator") == "endswith"
    tasks = F.lit(None).cast("array<struct<operator:string,length:int>>")
    for f, want in sorted(wanted.items()):
        listed = [("contains", n) for n in want["grams"]] + [("endswith", n) for n in want["ends"]]
        listed += [("equals", -1)] * want["eq"]
        tasks = F.when(F.col("field") == f, F.array(*[F.struct(
            F.lit(op).alias("operator"), F.lit(n).alias("length")) for op, n in sorted(listed)])
        ).otherwise(tasks)
    named = events.select(key, *[folded(F.lit(f), F.col(f"`{f}`").cast("string")).alias(f)
                                 for f in sorted(wanted)])
    asked = melt(named, [key], sorted(wanted), "field", "value", cast=None).where(
        value.isNotNull()).select(key, "field", "value", F.explode(tasks).alias("t")).select(
        key, "field", "value", "t.operator", F.when(F.col("t.length") < 0, size).otherwise(
            F.col("t.length")).alias("n")).where(size >= F.col("n"))
    # generated code from here to the lookup: a probe is a place in a piece of the value
    last = size - F.col("n") + 1
    pieces = asked.select(
        key, "field", "operator", "value", "n", F.explode(F.when(is_inside, F.sequence(
            F.lit(1), last, F.lit(PIECE))).otherwise(F.array(last))).alias("from")).withColumn(
        "piece", F.substring(value, F.col("from"), F.when(
            is_inside, PIECE - 1).otherwise(0) + F.col("n")))
    offered = pieces.select(
        key, "field", "operator", "value", "n", "from", "piece", F.explode(F.sequence(
            F.lit(1), F.length("piece") - F.col("n") + 1)).alias("i")).select(
        key, "field", "operator", "value", (F.col("from") + F.col("i") - 1).alias("at"),
        F.substring("piece", F.col("i"), F.col("n")).alias("probe")).where(
        F.substring(F.lit(bytes(taken)), _slot(F.col("field"), F.col("operator"), probe, slots) + 1,
                    1) == F.lit(b"\x01")).where(
        # a gram counts where it occurs first
        ~is_inside | (F.instr(value, probe) == F.col("at")) | (probe == "") & (F.col("at") == 1))
    held = F.broadcast(cond) if (total[1] or 0) <= BROADCAST_BYTES else cond
    needle = F.col("needle")
    hits = offered.join(held, ["field", "operator", "probe"]).where(
        F.when(is_inside, F.contains(value, needle)).when(
            is_end, F.endswith(value, needle)).otherwise(value == needle))
    return hits.groupBy(key, "sid", "n_conditions").agg(F.count("*").alias("met")).where(
        "met = n_conditions").select(key, "sid")


def native_events(dns: DataFrame, http: DataFrame | None = None, key: str = "seq") -> DataFrame:
    """Telemetry with one column per native field; raw wire names, nothing removed."""
    names = [F.col(f"`{f}`") for f in NATIVE_FIELDS]
    none = F.lit(None).cast("string")
    out = dns.select(F.col(key), F.col("query").alias("dns.query"),
                     *[none.alias(f) for f in NATIVE_FIELDS[1:]])
    if http is not None:
        out = out.unionByName(http.select(
            F.col(key), none.alias("dns.query"), F.col("uri").alias("http.uri"),
            F.col("host").alias("http.host"), F.col("user_agent").alias("http.user_agent")))
    return out.select(key, *names)


def _bounds(cond: DataFrame) -> dict[str, list[float]]:
    """The distinct bounds of every feature, rising; a rule book's, so few beside the windows."""
    listed = cond.groupBy("feature").agg(F.array_sort(F.collect_set("bound")).alias("bounds"))
    return {r["feature"]: r["bounds"] for r in listed.collect()}


def match_windows(windows: DataFrame, rules: DataFrame) -> DataFrame:
    """(window_start, client, sid) of windows that fulfil all numeric conditions of a rule.

    Every feature has its distinct bounds in rising order, and a window's value finds its place among
    them by binary search, so the bounds it reaches are the first ones. A rule waits at one bound
    only, that of its condition which fewest windows reach; a window takes up the rules at the bounds
    it reaches and tests their other conditions on its own row. Work follows those rules, not the
    rule book, and no window is shuffled. Local SIDs bound the rule book to SID_MAX - SID_MIN + 1
    rules of at most eight conditions, which is what is broadcast. Missing values and NaN reach no
    bound.
    """
    sound = F.col("sid").between(SID_MIN, SID_MAX)
    test = F.transform("conditions", lambda c: F.struct(
        c["field"].alias("feature"), (c["operator"] == "gt").alias("strict"),
        c["value_num"].cast("double").alias("bound")))
    known = F.forall("conditions", lambda c: c["operator"].isin(*NUMBER_OPERATORS)
                     & c["field"].isin(*DNS_WINDOW_FEATURES) & c["value_num"].isNotNull())
    book = settle(rules.where(sound & known & (F.size("conditions") > 0)).select(
        F.monotonically_increasing_id().alias("rule"), "sid", test.alias("tests")))
    cond = book.select("rule", "sid", "tests", F.explode("tests").alias("c")).select(
        "rule", "sid", "tests", "c.feature", "c.bound")
    bounds = _bounds(cond)
    value = lambda f: F.when(F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")),
                             F.col(f).cast("double")).otherwise(float("-inf"))
    placed = windows.select("window_start", "client", *[value(f).alias(f) for f in bounds])
    for f, listed in bounds.items():
        splits = sorted({float("-inf"), *listed, float("inf")})
        placed = Bucketizer(splits=splits, inputCol=f, outputCol=f"{f}__at").transform(placed)
    if not bounds:
        return windows.select("window_start", "client").join(rules.select("sid"), F.lit(False))
    reached = placed.select(F.explode(F.array(*[F.struct(
        F.lit(f).alias("feature"), F.col(f"{f}__at").cast("int").alias("at")) for f in bounds])
    ).alias("r")).groupBy("r.feature", "r.at").agg(F.count("*").alias("n"))
    # all bounds of a rule book: how many windows end at or beyond each
    at_least = F.sum("n").over(W.partitionBy("feature").orderBy(F.desc("at")))
    order = cond.select("feature", "bound").distinct().withColumn(
        "at", F.row_number().over(W.partitionBy("feature").orderBy("bound")))
    counted = order.select("feature", "bound", "at", F.lit(0).cast("long").alias("n")).unionByName(
        reached.select("feature", F.lit(None).cast("double").alias("bound"), "at", "n")).withColumn(
        "windows", at_least).where(F.col("bound").isNotNull())
    waiting = cond.join(counted.select("feature", "bound", "at", "windows"), ["feature", "bound"]
                        ).groupBy("rule", "sid").agg(
        F.min_by(F.struct("feature", "at", "tests"), F.struct("windows", "feature", "at")).alias(
            "w")).select("sid", "w.*")

    def offers(f: str) -> Column:
        at = F.col(f"{f}__at").cast("int")
        return F.when(at >= 1, F.transform(F.sequence(F.lit(1), at), lambda i: F.struct(
            F.lit(f).alias("feature"), i.alias("at")))).otherwise(
            F.array().cast("array<struct<feature:string,at:int>>"))

    taken = placed.select("window_start", "client", *bounds, F.explode(F.flatten(F.array(
        *[offers(f) for f in bounds]))).alias("o"))
    own = F.create_map(*[x for f in bounds for x in (F.lit(f), F.col(f))])
    met = F.forall("tests", lambda c: F.when(c["strict"], own[c["feature"]] > c["bound"]).otherwise(
        own[c["feature"]] >= c["bound"]))
    return taken.select("window_start", "client", *bounds, "o.*").join(
        F.broadcast(waiting), ["feature", "at"]).where(met).select("window_start", "client", "sid")
