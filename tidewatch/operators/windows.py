"""DNS behaviour windows and trailing live features."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import telemetry as T
from tidewatch.operators.ranking import null_safe_join, prefix_sum
from tidewatch.schemas import DNS_WINDOW_FEATURES, LIVE_FEATURES


def window_origin(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Start of a capture: its earliest event."""
    return df.agg(F.min(ts).alias("origin"))


def window_start(ts: Column, width: float, origin: Column) -> Column:
    width = F.lit(float(width))
    return origin + F.floor((ts - origin) / width).cast("double") * width


def address_queries(df: DataFrame) -> DataFrame:
    """Rows that count for the windows: A queries with a name."""
    return df.where(F.col("query").isNotNull() & (F.col("query") != "")
                    & (F.coalesce("qtype_name", F.lit("A")) == "A"))


def dns_windows(df: DataFrame, width: float, origin=0.0) -> DataFrame:
    """Tumbling windows per client session; empty windows do not appear.

    `origin` is a number or a one-row frame from `window_origin`. Names are counted by hash
    aggregates, so a busy client is combined before every shuffle.
    """
    if width <= 0:
        raise ValueError("a window needs a positive width")
    start = origin.scalar() if isinstance(origin, DataFrame) else F.lit(float(origin))
    name = T.clean_qname("query")
    base = address_queries(df).select(
        F.col("ts"), window_start(F.col("ts"), width, start).alias("window_start"),
        T.client_key().alias("client"), name.alias("name"),
        F.coalesce(F.col("rcode_name") == "NXDOMAIN", F.lit(False)).cast("double").alias("nx"))
    rows = base.select(
        "window_start", "client", "name", "nx", F.length("name").alias("len"),
        T.base_domain("name").alias("base"), T.subdomain("name").alias("sub"),
        T.label_entropy(T.first_label("name")).alias("entropy"))
    keys = ["window_start", "client"]
    per_window = rows.groupBy(*keys).agg(
        F.count("*").alias("dns_requests"), F.count_distinct("name").alias("unique_qnames"),
        F.count_distinct("base").alias("unique_base_domains"),
        F.count_distinct("sub").alias("unique_subdomains"),
        F.avg("len").alias("avg_qname_length"), F.max("len").alias("max_qname_length"),
        F.avg("nx").alias("nxdomain_ratio"), F.avg("entropy").alias("avg_label_entropy"))
    peak = base.groupBy(*keys, F.col("ts").cast("bigint").alias("sec")).agg(
        F.count("*").alias("c")).groupBy(*keys).agg(
        F.max("c").alias("peak_requests_per_second"))
    return null_safe_join(per_window, peak, keys).select(*keys, *DNS_WINDOW_FEATURES)


RECORD_COLUMNS = ["query", "rcode_name", "answers", "rtt", "uri", "host", "status_code",
                  "request_body_len", "response_body_len"]


def merge_sources(dns: DataFrame, http: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One arrival order over both logs; DNS precedes HTTP at the same position."""
    both = (dns.withColumn("source", F.lit("dns"))).unionByName(
        http.withColumn("source", F.lit("http")), allowMissingColumns=True)
    types = {"answers": "array<string>", "rtt": "double", "status_code": "int",
             "request_body_len": "bigint", "response_body_len": "bigint"}
    cols = []
    for c in RECORD_COLUMNS:
        t = types.get(c, "string")
        cols.append((F.col(c) if c in both.columns else F.lit(None)).cast(t).alias(c))
    us = F.round(F.col("ts") * 1000000).cast("bigint")
    return both.select("source", (F.col("seq") * 2 + (F.col("source") == "http").cast("int")
                                  ).alias("seq"), "ts", us.alias("ts_us"), *keep, *cols)


def record_features(df: DataFrame) -> DataFrame:
    """Per-record part of the live features; missing fields take their defaults."""
    dns = F.col("source") == "dns"
    status = F.coalesce(F.nullif(F.col("status_code"), F.lit(0)), F.lit(200))
    failed = F.when(dns, ~F.coalesce("rcode_name", F.lit("NOERROR")).isin("NOERROR", "0")
                    ).otherwise(status >= 400)
    answers = F.coalesce(F.aggregate(F.coalesce("answers", F.array().cast("array<string>")),
                                     F.lit(0), lambda a, x: a + F.coalesce(F.length(x), F.lit(0))),
                         F.lit(0))
    zero = F.lit(0).cast("bigint")
    sent = F.when(dns, F.length(F.coalesce("query", F.lit("")))).otherwise(
        F.coalesce("request_body_len", zero) + F.length(F.coalesce("uri", F.lit(""))))
    received = F.when(dns, answers).otherwise(F.coalesce("response_body_len", zero))
    return df.withColumns({
        "event_id": T.event_id("query", "uri", "host"),
        "protocol_type": F.when(dns, "udp").otherwise("tcp"),
        "service": F.when(dns, "domain_u").otherwise("http"),
        "failed": failed.cast("bigint"),
        "flag": F.when(failed, "REJ").otherwise("SF"),
        "duration": F.coalesce("rtt", F.lit(0.0)),
        "src_bytes": sent.cast("bigint"), "dst_bytes": received.cast("bigint"),
    })


def trailing_counters(df: DataFrame, width: float, group: Sequence[str] = ()) -> DataFrame:
    """Counts over the last `width` seconds up to and including the row in (ts_us, seq) order.

    A trailing count is the running count at the row minus the running count just before
    `ts - width`. Each row therefore adds one probe at that instant, and one exact running sum
    over rows and probes answers both, however many rows fall into one window or instant.
    """
    group = list(group)
    width_us = int(round(width * 1_000_000))
    is_dns = (F.col("source") == "dns").cast("bigint")
    rows = df.select(*group, "seq", F.col("ts_us").alias("t"), F.lit(1).alias("kind"),
                     is_dns.alias("nd"), (1 - is_dns).alias("nh"),
                     (is_dns * F.col("failed")).alias("ed"),
                     ((1 - is_dns) * F.col("failed")).alias("eh"))
    none = F.lit(0).cast("bigint")
    probes = df.select(*group, "seq", (F.col("ts_us") - width_us).alias("t"),
                       F.lit(0).alias("kind"), *[none.alias(c) for c in ("nd", "nh", "ed", "eh")])
    span = df.agg(F.min("ts_us").alias("t0"), F.max("seq").alias("s")).first()
    if span["t0"] is None:
        span = {"t0": 0, "s": 0}
    # grows along (t, kind, seq); the fraction lets even rows of one instant be split up
    place = (F.col("t") - F.lit(span["t0"])).cast("double") + (
        F.col("kind") + F.col("seq") / F.lit(float(span["s"] + 1))) / 2
    measures = ["nd", "nh", "ed", "eh"]
    run = prefix_sum(rows.unionByName(probes), ["t", "kind", "seq"],
                     {f"r_{m}": F.col(m) for m in measures}, group=group, key=place)
    at = F.col("kind") == 1
    # every seq has exactly one row and one probe
    return run.groupBy(*group, "seq").agg(*[
        F.sum(F.when(at, F.col(f"r_{m}")).otherwise(-F.col(f"r_{m}"))).alias(m)
        for m in measures])


def live_features(df: DataFrame, width: float = 2.0, entity: Sequence[str] = (),
                  keep: Sequence[str] = ("seq", "ts", "source", "event_id")) -> DataFrame:
    """The sixteen live features of every record of a merged log."""
    records = record_features(df)
    counts = trailing_counters(records, width, entity).select(
        "seq", *[F.col(c) for c in ("nd", "nh", "ed", "eh")])
    return with_rates(records.join(counts, "seq"), [*keep, *entity])


def with_rates(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Counters nd/nh/ed/eh to the named features; repeated columns are part of the contract."""
    dns = F.col("source") == "dns"
    count = F.col("nd") + F.col("nh")
    srv = F.when(dns, F.col("nd")).otherwise(F.col("nh"))
    srv_err = F.when(dns, F.col("ed")).otherwise(F.col("eh"))
    same = srv / count
    named = {
        "count": count, "srv_count": srv, "serror_rate": (F.col("ed") + F.col("eh")) / count,
        "srv_serror_rate": srv_err / srv, "rerror_rate": F.col("failed").cast("double"),
        "same_srv_rate": same, "diff_srv_rate": 1.0 - same, "dst_host_count": count,
        "dst_host_srv_count": srv, "dst_host_same_srv_rate": same,
    }
    return df.select(*dict.fromkeys(keep), *[
        named[c].alias(c) if c in named else F.col(c) for c in LIVE_FEATURES])
