import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import telemetry as T
from tidewatch.operators import alerts as A
from tidewatch.operators import evidence as E
from tidewatch.operators import matching as MT
from tidewatch.operators import windows as WN
from tidewatch.schemas import DNS_WINDOW_FEATURES, LIVE_FEATURES

ID = "5d41402abc4b2a76b9719d911017c592"
DNS = "seq long, ts double, orig_h string, orig_p long, query string, qtype_name string, " \
      "rcode_name string, answers array<string>, rtt double"
HTTP = "seq long, ts double, uri string, host string, status_code int, " \
       "request_body_len long, response_body_len long"


def test_event_id(spark):
    rows = spark.createDataFrame([
        (f"evt-{ID}.host.invalid", None), (None, f"/event/EVT-{ID.upper()}"),
        ("www.example.org", None)], "query string, uri string")
    got = [r[0] for r in rows.select(T.event_id("query", "uri")).collect()]
    assert got == [ID, ID, None]


@pytest.mark.parametrize("name, want", [
    (f"EVT-{ID}.WWW.Office.test...", "www.office.test"), ("a.test.", "a.test"), ("", ""),
    (f"x.evt-{ID}.a.test", f"x.evt-{ID}.a.test")])
def test_clean_qname(spark, name, want):
    assert spark.createDataFrame([(name,)], "q string").select(T.clean_qname("q")).first()[0] == want


def entropy(label):
    n = len(label)
    return -sum(c / n * math.log2(c / n) for c in Counter(label).values()) if n else 0.0


def test_entropy_and_parts(spark):
    names = ["", "a", "aab", "abcd.x.test", "x.test", "test", "a.b.c.d.e", "été.x.y"]
    rows = spark.createDataFrame([(n,) for n in names], "q string").select(
        "q", T.label_entropy(T.first_label("q")).alias("e"), T.base_domain("q").alias("b"),
        T.subdomain("q").alias("s")).collect()
    for r in rows:
        parts = r["q"].split(".")
        assert r["e"] == pytest.approx(entropy(parts[0]), abs=1e-12)
        assert r["b"] == ".".join(parts[-2:])
        assert r["s"] == ".".join(parts[:-2])


def dns(spark, rows):
    return spark.createDataFrame(
        [(i, ts, "192.0.2.1", port, q, "A", rc, ans, None)
         for i, (ts, port, q, rc, ans) in enumerate(rows)], DNS)


def test_live_contract_and_window(spark):
    log = dns(spark, [(1.0, 1, "a", "NOERROR", ["A 1.2.3.4"]), (3.0, 1, "b", None, None),
                      (3.1, 1, "c", "NXDOMAIN", None), (9.0, 1, "d", "0", None)])
    http = spark.createDataFrame([], HTTP)
    out = WN.live_features(WN.merge_sources(log, http), 2.0)
    assert out.columns[-16:] == LIVE_FEATURES
    rows = {r["seq"] // 2: r for r in out.collect()}
    assert [rows[i]["count"] for i in range(4)] == [1, 2, 2, 1]  # the boundary is inside
    assert rows[0]["dst_bytes"] == 9 and rows[0]["protocol_type"] == "udp"
    assert rows[2]["flag"] == "REJ" and rows[2]["serror_rate"] == 0.5
    assert rows[3]["flag"] == "SF"


def brute_live(records, width):
    """records: (seq, ts_us, source, failed) -> counters by the definition."""
    out = {}
    for seq, ts, source, _ in records:
        seen = [r for r in records if (r[1], r[0]) <= (ts, seq) and r[1] >= ts - width]
        mine = [r for r in seen if r[2] == source]
        out[seq] = (len(seen), len(mine), sum(r[3] for r in seen), sum(r[3] for r in mine))
    return out


def test_live_counters_with_a_hot_instant(spark):
    """A third of all rows share one instant; counts stay exact."""
    records = []
    for i in range(240):
        ts = 5_000_000 if i % 3 == 0 else (i * 37_211) % 11_000_000
        records.append((i, ts, "dns" if i % 2 else "http", int(i % 5 == 0)))
    df = spark.createDataFrame(records, "seq long, ts_us long, source string, failed long")
    got = {r["seq"]: (r["nd"] + r["nh"], r["nd"] if r["seq"] % 2 else r["nh"], r["ed"] + r["eh"],
                      r["ed"] if r["seq"] % 2 else r["eh"])
           for r in WN.trailing_counters(df, 2.0).collect()}
    assert got == brute_live(records, 2_000_000)


def test_dns_windows_ignore_labels_and_prefix(spark):
    name = "www.office.test"
    log = dns(spark, [(1.0, 20000, f"evt-{'a' * 32}.{name}", "NOERROR", None),
                      (1.5, 20000, f"evt-{'b' * 32}.{name}", None, None),
                      (61.0, 20000, "x.y.z.test", "NXDOMAIN", None)]).withColumn("label", F.lit(1))
    out = WN.dns_windows(log, 60)
    assert out.columns == ["window_start", "client", *DNS_WINDOW_FEATURES]
    rows = {r["window_start"]: r for r in out.collect()}
    assert rows[0.0]["unique_qnames"] == 1 and rows[0.0]["dns_requests"] == 2
    assert rows[0.0]["peak_requests_per_second"] == 2 and rows[0.0]["nxdomain_ratio"] == 0
    assert rows[60.0]["unique_subdomains"] == 1 and rows[60.0]["nxdomain_ratio"] == 1
    with pytest.raises(ValueError, match="positive"):
        WN.dns_windows(log, 0)


TRUTH = "seq long, ts double, event_id string, label int, delivered boolean"
PRED = "seq long, ts double, event_id string, prediction int"


def match(spark, truth, pred):
    return {r["event_id"]: (r["label"], r["prediction"]) for r in MT.match_events(
        spark.createDataFrame(truth, TRUTH), spark.createDataFrame(pred, PRED)).collect()}


def test_match_any_order(spark):
    got = match(spark, [(2, 0., "a", 1, True), (3, 0., "b", 0, None)],
                [(1, 0., "a", 1), (4, 0., "b", 1), (5, 0., "c", 1), (6, 0., "", 1)])
    assert got == {"a": (1, 1), "b": (0, 1)}


def test_match_only_once_with_the_latest_seen(spark):
    assert match(spark, [(1, 0., "a", 1, True), (4, 0., "a", 0, True)],
                 [(2, 0., "a", 0), (3, 0., "a", 1)]) == {"a": (1, 0)}
    # the prediction changed before truth arrived
    assert match(spark, [(9, 0., "a", 1, True)],
                 [(2, 0., "a", 0), (3, 0., "a", 1), (10, 0., "a", 0)]) == {"a": (1, 1)}


def test_undelivered_truth_is_ignored(spark):
    assert match(spark, [(1, 0., "a", 1, False)], [(2, 0., "a", 1)]) == {}


def test_silence(spark):
    ts = [0.0, 10.0, 10.2, 200.0, 86_399.0, 86_401.0]
    got = [(r["silent_from"], r["silent_until"]) for r in A.silence(
        spark.createDataFrame([(t,) for t in ts], "ts double"), until=90_000.0).orderBy(
        "silent_from").collect()]
    assert got == [(10.2, 200.0), (200.0, 86_399.0), (86_401.0, 90_000.0)]


def test_evidence_is_allow_listed(spark):
    log = dns(spark, [(1.0, 1, f"evt-{'a' * 32}.www.office.test", "NOERROR", None)]).withColumn(
        "label", F.lit("SECRET"))
    safe = E.safe_dns_events(log)
    assert safe.columns == ["ts", "client", "query", "rcode_name"]
    assert safe.first()["query"] == "www.office.test"


def test_novel_names_limit_before_baseline(spark):
    old = dns(spark, [(1.0, 1, "a-very-long-known-name.test", None, None)])
    new = dns(spark, [(1.0, 1, "a-very-long-known-name.test", None, None),
                      (2.0, 1, "new.test", None, None), (3.0, 1, "new.test", None, None)])
    with pytest.raises(ValueError, match="No novel"):
        E.ioc_candidates(new, old, n=1, check=True)
    assert E.ioc_candidates(new, old, n=1, limit_after=True).first()["query"] == "new.test"
    assert E.ioc_candidates(new, old).first()["count"] == 2
