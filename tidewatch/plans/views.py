"""Derived telemetry views over the driver tables.

Each view is one SELECT used verbatim by both engines; only the epoch function differs.
"""

from pyspark.sql import DataFrame, SparkSession

from tidewatch import schemas as S
from tidewatch.session import prepare

US = {"spark": "unix_micros(CAST(ts AS TIMESTAMP))", "duckdb": "epoch_us(ts)"}
STR = {"spark": "STRING", "duckdb": "VARCHAR"}


def _name_of_event() -> str:
    return """concat('evt-', md5(CAST(event_id AS {str})), '.',
   CASE WHEN event_type = 'error' AND user_id % 5 = 0
          THEN concat(substr(md5(concat('t', CAST(event_id AS {str}))), 1, 24), '.api.dev.test')
        WHEN event_type = 'error' THEN 'missing.www.office.test'
        WHEN event_type = 'purchase' THEN 'DB.Backend.test.'
        WHEN event_type = 'click' AND user_id % 3 = 0 THEN 'telemetry-update.bad-example.test'
        WHEN event_type = 'view' THEN concat('h', CAST(user_id % 7 AS {str}), '.shared.test')
        ELSE 'www.office.test' END)"""


LABEL = ("CAST(CASE WHEN event_type = 'error' OR (event_type = 'click' AND user_id % 3 = 0) "
         "THEN 1 ELSE 0 END AS INT)")

RECIPES = {
    "dns_log": ("events", f"""SELECT event_id AS seq, {{us}} AS ts_us,
 CAST({{us}} AS DOUBLE) / 1000000 AS ts, '192.0.2.1' AS orig_h,
 CAST(20000 + user_id % 4 AS BIGINT) AS orig_p,
 CASE WHEN event_type = 'signup' THEN 'AAAA' ELSE 'A' END AS qtype_name,
 {_name_of_event()} AS query,
 CASE WHEN event_type = 'error' THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode_name,
 value / 1000 AS rtt,
 {LABEL} AS label, event_id % 53 <> 0 AS delivered
FROM events"""),
    "http_log": ("events", """SELECT event_id AS seq, {us} AS ts_us,
 CAST({us} AS DOUBLE) / 1000000 AS ts, '192.0.2.1' AS orig_h,
 CAST(20000 + user_id % 4 AS BIGINT) AS orig_p,
 concat('/catalog/event/evt-', md5(CAST(event_id AS {str}))) AS uri,
 'lab-service' AS host,
 CASE WHEN user_id % 9 = 0 THEN 'curl/8.0' ELSE 'lab-browser/1.0' END AS user_agent,
 CAST(CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 10 = 0 THEN 404 ELSE 200 END AS INT)
   AS status_code,
 CAST(event_id % 500 AS BIGINT) AS request_body_len,
 CAST((event_id * 7) % 500 AS BIGINT) AS response_body_len
FROM events WHERE event_type IN ('view', 'click')"""),
    "truth": ("events", f"""SELECT event_id * 4 + CASE WHEN event_id % 2 = 1 THEN 82 ELSE 0 END AS seq,
 CAST({{us}} AS DOUBLE) / 1000000 AS ts, md5(CAST(event_id AS {{str}})) AS event_id,
 {LABEL} AS label, event_id % 53 <> 0 AS delivered,
 CASE WHEN event_type IN ('view', 'click') THEN 'http' ELSE 'dns' END AS service,
 CASE WHEN event_type = 'error' THEN 'dns_tunnel'
      WHEN event_type = 'click' AND user_id % 3 = 0 THEN 'beacon' ELSE 'none' END AS attack_type
FROM events"""),
    "predictions": ("events", f"""SELECT p.event_id * 4 + 1 + 122 * copy AS seq,
 CAST({{us}} AS DOUBLE) / 1000000 AS ts, md5(CAST(p.event_id AS {{str}})) AS event_id,
 CAST(CASE WHEN (p.event_id % 13 = 0) <> (copy = 1) THEN 1 - label ELSE label END AS INT)
   AS prediction,
 CAST(label AS DOUBLE) / 2 + CAST(p.event_id % 100 AS DOUBLE) / 250 AS score,
 CASE WHEN event_type IN ('view', 'click') THEN 'http' ELSE 'dns' END AS source
FROM (SELECT event_id, ts, user_id, event_type, {LABEL} AS label, 0 AS copy FROM events
      UNION ALL
      SELECT event_id, ts, user_id, event_type, {LABEL} AS label, 1 AS copy FROM events
      WHERE event_id % 101 = 0) p"""),
    "conn": ("orders", """SELECT o_orderkey AS row_id,
 CASE o_orderstatus WHEN 'F' THEN 'udp' WHEN 'P' THEN 'icmp' ELSE 'tcp' END AS protocol_type,
 concat('svc', CAST(o_custkey % 7 AS {str})) AS service,
 CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'S0' ELSE 'SF' END AS flag,
 CAST(CASE WHEN o_custkey % 4 = 0 THEN o_orderkey % 5 ELSE 0 END AS BIGINT) AS duration,
 CAST(floor(o_totalprice / 40000) AS BIGINT) * 100 AS src_bytes,
 CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey % 3 END AS BIGINT) * 50 AS dst_bytes,
 CAST(1 + o_custkey % 6 AS BIGINT) AS conn_count,
 CAST(1 + o_custkey % 6 AS BIGINT) AS srv_count,
 CAST(o_custkey % 3 AS DOUBLE) / 4 AS serror_rate,
 CAST(1 - CAST(o_custkey % 3 AS DOUBLE) / 4 AS DOUBLE) AS same_srv_rate,
 CAST(0 AS BIGINT) AS num_outbound_cmds,
 CASE WHEN o_totalprice >= 320000 OR (o_orderstatus = 'P' AND o_custkey % 3 = 0)
           OR o_orderkey % 997 = 0
      THEN CASE o_orderkey % 2 WHEN 0 THEN 'smurf.' ELSE 'neptune.' END
      ELSE 'normal.' END AS attack_type
FROM orders"""),
    "scored": ("lineitem", """SELECT
 CAST(CASE WHEN l_discount >= 0.08 AND l_returnflag <> 'N' THEN 1 ELSE 0 END AS INT) AS label,
 round(CAST(l_discount AS DOUBLE) * 6 + l_tax * 2 + l_quantity / 100, 3) AS score,
 CASE l_returnflag WHEN 'A' THEN 'udp' WHEN 'R' THEN 'icmp' ELSE 'tcp' END AS protocol_type,
 concat('svc', CAST(l_suppkey % 7 AS {str})) AS service
FROM lineitem"""),
}

# connection rows of `conn` that carry a fixed integer-weighted score (exact in both engines)
RECIPES["conn_scored"] = ("orders", f"""SELECT row_id, protocol_type, service, flag, duration,
 src_bytes, dst_bytes, serror_rate,
 CASE WHEN attack_type = 'normal.' THEN 'normal'
      WHEN attack_type = 'smurf.' THEN 'smurf' ELSE 'neptune' END AS attack_type,
 CAST(CASE WHEN attack_type = 'normal.' THEN 0 ELSE 1 END AS INT) AS label,
 CAST(src_bytes * 3 + duration * 500 + CAST(serror_rate * 4 AS BIGINT) * 400 - dst_bytes * 2
      + 1000 AS DOUBLE) / 10000 AS score
FROM ({RECIPES['conn'][1]}) c""")


def _conn41() -> str:
    """The full 41-column contract: the live columns plus rule-made constants and cycles."""
    given = {
        "duration": "duration", "protocol_type": "protocol_type", "service": "service",
        "flag": "flag", "src_bytes": "src_bytes", "dst_bytes": "dst_bytes",
        "count": "conn_count", "srv_count": "srv_count", "serror_rate": "serror_rate",
        "same_srv_rate": "same_srv_rate", "num_outbound_cmds": "num_outbound_cmds",
        "diff_srv_rate": "CAST(row_id % 11 AS DOUBLE) / 10",
        "dst_host_count": "CAST(1 + row_id % 29 AS BIGINT)",
        "dst_host_srv_count": "CAST(1 + row_id % 23 AS BIGINT)",
        "attack_type": "attack_type",
    }
    cols = ["row_id"]
    for i, c in enumerate(S.CONNECTION_COLUMNS):
        if c in given:
            cols.append(f'{given[c]} AS {{q}}{c}{{q}}')
        elif c.endswith("_rate"):
            cols.append(f"CAST((row_id * {i + 3}) % {i + 7} AS DOUBLE) / {i + 7} AS {c}")
        else:
            cols.append(f"CAST({'0' if i % 3 == 0 else f'(row_id * {i}) % {i + 2}'} AS BIGINT) AS {c}")
    return f"SELECT {', '.join(cols)} FROM ({RECIPES['conn'][1]}) c"


RECIPES["conn41"] = ("orders", _conn41())
QUOTE = {"spark": "`", "duckdb": '"'}


def sql(name: str, engine: str = "duckdb") -> str:
    return RECIPES[name][1].format(us=US[engine], str=STR[engine], q=QUOTE[engine])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = RECIPES[name][0]
    text = sql(name, "spark").replace(f"FROM {source}", "FROM {" + source + "}")
    return prepare(spark).sql(text, **{source: table(spark, sf_dir, source)})


def ctes(*names: str) -> str:
    """`name AS (...)` list for a DuckDB WITH clause."""
    return ",\n".join(f"{n} AS ({sql(n)})" for n in names)
