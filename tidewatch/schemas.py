"""Column contracts shared by every operator."""

from pyspark.sql import types as T

# --- fixed values: the connection-record contract (order matters) ---------------------------
CONNECTION_COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "land",
    "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in", "num_compromised",
    "root_shell", "su_attempted", "num_root", "num_file_creations", "num_shells",
    "num_access_files", "num_outbound_cmds", "is_host_login", "is_guest_login", "count",
    "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate",
    "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate",
    "attack_type",
]
CATEGORICAL = ["protocol_type", "service", "flag"]
LIVE_NUMERIC = [
    "duration", "src_bytes", "dst_bytes", "count", "srv_count", "serror_rate",
    "srv_serror_rate", "rerror_rate", "same_srv_rate", "diff_srv_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate",
]
DERIVED = [
    "total_bytes", "src_byte_share", "bytes_per_second", "zero_bytes", "srv_count_share",
    "host_srv_share", "log_duration", "log_src_bytes", "log_dst_bytes", "log_total_bytes",
    "log_bytes_per_second",
]
DNS_WINDOW_FEATURES = [
    "dns_requests", "unique_qnames", "unique_base_domains", "unique_subdomains",
    "avg_qname_length", "max_qname_length", "nxdomain_ratio", "avg_label_entropy",
    "peak_requests_per_second",
]
HYPOTHESIS_FEATURES = [
    "unique_subdomains", "avg_qname_length", "nxdomain_ratio", "avg_label_entropy",
    "peak_requests_per_second",
]
NATIVE_FIELDS = ["dns.query", "http.uri", "http.host", "http.user_agent"]
SID_MIN, SID_MAX = 9900000, 9999999
MISSING = "__MISSING__"
# --- end of fixed values --------------------------------------------------------------------

RAW_FEATURES = CONNECTION_COLUMNS[:-1]
LIVE_FEATURES = CATEGORICAL + LIVE_NUMERIC


def _connection_type(name: str) -> T.DataType:
    if name in CATEGORICAL or name == "attack_type":
        return T.StringType()
    return T.DoubleType() if name.endswith("_rate") else T.LongType()


CONNECTION_SCHEMA = T.StructType(
    [T.StructField(c, _connection_type(c)) for c in CONNECTION_COLUMNS]
)
DNS_LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("orig_h", T.StringType()),
    T.StructField("orig_p", T.LongType()),
    T.StructField("qtype_name", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("rcode_name", T.StringType()),
    T.StructField("rtt", T.DoubleType()),
    T.StructField("answers", T.ArrayType(T.StringType())),
])
HTTP_LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("orig_h", T.StringType()),
    T.StructField("orig_p", T.LongType()),
    T.StructField("uri", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("request_body_len", T.LongType()),
    T.StructField("response_body_len", T.LongType()),
])
TRUTH_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("delivered", T.BooleanType()),
    T.StructField("service", T.StringType()),
    T.StructField("attack_type", T.StringType()),
])
PREDICTION_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("prediction", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("source", T.StringType()),
])
EVE_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("flow_id", T.LongType()),
    T.StructField("tx_id", T.LongType()),
    T.StructField("alert", T.StructType([
        T.StructField("signature_id", T.LongType()),
        T.StructField("signature", T.StringType()),
    ])),
    T.StructField("dns", T.StructType([
        T.StructField("rrname", T.StringType()),
        T.StructField("queries", T.ArrayType(
            T.StructType([T.StructField("rrname", T.StringType())]))),
        T.StructField("tx_id", T.LongType()),
    ])),
    T.StructField("http", T.StructType([
        T.StructField("url", T.StringType()),
        T.StructField("hostname", T.StringType()),
    ])),
])
CONDITION_TYPE = T.StructType([
    T.StructField("field", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("value_str", T.StringType()),
    T.StructField("value_num", T.DoubleType()),
])
SPEC_SCHEMA = T.StructType([
    T.StructField("spec_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("evidence", T.ArrayType(T.StringType())),
    T.StructField("hypothesis", T.StringType()),
    T.StructField("rule_type", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("source_scope", T.StringType()),
    T.StructField("destination_scope", T.StringType()),
    T.StructField("conditions", T.ArrayType(CONDITION_TYPE)),
    T.StructField("severity", T.StringType()),
    T.StructField("suricata_compatible", T.BooleanType()),
    T.StructField("requires_correlation", T.BooleanType()),
    T.StructField("correlation_entity", T.StringType()),
    T.StructField("window_seconds", T.DoubleType()),
    T.StructField("limitations", T.ArrayType(T.StringType())),
    T.StructField("test_plan", T.StructType([
        T.StructField("positive_cases", T.ArrayType(T.StringType())),
        T.StructField("negative_cases", T.ArrayType(T.StringType())),
    ])),
])
