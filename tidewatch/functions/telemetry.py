"""Column expressions over DNS / HTTP telemetry; all of them stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: instrumentation prefix of generated names
EVENT_ID_PATTERN = "(?i)evt-([0-9a-f]{32})"
INSTRUMENTATION_PREFIX = "^evt-[0-9a-f]{32}\\."


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def event_id(*texts) -> Column:
    """First instrumented id in the given texts, lower-cased; null when there is none."""
    joined = F.concat_ws(" ", *[_c(t) for t in texts])
    return F.nullif(F.lower(F.regexp_extract(joined, EVENT_ID_PATTERN, 1)), F.lit(""))


def clean_qname(query) -> Column:
    bare = F.rtrim(F.lower(_c(query)), F.lit("."))
    return F.regexp_replace(bare, INSTRUMENTATION_PREFIX, "")


def first_label(name) -> Column:
    return F.substring_index(_c(name), ".", 1)


def base_domain(name) -> Column:
    """Last two labels."""
    return F.substring_index(_c(name), ".", -2)


def subdomain(name) -> Column:
    """Everything before the last two labels; empty when there is nothing."""
    name = _c(name)
    keep = F.length(name) - F.length(base_domain(name)) - 1
    return F.when(keep > 0, F.substring(name, F.lit(1), keep)).otherwise(F.lit(""))


def label_entropy(label) -> Column:
    """Shannon entropy in bits of the characters of one label."""
    label = _c(label)
    size = F.length(label).cast("double")

    def add(total, char):
        share = (size - F.length(F.replace(label, char, F.lit("")))) / size
        return total - share * F.log2(share)

    chars = F.array_distinct(F.regexp_extract_all(label, F.lit("(?s)(.)")))
    return F.when(F.length(label) == 0, F.lit(0.0)).otherwise(
        F.aggregate(chars, F.lit(0.0), add))


def client_key(orig_h="orig_h", orig_p="orig_p") -> Column:
    """Client session = source address and its persistent port."""
    return F.concat(F.coalesce(_c(orig_h), F.lit("")), F.lit(":"),
                    F.coalesce(_c(orig_p).cast("string"), F.lit("")))


def eve_dns_names(dns="dns") -> Column:
    """`rrname` of the answer plus every `queries[].rrname`, empty names left out."""
    dns = _c(dns)
    queried = F.coalesce(F.transform(dns["queries"], lambda q: q["rrname"]),
                         F.array().cast("array<string>"))
    return F.filter(F.concat(F.array(dns["rrname"]), queried),
                    lambda n: n.isNotNull() & (n != ""))


def eve_event_ids(dns="dns", http="http") -> Column:
    """Distinct instrumented ids of one event over its DNS names, URL and host name."""
    http = _c(http)
    texts = F.concat(eve_dns_names(dns), F.array(http["url"], http["hostname"]))
    return F.array_distinct(F.array_compact(F.transform(texts, lambda t: event_id(t))))


def eve_transaction(tx="tx_id", dns="dns") -> Column:
    return F.coalesce(_c(tx), _c(dns)["tx_id"])
