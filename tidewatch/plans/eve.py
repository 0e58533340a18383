"""Replay events derived from the DNS view: transactions and alerts, flat and nested."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.plans.views import ctes, sql, view
from tidewatch.session import prepare

# Transactions for every record but each 97th; alerts for labelled records. Every third alert
# has no names and needs its transaction; every 41st names only its flow; some carry foreign ids.
EVE_SELECT = """SELECT seq * 2 AS seq, 'dns' AS event_type, ts, orig_p AS flow_id,
  CASE WHEN seq % 2 = 0 THEN seq END AS tx_id, CASE WHEN seq % 2 = 1 THEN seq END AS dns_tx_id,
  CASE WHEN seq % 4 < 3 THEN query END AS rrname, CASE WHEN seq % 4 = 3 THEN query END AS qname,
  CAST(NULL AS {str}) AS url, CAST(NULL AS {str}) AS hostname, CAST(NULL AS BIGINT) AS sid
 FROM {src} WHERE seq % 97 <> 5
 UNION ALL SELECT seq * 2 + 1, 'alert', ts, orig_p, CASE WHEN seq % 41 <> 0 THEN seq END, NULL,
  CASE WHEN seq % 3 <> 0 THEN query END, NULL,
  CASE WHEN seq % 3 = 1 THEN concat('/x/', query) END, NULL,
  CAST(CASE WHEN seq % 29 = 0 THEN 2000001 ELSE 9900001 + seq % 2 END AS BIGINT)
 FROM {src} WHERE label = 1 OR seq % 211 = 0"""

EVE_FLAT = (f"{ctes('dns_log')}, eve_flat AS ("
            + EVE_SELECT.format(str="VARCHAR", src="dns_log") + ")")


def nest(flat: DataFrame) -> DataFrame:
    """Flat columns to the nested event layout."""
    return flat.select(
        "seq", "event_type", "ts", "flow_id", "tx_id",
        F.struct(F.col("sid").alias("signature_id"),
                 F.lit("LOCAL GENERATED candidate").alias("signature")).alias("alert"),
        F.struct("rrname", F.when(F.col("qname").isNotNull(), F.array(F.struct(
            F.col("qname").alias("rrname")))).alias("queries"),
            F.col("dns_tx_id").alias("tx_id")).alias("dns"),
        F.struct("url", "hostname").alias("http"))


def eve_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = EVE_SELECT.format(str="STRING", src="{dns_log}")
    return nest(prepare(spark).sql(text, dns_log=view(spark, sf_dir, "dns_log")))


__all__ = ["EVE_FLAT", "eve_view", "nest", "sql"]
