"""Derived connection features as native expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import CATEGORICAL, MISSING, RAW_FEATURES


def finite(col: Column) -> Column:
    """Null for anything that is not a finite number."""
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)


def numeric(df: DataFrame, name: str) -> Column:
    col, kind = F.col(f"`{name}`"), dict(df.dtypes)[name]
    return finite(col.try_cast("double") if kind == "string" else col.cast("double"))


def log_of(col: Column) -> Column:
    # greatest() skips nulls, so a missing value must be kept missing explicitly
    return F.when(col.isNotNull(), F.log1p(F.greatest(col, F.lit(0.0))))


def network_features(df: DataFrame, raw: list[str] | None = None,
                     keep: list[str] | None = None) -> DataFrame:
    """`keep` columns as they are, coerced raw features and the eleven derived ones.

    Derived features whose inputs are not among `raw` are left out.
    """
    raw = list(raw or RAW_FEATURES)
    base = [F.col(f"`{c}`") for c in (keep or [])]
    for c in raw:
        if c in CATEGORICAL:
            base.append(F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c))
        else:
            base.append(numeric(df, c).alias(c))
    out = df.select(*base)
    has = set(raw).issuperset
    src, dst, dur = F.col("src_bytes"), F.col("dst_bytes"), F.col("duration")
    one = F.lit(1.0)
    if has({"src_bytes", "dst_bytes"}):
        out = out.withColumn("total_bytes", finite(src + dst))
        out = out.withColumn("src_byte_share",
                             finite(F.try_divide(src, F.col("total_bytes") + one)))
        if has({"duration"}):
            out = out.withColumn("bytes_per_second",
                                 finite(F.try_divide(F.col("total_bytes"), dur + one)))
        out = out.withColumn("zero_bytes", F.coalesce(F.col("total_bytes") == 0, F.lit(False)
                                                      ).cast("int"))
    if has({"srv_count", "count"}):
        out = out.withColumn("srv_count_share", finite(F.try_divide(
            F.col("srv_count"), F.col("count") + one)))
    if has({"dst_host_srv_count", "dst_host_count"}):
        out = out.withColumn("host_srv_share", finite(F.try_divide(
            F.col("dst_host_srv_count"), F.col("dst_host_count") + one)))
    for c in ("duration", "src_bytes", "dst_bytes", "total_bytes", "bytes_per_second"):
        if c in out.columns:
            out = out.withColumn(f"log_{c}", log_of(F.col(c)))
    return out
