"""Portable seeded randomness: the same rows are drawn on any engine that has md5."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_u32(seed, *cols) -> Column:
    """Uniform 32-bit value of (seed, cols) as BIGINT."""
    text = F.concat_ws("|", F.lit(str(seed)), *[
        (F.col(c) if isinstance(c, str) else c).cast("string") for c in cols
    ])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_u60(seed, *cols) -> Column:
    """Uniform 60-bit value, wide enough to take modulo any row count."""
    text = F.concat_ws("|", F.lit(str(seed)), *[
        (F.col(c) if isinstance(c, str) else c).cast("string") for c in cols
    ])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def hash_u60_sql(seed, *cols: str) -> str:
    args = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {args})), 1, 15) AS BIGINT)"


def hash_u32_sql(seed, *cols: str) -> str:
    """The same value in DuckDB."""
    args = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {args})), 1, 8) AS BIGINT)"
