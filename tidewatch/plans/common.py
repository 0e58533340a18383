"""Small helpers shared by the query catalogues."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (sums are order dependent in the last bits)."""
    return df.select(*[
        (F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c)
        if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes])


def r6(expr: str, name: str | None = None) -> str:
    """The DuckDB twin of `rounded` for one expression."""
    text = f"round(CAST({expr} AS DOUBLE), 6) + 0.0"
    return f"{text} AS {name}" if name else text


def cum_sql(source: str, by: str = "", name: str = "cum") -> str:
    """CTEs `<name>_cells`, `<name>`: distinct scores with running counts, highest first."""
    b = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""{name}_cells AS (SELECT {b}score, CAST(sum(label) AS DOUBLE) AS pos,
   CAST(sum(1 - label) AS DOUBLE) AS neg FROM {source} GROUP BY {b}score),
{name} AS (SELECT {b}score, pos, neg, sum(pos) OVER ({part}ORDER BY score DESC) AS tp,
   sum(neg) OVER ({part}ORDER BY score DESC) AS fp,
   sum(pos) OVER ({part.strip()}) AS p, sum(neg) OVER ({part.strip()}) AS n FROM {name}_cells)"""


RATES_SQL = {
    "accuracy": "(tp + tn) / (tp + fp + fn + tn)",
    "balanced_accuracy": "(tp / (tp + fn) + tn / (tn + fp)) / 2",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "tp / (tp + fn)",
    "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
    "specificity": "tn / (tn + fp)",
    "fpr": "fp / (tn + fp)",
    "fnr": "fn / (fn + tp)",
    "mcc": "coalesce((tp * tn - fp * fn) / nullif(sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp)"
           " * sqrt(tn + fn), 0), 0)",
}


def suite_sql(cum: str, threshold: str, by: str = "") -> str:
    """SELECT giving tp/fp/fn/tn and the rank metrics per group from a `cum_sql` CTE."""
    b = f"{by}, " if by else ""
    return f"""SELECT {b}p, n, sum(pos * (n - fp + neg / 2)) / (p * n) AS roc_auc,
   sum(pos * tp / (tp + fp)) / p AS average_precision, max(abs(tp / p - fp / n)) AS ks,
   coalesce(sum(pos) FILTER (score >= {threshold}), 0) AS tp,
   coalesce(sum(neg) FILTER (score >= {threshold}), 0) AS fp,
   p - coalesce(sum(pos) FILTER (score >= {threshold}), 0) AS fn,
   n - coalesce(sum(neg) FILTER (score >= {threshold}), 0) AS tn
 FROM {cum} GROUP BY {b}p, n"""
