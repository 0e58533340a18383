"""Columnar and delimited sources and sinks for connection records."""

import hashlib
from collections.abc import Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidewatch.schemas import CONNECTION_SCHEMA
from tidewatch.sources.files import opened


def read_connections(spark: SparkSession, path: str, schema: T.StructType = CONNECTION_SCHEMA,
                     row_id: str | None = None) -> DataFrame:
    """Headerless CSV (plain or gz) with fixed names.

    `row_id` names a column for the input ordinal: 0, 1, 2, ... through the files by path. It is
    given at the scan; a second pass over the input counts the rows of its splits.
    """
    df = spark.read.schema(schema).option("header", False).option("mode", "FAILFAST").csv(path)
    if row_id is None:
        return df
    split = ["__file", "__block"]
    placed = df.select(
        "*", F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"))
    # one row per split of the input
    sizes = placed.groupBy(*split).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = W.orderBy(*split).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*split, (F.coalesce(F.sum("__n").over(before), F.lit(0))
                                    - F.col("__first")).alias("__shift"))
    return placed.join(offsets, split).select(
        *[F.col(f"`{f.name}`") for f in schema.fields],
        (F.col("__at") + F.col("__shift")).alias(row_id))


def write_connections(df: DataFrame, path: str) -> None:
    df.write.option("header", False).option("compression", "gzip").csv(path)


def read_features(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet when the path says so, otherwise CSV with a header."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    # with a header, columns are taken by name and may come in any order
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def write_splits(df: DataFrame, path: str, split: str = "split", label: str = "label") -> DataFrame:
    """Zstd Parquet partitioned by split; returns the per-split manifest of what was written."""
    df.write.option("compression", "zstd").partitionBy(split).parquet(path)
    return split_manifest(read_splits(df.sparkSession, path), split, label)


def split_manifest(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("rows"),
                                 F.count_if(F.col(label) == 0).alias("normal"),
                                 F.count_if(F.col(label) == 1).alias("attack"))


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def audit_manifest(df: DataFrame, manifest: DataFrame, split: str = "split") -> DataFrame:
    """Expected and actual rows per split; splits missing on either side count as zero."""
    actual = df.groupBy(split).agg(F.count("*").alias("actual_rows"))
    expected = manifest.select(split, F.col("rows").alias("expected_rows"))
    zero = F.lit(0).cast("bigint")
    return expected.join(actual, split, "full").select(
        split, F.coalesce("expected_rows", zero).alias("expected_rows"),
        F.coalesce("actual_rows", zero).alias("actual_rows")).withColumn(
        "matches", F.col("expected_rows") == F.col("actual_rows"))


#: Bytes that a digest reads at once; tasks that hash files, at most.
DIGEST_BYTES, DIGEST_TASKS = 8 << 20, 10_000


def file_digests(spark: SparkSession, glob: str) -> DataFrame:
    """(file, bytes, sha256) of every file, of any size.

    Spark lists the files; each is read in pieces by one task, since the digest of a file needs its
    bytes in order. The files must be open to the executors: a shared mount, or a store that Arrow
    reads.
    """
    paths = [(unquote(f),) for f in spark.read.format("binaryFile").load(glob).inputFiles()]

    def digest(batches):
        for batch in batches:
            sizes, digests = [], []
            for path in batch.column("path").to_pylist():
                state, size = hashlib.sha256(), 0
                with opened(path) as source:
                    while piece := source.read(DIGEST_BYTES):
                        state.update(piece)
                        size += len(piece)
                sizes.append(size)
                digests.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                names=["path", "bytes", "sha256"])

    tasks = max(1, min(len(paths), DIGEST_TASKS))
    return spark.createDataFrame(paths, "path string").repartition(tasks, "path").mapInArrow(
        digest, "path string, bytes long, sha256 string").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "bytes", "sha256")


def verify_digest(spark: SparkSession, glob: str, expected: DataFrame) -> DataFrame:
    """Compare with a (file, sha256) manifest."""
    actual = file_digests(spark, glob).select("file", F.col("sha256").alias("actual"))
    return expected.select("file", F.col("sha256").alias("expected")).join(
        actual, "file", "full").withColumn(
        "matches", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))


def require_digest(spark: SparkSession, glob: str, expected: DataFrame) -> None:
    bad = verify_digest(spark, glob, expected).where(~F.col("matches"))
    if not bad.isEmpty():
        raise ValueError("checksum of the source differs from the expected one; nothing was built")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str], what: str = "columns that the model needs are missing"
                    ) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what}: {', '.join(missing)}")
    return df


def require_exact(actual: Sequence[str], expected: Sequence[str]) -> None:
    """The ordered feature list must be equal, not only the set."""
    if list(actual) != list(expected):
        raise ValueError("the model's ordered features are not the features given")


def contract_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: its position in `df`, null when missing, and the rows and null
    values found in it."""
    where = {c: i for i, c in enumerate(df.columns)}
    none = F.lit(None).cast("bigint")
    seen = df.agg(F.count("*").alias("rows"), F.array(*[
        F.count_if(F.col(f"`{c}`").isNull()) if c in where else none for c in required]).alias("n"))
    contract = F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(i).alias("required_position"),
        F.lit(where.get(c)).cast("int").alias("actual_position")) for i, c in enumerate(required)])
    return seen.select("rows", "n", F.posexplode(contract).alias("at", "c")).select(
        "c.*", F.col("c.actual_position").isNotNull().alias("present"), "rows",
        F.get("n", F.col("at")).alias("missing_values"))


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Small report tables end up in one file."""
    out = df.coalesce(1).write
    (out.option("header", True).csv(path) if fmt == "csv" else out.json(path))
