"""JSON-lines logs: strict, tolerant, rotated, streamed and appended."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_lines(lines: DataFrame, schema: T.StructType, malformed: str = "fail",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Lines of text to records; blank and `#` lines are not records.

    `malformed="fail"` stops at a broken line, `"drop"` leaves out everything that is not one
    JSON object. Invalid UTF-8 is replaced, never a reason to fail.
    """
    if malformed not in ("fail", "drop"):
        raise ValueError(malformed)
    text = F.make_valid_utf8("value")
    rows = lines.withColumn("value", text).where(
        (F.trim("value") != "") & ~F.startswith("value", F.lit("#")))
    if malformed == "drop":
        rows = rows.where(F.startswith(F.schema_of_variant(F.try_parse_json("value")),
                                       F.lit("OBJECT")))
    mode = "FAILFAST" if malformed == "fail" else "PERMISSIVE"
    return rows.select(*keep, F.from_json("value", schema, {"mode": mode}).alias("r")).select(
        *keep, "r.*")


def read_jsonl(spark: SparkSession, path, schema: T.StructType,
               malformed: str = "fail") -> DataFrame:
    """One or several files, folders or globs; a missing path is an error."""
    return parse_lines(spark.read.text(path), schema, malformed)


def stream_jsonl(spark: SparkSession, path: str, schema: T.StructType, source: str | None = None,
                 files_per_trigger: int | None = None) -> DataFrame:
    """Records of files that arrive in a folder; broken lines are dropped.

    Offsets live in the query's checkpoint. Producers add files (rotation) instead of growing
    one that was already read.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    out = parse_lines(reader.text(path), schema, "drop")
    return out.withColumn("source", F.lit(source)) if source else out


def _sorted(col: Column, kind: T.DataType) -> Column:
    """Struct fields in name order at every level, as canonical JSON wants them."""
    if isinstance(kind, T.StructType):
        parts = [_sorted(col[f.name], f.dataType).alias(f.name)
                 for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(col, lambda x: _sorted(x, kind.elementType))
    return col


def canonical_json(df: DataFrame) -> Column:
    """Compact JSON text of a row with sorted keys and explicit nulls."""
    parts = [_sorted(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
             for f in sorted(df.schema.fields, key=lambda f: f.name)]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    df.select(canonical_json(df).alias("value")).write.mode(mode).text(path)


def merge_logs(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Rotated parts of one log as one: repeated records removed, ordered by time.

    A record is its whole JSON object with sorted keys, so keys outside of `schema` tell records
    apart as well.
    """
    whole = F.to_json(F.try_parse_json(F.make_valid_utf8("value")))
    rows = parse_lines(spark.read.text(path).withColumn("__record", whole), schema,
                       keep=("__record",))
    return rows.dropDuplicates(["__record"]).drop("__record").orderBy(
        F.coalesce("ts", F.lit(0.0)))
