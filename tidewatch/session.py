"""Session settings the operators rely on, and shared scratch space."""

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Epoch arithmetic is written for UTC; everything else is left to the session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, `spark.checkpoint.dir`.

    Without it only a local session goes on, below its working folder: executors on other machines
    could not read what one of them or the driver has written.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(os.path.abspath(spark.conf.get("spark.sql.warehouse.dir").removeprefix(
            "file:")), "scratch")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root; never reused, never cleared."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def settle_wide(df: DataFrame, name: str) -> DataFrame:
    """Like `settle` for many columns of numbers: encoded by column, so later passes read little."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of an aggregate that several later passes read.

    The scan and shuffle behind it run once, and the written files survive lost executors.
    """
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)
