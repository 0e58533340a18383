"""The corpus pipeline: documents through five stages, each written as Parquet and read by the next.

Every stage works on all rows that its predecessor kept. Rejected documents, recurring lines and
later copies are gone for good; the mixture returns a document as often as it is taken, so ids may
repeat after it; the last stage returns ids and digests in place of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import line_templates, mixing, quality, queries, simhash
from tidewatch.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier, fitted on this stage's own input, doesn't reject.

    Null text and lengths count as empty; rows are judged one by one, so repeated rows stay or go
    together; without labels the model is fitted on nothing and its scores are one constant; columns
    called `score` or `predicted` are kept; an empty table stays empty.
    """
    return quality.keep_good(docs, queries.table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all rows; drops lines and sentences that an earlier document has too.

    The first document, by id, keeps a recurring line; null ids come last; null text stays null, text of
    dropped lines only becomes empty; rows of equal id and text are treated alike; an empty table stays
    empty.
    """
    return line_templates.drop_recurring(docs, least=1, cut=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near duplicates, the one with the smallest id.

    Null ids come last; ties of the id are settled by the text's hash, so one of repeated rows stays;
    texts without words are one class; unrelated texts of one id stay apart; an empty table stays empty.
    """
    return simhash.keep_first(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Returns each document as often as the mix takes it.

    Null sources are a source of their own and come last; texts without words are never taken; rows of
    equal id and text are copied alike; an empty table stays empty.
    """
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests, one row for each row it gets; null text counts as empty."""
    return queries.bpe_round_trip(docs)


STAGES = [("quality classifier", quality_classifier), ("line dedup", line_dedup),
          ("near dedup", near_dedup), ("source mixture", source_mixture),
          ("token ids", token_ids)]

#: Fitted weights, trees and draws: no stage but the last one's counts has an equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    root = scratch_path(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        out = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
