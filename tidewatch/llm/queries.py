"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    bpe, context_tree, credentials, hard_negatives, line_templates, merkle, mixing, neighbours,
    periodic_runs, quality, simhash, token_files, toxicity)
from tidewatch.llm.training import held_out
from tidewatch.session import scratch_path

QUERIES = {}
ORACLES: dict[str, str] = {"op3_merkle_fingerprints": merkle.ORACLE_SQL,
                           "op13_hard_negatives": hard_negatives.ORACLE_SQL}


def register(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_round_trip(docs: DataFrame) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return bpe.decode(ids, ranks).select("doc_id", *bpe.digest())


@register
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"))


@register
def op4_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    # only what the score reads leaves the scan
    scored = quality.score_quality(docs.select("doc_id", "text", "n_chars"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@register
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as vocabulary:
        path = scratch_path(spark, "tokens")
        token_files.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary.read())
    return token_files.with_crc32(token_files.read_tokens(spark, path))


@register
def op8_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op10_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), lexicon)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@register
def op6_block_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents")).drop("tie")


@register
def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_templates.drop_recurring(
        table(spark, sf_dir, "documents").select("doc_id", "text"), dropped="n_dropped",
        least=1, cut=True)
    return cleaned.select("doc_id", "n_dropped", "text")


@register
def op3_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


@register
def op7_owned_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secrets(table(spark, sf_dir, "documents"))


@register
def op2_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@register
def op11_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.run_digests(periodic_runs.repeat_words(docs))


@register
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.integer_rows(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)
