"""The pipeline's stages in order, and that every operator has its query."""

import collections
import re

import corpus_pipeline
import public_tokenizers
import tiktoken
from tidewatch.llm import bpe, quality, queries
from tidewatch.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    numbers = [int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES if k.startswith("op")]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_stages(spark):
    docs = queries.table(spark, SF, "documents")
    columns, counts, last = docs.columns, [docs.count()], None
    root = scratch_path(spark, "stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        last = docs
        stage(spark, docs, SF).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        counts.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert 0 < counts[1] < counts[0] and counts[2] == counts[1] and 0 < counts[3] < counts[2]
    assert counts[5] == counts[4] > 0
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoding = tiktoken.Encoding("check", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})
    want = collections.Counter((r.doc_id, len(encoding.encode_ordinary(r.text)))
                               for r in last.collect())
    assert want == collections.Counter((r.doc_id, r.n_tokens) for r in docs.collect())
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_stand_odd_documents(spark, odd_documents):
    docs = odd_documents.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).count()
        stage(spark, docs.limit(0), SF).count()


def test_quality_stage_keeps_columns_of_its_own_names(spark):
    docs = queries.table(spark, SF, "documents")
    named = docs.selectExpr("*", "concat('s', doc_id) AS score", "doc_id AS predicted")
    labels = queries.table(spark, SF, "labels")
    kept = quality.keep_good(named, labels)
    assert kept.columns == named.columns
    rows = kept.collect()
    assert rows and all(r.score == f"s{r.doc_id}" and r.predicted == r.doc_id for r in rows)
    assert sorted(r.doc_id for r in rows) == sorted(
        r.doc_id for r in quality.keep_good(docs, labels).collect())
