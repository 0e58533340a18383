"""Byte-level BPE and token files against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tidewatch.llm import bpe, queries, token_files
from tidewatch.llm.pretokens import split_block
from tidewatch.session import scratch_path
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
PATTERN = regex.compile(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("'strevmld  \n\t1a!²漢😀 　"),
                                  st.characters(codec="utf-8")), max_size=30), max_size=5))
def test_pre_tokens_equal_the_pattern(texts):
    tokens, counts = split_block(texts)
    want = [PATTERN.findall(t) for t in texts]
    assert tokens.to_pylist() == [w for ws in want for w in ws]
    assert counts.tolist() == [len(ws) for ws in want]


def reference(ranks, texts):
    encoding = tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=ranks, special_tokens={})
    return [encoding.encode_ordinary(t or "") for t in texts]


def test_round_trip_of_odd_documents(odd_documents, ranks):
    got = bpe.decode(bpe.encode(odd_documents, ranks, public_tokenizers.PATTERN,
                                keep=["doc_id", "size"]), ranks).collect()
    rows = odd_documents.collect()
    want = [(r.doc_id, r.size, ids, (r.text or "").encode()) for r, ids in zip(
        rows, reference(ranks, [r.text for r in rows]), strict=True)]
    assert sorted(map(str, want)) == sorted(
        str((r.doc_id, r.size, r.ids, bytes(r.decoded))) for r in got)


def test_blocks_and_buckets_do_not_matter(odd_documents, ranks, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 50)
    small = bpe.encode(odd_documents, ranks, public_tokenizers.PATTERN, buckets=3).collect()
    rows = odd_documents.collect()
    want = [(r.doc_id, ids) for r, ids in zip(rows, reference(ranks, [r.text for r in rows]),
                                              strict=True)]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.ids)) for r in small)


def test_decode_of_unknown_and_missing_ids(spark, ranks):
    rows = spark.createDataFrame([(1, [0, 1]), (2, [50_999_999]), (3, None), (4, []), (5, [-1])],
                                 "k int, ids array<int>")
    got = {r.k: r.decoded for r in bpe.decode(rows, ranks).collect()}
    by_id = {i: b for b, i in ranks.items()}
    assert got == {1: by_id[0] + by_id[1], 2: None, 3: None, 4: b"", 5: None}


def test_empty_table(odd_documents, ranks, vocabulary, spark):
    none = odd_documents.limit(0)
    assert bpe.decode(bpe.encode(none, ranks, public_tokenizers.PATTERN), ranks).count() == 0
    path = scratch_path(spark, "none")
    token_files.write_tokens(none, path, vocabulary)
    assert token_files.with_crc32(token_files.read_tokens(spark, path)).count() == 0


def test_token_files(odd_documents, vocabulary, spark):
    added = [t.content for t in Tokenizer.from_str(vocabulary).get_added_tokens_decoder().values()]
    assert added
    rows = [(200 + i, t, 7) for i, t in enumerate([
        f"x{added[0]}y", f"{added[0]} ", f"a {added[0]}{added[0]}b's", added[0][:-1], added[0].upper()])]
    odd_documents = odd_documents.select("doc_id", "text", "leaf").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string, leaf int"))
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(odd_documents, path, vocabulary)
    tokenizer = Tokenizer.from_str(vocabulary)
    rows = sorted(odd_documents.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    start = 0
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, []).append(
            tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2])
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.ids in texts[r.doc_id]
        start += r.n_tokens
    assert start == sum(len(ids) for lists in texts.values() for ids in lists)
    some = token_files.read_tokens(spark, path, [5, -7])
    assert {r.doc_id for r in some.collect()} == {5, -7}
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()


def test_registered_queries_against_the_libraries(spark, ranks, vocabulary):
    docs = sorted(queries.table(spark, SF, "documents").collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in queries.QUERIES["op1_bpe_round_trip"](spark, SF).collect()}
    for r, ids in zip(docs, reference(ranks, [r.text for r in docs]), strict=True):
        g = got[r.doc_id]
        assert g.n_tokens == len(ids)
        assert g.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    tokenizer = Tokenizer.from_str(vocabulary)
    files = {r.doc_id: r for r in queries.QUERIES["op5_token_files"](spark, SF).collect()}
    start = 0
    for r in docs:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert tuple(files[r.doc_id]) == (
            r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_memory_of_words_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    tokenizer = Tokenizer.from_str(vocabulary)
    encoder = token_files.WordEncoder(vocabulary)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc de") for _ in range(40)) for _ in range(20)]
    for t in texts:
        ids, n = token_files.encode_block(encoder, [t, "", t], 2)
        want = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        assert ids.tolist() == [*want, 2, *want] and n.tolist() == [len(want), 1, len(want)]
