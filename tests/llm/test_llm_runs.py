"""Periodic runs against every period and every stretch, one by one."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tidewatch.llm import periodic_runs as pr
from tidewatch.llm import queries

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            stretch = words[i:i + length]
            if length >= max(24, 3 * q) and not any(
                    all(a == b for a, b in zip(stretch, stretch[r:])) for r in range(1, q)):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def cut(text):
    return (text or "").encode().split()


def planted(doc_id, words):
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, cut(text))
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def key(row):
    return tuple((x is None, x or 0) for x in row[:1]), row[1:]


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_every_run_of_random_words(letters):
    rng = random.Random(letters)
    for _ in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            block = [rng.randrange(letters) for _ in range(rng.randint(1, 45))]
            words += block * rng.choice([1, 1, 2, 3, 5]) + block[:rng.randint(0, len(block))]
        assert pr.find_runs(np.array(words, dtype=np.int64)) == plain_runs(words)


def test_long_runs_stay_linear():
    words = np.zeros(300_000, dtype=np.int64)
    assert pr.find_runs(words) == [(0, 300_000, 1)]
    block = np.arange(70_000)
    words = np.concatenate([block, block, block, block[:5]])
    assert pr.find_runs(words) == [(0, 210_005, 70_000)]


def test_rows_against_brute_force(spark, odd_documents):
    rows = [(r.doc_id, r.text if r.doc_id != 5 else r.text[:3000]) for r in odd_documents.collect()]
    rows += [(i, " ".join(random.Random(i).choice("ab c d é".split()) for _ in range(i % 90)))
             for i in range(1000, 1300)]
    rows += [(3000 + i, "x " * i) for i in range(20, 30)]
    docs = spark.createDataFrame([(i, t, 1, "r") for i, t in rows],
                                 "doc_id long, text string, runs int, collapsed string")
    got = pr.run_digests(pr.repeat_words(docs)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(
        (expected(i, t) for i, t in rows), key=key)
    whole = pr.collapse(docs)
    assert whole.columns == ["doc_id", "text", "runs", "collapsed"] and whole.count() == len(rows)
    assert pr.run_digests(pr.repeat_words(docs.limit(0))).collect() == []


def test_registered_query(spark):
    docs = queries.table(spark, SF, "documents").select("doc_id", "text").collect()
    rows = {r.doc_id: tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(rows) == len(docs)
    for r in docs:
        if len(cut(r.text)) < 1200:
            assert rows[r.doc_id] == expected(r.doc_id, r.text)
    assert sum(r[1] for r in rows.values()) > 10
