"""Context-tree weighting against a plain recursion over a dictionary of contexts."""

import collections
import math
import zlib

import pytest
from tidewatch.llm import context_tree as ct
from tidewatch.llm import queries

SF = "/root/testdata/sf0.001"


class Plain:
    """The weighted trees of all decisions, one context at a time."""

    def __init__(self, texts, depth=ct.DEPTH):
        self.depth, self.counts, self.known = depth, collections.defaultdict(lambda: [0, 0]), {}
        self.children = collections.defaultdict(set)
        for text in texts:
            for context, node, bit in self.decisions(text):
                for d in range(depth + 1):
                    self.counts[context[:d], node][bit] += 1
                    if d:
                        self.children[context[:d - 1], node].add(context[:d])

    def decisions(self, text):
        data = bytes([255]) * self.depth + text + b"\xff"
        for i in range(self.depth, len(data)):
            context = tuple(data[i - 1 - k] for k in range(self.depth))
            node = 1
            for k in range(8):
                bit = data[i] >> (7 - k) & 1
                yield context, node, bit
                node = 2 * node + bit

    def kt(self, context, node):
        a, b = self.counts.get((context, node), (0, 0))
        return (math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1)
                - math.log(math.pi)), (b + .5) / (a + b + 1)

    def log_pw(self, context, node):
        key = context, node
        if key not in self.known:
            own = self.kt(context, node)[0]
            if len(context) == self.depth:
                self.known[key] = own
            else:
                low, high = sorted([own, self.below(context, node)])
                self.known[key] = high + math.log1p(math.exp(low - high)) - math.log(2)
        return self.known[key]

    def below(self, context, node):
        return sum(self.log_pw(c, node) for c in self.children.get((context, node), ()))

    def one(self, context, node):
        p = self.kt(context, node)[1]
        for d in range(self.depth - 1, -1, -1):
            own, kt = self.kt(context[:d], node)
            weight = 1 / (1 + math.exp(min(700, self.below(context[:d], node) - own)))
            p = weight * kt + (1 - weight) * p
        return p

    def score(self, text):
        total = 0.0
        for context, node, bit in self.decisions(text):
            one = self.one(context, node)
            total += math.log10(one if bit else 1 - one)
        return total


def fold(text):
    return (text or "").encode().lower()


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def expected(rows):
    train = [fold(t) for i, t in rows if not held(i)]
    model = Plain(train)
    counts = collections.Counter(w for t in train for w in [*t.split(), b" "])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*fold(t).split(), b" "]
        base = sum(math.log10((counts[w] + .1) / (n + .1 * (v + 1))) for w in tokens)
        out.append((i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, base,
                    model.score(fold(t))))
    return out


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got = sorted((tuple(r)[:7] for r in got), key=key)
    want = sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=1e-5, abs=1e-5)


def test_equals_the_recursion(spark, monkeypatch, odd_documents):
    rows = [(r.doc_id, (r.text or "")[:400] if r.text is not None else None)
            for r in odd_documents.collect()]
    rows += [(1000 + i, "the cat sat on the mat " * (i % 4)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    compare(ct.score(docs).collect(), expected(rows))
    # small pieces and blocks change nothing; workers read the constants, so only the driver's
    # functions are called here
    monkeypatch.setattr(ct, "CHUNK", 97)
    monkeypatch.setattr(ct, "PIECE", 50)
    texts = [fold(t) for _, t in rows]
    block = ct._Block(0, 5)
    block.add(texts, [True] * len(texts))
    merged = list(ct._merge_buckets(_as_batches(block.rows())))
    plain = Plain(texts)
    got = collections.Counter()
    for batch in merged:
        for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist(),
                              strict=True):
            if kind == ct.GRAMS:
                keys, counts = ct._unpack(data, "<i8")
                assert len(set((keys >> 24).tolist())) == 1 or len(keys) <= 50 + 256
                for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
                    got[k] += c
    want = collections.Counter()
    for text in texts:
        data = b"\xff" * 5 + text + b"\xff"
        for i in range(5, len(data)):
            want[int.from_bytes(bytes(data[i - k] for k in (1, 2, 3, 4, 5, 0)), "big")] += 1
    assert got == want and plain.counts


def _as_batches(rows):
    rows = sorted(rows)
    return [ct._table(rows, "bucket block kind data")]


def test_probabilities_sum_to_one(spark):
    """Over all symbols that may follow a context, of an unseen text too."""
    model = Plain([b"abcabcabd", b"xyz"])
    for context in (b"abcab", b"zzzzz"):
        context = tuple(context[::-1])
        total = 0.0
        for symbol in range(256):
            p, node = 1.0, 1
            for k in range(8):
                bit = symbol >> (7 - k) & 1
                one = model.one(context, node)
                p *= one if bit else 1 - one
                node = 2 * node + bit
            total += p
        assert total == pytest.approx(1)


def test_kt_of_large_counts():
    import numpy as np
    for a, b in ((0, 0), (3, 5), (16383, 16384), (10**6, 3), (10**9, 10**8)):
        want = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
        assert ct.kt_log(np.array([a]), np.array([b]))[0] == pytest.approx(want, rel=1e-9, abs=1e-6)


def test_empty_and_untrained(spark):
    schema = "doc_id long, text string, block int, train string"
    assert ct.score(spark.createDataFrame([], schema)).collect() == []
    rows = [(i, "aB", 1, "x") for i in range(200) if held(i)]
    got = ct.score(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 2, 0, 0)
        assert r.base_score == pytest.approx(0) and r.score == pytest.approx(24 * math.log10(.5))
        assert r.bits_per_byte == pytest.approx(8)


def test_registered_query_beats_chance(spark):
    rows = queries.QUERIES["op11_context_tree"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    compare([r for r in rows][:0], [])
    held_rows = [r for r in rows if r.held_out]
    size = sum(len(fold(docs[r.doc_id])) + 1 for r in held_rows)
    bits = -sum(r.score for r in held_rows) * math.log2(10) / size
    counts = collections.Counter(b for i, t in docs.items() if not held(i) for b in fold(t) + b"\xff")
    total = sum(counts.values())
    zero_order = -sum(math.log2((counts[b] + .5) / (total + 128))
                      for r in held_rows for b in fold(docs[r.doc_id]) + b"\xff") / size
    assert bits < 0.75 * zero_order
