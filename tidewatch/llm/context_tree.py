"""Language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes with A-Z in lower case and one end symbol, the byte 0xFF, which UTF-8
never uses and which also fills the contexts before the first byte. A byte is eight binary
decisions. Every decision, given the bits before it, has a tree of contexts: none, the last byte,
the last two, up to the last `DEPTH`. A node counts zeros and ones and holds the
Krichevsky-Trofimov estimate of its own bits; its weighted probability is the mean of that estimate
and of the product of its children, so all depths are mixed by how well they coded the training
texts. A score is the code length of a text under the mixture, as a log10 probability.

All counts of the trees follow from the counts of (DEPTH + 1)-byte grams, so those are what moves.
Texts are cut into blocks; a block sorts its grams and sends each distinct one, with its count,
to a bucket by the three bytes before the coded one. Equal grams of all blocks meet there. A
bucket computes the depths of three and more bytes; of the shallower ones it sends sums per context
of two bytes, which ordinary aggregations weigh up to the root. With the mixture of the shallow
depths back in the bucket, every gram has its log probability, which returns to the blocks that
asked for it, and the blocks add up their texts. The words of the unigram base travel the same way.
A gram or word that fills a third of all rows is one entry per block; one context of three bytes
holds at most 2^24 grams, which bounds what a task must hold at once.

Defined results: null text counts as empty; an empty text consists of its end; rows stay one to
one, repeated rows and null ids included; texts with a null id are learned from; without training
texts every bit has probability 1/2 and a base token log10(0.1 / 0.1); an empty table stays empty;
further columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import scratch_path, settle

DEPTH = 5
END = 0xFF
FOLDS, HELD_OUT = 10, 0
#: Rows of a block: their grams are told apart by a number below 2^16 behind a gram of 48 bits.
BLOCK_ROWS_LOG2 = 13
#: Bytes whose grams are sorted at once.
CHUNK = 2_000_000
#: Grams of one model row, cut between contexts of three bytes.
PIECE = 1_000_000
GRAMS, WORDS = 0, 1
MODEL, SHALLOW = -2, -1
TEXT = 2
COUNTED = "bucket int, block long, kind int, data binary"
_U8 = np.uint64(8)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


# --- grams ------------------------------------------------------------------------------------
def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts between end symbols, and the number of the text at each byte.

    Bytes that only pad the contexts of a text have the number -1.
    """
    pad = bytes([END]) * DEPTH
    joined = b"".join(part for t in texts for part in (pad, t, pad[:1])) if texts else b""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes + DEPTH + 1)
    begin = np.concatenate([[0], np.cumsum(sizes + DEPTH + 1)])[:-1]
    for k in range(DEPTH):
        owner[begin + k] = -1
    return np.frombuffer(joined, dtype=np.uint8), owner


def _grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(gram, number of its text) of every coded byte: context bytes, nearest first, then the byte."""
    codes, owner = _layout(texts)
    for at in range(DEPTH, len(codes), CHUNK):
        end = min(at + CHUNK, len(codes))
        gram = np.zeros(end - at, dtype=np.uint64)
        for back in (*range(1, DEPTH + 1), 0):
            gram = (gram << _U8) | codes[at - back:end - back]
        own = owner[at:end]
        coded = own >= 0
        yield gram[coded], own[coded]


def _chunks(texts: list[bytes]) -> Iterator[list[int]]:
    """Numbers of texts that are taken together: about CHUNK bytes, a longer text alone."""
    own, size = [], 0
    for i, t in enumerate(texts):
        if own and size + len(t) > CHUNK:
            yield own
            own, size = [], 0
        own.append(i)
        size += len(t) + DEPTH + 1
    if own:
        yield own


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where a run of equal values starts."""
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


class _Tally:
    """Distinct grams with their counts; memory follows the distinct ones."""

    def __init__(self):
        self.keys, self.counts, self.waiting = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.waiting += len(keys)
        if self.waiting > CHUNK and self.waiting > 2 * len(self.keys[0]):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate(self.counts)[order]
        starts = _runs(keys)
        if len(starts):
            keys, counts = keys[starts], np.add.reduceat(counts, starts)
        self.keys, self.counts, self.waiting = [keys], [counts], len(keys)
        return keys, counts


def _pack(keys: np.ndarray, values: np.ndarray) -> bytes:
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.compress(len(keys).to_bytes(8, "little") + steps.tobytes() + values.tobytes(), 1)


def _unpack(data: bytes, kind: str) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:8], "little")
    steps = np.frombuffer(raw, dtype="<u8", count=n, offset=8)
    return np.cumsum(steps, dtype=np.uint64), np.frombuffer(raw, dtype=kind, offset=8 + 8 * n)


def _pack_words(words: list[bytes], counts: np.ndarray) -> bytes:
    return zstandard.compress(counts.astype("<i8").tobytes() + b" ".join(words), 1)


def _unpack_words(data: bytes, n: int) -> tuple[list[bytes], np.ndarray]:
    raw = zstandard.decompress(data)
    return raw[8 * n:].split(), np.frombuffer(raw, dtype="<i8", count=n)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the three nearest context bytes, mixed so that neighbours part."""
    near = (keys >> np.uint64(24)).astype(np.uint64)
    return ((near * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)


class _Block:
    """What one block knows: its distinct grams and words with their counts in training texts."""

    def __init__(self, block: int, buckets: int):
        self.block, self.buckets = block, buckets
        self.grams, self.words, self.seen = _Tally(), Counter(), set()

    def add(self, texts: list[bytes], train: list[bool]) -> None:
        for learned in (True, False):
            own = [t for t, x in zip(texts, train, strict=True) if x == learned]
            for chunk in _chunks(own):
                part = [own[i] for i in chunk]
                for gram, _ in _grams(part):
                    gram.sort()
                    starts = _runs(gram)
                    counts = np.diff(starts, append=len(gram))
                    self.grams.add(gram[starts], counts * learned)
                for t in part:
                    if learned:
                        self.words.update(t.split())
                    else:
                        self.seen.update(t.split())

    def rows(self) -> Iterator[tuple[int, int, int, bytes]]:
        keys, counts = self.grams.merge()
        bucket = _bucket(keys, self.buckets)
        order = np.argsort(bucket, kind="stable")
        for own in np.split(order, _runs(bucket[order])[1:]):
            if len(own):
                yield (int(bucket[own[0]]), self.block, GRAMS,
                       _pack(keys[own], counts[own].astype("<i8")))
        lists: dict[int, list[bytes]] = {}
        for w in self.words.keys() | self.seen:
            lists.setdefault(zlib.crc32(w) % self.buckets, []).append(w)
        for b, own in lists.items():
            n = np.fromiter((self.words[w] for w in own), dtype=np.int64, count=len(own))
            yield b, self.block, WORDS, len(own).to_bytes(8, "little") + _pack_words(own, n)


def _table(rows, names: str) -> pa.RecordBatch:
    """Rows of (int, long, int, binary) as a batch."""
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names.split())


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    column = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
    return [t.lower() for t in column.to_pylist()]


def _count_blocks(batches, buckets: int):
    block = None
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("block")).to_numpy()
        train = batch.column(batch.schema.get_field_index("train")).to_pylist()
        texts = _texts(batch)
        cuts = [*_runs(ids).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if block is not None and block.block != int(ids[a]):
                yield _table(block.rows(), "bucket block kind data")
                block = None
            block = block or _Block(int(ids[a]), buckets)
            block.add(texts[a:b], train[a:b])
    if block is not None:
        yield _table(block.rows(), "bucket block kind data")


def _by_key(batches, key: str):
    """Rows of a sorted stream, one after another, as (key, row) with the columns of the batch."""
    for batch in batches:
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for i, k in enumerate(columns[key].to_pylist()):
            yield k, {n: c[i] for n, c in columns.items()}


def _pieces(keys: np.ndarray, counts: np.ndarray):
    """Cuts between contexts of three bytes, after PIECE grams each."""
    starts = _runs(keys >> np.uint64(24))
    begin = 0
    while begin < len(keys):
        after = np.searchsorted(starts, begin + PIECE)
        end = int(starts[after]) if after < len(starts) else len(keys)
        yield keys[begin:end], counts[begin:end]
        begin = end


def _merge_buckets(batches):
    """The distinct grams and words of every bucket, with their counts over all blocks."""
    def emit(bucket, grams, words):
        rows = []
        for keys, counts in _pieces(*grams.merge()):
            rows.append((bucket, GRAMS, _pack(keys, counts.astype("<i8")), 0, 0))
        listed = list(words)
        for at in range(0, len(listed), PIECE):
            own = listed[at:at + PIECE]
            n = np.fromiter((words[w] for w in own), dtype=np.int64, count=len(own))
            rows.append((bucket, WORDS, len(own).to_bytes(8, "little") + _pack_words(own, n),
                         int(n.sum()), int((n > 0).sum())))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        types = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["bucket", "kind", "data", "tokens", "words"])

    current, grams, words = None, _Tally(), Counter()
    for bucket, row in _by_key(batches, "bucket"):
        if current is not None and bucket != current:
            yield emit(current, grams, words)
            grams, words = _Tally(), Counter()
        current = bucket
        data = row["data"].as_py()
        if row["kind"].as_py() == GRAMS:
            grams.add(*_unpack(data, "<i8"))
        else:
            n = int.from_bytes(data[:8], "little")
            for w, c in zip(*_unpack_words(data[8:], n), strict=True):
                words[w] += int(c)
    if current is not None:
        yield emit(current, grams, words)


# --- trees ------------------------------------------------------------------------------------
_SMALL = 1 << 14
_LOG_HALVES = np.concatenate([[0.5 * math.log(math.pi)], 0.5 * math.log(math.pi)
                              + np.cumsum(np.log(np.arange(_SMALL) + 0.5))])
_LOG_WHOLES = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, _SMALL + 1)))])


def _stirling(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def _log_gamma(n: np.ndarray, table: np.ndarray, shift: float) -> np.ndarray:
    """log Gamma(n + shift): a table for small n, Stirling's series beyond."""
    out = table[np.minimum(n, _SMALL)]
    large = n > _SMALL
    if large.any():
        out[large] = _stirling(n[large] + shift)
    return out


def kt_log(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov estimate of n0 zeros and n1 ones."""
    return (_log_gamma(n0, _LOG_HALVES, 0.5) + _log_gamma(n1, _LOG_HALVES, 0.5)
            - _log_gamma(n0 + n1, _LOG_WHOLES, 1.0) - math.log(math.pi))


def weigh(n0: np.ndarray, n1: np.ndarray, children: np.ndarray):
    """(log of the weighted probability, weight of the node's own estimate, its probability of 1)."""
    own = kt_log(n0, n1)
    return (np.logaddexp(own, children) - math.log(2),
            1 / (1 + np.exp(np.clip(children - own, -700, 700))), (n1 + 0.5) / (n0 + n1 + 1))


class _Nodes:
    """The nodes of one decision at one depth, in the order of (context, bits so far)."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, bit: int):
        symbol = grams & np.uint64(255)
        node = np.uint64(1 << bit) | (symbol >> np.uint64(8 - bit))
        keys = (grams & ~np.uint64(255)) | node
        self.first = starts = _runs(keys)
        self.of_gram = np.cumsum(np.bincount(starts, minlength=len(keys))) - 1
        self.ones = ((symbol >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)
        self.keys = keys[starts]
        self.n1 = np.add.reduceat(counts * self.ones, starts)
        self.n0 = np.add.reduceat(counts, starts) - self.n1

    def parents(self, above: np.ndarray) -> np.ndarray:
        """Place of each node's parent, the context one byte shorter, among the keys above."""
        wanted = ((self.keys >> np.uint64(16)) << _U8) | (self.keys & np.uint64(255))
        return np.searchsorted(above, wanted)


class _Trees:
    """Trees of the contexts of three and more bytes in one piece of the model."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.levels = [(keys, counts)]  # DEPTH first
        for _ in range(DEPTH - 3):
            tally = _Tally()
            at, n = self.levels[-1]
            tally.add(((at >> np.uint64(16)) << _U8) | (at & np.uint64(255)), n)
            self.levels.append(tally.merge())

    def decision(self, bit: int):
        """(nodes at DEPTH, their probability of 1 from depth three down, nodes at depth three,
        log of the weighted probability of these)."""
        deep = below = _Nodes(*self.levels[0], bit)
        log_pw = kt_log(deep.n0, deep.n1)
        chain = []
        for level in self.levels[1:]:
            nodes = _Nodes(*level, bit)
            up = below.parents(nodes.keys)
            log_pw, weight, kt = weigh(nodes.n0, nodes.n1, np.bincount(
                up, weights=log_pw, minlength=len(nodes.keys)))
            chain.append((up, weight, kt))
            below = nodes
        p, at = (deep.n1 + 0.5) / (deep.n0 + deep.n1 + 1), None
        for up, weight, kt in chain:
            at = up if at is None else up[at]
            p = weight[at] * kt[at] + (1 - weight[at]) * p
        return deep, p, below, log_pw


def _summaries(batches):
    """(bucket, context, node, n0, n1, children): what contexts of two bytes get from a piece."""
    names = ["bucket", "context", "node", "n0", "n1", "children"]
    for bucket, row in _by_key(batches, "bucket"):
        trees = _Trees(*_unpack(row["data"].as_py(), "<i8"))
        for bit in range(8):
            _, _, nodes, log_pw = trees.decision(bit)
            above = ((nodes.keys >> np.uint64(16)) << _U8) | (nodes.keys & np.uint64(255))
            tally, place = np.unique(above, return_inverse=True)
            total = lambda x: np.bincount(place, weights=x, minlength=len(tally))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(tally), bucket, dtype=np.int32)),
                pa.array((tally >> _U8).astype(np.int32)),
                pa.array((tally & np.uint64(255)).astype(np.int32)),
                pa.array(total(nodes.n0).astype(np.int64)),
                pa.array(total(nodes.n1).astype(np.int64)), pa.array(total(log_pw))], names=names)


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("log_pw", "weight", "kt")]))
def _weighed(n0: pd.Series, n1: pd.Series, children: pd.Series) -> pd.DataFrame:
    log_pw, weight, kt = weigh(n0.to_numpy(), n1.to_numpy(), children.to_numpy())
    return pd.DataFrame({"log_pw": log_pw, "weight": weight, "kt": kt})


def _level(sums: DataFrame, key: list) -> DataFrame:
    grouped = sums.groupBy(*key, "node").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("children").alias("children"))
    return settle(grouped.select("*", _weighed("n0", "n1", "children").alias("w")).select(
        *grouped.columns[:-1], "w.*"))


def shallow_mixture(sums: DataFrame) -> DataFrame:
    """(context, data): per context of two bytes, its nodes and how they go on from deeper ones.

    The probability of a 1 is `a + b * p` with p that of the contexts of three and more bytes. Each
    level is an aggregation whose rows have at most 256 children: no more than 65,536, 256 and one
    context of 255 nodes.
    """
    shorter = lambda level: level.select(F.shiftright("context", 8).alias("context"), "node", "n0",
                                         "n1", F.col("log_pw").alias("children"))
    two = _level(sums.select("context", "node", "n0", "n1", "children"), ["context"])
    one = _level(shorter(two), ["context"])
    root = _level(shorter(one), [])
    named = lambda df, k: df.select(*[c for c in df.columns if c in ("context", "node")],
                                    F.col("weight").alias(f"w{k}"), F.col("kt").alias(f"kt{k}"))
    # the root has 255 rows, contexts of one byte 255 times 256 at most
    joined = (named(two, 2).withColumn("last", F.shiftright("context", 8))
              .join(F.broadcast(named(one, 1).withColumnRenamed("context", "last")), ["last", "node"])
              .join(F.broadcast(named(root, 0)), "node"))
    rest0, rest1 = 1 - F.col("w0"), 1 - F.col("w1")
    a = (F.col("w0") * F.col("kt0") + rest0 * (F.col("w1") * F.col("kt1")
                                               + rest1 * F.col("w2") * F.col("kt2")))
    mixed = joined.select("context", F.struct(
        "node", a.alias("a"), (rest0 * rest1 * (1 - F.col("w2"))).alias("b")).alias("x"))
    return mixed.groupBy("context").agg(F.array_sort(F.collect_list("x")).alias("x"))


def _log_probabilities(keys, counts, shallow: dict[int, np.ndarray]) -> np.ndarray:
    """log10 probability of the coded byte of every gram."""
    trees = _Trees(keys, counts)
    total = np.zeros(len(keys))
    context = (keys >> np.uint64(32)).astype(np.int64)  # of two bytes
    listed = np.unique(context)
    table = np.stack([shallow[c] for c in listed.tolist()])  # contexts x nodes x (a, b)
    row = np.searchsorted(listed, context)
    for bit in range(8):
        deep, p, _, _ = trees.decision(bit)
        node = (deep.keys & np.uint64(255)).astype(np.int64)
        mixed = table[row[deep.first], node]
        one = mixed[:, 0] + mixed[:, 1] * p
        one = one[deep.of_gram]
        total += np.log10(np.where(deep.ones == 1, one, 1 - one))
    return total


def _answers(batches):
    """What the blocks asked for: the log probability of grams, the training count of words."""
    current, shallow, keys, values, words = None, {}, [], [], {}
    out: list[tuple] = []
    size = 0
    for bucket, row in _by_key(batches, "bucket"):
        if bucket != current:
            current, shallow, keys, values, words = bucket, {}, [], [], {}
            table = None
        order, kind = row["order"].as_py(), row["kind"].as_py()
        if order == SHALLOW:
            context = np.zeros((256, 2))
            listed = row["x"].values
            context[listed.field("node").to_numpy(), 0] = listed.field("a").to_numpy()
            context[listed.field("node").to_numpy(), 1] = listed.field("b").to_numpy()
            shallow[row["context"].as_py()] = context
            continue
        data = row["data"].as_py()
        if kind == WORDS:
            n = int.from_bytes(data[:8], "little")
            listed, counts = _unpack_words(data[8:], n)
            if order == MODEL:
                words.update(zip(listed, counts.tolist(), strict=True))
                continue
            found = np.fromiter((words[w] for w in listed), dtype=np.int64, count=n)
            out.append((bucket, row["block"].as_py(), WORDS,
                        data[:8] + _pack_words(listed, found)))
        else:
            own, counts = _unpack(data, "<i8")
            if order == MODEL:
                keys.append(own)
                values.append(_log_probabilities(own, counts, shallow).astype("<f4"))
                continue
            if table is None:  # pieces of a bucket are cut from sorted grams, in any row order
                joined, logs = np.concatenate(keys), np.concatenate(values)
                by = np.argsort(joined)
                table = joined[by], logs[by]
            place = np.searchsorted(table[0], own)
            out.append((bucket, row["block"].as_py(), GRAMS, _pack(own, table[1][place])))
        size += len(out[-1][3])
        if size > CHUNK:
            yield _table(out, "bucket block kind data")
            out, size = [], 0
    if out:
        yield _table(out, "bucket block kind data")


# --- texts ------------------------------------------------------------------------------------
def score_texts(texts: list[bytes], keys: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Sums of the texts' gram values; `keys` are sorted."""
    out = np.zeros(len(texts))
    for chunk in _chunks(texts):
        for gram, own in _grams([texts[i] for i in chunk]):
            packed = (gram << np.uint64(16)) | own.astype(np.uint64)
            packed.sort()
            starts = _runs(packed)
            pair = packed[starts]
            gram = pair >> np.uint64(16)
            first = _runs(gram)
            place = np.searchsorted(keys, gram[first])
            if len(first) and (place.max() >= len(keys) or (keys[place] != gram[first]).any()):
                raise RuntimeError("a block lacks grams of its texts")
            value = np.repeat(logs[place].astype(np.float64), np.diff(first, append=len(gram)))
            value *= np.diff(starts, append=len(packed))
            out[chunk] += np.bincount((pair & np.uint64(65535)).astype(np.int64), weights=value,
                                      minlength=len(chunk))
    return out


def _score_blocks(batches, types: list[pa.DataType]):
    current, keys, logs, words, table = None, [], [], {}, None
    for batch in batches:
        column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023
        blocks, kinds = column("block").to_numpy(), column("kind").to_numpy()
        cuts = [*_runs(blocks * 4 + kinds).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if blocks[a] != current:
                current, keys, logs, words, table = blocks[a], [], [], {}, None
            if kinds[a] == TEXT:
                if table is None:
                    joined = np.concatenate(keys)
                    by = np.argsort(joined, kind="stable")
                    table = joined[by], np.concatenate(logs)[by]
                own = batch.slice(a, b - a)
                texts = _texts(own)
                score = score_texts(texts, *table)
                n_tokens, n_known, base = [], [], []
                for t in texts:
                    listed = t.split()
                    found = np.fromiter((words[w] for w in listed), dtype=np.int64,
                                        count=len(listed))
                    n_tokens.append(len(found) + 1)
                    n_known.append(int((found > 0).sum()))
                    base.append(float(np.log10(found + 0.1).sum()))
                train = own.column(own.schema.get_field_index("train"))
                yield pa.RecordBatch.from_arrays(
                    [own.column(own.schema.get_field_index("doc_id")).cast(types[0]), train,
                     pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                     pa.array(list(map(len, texts)), pa.int64()), pa.array(base, pa.float64()),
                     pa.array(score)],
                    names=["doc_id", "train", "n_tokens", "n_known", "n_bytes", "base", "score"])
                continue
            for kind, data in zip(kinds[a:b], column("data")[a:b].to_pylist(), strict=True):
                if kind == GRAMS:
                    own_keys, own_logs = _unpack(data, "<f4")
                    keys.append(own_keys)
                    logs.append(own_logs)
                else:
                    n = int.from_bytes(data[:8], "little")
                    listed, counts = _unpack_words(data[8:], n)
                    words.update(zip(listed, counts.tolist(), strict=True))


def score(docs: DataFrame, hold_out: Column | None = None, buckets: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    `hold_out` marks the rows that are only scored; default: `held_out()`. The texts are written
    once to the shared scratch folder, with their blocks, and read from there by both passes, so a
    task that runs again meets the same blocks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    hold = held_out() if hold_out is None else F.coalesce(hold_out, F.lit(False))
    staged = written(docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), (~hold).alias("train"),
        F.shiftright(F.monotonically_increasing_id(), BLOCK_ROWS_LOG2).alias("block")), "ctw-texts")
    counted = written(staged.select("block", "train", "text").mapInArrow(
        lambda batches: _count_blocks(batches, n), COUNTED), "ctw-counts")
    model = written(counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _merge_buckets, "bucket int, kind int, data binary, tokens long, words long"), "ctw-model")

    sums = settle(model.where(F.col("kind") == GRAMS).mapInArrow(
        _summaries, "bucket int, context int, node int, n0 long, n1 long, children double"))
    shallow = shallow_mixture(sums).join(sums.select("bucket", "context").distinct(), "context")
    none = lambda kind: F.lit(None).cast(kind)
    x = "array<struct<node:int,a:double,b:double>>"
    asked = (model.select("bucket", none("long").alias("block"), F.lit(MODEL).alias("order"), "kind",
                          "data", none("int").alias("context"), none(x).alias("x"))
             .unionByName(shallow.select(
                 "bucket", none("long").alias("block"), F.lit(SHALLOW).alias("order"),
                 F.lit(GRAMS).alias("kind"), none("binary").alias("data"), "context", "x"))
             .unionByName(counted.select(
                 "bucket", "block", F.lit(0).alias("order"), "kind", "data",
                 none("int").alias("context"), none(x).alias("x"))))
    # the mixture of the shallow depths comes before the model, and both before the questions
    asked = asked.withColumn("turn", F.expr(
        f"CASE order WHEN {SHALLOW} THEN 0 WHEN {MODEL} THEN 1 ELSE 2 END"))
    answers = asked.repartition("bucket").sortWithinPartitions("bucket", "turn").mapInArrow(
        _answers, COUNTED)

    doc_type = staged.schema["doc_id"].dataType.simpleString()
    types = list(to_arrow_schema(staged.select("doc_id").schema).types)
    both = answers.select("block", "kind", "data", none(doc_type).alias("doc_id"),
                          none("string").alias("text"), none("boolean").alias("train")).unionByName(
        staged.select("block", F.lit(TEXT).alias("kind"), none("binary").alias("data"), "doc_id",
                      "text", "train"))
    scored = both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(
        lambda batches: _score_blocks(batches, types),
        f"doc_id {doc_type}, train boolean, n_tokens long, n_known long, n_bytes long, base double,"
        " score double")
    # both are one row
    totals = model.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
                       F.coalesce(F.sum("words"), F.lit(0)).alias("words")).crossJoin(
        staged.agg(F.count_if("train").alias("ends")))
    ends = F.col("ends")
    known_end = (ends > 0).cast("long")
    all_tokens = F.col("tokens") + ends
    vocabulary = F.col("words") + known_end
    return scored.crossJoin(F.broadcast(totals)).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("n_known") + known_end).alias("n_known"), all_tokens.alias("train_tokens"),
        (F.col("base") + F.log10(ends + 0.1)
         - F.col("n_tokens") * F.log10(all_tokens + 0.1 * (vocabulary + 1))).alias("base_score"),
        "score", (-F.col("score") * F.lit(math.log2(10)) / (F.col("n_bytes") + 1)).alias(
            "bits_per_byte"))
