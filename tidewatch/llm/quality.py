"""Document quality by a factorisation machine.

Features are hashed words, statistics of the text's structure and metadata (its recorded length).
A score is the logistic of bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j, and the pair sum is
taken in linear time as half of (square of the sum - sum of the squares), per factor.

The model is fitted on at most `TRAINING_ROWS` labelled rows, whose features Spark computes; every
document is then scored in Arrow batches, in chunks of bounded size.

Defined results: null text counts as empty; an empty text is scored from its structure; a null
length counts as the text's own; rows are kept one to one with all their columns, so input columns
named `score` or `predicted` are replaced. Without labels of both kinds the score is the share of
label 1 among the training rows, 0.5 if there are none.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.pretokens import text_blocks
from tidewatch.llm.training import sigmoid, training_rows

#: Bound of the labelled sample the model is fitted on.
TRAINING_ROWS = 8_192
WORD_BITS = 14
FACTORS = 8
THRESHOLD = 0.7
CHUNK_CHARS = 1_000_000
EPOCHS, BATCH, RATE, DECAY = 8, 64, 0.02, 1e-4

STRUCTURE = ["upper", "digit", "sentence", "pause", "symbol", "other_ascii", "line", "space",
             "word_bytes", "distinct_words", "top_word", "pipe_words", "log_words", "log_chars",
             "line_words"]
GROUPS = {  # bytes counted together
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "sentence": b".!?",
    "pause": b",;:", "symbol": b"#$%&*@^~+=<>{}[]|\\_", "other_ascii": b"\"'()/-`",
    "line": b"\n", "space": b" \t"}


@dataclass
class Features:
    """Sparse word features in row order, and dense structure features."""

    offsets: np.ndarray
    index: np.ndarray
    value: np.ndarray
    dense: np.ndarray


def byte_groups() -> np.ndarray:
    table = np.full(256, len(GROUPS), dtype=np.uint8)
    for k, members in enumerate(GROUPS.values()):
        table[list(members)] = k
    return table


def featurise(texts: list[str], lengths: list[int | None]) -> Features:
    n = len(texts)
    dense = np.zeros((n, len(STRUCTURE)))
    offsets, index, value = [0], [], []
    groups = byte_groups()
    hashes: dict[str, int] = {}
    for row, (text, length) in enumerate(zip(texts, lengths, strict=True)):
        data = text.encode("utf-8")
        shares = np.bincount(groups[np.frombuffer(data, dtype=np.uint8)], minlength=len(GROUPS) + 1)
        dense[row, :len(GROUPS)] = shares[:-1] / max(1, len(data))
        words = text.lower().split()
        count: dict[str, int] = {}
        for w in words:
            count[w] = count.get(w, 0) + 1
        for w in count:
            if w not in hashes:
                hashes[w] = zlib.crc32(w.encode("utf-8")) & ((1 << WORD_BITS) - 1)
        tf = np.log1p(np.fromiter(count.values(), dtype=np.float64, count=len(count)))
        index.append(np.fromiter(map(hashes.__getitem__, count), dtype=np.int32, count=len(count)))
        value.append(tf / max(1e-9, np.sqrt((tf * tf).sum())))
        offsets.append(offsets[-1] + len(count))
        many = max(1, len(words))
        dense[row, len(GROUPS):] = [
            len(data) / many, len(count) / many, max(count.values(), default=0) / many,
            count.get("|", 0) / many, np.log1p(len(words)),
            np.log1p(len(text) if length is None else max(0, length)),
            np.log1p(len(words) / (1 + data.count(b"\n")))]
    return Features(np.array(offsets), np.concatenate([*index, np.array([], np.int32)]),
                    np.concatenate([*value, np.array([])]), dense)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factors: np.ndarray
    center: np.ndarray
    scale: np.ndarray

    def rows(self, f: Features):
        """Sparse and standardised dense features as one sparse matrix, row by row."""
        n, d = f.dense.shape
        dense = np.clip((f.dense - self.center) / self.scale, -4, 4) / np.sqrt(d)
        sizes = np.diff(f.offsets)
        offsets = np.concatenate([[0], np.cumsum(sizes + d)])
        index = np.empty(offsets[-1], dtype=np.int64)
        value = np.empty(offsets[-1])
        tail = (offsets[1:, None] - d + np.arange(d)).ravel()
        words = np.ones(offsets[-1], dtype=bool)
        words[tail] = False
        index[words], value[words] = f.index, f.value
        index[tail] = (1 << WORD_BITS) + np.tile(np.arange(d), n)
        value[tail] = dense.ravel()
        return offsets, index, value

    def margin(self, offsets, index, value) -> np.ndarray:
        """No row is empty, because the dense features are always there."""
        first = offsets[:-1]
        linear = np.add.reduceat(self.weight[index] * value, first)
        vx = self.factors[index] * value[:, None]
        total = np.add.reduceat(vx, first, axis=0)
        squares = np.add.reduceat(vx * vx, first, axis=0)
        return self.bias + linear + 0.5 * (total * total - squares).sum(axis=1)

    def score(self, f: Features) -> np.ndarray:
        return sigmoid(self.margin(*self.rows(f))) if len(f.dense) else np.array([])


def fit(f: Features, y: np.ndarray, seed: int = 7) -> Machine:
    """Adam on the logistic loss, in small batches."""
    rng = np.random.default_rng(seed)
    size = (1 << WORD_BITS) + len(STRUCTURE)
    share = float(y.mean()) if len(y) else 0.5
    spread = f.dense.std(axis=0) if len(y) else np.zeros(len(STRUCTURE))
    model = Machine(float(np.log((share + 1e-6) / (1 - share + 1e-6))), np.zeros(size),
                    np.zeros((size, FACTORS)),
                    f.dense.mean(axis=0) if len(y) else np.zeros(len(STRUCTURE)),
                    np.where(spread > 1e-12, spread, 1.0))
    if share in (0.0, 1.0) or not len(y):
        return model
    model.factors = rng.normal(0, 0.05, (size, FACTORS))
    offsets, index, value = model.rows(f)
    table = np.hstack([model.weight[:, None], model.factors])
    moment, energy = np.zeros_like(table), np.zeros_like(table)
    bias_state, step = [0.0, 0.0], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        for chosen in np.array_split(rng.permutation(len(y)), -(-len(y) // BATCH)):
            step += 1
            sizes = offsets[chosen + 1] - offsets[chosen]
            first = np.cumsum(sizes) - sizes
            at = np.repeat(offsets[chosen] - first, sizes) + np.arange(sizes.sum())
            ix, x = index[at], value[at]
            vx = table[ix, 1:] * x[:, None]
            total = np.add.reduceat(vx, first, axis=0)
            margin = model.bias + np.add.reduceat(table[ix, 0] * x, first) + 0.5 * (
                total * total - np.add.reduceat(vx * vx, first, axis=0)).sum(axis=1)
            error = np.repeat((sigmoid(margin) - y[chosen]) / len(chosen), sizes)
            seen, place = np.unique(ix, return_inverse=True)
            grad = np.empty((len(seen), 1 + FACTORS))
            grad[:, 0] = np.bincount(place, error * x)
            pull = error[:, None] * x[:, None] * (np.repeat(total, sizes, axis=0) - vx)
            for k in range(FACTORS):
                grad[:, 1 + k] = np.bincount(place, pull[:, k])
            grad += DECAY * table[seen]
            moment[seen] = 0.9 * moment[seen] + 0.1 * grad
            energy[seen] = 0.99 * energy[seen] + 0.01 * grad * grad
            table[seen] -= rate * moment[seen] / (np.sqrt(energy[seen]) + 1e-8)
            g = float((sigmoid(margin) - y[chosen]).mean())
            bias_state = [0.9 * bias_state[0] + 0.1 * g, 0.99 * bias_state[1] + 0.01 * g * g]
            model.bias -= rate * bias_state[0] / (np.sqrt(bias_state[1]) + 1e-8)
    model.weight, model.factors = table[:, 0].copy(), table[:, 1:].copy()
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Machine:
    """Fit on at most `limit` labelled rows; their features, not texts, reach the driver."""
    def features(batches):
        for batch in batches:
            for rows, texts in text_blocks([batch], "text", CHUNK_CHARS):
                f = featurise(texts, rows.column("n_chars").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f.index[a:b].tolist() for a, b in zip(f.offsets, f.offsets[1:])],
                              pa.list_(pa.int32())),
                     pa.array([f.value[a:b].tolist() for a, b in zip(f.offsets, f.offsets[1:])],
                              pa.list_(pa.float32())),
                     pa.array(f.dense.tolist(), pa.list_(pa.float64())), rows.column("label")],
                    names=["index", "value", "dense", "label"])

    rows = training_rows(docs, labels, "quality", limit).mapInArrow(
        features, "index array<int>, value array<float>, dense array<double>, label int").toArrow()
    rows = rows.sort_by([("label", "ascending")]).combine_chunks()
    index = rows.column("index").combine_chunks()
    sizes = index.value_lengths().to_numpy(zero_copy_only=False)
    f = Features(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
                 index.flatten().to_numpy().astype(np.int64),
                 rows.column("value").combine_chunks().flatten().to_numpy().astype(np.float64),
                 rows.column("dense").combine_chunks().flatten().to_numpy().reshape(
                     -1, len(STRUCTURE)))
    # one order for the batches, whichever task delivered a row first
    y = rows.column("label").to_numpy().astype(np.float64)
    order = np.lexsort((*f.dense.T, y))
    sizes = np.diff(f.offsets)[order]
    at = np.repeat(f.offsets[:-1][order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(
        sizes.sum())
    return fit(Features(np.concatenate([[0], np.cumsum(sizes)]), f.index[at], f.value[at],
                        f.dense[order]), y[order])


def score_quality(docs: DataFrame, model: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of `docs`, `score` and `predicted`."""
    kept = docs.drop("score", "predicted")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    # a fixed number of weights, whatever the size of the table
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for rows, texts in text_blocks(batches, "text", CHUNK_CHARS):
            s = shared.value.score(featurise(
                texts, rows.column(rows.schema.get_field_index("n_chars")).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=[*rows.schema.names, "score", "predicted"])

    return kept.mapInArrow(score, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, with their own columns."""
    beside = {c: f"__own_{c}" for c in ("score", "predicted") if c in docs.columns}
    scored = score_quality(docs.withColumnsRenamed(beside), fit_quality(docs, labels), threshold)
    return scored.where(F.col("predicted") == 1).select(
        *[F.col(f"`{beside.get(c, c)}`").alias(c) for c in docs.columns])
