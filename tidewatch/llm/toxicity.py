"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters and digit substitutions to one letter and everything
that is no letter to a space. The lexicon holds whole words and word beginnings with a log-odds
weight each, learned from labelled rows; a word counts with its heaviest entry only. Exception
phrases - a matched word with the word before or after it - that occur in clean training texts alone
take the match back. The weights of a text are normalised by its length, and a logistic fit turns
them into a score.

Learning reads at most `TRAINING_ROWS` labelled rows; counts are Spark aggregates, only the bounded
lexicon, phrases and three numbers per training row reach the driver. Every document is scored.

Defined results: null text counts as empty; an empty text gets the score of no match; rows are kept
one to one with all their columns, so input columns named `score` or `predicted` are replaced;
without toxic training rows the lexicon is empty and all scores are equal.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.pretokens import text_blocks
from tidewatch.llm.training import fit_logistic, sigmoid, training_rows
from tidewatch.session import settle

#: Bounds of the labelled sample, the candidates counted in clean texts, the lexicon, the phrases.
TRAINING_ROWS, CANDIDATES, LEXICON, PHRASES = 16_384, 50_000, 4_000, 20_000
SHORTEST, LONGEST = 4, 9
LEAST_TEXTS, LEAST_WEIGHT, LEAST_EVIDENCE = 3, 1.5, 4.0
THRESHOLD = 0.3
CHUNK_CHARS = 1_000_000

# Digits and signs that stand for letters, and letters that look like Latin ones.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a",
          "$": "s"}
HOMOGLYPHS = {  # Cyrillic, Greek and others
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "i", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ⅼ": "i"}


class _Folding(dict):
    """Folds a code point when it is first met."""

    def __missing__(self, point: int) -> str:
        char = chr(point)
        folded = DIGITS.get(char)
        if folded is None:
            low = HOMOGLYPHS.get(char.lower(), char.lower())
            # compatibility forms (full-width, mathematical) as their plain letters
            plain = unicodedata.normalize("NFKC", low).lower() if point > 0x2000 else low
            folded = HOMOGLYPHS.get(plain, plain)
            if unicodedata.category(char) in ("Cf", "Mn"):
                folded = ""
            elif not folded.isalpha():
                folded = " "
        # one-letter look-alikes of each other
        folded = "i" if folded == "l" else folded
        self[point] = folded
        return folded


@cache
def folding() -> _Folding:
    return _Folding()


def fold(text: str) -> str:
    return text.translate(folding())


def entries_of(word: str) -> list[str]:
    """The whole word and its beginnings, as patterns over ` text `."""
    return [f" {word} ", *(f" {word[:n]}" for n in range(SHORTEST, min(LONGEST, len(word)) + 1))]


def texts_of(batches) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    return text_blocks(batches, "text", CHUNK_CHARS)


def entry_counts(rows: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(entry, n): the number of texts that hold an entry; of the wanted ones, or of all."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None

    def count(batches):
        for _, texts in texts_of(batches):
            seen: Counter[str] = Counter()
            for text in texts:
                own = {e for w in set(fold(text).split()) for e in entries_of(w)}
                seen.update(own if shared is None else own & shared.value)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())],
                    names=["entry", "n"])

    return rows.mapInArrow(count, "entry string, n long").groupBy("entry").agg(
        F.sum("n").alias("n"))


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    slope: np.ndarray = field(default_factory=lambda: np.zeros(3))
    bias: float = -2.0

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            out.add_word(entry, (len(entry), weight))
        if self.weights:
            out.make_automaton()
        return out

    def matches(self, automaton, text: str) -> tuple[str, dict[int, float]]:
        """The folded text between spaces, and the weight of the best entry by word start."""
        folded = f" {' '.join(fold(text).split())} "
        best: dict[int, float] = {}
        if self.weights:
            for end, (size, weight) in automaton.iter(folded):
                at = end - size + 1
                if weight > best.get(at, 0.0):
                    best[at] = weight
        return folded, best

    def evidence(self, automaton, text: str) -> list[float]:
        """Sum of the weights by length, heaviest weight, sum by the text's words."""
        folded, best = self.matches(automaton, text)
        if self.exceptions:
            best = {at: w for at, w in best.items()
                    if self.exceptions.isdisjoint(phrases_at(folded, at))}
        words = folded.count(" ") - 1
        total = sum(best.values())
        return [total / np.log2(4 + words), max(best.values(), default=0.0),
                100 * total / (20 + words)]

    def features(self, texts: list[str]) -> np.ndarray:
        automaton = self.automaton()
        return np.array([self.evidence(automaton, t) for t in texts]).reshape(-1, 3)


def phrases_at(folded: str, at: int) -> list[str]:
    """The word that starts after the space at `at`, with the word before and the word after."""
    end = folded.index(" ", at + 1)
    out = []
    if at:
        out.append(folded[folded.rindex(" ", 0, at) + 1:end])
    if end + 1 < len(folded):
        out.append(folded[at + 1:folded.index(" ", end + 1)])
    return out


def phrase_counts(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(phrase, clean, toxic): texts of either label that hold a phrase around a match."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def count(batches):
        automaton = shared.value.automaton()
        for batch, texts in texts_of(batches):
            seen: dict[str, list[int]] = {}
            for text, label in zip(texts, batch.column("label").to_pylist(), strict=True):
                folded, best = shared.value.matches(automaton, text)
                for phrase in {p for at in best for p in phrases_at(folded, at)}:
                    seen.setdefault(phrase, [0, 0])[label] += 1
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen)), pa.array([v[0] for v in seen.values()], pa.int64()),
                     pa.array([v[1] for v in seen.values()], pa.int64())],
                    names=["phrase", "clean", "toxic"])

    return rows.mapInArrow(count, "phrase string, clean long, toxic long").groupBy("phrase").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Lexicon:
    rows = settle(training_rows(docs, labels, "toxic", limit))
    sizes = dict(rows.groupBy("label").count().collect())
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return Lexicon({})
    toxic = entry_counts(rows.where("label = 1"), None).where(F.col("n") >= LEAST_TEXTS)
    found = dict(toxic.orderBy(F.desc("n"), "entry").limit(CANDIDATES).collect())
    clean = dict(entry_counts(rows.where("label = 0"), set(found)).collect())
    ranked = []
    for entry, n in found.items():
        p, q = (n + 0.5) / (n_toxic + 1), (clean.get(entry, 0) + 0.5) / (n_clean + 1)
        both = (n + clean.get(entry, 0)) / (n_clean + n_toxic)
        z = (n / n_toxic - clean.get(entry, 0) / n_clean) / np.sqrt(
            max(1e-12, both * (1 - both)) * (1 / n_toxic + 1 / n_clean))
        weight = float(np.log(p / q))
        if weight >= LEAST_WEIGHT and z >= LEAST_EVIDENCE:
            ranked.append((-z, entry, weight))
    lexicon = Lexicon({e: w for _, e, w in sorted(ranked)[:LEXICON]})
    phrases = phrase_counts(rows, lexicon).where(
        (F.col("toxic") == 0) & (F.col("clean") >= LEAST_TEXTS))
    lexicon.exceptions = {r["phrase"] for r in phrases.orderBy(
        F.desc("clean"), "phrase").limit(PHRASES).collect()}
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def evidence(batches):
        for batch, texts in texts_of(batches):
            x = shared.value.features(texts)
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T), batch.column("label")],
                                             names=["a", "b", "c", "label"])

    # four numbers for each of at most `limit` rows
    known = np.array(rows.mapInArrow(evidence, "a double, b double, c double, label int").collect())
    known = known[np.lexsort(known.T)]
    lexicon.slope, lexicon.bias = fit_logistic(known[:, :3], known[:, 3])
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of `docs`, `score` and `predicted`."""
    kept = docs.drop("score", "predicted")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    # at most `LEXICON` entries and `PHRASES` phrases
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def score(batches):
        for rows, texts in texts_of(batches):
            s = sigmoid(shared.value.features(texts) @ shared.value.slope + shared.value.bias)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=[*rows.schema.names, "score", "predicted"])

    return kept.mapInArrow(score, schema)
