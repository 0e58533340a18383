"""Periodic runs of words inside documents, by seeds on diagonals.

A run is a stretch of words with smallest period q that no neighbour extends and that is at least
`LEAST_PERIODS` periods and `LEAST_WORDS` words long. Words q apart are equal in it over at least
max(24 - q, 2 q) positions, so for the periods of a range one gram length is guaranteed to occur
twice, q apart: 16 words for periods up to 16, and k words for periods above k / 2 and up to k, with
k = 32, 64 and so on. A document's k-grams are named exactly by pairs of names of k / 2-grams, and
equal names list the occurrences. A gram of at least q words can't recur inside a run at a distance
below q, for the repeated part would then have a smaller period; so only neighbouring occurrences
are paired, at most one pair for each word, however often a gram occurs. A pair is a seed on the
diagonal of its lag and is extended to both sides; a table holds how far each lag is covered, and
seeds before that point are passed over.

A document is read by one task, as any function of a whole text; memory and, but for the sorts,
time follow its length. Nothing is shuffled.

Defined results: null text counts as empty; texts without a run have none and stay as they are, but
for the white space between words; rows stay one to one, repeated rows and null ids included; an
empty table stays empty. A column called `runs` or `collapsed` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Gram length for the smallest periods: the least overlap of a run with itself, one period later.
FIRST = 16
SPACES = r"[\x20\x09-\x0D]+"
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _doubled(names: np.ndarray, k: int) -> np.ndarray:
    """Names of 2k-grams from the names of k-grams."""
    left, right = names[:-k].astype(np.int64), names[k:].astype(np.int64)
    return np.unique(left * (int(names.max()) + 1) + right, return_inverse=True)[1]


def _differs(a: np.ndarray, b: np.ndarray) -> int:
    """How many values agree from the left."""
    where = np.flatnonzero(a != b)
    return int(where[0]) if len(where) else len(a)


def _extended(words: np.ndarray, lag: int, at: int, agree: int) -> tuple[int, int]:
    """The stretch of positions around `at` at which words `lag` apart are equal."""
    low, high, step = at, at + agree, 64
    while high + lag < len(words):
        end = min(high + step, len(words) - lag)
        n = _differs(words[high:end], words[high + lag:end + lag])
        high, step = high + n, 2 * step
        if high < end:
            break
    step = 64
    while low > 0:
        begin = max(0, low - step)
        n = _differs(words[begin:low][::-1], words[begin + lag:low + lag][::-1])
        low, step = low - n, 2 * step
        if low > begin:
            break
    return low, high


def _seeds(names: np.ndarray, least: int, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(lag, positions) of neighbouring occurrences of equal grams, `least` to `most` words apart."""
    order = np.argsort(names, kind="stable")
    lag = np.diff(order)
    use = (np.diff(names[order]) == 0) & (lag >= least) & (lag <= most)
    at, lag = order[:-1][use], lag[use]
    by = np.lexsort((at, lag))
    at, lag = at[by], lag[by]
    cuts = np.flatnonzero(np.diff(lag)) + 1
    for own, lags in zip(np.split(at, cuts), np.split(lag, cuts), strict=True):
        if len(own):
            yield int(lags[0]), own


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start, then period."""
    found, n, k, names = [], len(words), 1, words
    if n < LEAST_WORDS:
        return found
    while k < FIRST or 3 * k < n:
        names, k = _doubled(names, k), 2 * k
        if names.max() + 1 == len(names):  # no gram of this length or a larger one recurs
            break
        if k < FIRST:
            continue
        for lag, seeds in _seeds(names, 1 if k == FIRST else k // 2 + 1, k):
            i = 0
            while i < len(seeds):
                low, covered = _extended(words, lag, int(seeds[i]), k)
                length = covered - low + lag
                if length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                    found.append((low, length, lag))
                i = int(np.searchsorted(seeds, covered))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _read(text: bytes) -> tuple[list[tuple[int, int, int]], bytes]:
    words = text.split()
    numbers: dict[bytes, int] = {}
    coded = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64,
                        count=len(words))
    runs = find_runs(coded)
    if not runs:
        return runs, b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return runs, b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `runs` and `collapsed`, the words that no run repeats, joined by one space."""
    kept = [f for f in docs.schema.fields if f.name not in ("runs", "collapsed")]
    struct = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def read(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
            found = [_read(t or b"") for t in column.to_pylist()]
            runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in x]
                    for x, _ in found]
            whole = pa.array([x for _, x in found], pa.large_binary()).cast(pa.large_string())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(f.name)) for f in kept],
                 pa.array(runs, pa.list_(struct)), whole.cast(pa.string())],
                names=[*[f.name for f in kept], "runs", "collapsed"])

    return docs.mapInArrow(read, T.StructType([
        *kept, T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]))


def strongest(runs: Column) -> Column:
    """The run with the greatest length in periods, compared exactly; then the first by start, period."""
    none = F.lit(None).cast(RUNS.elementType)

    def better(best, run):
        more = run["length"] * best["period"] - best["length"] * run["period"]
        return F.when(best.isNull() | (more > 0), run).otherwise(best)

    # the runs come by start and period, so the first of equal ones stays
    return F.reduce(runs, none, better)


def repeat_words(docs: DataFrame) -> DataFrame:
    """The query's texts: from a word on, every tenth document repeats a stretch of its words.

    h is the CRC-32 of the id, g = h div 10; if h mod 10 is 0, word i from a = g mod n on becomes
    word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Rows without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    planted = docs.withColumn("__g", F.when(h % 10 == 0, g)).withColumn(
        "__w", F.when(F.col("__g").isNotNull(), words))
    n = F.size("__w").cast("long")
    a = F.col("__g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("__g") % 8))
    with_place = planted.withColumn("__a", F.when(n > 0, a)).withColumn("__p", F.when(n > 0, p))
    place = lambda i: F.when(i < F.col("__a"), i).otherwise(
        F.col("__a") + (i - F.col("__a")) % F.col("__p"))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                           lambda i: F.col("__w")[place(i).cast("int")])
    return with_place.withColumn("text", F.when(
        F.col("__p").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text"))).select(
        docs.columns)


def run_digests(docs: DataFrame) -> DataFrame:
    """Counts, the strongest run and digests of the runs and of the collapsed text, per row."""
    best = strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return collapse(docs.select("doc_id", "text")).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
