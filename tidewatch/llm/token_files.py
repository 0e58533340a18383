"""Token ids as ORC files: written in document order, read back by stripe or by document id.

Ids are an integer column, so ORC stores them with its integer run-length encoding. Row indexes and
a Bloom filter on the document id let a reader skip stripes and row groups that can't hold a wanted
document; stripes are read in parallel. Each row also holds how many ids its file has before it, so
the place of a document in the whole stream is that plus the sum of the files before.

Defined results: null text counts as empty and has only the end id; null document ids come first;
repeated rows are kept, equal document ids ordered by text hash; an empty table gives no rows; extra
columns of the input are not stored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.llm.pretokens import split_block, text_blocks

BLOCK_CHARS = 4_000_000
STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1_000
#: Words whose ids a worker remembers; beyond it they are encoded again, with the same ids.
REMEMBERED = 400_000
SCHEMA = "doc_id long, file_start long, n_tokens long, ids array<int>"


def byte_letters() -> np.ndarray:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for
    themselves, the others for the letters from 256 on, in order."""
    letters = np.arange(256, dtype="<u2")
    shown = np.zeros(256, dtype=bool)
    for a, b in ((0x21, 0x7F), (0xA1, 0xAD), (0xAE, 0x100)):
        shown[a:b] = True
    letters[~shown] = 256 + np.arange((~shown).sum())
    return letters


class WordEncoder:
    """Ids of pre-tokens by the library's BPE model.

    A text that holds one of the vocabulary's added tokens goes to the library whole, which cuts
    these tokens out before anything else.

    Recent words are remembered in two generations: a word that is met again moves to the younger
    one, and the older one is forgotten when the younger is full.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.model = self.library.model
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def has_added(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word, four bytes an id."""
        young, old, tokenize = self.young, self.old, self.model.tokenize
        missing = []
        for w in words:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    missing.append(w)
        # one letter per byte, for all missing words at once
        data = [w.encode("utf-8") for w in missing]
        written = self.letters[np.frombuffer(b"".join(data), dtype=np.uint8)].tobytes().decode(
            "utf-16-le")
        begin = 0
        for w, d in zip(missing, data, strict=True):
            end = begin + len(d)
            young[w] = array("i", [t.id for t in tokenize(written[begin:end])]).tobytes()
            begin = end
        out = [young[w] for w in words]
        if len(young) > REMEMBERED:
            self.young, self.old = {}, young
        return out


@cache
def encoder_of(vocabulary: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(vocabulary)


def encode_block(encoder: WordEncoder, texts: list[str],
                 end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts one after another, each with the end id, and their counts.

    The pre-tokens are those of the tokenizer's own byte-level pre-tokenizer, so distinct ones are
    encoded in place of whole texts.
    """
    apart = [i for i, t in enumerate(texts) if encoder.has_added(t)]
    if apart:
        parts, begin = [], 0
        for i in [*apart, len(texts)]:
            if begin < i:
                parts.append(encode_block(encoder, texts[begin:i], end_id))
            if i < len(texts):
                ids = np.array([*encoder.whole(texts[i]), end_id], dtype=np.int32)
                parts.append((ids, np.array([len(ids)])))
            begin = i + 1
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))
    tokens, counts = split_block(texts)
    coded = tokens.dictionary_encode()
    lists = encoder.encode(coded.dictionary.to_pylist())
    lists.append(np.array([end_id], dtype=np.int32).tobytes())
    size = np.fromiter(map(len, lists), dtype=np.int32, count=len(lists)) // 4
    flat = np.frombuffer(b"".join(lists), dtype=np.int32)
    # the end id is one more word, after each text's own
    codes = np.insert(coded.indices.to_numpy(), np.cumsum(counts), len(lists) - 1)
    n = size[codes]
    upto = np.cumsum(n, dtype=np.int64)
    shift = (np.cumsum(size) - size)[codes] - (upto - n)
    at = np.repeat(shift.astype(np.int32), n)
    at += np.arange(len(at), dtype=np.int32)
    doc_ends = upto[np.cumsum(counts + 1) - 1]
    return flat[at], np.diff(np.concatenate([[0], doc_ends]))


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2) -> None:
    """Write the ids of `text`, in ascending order of `doc_id`, over as many files as the session
    has shuffle partitions."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches):
        encoder = encoder_of(shared.value)
        before = 0
        for rows, texts in text_blocks(batches, "text", BLOCK_CHARS):
            ids, n = encode_block(encoder, texts, end_id)
            offsets = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(before + offsets[:-1]), pa.array(n),
                 pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))],
                names=["doc_id", "file_start", "n_tokens", "ids"])
            before += int(offsets[-1])

    ordered = docs.select("doc_id", "text").repartitionByRange(
        parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    (ordered.mapInArrow(encode, SCHEMA).write.option("compression", "zlib")
     .option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", INDEX_STRIDE)
     .option("maxRecordsPerFile", 0)  # a task's positions are those of its one file
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """`doc_id`, `start`, `n_tokens` and `ids` of all documents, or of the named ones.

    The filter on document ids reaches the ORC reader, which skips by file, stripe and row group.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    # one row per file, as many as the writing session had shuffle partitions; the files' names
    # follow the order of document ids
    totals = (spark.read.schema(SCHEMA).orc(path)
              .groupBy(F.col("_metadata.file_name").alias("file"))
              .agg(F.sum("n_tokens").alias("n")))
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return rows.withColumn("file", F.col("_metadata.file_name")).join(F.broadcast(offsets), "file").select(
        "doc_id", (F.col("file_start") + F.col("offset")).alias("start"), "n_tokens", "ids")


def with_crc32(df: DataFrame) -> DataFrame:
    """Replace `ids` by the checksum of them as little-endian unsigned 32-bit integers."""
    def checked(batches):
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy().astype("<u4")
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return df.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        checked, "doc_id long, start long, n_tokens long, ids_crc32 long")
