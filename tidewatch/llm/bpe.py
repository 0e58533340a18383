"""Byte-level BPE encoding and decoding of whole texts.

Encoding is a shuffle over distinct words. Texts are cut into blocks; a block's pre-tokens become
positions in the block's own list of distinct words. The lists are exploded into buckets by word
hash, so every occurrence of a word, from whatever block, meets in one task, which encodes the word
once. The ids go back to the block and are put together by position. Only packed, distinct words
move, so a word that fills a third of the corpus is one small entry per block.

Decoding joins ids with the token-byte table. The vocabulary is fixed in size, so the table is
broadcast and the join is a lookup per Arrow batch; ids outside of it give a null text.

Defined results: null text counts as empty; an empty text has no ids and decodes to no bytes; rows
are kept one to one, repeated rows and null keys included; an empty table stays empty. `keep` names
the columns carried along; a column called like an output must be renamed first.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.packing import pack, pack_columns, unpack
from tidewatch.llm.pretokens import split_block, text_blocks

BLOCK_CHARS = 4_000_000
#: Words whose ids a task remembers; beyond it a word may be encoded again, with the same ids.
REMEMBERED = 300_000
#: A vocabulary above this size is refused, because it is broadcast.
LARGEST_VOCABULARY = 2_000_000
MOVED = "block string, part int, data binary"
CODES = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a vocabulary file of base64 tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if len(ranks) > LARGEST_VOCABULARY:
        raise ValueError(f"{len(ranks)} tokens; at most {LARGEST_VOCABULARY} are broadcast")
    return ranks


def word_encoder(ranks: dict[bytes, int], pattern: str) -> Callable[[str], Sequence[int]]:
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary


def _planes(codes: np.ndarray) -> dict[str, np.ndarray]:
    """Bytes of the codes by place: the rarely used high bytes compress to nothing."""
    return {f"b{k}": ((codes >> 8 * k) & 255).astype(np.uint8) for k in range(4)}


def _whole(batch: pa.RecordBatch) -> np.ndarray:
    return sum(batch.column(f"b{k}").to_numpy().astype(np.int32) << 8 * k for k in range(4))


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _parts(data: bytes) -> list[pa.RecordBatch]:
    out, at = [], 0
    while at < len(data):
        end = at + 8 + int.from_bytes(data[at:at + 8], "little")
        out.append(unpack(data[at + 8:end]))
        at = end
    return out


class _Block:
    """Rows of one block, its distinct words in order of use, and the bucket of each word."""

    def __init__(self, rows: pa.RecordBatch, texts: list[str], keep: list[str], buckets: int):
        tokens, counts = split_block(texts)
        coded = tokens.dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_binary())
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        place = np.empty(len(words), dtype=np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        self.codes, self.words = place[codes], words.take(pa.array(order))
        self.bucket = np.fromiter(map(zlib.crc32, self.words.to_pylist()), dtype=np.int64,
                                  count=len(words)) % buckets
        self.head = pa.RecordBatch.from_arrays(
            [*[rows.column(rows.schema.get_field_index(c)) for c in keep], pa.array(counts)],
            names=[*keep, "__n"])
        # named by content: however the rows are cut, a name always means the same words
        name = xxhash.xxh3_128(pack(self.head))
        name.update("".join(texts).encode("utf-8"))
        self.name = name.hexdigest()


def _words(block: _Block, buckets: int) -> Iterator[tuple[str, str, int, bytes]]:
    by_bucket = np.argsort(block.bucket, kind="stable")
    ends = np.cumsum(np.bincount(block.bucket, minlength=buckets))
    for b in range(buckets):
        own = by_bucket[ends[b - 1] if b else 0:ends[b]]
        if len(own):
            listed = block.words.take(pa.array(own)).cast(pa.binary())
            yield f"{b}", block.name, b, pack_columns(word=listed)


def _codes(block: _Block) -> tuple[str, int, bytes]:
    return block.name, CODES, _join(
        pack(block.head), pack_columns(bucket=block.bucket.astype(np.uint16)),
        pack_columns(**_planes(block.codes)))


def _encode_words(batches: Iterable[pa.RecordBatch], encode: Callable[[str], Sequence[int]]):
    """Replace lists of words by lists of ids."""
    known: dict[bytes, bytes] = {}
    for batch in batches:
        out = []
        for data in batch.column("data"):
            words = unpack(data.as_py()).column("word").to_pylist()
            if len(known) > REMEMBERED:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = np.array(encode(w.decode("utf-8")), dtype="<i4").tobytes()
            ids = [known[w] for w in words]
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
            out.append(_join(pack_columns(n=sizes.astype(np.uint32)),
                             pack_columns(**_planes(np.frombuffer(b"".join(ids), dtype="<i4")))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("block"), batch.column("part"), pa.array(out, pa.binary())],
            names=["block", "part", "data"])


def _assemble(group: pa.Table, keep: list[str], types: list[pa.DataType]) -> pa.Table:
    """Rows of one block with their ids; blocks of equal content share a name."""
    parts, data = group.column("part").to_pylist(), group.column("data").to_pylist()
    blocks = [d for p, d in zip(parts, data, strict=True) if p == CODES]
    lists = {p: d for p, d in zip(parts, data, strict=True) if p != CODES}
    if not blocks:
        raise RuntimeError("a block lost its rows: they changed between two readings")
    head, buckets, _ = _parts(blocks[0])
    bucket = buckets.column("bucket").to_numpy()
    if set(lists) != set(np.unique(bucket).tolist()):
        raise RuntimeError("a block lost words: its rows changed between two readings")
    found = [(n.column("n").to_numpy(), _whole(ids))
             for n, ids in (_parts(lists[b]) for b in sorted(lists))]
    sizes = np.zeros(len(bucket), dtype=np.int64)
    begin = np.zeros(len(bucket), dtype=np.int64)
    flat = np.concatenate([x[1] for x in found]) if found else np.array([], dtype=np.int32)
    by_bucket = np.argsort(bucket, kind="stable")
    if found:
        sizes[by_bucket] = np.concatenate([x[0] for x in found])
        begin[by_bucket] = np.cumsum(sizes[by_bucket]) - sizes[by_bucket]
    out = []
    for block in blocks:
        head, _, planes = _parts(block)
        codes = _whole(planes)
        # every occurrence's ids, one after another
        n = sizes[codes]
        ends = np.cumsum(n)
        at = np.repeat(begin[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        upto = np.concatenate([[0], np.cumsum(head.column("__n").to_numpy())])
        offsets = np.concatenate([[0], ends])[upto].astype(np.int32)
        out.append(pa.Table.from_arrays(
            [*[head.column(head.schema.get_field_index(c)).cast(t)
               for c, t in zip(keep, types, strict=True)],
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[at].astype(np.int32)))],
            names=[*keep, "ids"]))
    return pa.concat_tables(out)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           keep: Sequence[str] = ("doc_id",), buckets: int | None = None) -> DataFrame:
    """`keep` and `ids`, the token ids of every whole text.

    `docs` is read twice and should be a table or a settled result: rows that come in another order
    the second time end the job with an error, never with a wrong result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    keep = list(keep)
    n = min(buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions")), 65_536)
    schema = T.StructType([*[docs.schema[c] for c in keep],
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    types = list(to_arrow_schema(T.StructType([docs.schema[c] for c in keep])).types)
    shared = spark.sparkContext.broadcast(ranks)

    def blocks(batches):
        for rows, texts in text_blocks(batches, text, BLOCK_CHARS):
            yield _Block(rows, texts, keep, n)

    def words(batches):
        for block in blocks(batches):
            out = list(zip(*_words(block, n), strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
                 pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())],
                names=["bucket", "block", "part", "data"])

    def codes(batches):
        for block in blocks(batches):
            name, part, data = _codes(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([data], pa.binary())],
                names=["block", "part", "data"])

    def encode_words(batches):
        return _encode_words(batches, word_encoder(shared.value, pattern))

    def assemble(group: pa.Table) -> pa.Table:
        return _assemble(group, keep, types)

    # the texts are cut twice, which is cheaper than carrying the codes past the words' shuffle
    rows = docs.select(*dict.fromkeys([*keep, text]))
    coded = rows.mapInArrow(words, f"bucket string, {MOVED}").repartition("bucket").mapInArrow(
        encode_words, MOVED)
    return coded.unionByName(rows.mapInArrow(codes, MOVED)).groupBy("block").applyInArrow(
        assemble, schema)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded",
           special: dict[bytes, int] | None = None) -> DataFrame:
    """Add `out`, the bytes of `ids`; null where ids are null or one is no token's."""
    by_id = {i: b for b, i in {**ranks, **(special or {})}.items()}
    shared = df.sparkSession.sparkContext.broadcast(
        [by_id.get(i) for i in range(max(by_id, default=-1) + 1)])
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def join_bytes(batches):
        table = pa.array([*shared.value, None], pa.binary())
        last = len(table) - 1
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            flat = np.where((flat >= 0) & (flat < last), flat, last).astype(np.int32)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            joined = pc.binary_join(pa.ListArray.from_arrays(
                pa.array(offsets), table.take(pa.array(flat))), b"")
            joined = pc.if_else(lists.is_valid(), joined, pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, joined.cast(pa.binary())],
                                             names=[*batch.schema.names, out])

    return df.mapInArrow(join_bytes, schema)


def digest(ids: str = "ids", decoded: str = "decoded") -> list:
    """Count and digests of ids and decoded bytes, as columns."""
    return [F.size(ids).cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256).alias("ids_sha256"),
            F.sha2(F.col(decoded), 256).alias("decoded_sha256")]
