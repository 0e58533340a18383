"""Line deduplication with a log-template tree of fixed depth.

A line's tokens that hold a digit become a wildcard. The tree parses a line by its token count and
its first three tokens; in a leaf a line joins the first template whose leading line shares at least
80 % of its tokens, position by position, and the template keeps the tokens that all its lines
share. A template found in several documents is a recurring one: only the first document, by id,
keeps its lines, so no content is lost, and all others drop them.

A line in which fewer than half of the tokens are words (a letter, no digit) has no template: it is
compared by its unmasked text, so rows of different numbers stay. With `least` 1, as the query and
the pipeline ask, lines of one or two tokens are compared too; so few tokens must be equal.

With `cut`, as the query and the pipeline ask, lines fall into pieces, each parsed like a line:
sentences, joined until a piece has eight tokens. An edit then spoils one piece only.

Most leaves are met in one document only and can't recur. A first pass writes each text with the
leaves of its pieces, and numbers alone, a leaf and a hash of the document, find the leaves of several
documents. They set bits in a filter of at most `FILTER_BITS`, and a second pass hands on the pieces
that pass it. A full filter passes more pieces than needed and changes no result.

Leaves are spread by a shuffle of distinct lines: each batch combines equal lines first, so a line
that a third of all documents hold is a few rows. In a leaf, candidates are found by segments: with
at most k differing tokens one of k + 1 segments is equal. Lines that must be equal are leaves of
their own. Any other leaf is grown in one task, however many distinct lines it has.

Defined results: null text has no lines and stays null; without `least` lines of fewer than three
tokens are never dropped; null ids come after all others; rows of equal id and text count as one document and are
treated alike; other columns pass unchanged; an empty table stays empty.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import scratch_path, settle

WILDCARD = "<*>"
LEADING = 3
LEAST_TOKENS = 3
SIMILARITY = 0.8
CHUNK_LINES = 20_000
SLICE_ROWS = 2_000
#: Share of the tokens of a masked line that must be words.
WORDS = 0.5
#: Least tokens of a piece, unless its line has fewer.
PIECE_TOKENS = 8
#: Bits of the filter of shared leaves: for each of them, and at most.
BITS_PER_LEAF, LEAST_BITS, FILTER_BITS = 16, 1 << 16, 1 << 26
LETTER = re.compile(r"[^\W\d_]")
SENTENCE_END = re.compile(r"[.!?][ \t](?=[^ \t])")
DIGIT = re.compile(r"\d")

PIECES = ("__n boolean, __i long, __h long, begin int, end int, leaf long, line long, "
          "masked string")

Key = tuple[bool, int, int]


def signed(data: str) -> int:
    h = xxhash.xxh64_intdigest(data.encode("utf-8"), 42)
    return h - (1 << 64) if h >> 63 else h


def few_words(tokens: list[str]) -> bool:
    words, wanted = 0, WORDS * len(tokens)
    # mostly prose: the first tokens are enough words, told by their first letters
    if "".join([t[0] for t in tokens[:math.ceil(wanted)]]).isalpha():
        return False
    for t in tokens:
        if t != WILDCARD and (t[0].isalpha() or LETTER.search(t)):
            words += 1
            if words >= wanted:
                return False
    return True


def masked_tokens(line: str) -> tuple[bool, list[str]]:
    """Whether the line is compared as it is, for want of words, and its tokens, masked if not."""
    given = line.split()
    # a token is masked as a whole, so its place among the tokens stays
    tokens = [WILDCARD if DIGIT.search(t) else t for t in given] if DIGIT.search(line) else given
    return (True, given) if few_words(tokens) else (False, tokens)


def leaf_of(line: str, least: int = LEAST_TOKENS) -> tuple[int, list[str]] | None:
    """The leaf and the masked tokens; none for a line of fewer tokens."""
    plain, tokens = masked_tokens(line)
    if len(tokens) < max(least, 1):
        return None
    if plain:
        return signed("\0".join(["=", *tokens])), tokens
    # few tokens allow no difference, so a leaf of their own spreads better
    leading = tokens if int(len(tokens) * (1 - SIMILARITY) + 1e-9) == 0 else tokens[:LEADING]
    return signed("\0".join([str(len(tokens)), *leading])), tokens


def parse(line: str, least: int = LEAST_TOKENS) -> tuple[int, str] | None:
    """The leaf and the masked line; none for a line of fewer tokens."""
    found = leaf_of(line, least)
    return found and (found[0], " ".join(found[1]))


def pieces(line: str, cut: bool) -> list[str]:
    """The line, or its sentences in runs of at least eight tokens; joined, they are the line."""
    if not cut:
        return [line]
    out, begin, last, tokens = [], 0, 0, 0
    for m in SENTENCE_END.finditer(line):
        # sentences end in white space, so their tokens add up
        tokens += len(line[last:m.end()].split())
        last = m.end()
        if tokens >= PIECE_TOKENS:
            out.append(line[begin:last])
            begin, tokens = last, 0
    if begin < len(line):
        rest = line[begin:]
        if not out or tokens + len(line[last:].split()) >= PIECE_TOKENS:
            out.append(rest)
        else:
            out[-1] += rest
    return out or [line]


@dataclass
class Template:
    lead: list[str]
    tokens: list[str]
    low: Key
    high: Key
    members: list[int] = field(default_factory=list)


class Leaf:
    """Templates of one leaf of the tree."""

    def __init__(self):
        self.templates: list[Template] = []
        self.index: dict[tuple, list[int]] = {}

    def add(self, masked: str, low: Key, high: Key) -> None:
        tokens = masked.split(" ")
        differing = int(len(tokens) * (1 - SIMILARITY) + 1e-9)
        cuts = np.linspace(0, len(tokens), differing + 2).astype(int).tolist()
        segments = [(a, *tokens[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        met: set[int] = set()
        best = None
        for s in segments:
            for i in self.index.get(s, ()):
                if i not in met:
                    met.add(i)
                    lead = self.templates[i].lead
                    if sum(x != y for x, y in zip(lead, tokens, strict=True)) <= differing and (
                            best is None or i < best):
                        best = i
        if best is None:
            best = len(self.templates)
            self.templates.append(Template(tokens, list(tokens), low, high))
            for s in segments:
                self.index.setdefault(s, []).append(best)
        t = self.templates[best]
        t.tokens = [x if x == y else WILDCARD for x, y in zip(t.tokens, tokens, strict=True)]
        t.low, t.high = min(t.low, low), max(t.high, high)
        t.members.append(signed(masked))


def key_of(doc_id: int | None, h: int) -> Key:
    return doc_id is None, doc_id or 0, h


def document_keys(docs: DataFrame) -> dict:
    return {"__n": F.col("doc_id").isNull(), "__i": F.coalesce("doc_id", F.lit(0)),
            "__h": F.xxhash64("text")}


def placed_pieces(text: str, cut: bool) -> Iterator[tuple[int, str]]:
    """Where a piece begins, and the piece; a line has one at least, if only an empty one."""
    at = 0
    for line in text.split("\n"):
        for piece in pieces(line, cut):
            yield at, piece
            at += len(piece)
        at += 1


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, so that few texts are held unpacked at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def parse_texts(batches: Iterable[pa.RecordBatch], least: int, cut: bool) -> Iterator[pa.RecordBatch]:
    """The batch with its last column, the text, packed, and where each piece of the text begins
    and its leaf; the leaf is null for pieces without one."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in slices(batches):
        packed, begins, leaves = [], [], []
        for text in batch.columns[-1].to_pylist():
            packed.append(None if text is None else pack(text.encode("utf-8")))
            placed = list(placed_pieces(text or "", cut))
            begins.append([at for at, _ in placed])
            found = [leaf_of(piece, least) for _, piece in placed]
            leaves.append([x and x[0] for x in found])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(packed, pa.binary()),
             pa.array(begins, pa.list_(pa.int32())), pa.array(leaves, pa.list_(pa.int64()))],
            names=[*batch.schema.names[:-1], "__packed", "__begins", "__leaves"])


def unpacked(data: bytes) -> str:
    return zstandard.decompress(data).decode("utf-8")


def leaf_filter(parsed: DataFrame) -> np.ndarray:
    """Bits set for every leaf that several documents reach, in bytes, lowest first."""
    met = parsed.select(F.xxhash64("__n", "__i", "__h").alias("doc"), F.explode("__leaves").alias(
        "leaf")).where(F.col("leaf").isNotNull())
    shared = settle(met.groupBy("leaf").agg(F.min("doc").alias("low"), F.max("doc").alias(
        "high")).where("low != high").select("leaf"))
    bits = LEAST_BITS
    while bits < min(FILTER_BITS, BITS_PER_LEAF * shared.count()):
        bits *= 2
    place = F.explode(F.array(F.col("leaf").bitwiseAND(bits - 1),
                              F.shiftrightunsigned("leaf", 32).bitwiseAND(bits - 1))).alias("at")
    words = shared.select(place).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr(
        "shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()  # at most bits / 64 rows
    table = np.zeros(bits // 64, dtype=np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.view(np.uint8)


def shared_pieces(batches: Iterable[pa.RecordBatch], bits) -> Iterator[pa.RecordBatch]:
    """(document, place, leaf, line, masked) of the pieces whose leaf passes the filter."""
    table = bits.value
    last = 8 * len(table) - 1

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 8
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
                 pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["__n", "__i", "__h", "begin", "end", "leaf", "line", "masked"])

    for batch in slices(batches):
        lists = batch.column("__leaves")
        flat, begins = lists.flatten(), batch.column("__begins").flatten().to_numpy()
        leaf = flat.fill_null(0).to_numpy()
        a, b = leaf & last, (leaf >> 32) & last
        passes = (table[a >> 3] >> (a & 7).astype(np.uint8)) & (
            table[b >> 3] >> (b & 7).astype(np.uint8)) & flat.is_valid().to_numpy(zero_copy_only=False)
        upto = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        # texts without such a piece stay packed
        row = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(passes)])[upto]))
        out: list[tuple] = []
        for k in row.tolist():
            n, i, h = (batch.column(c)[k].as_py() for c in ("__n", "__i", "__h"))
            text = unpacked(batch.column("__packed")[k].as_py())
            places = [*begins[upto[k]:upto[k + 1]].tolist(), len(text) + 1]
            for at in np.flatnonzero(passes[upto[k]:upto[k + 1]]).tolist():
                begin, end = places[at], places[at + 1]
                if end > len(text) or text[end - 1] == "\n":  # the next piece is another line's
                    end -= 1
                masked = " ".join(masked_tokens(text[begin:end])[1])
                out.append((n, i, h, begin, end, int(leaf[upto[k] + at]), signed(masked), masked))
            if len(out) > CHUNK_LINES:
                yield rows(out)
                out = []
        yield rows(out)


def distinct_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(leaf, masked, first and last document) of the distinct lines of a batch."""
    names = ["leaf", "masked", "low_n", "low_i", "low_h", "high_n", "high_i", "high_h"]
    kinds = [pa.int64(), pa.string(), *[pa.bool_(), pa.int64(), pa.int64()] * 2]
    for batch in batches:
        met: dict[tuple[int, str], list[Key]] = {}
        for n, i, h, leaf, masked in zip(*[batch.column(c).to_pylist() for c in (
                "__n", "__i", "__h", "leaf", "masked")], strict=True):
            key = (n, i, h)
            span = met.setdefault((leaf, masked), [key, key])
            span[0], span[1] = min(span[0], key), max(span[1], key)
        flat = [(leaf, masked, *low, *high) for (leaf, masked), (low, high) in met.items()]
        columns = list(zip(*flat, strict=True)) or [[]] * 8
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def grow_leaves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of recurring templates; rows come sorted by leaf and line."""
    current, waiting = None, {}

    def close() -> list[tuple]:
        if not waiting:
            return []
        if len(waiting) == 1:
            ((masked, (low, high)),) = waiting.items()
            return [(current, signed(masked), *low, masked)] if low != high else []
        leaf = Leaf()
        for masked, (low, high) in waiting.items():
            leaf.add(masked, low, high)
        return [(current, m, *t.low, " ".join(t.tokens)) for t in leaf.templates
                if t.low != t.high for m in t.members]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["leaf", "line", "first_n", "first_i", "first_h", "template"])

    for batch in batches:
        found: list[tuple] = []
        columns = [batch.column(i).to_pylist() for i in range(8)]
        for leaf, masked, *span in zip(*columns, strict=True):
            if leaf != current:
                found += close()
                current, waiting = leaf, {}
            low, high = tuple(span[:3]), tuple(span[3:])
            if masked in waiting:
                a, b = waiting[masked]
                low, high = min(a, low), max(b, high)
            waiting[masked] = (low, high)
        yield rows(found)
    yield rows(close())


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the pieces at these places; lines left with none go as a whole."""
    kept, at, todo = [], 0, sorted(spans, reverse=True)
    for line in text.split("\n"):
        left, begin, end = [], at, at + len(line)
        whole = not todo or todo[-1][0] > end
        while todo and todo[-1][0] <= end:
            a, b = todo.pop()
            left.append(text[begin:a])
            begin = b
        left = "".join([*left, text[begin:end]])
        if whole:
            kept.append(line)
        elif left:
            kept.append(left.rstrip())
        at = end + 1
    return "\n".join(kept)


def shortened(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, number of dropped pieces) in place of the packed text and the places."""
    for batch in slices(batches):
        texts, sizes = [], []
        for data, spans in zip(*[c.to_pylist() for c in batch.columns[-2:]], strict=True):
            text = None if data is None else unpacked(data)
            if spans:
                text = without(text, [(s["begin"], s["end"]) for s in spans])
            texts.append(text)
            sizes.append(len(spans or ()))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(texts, pa.string()), pa.array(sizes, pa.int64())],
            names=[*batch.schema.names[:-2], "__text", "__dropped"])


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def parsed_texts(docs: DataFrame, least: int = LEAST_TOKENS, cut: bool = False) -> DataFrame:
    """The columns of `docs` but the text, document keys, the packed text and its pieces' places and
    leaves; written to the scratch folder once, so nothing is cut twice."""
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c != "text"],
                       *[c.alias(k) for k, c in document_keys(docs).items()], "text")
    return written(rows.mapInArrow(partial(parse_texts, least=least, cut=cut), T.StructType([
        *rows.schema.fields[:-1], T.StructField("__packed", T.BinaryType()),
        T.StructField("__begins", T.ArrayType(T.IntegerType())),
        T.StructField("__leaves", T.ArrayType(T.LongType()))])), "parsed")


def candidate_pieces(parsed: DataFrame) -> DataFrame:
    """The pieces of leaves that several documents reach; written too, since they are read twice."""
    bits = parsed.sparkSession.sparkContext.broadcast(leaf_filter(parsed))
    columns = parsed.select("__n", "__i", "__h", "__packed", "__begins", "__leaves")
    return written(columns.mapInArrow(partial(shared_pieces, bits=bits), PIECES), "pieces")


def recurring_lines(pieces: DataFrame) -> DataFrame:
    """(leaf, line, first_n, first_i, first_h, template): distinct masked lines, by hash, of the
    templates found in several documents, and the first of these documents."""
    lines = pieces.select("__n", "__i", "__h", "leaf", "masked").mapInArrow(
        distinct_lines, "leaf long, masked string, low_n boolean, low_i long, low_h long, "
                        "high_n boolean, high_i long, high_h long")
    return lines.repartition("leaf").sortWithinPartitions("leaf", "masked").mapInArrow(
        grow_leaves, "leaf long, line long, first_n boolean, first_i long, first_h long, "
        "template string")


def drop_recurring(docs: DataFrame, dropped: str | None = None, least: int = LEAST_TOKENS,
                   cut: bool = False) -> DataFrame:
    """All columns of `docs`, `text` without recurring lines of at least `least` tokens, or with
    `cut` without recurring pieces of lines; `dropped` names a count of them."""
    parsed = parsed_texts(docs, least, cut)
    lines = candidate_pieces(parsed)
    known = recurring_lines(lines).drop("template")
    later = (F.col("__n") != F.col("first_n")) | (F.col("__i") != F.col("first_i")) | (
        F.col("__h") != F.col("first_h"))
    keys = ["__n", "__i", "__h"]
    marked = lines.drop("masked").join(known, ["leaf", "line"]).where(later).groupBy(*keys).agg(
        F.collect_set(F.struct("begin", "end")).alias("__spans"))
    others = [f for f in docs.schema.fields if f.name != "text"]
    short = parsed.drop("__begins", "__leaves").join(marked, keys, "left").select(
        *[f"`{f.name}`" for f in others], "__packed", "__spans").mapInArrow(
        shortened, T.StructType([*others, T.StructField("__text", T.StringType()),
                                 T.StructField("__dropped", T.LongType())]))
    return short.select(*[F.col("__text" if c == "text" else f"`{c}`").alias(c)
                          for c in docs.columns],
                        *([F.col("__dropped").alias(dropped)] if dropped else []))
