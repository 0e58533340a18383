"""Pre-tokens of the GPT-2 pattern, cut for a whole block of texts at once with numpy.

The pattern is
's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
Its matches cover a text without gaps, so a block is one UTF-8 buffer plus start offsets, and the
pre-tokens are an Arrow string array over that buffer.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import regex

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@cache
def classes() -> np.ndarray:
    """Class of every code point."""
    points = np.arange(0x110000, dtype=np.uint32)
    points[0xD800:0xE000] = 0  # surrogates are no characters
    every = points.tobytes().decode("utf-32-le")
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for code, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            table[m.start():m.end()] = code
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Boolean mask of the positions at which a pre-token starts.

    `first` marks where a text begins: neither a match nor a look-ahead crosses it.
    """
    n = len(points)
    kind = classes()[points]
    mask = first.copy()
    mask[1:] |= kind[1:] != kind[:-1]
    # the last character of a run of spaces that another character follows in the same text
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:]) if n > 1 else np.array([], int)
    mask[last] = True
    joined = last[points[last] == 0x20] + 1
    mask[joined] = False
    # a lone apostrophe before a letter may start a contraction
    quote = np.flatnonzero((points[:-1] == 0x27) & mask[:-1] & (kind[1:] == LETTER)
                           & ~first[1:]) if n > 1 else np.array([], int)
    for at in quote:
        for suffix in CONTRACTIONS:
            end = at + 1 + len(suffix)
            if end <= n and not first[at + 1:end].any() and all(
                    points[at + 1 + i] == ord(c) for i, c in enumerate(suffix)):
                mask[at + 1] = False
                if end < n:
                    mask[end] |= kind[end] == LETTER or first[end]
                break
    return mask


def split_block(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of the texts in order, and how many each text has."""
    joined = "".join(texts)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    edges = np.concatenate([[0], np.cumsum(lengths)])
    if not joined:
        return pa.array([], pa.large_string()), np.zeros(len(texts), dtype=np.int64)
    points = code_points(joined)
    first = np.zeros(len(points), dtype=bool)
    first[edges[:-1][lengths > 0]] = True
    where = np.flatnonzero(starts(points, first))
    counts = np.searchsorted(where, edges[1:]) - np.searchsorted(where, edges[:-1])
    data = joined.encode("utf-8")
    if len(data) == len(points):
        offsets = np.append(where, len(data)).astype(np.int64)
    else:
        size = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.uint8)
        offsets = np.append(np.concatenate([[0], np.cumsum(size)])[where], len(data)).astype(np.int64)
    tokens = pa.LargeStringArray.from_buffers(
        len(where), pa.py_buffer(offsets), pa.py_buffer(data))
    return tokens, counts


def text_blocks(batches, column: str, chars: int):
    """(rows, texts) of about `chars` characters; null counts as empty, a longer text stands alone."""
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
        begin = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t) > chars:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(t)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]
