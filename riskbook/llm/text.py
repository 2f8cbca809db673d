"""Words and word shingles of Arrow text columns as flat numpy arrays.

A word is a run of bytes other than the ASCII white space (0x20, 0x09 to 0x0D).  Lower case covers
ASCII and the Latin-1 letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once, so that a task's arrays stay small for any batch.
SLICE_BYTES = 1_000_000
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0xD1342543DE82EF95
MASK = 0xFFFFFFFFFFFFFFFF


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about SLICE_BYTES of the text column; a longer text is a piece alone."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(size) // SLICE_BYTES
    cuts = np.flatnonzero(np.diff(piece)) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if end > start:
            yield batch.slice(start, end - start)


def as_text(column: pa.Array) -> pa.Array:
    """Null texts as empty ones, with 64-bit offsets."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in a row, and each text's first place among them."""
    texts = as_text(column)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower(raw: np.ndarray) -> np.ndarray:
    """Lower case of ASCII letters and of U+00C0 to U+00DE."""
    out = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    two = np.flatnonzero(raw[:-1] == 0xC3) + 1
    two = two[(raw[two] >= 0x80) & (raw[two] <= 0x9E) & (raw[two] != 0x97)]
    out[two] += np.uint8(32)
    return out


@dataclass
class Words:
    """Words as spans of bytes; text i has the words from offsets[i] to offsets[i + 1]."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


def scan(column: pa.Array) -> Words:
    raw, places = text_bytes(column)
    full = ~SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[places] = True
    before = np.concatenate([[False], full[:-1]])
    after = np.concatenate([full[1:], [False]])
    starts = np.flatnonzero(full & (~before | edge[:-1]))
    ends = np.flatnonzero(full & (~after | edge[1:])) + 1
    return Words(raw, starts, ends, np.searchsorted(starts, places))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


#: A 64-bit code for each byte, and the powers of BASE, kept while a task runs.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64, for i up to `length` at least."""
    if not POWERS or len(POWERS[0][0]) <= length:
        size = 1 << max(10, length.bit_length())
        up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        POWERS[:] = [(np.multiply.accumulate(up), np.multiply.accumulate(down))]
    return POWERS[0]


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, the same wherever the span stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_CODES[raw] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def windows(codes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` items, and each text's first place among them.

    A text of fewer items has one run, of what it has; one without items has none.
    """
    count = np.diff(offsets)
    short = (count > 0) & (count < size)
    if short.any():
        padded = np.where(short, size, count)
        shift = np.concatenate([[0], np.cumsum(padded)])
        spread = np.zeros(shift[-1], np.uint64)
        spread[np.arange(len(codes)) + np.repeat(shift[:-1] - offsets[:-1], count)] = codes
        codes, offsets, count = spread, shift, padded
    runs = np.maximum(count - size + 1, 0)
    first = np.concatenate([[0], np.cumsum(runs)])
    if not first[-1]:
        return np.zeros(0, np.uint64), first
    total = np.zeros(len(codes) - size + 1, np.uint64)
    for i in range(size):
        weight = np.uint64((0x9E3779B97F4A7C15 + 2 * i * 0x632BE59BD9B4E019) & MASK)
        total += codes[i : len(codes) - size + 1 + i] * weight
    inside = np.ones(len(total), bool)
    for back in range(1, size):  # runs that would cross the end of a text
        at = offsets[1:-1] - back
        inside[at[(at >= 0) & (at < len(total))]] = False
    return mix(total[inside]), first


def shingles(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles in order, repeats included, and each text's first place."""
    found = scan(column)
    codes = hash_spans(lower(found.raw), found.starts, found.ends)
    return windows(codes, found.offsets, size)
