"""Words of many texts at once, as numpy arrays over one Arrow text buffer.

A text column of an Arrow batch is one run of UTF-8 bytes with offsets.  The
helpers work on that run in slices of a few megabytes, so memory does not
follow the number or the length of the rows (a longer text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept for the next slice."""
    known = _powers.get(str(base))
    if known is None or len(known) <= n:
        steps = np.full(max(n + 1, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = _powers[str(base)] = np.multiply.accumulate(steps)
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text, one row at least."""
    _, offsets = text_bytes(texts)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        end = min(end, len(texts))
        yield start, end
        start = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text array and the offset of each row; null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of member bytes: starts, ends, and the number of the first run of each row.

    A run never crosses the end of a row.
    """
    before = np.empty_like(member)
    before[:1] = False
    before[1:] = member[:-1]
    before[offsets[:-1][offsets[:-1] < len(member)]] = False
    after = np.empty_like(member)
    after[-1:] = False
    after[:-1] = member[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(member & ~before)
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than space and 09 to 0D."""
    return pieces(~_SEPARATOR[data], offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal spans anywhere."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, n)[:n], out=total[1:])
    spans = (total[ends] - total[starts]) * _power_table(_INVERSE, n)[starts]
    return mix(spans + (ends - starts).astype(np.uint64))


def by_row(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (0 to ``rows`` - 1) and 64-bit values, ordered by both.

    One sort of the row above the value's first bits does it; only where values
    of a row differ in their last bits alone, both are sorted as they are.
    """
    bits = np.uint64(max(rows - 1, 1).bit_length())
    order = np.argsort(row.astype(np.uint64) << (np.uint64(64) - bits) | value >> bits)
    one, two = row[order], value[order]
    if ((one[1:] == one[:-1]) & (two[1:] < two[:-1])).any():
        order = np.lexsort((value, row))
        one, two = row[order], value[order]
    return one, two


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row: hashes sorted by row and value, and their offsets.

    A row with fewer than k words has its whole sequence as its one shingle; a
    row without words has none.
    """
    counts = np.diff(first)
    made = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    row = np.repeat(np.arange(len(counts)), made)
    ends = np.concatenate([[0], np.cumsum(made)])
    at = first[:-1][row] + (np.arange(len(row)) - ends[row])
    size = np.minimum(counts, k)[row]
    value = np.zeros(len(row), np.uint64)
    for j in range(k):
        more = j < size
        inside = np.minimum(at + j, max(len(hashes) - 1, 0))
        step = (value ^ hashes[inside]) * np.uint64(0x9FB21C651E98DF25) + np.uint64(j + 1)
        value = np.where(more, step ^ (step >> np.uint64(29)), value) if not more.all() else step ^ (step >> np.uint64(29))
    row, value = by_row(row, mix(value), len(counts))
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[keep], value[keep]
    return value, np.searchsorted(row, np.arange(len(counts) + 1))


def crc32_mod(key: str, n: int):
    """crc32 of the id written as text, modulo n; null for a null id."""
    from pyspark.sql import functions as F

    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def in_rows(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list per row."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
