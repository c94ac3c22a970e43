"""Whole texts as flat numpy arrays: words and their 64-bit hashes, a chunk of rows at a time.

The functions here run inside tasks. A chunk holds at most ``CHUNK`` bytes of text
(or one row, if that is longer), so that the memory of a task does not depend on how
many rows Spark puts in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 2 << 20
BLOCK = 1 << 16
STEP = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the place where each row begins (one more at the end). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    whole = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(whole):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = whole.buffers()
    begins = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return flat[begins[0] : begins[-1]], begins - begins[0]


def row_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have at most ``limit`` bytes together, or one longer row."""
    begins = text_bytes(column)[1]
    row, rows = 0, len(begins) - 1
    while row < rows:
        end = int(np.searchsorted(begins, begins[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z in lower case; all other bytes stay."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def is_space(data: np.ndarray) -> np.ndarray:
    """Space, tab, line feed, vertical tab, form feed, carriage return."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = np.asarray(h, np.uint64).copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _block_sums(blocks: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of the mixed 8-byte blocks of each range, each told by its place; all ranges have bytes."""
    counts = (lengths + 7) >> 3
    first = np.cumsum(counts) - counts
    place = np.arange(int(counts.sum())) - np.repeat(first, counts)
    value = blocks[np.repeat(starts, counts) + 8 * place]
    over = 8 * counts - lengths  # bytes of the last block that are not of the range
    value[first + counts - 1] &= ~np.uint64(0) >> (8 * over).astype(np.uint64)
    return np.add.reduceat(mix(mix(value + STEP) + place.astype(np.uint64) * STEP), first)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of bytes; equal bytes have equal hashes wherever they stand.

    Blocks of 8 bytes are mixed with their place in the range and summed, so that no relation of
    the bytes to each other cancels out. About ``BLOCK`` blocks are held at a time.
    """
    lengths = (ends - starts).astype(np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))
    sums = np.zeros(len(starts), np.uint64)
    counted = np.concatenate([[0], np.cumsum((lengths + 7) >> 3)])
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(counted, counted[at] + BLOCK, side="right")) - 1)
        own = slice(at, to)
        some = lengths[own] > 0
        if counted[to] - counted[at] <= 2 * BLOCK:
            if some.any():
                sums[own][some] = _block_sums(blocks, starts[own][some], lengths[own][some])
        else:  # one long range, piece by piece
            sums[at] = _long_sum(blocks, int(starts[at]), int(lengths[at]))
        at = to
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def _long_sum(blocks: np.ndarray, start: int, length: int) -> np.uint64:
    total = np.zeros(1, np.uint64)
    for low in range(0, length, 8 * BLOCK):
        count = min(BLOCK, (length - low + 7) >> 3)
        place = np.arange(low >> 3, (low >> 3) + count)
        value = blocks[start + 8 * place]
        over = max(0, low + 8 * count - length)
        value[-1] &= ~np.uint64(0) >> np.uint64(8 * over)
        total += mix(mix(value + STEP) + place.astype(np.uint64) * STEP).sum()
    return total[0]


def is_letter(data: np.ndarray) -> np.ndarray:
    """a-z and whatever is not ASCII."""
    return ((data >= 97) & (data <= 122)) | (data >= 128)


def words_of(data: np.ndarray, begins: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of each row (one more at the end).

    ``inside`` tells which bytes belong to words; by default all that are no white space.
    """
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(begins), np.int64)
    inside = ~is_space(data) if inside is None else inside
    first = np.zeros(len(data) + 1, bool)
    first[begins] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, begins)


def hashed_words(column: pa.Array, letters: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all rows, and the first word of each row (one more at the end).

    Words are what white space parts, or runs of ``letters``.
    """
    data, begins = text_bytes(column)
    lowered = lower_ascii(data)
    starts, ends, rows = words_of(lowered, begins, is_letter(lowered) if letters else None)
    return hash_ranges(lowered, starts, ends), rows


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of ragged ranges, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(lengths) else 0
    return np.arange(total, dtype=np.int64) + shift


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of one key after the other, from batches sorted by ``keys``. One group is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = tuple(column[a] for column in columns)
            if last is not None and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = own
    if held:
        yield pa.Table.from_batches(held)
