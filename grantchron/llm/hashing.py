"""Words and rolling hashes of many texts at once, with numpy on the bytes of an Arrow column."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_LONG_WORD = 64  # bytes of the longest word that is hashed with others
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and where each row starts (and the end)."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back_memory() -> None:
    """At the end of a task: a worker waits for the next one without what this one had freed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library may have no such call
        ctypes.CDLL(None).malloc_trim(0)


def parts(
    batches: Iterator[pa.RecordBatch], text_at: int, size: int = 2_000_000
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of batches with about `size` bytes of text: rows, their bytes, where each starts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = bytes_of(batch.column(text_at))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + size, "left"))
            end = min(max(end, start + 1), batch.num_rows)
            low, high = offsets[start], offsets[end]
            yield batch.slice(start, end - start), data[low:high], offsets[start : end + 1] - low
            start = end
    give_back_memory()


@cache
def _space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each run of non-space bytes within a row, and words before each row."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~_space()[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets, "left")


@cache
def _tables(which: int) -> np.ndarray:
    """A random number for each byte at each place of a word, one row for a place."""
    numbers = np.arange(_LONG_WORD * 256, dtype=U64) + U64(which << 40)
    return mix(mix(numbers * U64(0x9E3779B97F4A7C15) + U64(0xC2B2AE3D27D4EB4F))).reshape(_LONG_WORD, 256)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, stops: np.ndarray, which: int = 0
) -> np.ndarray:
    """A 64-bit hash of each word; `which` picks one of two independent functions.

    The sum of a random number for each byte and place (tabulation hashing); long words are
    hashed one at a time.
    """
    table = _tables(which).reshape(-1)
    result = np.empty(len(starts), U64)
    length = stops - starts
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(stops, low + _CHUNK, "right")))
        s, e = starts[first:last] - low, stops[first:last] - low
        if last == first + 1 and e[0] > _LONG_WORD:
            first = last
            continue
        # Up to the next word, bytes between words count as the word's; no sum ends behind them.
        begin = np.repeat(s.astype(np.int32), np.diff(s, append=e[-1]))
        place = np.minimum(np.arange(len(begin), dtype=np.int32) - begin, _LONG_WORD - 1)
        sums = np.zeros(len(place) + 1, U64)
        np.cumsum(table[(place << 8) | data[low : low + len(place)]], out=sums[1:])
        result[first:last] = sums[e] - sums[s]
        first = last
    for i in np.flatnonzero(length > _LONG_WORD):
        result[i] = xxhash.xxh3_64_intdigest(data[starts[i] : stops[i]].tobytes(), seed=which)
    return mix(result + length.astype(U64))


def runs(hashes: np.ndarray, n: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """A hash of each n consecutive entries, one for each start that has n."""
    if len(hashes) < n:
        return np.empty(0, U64)
    total = np.zeros(len(hashes) - n + 1, U64)
    for j in range(n):
        total = total * U64(base) + hashes[j : j + len(total)]
    return mix(total)


def place_in_row(before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For n entries of rows that have `before` entries before them: row, and place in it."""
    count = np.diff(before)
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(n) - before[row]
