"""Words of whole Arrow batches as 64-bit hashes, and hashes of runs of words, without Python loops."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
SLICE_BYTES = 1 << 22
#: Partitions of a shuffle by bucket, at most; beyond that several buckets share one.
MOST_PARTITIONS = 10_000
_U = np.uint64
_STEP, _STEP_BACK = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64) * _U(2) + _U(1)


def byte_class(dropped: bytes) -> np.ndarray:
    """A table that says of each byte whether it belongs to a word."""
    table = np.ones(256, bool)
    table[list(dropped)] = False
    return table


#: Words between white space, and words of letters, digits and everything beyond ASCII.
SPACED = byte_class(b" \t\n\x0b\x0c\r")
PLAIN = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that lets every bit depend on every other."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_KEPT_POWERS = CHUNK_BYTES + 65_536
_POWERS: list[np.ndarray] = []


def _accumulated(n: int) -> list[np.ndarray]:
    up, back = np.full(n, _STEP), np.full(n, _STEP_BACK)
    up[:1] = back[:1] = 1
    return [np.multiply.accumulate(x, out=x) for x in (up, back)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash's base and of its inverse. A worker keeps those that a chunk needs, and no more."""
    if n > _KEPT_POWERS:
        up, back = _accumulated(n)
        return up, back
    if not _POWERS:
        _POWERS[:] = _accumulated(_KEPT_POWERS)
    return _POWERS[0][:n], _POWERS[1][:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each run ``values[start:end]``; equal runs have equal hashes wherever they lie."""
    up, back = powers(len(values) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:-1])))
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def content(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one text after the other, and where each text ends."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and ends[-1] else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def word_places(column: pa.Array, kind: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of a string column in order, their first and last + 1 bytes, and where each text ends.

    Bytes go through in chunks of bounded size that are cut outside words.
    """
    data, ends = content(column)
    data = _LOWER[data] if lower else data
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[ends] = True
    hashes, firsts, lasts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    done = 0
    while done < len(data):
        stop = min(done + CHUNK_BYTES, len(data))
        while stop < len(data) and not starts_text[stop] and kind[data[stop]]:
            more = np.flatnonzero(~kind[data[stop : stop + 65_536]] | starts_text[stop : min(stop + 65_536, len(data))])
            stop += int(more[0]) if more.size else min(65_536, len(data) - stop)
        part, border = data[done:stop], starts_text[done : stop + 1]
        inside = kind[part]
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | border[1:-1]
        closes[:-1] &= ~inside[1:] | border[1:-1]
        first, last = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        hashes.append(run_hashes(_BYTES[part], first, last))
        firsts.append(first + done)
        lasts.append(last + done)
        done = stop
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(lasts), ends


def words(column: pa.Array, kind: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column in order, and the number of words before each text's end."""
    hashes, first, _, ends = word_places(column, kind, lower)
    return hashes, np.searchsorted(first, ends)


def grams(hashes: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``n`` consecutive words, for each place in ``hashes``, and whether the run lies in one text."""
    at = np.arange(len(hashes))
    left = np.repeat(ends[1:], np.diff(ends)) - at
    last = np.minimum(at + n, len(hashes))
    return run_hashes(hashes, at, last), left >= n


_TRIM = ctypes.CDLL(None).malloc_trim if sys.platform == "linux" and hasattr(ctypes.CDLL(None), "malloc_trim") else None


def give_back() -> None:
    """Memory that a worker has freed goes back to the machine: it lives as long as its executor, beside others and a JVM."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of one column; a longer text is a batch of its own."""
    # What this worker held in an earlier stage.
    give_back()
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy()
        ends = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
            yield batch.slice(at, stop - at)
            at = stop
            # What a slice needed goes back before the next.
            give_back()


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its values and the length of each list."""
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))
