"""Texts of an Arrow batch as flat byte arrays, and hashes of spans in them.

A batch is cut into slices of about `limit` bytes (a longer text is a slice of its own), so
that the working arrays of a task stay bounded whatever the batch holds.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_state: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def give_back() -> None:
    """Return what this worker has freed to the system, for the stages after this one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one more entry at the end); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(starts: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes each."""
    row, rows = 0, len(starts) - 1
    while row < rows:
        end = int(np.searchsorted(starts, starts[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(32)
    return values


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _state.get("powers")
    if have is None or len(have) < n:
        size = max(n, SLICE + (1 << 16))
        for name, base in (("powers", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _state[name] = np.multiply.accumulate(steps)
        _state["table"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return _state["powers"], _state["inverse"]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running sums from which `span_hashes` takes the hash of any span of `data`."""
    powers, _ = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    values = _state["table"][data]
    values *= powers[: len(data)]
    np.cumsum(values, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; equal bytes have equal hashes."""
    _, inverse = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def ordered_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = SLICE) -> np.ndarray:
    """`span_hashes` of spans that follow each other, by blocks of about `limit` bytes: neither
    the sums nor the powers a worker keeps grow with `data`."""
    out = np.empty(len(starts), np.uint64)
    row = 0
    while row < len(starts):
        begin = int(starts[row])
        after = max(int(np.searchsorted(ends, begin + limit, "right")), row + 1)
        sums = prefix_hashes(data[begin : int(ends[after - 1])])
        out[row:after] = span_hashes(sums, starts[row:after] - begin, ends[row:after] - begin)
        row = after
    return out


def runs(inside: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that lie within one text.

    `text_starts`: where each text begins, and the end of the last.
    """
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(inside) + 1, bool)
    cut[text_starts] = True
    before = np.empty(len(inside), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(inside), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends


def within(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift
