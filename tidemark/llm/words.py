"""Words and word shingles of whole Arrow batches, found and hashed with numpy on the UTF-8 bytes.

A word is a maximal run of bytes outside a set of ASCII separators, so cutting bytes cuts whole characters. Words never cross
texts. Hashes are 64 bits, alike in every task; whoever needs exact equality compares the bytes or strings afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BASE, _STEP = 0x9E3779B97F4A7C15, _U(0xD6E8FEB86659FD93)
_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(0xA0761D6478BD642F)) | _U(1)


def _separators(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: ASCII white space parts words; words are kept as they are.
SPACES = _separators((0x09, 0x0D), (0x20, 0x20))
#: All ASCII but digits and letters parts words; ASCII letters count as lower case.
SYMBOLS = _separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

_EXACT = _BYTES
_FOLDED = _BYTES.copy()
_FOLDED[0x41:0x5B] = _BYTES[0x61:0x7B]


class Words(NamedTuple):
    """Words of some texts: byte span and hash of each, and where each text's words begin (one entry more than texts)."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string or binary column into (first row, end row, bytes, offsets); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    rows = len(column)
    if not rows:
        return
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int32, rows + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    row = 0
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, _U), np.cumprod(np.full(max(n - 1, 0), _BASE, _U))])[:n]


_KNOWN: dict[str, np.ndarray] = {"powers": _powers(4096)}


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A polynomial in each word's bytes; the sums of a block of words are differences of one running sum."""
    out = np.empty(len(starts), _U)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SLICE_BYTES, "right")))
        low, high = int(starts[a]), int(ends[b - 1])
        begin = np.zeros(high - low, np.int64)
        begin[starts[a:b] - low] = starts[a:b] - low
        power = np.arange(high - low) - np.maximum.accumulate(begin)
        longest = int(power.max()) + 1
        if longest > len(_KNOWN["powers"]):
            _KNOWN["powers"] = _powers(longest)
        total = np.zeros(high - low + 1, _U)
        np.cumsum(values[data[low:high]] * _KNOWN["powers"][power], out=total[1:])
        out[a:b] = total[ends[a:b] - low] - total[starts[a:b] - low]
        a = b
    return mix(out + (ends - starts).astype(_U) * _STEP)


def find(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES, fold: bool = False) -> Words:
    """The words of the texts that `offsets` cut out of `data`; `fold` takes A-Z as a-z."""
    inside = ~separators[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    low, high = offsets[:-1][filled], offsets[1:][filled] - 1
    start[low], end[high] = inside[low], inside[high]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets), _hash(data, starts, ends, _FOLDED if fold else _EXACT))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every `size` consecutive words, by the place of their first word, and which of them stay inside one text."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, bool)
    out = words.hashes[:n].copy()
    for j in range(1, size):
        out *= _STEP
        out += words.hashes[j : j + n]
    text = np.repeat(np.arange(len(words.first) - 1), words.counts)
    return mix(out ^ _U(size)), text[:n] == text[size - 1 : size - 1 + n]


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return hashes.view(np.int64)


def lists(values: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Consecutive runs of `values`, one list of each count."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))
