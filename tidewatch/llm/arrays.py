"""Numpy helpers for text in Arrow columns: buffers, runs, hashes of runs, ragged gathers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that end a word: space and 0x09 to 0x0D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
#: Values that are hashed as one power sum.
_CUT = 256
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def as_strings(column: pa.Array) -> pa.Array:
    """A string column without nulls (null: empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    return column


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the places where its values begin and end."""
    large = pa.types.is_large_string(column.type)
    kind, width = (np.int64, 8) if large else (np.int32, 4)
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * width)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return data[first : int(offsets[-1])], offsets.astype(np.int64) - first


def row_blocks(column: pa.Array, size: int = 1 << 20):
    """Cut rows into (begin, end) ranges of about ``size`` bytes, at least one row each."""
    _, offsets = buffers(column)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1
        end = min(max(end, begin + 1), len(column))
        yield begin, end
        begin = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _reach(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("_powers", _BASE), ("_inverses", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            globals()[name] = np.cumprod(table, dtype=np.uint64)
    return _powers, _inverses


def _hash_short(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverses = _reach(len(values) + 1)
    terms = np.empty(len(values) + 1, np.uint64)
    terms[0] = 0
    np.add(values, 1, out=terms[1:], dtype=np.uint64, casting="unsafe")
    terms[1:] *= powers[: len(values)]
    np.cumsum(terms, out=terms)
    value = (terms[ends] - terms[begins]) * inverses[begins]
    return mix(value ^ ((ends - begins).astype(np.uint64) << np.uint64(48)))


def hash_runs(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[begin:end]``, from one pass over ``values``.

    A power sum modulo 2^64 repeats for some regular sequences of a thousand values or more (a
    Thue-Morse word and its complement), so runs of more than ``_CUT`` values are hashed as the
    sequence of the mixed hashes of their pieces, as often as that takes.
    """
    lengths = ends - begins
    long = np.flatnonzero(lengths > _CUT)
    if not len(long):
        return _hash_short(values, begins, ends)
    out = _hash_short(values, begins, np.minimum(ends, begins + _CUT))
    pieces = -(-lengths[long] // _CUT)
    stops = np.cumsum(pieces)
    at = spans(np.zeros(len(long), np.int64), pieces) * _CUT + np.repeat(begins[long], pieces)
    piece = _hash_short(values, at, np.minimum(at + _CUT, np.repeat(ends[long], pieces)))
    out[long] = mix(hash_runs(piece, stops - pieces, stops) + lengths[long].astype(np.uint64))
    return out


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbours in a sequence of hashes."""
    m = max(0, len(hashes) - n + 1)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(3) + hashes[k : k + m])
    return out


def spans(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of all runs, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    stops = np.cumsum(lengths)
    return np.arange(total) + np.repeat(begins - (stops - lengths), lengths)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the words in each row, and the place of each row's first word."""
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = BLANK[data]
    change = np.flatnonzero(blank[1:] != blank[:-1])
    begins, ends = change[::2], change[1::2]
    # a word that runs over a row's end is cut there
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(data))])
    inner = inner[~blank[inner] & ~blank[inner + 1]]
    if len(inner):
        begins = np.sort(np.concatenate([begins, inner]))
        ends = np.sort(np.concatenate([ends, inner]))
    return begins, ends, np.searchsorted(begins, offsets)
