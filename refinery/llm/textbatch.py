"""Whole columns of text as numpy arrays: bytes, words, word hashes and word shingles.

Everything here works on one block of an Arrow batch at a time. A block holds rows of about
``BLOCK_BYTES``; a longer text is a block of its own, so no text is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0xD6E8FEB86659FD93  # base of the polynomial word hash
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of the splitmix64 generator: spreads 64-bit values evenly."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(x + _GOLDEN * np.uint64(salt + 1))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (from 0) of a string column; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, name: str, limit: int = 4 * BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text, so that work on a run stays small."""
    sizes = pc.binary_length(batch.column(name)).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    row = 0
    while row < batch.num_rows:
        end = max(int(np.searchsorted(total, total[row] + limit, "right")) - 1, row + 1)
        yield batch.slice(row, end - row)
        row = end


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of each run of rows of at most ``limit`` bytes (or one row)."""
    data, offsets = string_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and each row's offsets into them."""
    inside = ~_SPACE[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    before[edges] = False
    after = np.concatenate((inside[1:], [False])) if len(data) else inside.copy()
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _letters(fold: bool) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
    if fold:
        table[65:91] = table[97:123]
    return table


_TABLES = {fold: _letters(fold) for fold in (False, True)}
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        made = []
        for base in (_ODD, _ODD_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps))
        _powers = made[0], made[1]
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit hash of each byte span; with ``fold`` A-Z count as a-z.

    The spans are in order. Those of about ``BLOCK_BYTES`` are hashed at a time.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(int(np.searchsorted(ends, base + BLOCK_BYTES, "right")), first + 1)
        a, b = starts[first:last] - base, ends[first:last] - base
        up, down = _powers_to(int(b[-1]))
        with np.errstate(over="ignore"):
            sums = np.zeros(b[-1] + 1, np.uint64)
            np.cumsum(_TABLES[fold][data[base : base + b[-1]]] * up[: b[-1]], out=sums[1:])
            out[first:last] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        first = last
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Each row's sorted distinct hashes of ``size`` consecutive words, A-Z folded.

    A row of fewer words has its whole sequence as its only shingle, one without words none.
    """
    starts, ends, rows = words(data, offsets)
    hashes = span_hashes(data, starts, ends, fold=True)
    weights = mix(np.arange(1, size + 1, dtype=np.uint64))
    weights |= np.uint64(1)
    with np.errstate(over="ignore"):
        n = max(len(hashes) - size + 1, 0)
        whole = np.full(n, size, np.uint64)
        for i in range(size):
            whole += hashes[i : i + n] * weights[i]
        whole = mix(whole)
        sets = []
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            if b - a >= size:
                sets.append(np.unique(whole[a : b - size + 1]))
            elif b > a:
                part = (hashes[a:b] * weights[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                sets.append(mix(np.array([part], np.uint64)))
            else:
                sets.append(np.empty(0, np.uint64))
    return sets
