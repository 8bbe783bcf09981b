"""Word and n-gram hashes computed on whole Arrow string buffers with numpy.

All helpers work on a *slice*: some consecutive texts of an Arrow batch, at
most ``SLICE_BYTES`` long unless one text alone is longer. Texts are never cut.
Words are maximal runs of bytes that are not ASCII white space (0x20, 0x09 to
0x0D); bytes of multi-byte UTF-8 characters are word bytes, so the words equal
those of the pattern ``[^\\x20\\x09-\\x0D]+`` over code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 4 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))
_rng = np.random.default_rng(20240607)
_BYTE_CODES = [_rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1) for _ in range(2)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Tables(dict):
    """A memo that is empty again in every task: its tables don't travel with the functions that use it."""

    def __reduce__(self):
        return _Tables, ()


_powers: dict[int, np.ndarray] = _Tables()


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        have = _powers[int(base)] = np.cumprod(table, dtype=np.uint64)
    return have[:n]


def schema_with(field: StructField, ddl: str) -> StructType:
    """``field`` (whatever the names inside it), then the columns of ``ddl``."""
    return StructType([StructField(field.name, field.dataType, True), *StructType.fromDDL(ddl).fields])


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every input bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def string_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts have length 0."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not (pa.types.is_string(arr.type) or pa.types.is_binary(arr.type)):
        arr = arr.cast(pa.string())
    _, offs, data = arr.buffers()
    if len(arr) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offsets = np.frombuffer(offs, np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows so that the texts of a piece stay near ``limit`` bytes."""
    n = batch.num_rows
    if n == 0:
        return
    _, offsets = string_buffer(batch.column(column))
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield batch.slice(lo, hi - lo)
        lo = hi


@dataclass
class Words:
    """Words of a slice: byte spans, owning row and first word of each row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray  # len rows + 1: words of row r are first[r] .. first[r+1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def position(self) -> np.ndarray:
        return np.arange(len(self.row)) - self.first[self.row]


def words(arr: pa.Array, lower: bool = False, separators: np.ndarray | None = None) -> Words:
    """Words of every text; ``lower`` maps A-Z to a-z; ``separators`` replaces the white-space table."""
    data, offsets = string_buffer(arr)
    if lower and len(data):
        data = _LOWER[data]
    space = (_SPACE if separators is None else separators)[data] if len(data) else np.zeros(0, bool)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = ~space
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    starts = np.flatnonzero(word & (before | edge[:-1]))
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, starts, ends, row, first)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, variant: int = 0) -> np.ndarray:
    """64-bit hash of every byte span (``variant`` 0 or 1: independent byte codes)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[variant][data] * _power_table(_BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power_table(_BASE_INV, len(data) + 1)[starts]
    return mix(h ^ (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def word_hashes(w: Words, variant: int = 0) -> np.ndarray:
    return span_hashes(w.data, w.starts, w.ends, variant)


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words (runs across rows included; mask them with ``whole``)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = np.zeros(n, np.uint64)
    for j in range(k):
        g *= _U(0xA24BAED4963EE407)
        g += h[j : j + n]
    return mix(g)


def whole(row: np.ndarray, k: int) -> np.ndarray:
    """True where a run of k words lies in one row."""
    n = len(row) - k + 1
    return row[:n] == row[k - 1 :] if n > 0 else np.zeros(0, bool)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum (mod 2^64) of ``values`` over each row's range."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def row_hashes(h: np.ndarray, w: Words, salt: int = 0) -> np.ndarray:
    """Hash of each row's word sequence (order matters)."""
    scale = _power_table(_BASE, int(w.counts.max(initial=0)) + 1)[w.position()]
    return mix(row_sums(mix(h ^ _U(salt)) * scale, w.first) ^ w.counts.astype(np.uint64))


def winnow(g: np.ndarray, ok: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of every ``width`` consecutive values.

    ``ok[i]`` says whether the window that starts at i lies in one row; other
    windows get -1. Two equal windows pick the same place, so equal runs share
    an anchor.
    """
    n = len(ok)
    if n == 0:
        return np.zeros(0, np.int64)
    least = g[:n].copy()
    for o in range(1, width):
        np.minimum(least, g[o : o + n], out=least)
    at = np.full(n, -1, np.int64)
    base = np.arange(n)
    for o in range(width - 1, -1, -1):
        np.copyto(at, base + o, where=g[o : o + n] == least)
    at[~ok] = -1
    return at


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """Distinct values of a non-decreasing array."""
    if len(values) == 0:
        return values
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """True at the first row of every group of equal neighbours."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


def whole_groups(batches, keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Numpy columns of a stream that is sorted by ``keys``, cut between groups.

    Only the group that is still open is held back, so memory is one batch and
    one group.
    """
    held: dict[str, np.ndarray] | None = None
    for b in batches:
        if b.num_rows == 0:
            continue
        cols = {name: b.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(b.schema.names)}
        if held is not None:
            cols = {c: np.concatenate([held[c], v]) for c, v in cols.items()}
        last = int(np.flatnonzero(group_starts(*(cols[k] for k in keys)))[-1])
        if last:
            yield {c: v[:last] for c, v in cols.items()}
        held = {c: v[last:] for c, v in cols.items()}
    if held is not None:
        yield held
