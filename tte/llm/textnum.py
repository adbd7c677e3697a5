"""Whole-batch text work on Arrow buffers: words, hashes of words and runs of words, as numpy arrays.

Functions here run inside ``mapInArrow`` tasks. They see the UTF-8 bytes of many texts at once as one
array and its offsets, in slices of about a megabyte, so no Python object is made per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = U64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of a word that ends at ASCII white space: everything but 0x20 and 0x09-0x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of letters and digits, with every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[_a:_b] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_CODE = mix64((np.arange(256, dtype=U64) + U64(1)) * _STEP) | U64(1)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the powers 0 to n, and their inverses, modulo 2 ** 64."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums: ``range_hash`` reads the hash of any byte range from them."""
    up, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, dtype=U64)
    np.cumsum(_BYTE_CODE[buf] * up[: len(buf)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * _STEP)


def binary_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, one more than rows) of a binary or string column without nulls."""
    col = batch.column(batch.schema.get_field_index(name))
    wide = pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offs.astype(np.int64)


def gathered(batches, name: str, limit: int):
    """Join consecutive batches until the named column holds about ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += int(np.diff(binary_column(batch, name)[1][[0, -1]])[0])
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Cut rows into runs of about ``limit`` bytes (at least one row each): yields ``lo, hi``."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def word_spans(buf: np.ndarray, bounds: np.ndarray, is_word: np.ndarray = NOT_SPACE):
    """Starts, ends and text number of all words; ``bounds`` are the texts' offsets in ``buf``."""
    inside = is_word[buf]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(buf):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(buf))]
        before[edges] = False
        after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def run_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive values (``len - k + 1`` of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(n, dtype=U64)
    for j in range(k):
        out = out * U64(0xD1342543DE82EF95) + hashes[j: j + n]
    return mix64(out)


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and the number of values in each row."""
    offs = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, type=kind))
