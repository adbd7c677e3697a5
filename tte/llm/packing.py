"""Packing of tokenized documents into sequences of fixed length by bounded-space best fit.

A document is its token ids followed by one end id, cut into pieces of ``capacity`` ids if it is longer.
Each task packs its pieces online: a fixed number of open bins lies in a bitset keyed by free space (one
bit for each amount of free space that some open bin has), so the tightest bin that takes a piece is the
lowest set bit from the piece's length on. If no bin takes it, a bin is opened; beyond ``open_bins`` the
fullest open one closes first. Whole pieces of ``capacity`` ids are bins of their own.

The bins still open when a task ends are not lost as half-empty sequences: they are packed again, each as
one item as long as what it holds, by the same rule in few large tasks. Only (bin, length) rows move for
that. So what is wasted does not grow with the number of input tasks.

Tokens are computed once per distinct part of a batch's texts: the tokenizer never joins text across white
space, nor Latin letters with digits or signs, so a text's ids are those of its parts, one after the other.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.llm.common import small_side, written
from tte.llm.textnum import LOWER, binary_column, gathered, list_column, slices

CAPACITY = 2048
OPEN_BINS = 512
END_ID = 0
#: Open bins that one task of the second round packs.
BINS_A_TASK = 200_000
#: Bytes of text whose tokens a task holds at once; a longer text is held alone.
TEXT_BYTES = 2 << 20
#: Parts of texts that a worker remembers the ids of; then it forgets all of them.
MEMO_RUNS = 400_000
_MEMO_BYTES = 64


class Bins:
    """Open bins of one packer. ``put`` gives the number of the bin and the place in it."""

    def __init__(self, capacity: int, open_bins: int, first: int = 0):
        self.capacity, self.limit, self.next = capacity, open_bins, first
        self.mask, self.by_free, self.open = 0, {}, 0

    def put(self, length: int) -> tuple[int, int]:
        free = self.capacity
        if length == free:
            self.next += 1
            return self.next - 1, 0
        above = self.mask >> length
        if above:
            free = length + (above & -above).bit_length() - 1
            number = self._take(free)
        else:
            number, self.next = self.next, self.next + 1
        if free > length:
            self._keep(free - length, number)
            if self.open > self.limit:
                self._take((self.mask & -self.mask).bit_length() - 1)
        return number, self.capacity - free

    def _keep(self, free: int, number: int) -> None:
        self.by_free.setdefault(free, []).append(number)
        self.mask |= 1 << free
        self.open += 1

    def _take(self, free: int) -> int:
        same = self.by_free[free]
        number = same.pop()
        if not same:
            del self.by_free[free]
            self.mask &= ~(1 << free)
        self.open -= 1
        return number

    def still_open(self) -> list[tuple[int, int]]:
        """(bin, ids in it) of the bins with free space that may take more."""
        return [(number, self.capacity - free) for free, same in sorted(self.by_free.items()) for number in same]


#: Kinds of ASCII bytes and of the bytes of U+00C0 to U+00FF: white space, letter, digit, anything else.
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
for _a, _b, _k in ((0x41, 0x5B, 1), (0x61, 0x7B, 1), (0x80, 0x100, 1), (0x30, 0x3A, 2)):
    _KIND[_a:_b] = _k
#: Bytes whose run is tokenized as it stands: apostrophes (contractions), ``<`` (special tokens) and the
#: first bytes of characters beyond U+00FF, which need not be letters.
_WHOLE = np.zeros(256, dtype=bool)
_WHOLE[[0x27, 0x3C, 0xC2, *range(0xC4, 0x100)]] = True


class RunTokens:
    """Ids of texts by their distinct parts. A part is a run of non-white-space or, where a run has Latin
    letters, digits and ASCII signs only, a run of one of these kinds in it with A-Z as a-z: the tokenizer
    cuts there itself and lower-cases before it looks anything up."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        # part 0 stands for the end of a text
        self.flat, self.first, self.size = np.array([END_ID], np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64)

    def _numbers(self, parts: list[bytes]) -> np.ndarray:
        """The parts' places in ``first`` and ``size``."""
        if len(self.known) > MEMO_RUNS:
            self._forget()
        new = [p for p in parts if p not in self.known]
        sizes, ids = [], [self.flat]
        for at in range(0, len(new), 4096):
            some = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in new[at: at + 4096]], add_special_tokens=False)]
            sizes += map(len, some)
            ids.append(np.fromiter(chain.from_iterable(some), np.uint32))
        if new:
            self.known.update(zip(new, range(len(self.size), len(self.size) + len(new)), strict=True))
            more = np.array(sizes, dtype=np.int64)
            self.first = np.concatenate((self.first, len(self.flat) + np.cumsum(more) - more))
            self.size = np.concatenate((self.size, more))
            self.flat = np.concatenate(ids)
        out = np.array([self.known[p] for p in parts], dtype=np.int64)
        for p in new:
            if len(p) > _MEMO_BYTES:
                del self.known[p]
        return out

    def ids(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts with the end id after each text, and each text's bounds in them; ``bounds``
        are the texts' offsets in their UTF-8 bytes ``buf``."""
        docs = len(bounds) - 1
        low, kind = LOWER[buf], _KIND[buf]
        begins = np.zeros(len(buf) + 1, dtype=bool)
        begins[bounds] = True
        begins = begins[:-1]
        ink = kind > 0
        begins |= np.append(True, ~ink[:-1]) if len(buf) else begins
        begins &= ink
        runs = np.flatnonzero(begins)
        if len(runs):
            whole = _WHOLE[buf]
            whole[1:] |= (buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))
            whole = np.logical_or.reduceat(whole & ink, runs)
            inner = np.append(False, kind[1:] != kind[:-1]) & ink
            if whole.any():
                # a run kept whole is given as it is: lower case would make other special tokens
                kept = whole[np.maximum(np.cumsum(begins) - 1, 0)]
                inner &= ~kept
                low = np.where(kept, buf, low)
            begins |= inner
        starts = np.flatnonzero(begins)
        text = np.searchsorted(bounds, starts, side="right") - 1
        place = np.concatenate((np.cumsum(ink)[starts] - 1, [np.count_nonzero(ink)])) if len(buf) else np.zeros(1, np.int64)
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(place.astype(np.int64)), pa.py_buffer(low[ink])])
        parts = parts.dictionary_encode()
        number = self._numbers(parts.dictionary.to_pylist())[parts.indices.to_numpy(zero_copy_only=False)] if len(starts) else np.zeros(0, np.int64)
        ends = np.cumsum(np.bincount(text, minlength=docs))
        order = np.insert(number, ends, 0)
        counts = self.size[order]
        upto = np.concatenate(([0], np.cumsum(counts)))
        out = self.flat[np.repeat(self.first[order] - upto[:-1], counts) + np.arange(upto[-1])]
        return out, upto[np.concatenate(([0], ends + np.arange(1, docs + 1)))]


_TOKENS: dict[str, RunTokens] = {}


def worker_tokens(tokenizer_path: str) -> RunTokens:
    """The parts that this worker knows, kept for its next task."""
    if tokenizer_path not in _TOKENS:
        _TOKENS[tokenizer_path] = RunTokens(tokenizer_path)
    return _TOKENS[tokenizer_path]


def _pack_batches(tokenizer_path: str, capacity: int, open_bins: int, with_ids: bool):
    def run(batches):
        tokens, task = worker_tokens(tokenizer_path), TaskContext.get().partitionId()
        # 2 ** 40 bins a task and 2 ** 23 tasks
        bins = Bins(capacity, open_bins, task << 40)
        for batch in gathered(batches, "text", TEXT_BYTES):
            data, offs = binary_column(batch, "text")
            for lo, hi in slices(offs, TEXT_BYTES):
                part = batch.slice(lo, hi - lo)
                ids, bounds = tokens.ids(data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo])
                n = np.diff(bounds)
                pieces = (n + capacity - 1) // capacity
                row = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                at = bounds[:-1][row] + start
                # what is at hand arrives longest first, which leaves the short pieces for the gaps
                order = np.argsort(-length, kind="stable")
                placed = np.zeros((len(length), 2), dtype=np.int64)
                placed[order] = np.array([bins.put(x) for x in length[order].tolist()], dtype=np.int64).reshape(-1, 2)
                crc = [zlib.crc32(ids[a: a + m].astype("<u4", copy=False).data) for a, m in zip(at, length, strict=True)]
                columns = {"key": part.column("key").take(pa.array(row)), "piece": pa.array(piece, pa.int32()),
                           "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                           "ids_crc32": pa.array(crc, pa.int64()), "bin": pa.array(placed[:, 0]), "place": pa.array(placed[:, 1]),
                           "still": pa.nulls(len(row), pa.bool_())}
                if with_ids:  # the pieces lie one after the other in ids
                    columns["ids"] = list_column(ids.astype(np.int32), length, pa.int32())
                yield pa.RecordBatch.from_pydict(columns)
        left = bins.still_open()
        if left:
            number, used = (np.array(x, dtype=np.int64) for x in zip(*left, strict=True))
            columns = {"key": pa.nulls(len(left), batch.schema.field("key").type), "piece": pa.nulls(len(left), pa.int32()),
                       "start": pa.nulls(len(left), pa.int64()), "length": pa.array(used), "ids_crc32": pa.nulls(len(left), pa.int64()),
                       "bin": pa.array(number), "place": pa.nulls(len(left), pa.int64()), "still": pa.array([True] * len(left))}
            if with_ids:
                columns["ids"] = pa.nulls(len(left), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
    return run


def _pack_bins(capacity: int, open_bins: int):
    def run(batches):
        # numbers of this round lie below those of the tasks before it
        bins = Bins(capacity, open_bins, -((TaskContext.get().partitionId() + 1) << 40))
        for batch in batches:
            placed = np.array([bins.put(x) for x in batch.column("length").to_pylist()], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict({"bin": batch.column("bin"), "sequence_id": pa.array(placed[:, 0]), "shift": pa.array(placed[:, 1])})
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   open_bins: int = OPEN_BINS, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32, sequence_id, offset`` and, ``with_ids``,
    the piece's token ids ``ids array<int>``.

    ``start`` counts the document's ids before the piece; ``ids_crc32`` is that of the ids as little-endian
    unsigned 32-bit numbers; pieces lie in a sequence without gaps from offset 0, and no sequence holds more
    than ``capacity`` ids. Sequence ids are distinct, not consecutive and may be negative.

    Null and empty texts, and texts of white space only, are the end id alone: one piece of one id. Very long texts are tokenized
    whole, one at a time. Rows are packed as they are: rows that repeat an id or a text, and rows without an
    id, each give their own pieces. An empty table gives an empty result. Only ``key`` and ``text`` are read,
    so further columns, whatever their names, do not matter. ``tokenizer_path`` is a file on every worker."""
    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = (f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, place bigint, still boolean"
              + (", ids array<int>" if with_ids else ""))
    packed = written(own.mapInArrow(_pack_batches(tokenizer_path, capacity, open_bins, with_ids), schema), "pack-pieces")
    left = packed.where("still").select("bin", "length")
    n = left.count()
    # a hash of the bin deals tasks' bins of all sizes to every packer, in an order that does not depend on the run
    again = (left.withColumn("h", F.xxhash64("bin")).repartitionByRange(max(1, -(-n // BINS_A_TASK)), "h").sortWithinPartitions("h", "bin")
             .select("bin", "length"))
    moved = small_side(written(again.mapInArrow(_pack_bins(capacity, open_bins), "bin bigint, sequence_id bigint, shift bigint"), "pack-bins"), n)
    return (packed.where("still is null").join(moved, "bin", "left")
            .select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", F.coalesce("sequence_id", "bin").alias("sequence_id"),
                    (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"), *(["ids"] if with_ids else [])))
