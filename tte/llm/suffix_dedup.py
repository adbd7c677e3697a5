"""Exact removal of repeated passages by induced suffix sorting of bounded shards.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. Sorting every
suffix of the corpus is not needed for that, only of the places where a repeat can be:

1. Every window of ``length`` bytes has an anchor: the 40-byte gram in it with the smallest hash
   (leftmost on a tie). Equal windows have equal anchors at equal offsets, and consecutive windows
   mostly share one, so a text of ``n`` bytes has about ``n / 80`` runs (anchor, first window, number
   of windows). Spark counts the anchors' hashes; a run whose anchor stands in one place only cannot
   hold a repeat. Nothing is lost: two equal windows have anchors with the same hash.
2. The bytes of each remaining run are a segment. Equal segments of one anchor are kept once, with
   their number. All segments of an anchor go to one shard, so every pair of equal windows meets.
3. Each shard is sorted by ``suffix_sort`` (induced sorting with common prefixes on disk-backed
   queues) in blocks of about ``BLOCK_BYTES``; a window is repeated if its suffix shares ``length``
   bytes with a neighbour in sorted order.
4. Repeated windows go back to their texts, are merged into maximal runs and cut out.

An anchor whose distinct segments exceed ``HOT_SEGMENTS`` (a passage inside a large part of all
documents, each time between other words) would make one shard grow with the corpus. Its windows are
counted one by one instead, by a 128-bit hash and with map-side sums: the same windows are found, and
no task holds the group.

Copies of a whole text are found by its MD5 and processed once; each copy is removed whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.llm.common import drop_frame, small_side, written
from tte.llm.suffix_sort import sorted_neighbours
from tte.llm.textnum import U64, binary_column, list_column, mix64, powers, prefix_hash, slices

LENGTH = 200
GRAM = 40
BLOCK_BYTES = 3 << 20
HOT_SEGMENTS = 20_000
#: Longer texts are read in pieces of this many windows, so that a position fits the tie-break bits.
PIECE = 4 << 20
_LOW = U64((1 << 24) - 1)


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    fill = -len(values) % width
    blocks = np.concatenate((values, np.full(fill, np.iinfo(np.uint64).max, U64))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1: width - 1 + n])


def anchor_runs(buf: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows that share an anchor: text number, first window (from the text's start),
    number of windows, hash of the anchor's gram."""
    empty = np.zeros(0, np.int64)
    if len(buf) < length:
        return empty, empty, empty, empty.astype(U64)
    sums = prefix_hash(buf)
    at = np.arange(len(buf) - gram + 1)
    hashes = mix64((sums[gram:] - sums[:-gram]) * powers(len(buf))[1][: len(at)])
    least = _window_minimum((hashes & ~_LOW) | at.astype(U64), length - gram + 1)
    anchor = (least & _LOW).astype(np.int64)
    start = np.arange(len(anchor))
    doc = np.searchsorted(bounds, start, side="right") - 1
    whole = start + length <= bounds[doc + 1]
    start, doc, anchor = start[whole], doc[whole], anchor[whole]
    if not len(start):
        return empty, empty, empty, empty.astype(U64)
    heads = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    counts = np.diff(np.append(heads, len(start)))
    return doc[heads], start[heads] - bounds[doc[heads]], counts, hashes[anchor[heads]]


def _pieces(offs: np.ndarray, length: int, limit: int = 1 << 20):
    """Slices of whole texts, and of pieces of texts longer than ``PIECE``: yields the byte range, the
    bounds within it, the row of each piece and its first byte's position in the text."""
    for lo, hi in slices(offs, limit):
        size = int(offs[hi] - offs[lo])
        if hi - lo > 1 or size <= PIECE + length:
            yield int(offs[lo]), int(offs[hi]), offs[lo: hi + 1] - offs[lo], np.arange(lo, hi), np.zeros(hi - lo, np.int64)
        else:
            for s in range(0, size - length + 1, PIECE):
                e = min(size, s + PIECE + length - 1)
                yield (int(offs[lo]) + s, int(offs[lo]) + e, np.array([0, e - s], np.int64), np.array([lo]),
                       np.array([s], np.int64))


def _anchors_of(length: int):
    def run(batches):
        for batch in batches:
            data, offs = binary_column(batch, "text")
            rows, firsts, counts, hashes = [], [], [], []
            for a, b, bounds, row, base in _pieces(offs, length):
                doc, first, n, h = anchor_runs(data[a:b], bounds, length)
                rows.append(row[doc])
                firsts.append(first + base[doc])
                counts.append(n)
                hashes.append(h)
            rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            per_row = np.bincount(rows, minlength=batch.num_rows)
            cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("key")),
                list_column(cat(hashes, U64).view(np.int64), per_row, pa.int64()),
                list_column(cat(firsts, np.int32), per_row, pa.int32()),
                list_column(cat(counts, np.int32), per_row, pa.int32())], names=["key", "h", "first", "n"])
    return run


def _segments_of(length: int):
    def run(batches):
        for batch in batches:
            data, offs = binary_column(batch, "text")
            runs = batch.column(batch.schema.get_field_index("runs"))
            keys = batch.column(batch.schema.get_field_index("key"))
            flat = runs.flatten()
            row = np.repeat(np.arange(batch.num_rows), runs.value_lengths().to_numpy())
            first = flat.field("first").to_numpy()
            n = flat.field("n").to_numpy()
            begin = offs[row] + first
            raw = memoryview(data)
            step = 4096
            for i in range(0, len(row), step):
                j = slice(i, i + step)
                pieces = [bytes(raw[b: b + m + length - 1]) for b, m in zip(begin[j].tolist(), n[j].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(row[j])), flat.field("h").slice(i, step), pa.array(first[j], pa.int32()),
                    pa.array(n[j], pa.int32()), pa.array([hashlib.md5(p).digest() for p in pieces], pa.binary()),
                    pa.array(pieces, pa.binary())], names=["key", "h", "first", "n", "content", "bytes"])
    return run


def repeated_in_block(pieces: list, windows: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each piece of text the windows (of its first ``windows[i]``) that occur twice in the block."""
    sizes = np.array([len(p) + 1 for p in pieces])
    text = np.empty(int(sizes.sum()) + 1, dtype=np.uint16)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    raw = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
    text[:-1] = raw.astype(np.uint16) + 2
    text[starts[1:] - 1] = 1
    text[-1] = 0
    used = np.bincount(text, minlength=258) > 0
    alphabet = int(used.sum())
    if alphabet > 256:
        raise ValueError("more than 254 distinct bytes in a block: not UTF-8")
    text = (np.cumsum(used) - 1).astype(np.uint8)[text]
    repeated = np.zeros(len(text), dtype=bool)
    for pos, lcp in sorted_neighbours(text, alphabet, length):
        hit = np.flatnonzero(lcp[1:] >= length) + 1
        repeated[pos[hit]] = True
        repeated[pos[hit - 1]] = True
    return [np.flatnonzero(repeated[s: s + n]) for s, n in zip(starts[:-1].tolist(), windows.tolist(), strict=True)]


def _to_runs(windows: np.ndarray):
    """First and number of each run of consecutive numbers."""
    if not len(windows):
        return windows, windows
    heads = np.flatnonzero(np.concatenate(([True], np.diff(windows) > 1)))
    return windows[heads], np.diff(np.append(heads, len(windows)))


def _sort_shards(length: int, block_bytes: int):
    """Sort the segments of a partition, which come ordered by anchor, in blocks of whole anchors."""
    def flush(held):
        found = repeated_in_block([b for _, _, _, _, b in held], np.array([n for _, _, n, _, _ in held]), length)
        h, content, first, count = [], [], [], []
        for (anchor, md5, n, places, _), windows in zip(held, found, strict=True):
            f, c = (np.array([0]), np.array([n])) if places > 1 else _to_runs(windows)
            h += [anchor] * len(f)
            content += [md5] * len(f)
            first += f.tolist()
            count += c.tolist()
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(content, pa.binary()), pa.array(first, pa.int32()),
                                           pa.array(count, pa.int32())], names=["h", "content", "off", "m"])

    def anchors(batches):
        """The rows of one anchor at a time."""
        group = []
        for batch in batches:
            for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                             for c in ("h", "content", "n", "places", "bytes")), strict=True):
                if group and row[0] != group[-1][0]:
                    yield group
                    group = []
                group.append(row)
        if group:
            yield group

    def run(batches):
        held, size = [], 0
        for group in anchors(batches):
            more = sum(len(row[4]) for row in group)
            if held and size + more > block_bytes:
                yield flush(held)
                held, size = [], 0
            held += group
            size += more
        if held:
            yield flush(held)
    return run


def _single_windows(length: int):
    """One row per window of a hot segment, with the window's hash."""
    def run(batches):
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("h", "content", "n", "bytes")]
            for h, content, n, b in zip(*cols, strict=True):
                yield pa.RecordBatch.from_arrays([
                    pa.array([h] * n, pa.int64()), pa.array([content] * n, pa.binary()), pa.array(range(n), pa.int32()),
                    pa.array([hashlib.md5(b[i: i + length]).digest() for i in range(n)], pa.binary())],
                    names=["h", "content", "off", "window"])
    return run


def _cut(length: int):
    """Cut the covered bytes of each text out."""
    def run(batches):
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("key", "text", "runs")]
            out = []
            for key, text, runs in zip(*(c.to_pylist() for c in cols), strict=True):
                spans = sorted((r["first"], r["first"] + r["n"] + length - 1) for r in runs)
                kept, at, removed, n = [], 0, 0, 0
                i = 0
                while i < len(spans):
                    s, e = spans[i]
                    while i + 1 < len(spans) and spans[i + 1][0] <= e:
                        i += 1
                        e = max(e, spans[i][1])
                    kept.append(text[at:s])
                    at, removed, n, i = e, removed + e - s, n + 1, i + 1
                out.append((key, removed, n, b"".join(kept) + text[at:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.binary()))],
                names=["key", "n_removed", "n_spans", "kept"])
    return run


def cut_texts(docs: DataFrame, text: str = "text", length: int = LENGTH, block_bytes: int = BLOCK_BYTES,
              hot: int = HOT_SEGMENTS) -> DataFrame:
    """One row per distinct text that loses bytes: ``key`` (MD5 of its bytes), ``n_removed``,
    ``n_spans`` and ``kept``, the bytes that stay. Texts in no row lose nothing: null, empty and
    shorter texts, and those without a repeated window. Copies of a text of ``length`` bytes or more
    lose everything."""
    own = (docs.select(F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
           .where(F.octet_length("text") >= length).withColumn("key", F.unhex(F.md5("text"))))
    runs = written(own.mapInArrow(_anchors_of(length), "key binary, h array<bigint>, first array<int>, n array<int>")
                   .selectExpr("key", "inline(arrays_zip(h, first, n))"), "rep-anchors")
    place = F.xxhash64("key", "first")
    # written, so that the join below reads two plain shuffles, whose hot anchors the skew join splits
    twice = written(runs.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b").select("h"), "rep-twice")
    candidates = runs.join(twice, "h").groupBy("key").agg(F.collect_set(F.struct("first", "n", "h")).alias("runs"))
    whole = own.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    texts = written(whole.join(candidates, "key"), "rep-texts")
    drop_frame(runs)
    drop_frame(twice)
    segments = written(texts.select("key", "text", "runs")
                       .mapInArrow(_segments_of(length), "key binary, h bigint, first int, n int, content binary, bytes binary"),
                       "rep-segments")
    distinct = written(segments.groupBy("h", "content").agg(F.first("bytes").alias("bytes"), F.first("n").alias("n"),
                                                            F.count(F.lit(1)).alias("places")), "rep-distinct")
    size = distinct.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    crowded = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > hot).select("h")
    shards = max(1, -(-size // block_bytes))
    found = (distinct.join(crowded, "h", "left_anti").select("h", "content", "n", "places", "bytes")
             .repartition(int(shards), "h").sortWithinPartitions("h")
             .mapInArrow(_sort_shards(length, block_bytes), "h bigint, content binary, off int, m int"))
    if not crowded.isEmpty():
        single = written(distinct.join(crowded, "h").select("h", "content", "n", "bytes", "places")
                         .mapInArrow(_single_windows(length), "h bigint, content binary, off int, window binary"), "rep-windows")
        single = single.join(distinct.select("h", "content", "places"), ["h", "content"])
        often = single.groupBy("window").agg(F.sum("places").alias("k")).where("k > 1").select("window")
        found = found.unionByName(single.join(often, "window").select("h", "content", "off", F.lit(1).alias("m")))
    found = written(found, "rep-found")
    spans = (segments.select("key", "h", "first", "content").join(found, ["h", "content"])
             .groupBy("key").agg(F.collect_list(F.struct((F.col("first") + F.col("off")).alias("first"), F.col("m").alias("n")))
                                 .alias("runs")))
    cut = (texts.where("copies = 1").select("key", "text").join(spans, "key").select("key", "text", "runs")
           .mapInArrow(_cut(length), "key binary, n_removed bigint, n_spans bigint, kept binary"))
    copied = (own.groupBy("key").agg(F.max(F.octet_length("text")).cast("long").alias("n_removed"), F.count(F.lit(1)).alias("k"))
              .where("k > 1").select("key", "n_removed", F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept")))
    out = written(cut.unionByName(copied), "rep-cut")
    for table in (texts, segments, distinct, found):
        drop_frame(table)
    return out


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, **how) -> DataFrame:
    """Every input row with all its columns, plus ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``
    (binary): the text's UTF-8 bytes without those that repeat.

    Null texts count as empty. Repeated rows are copies of each other and lose everything if long
    enough. An empty table gives an empty result. The four added columns come last; a table that has
    columns of these names gets them twice, so pack its rows in a struct first. Only texts that change
    are shuffled, unless they are too many for their keys to be broadcast."""
    changed = cut_texts(docs, text, length, **how)
    raw = F.coalesce(F.col("_rep_row")[text].cast("binary"), F.lit(b""))
    rows = docs.select(F.struct("*").alias("_rep_row")).withColumn("key", F.unhex(F.md5(raw)))
    keys = small_side(written(changed.select("key"), "rep-keys"))
    cut = rows.join(keys, "key", "left_semi").join(changed, "key")
    whole = (rows.join(keys, "key", "left_anti")
             .select("key", "_rep_row", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), raw.alias("kept")))
    return cut.unionByName(whole).select("_rep_row.*", F.octet_length(raw).cast("long").alias("n_bytes"), "n_removed", "n_spans", "kept")


def repeat_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, **how) -> DataFrame:
    """Per row ``key, n_bytes, n_removed, n_spans`` and the SHA-256 of the bytes kept; as
    ``remove_repeats``, but no text is shuffled for it."""
    changed = cut_texts(docs, text, length, **how).select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    own = docs.select(F.col(key).alias("doc"), F.unhex(F.md5(raw)).alias("key"),
                      F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole"))
    return (own.join(changed, "key", "left")
            .select(F.col("doc").alias(key), "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256")))
