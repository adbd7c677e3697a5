"""Scoring by an interpolated modified Kneser-Ney bigram model.

Counting, in Spark, over all training rows:

1. Words are counted by their 64-bit hash and stored as sorted hash arrays with their counts, cut into
   shards by range; a word's number is its rank.
2. Bigrams (context number, word number) are counted per batch, packed, and shuffled by a hash of the
   pair, so that a frequent context is spread over all shards. Each shard becomes a sorted array of
   pairs with their counts, and hands on what it holds per context and per word.
3. Those partial sums are shuffled by ranges of numbers and become, for each word, its total as a
   context, the number of its continuations by count (1, 2, 3 and more) and the number of contexts it
   follows.

The arrays lie in the shared folder; the driver sees only their names, sizes and the counts of counts.
Workers memory-map them and look whole batches up by binary search.

Probability: ``p(w|u) = max(c(u,w) - D(c), 0) / c(u) + g(u) * p1(w)`` with the three discounts D of
modified Kneser-Ney estimated from the counts of counts, ``g(u)`` what they take from ``u``, and ``p1``
the same on the number of distinct contexts of ``w``, interpolated with ``1 / (V + 1)``, which is all
an unknown word has. An unknown context has ``p1`` alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.llm.common import drop_frame, scratch_path, written
from tte.llm.files import mapped_arrays, unique_name, write_arrays
from tte.llm.textnum import LOWER, U64, binary_column, gathered, mix64, prefix_hash, range_hash, slices, word_spans

#: Words per range of the vocabulary and bigrams (before merging) per shard: what one task holds.
SHARD_WORDS = 1_000_000
SHARD_PAIRS = 2_000_000
#: Bytes of text whose bigrams are counted together before they are sent.
COUNT_BYTES = 12 << 20
END = np.int64(0x7E57E4D0F7E87E57)
ALPHA = 0.1


def tokens(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words in lower case, then one end per text) and the tokens' bounds."""
    low = LOWER[buf]
    starts, ends, doc = word_spans(low, bounds)
    n = np.bincount(doc, minlength=len(bounds) - 1) + 1
    cuts = np.concatenate(([0], np.cumsum(n)))
    out = np.full(cuts[-1], END, dtype=np.int64)
    out[np.arange(len(starts)) + doc] = range_hash(prefix_hash(low), starts, ends).view(np.int64)
    return out, cuts


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Discounts for counts 1, 2 and 3 or more; where a count of counts is 0, half the count."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [i - (i + 1) * y * b / a if a else i / 2 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(x, 0.0), float(i)) for i, x in enumerate(d, 1))


def _discounted(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(c - np.array([0.0, *d])[np.minimum(c, 3)], 0.0)


def _pack(ids: np.ndarray, *values: np.ndarray) -> bytes:
    """Ascending numbers as differences, and small values, byte plane by byte plane, compressed."""
    deltas = np.diff(ids, prepend=np.int64(0)).astype("<i8")
    planes = [deltas.view(np.uint8).reshape(-1, 8).T.ravel()] + [v.astype("<i8").view(np.uint8).reshape(-1, 8).T.ravel() for v in values]
    return len(ids).to_bytes(8, "little") + pa.compress(np.concatenate(planes).tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, width: int) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(pa.decompress(blob[8:], 8 * n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, 8, n)
    out = [np.ascontiguousarray(p.T).view("<i8").ravel() for p in raw]
    out[0] = np.cumsum(out[0])
    return out


def _summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return [keys[heads], *(np.add.reduceat(v[order], heads) if len(heads) else v for v in values)]


def _texts(batches):
    """Slices of texts with their rows: ``batch, lo, hi, tokens, bounds``."""
    for batch in batches:
        data, offs = binary_column(batch, "text")
        for lo, hi in slices(offs, 2 << 20):
            yield batch, lo, hi, *tokens(data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo])


def _word_counts(batches):
    for batch in gathered(batches, "text", COUNT_BYTES):
        held = [np.unique(t, return_counts=True) for *_, t, _ in _texts([batch])]
        if held:
            h, n = _summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])


def _write_words(folder: str):
    def run(batches):
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if parts:
            h, n = (np.concatenate([p[i] for p in parts]) for i in range(2))
            if len(h):
                path = unique_name(folder, "words")
                write_arrays(path, h, n)
                yield pa.RecordBatch.from_pylist([{"path": path, "size": len(h), "first": int(h[0]), "total": int(n.sum())}])
    return run


@dataclass
class BigramModel:
    """Names and sizes of the arrays, and the figures the probabilities need."""

    words: list[tuple[str, int, int]] = field(default_factory=list)  # path, size, first hash
    pairs: list[tuple[str, int]] = field(default_factory=list)
    ranges: list[tuple[str, int]] = field(default_factory=list)
    total: int = 0
    size: int = 0
    step: int = SHARD_WORDS
    pair_discounts: tuple = (0.5, 1.0, 1.5)
    word_discounts: tuple = (0.5, 1.0, 1.5)
    kinds: int = 0
    word_counts: tuple = (0, 0, 0)

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and training count of each word hash; unknown words have number -1 and count 0."""
        kinds, back = np.unique(hashes, return_inverse=True)
        number, count = np.full(len(kinds), -1, dtype=np.int64), np.zeros(len(kinds), dtype=np.int64)
        cuts = np.searchsorted(kinds, np.array([f for _, _, f in self.words], dtype=np.int64))
        base = 0
        for i, (path, size, _) in enumerate(self.words):
            part = slice(cuts[i], cuts[i + 1] if i + 1 < len(cuts) else len(kinds))
            if part.start < part.stop:
                h, n = mapped_arrays(path, size, "<i8", "<i8")
                at = np.minimum(np.searchsorted(h, kinds[part]), size - 1)
                known = h[at] == kinds[part]
                number[part] = np.where(known, base + at, -1)
                count[part] = np.where(known, n[at], 0)
            base += size
        return number[back], count[back]

    def contexts(self, hashes: np.ndarray, bounds: np.ndarray):
        """Context and word number of each token, and the word's count; a text's first context is the
        number after the last word's."""
        number, count = self.numbers(hashes)
        before = np.empty_like(number)
        before[1:] = number[:-1]
        before[bounds[:-1]] = self.size
        return before, number, count

    def of_numbers(self, ids: np.ndarray) -> list[np.ndarray]:
        """Context total, context back-off weight and distinct contexts of each number (0, 1, 0 for -1)."""
        kinds, back = np.unique(ids, return_inverse=True)
        out = [np.zeros(len(kinds)), np.ones(len(kinds)), np.zeros(len(kinds), dtype=np.int64)]
        for j in np.unique(kinds[kinds >= 0] // self.step)[: len(self.ranges)]:
            path, size = self.ranges[j]
            at = np.flatnonzero((kinds >= 0) & (kinds // self.step == j))
            for o, a in zip(out, mapped_arrays(path, size, "<f8", "<f8", "<i8"), strict=True):
                o[at] = a[kinds[at] - j * self.step]
        return [o[back] for o in out]

    def pair_counts(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Training count of each (context, word); 0 if unseen."""
        out = np.zeros(len(context), dtype=np.int64)
        known = np.flatnonzero((context >= 0) & (word >= 0))
        if not len(known) or not self.pairs:
            return out
        kinds, back = np.unique((context[known] << 32) | word[known], return_inverse=True)
        shard, found = _shard(kinds, len(self.pairs)), np.zeros(len(kinds), dtype=np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(len(self.pairs) + 1))
        for s, (path, size) in enumerate(self.pairs):
            mine = order[cuts[s]: cuts[s + 1]]
            if len(mine) and size:
                keys, n = mapped_arrays(path, size, "<i8", "<u4")
                at = np.minimum(np.searchsorted(keys, kinds[mine]), size - 1)
                found[mine] = np.where(keys[at] == kinds[mine], n[at], 0)
        out[known] = found[back]
        return out

    def log10_probabilities(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        _, _, follows = self.of_numbers(word)
        uniform = 1.0 / (self.size + 1)
        if self.kinds:
            spare = sum(d * n for d, n in zip(self.word_discounts, self.word_counts, strict=True)) / self.kinds
            lower = _discounted(follows, self.word_discounts) / self.kinds + spare * uniform
        else:
            lower = np.full(len(word), uniform)
        total, weight, _ = self.of_numbers(context)
        seen = _discounted(self.pair_counts(context, word), self.pair_discounts) / np.maximum(total, 1)
        return np.log10(seen + np.where(total > 0, weight, 1.0) * lower)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(keys.view(U64)) % U64(shards)).astype(np.int64)


def _pair_counts(model: BigramModel, shards: int):
    def flush(held):
        key, n = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
        shard = _shard(key, shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        rows = [(s, _pack(key[order[a:b]], n[order[a:b]])) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                          names=["shard", "packed"])

    def run(batches):
        held, size = [], 0
        for *_, hashes, bounds in _texts(batches):
            before, number, _ = model.contexts(hashes, bounds)
            key = (before << 32) | number
            held.append(np.unique(key, return_counts=True))
            size += 6 * len(key)
            if size >= COUNT_BYTES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)
    return run


_PART = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("size", pa.int64()), ("counts", pa.list_(pa.int64())),
                   ("range", pa.int32()), ("contexts", pa.binary()), ("words", pa.binary())])


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c, 5), minlength=6)[1:5].tolist()


def _merge_pairs(folder: str, step: int):
    """Merge one shard's packed counts, write its arrays, and hand on sums per context and per word."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_unpack(b, 2) for b in table.column("packed").to_pylist()]
        key, n = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        shard = table.column("shard")[0].as_py()
        path = unique_name(folder, f"pairs-{shard}")
        write_arrays(path, key, np.minimum(n, 0xFFFFFFFF).astype("<u4"))
        rows = [{"shard": shard, "path": path, "size": len(key), "counts": _counts_of_counts(n)}]
        contexts = _summed(key >> 32, n, n == 1, n == 2, n >= 3)
        words = _summed(key & 0xFFFFFFFF, np.ones(len(key), dtype=np.int64))
        top = int(max(contexts[0][-1], words[0][-1])) // step
        for j in range(top + 1):
            c, w = (np.searchsorted(x, [j * step, (j + 1) * step]) for x in (contexts[0], words[0]))
            rows.append({"range": j, "contexts": _pack(*[x[c[0]: c[1]].astype(np.int64) for x in contexts]),
                         "words": _pack(*[x[w[0]: w[1]] for x in words])})
        return pa.Table.from_pylist(rows, schema=_PART)
    return run


_RANGE = pa.schema([("range", pa.int32()), ("path", pa.string()), ("size", pa.int64()), ("counts", pa.list_(pa.int64())),
                    ("three", pa.int64()), ("kinds", pa.int64())])


def _merge_range(folder: str, step: int, d: tuple[float, float, float]):
    def run(table: pa.Table) -> pa.Table:
        j = table.column("range")[0].as_py()
        sums = np.zeros((5, step), dtype=np.int64)
        for contexts, words in zip(table.column("contexts").to_pylist(), table.column("words").to_pylist(), strict=True):
            ids, *values = _unpack(contexts, 5)
            for row, v in zip(sums, values, strict=False):
                row[ids - j * step] += v
            ids, n = _unpack(words, 2)
            sums[4][ids - j * step] += n
        total, one, two, three, follows = sums
        weight = (d[0] * one + d[1] * two + d[2] * three) / np.maximum(total, 1)
        path = unique_name(folder, f"range-{j}")
        write_arrays(path, total.astype("<f8"), weight.astype("<f8"), follows.astype("<i8"))
        return pa.Table.from_pylist([{"range": j, "path": path, "size": step, "counts": _counts_of_counts(follows),
                                      "three": int((follows >= 3).sum()), "kinds": int(follows.sum())}], schema=_RANGE)
    return run


def learn(rows: DataFrame, text: str = "text", shard_words: int = SHARD_WORDS, shard_pairs: int = SHARD_PAIRS) -> BigramModel:
    """Count the model from all rows; null texts count as empty. Without rows the model knows nothing
    and gives every token the same probability, 1."""
    folder = scratch_path(rows.sparkSession, "ngrams")
    own = rows.select(F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    words = written(own.mapInArrow(_word_counts, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")), "lm-words")
    size = words.count()
    model = BigramModel(size=size, step=shard_words)
    if not size:
        return model
    found = (words.repartitionByRange(-(-size // shard_words), "h").sortWithinPartitions("h")
             .mapInArrow(_write_words(folder), "path string, size long, first long, total long").collect())
    drop_frame(words)
    model.words = sorted(((r["path"], r["size"], r["first"]) for r in found), key=lambda w: w[2])
    model.total = sum(r["total"] for r in found)
    shards = -(-model.total // shard_pairs)
    parts = written(own.mapInArrow(_pair_counts(model, shards), "shard int, packed binary").groupBy("shard").applyInArrow(
        _merge_pairs(folder, shard_words),
        "shard int, path string, size long, counts array<long>, range int, contexts binary, words binary"), "lm-parts")
    held = {r["shard"]: r for r in parts.where("path is not null").select("shard", "path", "size", "counts").collect()}
    model.pairs = [(held[s]["path"], held[s]["size"]) if s in held else ("", 0) for s in range(shards)]
    model.pair_discounts = discounts(*np.sum([r["counts"] for r in held.values()], axis=0).tolist())
    ranges = (parts.where("path is null").select("range", "contexts", "words").groupBy("range").applyInArrow(
        _merge_range(folder, shard_words, model.pair_discounts),
        "range int, path string, size long, counts array<long>, three long, kinds long").collect())
    drop_frame(parts)
    model.ranges = [(r["path"], r["size"]) for r in sorted(ranges, key=lambda r: r["range"])]
    counts = np.sum([r["counts"] for r in ranges], axis=0).tolist()
    model.word_discounts = discounts(*counts)
    model.kinds = sum(r["kinds"] for r in ranges)
    model.word_counts = (counts[0], counts[1], sum(r["three"] for r in ranges))
    return model


def _score(model: BigramModel):
    def run(batches):
        for batch in batches:
            out = []
            for *_, hashes, bounds in _texts([batch]):
                before, number, count = model.contexts(hashes, bounds)
                base = np.log10((count + ALPHA) / (model.total + ALPHA * (model.size + 1)))
                score = model.log10_probabilities(before, number)
                add = lambda v: np.add.reduceat(v, bounds[:-1])  # noqa: E731, B023  every text has an end token
                out.append((np.diff(bounds), add((count > 0).astype(np.int64)), add(base), add(score)))
            if out:
                n, known, base, score = (np.concatenate([o[i] for o in out]) for i in range(4))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("doc")), batch.column(batch.schema.get_field_index("held_out")),
                     pa.array(n), pa.array(known), pa.array(base), pa.array(score)],
                    names=["doc", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def lm_scores(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """One row per document: ``key, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity``, learned from the rows that are not held out.

    Null and empty texts are one end token. Repeated rows each count in training and get equal scores;
    rows without an id are scored like others. An empty table gives an empty result. Only the named
    columns are read."""
    own = docs.select(F.col(key).alias("doc"), held_out.alias("held_out"), F.col(text).alias("text"))
    model = learn(own.where(~F.col("held_out")), **sizes)
    kind = dict(own.dtypes)["doc"]
    return (own.withColumn("text", F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
            .mapInArrow(_score(model), f"doc {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
            .select(F.col("doc").alias(key), "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                    "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")))
