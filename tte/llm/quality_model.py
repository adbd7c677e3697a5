"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every document becomes a fixed vector of statistics of its whole text, computed for all documents in
one pass. The trees are fitted on a bounded sample of the labelled vectors (``SAMPLE_ROWS``, the rows
with the smallest hashes of their ids), so fitting costs the same at any corpus size: values are
binned at quantiles, each level of a tree sums gradients per (node, feature, bin), and the best
cut of each node splits it. The fitted trees are flattened into arrays of feature, cut, children and
value, and a batch of documents walks all trees at once by indexing those arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.llm.common import written
from tte.llm.textnum import ALNUM, LOWER, U64, binary_column, list_column, prefix_hash, range_hash, run_hash, slices, word_spans

#: Labelled rows that fitting uses at most. The vectors of this many rows fit in the driver (13 MB).
SAMPLE_ROWS = 100_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
MIN_ROWS = 5
CUT = 0.3

FEATURES = (
    "log_bytes", "log_words", "mean_word_bytes", "max_word_bytes", "upper_share", "digit_share", "space_share",
    "non_ascii_share", "stops_per_word", "exclaims_per_word", "bars_per_word", "symbols_per_word", "other_punct_per_word",
    "log_lines", "words_per_line", "distinct_words", "distinct_lines", "distinct_runs", "top_word_share",
    "same_as_before", "ends_in_mark", "capital_words", "mark_only_words", "byte_entropy",
)

_NOT_NEWLINE = np.ones(256, dtype=bool)
_NOT_NEWLINE[0x0A] = False


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_UPPER = _flags(bytes(range(0x41, 0x5B)))
_DIGIT = _flags(bytes(range(0x30, 0x3A)))
_SPACE = _flags(b" \t\n\r\v\f")
_HIGH = _flags(bytes(range(0x80, 0x100)))
_STOPS = _flags(b".,;:?")
_SYMBOLS = _flags(b"#*$%&<>")
_OTHER = ~(ALNUM | _SPACE | _STOPS | _SYMBOLS | _flags(b"!|"))


def _distinct(doc: np.ndarray, value: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the number of distinct values and the largest number of equal ones."""
    key, n = np.unique((doc.astype(U64) << U64(44)) | (value >> U64(20)), return_counts=True)
    owner = (key >> U64(44)).astype(np.int64)
    most = np.zeros(docs, dtype=np.int64)
    np.maximum.at(most, owner, n)
    return np.bincount(owner, minlength=docs), most


def statistics(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text (float32); all zero for an empty text."""
    docs = len(bounds) - 1
    size = np.diff(bounds).astype(np.float64)
    of_byte = np.repeat(np.arange(docs), np.diff(bounds))

    def count(flags):
        return np.bincount(of_byte, weights=flags[buf], minlength=docs)

    starts, ends, doc = word_spans(buf, bounds)
    sums = prefix_hash(buf)
    words = range_hash(sums, starts, ends)
    n = np.bincount(doc, minlength=docs).astype(np.float64)
    wide = ends - starts
    longest = np.zeros(docs)
    np.maximum.at(longest, doc, wide)
    line_starts, line_ends, line_doc = word_spans(buf, bounds, _NOT_NEWLINE)
    lines = np.bincount(line_doc, minlength=docs).astype(np.float64)
    line_kinds, _ = _distinct(line_doc, range_hash(sums, line_starts, line_ends), docs)
    kinds, most = _distinct(doc, words, docs)
    runs = run_hash(words, 3)
    whole = doc[: len(runs)] == doc[2:] if len(runs) else np.zeros(0, bool)
    run_kinds, _ = _distinct(doc[: len(runs)][whole], runs[whole], docs)
    same = np.bincount(doc[1:], weights=(words[1:] == words[:-1]) & (doc[1:] == doc[:-1]), minlength=docs) if len(doc) else np.zeros(docs)
    marks = np.concatenate(([0], np.cumsum(~ALNUM[buf])))
    ends_mark = np.bincount(doc, weights=~ALNUM[buf[ends - 1]], minlength=docs)
    capital = np.bincount(doc, weights=_UPPER[buf[starts]] & (_UPPER[buf[np.minimum(starts + 1, np.maximum(ends - 1, 0))]]), minlength=docs)
    only = np.bincount(doc, weights=marks[ends] - marks[starts] == wide, minlength=docs)
    pair, times = np.unique(of_byte.astype(np.int64) << 8 | buf, return_counts=True)
    share = times / size[pair >> 8]
    entropy = np.bincount(pair >> 8, weights=-share * np.log2(share), minlength=docs)
    per_word, per_byte = np.maximum(n, 1), np.maximum(size, 1)
    out = np.column_stack((
        np.log1p(size), np.log1p(n), np.bincount(doc, weights=wide, minlength=docs) / per_word, longest, count(_UPPER) / per_byte,
        count(_DIGIT) / per_byte, count(_SPACE) / per_byte, count(_HIGH) / per_byte, count(_STOPS) / per_word,
        count(_flags(b"!")) / per_word, count(_flags(b"|")) / per_word, count(_SYMBOLS) / per_word, count(_OTHER) / per_word,
        np.log1p(lines), n / np.maximum(lines, 1), kinds / per_word, line_kinds / np.maximum(lines, 1),
        run_kinds / np.maximum(n - 2, 1), most / per_word, same / per_word, ends_mark / per_word, capital / per_word,
        only / per_word, entropy))
    return out.astype(np.float32)


def _statistics_batches(batches):
    for batch in batches:
        data, offs = binary_column(batch, "text")
        rows = [statistics(data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo]) for lo, hi in slices(offs)]
        if rows:
            x = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc")), list_column(x.ravel(), np.full(len(x), x.shape[1]), pa.float32())],
                names=["doc", "x"])


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` and the vector ``x`` of every row; null texts count as empty."""
    own = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    return own.mapInArrow(_statistics_batches, f"doc {dict(own.dtypes)['doc']}, x array<float>")


@dataclass
class FlatTrees:
    """Boosted trees as arrays over all nodes: a node sends rows with ``x[feature] <= cut`` to ``left``;
    a leaf is its own child."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        out = np.full(len(x), self.base)
        if len(self.roots):
            rows = np.arange(len(x))[:, None]
            node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.cut[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            out = out + self.value[node].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-out))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> FlatTrees:
    """Logistic boosting on binned values. Without rows of both labels the score is constant: the one
    label's smoothed share, or one half without any row."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "cut", "left", "right", "value")}
    roots: list[int] = []
    if len(np.unique(y)) == 2:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]).astype(np.int64)
        margin = np.full(len(y), base)

        def new() -> int:
            for k, v in (("feature", 0), ("cut", np.inf), ("left", len(nodes["cut"])), ("right", len(nodes["cut"])), ("value", 0.0)):
                nodes[k].append(v)
            return len(nodes["cut"]) - 1

        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = y - p, p * (1 - p)
            roots.append(new())
            level, at = [roots[-1]], np.zeros(len(y), dtype=np.int64)  # at: place in the level, -1 in a leaf
            leaf = np.full(len(y), roots[-1])
            for _ in range(depth):
                live = at >= 0
                if not live.any():
                    break
                width, where = len(level), at[live]
                g, h = grad[live], hess[live]
                best = [(1e-6, None)] * width
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    slot = where * (bins + 1) + binned[live, f]
                    sg, sh, sn = (np.bincount(slot, w, width * (bins + 1)).reshape(width, -1).cumsum(axis=1) for w in (g, h, None))
                    tg, th, tn = sg[:, -1:], sh[:, -1:], sn[:, -1:]
                    gain = sg ** 2 / (sh + RIDGE) + (tg - sg) ** 2 / (th - sh + RIDGE) - tg ** 2 / (th + RIDGE)
                    gain = np.where((sn >= MIN_ROWS) & (tn - sn >= MIN_ROWS), gain, -1)[:, : len(c)]
                    pick = gain.argmax(axis=1)
                    for i in range(width):
                        if gain[i, pick[i]] > best[i][0]:
                            best[i] = (gain[i, pick[i]], (f, int(pick[i])))
                below, to_left, to_right = [], np.full(width, -1), np.full(width, -1)
                for i, (_, found) in enumerate(best):
                    if found:
                        f, b = found
                        node = level[i]
                        nodes["feature"][node], nodes["cut"][node] = f, cuts[f][b]
                        nodes["left"][node], nodes["right"][node] = new(), new()
                        to_left[i], to_right[i] = len(below), len(below) + 1
                        below += [nodes["left"][node], nodes["right"][node]]
                feature = np.array([b[1][0] if b[1] else 0 for b in best])
                bound = np.array([b[1][1] if b[1] else 0 for b in best])
                left = binned[np.flatnonzero(live), feature[where]] <= bound[where]
                at[live] = np.where(left, to_left[where], to_right[where])
                level = below
                moved = at >= 0
                if level:
                    leaf[moved] = np.array(level)[at[moved]]
            total_g = np.bincount(leaf, grad, len(nodes["cut"]))
            total_h = np.bincount(leaf, hess, len(nodes["cut"]))
            values = rate * total_g / (total_h + RIDGE)
            for i in np.unique(leaf):
                nodes["value"][i] = float(values[i])
            margin += values[leaf]
    array = {k: np.array(v, dtype=np.float64 if k in ("cut", "value") else np.int64) for k, v in nodes.items()}
    return FlatTrees(**array, roots=np.array(roots, dtype=np.int64), depth=depth, base=base)


def learn(vectors: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", sample: int = SAMPLE_ROWS) -> FlatTrees:
    """Fit on the labelled vectors (``doc, x``); null labels and ids are left out. Beyond ``sample``
    labelled rows those with the smallest id hashes are used."""
    own = labels.select(F.col(key).alias("doc"), F.col(label).cast("double").alias("y")).where("doc is not null and y is not null")
    rows = (vectors.join(own, "doc").select("x", "y", F.xxhash64("doc").alias("h"), "doc")
            .orderBy("h", "doc", "y", "x").limit(sample).select("x", "y").toArrow())
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, len(FEATURES))
    return fit_trees(x.astype(np.float32), rows.column("y").to_numpy())


def classify(vectors: DataFrame, model: FlatTrees, cut: float = CUT) -> DataFrame:
    """``vectors`` with ``score`` (0 to 1) and ``predicted`` (1 from ``cut`` on) in place of ``x``."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)  # a few thousand nodes, fixed by TREES and DEPTH

    @F.pandas_udf("double")
    def score(x):
        import pandas as pd

        return pd.Series(shared.value.score(np.stack(x.to_numpy()).astype(np.float32)) if len(x) else np.zeros(0))

    return vectors.withColumn("score", score("x")).drop("x").withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key, held_out, score, predicted``; only rows for which ``held_out`` (a
    function of the id column) is false teach the model. Null and empty texts are scored as texts
    without words, repeated rows alike, rows without an id too. Other columns are not read."""
    vectors = written(document_statistics(docs, key, text), "quality-vectors")
    model = learn(vectors.where(~held_out(F.col("doc"))), labels, key)
    return (classify(vectors, model)
            .select(F.col("doc").alias(key), held_out(F.col("doc")).alias("held_out"), "score", "predicted"))
