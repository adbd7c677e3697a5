"""Spelling variants by search in a trie of letter counts.

A word becomes a vector: how often it has each letter group, commonest letters first. One inserted,
deleted or replaced letter adds at most one to one count (a surplus) and takes at most one from another
(a deficit). The trie arranges words by their successive counts; a search follows a word's own counts and
spends a budget of one surplus and one deficit on the way down. The words of the leaves it reaches are
verified letter by letter. The descent takes many words at once, as arrays, level by level.

The upper levels of the trie are cells spread over the cluster: every word lies in one cell, and is
sent as a query to the cells that its budget reaches and that come after its own, so each pair of words
meets in exactly one cell. Where the cells are cut is learned from a bounded sample of the words; that
decides the balance only, the cells cover all words and the result does not depend on it. A cell's task
builds the lower levels over its own words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.llm.common import small_side, written

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_FACTOR = 10
#: Levels of the trie: letters from common to rare, and four groups of all other letters by code point.
LEVELS = "etaoinsrhldcumfpgwybvkxjqz"
OTHERS = 4
DEPTH = len(LEVELS) + OTHERS
#: Words that show where the cells are cut (about so many, by their hash), and words meant for a cell: more
#: than ``CELL_WORDS`` only beyond ``CELL_WORDS * MAX_CELLS`` words.
SAMPLE_WORDS = 400_000
CELL_WORDS = 20_000
MAX_CELLS = 20_000
#: Words of a lowest node, which is not split any more.
LEAF_WORDS = 8
#: Queries that go down the trie at once, and pairs verified at once.
QUERIES = 8_192
PAIR_BYTES = 8 << 20

_GROUP = np.array([LEVELS.index(chr(c)) if chr(c) in LEVELS else len(LEVELS) + c % OTHERS for c in range(256)])


class Words:
    """Words of letters up to U+00FF as one array of code points."""

    def __init__(self, column: pa.Array):
        letters = [w.encode("latin-1") for w in column.to_pylist()]
        self.size = np.array([len(x) for x in letters], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(letters), dtype=np.uint8)

    def vectors(self) -> np.ndarray:
        """Counts per group; counts beyond 30,000 are told apart by the verification only."""
        owner = np.repeat(np.arange(len(self.size)), self.size)
        counts = np.bincount(owner * DEPTH + _GROUP[self.flat], minlength=len(self.size) * DEPTH)
        return np.minimum(counts, 30_000).astype(np.int16).reshape(-1, DEPTH)

    def edge(self, n: int, last: bool) -> np.ndarray:
        """The first or last ``n`` letters as one number."""
        out = np.zeros(len(self.size), dtype=np.int64)
        for j in range(n):
            at = self.first + (self.size - 1 - j if last else j)
            out = (out << 8) | self.flat[at]
        return out


class Trie:
    """A trie over sorted vectors. A node with at most ``leaf`` rows, or at the lowest level, is a leaf and
    stands for a range of rows. A count that no child has belongs to the child with the next smaller one
    (else the first), so that a trie over a sample takes every vector."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        rows = len(vectors)
        #: Per level: keys (node << 32 | count) in order, first child of each node, and for each child its
        #: number in the next level (leaves: the complement of their number).
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ranges: list[tuple[int, int]] = []
        starts, ends = np.array([0]), np.array([rows])
        for level in range(vectors.shape[1]):
            if not len(starts) or not rows:
                break
            at = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends, strict=True)])
            node = np.repeat(np.arange(len(starts)), ends - starts)
            key = (node << 32) | vectors[at, level]
            new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            a, b = at[new], at[np.append(new[1:], len(at)) - 1] + 1
            ends_here = (b - a <= leaf) | (level == vectors.shape[1] - 1)
            number = np.cumsum(~ends_here) - 1
            number[ends_here] = ~(len(self.ranges) + np.arange(ends_here.sum()))
            self.ranges += list(zip(a[ends_here].tolist(), b[ends_here].tolist(), strict=True))
            self.levels.append((key[new], np.searchsorted(key[new], np.arange(len(starts)) << 32), number))
            starts, ends = a[~ends_here], b[~ends_here]

    def reached(self, vectors: np.ndarray, budget: int = 1, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of every leaf within the budget of surplus and deficit; ``exact``: only children
        with the very count."""
        query, node = np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
        more, less = np.full(len(vectors), budget), np.full(len(vectors), budget)
        found = []
        for level, (keys, first, number) in enumerate(self.levels):
            parts = []
            last = np.append(first[1:], len(keys)) - 1
            for step in (0, 1, -1):
                go = np.arange(len(query)) if step == 0 else np.flatnonzero((more if step > 0 else less) > 0)
                want = vectors[query[go], level].astype(np.int64) + step
                go, want = go[want >= 0], want[want >= 0]
                key = (node[go] << 32) | want
                child = np.searchsorted(keys, key, side="right") - 1
                if exact:
                    hit = (child >= 0) & (keys[np.maximum(child, 0)] == key)
                    go, child = go[hit], child[hit]
                else:
                    child = np.clip(child, first[node[go]], last[node[go]])
                parts.append((query[go], number[child], more[go] - (step > 0), less[go] - (step < 0)))
            query, node, more, less = (np.concatenate(x) for x in zip(*parts, strict=True))
            done = node < 0
            found.append((query[done], ~node[done]))
            query, node, more, less = (x[~done] for x in (query, node, more, less))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def in_order(vectors: np.ndarray) -> np.ndarray:
    """Row numbers in the vectors' order."""
    return np.lexsort(vectors.T[::-1])


def one_edit(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each pair of different words differs by exactly one letter inserted, deleted or replaced: what
    they share from the left and from the right leaves at most one letter of the longer."""
    out = np.zeros(len(a), dtype=bool)
    order = np.argsort(np.maximum(words.size[a], words.size[b]), kind="stable")
    at = 0
    while at < len(order):
        # pairs of like length together: a chunk is as wide as its longest word
        width = int(max(words.size[a[order[at]]], words.size[b[order[at]]]))
        some = order[at: at + max(1, PAIR_BYTES // (4 * width))]
        longest = np.maximum(words.size[a[some]], words.size[b[some]])
        some = some[: max(1, int(np.searchsorted(longest, 2 * width, side="right")))]
        at += len(some)
        x, y = a[some], b[some]
        short = np.minimum(words.size[x], words.size[y])
        width, shared = int(short.max()), np.zeros(len(some), dtype=np.int64)
        step = np.arange(width)
        inside = step < short[:, None]
        for side in (0, 1):
            i, j = (words.first[w][:, None] + (step if side == 0 else words.size[w][:, None] - 1 - step) for w in (x, y))
            same = inside & (words.flat[np.where(inside, i, 0)] == words.flat[np.where(inside, j, 0)])
            shared += np.where(same.all(axis=1), width, np.argmin(same, axis=1))
        out[some] = (np.abs(words.size[x] - words.size[y]) <= 1) & (shared >= np.maximum(words.size[x], words.size[y]) - 1)
    return out


def near_pairs(words: Words, own: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near words: an ``own`` word with every other, once. Words are distinct."""
    vectors, mine = words.vectors(), np.flatnonzero(own)
    mine = mine[in_order(vectors[mine])]
    trie = Trie(vectors[mine], LEAF_WORDS)
    first, last = (np.array(x, dtype=np.int64) for x in (zip(*trie.ranges, strict=True) if trie.ranges else ((), ())))
    place = np.full(len(own), -1)
    place[mine] = np.arange(len(mine))
    half = min(3, min_length // 2)
    head, tail = words.edge(half, False), words.edge(half, True)
    asking = np.concatenate((mine, np.flatnonzero(~own)))
    left, right = [], []
    for at in range(0, len(asking), QUERIES):
        some = asking[at: at + QUERIES]
        query, leaf = trie.reached(vectors[some], exact=True)
        sizes = last[leaf] - first[leaf]
        q = np.repeat(some[query], sizes)
        to = np.repeat(first[leaf] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        w = mine[to]
        # own words meet once; one edit leaves the head or the tail as it is
        keep = (place[q] < to) & ((head[q] == head[w]) | (tail[q] == tail[w])) & (np.abs(words.size[q] - words.size[w]) <= 1)
        q, w = q[keep], w[keep]
        good = one_edit(words, q, w)
        left.append(q[good])
        right.append(w[good])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


_CELL = "cell int, own boolean, word string, n bigint"


def _send(trie: Trie):
    """Words to the cell each lies in and, as queries, to the later cells within its budget."""

    def run(batches):
        for batch in batches:
            vectors = Words(batch.column("word")).vectors()
            home = np.zeros(batch.num_rows, dtype=np.int64)
            query, cell = trie.reached(vectors, 0)
            home[query] = cell
            query, cell = trie.reached(vectors)
            pair = np.unique((query << 32) | cell)
            query, cell = pair >> 32, pair & 0xFFFFFFFF
            later = cell >= home[query]
            query, cell = query[later], cell[later]
            rows = batch.select(["word", "n"]).take(pa.array(query))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(cell == home[query]), *rows.columns],
                                             names=["cell", "own", "word", "n"])
    return run


def _meet(min_length: int):
    """The words of a cell to what each learns there: its number of near words and the best of them."""

    def run(table: pa.Table) -> pa.Table:
        column, n = table.column("word").combine_chunks(), table.column("n").to_numpy()
        own = table.column("own").combine_chunks().to_numpy(zero_copy_only=False)
        a, b = near_pairs(Words(column), own, min_length)
        word, near = np.concatenate((a, b)), np.concatenate((b, a))
        rank = np.empty(len(column), dtype=np.int64)
        rank[pa.compute.sort_indices(column.cast(pa.binary())).to_numpy()] = np.arange(len(column))
        order = np.lexsort((rank[near], -n[near], word))
        word, near = word[order], near[order]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
        counts = np.diff(np.append(first, len(word)))
        return pa.table({"word": column.take(pa.array(word[first])), "n_near": pa.array(counts, pa.int64()),
                         "best_n": pa.array(n[near[first]], pa.int64()), "best": column.take(pa.array(near[first]))})
    return run


def cell_trie(words: DataFrame, total: int) -> Trie:
    """The upper levels, cut so that a cell has about ``CELL_WORDS`` of the ``total`` words; reads about
    ``SAMPLE_WORDS`` of them."""
    share = min(1.0, SAMPLE_WORDS / max(1, total))
    part = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)))
    vectors = Words(pa.array([r.word for r in part.select("word").toLocalIterator()], pa.string())).vectors()
    return Trie(vectors[in_order(vectors)], max(1, int(share * max(CELL_WORDS, total / MAX_CELLS))))


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``word, n_near, best, best_n`` of the distinct ``words`` (``word, n``) that have a near word, one that
    differs by one letter inserted, deleted or replaced: how many, and the one with the largest ``n`` (ties: the
    least in code-point order). Words have ``min_length`` (2 or more) to any number of letters up to U+00FF."""
    total = words.count()
    if not total:
        return words.select("word", F.lit(0).cast("long").alias("n_near"), F.col("word").alias("best"), F.col("n").alias("best_n"))
    sent = words.select("word", "n").mapInArrow(_send(cell_trie(words, total)), _CELL)
    met = sent.groupBy("cell").applyInArrow(_meet(min_length), "word string, n_near bigint, best_n bigint, best string")
    # the least word among the largest n, by code points
    return (met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form: the last word when forms are followed. Each round
    doubles the steps taken; a form's count is a multiple of the word's, so a few rounds reach all ends."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = small_side(now.select(F.col("word").alias("root"), F.col("root").alias("next")))
        after = written(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                        "spelling-roots")
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame, min_length: int = MIN_LENGTH, factor: int = FORM_FACTOR) -> DataFrame:
    """Distinct words (``word, n``) with their variants: ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of the largest ``n`` (ties: least in code-point order) if that is at least
    ``factor`` times the word's own (2 or more), else null; ``root`` is where forms lead, the word itself if it has none. Rows
    with a null word, and words shorter than ``min_length``, are left out; a word may be as long as any.
    An empty table gives an empty result."""
    own = words.where(F.length("word") >= min_length).select("word", F.col("n").cast("long").alias("n"))
    near = near_words(own, min_length)
    good = F.col("best_n") >= factor * F.col("n")
    found = written(own.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best")).alias("form"),
        F.when(good, F.col("best_n")).alias("form_n")), "spelling-forms")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def damaged_words(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                  every: int = 31) -> DataFrame:
    """``word, n`` of the texts' maximal runs of Latin letters (A-Z as a-z), where the crc32 of ``<key>:<run>``, if
    ``every`` divides it, deletes one letter of the run: those of at least ``min_length`` letters found
    ``min_count`` times or more. Null and empty texts have no words; a null key counts as an empty one; rows that repeat count
    again. Only ``key`` and ``text`` are read; very long texts and runs are taken whole."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # explode_outer: see the decontamination; a shorter run cannot give a word
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
                       F.explode_outer(F.regexp_extract_all(F.col(text), F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{min_length},}})"), F.lit(1))).alias("run"))
    runs = runs.where("run is not null").select("k", F.translate("run", upper, upper.lower()).alias("run"))
    h = F.crc32(F.concat("k", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select("run", h.alias("h")).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def document_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The spelling variants among the damaged words of all texts."""
    return spelling_variants(written(damaged_words(docs, key, text), "spelling-words"))
