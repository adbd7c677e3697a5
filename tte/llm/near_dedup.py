"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A document is the set of its five-word shingles, weighted by how often each occurs. The similarity is
the probability Jaccard: the sum over the shared shingles d of
``1 / sum over all d' of max(wA(d') / wA(d), wB(d') / wB(d))``, which is the Jaccard similarity when
all weights are equal, and does not change when a text is repeated as a whole.

Signature: each shingle runs a Poisson process whose rate is its weight. Its arrivals carry times and
pick registers at random, both derived from the shingle alone; each register keeps the shingle of its
earliest arrival. All shingles take their first arrival, then their second, and so on; a shingle stops
as soon as its time is beyond the latest of all registers (early termination). Two documents hold the
same shingle in a register with a probability equal to their probability Jaccard.

Banding: 25 bands of 5 registers; documents that agree in a band are candidates (a pair at similarity
0.8 is missed with a probability of 5e-5, at 0.9 with 1e-10).

Verification: candidates are compared by their exact similarity. Nodes are word sequences, so exact copies
are one node. Documents in one bucket are not paired with each other: every bucket's members are compared
with one hub (the member with the most company), and the links merge classes. What matters afterwards are
only pairs whose ends are still in different classes, and none of those is left out: in buckets of up to
``SMALL`` members they are compared pair by pair; larger buckets are cut into blocks, and each pair of
blocks is one group of bounded size, compared by matrix products that hand on only the links that join
classes. Links between classes are contracted with the classes as nodes, not with all links again.

A bucket whose members the hub joins, as those of near copies mostly are, makes one row a member. One with ``s``
members that stay apart costs what comparing them all costs: each of its sets goes to ``s / BLOCK`` groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.llm.common import drop_written, paths_of, scratch_now, small_side, written
from tte.llm.graph import components
from tte.llm.textnum import (LOWER, U64, binary_column, gathered, list_column, mix64, prefix_hash, range_hash, run_hash,
                             slices, word_spans)

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 25
ROWS = 5
SMALL = 32
BLOCK = 256
BLOCK_SHINGLES = 200_000
_GOLD = U64(0x9E3779B97F4A7C15)


def weighted_shingles(buf: np.ndarray, bounds: np.ndarray, k: int = SHINGLE):
    """``(document, shingle, weight)`` in order of document and shingle, and per document the number of
    words and two hashes of its word sequence. Words end at ASCII white space; A-Z count as a-z. A
    text of one to ``k - 1`` words has one shingle, its whole word sequence."""
    low = LOWER[buf]
    starts, ends, doc = word_spans(low, bounds)
    docs = len(bounds) - 1
    words = range_hash(prefix_hash(low), starts, ends)
    n_words = np.bincount(doc, minlength=docs)
    first = np.concatenate(([0], np.cumsum(n_words)))
    grams = run_hash(words, k)
    inside = doc[: len(grams)] == doc[k - 1:] if len(grams) else np.zeros(0, bool)
    place = np.arange(len(words), dtype=U64) - first[doc].astype(U64)
    whole = [np.add.reduceat(np.append(mix64(words + (place + U64(s)) * _GOLD), U64(0)), first[:-1]) for s in (1, 1 << 40)]
    whole = [np.where(n_words > 0, mix64(w + n_words.astype(U64)), U64(0)) for w in whole]
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    owner = np.concatenate((doc[: len(grams)][inside], short)).astype(U64)
    value = np.concatenate((grams[inside], whole[0][short]))
    # a document has at most a few million shingles: 44 bits tell them apart
    key, weight = np.unique((owner << U64(44)) | (value >> U64(20)), return_counts=True)
    return (key >> U64(44)).astype(np.int64), key & U64((1 << 44) - 1), weight, n_words, whole


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, size: int = BANDS * ROWS) -> np.ndarray:
    """Registers of each document: the shingle of the earliest arrival (0 for a document without any)."""
    time = np.full(docs * size, np.inf)
    held = np.zeros(docs * size, dtype=U64)
    at, who, elem, rate = np.zeros(len(doc)), doc, shingle, weight.astype(np.float64)
    arrival = 0
    while len(who):
        arrival += 1
        draw = mix64(mix64(elem + _GOLD) + np.array([arrival], U64) * _GOLD)
        at = at - np.log(((draw >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate
        slot = who * size + (mix64(draw) % U64(size)).astype(np.int64)
        np.minimum.at(time, slot, at)
        won = time[slot] == at
        held[slot[won]] = elem[won]
        if arrival % 4 == 1:  # a stale, later bound only lets a shingle go on for longer
            latest = time.reshape(docs, size).max(axis=1)
        alive = at < latest[who]
        at, who, elem, rate = at[alive], who[alive], elem[alive], rate[alive]
    return held.reshape(docs, size)


_SIGNED = "row bigint, doc bigint, digest string, a bigint, b bigint, n_words bigint, bands array<bigint>"


def _signature_batches(k: int):
    def run(batches):
        row = TaskContext.get().partitionId() << 40
        # a short text takes hundreds of turns, which all texts of a batch share
        for batch in gathered(batches, "text", 4 << 20):
            data, offs = binary_column(batch, "text")
            parts = []
            for lo, hi in slices(offs):
                doc, *rest = weighted_shingles(data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo], k)
                parts.append((doc + lo, *rest))
            doc, shingle, weight, n_words = (np.concatenate([p[i] for p in parts]) for i in range(4))
            a, b = (np.concatenate([p[4][i] for p in parts]) for i in range(2))
            held = signatures(doc, shingle, weight, batch.num_rows).reshape(-1, BANDS, ROWS)
            bands = np.zeros(held.shape[:2], dtype=U64) + np.arange(1, BANDS + 1, dtype=U64)
            for r in range(ROWS):
                bands = mix64(bands * _GOLD + held[:, :, r])
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row - batch.num_rows, row)), batch.column("doc"), batch.column("digest"), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                pa.array(n_words.astype(np.int64)), list_column(bands.ravel().view(np.int64), np.full(len(a), BANDS), pa.int64())],
                names=["row", "doc", "digest", "a", "b", "n_words", "bands"])
    return run


def _shingle_batches(k: int):
    def run(batches):
        for batch in batches:
            data, offs = binary_column(batch, "text")
            for lo, hi in slices(offs):
                buf, bounds = data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo]
                doc, shingle, weight, _, _ = weighted_shingles(buf, bounds, k)
                counts = np.bincount(doc, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([
                    batch.column(batch.schema.get_field_index("node")).slice(lo, hi - lo),
                    list_column(shingle.view(np.int64), counts, pa.int64()),
                    list_column(weight.astype(np.int32), counts, pa.int32())], names=["node", "s", "w"])
    return run


def probability_jaccard(sa: np.ndarray, wa: np.ndarray, sb: np.ndarray, wb: np.ndarray) -> float:
    """Exact similarity of two weighted sets; the element arrays are sorted and without repeats."""
    common, ia, ib = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if wa.max() == 1 and wb.max() == 1:
        return len(common) / (len(sa) + len(sb) - len(common))
    xa, xb = wa[ia].astype(np.float64), wb[ib].astype(np.float64)
    only_a, only_b = wa.sum() - xa.sum(), wb.sum() - xb.sum()
    pairs, inverse = np.unique(np.column_stack((xa, xb)), axis=0, return_inverse=True)
    counts = np.bincount(inverse.ravel())
    total = 0.0
    for (p, q), m in zip(pairs, counts, strict=True):
        total += m / (only_a / p + only_b / q + float((np.maximum(pairs[:, 0] / p, pairs[:, 1] / q) * counts).sum()))
    return total


def _compare(threshold: float):
    def run(batches):
        for batch in batches:
            col = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            flat = {n: (col[n].flatten().to_numpy(), np.concatenate(([0], np.cumsum(col[n].value_lengths().to_numpy()))))
                    for n in ("sa", "wa", "sb", "wb")}
            keep = []
            for i in range(batch.num_rows):
                part = [v[o[i]: o[i + 1]] for v, o in (flat[n] for n in ("sa", "wa", "sb", "wb"))]
                keep.append(probability_jaccard(*part) >= threshold - 1e-12)
            yield pa.RecordBatch.from_arrays([col["a"], col["b"], pa.array(keep, pa.bool_())], names=["a", "b", "linked"])
    return run


def block_links(node: np.ndarray, root: np.ndarray, left: np.ndarray, right: np.ndarray, sets: list, weights: list,
                threshold: float) -> list[tuple[int, int]]:
    """Pairs of roots of the left and of the right side that links between their documents join: enough of
    them to join all roots that links join.

    With ``m`` the part of one document's weight that lies on the other's shingles, the similarity is
    at most the smaller ``m`` of the two, so only pairs with both at ``threshold`` go further."""
    rows = np.repeat(np.arange(len(node)), [len(x) for x in sets])
    kinds, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.flatnonzero(np.bincount(column) > 1)
    place = np.full(len(kinds), -1)
    place[shared] = np.arange(len(shared))
    column, total = place[column], np.array([w.sum() for w in weights], dtype=np.float64)
    mass = np.concatenate(weights) / total[rows]
    common, on = np.zeros((len(node), len(node)), np.float32), np.zeros((len(node), len(node)), np.float32)
    step = 4096
    for c in range(0, len(shared), step):
        mine = np.flatnonzero((column >= c) & (column < c + step))
        has, heavy = (np.zeros((len(node), min(step, len(shared) - c)), np.float32) for _ in range(2))
        has[rows[mine], column[mine] - c] = 1
        heavy[rows[mine], column[mine] - c] = mass[mine]
        common += has @ has.T
        on += heavy @ has.T
    near = np.minimum(on, on.T) >= threshold - 1e-3
    near &= left[:, None] & right[None, :] & (root[:, None] != root[None, :]) & (node[:, None] != node[None, :])
    plain, size = np.array([w.max() == 1 for w in weights]), np.array([len(x) for x in sets])
    parent: dict[int, int] = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(near), strict=True):
        x, y = find(int(root[i])), find(int(root[j]))
        if x == y:
            continue
        n = round(float(common[i, j]))
        if plain[i] and plain[j]:
            alike = n / (size[i] + size[j] - n)
        else:
            alike = probability_jaccard(sets[i], weights[i], sets[j], weights[j])
        if alike >= threshold - 1e-12:
            parent[max(x, y)] = min(x, y)
            links.append((min(x, y), max(x, y)))
    return links


def _compare_blocks(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block = table.column("block").to_numpy()
        lists = [[np.array(x, dtype=np.int64) for x in table.column(c).to_pylist()] for c in ("s", "w")]
        links = block_links(table.column("node").to_numpy(), table.column("root").to_numpy(), block == i, block == j, *lists, threshold)
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})
    return run


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``doc, digest, class_key, class_id`` of every row: its id, its text's digest (``text_digest``), a number that
    all rows of one class share (null: a text without words, which is never linked) and the smallest id in
    the class (null if none of its rows has an id)."""
    spark, before = docs.sparkSession, scratch_now()
    own = docs.select(F.col(key).cast("long").alias("doc"), text_digest(F.col(text)).alias("digest"),
                      F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    signed = written(own.mapInArrow(_signature_batches(k), _SIGNED), "near-signatures")
    # nodes are word sequences: all rows that share one are linked
    groups = signed.where("n_words > 0").groupBy("a", "b").agg(
        F.min(F.struct("row", "digest")).alias("x"), F.first("bands").alias("bands"), F.min("doc").alias("least"))
    nodes = written(groups.select("a", "b", F.col("x.row").alias("node"), F.col("x.digest").alias("digest"), "bands", "least"), "near-nodes")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = written(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-shared")
    members = written(buckets.join(small_side(shared), "bucket"), "near-members")
    # the hub of a bucket is the member with the most company in all its buckets
    company = written(members.groupBy("node").agg(F.sum("size").alias("company")), "near-company")
    active = nodes.join(company, "node", "left_semi").select("node", "digest")
    sets = written(own.select("digest", "text").join(small_side(written(active, "near-active")), "digest").mapInArrow(
        _shingle_batches(k), "node bigint, s array<bigint>, w array<int>")
        .groupBy("node").agg(F.first(F.struct("s", "w")).alias("x")).select("node", "x.s", "x.w"), "near-sets")

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a < b) that are similar."""
        left = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"), F.col("w").alias("wa"))
        right = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"), F.col("w").alias("wb"))
        judged = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "wa", "sb", "wb").mapInArrow(
            _compare(threshold), "a bigint, b bigint, linked boolean")
        return written(judged.where("linked").select("a", "b"), "near-links")

    hub = F.max(F.struct("company", (-F.col("node")).alias("h")))
    hubs = members.join(small_side(company), "node").groupBy("bucket").agg(hub.alias("x")).select("bucket", (-F.col("x.h")).alias("hub"))
    pairs = members.join(small_side(written(hubs, "near-hubs")), "bucket").where("node <> hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    roots = small_side(written(components(linked(pairs)), "near-roots"))

    # what is left to compare: members of one bucket that are not in one class yet
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = placed.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("bucket")
    rest = written(placed.join(small_side(written(split, "near-split")), "bucket"), "near-rest")
    edges = members.sparkSession.createDataFrame([], "a bigint, b bigint")
    few = rest.where(F.col("size") <= SMALL).select("bucket", "node", "root")
    pairs = written(few.alias("p").join(few.alias("q"), F.expr("p.bucket = q.bucket and p.node < q.node and p.root <> q.root"))
                    .select(F.col("p.node").alias("a"), F.col("q.node").alias("b"), F.col("p.root").alias("ra"), F.col("q.root").alias("rb")).distinct(), "near-pairs")
    if not pairs.isEmpty():
        edges = linked(pairs.select("a", "b")).join(pairs, ["a", "b"]).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    many = rest.where(F.col("size") > SMALL)
    if not many.isEmpty():
        edges = edges.unionByName(_large_buckets(many, sets, threshold))
    # roots are joined by the links between their members
    upper = written(components(edges), "near-upper").select(F.col("node").alias("root"), F.col("root").alias("top"))
    of = signed.where("n_words > 0").join(nodes.select("a", "b", "node", "least"), ["a", "b"])
    of = of.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(small_side(upper), "root", "left").select(
        "row", F.coalesce("top", "root").alias("class_key"), "doc")
    of = written(of, "near-rows")
    ids = of.groupBy("class_key").agg(F.min("doc").alias("class_id"))
    classes = of.select("row", "class_key").join(ids, "class_key")
    final = written(signed.select("row", "doc", "digest").join(classes, "row", "left").select("doc", "digest", "class_key", "class_id"), "near-final")
    drop_written(spark, *(scratch_now() - before - set(paths_of(final))))
    return final


def _large_buckets(many: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between the roots of buckets with more than ``SMALL`` members, every pair of members of different
    roots compared: a bucket is cut into blocks by hash, so many that a block has about ``BLOCK`` documents and
    ``BLOCK_SHINGLES`` shingles, and each pair of blocks is one group. A set goes to as many groups as its
    bucket has blocks."""
    heavy = many.join(sets.select("node", "s", "w"), "node")
    total = heavy.groupBy("bucket").agg(F.sum(F.size("s")).alias("shingles"), F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    cut = many.join(total, "bucket").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root")
    return written(dealt.join(sets, "node").groupBy("bucket", "i", "j").applyInArrow(_compare_blocks(threshold), "a bigint, b bigint"),
                   "near-block-links").distinct()


def text_digest(text: Column) -> Column:
    """Digest by which rows of one text are found again (null counts as empty)."""
    return F.md5(F.coalesce(text.cast("binary"), F.lit(b"")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE,
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``key`` and ``class_id``, the smallest id of the documents linked with it,
    directly or through others; an unlinked document is its own class.

    Documents are linked if their similarity is ``threshold`` or more; equal word sequences always are.
    Null, empty and blank texts have no shingles and are never linked. Texts are compared, not ids: rows that repeat
    an id with different texts each get the class of their own text, and rows without an id take part; a class none of
    whose rows has an id has a null ``class_id``. An empty table gives an empty
    result. Only ``key`` (a whole number) and ``text`` are read."""
    found = near_classes(docs, key, text, k, threshold)
    return found.select(F.col("doc").cast(docs.schema[key].dataType).alias(key),
                        F.when(F.col("class_key").isNull(), F.col("doc")).otherwise(F.col("class_id")).alias("class_id"))
