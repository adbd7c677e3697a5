"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items hide inside long documents, so the Jaccard similarity of the two is tiny and a
signature of fixed length would miss them. Documents are therefore partitioned by size (the power of two
above their number of distinct shingles), and each partition has its own one-permutation MinHash with
``BINS_PER_SHINGLE`` bins per shingle of its largest document: every shingle is hashed once, the hash's
top bits choose the bin, and the smallest hash of each bin is the signature. An item is signed for
each size partition. Documents and items that agree in a bin are candidates, and the exact containment
of the item's shingle set in the document's decides.

A shared shingle makes a bin of the two agree unless another shingle of the document has a smaller hash
in the same bin, which at two bins a shingle happens to about a fifth of them (``MISS``). So an item that
shares ``m`` shingles is missed with a probability of about ``MISS ** m``. Where that is not negligible at
the threshold (``exact_items``), as for items of few shingles, an exact search stands beside the bins: of any
``n - ceil(threshold * n) + 1`` of an item's ``n`` shingles one has to be in the document, so these items'
smallest hashes, so many of each, are looked up among all shingles. For the other items a miss is less
likely than ``NEGLIGIBLE``.

An item of one to ``k - 1`` words has one shingle, its whole word sequence; documents are searched for
sequences of the lengths that such items have.

Signatures are arrays inside the document's row: nothing is shuffled to build them. What is exploded meets the
items' hashes, one row each whatever the number of partitions, in a join that needs no shuffle while they are
few (checked by a count); beyond that it is an ordinary shuffle join. Tables with arrays are broadcast by the
number of their elements.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.llm.common import small_lists, small_side, written

SHINGLE = 5
THRESHOLD = 0.8
BINS_PER_SHINGLE = 2
#: Size partitions go up to documents of 2 ** 30 distinct shingles.
MAX_CLASS = 30
#: Bound of the share of shared shingles whose bin another shingle of the document takes; the largest miss
#: probability that is left to the bins alone.
MISS = 0.25
NEGLIGIBLE = 1e-9


def _shingles_of(words: Column, k: int) -> Column:
    """Distinct hashes of all runs of ``k`` words (none if there are fewer words)."""
    n = F.size(words)
    return F.when(n >= k, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, k))))
    ).otherwise(F.array().cast("array<bigint>"))


def words_of(text: str) -> Column:
    """Runs of letters and digits in lower case, so that punctuation, case and spacing do not hide a passage."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def item_sets(items: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``item_id, n_words, _set`` of ``item_id, _text``: the distinct hashes of all runs of ``k`` words in ascending order;
    an item of fewer words has the hash of all of them. Items without a word are left out."""
    w = F.col("_words")
    own = F.when(F.size(w) >= k, _shingles_of(w, k)).otherwise(F.array(F.xxhash64(w)))
    return (items.withColumn("_words", words_of("_text")).where(F.size("_words") > 0)
            .select("item_id", F.size("_words").alias("n_words"), F.sort_array(own).alias("_set")).distinct())


def with_shingles(df: DataFrame, text: str, k: int = SHINGLE, short: list[int] = ()) -> DataFrame:
    """Replace the text column by ``_set``, the distinct 64-bit hashes of all runs of ``k`` words in ascending order, and
    ``_short``, those of all runs of the lengths ``short``. Null, empty and shorter texts give empty arrays."""
    runs = F.array().cast("array<bigint>")
    for m in short:
        runs = F.concat(runs, _shingles_of(F.col("_words"), m))
    return (df.withColumn("_words", words_of(text)).withColumn("_set", F.sort_array(_shingles_of(F.col("_words"), k)))
            .withColumn("_short", runs).drop("_words", text))


def size_class(n: Column) -> Column:
    """0 for one shingle, else the exponent of the next power of two. Never null, and declared so: a
    join on a nullable expression gets a filter that repeats the array expressions below it."""
    return F.coalesce(F.ceil(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int"), F.lit(0))


def bin_minima(ordered: str, cls: Column) -> Column:
    """One-permutation MinHash of a sorted array of hashes: the first (smallest) hash of each bin.
    Bins are equal ranges of the hash, ``BINS_PER_SHINGLE * 2 ** cls`` of them, so the array is in
    order of bins already."""
    shift = F.lit(64 - BINS_PER_SHINGLE.bit_length() + 1).cast("int") - cls
    bin_of = lambda h: F.call_function("shiftright", h, shift)
    return F.filter(ordered, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(ordered, i - 1))))


def item_hashes(items: DataFrame) -> DataFrame:
    """``(value, from_cls, item_id)``: each hash of an item's signatures with the first size partition in which it is
    one. Bins halve from one partition to the next, so a hash that is the smallest of its bin stays
    so: it is from the partition on in whose bins it and the next smaller hash part."""
    part = lambda h, i: F.when(i == 0, 0).otherwise(  # noqa: E731  leading bits that the two share
        64 - F.length(F.bin(h.bitwiseXOR(F.get("_set", i - 1)))))
    each = F.transform("_set", lambda h, i: F.struct(h.alias("value"), part(h, i).cast("int").alias("from_cls")))
    return items.select("item_id", F.explode(each).alias("x")).select("x.value", "x.from_cls", "item_id")


def needed(n: Column, threshold: float) -> Column:
    """Shared shingles that an item of ``n`` needs."""
    return F.greatest(F.ceil(F.lit(threshold) * n - 1e-9).cast("int"), F.lit(1))


def exact_items(items: DataFrame, threshold: float = THRESHOLD) -> Column:
    """Whether the bins alone could miss the item: with the fewest shared shingles that it needs, or for want of a
    shingle."""
    sure = math.log(NEGLIGIBLE) / math.log(MISS)
    return needed(F.size("_set"), threshold) < sure


def item_prefixes(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(value, from_cls, item_id)``, ``from_cls`` -1: of each item so many of its smallest hashes that a document which holds none
    of them is below ``threshold``; ``items`` has ``item_id, _set``, none of them empty."""
    n = F.size("_set")
    least = needed(n, threshold)
    return items.where(least <= n).select("item_id", F.explode(F.slice("_set", F.lit(1), n - least + 1)).alias("value")).select(
        "value", F.lit(-1).alias("from_cls"), "item_id")


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
               item_text: str = "text", threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """Pairs of a document and a test item whose shingles the document contains.

    Returns ``key, item_key, n_words, n_shingles`` (of the item), ``n_shared, containment`` for every pair at
    or above ``threshold``. An item of fewer than ``k`` words is one shingle, its whole word sequence; its ``n_words``
    tells it apart, for callers to whom a single common word is no leak. Null and empty texts match nothing. Very
    long texts are searched whole. Repeated rows of one document (or item) give one pair each time the pair of
    ids differs: rows that share an id are one document, whose shingles may lie in any of its rows'
    texts (the best row counts). Rows without an id cannot be reported and are skipped. Empty tables
    give an empty result; only the named columns are read."""
    own = docs.select(F.col(key).alias("doc"), F.col(text).alias("_text")).where("doc is not null")
    tests = written(item_sets(items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("_text")).where("item_id is not null"), k), "leak-items")
    # at most k - 1 numbers
    short = sorted(r[0] for r in tests.where(F.col("n_words") < k).select("n_words").distinct().collect())
    exact = exact_items(tests, threshold)
    bins, sure = item_hashes(tests.where(~exact)), item_prefixes(tests.where(exact), threshold)
    hashes = written(bins.unionByName(sure), "leak-hashes")
    # a document looks up its signature and, where there are items for the exact search, its other shingles; these
    # are in no partition. explode_outer: for a plain explode the optimizer adds a filter on the array's
    # size, which repeats the whole array expression
    signed = with_shingles(own, "_text", k, short).withColumn("_cls", size_class(F.size("_set"))).withColumn("_sig", bin_minima("_set", F.col("_cls")))
    asked = F.transform("_sig", lambda h: F.struct(h.alias("value"), F.col("_cls").alias("cls")))
    if not hashes.where("from_cls = -1").isEmpty():
        asked = F.concat(asked, F.transform(F.concat(F.array_except("_set", "_sig"), "_short"), lambda h: F.struct(h.alias("value"), F.lit(-1).alias("cls"))))
    held = signed.select("doc", F.explode_outer(asked).alias("p")).select("doc", "p.value", "p.cls")
    candidates = written(held.join(small_side(hashes), "value").where("from_cls <= cls").select("doc", "item_id").distinct(), "leak-candidates")
    per_doc = candidates.groupBy("doc").agg(F.collect_set("item_id").alias("_items"))
    per_doc = small_lists(written(per_doc, "leak-docs"), "_items")
    pairs = (with_shingles(own.join(per_doc, "doc"), "_text", k, short)
             .select("doc", F.concat("_set", "_short").alias("_doc_set"), F.explode("_items").alias("item_id")))
    shared = F.size(F.array_intersect("_set", "_doc_set"))
    found = (pairs.join(small_lists(tests, "_set"), "item_id")
             .select("doc", "item_id", "n_words", F.size("_set").alias("n"), shared.alias("m"))
             .where(F.col("m") >= F.lit(threshold) * F.col("n")))
    best = F.max(F.struct((F.col("m") / F.col("n")).alias("c"), "m", "n", "n_words")).alias("b")
    return (found.groupBy("doc", "item_id").agg(best)
            .select(F.col("doc").alias(key), F.col("item_id").alias(item_key), F.col("b.n_words").cast("long").alias("n_words"),
                    F.col("b.n").cast("long").alias("n_shingles"), F.col("b.m").cast("long").alias("n_shared"),
                    F.col("b.c").alias("containment")))
