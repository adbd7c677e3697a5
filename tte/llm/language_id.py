"""Language identification by bit-sliced Bloom filters over n-grams.

Training counts, in Spark and over all training rows, in how many documents of each language every
n-gram occurs. An n-gram belongs to a language if it occurs in at least ``min_share`` of its documents
(and in two), so stray foreign words and names do not enter; a language thus has at most the mean
number of distinct n-grams per document divided by ``min_share`` of them, however large the corpus.

The filters of all languages lie across each other: the table has one row of bits per Bloom position
and one column per language, 64 of them in a word and as many words as the languages need. The rows at
an n-gram's ``HASHES`` positions, and-ed, give the mask of all languages that contain it (or look so);
one lookup serves every language of a word.

A text is a bag of n-grams. Per language the set bits of the masks are counted; with ``c`` of ``n``
n-grams found and the filter's false-positive rate ``f``, ``(c - f * n) / (1 - f)`` are truly there.
The language with the most wins (on a tie the one with more training documents, then the smaller
name), and the score is its share of ``n``.

N-grams are five bytes of the text with A-Z as a-z and every run of bytes that are not letters of any
kind as one space, so words count with their ends.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.llm.common import small_side
from tte.llm.textnum import LOWER, U64, binary_column, gathered, mix64, slices

GRAM = 5
HASHES = 3
BITS_PER_GRAM = 12
MIN_SHARE = 0.001
UNKNOWN = "und"
#: Languages in one word of a mask.
WORD = 64

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def grams(buf: np.ndarray, bounds: np.ndarray, k: int = GRAM):
    """``(text number, n-gram)`` of every position; n-grams are numbers of ``8 * k`` bits. Each text is
    read as if a space stood before and after it."""
    buf = np.insert(buf, np.concatenate((bounds[:-1], bounds[1:])), 0x20)
    bounds = bounds + 2 * np.arange(len(bounds))
    letter = _LETTER[buf]
    out = np.where(letter, LOWER[buf], np.uint8(0x20))
    gap = ~letter
    again = np.zeros_like(gap)
    if len(buf):
        again[1:] = gap[1:] & gap[:-1]
        again[bounds[(bounds > 0) & (bounds < len(buf))]] = False
    keep = ~again
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[keep]
    out = out[keep].astype(U64)
    n = len(out) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    value = np.zeros(n, dtype=U64)
    for j in range(k):
        value = (value << U64(8)) | out[j: j + n]
    inside = doc[:n] == doc[k - 1:]
    return doc[:n][inside], value[inside]


def _count_batches(k: int):
    """Per batch and language the number of documents with each n-gram."""
    def run(batches):
        for batch in gathered(batches, "text", 12 << 20):
            data, offs = binary_column(batch, "text")
            lang = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
            code, names = lang.indices.to_numpy(), lang.dictionary
            held: list[tuple] = []
            for lo, hi in slices(offs, 2 << 20):
                doc, value = grams(data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo], k)
                # 40 bits of n-gram and up to 2 ** 24 texts in a slice
                one = np.unique((doc.astype(U64) << U64(8 * k)) | value)
                who = code[lo + (one >> U64(8 * k)).astype(np.int64)].astype(U64)
                held.append(np.unique((who << U64(8 * k)) | (one & U64((1 << 8 * k) - 1)), return_counts=True))
            if not held:
                continue
            key, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            n = np.bincount(back, weights=np.concatenate([h[1] for h in held])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array((key >> U64(8 * k)).astype(np.int64))), pa.array((key & U64((1 << 8 * k) - 1)).view(np.int64)),
                 pa.array(n)], names=["lang", "gram", "n"])
    return run


@dataclass
class LanguageFilters:
    """Bit-sliced Bloom filters: ``rows[w, i]`` holds bit ``i`` of the filters of the languages from
    ``64 * w`` on."""

    names: list[str]
    rows: np.ndarray
    false_rate: np.ndarray
    gram: int = GRAM

    @classmethod
    def build(cls, names: list[str], value: np.ndarray, mask: np.ndarray, gram: int = GRAM) -> LanguageFilters:
        """From distinct n-grams and the masks of the languages that contain them: one word each, or a
        column per 64 languages."""
        mask = mask.reshape(len(value), -1) if len(value) else np.zeros((0, 1), U64)
        size = 1 << max(10, int(np.ceil(np.log2(max(1, len(value)) * BITS_PER_GRAM))))
        rows = np.zeros((max(1, -(-len(names) // WORD)), size), dtype=U64)
        for at in _positions(value, size):
            for w in range(mask.shape[1]):
                np.bitwise_or.at(rows[w], at, mask[:, w])
        filled = np.array([((rows[i // WORD] >> U64(i % WORD)) & U64(1)).mean() for i in range(len(names))])
        return cls(names, rows, filled ** HASHES, gram)

    def masks(self, value: np.ndarray, word: int = 0) -> np.ndarray:
        """For each n-gram the mask of all languages of a word whose filter contains it."""
        out = np.full(len(value), np.iinfo(np.uint64).max, dtype=U64)
        for at in _positions(value, self.rows.shape[1]):
            out &= self.rows[word][at]
        return out

    def decide(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the best language per text (-1 if it has no n-gram) and its score."""
        docs = len(bounds) - 1
        doc, value = grams(buf, bounds, self.gram)
        total = np.bincount(doc, minlength=docs).astype(np.float64)
        if not self.names:
            return np.full(docs, -1), np.zeros(docs)
        best, top = np.zeros(docs, np.int64), np.full(docs, -np.inf)
        for i, f in enumerate(self.false_rate):
            if i % WORD == 0:
                mask = self.masks(value, i // WORD)
            found = np.bincount(doc, weights=((mask >> U64(i % WORD)) & U64(1)).astype(np.float64), minlength=docs)
            share = (found - f * total) / max(1e-9, 1 - f) / np.maximum(total, 1)
            best[share > top] = i
            np.maximum(top, share, out=top)
        return np.where(total > 0, best, -1), np.clip(top, 0.0, 1.0)


def _positions(value: np.ndarray, size: int):
    for i in range(HASHES):
        yield (mix64(value + np.array([i + 1], U64) * U64(0x9E3779B97F4A7C15)) & U64(size - 1)).astype(np.int64)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", min_share: float = MIN_SHARE,
          k: int = GRAM) -> LanguageFilters:
    """Filters from the labelled rows; those without a text or language are left out. What reaches the
    driver is one row per n-gram in a filter and word of its mask, bounded by ``min_share`` as described above."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text")).where("lang is not null and text is not null")
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(totals, key=lambda n: (-totals[n], n))  # the first of equals wins: the more frequent one
    if not names:
        return LanguageFilters([], np.zeros((1, 1024), U64), np.zeros(0), k)
    table = rows.sparkSession.createDataFrame(
        [(n, i, float(max(min(2, totals[n]), min_share * totals[n]))) for i, n in enumerate(names)], "lang string, number int, least double")
    counts = rows.mapInArrow(_count_batches(k), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    kept = (counts.join(small_side(table, len(names)), "lang").where("n >= least")
            .groupBy("gram", F.expr(f"number div {WORD}").cast("int").alias("word"))
            .agg(F.collect_list(F.expr(f"number % {WORD}")).alias("bits"))
            .selectExpr("gram", "word", "aggregate(bits, 0L, (m, i) -> m | shiftleft(1L, i)) as mask").toPandas())
    value, at = np.unique(kept["gram"].to_numpy().view(np.uint64), return_inverse=True)
    mask = np.zeros((len(value), -(-len(names) // WORD)), U64)
    mask[at, kept["word"].to_numpy()] = kept["mask"].to_numpy().view(np.uint64)
    return LanguageFilters.build(names, value, mask, k)


def identify(docs: DataFrame, model: LanguageFilters, text: str = "text") -> DataFrame:
    """Every row with all its columns, plus ``lang_pred`` and ``score`` (0 to 1).

    A null text, or one without a letter, is ``und`` with score 0; so is any text when nothing was
    learned. A text too short for an n-gram but with a letter gets the language with the most training
    documents and score 0. Repeated rows are judged alike; very long texts are read whole; an empty table gives an empty
    result. Columns ``lang_pred`` and ``score`` of the table are replaced; no other name matters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred string, score double>")
    def predict(texts):
        import pandas as pd

        filters = shared.value
        raw = pa.array(texts, type=pa.binary())
        batch = pa.RecordBatch.from_arrays([raw], names=["text"])
        data, offs = binary_column(batch, "text")
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for lo, hi in slices(offs):
            best[lo:hi], score[lo:hi] = filters.decide(data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo])
        names = np.array(filters.names + [UNKNOWN], dtype=object)
        return pd.DataFrame({"lang_pred": names[np.where(best < 0, 0 if filters.names else -1, best)], "score": score})

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    found = docs.select(F.struct("*").alias("row"), has_letter.alias("letter"), predict(F.coalesce(F.col(text).cast("binary"), F.lit(b""))).alias("found"))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("lang_pred", "score")]
    return found.select(*kept, F.when(F.col("letter"), F.col("found.lang_pred")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                        F.when(F.col("letter"), F.col("found.score")).otherwise(F.lit(0.0)).alias("score"))
