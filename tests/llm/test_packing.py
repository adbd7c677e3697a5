"""Packing against the tokenizer itself and plain best fit."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tte.llm.packing import Bins, RunTokens, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "B", "é", "É", "×", "÷", "ß", "'", "s", "'S", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "<", "|>", " ", "  ", "\n", "\x1c", "\x85",
       " ", " ", "1", "23", "²", "½", "!", "..", "…", "—", "́", "漢", "🙂", "Σ", "ΑΣ", "İ", "ª", "µ", "_", "\x00", "ﬁ", "Å", "ẛ̣", "don't"]


def bytes_of(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in data]))).astype(np.int64)


def test_parts_give_the_tokenizers_ids():
    rng = random.Random(5)
    texts = ["", " \n", "x" * 3000, *("".join(rng.choice(ODD) for _ in range(rng.randrange(20))) for _ in range(4000))]
    ids, bounds = RunTokens(PATH).ids(*bytes_of(texts))
    whole = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    for i, e in enumerate(whole):
        assert ids[bounds[i]: bounds[i + 1]].tolist() == [*e.ids, 0], repr(texts[i])


def test_memory_of_parts_is_bounded(monkeypatch):
    import tte.llm.packing as packing

    monkeypatch.setattr(packing, "MEMO_RUNS", 10)
    tokens, rng = RunTokens(PATH), random.Random(2)
    plain = Tokenizer.from_file(PATH)
    for _ in range(30):
        text = " ".join(rng.choice(["alpha", "beta", "z" * 100]) + str(rng.randrange(50)) for _ in range(12))
        ids, _ = tokens.ids(*bytes_of([text]))
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 0]
        assert len(tokens.known) <= 60 and len(tokens.flat) < 5000


def plain_best_fit(lengths, capacity, open_bins):
    """Bins as lists of lengths, by looking at every open bin for every item."""
    bins, open_now = [], []
    for n in lengths:
        fits = [b for b in open_now if sum(bins[b]) + n <= capacity]
        if n == capacity or not fits:
            bins.append([])
            b = len(bins) - 1
            if n < capacity:
                open_now.append(b)
        else:
            b = max(fits, key=lambda x: (sum(bins[x]), ))
        bins[b].append(n)
        if sum(bins[b]) == capacity and b in open_now:
            open_now.remove(b)
        if len(open_now) > open_bins:
            open_now.remove(max(open_now, key=lambda x: sum(bins[x])))
    return bins


@pytest.mark.parametrize("open_bins", [1, 3, 50])
def test_bitset_finds_the_tightest_bin(open_bins):
    rng = random.Random(open_bins)
    lengths = [rng.choice([1, 2, 3, 10, 40, 63, 64, 99, 100]) for _ in range(800)]
    bins, got = Bins(100, open_bins), {}
    for n in lengths:
        b, at = bins.put(n)
        assert at == sum(got.get(b, []))
        got.setdefault(b, []).append(n)
        assert bins.open <= open_bins and bins.mask.bit_count() == len(bins.by_free)
    want = plain_best_fit(lengths, 100, open_bins)
    assert len(got) == len(want) and sorted(map(sum, got.values())) == sorted(map(sum, want))


def check(rows, pieces, capacity=2048):
    plain = Tokenizer.from_file(PATH)
    ids = {}
    for i, text in enumerate(rows):
        ids[i] = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == ids.keys()
    for i, own in by_doc.items():
        own.sort(key=lambda p: p.piece)
        assert [p.piece for p in own] == list(range(-(-len(ids[i]) // capacity)))
        for p in own:
            want = ids[i][p.piece * capacity: (p.piece + 1) * capacity]
            assert (p.start, p.length) == (p.piece * capacity, len(want))
            assert p.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes()) and ("ids" not in p or p.ids == want)
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(p.length for p in own) <= capacity
    return len(by_sequence), -(-sum(len(x) for x in ids.values()) // capacity)


def test_pieces_of_odd_texts(documents_of):
    rng = random.Random(9)
    texts = [None, "", " \t", "one <|endoftext|> two", "it's NOT they'LL", "long " * 9000, "x" * 50_000, "漢字🙂 " * 700, "same text", "same text"]
    texts += [" ".join(rng.choice(["word", "thing", "Über", "9"]) for _ in range(rng.randrange(700))) for _ in range(300)]
    docs = documents_of(list(enumerate(texts)), parts=5).withColumns({"key": F.lit(1), "bin": F.lit("x"), "place": F.lit(0), "still": F.lit(True)})
    used, least = check(texts, pack_documents(docs, PATH).collect())
    assert used <= least + 2
    small, least = check(texts, pack_documents(docs, PATH, capacity=64, open_bins=4).collect(), 64)
    assert small <= 1.1 * least


def test_repeated_ids_missing_ids_and_no_rows(documents_of):
    docs = documents_of([(1, "a b"), (1, "a b"), (None, "c"), (None, None)])
    got = pack_documents(docs, PATH, with_ids=False)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 1), (0, 2), (1, 3), (1, 3)]
    assert len({r.sequence_id for r in rows}) == 1 and sorted(r.offset for r in rows)[0] == 0
    assert pack_documents(docs.limit(0), PATH).count() == 0


def test_whole_query_against_the_tokenizer(spark):
    from tte.llm.registry import queries

    rows = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    at = {d: i for i, d in enumerate(rows)}
    pieces = queries()["op12_pack_sequences"](spark, "/root/testdata/sf0.001")
    renamed = pieces.replace(at, subset="doc_id") if at != {d: d for d in rows} else pieces
    used, least = check(list(rows.values()), renamed.collect())
    assert used <= 1.02 * least + 2
