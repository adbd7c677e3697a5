"""Repeated passages against a count of every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tte.llm.suffix_dedup import anchor_runs, remove_repeats, repeat_digest, repeated_in_block
from tte.llm.suffix_sort import sorted_neighbours


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        spans = int(np.sum(gone[:-1] & ~np.concatenate(([False], gone[:-2])))) if len(b) else 0
        out.append((len(b), int(gone[:len(b)].sum()), spans, kept))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 9)))
    passage = [" ".join(word() for _ in range(60)) for _ in range(4)]
    texts = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 90)))]
        if rng.random() < 0.5:
            p = rng.choice(passage)
            parts.append(p[rng.randint(0, 40):len(p) - rng.randint(0, 40)])
        parts.append(" ".join(word() for _ in range(rng.randint(0, 50))))
        texts.append(" ".join(parts))
    texts += [texts[0], texts[0], "ab" * 400, "x" * 700, texts[1] + "!", None, "", "short"]
    return texts


@pytest.mark.parametrize("seed,hot", [(1, 100_000), (2, 100_000), (3, 2)])
def test_digest_is_that_of_every_window(spark, documents_of, seed, hot):
    texts = corpus(seed)
    docs = documents_of(list(enumerate(texts)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in repeat_digest(docs, block_bytes=20_000, hot=hot).collect()}
    for i, (n, gone, spans, kept) in enumerate(brute(texts, 200)):
        assert got[i] == (n, gone, spans, hashlib.sha256(kept).hexdigest()), i


def test_kept_text_and_other_columns(spark, documents_of, odd_rows):
    docs = documents_of(odd_rows)
    rows = remove_repeats(docs).collect()
    assert len(rows) == len(odd_rows)
    assert {"lang", "source", "n_chars"} <= set(rows[0].asDict())
    want = {(r[0], hashlib.md5((r[1] or "").encode()).hexdigest()): k for r, k in zip(odd_rows, brute([r[1] for r in odd_rows], 200), strict=True)}
    for r in rows:
        n, gone, spans, kept = want[(r.doc_id, hashlib.md5((r.text or "").encode()).hexdigest())]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (n, gone, spans, kept)
    assert remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [60, 1 << 20])
def test_induced_order_and_common_prefixes(limit):
    rng = np.random.default_rng(5)
    for _ in range(60):
        n, k, depth = int(rng.integers(1, 90)), int(rng.integers(1, 5)), int(rng.integers(2, 20))
        text = np.append(rng.integers(1, 1 + k, n), 0).astype(np.uint8)
        raw, seen = bytes(text), set()
        for pos, lcp in sorted_neighbours(text, 1 + k, depth, limit):
            seen |= set(pos.tolist())
            for a, b, v in zip(pos[:-1], pos[1:], lcp[1:], strict=True):
                w = 0
                while w < depth and max(a, b) + w < len(raw) and raw[a + w] == raw[b + w]:
                    w += 1
                assert w == v
        assert seen == set(range(n + 1))


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    a = bytes(rng.choice(b"abc") for _ in range(500))
    one, two = b"zz" + a, b"yyyyyyyyyy" + a + b"q"
    buf = np.frombuffer(one + two, np.uint8)
    doc, first, n, h = anchor_runs(buf, np.array([0, len(one), len(one) + len(two)]))
    where = [{}, {}]
    for d, f, m, x in zip(doc, first, n, h, strict=True):
        for w in range(f, f + m):
            where[d][w - (2 if d == 0 else 10)] = x
    for w in range(301):
        assert where[0][w] == where[1][w]


def test_block_of_pieces():
    found = repeated_in_block([b"a" * 30, b"bc" * 20, b"q"], np.array([21, 31, 0]), 10)
    assert [len(f) for f in found] == [21, 31, 0]
