"""Bigram scores against a direct dictionary implementation."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tte.llm.common import fold
from tte.llm.lm_score import discounts, lm_scores


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute(rows, mod=10):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % mod == 0
    train = [tokens(t) for i, t in rows if not held(i)]
    uni = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["<s>", *t[:-1]], t, strict=True))
    n, v = sum(uni.values()), len(uni)
    total, by, follows = Counter(), defaultdict(Counter), Counter()
    for (u, w), c in pairs.items():
        total[u] += c
        by[u][min(c, 3)] += 1
        follows[w] += 1
    coc = lambda cs: [sum(1 for c in cs if c == i) for i in (1, 2, 3, 4)]
    d, e = discounts(*coc(pairs.values())), discounts(*coc(follows.values()))
    kinds = len(pairs)
    off = lambda c, d: max(c - d[min(c, 3) - 1], 0.0) if c else 0.0
    spare = sum(e[min(c, 3) - 1] for c in follows.values()) / kinds if kinds else 1.0
    out = []
    for i, t in rows:
        toks, s, base = tokens(t), 0.0, 0.0
        for u, w in zip(["<s>", *toks[:-1]], toks, strict=True):
            base += math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1)))
            low = (off(follows[w], e) / kinds if kinds else 0) + spare / (v + 1)
            known = u in total and (u == "<s>" or u in uni)
            back = sum(d[k - 1] * by[u][k] for k in (1, 2, 3)) / total[u] if known else 1.0
            s += math.log10((off(pairs[u, w], d) / total[u] if known else 0.0) + back * low)
        out.append((i, held(i), len(toks), sum(uni[w] > 0 for w in toks), n, base, s))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(300)]
    return [(i, " ".join(rng.choices(vocabulary, [1 / (1 + j) for j in range(300)], k=rng.randint(0, 80)))) for i in range(150)]


@pytest.mark.parametrize("seed,sizes", [(1, {}), (2, {"shard_words": 40, "shard_pairs": 500})])
def test_scores_are_those_of_the_dictionaries(spark, documents_of, seed, sizes):
    rows = corpus(seed) + [(900, ""), (901, None), (902, "only words never seen before xyzzy")]
    got = {r.doc_id: r for r in lm_scores(documents_of(rows), fold("doc_id", 10) == 0, **sizes).collect()}
    for i, held, n, known, total, base, score in brute(rows):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-8) and r.score == pytest.approx(score, abs=1e-8)


def test_probabilities_of_a_context_add_up(spark, documents_of):
    rows = corpus(3)
    words = sorted({w for _, t in rows for w in tokens(t) if w})
    train = documents_of(rows + [(10_000 + i, w) for i, w in enumerate(words)])
    scored = lm_scores(train, F.col("doc_id") >= 10_000).where("held_out and n_known = n_tokens").collect()
    # p(w, end) summed over all words is below 1, and well above 0
    assert 0.01 < sum(10 ** r.score for r in scored) < 1


def test_odd_rows(spark, documents_of, odd_rows):
    got = lm_scores(documents_of(odd_rows), fold("doc_id", 10) == 0).collect()
    want = sorted((str(r[0]), r[2], round(r[6], 6)) for r in brute([(r[0], r[1]) for r in odd_rows]))
    assert sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in got) == want
    assert lm_scores(documents_of(odd_rows).limit(0), fold("doc_id", 10) == 0).count() == 0
    alone = lm_scores(documents_of([(1, "a b")]), F.lit(True)).collect()
    assert alone[0].train_tokens == 0 and alone[0].score == pytest.approx(0.0)
