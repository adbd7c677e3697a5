"""Near duplicates against all pairs by the definition of the similarity."""

import random
from collections import Counter

import numpy as np
import pytest

from tte.llm import near_dedup
from tte.llm.graph import components
from tte.llm.near_dedup import near_duplicates, probability_jaccard, signatures, weighted_shingles


def shingles(text, k=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return Counter()
    return Counter(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def similarity(a, b):
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a.keys() | b.keys())
    return total


def brute(rows, threshold=0.8):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and similarity(a, b) >= threshold - 1e-12:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(40, 160))]
        if rng.random() < 0.3:
            base += base[:20] * 3
        for _ in range(rng.choice([1, 1, 2, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n, rows[0][1].upper()), (n + 1, rows[0][1]), (n + 2, ""), (n + 3, None), (n + 4, "two words"), (n + 5, "two  words")]
    return rows


@pytest.mark.parametrize("seed,small,block", [(1, 32, 256), (2, 1, 256), (3, 0, 4)])
def test_classes_are_those_of_all_pairs(spark, documents_of, monkeypatch, seed, small, block):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = corpus(seed)
    got = {r.doc_id: r.class_id for r in near_duplicates(documents_of(rows)).collect()}
    assert got == brute(rows)


def test_odd_rows(spark, documents_of, odd_rows):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.class_id or 0) for r in near_duplicates(documents_of(odd_rows)).collect())
    assert len(got) == len(odd_rows)
    want = {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8}
    assert all(c == (0 if null else want[i]) for null, i, c in got)
    assert near_duplicates(documents_of(odd_rows).limit(0)).count() == 0


def test_different_texts_of_one_id_and_rows_without_id(documents_of):
    """Texts are compared: no text is lost because its id repeats or is missing."""
    base = [f"w{i}" for i in range(60)]
    text = lambda *changes: " ".join("x" if i in changes else w for i, w in enumerate(base))
    other = " ".join(f"v{i}" for i in range(40))
    rows = [(7, text()), (7, other), (None, text(3)), (9, text(59)), (None, "alone without id at all here"), (8, other + " end"), (12, "quite another text of words")]
    got = sorted((str(r.doc_id), str(r.class_id)) for r in near_duplicates(documents_of(rows)).collect())
    assert got == sorted([("7", "7"), ("7", "7"), ("None", "7"), ("9", "7"), ("None", "None"), ("8", "7"), ("12", "12")])
    classes = near_dedup.near_classes(documents_of(rows)).collect()
    assert len({r.class_key for r in classes}) == 4


def test_similarity_by_definition():
    rng = random.Random(4)
    for _ in range(50):
        a = Counter(rng.choices(range(12), k=rng.randint(1, 20)))
        b = Counter(rng.choices(range(12), k=rng.randint(1, 20)))
        sides = [(np.array(sorted(x)), np.array([x[e] for e in sorted(x)])) for x in (a, b)]
        assert probability_jaccard(*sides[0], *sides[1]) == pytest.approx(similarity(a, b))


def test_registers_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(1)
    agree, want = [], []
    for t in range(60):
        wa, wb = rng.integers(1, 5, 40), rng.integers(1, 5, 40)
        wa[:6], wb[-6:] = 0, 0
        elem = np.arange(40, dtype=np.uint64) + np.uint64(1000 * t)
        held = [signatures(np.zeros(int((w > 0).sum()), np.int64), elem[w > 0], w[w > 0], 1)[0] for w in (wa, wb)]
        agree.append((held[0] == held[1]).mean())
        want.append(similarity(Counter({i: int(w) for i, w in enumerate(wa) if w}), Counter({i: int(w) for i, w in enumerate(wb) if w})))
    assert np.mean(agree) == pytest.approx(np.mean(want), abs=0.03)


def test_words_and_weights():
    text = "A b c d e a B c d e".encode()
    doc, shingle, weight, n, _ = weighted_shingles(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert n[0] == 10 and sorted(weight.tolist()) == [1, 1, 1, 1, 2]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 1 for i in range(1, 50))
