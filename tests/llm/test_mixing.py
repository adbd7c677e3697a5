"""Mixing against a plain computation over all rows."""

import hashlib
import random
import re

import pytest

from tte.llm.mixing import mix, take_mix


def brute(rows):
    """(doc_id, text, source) rows to (doc_id, size, source_size, target, taken), by water filling."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, (*_, x) in zip(size, rows, strict=True) if x == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    budget, capped = 1.5 * sum(size), set()
    while True:
        free = [s for s in sources if s not in capped]
        level = (budget - sum(2 * total[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] > 2 * total[s]}
        if not over:
            break
        capped |= over
    target = {s: 2.0 * total[s] if s in capped else level * weight[s] for s in sources}
    return size, total, target


def corpus(seed, n=400):
    rng = random.Random(seed)
    pick = lambda: rng.choice(["hot"] * 6 + ["é", "b", "B", "z", None])
    return [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 30, 200]))), pick()) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_words_taken(documents_of, seed):
    rows = corpus(seed)
    docs = documents_of([(i, t, "en", s) for i, t, s in rows])
    got = {r.doc_id: r for r in mix(docs).collect()}
    size, total, target = brute(rows)
    taken = dict.fromkeys(total, 0)
    for (i, _, s), n in zip(rows, size, strict=True):
        r = got[i]
        assert (r.size, r.source_size) == (n, total[s]) and r.target == pytest.approx(target[s])
        assert r.taken in (0, n, 2 * n)
        taken[s] += r.taken
    for s in total:
        assert abs(taken[s] - target[s]) <= 200  # the largest document
    again = {r.doc_id: r.taken for r in mix(docs.repartition(7)).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_rows_taken_are_those_of_smallest_hash(documents_of):
    rows = [(i, "a b c", s) for i in range(300) for s in ("x",)] + [(1000 + i, "a", "y") for i in range(300)]
    docs = documents_of([(i, t, "en", s) for i, t, s in rows])
    got = {r.doc_id: r.repeats for r in mix(docs).collect()}
    h = lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16)
    for group in (range(300), range(1000, 1300)):
        order = [got[i] for i in sorted(group, key=h)]
        assert order == sorted(order, reverse=True)  # a threshold on the hash
    kept = {r.doc_id: r.repeats for r in take_mix(docs).collect()}
    assert kept == {i: n for i, n in got.items() if n}


def test_odd_rows(documents_of, odd_rows):
    docs = documents_of(odd_rows).selectExpr("*", "1 as size", "'t' as target", "5 as repeats", "0L as h", "'r' as row")
    got = mix(docs).collect()
    assert len(got) == len(odd_rows) and all(r.taken == 0 for r in got if r.size == 0)
    taken = take_mix(docs)
    assert taken.columns == [c for c in docs.columns if c != "repeats"] + ["repeats"]
    assert sum(r.repeats for r in taken.collect()) == sum(r.repeats for r in got)
    assert mix(docs.limit(0)).count() == 0 and take_mix(docs.limit(0)).count() == 0
    empty = documents_of([(1, None), (2, "")])
    assert [r.taken for r in mix(empty).collect()] == [0, 0]
