"""Quality rules and benchmark decontamination against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tte.llm.decontaminate import bin_minima, find_leaks, item_hashes
from tte.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, measures, quality_rules


def brute_base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    covered = set()
    for i, x in enumerate(windows):
        if windows.count(x) > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    failed = n < MIN_WORDS or 100 * len(covered) > MAX_REPEAT_PERCENT * n
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(40):
        words = [rng.choice(["the", "a", "und", "x1", "é#", "|", "ñandú"]) for _ in range(rng.randint(0, 60))]
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t", "\r\n", "\x0b"]) for w in words))
    out += ["a b c d e f g h " * 9, "one\ntwo\none\n \n \n" * 3, "w " * 8, "w " * 9, " x y", "🙂🙂 #🙂"]
    return out


def test_base_measures(documents_of, odd_rows):
    rows = list(enumerate(texts(1))) + [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 5000]
    got = sorted(((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality_rules(documents_of(rows)).collect()))
    assert got == sorted((str(i), *brute_base(t)) for i, t in rows)


def test_verdict_and_odd_rows(documents_of, odd_rows):
    good = "the house stands on the hill and a road leads to the town with many people in it every day of the year "
    rows = [(100, good * 1 + "while others stay at home"), (101, good.upper().replace(" ", "!! ")), (102, good.replace(" ", "*** ")), (103, good * 9)]
    docs = documents_of(rows + [(r[0], r[1]) for r in odd_rows]).selectExpr("*", "1 as n_words", "2 as kept", "'x' as _text")
    got = quality_rules(docs).collect()
    assert len(got) == len(rows) + len(odd_rows)
    assert {r.doc_id: r.kept for r in got if (r.doc_id or 0) >= 100} == {100: True, 101: False, 102: False, 103: False}
    assert quality_rules(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        measures(docs.selectExpr("text", "1 as _qr_words"))


def word_list(text):
    return [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]


def shingle_set(text, k=5):
    w = word_list(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def all_leaks(docs, items, threshold=0.8):
    """Every pair by definition; an item of fewer than five words is one shingle, all its words."""
    want = {}
    sets = [(j, len(word_list(t)), shingle_set(t, min(5, len(word_list(t))))) for j, t in items if word_list(t)]
    for i, t in docs:
        held = {k: shingle_set(t, k) for k in {min(5, n) for _, n, _ in sets}}
        for j, n, s in sets:
            m = len(s & held[min(5, n)])
            if m >= threshold * len(s):
                want[i, j] = (n, len(s), m)
    return want


def leak_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(900)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 6, 9, 14, 40])))) for i in range(60)]
    docs = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.choice([0, 20, 300, 3000]))
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1])):
                part[rng.randrange(len(part))] = "changed"
            if rng.random() < 0.3:
                part = [p.upper() + "," for p in part]
            at = rng.randint(0, len(words))
            words[at:at] = part
        docs.append((i, " ".join(words)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_leaks_are_those_of_all_pairs(spark, documents_of, seed):
    docs, items = leak_rows(seed)
    got = {(r.doc_id, r.item_id): (r.n_words, r.n_shingles, r.n_shared) for r in
           find_leaks(documents_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = all_leaks(docs, items)
    assert got == want
    assert {n for n, *_ in want.values()} >= {3, 6, 9, 14, 40}


def test_bins_alone_find_long_items(spark, documents_of, monkeypatch):
    """Without the exact search the size partitions and their bins still find all but the shortest items."""
    import tte.llm.decontaminate as decontaminate

    monkeypatch.setattr(decontaminate, "exact_items", lambda items, threshold: F.lit(False))
    docs, items = leak_rows(3)
    got = {(r.doc_id, r.item_id) for r in find_leaks(documents_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = all_leaks(docs, items)
    assert got <= set(want) and not {k for k in set(want) - got if want[k][2] > 6}
    assert got and any(want[k][2] >= 10 for k in got)


def test_a_hash_is_a_bins_minimum_from_its_partition_on(spark):
    rng = random.Random(8)
    sets = [sorted(rng.getrandbits(64) - 2 ** 63 for _ in range(rng.randrange(1, 60))) for _ in range(20)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "item_id long, _set array<long>")
    first = {(r.item_id, r.value): r.from_cls for r in item_hashes(df).collect()}
    for cls in (0, 1, 4, 9):
        for r in df.select("item_id", bin_minima("_set", F.lit(cls)).alias("m")).collect():
            assert r.m == [h for h in sets[r.item_id] if first[r.item_id, h] <= cls]


@pytest.mark.parametrize("threshold", [0.8, 0.5, 1.0])
def test_leaks_of_short_items_are_all_found(spark, documents_of, threshold):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=5 + i % 15))) for i in range(60)]
    docs = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.choice([0, 30, 700]))
        for _, item in rng.sample(items, 4):
            part = item.split()[rng.choice([0, 0, 1]):]
            at = rng.randint(0, len(words))
            words[at:at] = part
        docs.append((i, " ".join(words)))
    want = {p: (n, m) for p, (_, n, m) in all_leaks(docs, items, threshold).items()}
    found = find_leaks(documents_of(docs), spark.createDataFrame(items, "item_id long, text string"), threshold=threshold)
    assert {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in found.collect()} == want
    assert sum(n <= 2 for n, _ in want.values()) >= 30


def test_leaks_odd_rows(spark, documents_of, odd_rows):
    items = [(None, None), (None, "some words without an id stand here"), (1, ""), (2, "two words"), (3, "same tie text of five words"),
             (3, "same tie text of five words"), (4, "The quick, brown FOX jumps over the lazy dog")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc", "2 as value")
    got = {(r.doc_id, r.item_id) for r in find_leaks(documents_of(odd_rows), bench).collect()}
    assert got == {(8, 3), (9, 3), (4, 4)}
    assert find_leaks(documents_of(odd_rows).limit(0), bench).count() == 0
    assert find_leaks(documents_of(odd_rows), bench.limit(0)).count() == 0
