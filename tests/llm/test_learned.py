"""Language identification and the quality model: held-out accuracy, exact parts, odd rows."""

import random

import numpy as np
import pytest

from tte.llm.common import fold
from tte.llm.language_id import HASHES, LanguageFilters, grams, identify, learn
from tte.llm.quality_model import FEATURES, FlatTrees, fit_trees, quality_scores, statistics

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["ski", "vor", "ngu", "ehl"], "cc": ["éta", "oñi", "ção", "ûr"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def languages(documents_of):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, rng.randint(3, 60)), lang) for i in range(300) for lang in [rng.choice(list(SYLLABLES))]]
    return rows, documents_of(rows)


def test_held_out_languages(languages):
    rows, docs = languages
    model = learn(docs.where(fold("doc_id", 3) != 1))
    got = {r.doc_id: r for r in identify(docs, model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_odd_rows(languages, documents_of, odd_rows):
    _, docs = languages
    model = learn(docs)
    odd = documents_of(odd_rows).selectExpr("*", "'x' as lang_pred", "7 as score", "1 as _x")
    got = identify(odd, model).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert identify(odd.limit(0), model).count() == 0
    nothing = learn(docs.limit(0))
    assert {r.lang_pred for r in identify(docs.limit(5), nothing).collect()} == {"und"}


def test_more_languages_than_bits_in_a_word(documents_of):
    rng = random.Random(5)
    words = {f"l{i:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(5)] for i in range(150)}
    rows = [(i, " ".join(rng.choices(words[lang], k=12)), lang) for i, lang in enumerate(sorted(words) * 5)]
    docs = documents_of(rows)
    model = learn(docs.where("doc_id >= 150"))
    assert sorted(model.names) == sorted(words) and model.rows.shape[0] == 3
    got = {r.doc_id: r for r in identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang and got[i].score > 0.5 for i, _, lang in rows)


def test_filters_hold_every_gram_and_rates_are_measured():
    rng = np.random.default_rng(1)
    value = np.unique(rng.integers(0, 1 << 40, 5000).astype(np.uint64))
    mask = rng.integers(1, 8, len(value)).astype(np.uint64)
    filters = LanguageFilters.build(["a", "b", "c"], value, mask)
    assert ((filters.masks(value) & mask) == mask).all()
    other = np.setdiff1d(rng.integers(0, 1 << 40, 50_000).astype(np.uint64), value)
    for i, rate in enumerate(filters.false_rate):
        assert ((filters.masks(other) >> np.uint64(i)) & np.uint64(1)).mean() == pytest.approx(rate, abs=0.01)
    assert HASHES == 3


def test_grams_by_definition():
    raw = "Ab, cd\n\nÉ".encode()
    doc, value = grams(np.frombuffer(raw + b"x", np.uint8), np.array([0, len(raw), len(raw) + 1]), 3)
    padded = b" ab cd " + "É".encode() + b" "
    want = [padded[i:i + 3] for i in range(len(padded) - 2)]
    assert [int(v).to_bytes(3, "big") for v in value[doc == 0]] == want
    assert [int(v).to_bytes(3, "big") for v in value[doc == 1]] == [b" x "]


def walk(trees: FlatTrees, x):
    total = trees.base
    for node in trees.roots:
        while trees.left[node] != node:
            node = trees.left[node] if x[trees.feature[node]] <= trees.cut[node] else trees.right[node]
        total += trees.value[node]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_match_a_walk_and_learn():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.5)).astype(float)
    trees = fit_trees(x[:2000], y[:2000])
    score = trees.score(x[2000:])
    assert ((score > 0.5) == y[2000:]).mean() > 0.95
    assert np.allclose(score[:50], [walk(trees, r) for r in x[2000:2050]])
    assert fit_trees(x[:10], np.ones(10)).score(x[:3]).std() == 0
    assert fit_trees(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3


def test_statistics_by_definition():
    a = "THE the the line!!\nline two | x\nline two | x"
    raw = a.encode()
    row = dict(zip(FEATURES, statistics(np.frombuffer(raw, np.uint8), np.array([0, len(raw), len(raw)]))[0], strict=True))
    words = a.split()
    assert row["log_words"] == pytest.approx(np.log1p(len(words))) and row["distinct_words"] == pytest.approx(len(set(words)) / len(words))
    assert row["distinct_lines"] == pytest.approx(2 / 3) and row["exclaims_per_word"] == pytest.approx(2 / len(words))
    assert row["same_as_before"] == pytest.approx(1 / len(words)) and row["upper_share"] == pytest.approx(3 / len(raw))
    assert not statistics(np.zeros(0, np.uint8), np.array([0, 0])).any()


def test_quality_held_out_and_odd_rows(spark, documents_of, odd_rows):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(100, 500):
        good = rng.random() < 0.6
        t = text(rng, "aa", 60)
        rows.append((i, t if good else t.replace(" ", " | ")))
        labels.append((i, int(good)))
    labels += [(None, 1), (100, None), (9999, 0)]
    docs = documents_of(rows + [(r[0], r[1]) for r in odd_rows]).selectExpr("*", "1 as score", "2 as x", "3 as doc")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality_scores(docs, marks, lambda key: fold(key, 5) == 0).collect()
    assert len(got) == len(rows) + len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and (r.doc_id or 0) >= 101]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.95
    assert quality_scores(docs.limit(0), marks, lambda key: fold(key, 5) == 0).count() == 0
    flat = quality_scores(docs, marks.limit(0), lambda key: fold(key, 5) == 0).collect()
    assert {r.score for r in flat} == {0.5}
