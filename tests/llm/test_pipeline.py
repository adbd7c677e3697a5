"""Each pipeline stage, and the whole run, against plain Python on a small corpus."""

import hashlib
import random

import pytest
from test_mixing import brute as brute_mix
from test_near_dedup import brute as brute_classes
from test_rules_and_leaks import shingle_set
from test_suffix_dedup import brute as brute_repeats

import corpus_pipeline as cp

BENCH = [(1, "sentinel alpha beta gamma delta epsilon zeta eta theta iota"), (2, "short item"), (None, None)]
CLASH = ["row", "key", "score", "lang_pred", "kept", "n_removed", "_doc", "repeats"]


def corpus():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(500)]
    words = lambda n: rng.choices(vocabulary, k=n)
    passage = " ".join(words(60))
    rows = []
    for i in range(60):
        w = words(rng.randint(30, 120))
        if i % 9 == 0:
            w[10:10] = BENCH[0][1].split()
        t = " ".join(w)
        if i % 7 == 0:
            t = t[:50] + " é " + passage + " ü " + t[50:]
        rows.append((i, t, "xx", f"s{i % 4}" if i % 5 else None))
    for i in range(60, 70):
        w = rows[i - 40][1].split()
        w[5] = "changed"
        rows.append((i, " ".join(w), "xx", "s1"))
    return rows + [(70, rows[3][1], "xx", "s2"), (71, None, "xx", "s2"), (72, "", None, "s2"), (73, "12 34 56", "xx", None),
                   (None, " ".join(words(50)), "xx", "s0"), (74, "漢字 漢字 漢字 漢字 漢字", None, "s3"), (75, rows[4][1], "xx", "s1"), (75, rows[4][1], "xx", "s1")]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def table(documents_of, rows, clash=False):
    docs = documents_of([r[:4] for r in rows])
    for c in CLASH if clash else []:
        docs = docs.selectExpr("*", f"'{c}' as {c}")
    return docs


def plain(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def languages(rows):
    return [r for r in rows if r[1] and any(c.isalpha() for c in r[1]) and "漢" not in r[1]]


def near(rows):
    """Classes of texts, whatever their ids; the smallest id of each stays, of equal ids the smallest digest."""
    numbered = brute_classes(list(enumerate(r[1] for r in rows)))
    classes = {}
    for i, r in enumerate(rows):
        classes.setdefault(numbered[i], []).append(r)
    best = {c: min(own, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())) for c, own in classes.items()}
    return [best[c] for c in classes]


def repeats(rows):
    out = []
    for r, (_, gone, _, kept) in zip(rows, brute_repeats([r[1] for r in rows], 200), strict=True):
        out.append((r[0], kept.decode("utf-8", "ignore") if gone else r[1], *r[2:]))
    return out


def leaks(rows):
    sets = [s for s in (shingle_set(t) for _, t in BENCH) if s]
    return [r for r in rows if not any(len(s & shingle_set(r[1])) >= 0.8 * len(s) for s in sets)]


PLAIN = [languages, near, repeats, leaks]


@pytest.mark.parametrize("n", range(4))
def test_stage_keeps_what_plain_python_keeps(spark, documents_of, sf_dir, n):
    rows = corpus()
    out = cp.STAGES[n][1](spark, table(documents_of, rows, clash=True), sf_dir)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASH]
    assert plain(out) == sorted(((r[0], r[1]) for r in PLAIN[n](rows)), key=str)
    assert all(r[c] == c for r in out.select(*CLASH).limit(3).collect() for c in CLASH)
    empty = cp.STAGES[n][1](spark, table(documents_of, rows).limit(0), sf_dir)
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def check_mix(rows, got):
    size, total, target = brute_mix([(r[0], r[1], r[3]) for r in rows])
    h = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    taken = {}
    for r, n in zip(rows, size, strict=True):
        taken.setdefault(r[3], []).append((h(r[0]), got.get((r[0], r[1]), 0), n))
    for s, items in taken.items():
        counts = [c for _, c, n in sorted(items) if n]
        assert counts == sorted(counts, reverse=True)
        assert abs(sum(c * n for _, c, n in items) - target[s]) <= 2 * max(n for *_, n in items)


def test_mix_stage(spark, documents_of, sf_dir):
    rows = leaks(languages(corpus()))
    rows = [r for i, r in enumerate(rows) if r not in rows[:i]]
    out = cp.mix_stage(spark, table(documents_of, rows, clash=True), sf_dir)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASH[:-1], "repeats"]
    check_mix(rows, {(r.doc_id, r.text): r.repeats for r in out.collect()})


def test_whole_run(spark, documents_of, sf_dir):
    rows = corpus()
    table(documents_of, rows).write.mode("overwrite").parquet(f"{sf_dir}/documents.parquet")
    for step in PLAIN:
        rows = step(rows)
    out = cp.run(spark, sf_dir)
    check_mix(rows, {(r.doc_id, r.text): r.repeats for r in out.collect()})
    assert cp.ORACLE_SQL is None and [name for name, _ in cp.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontaminate", "mix_sources"]
