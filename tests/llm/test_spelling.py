"""Spelling variants against all pairs, and whole queries against their SQL on odd tables."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tte.llm.spelling as spelling
from tte.llm.spelling import DEPTH, Trie, Words, damaged_words, document_variants, in_order, near_pairs, near_words, one_edit, spelling_variants


def edited_once(a, b):
    """One letter inserted, deleted or replaced, by trying all of them."""
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_variants(counts, factor=10):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if edited_once(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        out[w] = (best if near and counts[best] >= factor * n else None, n, len(near))
    root = {}
    for w in counts:
        at = w
        while out[at][0]:
            at = out[at][0]
        root[w] = at
    return {w: (f, root[w], n, k, counts[f] if f else None) for w, (f, n, k) in out.items()}


def vocabulary(seed, size=400, alphabet="abcdeéÿ"):
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(7, 12))) for _ in range(size // 4)}
    for w in list(words) * 3:
        i = rng.randrange(len(w))
        words.add(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1:], w[i:] + w[:i]]))
    return {w: rng.choice([2, 2, 3, 20, 25, 200, 250, 2500]) for w in words if len(w) >= 7}


def words_frame(spark, counts):
    return spark.createDataFrame([(w, n) for w, n in counts.items()], "word string, n bigint").repartition(4)


@pytest.mark.parametrize("seed", [1, 2])
def test_verification_and_trie_find_all_pairs(seed):
    column = pa.array(sorted(vocabulary(seed)))
    names, words = column.to_pylist(), Words(column)
    n = len(names)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
    a, b = a[a < b], b[a < b]
    want = {(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if edited_once(names[i], names[j])}
    assert want and {(i, j) for i, j, ok in zip(a.tolist(), b.tolist(), one_edit(words, a, b), strict=True) if ok} == want
    own = np.arange(n) % 3 > 0
    x, y = near_pairs(words, own, 7)
    found = [tuple(sorted(p)) for p in zip(x.tolist(), y.tolist(), strict=True)]
    assert len(found) == len(set(found)) and set(found) == {p for p in want if own[p[0]] or own[p[1]]}


def test_trie_over_a_sample_takes_every_vector():
    words = Words(pa.array(sorted(vocabulary(5))))
    vectors = words.vectors()
    part = vectors[::9]
    trie = Trie(part[in_order(part)], 5)
    query, leaf = trie.reached(vectors, 0)
    assert sorted(query.tolist()) == list(range(len(vectors)))  # every word has one cell
    home = dict(zip(query.tolist(), leaf.tolist(), strict=True))
    reach = {}
    for q, c in zip(*(x.tolist() for x in trie.reached(vectors)), strict=True):
        reach.setdefault(q, set()).add(c)
    for i in range(len(vectors)):
        for j in range(len(vectors)):
            diff = vectors[j].astype(int) - vectors[i]
            if diff.clip(0).sum() <= 1 and (-diff).clip(0).sum() <= 1:
                assert home[j] in reach[i]


@pytest.mark.parametrize("cell", [20, 100_000])
def test_variants_are_those_of_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL_WORDS", cell)
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 150)
    counts = vocabulary(cell)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(words_frame(spark, counts)).collect()}
    assert got == plain_variants(counts)
    assert any(v[0] and v[1] != v[0] for v in got.values())  # forms of forms


def test_ties_long_words_and_no_words(spark):
    long = "ab" * 60_000
    counts = {"aaaaaaaa": 2, "aaaaaaab": 40, "aaaaaaac": 40, long: 3, long + "c": 30, "bbbbbbbbb": 7, "zz": 50}
    got = {r.word: r for r in spelling_variants(words_frame(spark, counts)).collect()}
    assert got["aaaaaaaa"].form == "aaaaaaab" and got["aaaaaaaa"].n_near == 2
    assert got[long].root == long + "c" and got["bbbbbbbbb"].form is None and got["bbbbbbbbb"].root == "bbbbbbbbb"
    assert "zz" not in got
    empty = words_frame(spark, counts).limit(0)
    assert spelling_variants(empty).count() == 0 and near_words(empty).count() == 0


def plain_words(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def odd_texts():
    rng = random.Random(11)
    base = ["Strassen", "straßen", "RÉSUMÉS", "résumés", "children", "Childrens", "wordword", "naïveté", "multi×ply÷x", "abcdefg"]
    rows = [(None, None), (1, ""), (2, " \n"), (None, "children children"), (3, "children"), (3, "children"), (4, "漢字children漢children_9children"),
            (5, "x" * 70_000 + " " + "x" * 70_000), (6, "Ÿabcdefg ſabcdefg")]
    return rows + [(10 + i, " ".join(rng.choice(base) for _ in range(rng.randrange(60)))) for i in range(300)]


def test_words_of_texts(documents_of):
    rows = odd_texts()
    docs = documents_of(rows).withColumns({"k": F.lit(1), "run": F.lit("x"), "word": F.lit("y"), "n": F.lit(2)})
    assert {r.word: r.n for r in damaged_words(docs).collect()} == plain_words(rows)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in document_variants(docs).collect()}
    assert got == plain_variants(plain_words(rows))
    assert document_variants(docs.limit(0)).count() == 0


def test_sql_states_the_same_rows(spark, documents_of, tmp_path):
    from tte.llm.conversation_repair import repair_digest
    from tte.llm.sqltext import REPAIR, VARIANTS

    rng = random.Random(4)
    turns = [(c if c else None, rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", None, "tool"]),
              rng.choice(["Good.", "no end", None, "", "Why? ", "Said."])) for c in range(60) for _ in range(rng.randrange(1, 9))]
    tables = {"documents": documents_of(odd_texts()[:-200]),
              "conversations": spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")}
    con = duckdb.connect()
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}/*.parquet'")
    for sql, df in ((VARIANTS, document_variants(tables["documents"])), (REPAIR, repair_digest(tables["conversations"]))):
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def test_depth_has_a_level_for_every_letter():
    words = Words(pa.array(["abcdefghijklmnopqrstuvwxyzàÿ"]))
    assert words.vectors().shape == (1, DEPTH) and words.vectors().sum() == 28
