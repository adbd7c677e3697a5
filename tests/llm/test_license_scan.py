"""Phrases by a plain search, template spans by planted copies."""

import re

import pytest

from tte.llm.license_scan import PHRASES, TEMPLATES, find_spans, scan_licenses


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_base(text):
    w, places, labels = words(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LONG = TEMPLATES[3][1]
ROWS = [
    (1, "Some text. Released under the MIT License. More text."),
    (2, "intro " * 40 + LONG + " outro" * 30),
    (3, "intro " * 5 + LONG.replace("without restriction, including", "with no restriction at all, including")),
    (4, "cc by cc by-nc mit LICENSE é apache\nlicense gnu general public license"),
    (5, "nothing here at all, only words about permission and copyright notice"),
    (6, "Licensed under CC BY-NC 4.0. " * 50),
    (7, " ".join(LONG.split()[:12])),
    (8, "x " * 30_000 + "This work is licensed under the GNU General Public License, version 3."),
]


@pytest.fixture(scope="module")
def scanned(documents_of, odd_rows):
    rows = ROWS + [(r[0], r[1]) for r in odd_rows if r[0] is None or r[0] > 8] + [(20, None), (21, ""), (22, ROWS[0][1]), (22, ROWS[0][1])]
    return rows, scan_licenses(documents_of(rows)).collect()


def test_base_columns(scanned):
    rows, got = scanned
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((key((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got)) == sorted(
        key((i, *brute_base(t))) for i, t in rows)


def test_labels_and_score(scanned):
    got = {r.doc_id: r for r in scanned[1]}
    assert got[1].labels == "mit" and got[1].score == 1.0
    assert got[2].labels == "mit" and got[2].score == 1.0
    assert got[3].labels == "mit" and 0.9 < got[3].score < 1.0
    assert got[5].labels == "" and got[5].score == 0.0 and got[7].score == 0.0
    assert got[6].labels == "cc-by,cc-by-nc-4.0" and got[8].labels == "gpl,gpl-3.0"
    assert got[20].labels == "" and got[21].n_words == 0


def test_spans(spark):
    from pyspark.sql import functions as F

    from tte.llm.license_scan import _scan_batches

    texts = spark.createDataFrame([(bytes([i]), bytearray(t.encode())) for i, t in ROWS], "key binary, text binary")
    runs = texts.mapInArrow(_scan_batches(PHRASES), "key binary, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
                            " base_labels string, runs array<bigint>")
    got = {(r.key[0], r.first): r.last for r in find_spans(texts, runs).where(F.col("template") == 3).collect()}
    assert got[2, 40] == 40 + len(words(LONG)) - 1


NEAR = [
    ("The album was released under the title X", ""),
    ("He was released under the Mental Health Act of that year", ""),
    ("Licensed under the Mozilla Public License, Version 2.0", ""),
    ("Licensed under the Mozilla Public License, Version 2.0; not the Apache License", "apache"),
    ("Licensed under the Apache License, Version 1.1", "apache"),
    ("Licensed under the Apache License, Version 2.0", "apache,apache-2.0"),
    ("Licensed under the Apache License 2.0", "apache,apache-2.0"),
    ("Licensed under Apache License, Version 2.0", "apache,apache-2.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("Licensed under CC BY-NC-SA 4.0", "cc-by"),
    ("Licensed under CC BY-NC 3.0", "cc-by"),
    ("Licensed under CC BY-NC version 4.0", "cc-by,cc-by-nc-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ""),
    ("This work is licensed under a Creative Commons Attribution 3.0 Unported License", ""),
    ("This work is licensed under the GNU General Public License, version 2", "gpl"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl,gpl-3.0"),
    (TEMPLATES[5][1], "gpl,gpl-3.0"),
    (TEMPLATES[6][1], "gpl,gpl-2.0"),
    (TEMPLATES[5][1].replace("General", "Lesser General"), ""),
    (LONG, "mit"),
    (LONG[:LONG.index("The above copyright")], ""),
    (TEMPLATES[8][1], "isc"),
    (TEMPLATES[7][1], "bsd"),
    (TEMPLATES[1][1], "apache,apache-2.0"),
]


def test_other_licenses_and_plain_sentences(documents_of):
    docs = documents_of([(i, f"Some words before. {t}. And some words after it.") for i, (t, _) in enumerate(NEAR)])
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert {t: got[i].labels for i, (t, _) in enumerate(NEAR)} == dict(NEAR)
    assert all((got[i].score > 0) == (got[i].labels != got[i].base_labels) for i in got)


def test_empty_table(documents_of):
    assert scan_licenses(documents_of(ROWS).limit(0)).count() == 0
