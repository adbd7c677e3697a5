"""License scans by diagonal voting.

Every run of ``K`` words of every document is hashed and joined, in Spark, with the positions of equal
runs in the license templates. A copied license puts its matches on one diagonal (position in the
document less position in the template); votes are summed by document, template and diagonal, and
diagonals at most ``DRIFT`` words apart are merged, since a changed or missing word shifts the rest.
Each merged span is then verified word by word against the template: the share of the template's words
that stand at a place the span's diagonals allow is its coverage. Licenses share most of their wording,
and a short notice shares it with plain sentences, so the words that tell a license apart (``TELLING``:
its name, its version) must stand in the span too, at most ``DRIFT`` words from their place.

The templates are a fixed table of this module, so the side that is broadcast never grows. Votes are
keyed by the text's hash, so copies of a text are scanned once and one text's hits meet in one group
bounded by its own length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tte.llm.common import small_side, written
from tte.llm.textnum import ALNUM, LOWER, binary_column, list_column, prefix_hash, range_hash, run_hash, slices, word_spans

K = 3
DRIFT = 3
MIN_COVERAGE = 0.6

# fixed values: phrases and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# fixed values: license notices and their labels
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
     " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
     " applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
     " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
     " permissions and limitations under the License."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights"
     " to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to"
     " whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission"
     " notice shall be included in all copies or substantial portions of the Software."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
     " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
     " License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
     " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions"
     " and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
     " provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
)

# fixed values: what a notice must say besides, per label; one alternative of each group
TELLING = {
    "apache-2.0": (("apache license 2", "apache license v2"),),
    "mit": (("mit license", "mit licence", "this permission notice shall be included in all copies"),),
    "gpl-3.0": (("gnu general public license",), ("version 3", "v3")),
    "gpl-2.0": (("gnu general public license",), ("version 2", "v2")),
    "isc": (("this permission notice appear in all copies",),),
    "cc-by-4.0": (("creative commons attribution 4", "creative commons attribution v4"),),
    "cc-by-nc-4.0": (("cc by nc 4", "cc by nc v4"),),
}
#: Words that may stand between those of ``TELLING``: they name no other license.
FILL = ("license", "licence", "version", "v", "international", "public", "software")


def _words(buf: np.ndarray, bounds: np.ndarray):
    """Word hashes (letters and digits in lower case, and everything beyond ASCII) and their texts."""
    low = LOWER[buf]
    starts, ends, doc = word_spans(low, bounds, ALNUM)
    return range_hash(prefix_hash(low), starts, ends), doc


def _hashes(text: str) -> np.ndarray:
    raw = text.encode()
    return _words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]


def _columns(batch, names):
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def _scan_batches(phrases: dict[str, str]):
    """Base columns of each text and the hashes of its runs of ``K`` words."""
    targets = [(_hashes(p), label) for p, label in phrases.items()]

    def run(batches):
        for batch in batches:
            data, offs = binary_column(batch, "text")
            (keys,) = _columns(batch, ("key",))
            for lo, hi in slices(offs):
                docs = hi - lo
                words, doc = _words(data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo])
                n = np.bincount(doc, minlength=docs)
                begin = np.concatenate(([0], np.cumsum(n)))
                found, first = np.zeros(docs, np.int64), np.full(docs, np.iinfo(np.int64).max)
                last, labels = np.full(docs, -1), [set() for _ in range(docs)]
                for target, label in targets:
                    m = len(words) - len(target) + 1
                    if m <= 0:
                        continue
                    hit = doc[:m] == doc[len(target) - 1:]
                    for j, h in enumerate(target):
                        hit &= words[j: j + m] == h
                    at = np.flatnonzero(hit)
                    who, place = doc[at], at - begin[doc[at]]
                    found += np.bincount(who, minlength=docs)
                    np.minimum.at(first, who, place)
                    np.maximum.at(last, who, place)
                    for d in np.unique(who):
                        labels[d].add(label)
                runs = run_hash(words, K)
                inside = doc[: len(runs)] == doc[K - 1:] if len(runs) else np.zeros(0, bool)
                none = found == 0
                yield pa.RecordBatch.from_arrays([
                    keys.slice(lo, docs), pa.array(n.astype(np.int64)), pa.array(found),
                    pa.array(first, mask=none), pa.array(last, mask=none), pa.array([",".join(sorted(x)) for x in labels]),
                    list_column(runs[inside].view(np.int64), np.bincount(doc[: len(runs)][inside], minlength=docs), pa.int64())],
                    names=["key", "n_words", "n_base", "first_word", "last_word", "base_labels", "runs"])
    return run


def _stands(words: np.ndarray, at: int, phrase: np.ndarray, fill: np.ndarray) -> bool:
    """Whether the phrase begins at a place, with nothing but ``fill`` words between its own."""
    if not 0 <= at < len(words) or words[at] != phrase[0]:
        return False
    for h in phrase[1:]:
        at += 1
        while at < len(words) and words[at] != h and words[at] in fill:
            at += 1
        if at >= len(words) or words[at] != h:
            return False
    return True


def _telling(templates):
    """Per template the groups of ``TELLING``, each with its place in the template and its phrases."""
    fill = _hashes(" ".join(FILL))
    out = []
    for label, text in templates:
        side, groups = _hashes(text), []
        for group in TELLING.get(label, ()):
            phrases = [_hashes(p) for p in group]
            place = next((i for i in range(len(side)) if any(_stands(side, i, p, fill) for p in phrases)), None)
            if place is not None:
                groups.append((place, phrases))
        out.append(groups)
    return out, fill


def _verify_batches(templates):
    """Coverage of each span: the share of the template's words found on the span's diagonals; 0 if the
    words that tell the license apart are not there."""
    sides = [_hashes(t) for _, t in templates]
    telling, fill = _telling(templates)

    def told(mine, span):
        return all(any(_stands(mine, at, p, fill) for at in range(place + span["low"] - DRIFT, place + span["high"] + DRIFT + 1) for p in phrases)
                   for place, phrases in telling[span["template"]])

    def run(batches):
        for batch in batches:
            data, offs = binary_column(batch, "text")
            keys, spans = _columns(batch, ("key", "spans"))
            spans = spans.to_pylist()
            out = []
            for lo, hi in slices(offs):
                words, doc = _words(data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo])
                begin = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=hi - lo))))
                for row in range(lo, hi):
                    mine = words[begin[row - lo]: begin[row - lo + 1]]
                    for s in spans[row]:
                        side = sides[s["template"]]
                        seen = np.zeros(len(side), bool)
                        for d in range(s["low"], s["high"] + 1):
                            a, b = max(0, -d), min(len(side), len(mine) - d)
                            if a < b:
                                seen[a:b] |= side[a:b] == mine[a + d: b + d]
                        out.append((row, s["template"], s["first"], s["last"], float(seen.mean()) if told(mine, s) else 0.0))
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array([o[0] for o in out], pa.int64())), *(pa.array([o[i] for o in out], t) for i, t in (
                    (1, pa.int32()), (2, pa.int64()), (3, pa.int64()), (4, pa.float64())))],
                names=["key", "template", "first", "last", "coverage"])
    return run


def find_spans(texts: DataFrame, runs: DataFrame, templates=TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Verified spans ``key, template, first, last, coverage`` (words, both ends included) of the texts
    (``key, text``) whose runs (``key, runs``) match a template."""
    spark = texts.sparkSession
    table = [(i, t, int(h)) for i, (_, text) in enumerate(templates) for t, h in enumerate(run_hash(_hashes(text), K).view(np.int64))]
    places = F.broadcast(spark.createDataFrame(table, "template int, tpos int, run bigint"))
    votes = (runs.select("key", F.posexplode_outer("runs").alias("pos", "run")).join(places, "run")
             .groupBy("key", "template", (F.col("pos") - F.col("tpos")).alias("diagonal"))
             .agg(F.count(F.lit(1)).alias("votes"), F.min("pos").alias("a"), F.max("pos").alias("b")))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    merged = (votes.withColumn("new", (F.col("diagonal") - F.lag("diagonal", 1, -(1 << 30)).over(order) > DRIFT).cast("int"))
              .withColumn("group", F.sum("new").over(order))
              .groupBy("key", "template", "group")
              .agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.min("a").alias("first"),
                   (F.max("b") + (K - 1)).alias("last")))
    found = written(merged.groupBy("key").agg(F.collect_list(F.struct(
        "template", F.col("low").cast("int").alias("low"), F.col("high").cast("int").alias("high"),
        F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))).alias("spans")), "license-spans")
    verified = (texts.join(small_side(found), "key").select("key", "text", "spans")
                .mapInArrow(_verify_batches(templates), "key binary, template int, first bigint, last bigint, coverage double"))
    return verified.where((F.col("coverage") >= min_coverage) & (F.col("coverage") > 0)).distinct()


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES,
                  min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per document: ``key, n_words, n_base, first_word, last_word, base_labels`` of the phrases,
    ``labels`` (those and the templates') and ``score``, the best coverage of a template (0 without a
    verified span).

    Null and empty texts have no words, no place and empty labels. Repeated rows get equal results,
    rows without an id too. An empty table gives an empty result. Only the named columns are read."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    own = docs.select(F.col(key).alias("doc"), raw.alias("text"), F.unhex(F.md5(raw)).alias("key"))
    scanned = own.select("key", "text").mapInArrow(
        _scan_batches(phrases), "key binary, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
        " runs array<bigint>")
    spans = find_spans(own.select("key", "text"), scanned.select("key", "runs"), templates, min_coverage)
    label = F.element_at(F.array(*[F.lit(name) for name, _ in templates]), F.col("template") + 1)
    labelled = written(spans.groupBy("key").agg(F.collect_set(label).alias("found"), F.max("coverage").alias("score")), "license-labels")
    base = written(scanned.drop("runs").distinct(), "license-base")
    both = F.array_union(F.when(F.col("base_labels") == "", F.array().cast("array<string>")).otherwise(F.split("base_labels", ",")),
                         F.coalesce("found", F.array().cast("array<string>")))
    per_text = base.join(labelled, "key", "left").select(
        "key", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.concat_ws(",", F.array_sort(both)).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
    return own.select("doc", "key").join(per_text, "key").drop("key").withColumnRenamed("doc", key)

