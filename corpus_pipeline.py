"""A training corpus from raw documents, in five stages.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and returns what
it keeps of ``docs``, all but the last with the same columns. ``run`` applies them to ``documents``,
writing each stage's result and reading it again as the next one's input.

Rows are handled whole (packed in a struct), so columns that an operator adds cannot clash with theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tte.llm.common import documents, drop_written, fold, ready, scratch_path, small_side, written
from tte.llm.decontaminate import SHINGLE, find_leaks
from tte.llm.language_id import GRAM, UNKNOWN, identify, learn
from tte.llm.mixing import take_mix
from tte.llm.near_dedup import near_classes, text_digest
from tte.llm.suffix_dedup import remove_repeats

#: A document stays if this share of its n-grams is found in its language.
MIN_LANGUAGE_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the labelled ones teach: a null or empty text, one without a letter, and one whose
    n-grams are foreign to every language go. A score is a share of n-grams, so a text of few n-grams may score
    low by chance: it goes only if its score is below the bound by more than its uncertainty, the inverse root of
    their number. Learns from the texts with a language of two thirds of the ids. Repeated rows are judged alike, very long
    texts whole; an empty table gives an empty one; other columns, whatever their names, stay as they are."""
    ready(spark)
    model = learn(docs.where(fold("doc_id", 3) != 1))
    found = identify(docs.select(F.struct("*").alias("row"), F.col("text").alias("text")), model)
    grams = F.greatest(F.octet_length("text") - (GRAM - 1), F.lit(1))
    known = F.col("score") + 1.0 / F.sqrt(grams) >= MIN_LANGUAGE_SCORE
    return found.where((F.col("lang_pred") != UNKNOWN) & known).select("row.*")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id (rows without an id come last; ties:
    the text of the smallest digest; of rows that repeat id and text the smallest row). Classes are of texts, so
    different texts under one id are documents of their own. Null, empty and blank texts are in no class and
    stay. Very long texts are compared whole; an empty table gives an empty one; other columns, whatever their
    names, stay as they are."""
    ready(spark)
    key = lambda doc, digest: F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"), digest)
    classes = written(near_classes(docs).where("class_key is not null").groupBy("class_key", "doc", "digest").agg(
        F.count(F.lit(1)).alias("rows")), "stage-classes")
    first = F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", "digest", "rows")).alias("x")
    best = classes.groupBy("class_key").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1 or x.rows > 1")
    best = small_side(written(best.select("class_key", key(F.col("x.doc"), F.col("x.digest")).alias("best"), F.col("x.rows").alias("again")), "stage-best"))
    gone = classes.select("class_key", key(F.col("doc"), F.col("digest")).alias("k")).join(best, "class_key").where("k <> best").select("k")
    gone = small_side(written(gone, "stage-copies"))
    keyed = docs.select(F.struct("*").alias("row"), key(F.col("doc_id"), text_digest(F.col("text"))).alias("k")).join(gone, "k", "left_anti")
    again = small_side(written(best.where("again > 1").select(F.col("best").alias("k")), "stage-repeated"))
    once = keyed.join(again, "k", "left_semi").groupBy("k").agg(F.min("row").alias("row"))
    return keyed.join(again, "k", "left_anti").select("row.*").unionByName(once.select("row.*"))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that stand more than once. Where a cut falls
    inside a character, its remaining bytes go too (and, in a text that is cut, any U+FFFD). ``n_chars``
    follows the text. Null and empty texts stay as they are; rows that repeat a text lose what they share; an empty table
    gives an empty one; other columns, whatever their names, stay as they are."""
    ready(spark)
    cut = remove_repeats(docs.select(F.struct("*").alias("row"), F.col("text").alias("text")))
    text = F.when(F.col("n_removed") > 0, F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "�", "")).otherwise(F.col("text"))
    cut = cut.withColumn("cut", text)
    kinds = dict(docs.dtypes)
    columns = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("cut")}
    if "n_chars" in kinds:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("cut").cast(kinds["n_chars"])).otherwise(F.col("row")["n_chars"])
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item of at least ``SHINGLE`` words (a shorter one, such as a single common
    word, is in many clean documents). A text is judged, not an id, so rows without an id and
    rows that share one are judged each by their own text. Null and empty texts stay; an empty table gives an empty one."""
    ready(spark)
    keyed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("key"))
    leaks = find_leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="key")
    found = small_side(written(leaks.where(F.col("n_words") >= SHINGLE).select("key").distinct(), "stage-leaks"))
    return keyed.join(found, "key", "left_anti").select("row.*")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix by source weight takes, with ``repeats``, how often each counts. Null and empty texts
    have no words and take no part in the budget; equal ids hash alike; an empty table gives an empty one; a column
    ``repeats`` of the table is replaced."""
    ready(spark)
    return take_mix(docs)


STAGES = [("language_id", language_stage), ("near_dedup", near_stage), ("suffix_dedup", suffix_stage),
          ("decontaminate", leak_stage), ("mix_sources", mix_stage)]

#: The stages learn models, sort suffixes and cut bytes; SQL cannot state their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ready(spark)
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            drop_written(spark, before)
        before = path
    return docs
