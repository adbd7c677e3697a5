"""Quality rules: a threshold table compiled into one Spark projection, no user functions.

The document's measures are built-in expressions over its text; ``RULES`` names a measure, a
comparison and a bound per row, and ``verdict`` turns the table into one Boolean column. Nothing is
shuffled: a document's measures need only its own text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.llm.mixing import WORD

# fixed values: frequent function words of the languages served
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "for", "on", "are", "was",
    "der", "die", "das", "und", "von", "zu", "mit", "den", "des", "ein", "nicht", "sich", "auf",
    "le", "la", "les", "de", "et", "un", "une", "du", "que", "dans", "est", "pour", "en",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "para", "su", "al", "lo", "como",
)

#: (measure, comparison, bound): a document is kept if every comparison holds.
RULES: tuple[tuple[str, str, float], ...] = (
    ("mean_word_chars", ">=", 2.0),
    ("mean_word_chars", "<=", 15.0),
    ("symbols_per_word", "<=", 0.2),
    ("exclaims_per_word", "<=", 0.4),
    ("dup_line_share", "<=", 0.3),
    ("repeat_word_share", "<=", 0.3),
    ("stop_word_share", ">=", 0.02),
)

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
_COMPARE = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b}


def verdict(rules: tuple[tuple[str, str, float], ...] = RULES) -> Column:
    """The threshold table as one Boolean expression over the measure columns."""
    out = F.lit(True)
    for measure, op, bound in rules:
        out = out & _COMPARE[op](F.col(measure), F.lit(bound))
    return out


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures the rules read; every other column of ``docs`` stays.

    Null and empty texts have no words: counts are 0 and the ratios are 0. The repeat count hashes
    every window of ``WINDOW`` words; only a text with two equal hashes goes further: its (hash,
    position) pairs are sorted, those with an equal neighbour are put back in order of position, and
    each covers up to ``WINDOW`` words, fewer if the next one starts earlier. Internal columns carry
    a prefix that no table is expected to use; a clash raises."""
    taken = [c for c in docs.columns if c.startswith("_qr_")]
    if taken:
        raise ValueError(f"columns {taken} clash with internal ones")
    col, zero_pairs = F.col, F.array().cast("array<struct<h:bigint,i:int>>")
    n = F.size("_qr_words")
    out = (docs
           .withColumn("_qr_text", F.coalesce(F.col(text), F.lit("")))
           .withColumn("_qr_words", F.regexp_extract_all("_qr_text", F.lit(WORD), F.lit(0)))
           .withColumn("_qr_lines", F.filter(F.split("_qr_text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
           .withColumn("_qr_windows", F.when(n > WINDOW, F.transform(
               F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_qr_words", i, WINDOW)))))
           .withColumn("_qr_sorted", F.when(
               F.size(F.array_distinct("_qr_windows")) < F.size("_qr_windows"),
               F.sort_array(F.transform("_qr_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
               .otherwise(zero_pairs))
           .withColumn("_qr_hits", F.sort_array(F.transform(F.filter("_qr_sorted", lambda x, i: F.coalesce(
               F.get("_qr_sorted", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
               F.get("_qr_sorted", i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
           .withColumn("n_words", n.cast("long"))
           .withColumn("word_chars", F.length(F.regexp_replace("_qr_text", r"[\x20\x09-\x0D]+", "")).cast("long"))
           .withColumn("n_symbols", F.length(F.regexp_replace("_qr_text", r"[^#*$%&|<>]+", "")).cast("long"))
           .withColumn("n_exclaims", F.length(F.regexp_replace("_qr_text", "[^!]+", "")).cast("long"))
           .withColumn("n_lines", F.size("_qr_lines").cast("long"))
           .withColumn("n_dup_lines", (F.size("_qr_lines") - F.size(F.array_distinct("_qr_lines"))).cast("long"))
           .withColumn("n_repeat_words", F.when(F.size("_qr_hits") > 0, F.aggregate(
               F.transform("_qr_hits", lambda p, i: F.least(
                   F.lit(WINDOW), F.coalesce(F.get("_qr_hits", i + 1) - p, F.lit(WINDOW)))),
               F.lit(0), lambda a, x: a + x)).otherwise(0).cast("long"))
           .withColumn("n_stop_words", F.size(F.filter(
               "_qr_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long")))
    ratio = lambda a, b: F.when(col(b) > 0, col(a) / col(b)).otherwise(0.0)
    out = (out.withColumn("mean_word_chars", ratio("word_chars", "n_words"))
           .withColumn("symbols_per_word", ratio("n_symbols", "n_words"))
           .withColumn("exclaims_per_word", ratio("n_exclaims", "n_words"))
           .withColumn("dup_line_share", ratio("n_dup_lines", "n_lines"))
           .withColumn("repeat_word_share", ratio("n_repeat_words", "n_words"))
           .withColumn("stop_word_share", ratio("n_stop_words", "n_words")))
    return out.drop("_qr_text", "_qr_words", "_qr_lines", "_qr_windows", "_qr_sorted", "_qr_hits")


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  rules: tuple[tuple[str, str, float], ...] = RULES) -> DataFrame:
    """One row per document: its measures, ``base_failed`` (too few words, or too many in repeated
    windows) and ``kept`` (no base failure and every rule holds).

    Null and empty texts fail the base. Repeated rows are judged alike, each on its own; null keys
    pass through; only ``key`` and ``text`` are read, so further columns cannot clash."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (measures(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text")
            .withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & verdict(rules))
            .withColumnRenamed("_key", key).drop("_text"))
