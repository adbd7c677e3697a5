"""The registered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.llm import sqltext
from tte.llm.common import documents, fold
from tte.llm.conversation_repair import repair_digest
from tte.llm.decontaminate import find_leaks
from tte.llm.language_id import identify, learn
from tte.llm.license_scan import scan_licenses
from tte.llm.lm_score import lm_scores
from tte.llm.mixing import mix
from tte.llm.near_dedup import near_duplicates
from tte.llm.packing import pack_documents
from tte.llm.quality_model import quality_scores
from tte.llm.quality_rules import quality_rules
from tte.llm.registry import register
from tte.llm.spelling import document_variants
from tte.llm.suffix_dedup import repeat_digest
from tte.llm.warc import read_warc, write_warc


@register("op1_mix_sources", sqltext.MIX)
def op1_mix_sources(spark, sf_dir) -> DataFrame:
    """All documents mixed by source weight: rows with their source's size and target and the words taken."""
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@register("op2_warc", sqltext.WARC)
def op2_warc(spark, sf_dir) -> DataFrame:
    """Every page written to WARC archives and read back through their index."""
    index = write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_warc(index, with_payload=False).drop("payload", "url")


@register("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir) -> DataFrame:
    """Every document without the bytes of repeated 200-byte strings, as a digest."""
    return repeat_digest(documents(spark, sf_dir))


@register("op4_quality_rules", sqltext.QUALITY)
def op4_quality_rules(spark, sf_dir) -> DataFrame:
    """Measures and verdict of every document."""
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op5_decontaminate", sqltext.LEAKS)
def op5_decontaminate(spark, sf_dir) -> DataFrame:
    """Every pair of a document and a benchmark item that the document contains."""
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register("op6_license_scan")
def op6_license_scan(spark, sf_dir) -> DataFrame:
    """License phrases, labels and template coverage of every document."""
    return scan_licenses(documents(spark, sf_dir))


@register("op7_lm_score")
def op7_lm_score(spark, sf_dir) -> DataFrame:
    """Kneser-Ney and add-0.1 scores of every document; every tenth fold is held out."""
    return lm_scores(documents(spark, sf_dir), fold("doc_id", 10) == 0)


@register("op8_near_dedup")
def op8_near_dedup(spark, sf_dir) -> DataFrame:
    """Every document with the class of its near copies."""
    return near_duplicates(documents(spark, sf_dir))


@register("op9_quality_model")
def op9_quality_model(spark, sf_dir) -> DataFrame:
    """Quality score of every document; every fifth fold is held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(documents(spark, sf_dir), labels, lambda key: fold(key, 5) == 0)


@register("op10_language_id")
def op10_language_id(spark, sf_dir) -> DataFrame:
    """Predicted language of every document; every third fold is held out."""
    docs = documents(spark, sf_dir)
    model = learn(docs.where(fold("doc_id", 3) != 1))
    return identify(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@register("op11_repair_conversations", sqltext.REPAIR)
def op11_repair_conversations(spark, sf_dir) -> DataFrame:
    """Every conversation, damaged by rule: its faults, the cheapest repair and a hash of the result."""
    return repair_digest(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@register("op12_pack_sequences")
def op12_pack_sequences(spark, sf_dir) -> DataFrame:
    """All documents, tokenized, in sequences of at most 2048 tokens."""
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


@register("op13_spelling_variants", sqltext.VARIANTS)
def op13_spelling_variants(spark, sf_dir) -> DataFrame:
    """Words of all documents, damaged by rule, with the spelling each is a variant of."""
    return document_variants(documents(spark, sf_dir))
