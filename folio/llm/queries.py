"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.llm.base import table
from folio.llm.decontaminate import leaks
from folio.llm.jaccard import jaccard_classes
from folio.llm.merkle import merkle_report
from folio.llm.packing import pack
from folio.llm.perplexity import quality_rules
from folio.llm.phrases import remove_phrases
from folio.llm.pii import pii_report
from folio.llm.quality import quality_scores
from folio.llm.secrets import secret_report
from folio.llm.spelling import spelling_report
from folio.llm.suffix import remove_repeats
from folio.llm.tokens import token_files
from folio.llm.toxicity import toxicity_scores


def vocabulary() -> str:
    """The path of the tokenizer; on a cluster it is installed at the same place everywhere."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "cost")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary(), limit=2048, end_id=0)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), vocabulary(), end_id=1)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_report(table(spark, sf_dir, "documents"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_phrases(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_secret_scan, op3_decontamination, op4_toxicity, op5_pii, op6_quality_rules, op7_suffix_dedup,
        op8_best_fit_packing, op9_token_files, op10_jaccard_join, op11_merkle_manifest,
        op12_spelling_variants, op13_substring_dedup,
    )
}
