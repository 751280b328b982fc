"""The queries of this package: the operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    bpe,
    decontamination,
    filter_audit,
    fingerprints,
    html_text,
    jaccard,
    licences,
    mixing,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    toxicity,
    warc,
)
from millrace.sources import table


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is; every executor has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, folder, "documents"), "doc_id", "text")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    models = toxicity.train(docs, labels, "doc_id", "text", "toxic", usable=~toxicity.held_out(F.col("id")))
    scored = docs.select("doc_id", toxicity.score(F.col("text"), models).alias("score"))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontamination.contaminated(docs, items, "doc_id", "text", "item_id", "text")


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", "text")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components_by_id(table(spark, folder, "documents"), "doc_id", "text", k=4, percent=85)


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"), "doc_id", "text", licences.known_licences(spark))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), "doc_id", "text", "source")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"), "page_id", "url", "html")


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", "text")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.archived(table(spark, folder, "pages"), "page_id", "url", "html")
    return records.select(
        warc.id_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.id_of(F.col("refers_to")).alias("refers_to"),
    )


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return token_alignment.align(table(spark, folder, "documents"), "doc_id", "text", *files)


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id", "text", "lang")


def op13_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer_file("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, folder, "documents"), "doc_id", "text", path), path)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_jaccard": op5_jaccard,
    "op6_licences": op6_licences,
    "op7_mixing": op7_mixing,
    "op8_html_text": op8_html_text,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_warc": op10_warc,
    "op11_token_alignment": op11_token_alignment,
    "op12_filter_audit": op12_filter_audit,
    "op13_bpe": op13_bpe,
}

SQL: dict[str, str] = {
    "op4_substring_dedup": substring_dedup.removed_sql(),
    "op5_jaccard": jaccard.components_sql(4, 85),
    "op6_licences": licences.scan_sql(),
    "op7_mixing": mixing.mix_sql(),
    "op10_warc": warc.archived_sql(),
    "op12_filter_audit": filter_audit.audit_sql(),
}
