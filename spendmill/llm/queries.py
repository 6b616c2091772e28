"""Driver queries of the corpus operators: `opN_<name>`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendmill.llm.license_scan import scan_licences, summarise

    return summarise(scan_licences(table(spark, sf_dir, "documents")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendmill.llm.line_dedup import remove_repeated_lines

    out = remove_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_removed", "line_dedup.text")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendmill.llm.decontamination import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendmill.llm.substring_dedup import remove_repeated_windows

    return remove_repeated_windows(table(spark, sf_dir, "documents")).drop("kept")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from spendmill.llm.token_counts import count_tokens

    counted = count_tokens(table(spark, sf_dir, "documents"), path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from spendmill.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendmill.llm.html_text import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendmill.llm.suffix_dedup import remove_repeated_bytes

    return remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendmill.llm.quality_rules import score_documents

    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendmill.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendmill.llm.source_divergence import audit_sources

    return audit_sources(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from spendmill.llm.token_alignment import align_tokens, count_links

    aligned = align_tokens(
        table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
    )
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return count_links(aligned.withColumn("groups_sha256", digest).drop("groups"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from spendmill.llm.byte_bpe import decode_ids, encode_texts

    ranks = path("byte_bpe_50k.tiktoken")
    decoded = decode_ids(encode_texts(table(spark, sf_dir, "documents"), ranks), ranks)
    return decoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    name: query for name, query in list(globals().items()) if name.startswith("op") and name[2].isdigit()
}
