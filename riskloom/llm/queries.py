"""The registered query of each operator, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import ensure_work_folder
from riskloom.llm.oracles import ORACLES
from riskloom.session import work_folder

__all__ = ["ORACLES", "QUERIES"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ensure_work_folder(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.token_count import count_tokens

    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_markov_chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.chat import format_chats

    held_out = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 7 == 2
    out = format_chats(read(spark, sf_dir, "conversations"), ~held_out)
    return out.drop("content").withColumn("held_out", held_out)


def op3_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.neardup import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), size=3, part=85, whole=100)


def op4_template_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.template import main_text

    return main_text(read(spark, sf_dir, "pages"))


def op5_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.quality import quality_rules

    out = quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.drop("text_hash")


def op6_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.wavelet import documents_of, read_shards, write_shards

    docs = read(spark, sf_dir, "documents")
    path = work_folder(spark, "shards")
    write_shards(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return documents_of(read_shards(spark, path))


def op7_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.packing import pack

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_pitman_yor_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.language_model import held_out_by_checksum, score

    return score(read(spark, sf_dir, "documents"), held_out_by_checksum())


def op9_string_tiling_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.tiling import contamination_report

    return contamination_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_suffix_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.suffix import remove_repeats

    docs = read(spark, sf_dir, "documents").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    out = remove_repeats(docs.select("doc_id", "n_bytes", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.lines import deduplicate_lines

    out = deduplicate_lines(read(spark, sf_dir, "documents"), least_docs=2, least_chars=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_automaton_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.search import search

    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), top=10)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.negatives import hard_negatives

    return hard_negatives(read(spark, sf_dir, "embeddings"), every=100, positives=5, negatives=5, share=80)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_markov_chat_roles": op2_markov_chat_roles,
    "op3_setsketch_near_duplicates": op3_setsketch_near_duplicates,
    "op4_template_main_text": op4_template_main_text,
    "op5_risk_controlled_quality": op5_risk_controlled_quality,
    "op6_wavelet_ids": op6_wavelet_ids,
    "op7_bin_slack_packing": op7_bin_slack_packing,
    "op8_pitman_yor_score": op8_pitman_yor_score,
    "op9_string_tiling_leaks": op9_string_tiling_leaks,
    "op10_suffix_sort_dedup": op10_suffix_sort_dedup,
    "op11_line_dedup": op11_line_dedup,
    "op12_automaton_search": op12_automaton_search,
    "op13_hard_negatives": op13_hard_negatives,
}
