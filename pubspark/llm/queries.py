"""One thin query per operator: its production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pubspark.llm import (
    byte_pair, chosen_paths, license_diagonals, pair_sql, personal_data, quality_rules, record_files, sequence_packing,
    source_mix, spelling_variants, subspace_join, tag_paths, toxic_passages, vector_codes)
from pubspark.llm.common import read_table


def op1_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op2_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_diagonals.scan_licenses(read_table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data_report(read_table(spark, sf_dir, "documents"))


def op4_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxic_passages.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxic_passages.toxicity_report(docs, model)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents"))


def op6_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract_pages(read_table(spark, sf_dir, "pages"))


def op7_byte_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pair.round_trip(read_table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)


def op8_chosen_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_paths.near_duplicates(read_table(spark, sf_dir, "documents")).drop("own")


def op9_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence_packing.pack_documents(read_table(spark, sf_dir, "documents"),
                                           public_tokenizers.path("word_bpe_49k.json"))


def op10_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_files.round_trip(read_table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.taken_words(read_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_subspace_join, op2_license_diagonals, op3_personal_data, op4_toxic_passages, op5_quality_rules, op6_tag_paths,
    op7_byte_pair, op8_chosen_paths, op9_sequence_packing, op10_record_files, op11_spelling_variants, op12_source_mix, op13_vector_codes)}

LLM_ORACLE_SQL = {"op1_subspace_join": pair_sql.near_vectors_sql(), "op8_chosen_paths": pair_sql.near_duplicates_sql(),
                  "op2_license_diagonals": license_diagonals.scan_sql(),
                  "op5_quality_rules": quality_rules.report_sql(),
                  "op11_spelling_variants": spelling_variants.variants_sql(),
                  "op13_vector_codes": vector_codes.codes_sql()}
