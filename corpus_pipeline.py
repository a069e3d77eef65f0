"""The corpus pipeline: documents through the stages of ``STAGES``, each written and read back.

A stage takes ``(spark, docs, sf_dir)`` and returns what the next one reads; all but the last
return the columns of ``documents``. In order: quality rules reject documents, toxic documents
go, one document of each group of near copies stays, personal data is masked, and the rest is
packed into sequences. SQL cannot express the stages, so ``ORACLE_SQL`` is None and the tests hold
``run`` against brute force.

Defined results are those of the operators: null texts are empty (and rejected by the first
stage), repeated rows give one, an empty table gives no rows, other columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pubspark.llm import (
    chosen_paths, personal_data, quality_rules, sequence_packing, toxic_passages)
from pubspark.llm.common import materialize, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; trained on the labelled ones among them."""
    return toxic_passages.keep_clean(docs, toxic_passages.fit(docs, read_table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return chosen_paths.keep_firsts(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return personal_data.mask_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of at most 2048 tokens. Workers that other
    stages have used remember fewer words."""
    return sequence_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), chunks=100_000)


STAGES = [("quality_rules", quality), ("toxicity", toxicity), ("near_copies", near_copies),
          ("personal_data", personal), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
