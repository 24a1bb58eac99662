"""From raw documents to token ids: five stages, each by one operator of ``tablelens.llm``.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame.  Stages are chained
through Parquet in the shared folder, so a lost executor costs one stage at most.  All but the last keep
the columns of documents as they came.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablelens.llm import bpe, decontaminate, exact_dedup, jaccard, quality
from tablelens.llm.queries import tokenizer
from tablelens.plans.runtime import written
from tablelens.sources.reader import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more."""
    return quality.without_rejected(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on five-word shingles."""
    return jaccard.near_duplicates_removed(docs, width=5, percent=80)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark."""
    return decontaminate.without_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of the ids and of the decoded text."""
    return bpe.encode_decode(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("near_duplicates", near_copies),
    ("decontamination", benchmark_free),
    ("bpe", token_ids),
]

#: A fitted classifier and a BPE vocabulary are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
