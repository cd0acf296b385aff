"""The corpus pipeline: documents to a mixed, tokenized training corpus in five stages.

Each stage reads what its predecessor kept, written as Parquet in the shared scratch folder, so a
lost executor costs at most the stage that runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridline.llm.common import stored, table
from gridline.llm.lsa_decontam import decontaminate
from gridline.llm.minhash_join import keep_one_of_each
from gridline.llm.mixing import mix
from gridline.llm.quality_llr import fit_weights, judge, trusted_ids
from gridline.llm.token_blocks import read_documents, write_tokens
from gridline.session import ensure_conf

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood ratio; the others go."""
    weights = fit_weights(docs, trusted_ids(table(spark, sf_dir, "labels")))
    return judge(docs, weights).filter("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row per taken document or part, repeats as rows."""
    return mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in the block format; the result describes the documents as read back from the files."""
    import public_tokenizers
    return read_documents(spark, write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# Hash buckets of n-grams, MinHash, singular vectors and byte-pair merges are beyond SQL: the stages
# are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
