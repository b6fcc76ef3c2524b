"""The corpus pipeline: documents in, clean encoded documents out.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns a DataFrame; ``run`` writes each stage's rows to the shared
folder as Parquet and hands the reread table to the next. All stages but the
last return the columns of their input, rows unchanged.

Rows with a null id are treated as documents like any other; null texts count
as empty; an empty table stays empty through all stages; extra columns pass.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import common, op2_decontamination, op3_minhash, op6_exact_dedup, op8_toxicity, op10_bpe


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents scored 0.5 or more go."""
    score = op8_toxicity.scorer(spark, op8_toxicity.train(docs, op8_toxicity.labels_of(spark, sf_dir)))
    return docs.filter(score(F.col("text")) < 0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the first of equal texts stays."""
    return op6_exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each group of near copies stays."""
    return op3_minhash.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark passage go."""
    return op2_decontamination.drop_contaminated(docs, op2_decontamination.benchmark_of(spark, sf_dir))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: ids and decoded text of each document, as digests."""
    return op10_bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontaminate), ("bpe", encode)]
ORACLE_SQL = None  # a trained classifier and a BPE vocabulary are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
