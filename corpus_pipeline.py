"""The training-data pipeline: toxic texts, exact copies, near copies and benchmark leaks go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is written as Parquet
into the shared folder and reread as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandspark.llm.bpe import round_trip
from demandspark.llm.common import documents, save
from demandspark.llm.decontaminate import drop_leaks
from demandspark.llm.exact_dedup import drop_duplicates
from demandspark.llm.set_join import drop_similar
from demandspark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents predicted toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of equal texts the row with the largest doc_id stays."""
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of texts that links of a 5-word Jaccard of 0.8 connect, the row with the smallest doc_id stays."""
    return drop_similar(docs, n=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents with a passage of the benchmark go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token ids of what is left, with digests of the ids and of the decoded bytes."""
    return round_trip(docs, keep_ids=True)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("encode", encode)]

#: Learned scores, q-gram alignment and byte pair encoding are beyond SQL; the tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
