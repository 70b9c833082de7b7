"""Documents to token sequences: the training-data operators one after another.

Each stage is written as Parquet to the cluster's shared folder and read
again, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import decontam, minhash, packing, suffix_dedup, toxicity
from tillstar.sources.sinks import stage_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, similarity 0.8."""
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 50 that an earlier document has are cut out."""
    return suffix_dedup.remove_repeats(docs, text_out=True, size_col="n_chars")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of token sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", remove_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Classification, sketches and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
