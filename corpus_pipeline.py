"""A corpus pipeline of five operators; each stage reads what the one before it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import bpe, line_dedup, mixing, simhash, toxicity
from wakeline.llm.registry import vocabulary
from wakeline.session import shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models, learnt on this input and its labels, do not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a large part of their source shares; n_chars follows the text."""
    out = line_dedup.drop_boilerplate(docs, "source")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate_lines),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

#: The fitted toxicity curve and the XXH64 fingerprints have no DuckDB form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
