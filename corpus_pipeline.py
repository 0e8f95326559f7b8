"""The corpus pipeline: documents to token shards in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from utterlake.llm import decontam, mixing, near, quality, tokens
from utterlake.llm.common import cut, ship
from utterlake.llm.queries import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 or more)."""
    return quality.good_documents(docs, _table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by at least 80 % shared five-word shingles."""
    ship(spark)
    return near.drop_copies(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of the benchmark."""
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target weights."""
    return mixing.mix(docs).select(*COLUMNS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of what is left, and where each document lies in them."""
    ship(spark)
    return tokens.token_output(docs, vocabulary()).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality", filter_quality),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
