"""The test tables in the roles of corpus tables: conversations as utterances, their words as tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.functions import scalars as S


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, role, order (from 1), text, tokens, num_tokens, num_morphemes (a hyphen adds one) for each turn."""
    rows = table(spark, sf_dir, "conversations")
    tokens = S.words(F.col("text"))
    rows = rows.select("conv_id", "role", (F.col("turn") + 1).alias("order"), "text", tokens.alias("tokens"))
    morphemes = F.aggregate("tokens", F.lit(0), lambda n, w: n + F.size(F.split(w, "-")))
    return rows.withColumns({"num_tokens": F.size("tokens"), "num_morphemes": F.when(F.size("tokens") > 0, morphemes)})


def tok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, role, order, token_order (from 1), gloss for each word."""
    rows = utt(spark, sf_dir).select("conv_id", "role", "order", F.posexplode("tokens").alias("at", "gloss"))
    return rows.withColumn("token_order", (F.col("at") + 1).cast("long")).drop("at")


# SQL for the same views, to put before a query
UTT = r"""u AS (
  SELECT conv_id, role, turn + 1 AS ord, text, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS tokens FROM conversations)"""
TOK = UTT + r""",
t AS (SELECT conv_id, role, ord, unnest(range(1, len(tokens) + 1)) AS token_order, unnest(tokens) AS gloss FROM u)"""
