"""Exact numbers of distinct words that add up from speakers to corpora and collections.

Words are numbered once; the words of a group are then bitmaps, one for each 32,768 numbers in which it has any, made by partial aggregates. Bitmaps of
groups unite to those of wider groups, so the levels of a hierarchy come from one pass over the tokens, each from the level below it, and stored bitmaps
of an old part unite with those of a new one. Nulls and empty strings are no words; a group without words has no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.session import stored


def numbered_words(tokens: DataFrame, word: Column) -> DataFrame:
    """word, number: each distinct word once. Numbers run on within a partition, so that few bitmaps are sparse."""
    words = tokens.select(word.alias("word")).where("word <> ''").distinct()
    return stored(words.withColumn("number", F.monotonically_increasing_id()), "words")


def bitmaps(tokens: DataFrame, key: Sequence[str], word: Column, numbers: DataFrame) -> DataFrame:
    """key, bucket, bitmap, n_tokens of each group's words; n_tokens counts the tokens behind a bitmap."""
    counts = tokens.select(*key, word.alias("word")).where("word <> ''").groupBy(*key, "word").agg(F.count("*").alias("n_tokens"))
    found = counts.join(numbers, "word").select(*key, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"), "n_tokens")
    return found.groupBy(*key, "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"), F.sum("n_tokens").alias("n_tokens"))


def united(parts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Bitmaps of wider groups from those of their parts."""
    return parts.groupBy(*key, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("n_tokens").alias("n_tokens"))


def counts(parts: DataFrame, key: Sequence[str]) -> DataFrame:
    """key, num_types, num_tokens, ttr."""
    sums = parts.groupBy(*key).agg(F.sum(F.bitmap_count("bitmap")).alias("num_types"), F.sum("n_tokens").alias("num_tokens"))
    return sums.where("num_tokens > 0").withColumn("ttr", F.col("num_types") / F.col("num_tokens"))


def by_level(tokens: DataFrame, path: Sequence[str], word: Column) -> DataFrame:
    """level, path (null below the level), num_types, num_tokens, ttr from the whole (level 0) down to groups by all of path."""
    level = stored(bitmaps(tokens, path, word, numbered_words(tokens, word)), "bitmaps")
    out = None
    for n in range(len(path), -1, -1):
        key = list(path[:n])
        if n < len(path):
            level = stored(united(level, key), "bitmaps")
        rest = [F.lit(None).cast(tokens.schema[c].dataType).alias(c) for c in path[n:]]
        rows = counts(level, key).select(F.lit(n).alias("level"), *key, *rest, "num_types", "num_tokens", "ttr")
        out = rows if out is None else out.unionByName(rows)
    return out
