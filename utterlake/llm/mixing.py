"""Mixing sources to target weights.

Sizes are summed for each source, repetition rates follow from the target of each source, and each document is emitted
floor(rate) times, plus once more if a number in [0, 1) that is fixed by seed and document lies below the fraction.
The draws are independent over documents, so a source's emitted size is close to its target, and reruns agree.

Sources are ordered by code point, null last, and weigh 5, 2, 1, 5, 2, 1, ... The targets share `share` times the total
size by weight; a target stops at `most` times its source's size, and what is over is shared again by weight among
the others until none is above. That fixed point is reached at once: with sources ordered by size / weight, a prefix
of them is full, and the rest share what is left by weight.

Defined cases: a null or blank text has size 0; a source of size 0 has target 0 and rate 0; equal documents (repeated
rows) have equal draws; an empty table gives no rows; columns other than those named pass through mix() unchanged,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.llm.common import cut

WEIGHTS = (5, 2, 1)
#: Sources up to this many are broadcast (under 1 MB); more are joined by shuffle, with the hot ones salted.
BROADCAST_SOURCES = 10_000
SALTS = 64


def word_count(text: Column) -> Column:
    """Runs of bytes other than white space (tab, line feed, vertical tab, form feed, return, space)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def sizes(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text).cast("string")).alias("size"))


def source_plan(sized: DataFrame, *, share: float = 1.5, most: int = 2, weights: tuple = WEIGHTS) -> DataFrame:
    """source, source_size, target, rate: one row for each source of sized (source, size)."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank + 1))
    by_fill = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    fuller = by_fill.rowsBetween(W.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum(F.col("source_size") * most).over(fuller), F.lit(0))
    level = left / F.sum("weight").over(by_fill.rowsBetween(0, W.unboundedFollowing))
    tried = weighted.withColumns({"level": level, "full": F.col("source_size") * most <= F.col("weight") * level})
    # the first source that doesn't fill up sets the level of all behind it
    final = F.min(F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(W.partitionBy())["level"]
    target = F.when(F.col("full") | final.isNull(), (F.col("source_size") * most).cast("double")).otherwise(F.col("weight") * final)
    return tried.withColumn("target", target).select("source", "source_size", "target", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)).alias("rate"))


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) with 32 bits, from the key's text and the seed."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def with_plan(rows: DataFrame, plan: DataFrame, on: str, salt_by: Column) -> DataFrame:
    """rows with source_size, target and rate of their source in column `on`."""
    plan = plan.withColumnRenamed("source", "_source")
    if len(plan.select("_source").take(BROADCAST_SOURCES + 1)) <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(plan), rows[on].eqNullSafe(plan["_source"]), "left").drop("_source")
    salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_of", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)).cast("int"))
    return rows.join(salted, rows[on].eqNullSafe(salted["_source"]) & (rows["_of"] == salted["_salt"]), "left").drop("_source", "_salt", "_of")


def copies(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", share: float = 1.5, most: int = 2, weights: tuple = WEIGHTS, seed: int = 9) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, n_copies: how often the mix holds each document."""
    sized = cut(sizes(docs, doc_id, source, text), "mix-sizes")
    plan = cut(source_plan(sized, share=share, most=most, weights=weights), "mix-plan")
    out = with_plan(sized, plan, "source", F.col("doc_id"))
    whole = F.floor("rate")
    more = (draw(F.col("doc_id"), seed) < F.col("rate") - whole).cast("long")
    return out.withColumn("n_copies", whole + more)


def mix(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", share: float = 1.5, most: int = 2, weights: tuple = WEIGHTS, seed: int = 9) -> DataFrame:
    """The mixed corpus: docs' own columns, each document as often as copies() says."""
    plan = cut(source_plan(sizes(docs, doc_id, source, text), share=share, most=most, weights=weights), "mix-plan")
    n = len(docs.columns)
    own = docs.toDF(*[f"_c{i}" for i in range(n)])
    at = {c: f"_c{docs.columns.index(c)}" for c in (doc_id, source)}
    rows = with_plan(own, plan, at[source], F.col(at[doc_id]))
    whole = F.floor("rate")
    n_copies = (whole + (draw(F.col(at[doc_id]), seed) < F.col("rate") - whole).cast("long")).cast("int")
    rows = rows.withColumn("_n", n_copies).where("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return rows.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])
