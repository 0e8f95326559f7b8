"""MTLD of groups of any length, without a group's words in one task.

In MTLD a factor ends at the first word at which the ratio of types to words falls to the threshold, and the next begins behind it. For every
place the beginning of the next factor, if one began there, depends on the words from there on alone; so words are cut in chunks, and each chunk
finds these pointers for all its places at once, from its own words and those that follow. Within the chunk pointers are followed until they leave it,
which leaves for each place where its chain enters a later chunk and how many factors end on the way. Chains over chunks are then
put together by pointer doubling, in as many rounds as the logarithm of the number of chunks. The places where a chain can enter a chunk are few, so that these tables are small.

A factor that reaches further than AHEAD words behind a chunk is looked for again with more of them. A task thus holds a chunk and the longest
factor. Words are compared as given; nulls are no words; a group of fewer than `least` words has no measure.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.functions.lexical import LEAST, THRESHOLD
from utterlake.session import stored

CHUNK, AHEAD = 1 << 16, 1 << 12


def numbered(rows: DataFrame, key: Sequence[str], order: Sequence[str], size: str) -> DataFrame:
    """rows with before: the sum of size over the rows of the same key that come earlier in order (which has no ties).

    Rows are dealt out by ranges of key and order; sums run within a range, behind the ranges before it, so that a key may fill many tasks.
    """
    dealt = stored(rows.repartitionByRange(*key, *order).withColumn("_part", F.spark_partition_id()), "numbered")
    sums = dealt.groupBy("_part", *key).agg(F.sum(size).alias("_sum"))  # a row for each range and key in it
    earlier = W.partitionBy(*key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_part", *key, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inner = W.partitionBy("_part", *key).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    within = dealt.withColumn("_within", F.coalesce(F.sum(size).over(inner), F.lit(0)))
    on = [within[k].eqNullSafe(offsets[k]) for k in ("_part", *key)]
    return within.join(offsets.hint("merge"), on).select(*[within[c] for c in rows.columns], (F.col("_within") + F.col("_offset")).alias("before"))


def next_starts(words: np.ndarray, n: int, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """For each of the first n places of words (numbers for types): where the factor after one that begins there begins, and the types up to the end; -1 and those types where none ends.

    All places go on together, word by word: the word d places on is new to a factor if it last occurred before the factor's beginning.
    """
    order = np.argsort(words, kind="stable")
    last = np.full(len(words), -1, np.int64)
    same = words[order][1:] == words[order][:-1]
    last[order[1:][same]] = order[:-1][same]
    out, types = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    open_ = np.arange(n)
    for d in range(len(words)):
        open_ = open_[open_ + d < len(words)]
        if not len(open_):
            break
        types[open_] += last[open_ + d] < open_
        ends = types[open_] / (d + 1) <= threshold
        out[open_[ends]] = open_[ends] + d + 1
        open_ = open_[~ends]
    return out, types


def _chains(table: pa.Table, chunk: int, threshold: float) -> pa.Table:
    """For each place of a chunk: where its chain enters what lies behind the chunk (null: the words end first), with how many factors.

    The last row's `unknown` says that words behind those at hand are needed.
    """

    place = table.column("place").to_numpy()
    by = np.argsort(place)
    _, words = np.unique(np.array(table.column("word").to_pylist(), object)[by].astype(str), return_inverse=True)
    first, total = int(place.min()), table.column("total")[0].as_py()
    n = min(chunk, len(place))
    starts, types = next_starts(words, n, threshold)
    at_end = first + len(place) == total
    factors = np.ones(n)
    if at_end:
        left = len(place) - np.arange(n)
        factors = np.where(starts < 0, (1.0 - types / left) / (1.0 - threshold), 1.0)
    unknown = (starts < 0) & (not at_end)
    # chains within the chunk: each round follows what the last has found
    inside = (starts >= 0) & (starts < n)
    while inside.any():
        i = np.flatnonzero(inside)
        to = starts[i]
        factors[i] += factors[to]
        unknown[i] |= unknown[to]
        starts[i] = starts[to]
        inside = (starts >= 0) & (starts < n)
    ends = (starts < 0) | (starts == len(place)) & at_end  # a factor that ends with the last word leaves nothing
    enters = pa.array(first + starts, mask=ends)
    return pa.table({"g": table.column("g").slice(0, 1).take(pa.array(np.zeros(n, np.int64))), "place": pa.array(first + np.arange(n)), "enters": enters, "factors": pa.array(factors), "unknown": pa.array(unknown)})


_CHAINS = "g string, place long, enters long, factors double, unknown boolean"


def factor_counts(words: DataFrame, threshold: float = THRESHOLD, chunk: int = CHUNK, ahead: int = AHEAD) -> DataFrame:
    """g, factors: MTLD's factors of each group of words (g, place from 0, word, total), remainder included."""

    def chains(rows: DataFrame, ahead: int) -> DataFrame:
        own = F.floor(F.col("place") / chunk)
        back = F.greatest(F.lit(0), F.floor((F.col("place") - ahead) / chunk)).cast("long")
        dealt = rows.withColumn("chunk", F.explode(F.sequence(back, own)))
        return dealt.groupBy("g", "chunk").applyInArrow(lambda t: _chains(t, chunk, threshold), _CHAINS)

    # Tables are joined by sorting: their files are far smaller than their rows, and Spark would gather them in the driver to broadcast them.
    rows = stored(words, "mtld-words")
    found = stored(chains(rows, ahead), "mtld-chains")
    while found.where("unknown").take(1):
        ahead *= 8
        again = found.where("unknown").select("g", F.floor(F.col("place") / chunk).alias("_c")).distinct()
        # each of these chunks gets its own words and those ahead; no other chunk is made of them
        spans = again.select("g", F.col("_c").alias("chunk"), F.explode(F.sequence("_c", (F.col("_c") + ahead // chunk + 1).cast("long"))).alias("_of"))
        some = rows.withColumn("_of", F.floor(F.col("place") / chunk)).join(spans.hint("merge"), ["g", "_of"]).where(F.col("place") < (F.col("chunk") + 1) * chunk + ahead)
        fresh = some.groupBy("g", "chunk").applyInArrow(lambda t: _chains(t, chunk, threshold), _CHAINS)
        old = found.withColumn("_c", F.floor(F.col("place") / chunk)).join(again.hint("merge"), ["g", "_c"], "left_anti").drop("_c")
        found = stored(old.unionByName(fresh.select(*old.columns)), "mtld-chains")
    met = found.where("enters IS NOT NULL").select("g", F.col("enters").alias("place")).distinct()
    links = found.where("place = 0").unionByName(found.where("place > 0").join(met.hint("merge"), ["g", "place"], "left_semi"))
    links = stored(links.select("g", "place", "enters", "factors"), "mtld-links")
    while links.where("place = 0 AND enters IS NOT NULL").take(1):
        further = links.select("g", F.col("place").alias("enters"), F.col("enters").alias("_on"), F.col("factors").alias("_more"))
        both = links.join(further.hint("merge"), ["g", "enters"], "left")
        links = stored(both.select("g", "place", F.col("_on").alias("enters"), (F.col("factors") + F.coalesce("_more", F.lit(0.0))).alias("factors")), "mtld-links")
    return links.where("place = 0").select("g", "factors")


def mtld(rows: DataFrame, key: Sequence[str], order: Sequence[str], words: str, threshold: float = THRESHOLD, least: int = LEAST, chunk: int = CHUNK, ahead: int = AHEAD) -> DataFrame:
    """key, n_words, mtld of each key: the mean of both directions over the words (arrays) of its rows in order."""
    kept = rows.select(*key, *order, F.filter(words, lambda w: w.isNotNull()).alias("_words")).withColumn("_n", F.size("_words"))
    placed = numbered(kept.where("_n > 0"), key, order, "_n")
    totals = placed.groupBy(*key).agg(F.sum("_n").alias("n_words"))
    totals = stored(totals.withColumn("g", F.to_json(F.array(*[F.col(k).cast("string") for k in key]), {"ignoreNullFields": "false"})), "mtld-totals")
    on = [placed[k].eqNullSafe(totals[k]) for k in key]
    enough = totals.where(F.col("n_words") >= least)
    each = placed.join(enough.select(*key, "g", F.col("n_words").alias("total")), on).select("g", "total", "before", F.posexplode("_words").alias("_at", "word"))
    forward = each.select(F.concat(F.lit("+"), "g").alias("g"), (F.col("before") + F.col("_at")).alias("place"), "word", "total")
    backward = forward.select(F.concat(F.lit("-"), F.substring("g", F.lit(2), F.length("g"))).alias("g"), (F.col("total") - 1 - F.col("place")).alias("place"), "word", "total")
    found = factor_counts(forward.unionByName(backward), threshold, chunk, ahead)
    both = found.groupBy(F.expr("substring(g, 2)").alias("g")).agg(F.max(F.when(F.startswith("g", F.lit("+")), F.col("factors"))).alias("a"), F.max(F.when(F.startswith("g", F.lit("-")), F.col("factors"))).alias("b"))
    mean = lambda f: F.when(F.col(f) > 0, F.col("n_words") / F.col(f)).otherwise(-1.0)
    return totals.join(both, "g", "left").select(*key, "n_words", F.when(F.col("a").isNotNull(), (mean("a") + mean("b")) / 2).alias("mtld"))
