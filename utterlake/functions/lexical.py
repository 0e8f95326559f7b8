"""Lexical measures as column expressions over arrays of words.

MTLD needs a set that grows and empties along the words; as a fold of column expressions that is quadratic, so it runs in
Python over Arrow batches, one pass for each direction.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

THRESHOLD, DRAWS, LEAST = 0.72, 42, 50


def ordered(value: Column, *order: Column) -> Column:
    """Aggregate: values of a group in the order of the given columns."""
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    return F.transform(F.array_sort(F.collect_list(F.struct(*keys, value.alias("v")))), lambda s: s["v"])


def _words_per_factor(words: Iterable[str], total: int, threshold: float) -> float:
    """Mean words per factor in one direction; -1 if no factor forms."""
    factors, seen, n = 0.0, set(), 0
    for w in words:
        seen.add(w)
        n += 1
        if len(seen) / n <= threshold:
            factors, seen, n = factors + 1, set(), 0
    if n:
        factors += (1.0 - len(seen) / n) / (1.0 - threshold)
    return total / factors if factors > 0 else -1.0


def mtld_of(words: Sequence[str] | None, threshold: float = THRESHOLD, least: int = LEAST) -> float | None:
    if words is None or len(words) < least:
        return None
    return (_words_per_factor(words, len(words), threshold) + _words_per_factor(reversed(words), len(words), threshold)) / 2


def hdd_of(words: Sequence[str] | None, draws: int = DRAWS, least: int = LEAST) -> float | None:
    if words is None or len(words) < max(least, draws):
        return None
    total, out = len(words), 0.0
    for c, types in Counter(Counter(words).values()).items():  # types that occur equally often weigh equally
        missing = 1.0
        for i in range(draws):
            missing *= max(total - c - i, 0) / (total - i)
        out += types * (1.0 - missing) / draws
    return out


def _each(words: Column, kind: str, make) -> Column:
    @F.pandas_udf(kind)
    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([make(None if w is None else list(w)) for w in batch], dtype="float64")

    return run(words)


def mtld(words: Column, threshold: float = THRESHOLD, least: int = LEAST) -> Column:
    """Measure of textual lexical diversity: the mean of both directions, null below `least` words. Words are compared as given."""
    return _each(words, "double", lambda w: mtld_of(w, threshold, least))


def hdd(words: Column, draws: int = DRAWS, least: int = LEAST) -> Column:
    """HD-D of an array of words; null below `least` words."""
    return _each(words, "double", lambda w: hdd_of(w, draws, least))


def diversity(words: Column) -> Column:
    """struct<num_types:int, mtld:double, hdd:double> of an array of words, in one pass."""

    @F.pandas_udf("num_types int, mtld double, hdd double")
    def run(batch: pd.Series) -> pd.DataFrame:
        lists = [[] if w is None else list(w) for w in batch]
        return pd.DataFrame({"num_types": [len(set(w)) for w in lists], "mtld": pd.Series([mtld_of(w) for w in lists], dtype="float64"), "hdd": pd.Series([hdd_of(w) for w in lists], dtype="float64")})

    return run(words)


def hdd_of_counts(counts: Column, total: Column, draws: int = DRAWS, least: int = LEAST) -> Column:
    """HD-D from the number of times each type occurs.

    The chance that none of `draws` words is of a type that occurs c times among n is the product over i of
    (n - c - i) / (n - i), which neither over- nor underflows however large n is.
    """
    def missing(c: Column) -> Column:
        steps = F.sequence(F.lit(0), F.lit(draws - 1))
        return F.aggregate(steps, F.lit(1.0), lambda p, i: p * F.greatest(total - c - i, F.lit(0)) / (total - i))

    return F.when(total >= least, F.aggregate(counts, F.lit(0.0), lambda s, c: s + (1.0 - missing(c)) / draws))


def ttr(types: Column, tokens: Column) -> Column:
    return F.try_divide(types, tokens)


def mlu(lengths: Column) -> Column:
    """Aggregate: mean length of utterance, nulls left out."""
    return F.avg(lengths)


def reader_mlu(utterances: Column) -> Column:
    """Mean length in morphemes over ordered utterances, an array of arrays of struct<word:string,pos:string>.

    A word has a morpheme more for each hyphen in it. Utterances that are empty, hold an unintelligible word (pos 'unk') or
    equal the last one kept are left out. Of the others, each filler (pos 'co' or null) takes one morpheme off, and an
    utterance with any filler counts no utterance. 0 where none counts.
    """
    start = F.struct(F.lit(None).cast("array<struct<word:string,pos:string>>").alias("last"), F.lit(0).alias("morphemes"), F.lit(0).alias("kept"))

    def step(s: Column, u: Column) -> Column:
        unknown = F.exists(u, lambda w: F.coalesce(w["pos"] == "unk", F.lit(False)))
        fillers = F.size(F.filter(u, lambda w: F.coalesce(w["pos"] == "co", F.lit(True))))
        parts = F.aggregate(u, F.lit(0), lambda n, w: n + F.size(F.split(F.coalesce(w["word"], F.lit("")), "-")))
        taken = F.struct(u.alias("last"), (s["morphemes"] + parts - fillers).alias("morphemes"), (s["kept"] + (fillers == 0).cast("int")).alias("kept"))
        return F.when((F.size(u) == 0) | unknown | u.eqNullSafe(s["last"]), s).otherwise(taken)

    return F.aggregate(utterances, start, step, lambda s: F.coalesce(F.try_divide(s["morphemes"], s["kept"]), F.lit(0.0)))
