"""Comparing releases, checking invariants, and scoring annotations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def align(old: DataFrame, new: DataFrame, on: str) -> DataFrame:
    """on, old and new rows as structs: both sides kept, null where one lacks the key."""
    x = old.select(F.col(on), F.struct("*").alias("old"))
    y = new.select(F.col(on), F.struct("*").alias("new"))
    return x.join(y, on, "full_outer")


def row_hashes(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """key, n (row number within key), hash of all other columns."""
    rest = [c for c in df.columns if c not in key]
    n = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return df.select(*key, n.alias("n"), F.xxhash64(*rest).alias("hash"))


def changed_rows(old: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """key, n, status of rows by position: same, changed, only_old, only_new. The whole database in one join."""
    x = row_hashes(old, key, order).withColumnRenamed("hash", "old_hash")
    y = row_hashes(new, key, order).withColumnRenamed("hash", "new_hash")
    status = F.when(F.col("old_hash").isNull(), "only_new").when(F.col("new_hash").isNull(), "only_old").when(F.col("old_hash") == F.col("new_hash"), "same").otherwise("changed")
    return x.join(y, [*key, "n"], "full_outer").select(*key, "n", status.alias("status"))


def changed_values(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """key, column, old, new: every value that differs between rows of a (unique) key."""
    rest = [c for c in old.columns if c not in key and c in new.columns]
    tall = lambda df, name: df.select(*key, *[F.col(c).cast("string").alias(c) for c in rest]).unpivot(key, rest, "column", name)
    both = tall(old, "old").join(tall(new, "new"), [*key, "column"])
    return both.where(~F.col("old").eqNullSafe(F.col("new")))


def emptiness(pairs: DataFrame, old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """For each key of pairs, which sides have no rows: both, old, new or neither."""
    count = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    out = pairs.select(key).distinct().join(count(old, "n_old"), key, "left").join(count(new, "n_new"), key, "left")
    no = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    return out.select(key, F.when(no("n_old") & no("n_new"), "both").when(no("n_old"), "old").when(no("n_new"), "new").otherwise("neither").alias("empty"))


def contiguous(df: DataFrame, group: list[str], order: str, first: int = 1) -> DataFrame:
    """group, ok: whether order runs from `first` without gap or repeat."""
    got = df.groupBy(*group).agg(F.min(order).alias("lo"), F.max(order).alias("hi"), F.count("*").alias("n"), F.countDistinct(order).alias("d"))
    return got.select(*group, ((F.col("lo") == first) & (F.col("hi") == F.col("n") + (first - 1)) & (F.col("d") == F.col("n"))).alias("ok"))


def increasing(df: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """Rows whose value isn't above the one before."""
    before = F.lag(value).over(W.partitionBy(*group).orderBy(order))
    return df.withColumn("before", before).where(F.col("before") >= F.col(value))


def orphans(rows: DataFrame, key: str, parents: DataFrame, id: str = "id") -> DataFrame:
    """rows whose key no parent has (null keys are no orphans)."""
    return rows.where(F.col(key).isNotNull()).join(parents.select(F.col(id).alias(key)).distinct(), key, "left_anti")


def same_values(a: DataFrame, b: DataFrame) -> bool:
    """Whether two one-column frames hold the same set of values."""
    x, y = a.distinct(), b.distinct()
    return not x.exceptAll(y).take(1) and not y.exceptAll(x).take(1)


def confusion(df: DataFrame, gold: str, predicted: str, labels: list[str], normalize: bool = False) -> DataFrame:
    """gold, and a column for each predicted label: counts, or shares of the row (0 for an empty one)."""
    out = df.groupBy(gold).pivot(predicted, labels).agg(F.count(F.lit(1))).fillna(0)
    if normalize:
        total = reduce(Column.__add__, [F.col(f"`{c}`") for c in labels])
        out = out.select(gold, *[F.coalesce(F.try_divide(F.col(f"`{c}`"), total), F.lit(0.0)).alias(c) for c in labels])
    return out


def _ratios(tp: Column, fp: Column, fn: Column) -> list[Column]:
    p, r = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return [p.alias("precision"), r.alias("recall"), F.try_divide(2 * p * r, p + r).alias("f1")]


def micro_scores(df: DataFrame, gold: str, predicted: str) -> DataFrame:
    """precision, recall, f1 over the labels that occur among predictions."""
    labels = df.select(F.col(predicted).alias("_label")).where("_label IS NOT NULL").distinct()
    seen = df.join(labels, df[gold] == labels["_label"], "left")
    hit = (F.col(gold) == F.col(predicted)).cast("int")
    sums = seen.agg(F.sum(hit).alias("tp"), F.count(predicted).alias("p"), F.count("_label").alias("g"))
    return sums.select(*_ratios(F.col("tp"), F.col("p") - F.col("tp"), F.col("g") - F.col("tp")))


def scores_by_group(df: DataFrame, group: str, gold: str, predicted: str, fixed: bool = True) -> DataFrame:
    """precision, recall, f1 by group. fixed=False: labels of the group, but counts over the whole frame, as published results have it."""
    labels = df.where(F.col(predicted).isNotNull()).select(F.col(group).alias("_group"), F.col(predicted).alias("_label")).distinct()
    if fixed:
        seen = df.join(labels, (df[group] == labels["_group"]) & (df[gold] == labels["_label"]), "left")
        hit = (F.col(gold) == F.col(predicted)).cast("int")
        sums = seen.groupBy(group).agg(F.sum(hit).alias("tp"), F.count(predicted).alias("p"), F.count("_label").alias("g"))
    else:
        count = lambda c, name: df.groupBy(F.col(c).alias("_label")).agg(F.count("*").alias(name))
        hits = df.where(F.col(gold) == F.col(predicted)).groupBy(F.col(gold).alias("_label")).agg(F.count("*").alias("tp"))
        out = labels.join(count(predicted, "p"), "_label", "left").join(count(gold, "g"), "_label", "left").join(hits, "_label", "left")
        sums = out.fillna(0).groupBy(F.col("_group").alias(group)).agg(*[F.sum(c).alias(c) for c in ("tp", "p", "g")])
    return sums.select(group, *_ratios(F.col("tp"), F.col("p") - F.col("tp"), F.col("g") - F.col("tp")))


def unigram_counts(output: Column) -> Column:
    """word -> count from a frequency program's printed lines ('  12 word')."""
    counts = F.regexp_extract_all(output, F.lit(r"(?m)^\s*(\d+)\s+\S+"), F.lit(1))
    names = F.regexp_extract_all(output, F.lit(r"(?m)^\s*\d+\s+(\S+)"), F.lit(1))
    return F.transform(F.arrays_zip(names.alias("word"), counts.alias("n")), lambda x: F.struct(x["word"].alias("word"), x["n"].cast("int").alias("n")))


def merged_counts(df: DataFrame, key: list[str], count: str = "n") -> DataFrame:
    return df.groupBy(*key).agg(F.sum(count).alias(count))


def majority(df: DataFrame, group: list[str], value: str, order: str) -> DataFrame:
    """group, value that is commonest; of equals the one seen first by order."""
    votes = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("c"), F.min(order).alias("first"))
    top = W.partitionBy(*group).orderBy(F.desc("c"), "first")
    return votes.withColumn("place", F.row_number().over(top)).where("place = 1").select(*group, value)


def model_coverage(utterances: DataFrame, codes: DataFrame, models: DataFrame, total: str = "n") -> DataFrame:
    """Languages with their share of utterances and whether a model knows them; utterances: language, n (codes space-joined: the first counts)."""
    first = utterances.withColumn("code", F.split("language", " ")[0]).groupBy("code").agg(F.sum(total).alias(total))
    out = first.join(codes, first["code"] == codes["code3"], "left").join(models.select(F.col("code1").alias("_code1"), "models"), F.col("code1") == F.col("_code1"), "left")
    n_models = F.coalesce("models", F.lit(0))
    return out.select("code", "name", total, F.when(n_models > 0, "yes").otherwise("no").alias("has_model"), (F.col(total) / F.sum(total).over(W.partitionBy())).alias("share"))


def schema_coverage(elements: DataFrame, source: str) -> DataFrame:
    """element, read: whether a reader's source text names each schema element."""
    return elements.select("element", F.contains(F.lit(source), F.col("element")).alias("read"))
