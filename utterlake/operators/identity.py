"""Which child a file is about: rules on paths learned from known files, all corpora in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.functions import scalars as S

COVERAGE, SUBDIR_SHARE, EXAMPLES = 0.95, 0.8, 3


def candidate_keys(path: Column, name: Column) -> list[tuple[str, Column]]:
    """Rules in order of preference, each a name and a key (null where the rule says nothing of a file)."""
    parts, stem = F.split(path, "/"), S.stem_name(path)
    found = lambda pattern, i=0: F.nullif(F.regexp_extract(stem, pattern, i), F.lit(""))
    one = F.when(F.size(parts) > 1, parts[0])
    alpha, digits, tail = found("^[A-Za-z]+"), found("^[0-9]+"), found("[0-9]+$")
    both = lambda a, b: F.concat(a, F.lit("|"), b)
    # Names and order of the rules, and what each takes of a path.
    before = F.when(F.rlike(stem, F.lit("^.*[_-][^_-]+$")), F.regexp_extract(stem, "^(.*)[_-][^_-]+$", 1))
    prefixes = [(f"prefix{k}", F.when(F.length(stem) >= k, F.left(stem, F.lit(k)))) for k in (6, 5, 4, 3, 2)]
    return [
        ("subdir1", one),
        ("subdir2", F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 1, 2), "/"))),
        ("alpha_prefix", alpha),
        ("stem", stem),
        ("digit_prefix", digits),
        ("digit_suffix", tail),
        ("before_last_sep", before),
        ("subdir1+alpha_prefix", both(one, alpha)),
        ("subdir1+digit_prefix", both(one, digits)),
        ("subdir1+digit_suffix", both(one, tail)),
        ("subdir1+stem", both(one, stem)),
        *prefixes,
        ("name2026", name),
        ("file", path),
        ("single", F.lit("corpus_child")),
    ]


def keyed(files: DataFrame) -> DataFrame:
    """files (corpus, path, name, truth, ...) times rules: rule, priority, risky, key."""
    rules = candidate_keys(F.col("path"), F.col("name"))
    structs = [F.struct(F.lit(n).alias("rule"), F.lit(i).alias("priority"), F.lit(n.startswith("prefix")).alias("risky"), k.alias("key")) for i, (n, k) in enumerate(rules)]
    return files.select("*", F.inline(F.array(*structs)))


def coverage(files: DataFrame) -> DataFrame:
    """corpus, and the share of its files that name their child."""
    return files.groupBy("corpus").agg(F.avg(F.col("name").isNotNull().cast("double")).alias("covered"))


def agreement(rows: DataFrame, by: list[str], key: str = "key", truth: str = "truth") -> DataFrame:
    """How well keys match truths by group: n, score (mean purity of both directions, 4 digits), passes (each one to one, no null key)."""
    cells = rows.groupBy(*by, key, truth).agg(F.count("*").alias("c"))
    way = lambda side: cells.groupBy(*by, side).agg(F.max("c").alias("top"), F.count("*").alias("others"), F.sum("c").alias("n"))
    total = lambda df, p: df.groupBy(*by).agg(F.sum("top").alias(f"{p}_top"), F.max("others").alias(f"{p}_others"), F.sum("n").alias("n"))
    nulls = rows.groupBy(*by).agg(F.bool_or(F.col(key).isNull()).alias("has_null"))
    out = total(way(key), "k").join(total(way(truth), "t").drop("n"), by).join(nulls, by)
    score = F.round((F.col("k_top") / F.col("n") + F.col("t_top") / F.col("n")) / 2, 4)
    return out.select(*by, "n", score.alias("score"), (~F.col("has_null") & (F.col("k_others") == 1) & (F.col("t_others") == 1)).alias("passes"))


def learn(files: DataFrame) -> DataFrame:
    """corpus, rule, passed, score: the rule of each corpus with known files.

    Of rules that match the truth one to one, that which isn't a bare prefix, makes fewest keys over all files of the corpus, and comes
    first; else the best-scoring. name2026 comes first of all where most files name their child.
    """
    rows = keyed(files).join(coverage(files), "corpus")
    rows = rows.withColumn("priority", F.when((F.col("rule") == "name2026") & (F.col("covered") >= COVERAGE), -1).otherwise(F.col("priority")))
    by = ["corpus", "rule", "priority", "risky"]
    n_keys = rows.groupBy(*by).agg((F.countDistinct("key") + F.max(F.col("key").isNull().cast("int"))).alias("n_keys"))
    scored = agreement(rows.where("truth IS NOT NULL"), by).join(n_keys, by)
    passing = F.when(F.col("passes"), F.struct("risky", "n_keys", "priority"))
    order = W.partitionBy("corpus").orderBy(passing.asc_nulls_last(), F.when(~F.col("passes"), -F.col("score")), "priority")
    best = scored.withColumn("place", F.row_number().over(order)).where("place = 1")
    return best.select("corpus", "rule", F.col("passes").alias("passed"), F.when(F.col("passes"), 1.0).otherwise(F.col("score")).alias("score"))


def guess(files: DataFrame) -> DataFrame:
    """corpus, rule by structure alone, for corpora without known files."""
    inside = F.contains("path", F.lit("/"))
    facts = files.groupBy("corpus").agg(
        F.avg(F.col("name").isNotNull().cast("double")).alias("covered"),
        F.countDistinct(F.when(inside, F.split_part("path", F.lit("/"), F.lit(1)))).alias("subdirs"),
        F.avg(inside.cast("double")).alias("inside"),
        F.bool_and(F.rlike(S.stem_name(F.col("path")), F.lit("^[0-9_]+$"))).alias("coded"),
    )
    rule = F.when(F.col("covered") >= COVERAGE, "name2026").when((F.col("subdirs") >= 2) & (F.col("inside") >= SUBDIR_SHARE), "subdir1").when(F.col("coded"), "single").otherwise("stem")
    return facts.select("corpus", rule.alias("rule"))


def rules(files: DataFrame) -> DataFrame:
    """corpus, rule: learned where there are known files, else guessed."""
    known = learn(files).select("corpus", F.col("rule").alias("learned"))
    return guess(files).join(known, "corpus", "left").select("corpus", F.coalesce("learned", "rule").alias("rule"))


def assign(files: DataFrame) -> DataFrame:
    """corpus, path, key, name for each file.

    A known file goes to its child. Of others, a key that known files give one child joins that child, any other key is a
    child of its own, and so is a file that the rule says nothing of. A child's name is the commonest that its known files carry.
    """
    rows = keyed(files).join(rules(files), ["corpus", "rule"])
    known = rows.where("truth IS NOT NULL")
    one = known.where("key IS NOT NULL").groupBy("corpus", "key").agg(F.min("truth").alias("of_key"), F.max("truth").alias("other")).where("of_key = other").drop("other")
    votes = known.where("name IS NOT NULL").groupBy("corpus", "truth", "name").agg(F.count("*").alias("c"), F.min("path").alias("first"))
    top = W.partitionBy("corpus", "truth").orderBy(F.desc("c"), "first")
    names = votes.withColumn("place", F.row_number().over(top)).where("place = 1").select("corpus", F.col("truth").alias("child"), F.col("name").alias("child_name"))
    rows = rows.join(one, ["corpus", "key"], "left").withColumn("child", F.coalesce("truth", "of_key")).join(names, ["corpus", "child"], "left")
    key = F.coalesce(F.concat(F.lit("truth:"), F.col("child").cast("string")), F.concat(F.lit("rule:"), "key"), F.concat(F.lit("file:"), "path"))
    return rows.select("corpus", "path", key.alias("key"), F.coalesce("child_name", "name").alias("name"))


def examples(files: DataFrame, limit: int = EXAMPLES) -> DataFrame:
    """Known files, at most `limit` a corpus, whose learned rule's key is null or stands for several children."""
    rows = keyed(files.where("truth IS NOT NULL")).join(learn(files).where("NOT passed"), ["corpus", "rule"])
    same = W.partitionBy("corpus", "key")
    bad = rows.withColumn("children", F.size(F.collect_set("truth").over(same))).where("children > 1 OR key IS NULL")
    place = F.row_number().over(W.partitionBy("corpus").orderBy("path"))
    return bad.withColumn("place", place).where(F.col("place") <= limit).select("corpus", "path", "key", "truth")


def matched(files: DataFrame, old: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """files (pid, source, corpus_name, path, ...) with truth from old (pid, source, corpus_name, filename, id, child).

    A file matches by pid; else by source, corpus and file stem, where that names one old transcript only. corrections (id, new_child) overrule.
    """
    if corrections is not None:
        fixed = corrections.select(F.col("transcript_id").alias("id"), F.col("new_child_id").alias("_new"))
        old = old.join(fixed, "id", "left").withColumn("child", F.coalesce("_new", "child")).drop("_new")
    by_pid = old.where("pid IS NOT NULL").groupBy("pid").agg(F.min("child").alias("by_pid"))
    key = ["source", "corpus_name", "stem"]
    alone = old.withColumn("stem", S.stem_name(F.col("filename"))).groupBy(*key).agg(F.count("*").alias("n"), F.min("child").alias("by_stem")).where("n = 1").drop("n")
    out = files.withColumn("stem", S.stem_name(F.col("path"))).join(by_pid, "pid", "left").join(alone, key, "left")
    return out.withColumn("truth", F.coalesce("by_pid", "by_stem")).drop("by_pid", "by_stem", "stem")
