"""MTLD by chunks against the fold over all words of a group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from utterlake.functions.lexical import mtld_of
from utterlake.operators import diversity


def texts():
    rng = random.Random(3)
    out = {"none": [], "few": ["a"] * 49, "same": ["a"] * 300, "distinct": [f"w{i}" for i in range(400)], "late": [f"w{i}" for i in range(150)] + ["z"] * 200, None: ["x", "y"] * 60}
    for k in range(14):
        types = rng.choice([5, 40, 200, 1000])
        out[f"t{k}"] = [f"w{int(types * rng.random() ** 2)}" for _ in range(rng.randrange(40, 700))]
    return out


@pytest.mark.parametrize("chunk,ahead", [(1 << 16, 1 << 12), (64, 40), (7, 3), (100, 1)])
def test_equal_to_the_fold(spark, chunk, ahead):
    rng = random.Random(chunk)
    rows, groups = [], texts()
    for g, words in groups.items():
        at = line = 0
        while at < len(words) or not line:
            n = rng.randrange(0, 12)
            rows.append((g, line, words[at : at + n] + [None] * (rng.random() < 0.1), 5))
            at, line = at + n, line + 1
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "who string, line int, words array<string>, total int")
    got = {r.who: r for r in diversity.mtld(df, ["who"], ["line"], "words", chunk=chunk, ahead=ahead).collect()}
    assert set(got) == set(groups) - {"none"}
    for g, words in groups.items():
        if words:
            assert got[g].n_words == len(words) and got[g].mtld == pytest.approx(mtld_of(words), abs=1e-9), g


def test_next_starts():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 30, 300)
    starts, types = diversity.next_starts(words, 250)
    for i in range(250):
        seen, end = set(), -1
        for j in range(i, 300):
            seen.add(int(words[j]))
            if len(seen) / (j - i + 1) <= 0.72:
                end = j + 1
                break
        assert (starts[i], types[i]) == (end, len(seen))


def test_running_sums_over_ranges(spark):
    """A key that fills many partitions is summed through; null keys are a key."""
    rows = spark.range(3000).select(F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("k"), F.col("id").alias("o"), (F.col("id") % 7).alias("n"), F.lit(1).alias("_part_"))
    got = diversity.numbered(rows.repartition(9), ["k"], ["o"], "n").collect()
    sums = {}
    for r in sorted(got, key=lambda r: r.o):
        assert r.before == sums.get(r.k, 0)
        sums[r.k] = r.before + r.n
    assert len(got) == 3000


def test_no_words(spark):
    df = spark.createDataFrame([("a", 1, []), ("b", 1, None)], "who string, line int, words array<string>")
    assert diversity.mtld(df, ["who"], ["line"], "words").collect() == []


def test_types_at_every_level(spark):
    """Bitmaps unite to exact counts, over many partitions of numbered words, with nulls and words that parts share."""
    from utterlake.operators import types

    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(4), rng.choice([None, "", f"w{int(70_000 * rng.random() ** 3)}"])) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "who string, part int, word string").repartition(5)
    got = {(r.level, r.who, r.part): (r.num_types, r.num_tokens) for r in types.by_level(df, ["who", "part"], F.col("word")).collect()}
    want = {}
    for who, part, word in rows:
        if word:
            for k in ((0, None, None), (1, who, None), (2, who, part)):
                seen, n = want.get(k, (set(), 0))
                want[k] = (seen | {word} if len(seen) < 3 else (seen.add(word) or seen), n + 1)
    assert got == {k: (len(s), n) for k, (s, n) in want.items()}
    half = [types.bitmaps(df.where(w), ["who"], F.col("word"), numbers) for numbers in [types.numbered_words(df, F.col("word"))] for w in ("part < 2", "part >= 2")]
    whole = types.counts(types.united(half[0].unionByName(half[1]), ["who"]), ["who"]).collect()
    assert {r.who: r.num_types for r in whole} == {k[1]: v[0] for k, v in got.items() if k[0] == 1}
    assert types.by_level(df.limit(0), ["who", "part"], F.col("word")).collect() == []


def test_words_ahead_go_to_chunks_that_need_them_alone(spark, monkeypatch):
    """One factor reaches over many chunks: the words ahead are dealt to its own chunks, and no table is broadcast."""
    made, chains = spark.sparkContext.accumulator(0), diversity._chains

    def counted(table, chunk, threshold):
        made.add(1)
        return chains(table, chunk, threshold)

    monkeypatch.setattr(diversity, "_chains", counted)
    words = [*("a" if i % 2 else "b" for i in range(3000)), *(f"w{i}" for i in range(700)), *("a" for _ in range(3000))]
    rows = spark.createDataFrame([("x", i, [w]) for i, w in enumerate(words)], "k string, at long, words array<string>")
    out = diversity.mtld(rows, ["k"], ["at"], "words", chunk=64, ahead=8).first()
    assert abs(out.mtld - mtld_of(words)) < 1e-9
    assert made.value < 300
