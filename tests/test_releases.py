"""Release comparison by hash tree and alignment."""

import random

import pytest
from pyspark.sql import functions as F

from utterlake.operators import release_diff as D

PATH = ["collection", "corpus", "transcript"]
SCHEMA = "collection string, corpus string, transcript string, place long, gloss string, n int, row_id long"


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@pytest.mark.parametrize("values", [1, 2, 3, 12])
def test_common_subsequence(values):
    rng = random.Random(values)
    for _ in range(400):
        a, b = ([rng.randrange(values) for _ in range(rng.randrange(30))] for _ in range(2))
        found = D.common_subsequence(a, b)
        assert len(found) == longest(a, b) and all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def release(spark, transcripts):
    rows = [(*path, i, g, len(g) if g else None, 1000 * k + i) for k, (path, words) in enumerate(transcripts.items()) for i, g in enumerate(words)]
    return spark.createDataFrame(rows, SCHEMA)


def diff(old, new, block):
    columns = D.compared(old, new, PATH, "place")
    assert columns == ["gloss", "n"]
    nodes = D.differing(*(D.tree(x, PATH, "place", columns) for x in (old, new)), 3)
    return nodes, D.changed_rows(old, new, PATH, "place", nodes.where("level = 3 AND status = 'changed'"), block)


@pytest.mark.parametrize("block", [1, 3, 32])
def test_one_row_between(spark, block):
    """A row put in, left out or changed is one row of the difference, also among equal rows and nulls."""
    rng = random.Random(block)
    words = [rng.choice(["yes", "no", None, "mhm", f"w{i}"]) for i in range(200)]
    base = {("a", "c1", f"t{i}"): words for i in range(4)} | {("a", "c2", "t"): ["x", "x"], (None, "c1", "t"): ["n"], ("b", "c9", "t"): words}
    after = dict(base)
    after["a", "c1", "t0"] = words[:80] + ["in"] + words[80:]
    after["a", "c1", "t1"] = words[:120] + words[121:]
    after["a", "c1", "t2"] = words[:50] + ["other"] + words[51:]
    after[None, "c1", "t"] = [None]
    del after["b", "c9", "t"]
    after["b", "c8", "t"] = words
    nodes, rows = diff(release(spark, base), release(spark, after), block)
    got = {(r.level, r.key): r.status for r in nodes.collect()}
    assert got == {
        (0, "[]"): "changed", (1, '["a"]'): "changed", (1, "[null]"): "changed", (1, '["b"]'): "changed", (2, '["a","c1"]'): "changed", (2, '[null,"c1"]'): "changed",
        (2, '["b","c9"]'): "only_old", (2, '["b","c8"]'): "only_new", (3, '["a","c1","t0"]'): "changed", (3, '["a","c1","t1"]'): "changed",
        (3, '["a","c1","t2"]'): "changed", (3, '[null,"c1","t"]'): "changed",
    }
    found = [(r.key, r.status, r.old_n, r.new_n, r.columns) for r in rows.collect()]
    by = {k: [f[1:] for f in found if f[0] == k] for k in {f[0] for f in found}}
    assert by['["a","c1","t0"]'] == [("only_new", None, 81, None)] and by['[null,"c1","t"]'] == [("changed", 1, 1, ["gloss", "n"])]
    (status, at, none, _), = by['["a","c1","t1"]']  # which of equal neighbours went is open
    assert (status, none) == ("only_old", None) and words[at - 1] == words[120]
    (status, i, j, columns), = by['["a","c1","t2"]']
    assert (status, i, j) == ("changed", 51, 51) and columns[0] == "gloss" and len(found) == 4


@pytest.mark.parametrize("block", [1, 4])
def test_edits_rebuild_the_new_release(spark, block):
    """Taking out and putting in what the difference names makes the new rows out of the old, for random edits of repetitive rows."""
    rng = random.Random(9)
    old, new = {}, {}
    for t in range(12):
        words = [rng.choice("abcd") for _ in range(rng.randrange(80))]
        other = [w for w in words if rng.random() > 0.1]
        for _ in range(rng.randrange(8)):
            other.insert(rng.randrange(len(other) + 1), rng.choice("abcde"))
        old["s", "c", f"t{t}"], new["s", "c", f"t{t}"] = words or ["a"], other or ["b"]
    _, rows = diff(release(spark, old), release(spark, new), block)
    found = rows.collect()
    for (_, _, t), words in old.items():
        mine = [r for r in found if r.key == f'["s","c","{t}"]']
        gone, put = {r.old_n for r in mine}, {r.new_n for r in mine}
        kept = [w for i, w in enumerate(words, 1) if i not in gone]
        want = new["s", "c", t]
        assert kept == [w for j, w in enumerate(want, 1) if j not in put]
        if block == 1 and t == "t0":
            assert len(kept) >= 0.6 * longest(words, want)


def test_unchanged_corpora_are_not_moved(spark):
    """No exchange of the row comparison gets rows of transcripts that are the same."""
    words = [f"w{i}" for i in range(50)]
    base = {("a", f"c{k}", f"t{i}"): words for k in range(20) for i in range(5)}
    old, new = release(spark, base), release(spark, base | {("a", "c3", "t1"): words[:9] + words[10:]})
    keys = D.differing(*(D.tree(x, PATH, "place", ["gloss", "n"]) for x in (old, new)), 3).where("level = 3").cache()
    assert [r.key for r in keys.collect()] == ['["a","c3","t1"]']
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: sum(s.shuffleWriteRecords() for s in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)))
    before = stages()
    rows = D.changed_rows(old, new, PATH, "place", keys).collect()
    assert [(r.status, r.old_n) for r in rows] == [("only_old", 10)]
    assert stages() - before < 600, "5,000 rows on each side, 100 of them in the transcript that differs"


def test_empty_releases(spark):
    some = release(spark, {("a", "c", "t"): ["x"]})
    nodes, rows = diff(some, some.limit(0), 32)
    assert {(r.level, r.status) for r in nodes.collect()} <= {(0, "changed"), (0, "only_old"), (1, "only_old")} and rows.collect() == []
    assert diff(some, some, 32)[0].collect() == [] and diff(some.limit(0), some.limit(0), 32)[1].collect() == []
