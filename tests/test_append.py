"""Appends that add a batch once."""

import pytest
from pyspark.sql import functions as F

from utterlake.sources import append

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def held(spark, url, table="token"):
    return sorted(map(tuple, spark.read.jdbc(url, table, properties=DRIVER).collect()), key=repr)


@pytest.fixture
def rows(spark):
    # a third of all rows are equal, and some are null
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("w"), F.col("id") % 3)).alias("gloss"))


def test_a_batch_is_added_once(spark, rows, tmp_path):
    url, out = "jdbc:derby:memory:once;create=true", f"file://{tmp_path}"
    add = lambda df, batch: append.append_once(df, url, "token", batch, out, 4, DRIVER)
    want = sorted(map(tuple, rows.collect()), key=repr)
    assert add(rows, "a") == 3000 and add(rows, "a") == 0 and held(spark, url) == want
    assert add(rows, "b/é") == 3000 and add(rows.limit(0), "none") == 0
    assert held(spark, url) == sorted(want * 2, key=repr) and [p.name for p in tmp_path.iterdir()] == []
    with pytest.raises(ValueError):
        add(rows.withColumn("_part", F.lit(1)), "c")


def test_a_batch_cut_short_goes_on(spark, rows, tmp_path, monkeypatch):
    url, out = "jdbc:derby:memory:short;create=true", f"file://{tmp_path}"
    monkeypatch.setattr(append, "RUN", 50)
    move, moved = append._move, []

    def dies(*args):
        if len(moved) == 2:
            raise OSError("the driver dies")
        moved.append(move(*args))
        return moved[-1]

    monkeypatch.setattr(append, "_move", dies)
    with pytest.raises(OSError):
        append.append_once(rows, url, "token", "a", out, 8, DRIVER)
    assert 0 < len(held(spark, url)) == sum(moved) < 3000
    monkeypatch.setattr(append, "_move", move)
    # what the second call is given no longer counts: the batch is what the first one wrote
    assert append.append_once(rows.withColumn("id", F.col("id") * 0), url, "token", "a", out, 8, DRIVER) == 3000 - sum(moved)
    assert held(spark, url) == sorted(map(tuple, rows.collect()), key=repr)


def test_a_failed_move_leaves_nothing_and_copies_of_tasks_count_once(spark, rows, tmp_path):
    url = "jdbc:derby:memory:copies;create=true"
    append._ledger(spark, url, "append_ledger", "a", DRIVER)
    both = [rows.withColumns({"_part": F.lit(0).cast("long"), "_copy": F.lit(c).cast("long")}) for c in (11, 12)]
    append._write(both[0].unionByName(both[1]), url, "stage", DRIVER)
    append._write(rows.limit(0), url, "token", DRIVER)
    one = lambda copy: append._move(spark, url, "stage", "token", "append_ledger", "a", 0, copy, ["id", "gloss"], '"', DRIVER)
    assert one(11) == 3000
    with pytest.raises(Exception, match="(?i)duplicate"):
        one(12)
    assert len(held(spark, url)) == 3000 and append._ledger(spark, url, "append_ledger", "a", DRIVER) == {0}
