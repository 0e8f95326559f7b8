"""Databases in a shared folder, which every process opens by itself."""

import os
import random
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pyspark
import pytest
from pyspark.sql import functions as F

from utterlake.sources import append, keyset, sqlite

CLUSTER = """
import sys
from pyspark.sql import SparkSession
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "600m", "spark.checkpoint.dir": f"file://{sys.argv[2]}/shared", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
import __spark_entry__
rows = __spark_entry__.queries()[sys.argv[1]](spark, "/root/testdata/sf0.001")
print("ROWS", rows.count(), rows.dropDuplicates(["o_orderkey"]).count(), spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count())
"""


def held(spark, url, table="token", parts=4):
    return sorted(map(tuple, keyset.read(spark, url, table, "rowid", parts, {}).collect()), key=repr)


@pytest.fixture
def rows(spark):
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("w\0é"), F.col("id") % 3)).alias("gloss"), (F.col("id") / 7).alias("x y"))


@pytest.mark.parametrize("query", ["appended_once", "keyset_export"])
def test_executors_reach_the_database(tmp_path, query):
    home = tmp_path / "home"  # executors' logs go to Spark's home
    home.mkdir()
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = os.environ | {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable, "PYSPARK_SUBMIT_ARGS": "--driver-memory 1g pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", CLUSTER, query, str(tmp_path)], env=env, cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=300)
    got = next((line.split()[1:] for line in out.stdout.splitlines() if line.startswith("ROWS")), out.stderr[-2000:])
    assert len(got) == 3 and got[0] == got[1] == got[2] != "0", got


def test_a_batch_is_added_once(spark, rows, tmp_path):
    url, out = sqlite.new(f"file://{tmp_path}/a db"), f"file://{tmp_path}/batches"
    add = lambda df, batch: append.append_once(df, url, "token", batch, out, 4)
    want = sorted(map(tuple, rows.collect()), key=repr)
    assert add(rows, "a") == 3000 and add(rows, "a") == 0 and held(spark, url) == want
    assert add(rows, "b/é") == 3000 and add(rows.limit(0), "none") == 0
    assert held(spark, url) == sorted(want * 2, key=repr) and keyset.read(spark, url, "token", "rowid", 4, {}).dtypes == rows.dtypes
    with pytest.raises(ValueError):
        append.append_once(rows.withColumn("day", F.current_date()), url, "other", "c", out, 4)
    with pytest.raises(Exception, match="NaN"):
        add(rows.withColumn("x y", F.lit(float("nan"))), "nan")
    assert len(held(spark, url)) == 6000


def test_a_task_that_fails_leaves_nothing_and_one_that_runs_again_adds_nothing(spark, rows, tmp_path):
    url = sqlite.new(str(tmp_path))
    sqlite.create(url, "token", rows.schema)
    append._ledger(spark, url, "append_ledger", "a", {})
    batches = [pa.RecordBatch.from_pylist([{"id": i, "gloss": "w", "x y": 0.5, "_part": i % 2} for i in range(k, k + 10)]) for k in (0, 10)]
    enter = lambda of: append._enter(url, "token", "append_ledger", "a", iter(of))

    def broken():
        yield batches[0]
        raise OSError("the executor is lost")

    with pytest.raises(OSError):
        enter(broken())
    assert held(spark, url) == [] and append._ledger(spark, url, "append_ledger", "a", {}) == set()
    enter(b.filter(pa.array([i % 2 == 1 for i in range(10)])) for b in batches)
    assert len(held(spark, url)) == 10 and append._ledger(spark, url, "append_ledger", "a", {}) == {1}
    for _ in range(2):  # part 1 is there, part 0 comes twice
        enter(batches)
    assert sorted(r[0] for r in held(spark, url)) == list(range(20)) and append._ledger(spark, url, "append_ledger", "a", {}) == {0, 1}


@pytest.mark.parametrize("shape", ["even", "blocks", "far", "same", "negative"])
def test_ranges_hold_even_shares(spark, shape, tmp_path):
    rng = random.Random(1)
    ids = {
        "even": range(1, 3001),
        "blocks": [*range(1, 2001), *range(10**9 + 1, 10**9 + 801), *rng.sample(range(10**12, 2 * 10**12), 200)],
        "far": [*range(2999), 9 * 10**18],
        "same": [5] * 1500 + list(range(6, 1506)),
        "negative": [-(i**3) for i in range(3000)],
    }[shape]
    url, rows = sqlite.new(str(tmp_path)), spark.createDataFrame([(i,) for i in ids], "id long")
    sqlite.create(url, "token", rows.schema, key="id")
    assert keyset.ranges(spark, url, "token", '"id"', 10, {}) == [] and keyset.read(spark, url, "token", '"id"', 4, {}).count() == 0
    append.append_once(rows, url, "token", "a", f"{tmp_path}/batches", 4)
    found = keyset.ranges(spark, url, "token", '"id"', 10, {})
    sizes = [sum(low <= i <= high for i in ids) for low, high, _ in found]
    assert sizes == [n for *_, n in found] and sum(sizes) == 3000 and max(sizes) <= (1500 if shape == "same" else 300) and len(found) <= 20
    back = keyset.read(spark, url, "token", '"id"', 10, {})
    assert back.rdd.getNumPartitions() == len(found) and sorted(r.id for r in back.collect()) == sorted(ids)
    after = sorted(ids)[1000]
    assert keyset.read(spark, url, "token", '"id"', 4, {}, after).count() == sum(i > after for i in ids)


def test_a_store_that_is_no_folder_is_an_error():
    with pytest.raises(ValueError):
        sqlite.new("hdfs://host/shared")
