"""Database reads by ranges of the key, and exports that go on where the last one ended."""

import random

import pytest
from pyspark.sql import functions as F

from utterlake.sources import keyset, tables

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def database(spark, name, ids):
    url = f"jdbc:derby:memory:{name};create=true"
    rows = spark.createDataFrame([(i, f"w{i % 7}") for i in ids], "id long, gloss string")
    tables.write_jdbc(rows, url, "token", "overwrite", DRIVER)
    return url, rows


@pytest.mark.parametrize("shape", ["even", "blocks", "far", "same", "negative"])
def test_ranges_hold_even_shares(spark, shape):
    rng = random.Random(1)
    ids = {
        "even": range(1, 3001),
        "blocks": [*range(1, 2001), *range(10**9 + 1, 10**9 + 801), *rng.sample(range(10**12, 2 * 10**12), 200)],
        "far": [*range(2999), 9 * 10**18],
        "same": [5] * 1500 + list(range(6, 1506)),
        "negative": [-(i**3) for i in range(3000)],
    }[shape]
    url, _ = database(spark, f"ranges{shape}", ids)
    found = keyset.ranges(spark, url, "token", '"id"', 10, DRIVER)
    assert sum(n for *_, n in found) == 3000 and all(a[1] < b[0] for a, b in zip(found, found[1:]))
    sizes = [sum(low <= i <= high for i in ids) for low, high, _ in found]
    assert sizes == [n for *_, n in found] and max(sizes) <= (1500 if shape == "same" else 300) and len(found) <= 20
    back = keyset.read(spark, url, "token", '"id"', 10, DRIVER)
    assert back.rdd.getNumPartitions() == len(found) and sorted(r.id for r in back.collect()) == sorted(ids)
    after = sorted(ids)[1000]
    assert keyset.read(spark, url, "token", '"id"', 4, DRIVER, after).count() == sum(i > after for i in ids)


def test_exports_go_on(spark, tmp_path):
    url, rows = database(spark, "exports", range(1, 1001))
    out = f"file://{tmp_path}/out"
    export = lambda: keyset.export_new(spark, url, "token", '"id"', out, 4, DRIVER)
    assert export() == 1000 and export() == 0
    tables.write_jdbc(rows.withColumn("id", F.col("id") * 1000 + 5), url, "token", "append", DRIVER)
    # an export that failed before its key entered the ledger
    rows.limit(3).write.parquet(f"{out}/rows/upto=77")
    assert export() == 1000
    got = keyset.exported(spark, out)
    assert got.count() == 2000 and {r.upto: r["count"] for r in got.groupBy("upto").count().collect()} == {1000: 1000, 1_000_005: 1000}


def test_empty_table(spark, tmp_path):
    url, _ = database(spark, "nothing", [])
    assert keyset.ranges(spark, url, "token", '"id"', 4, DRIVER) == [] and keyset.read(spark, url, "token", '"id"', 4, DRIVER).count() == 0
    assert keyset.export_new(spark, url, "token", '"id"', f"file://{tmp_path}/out", 4, DRIVER) == 0
