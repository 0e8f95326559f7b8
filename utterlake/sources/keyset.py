"""Database tables read by ranges of their key that hold about as many rows each, and exports that go on where the last one ended.

Keys are rarely even: ids come in blocks, and rows are deleted. The database counts rows in cells of the key's span, at most CELLS rows an answer; cells
that hold more than a task's share are counted again by themselves, and ranges are cut from the cells in order. A task's query is a range of the key, so
that the database walks its index once and no page is found by skipping rows. In an SQLite database (`sources.sqlite`) tasks count the cells, each by its
part of the index; the key is an indexed column or rowid.

An export covers the keys above the last one exported, up to the largest as it began. Its rows go to a folder of that key, and only once they are
written does the key enter the ledger; a failed export leaves a folder that no reader looks at and that the next one replaces or ignores. Keys must grow:
a row that is added or changed below the last key exported is not seen. Null keys are in no range.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.sources import sqlite

CELLS = 1000


def _one(spark: SparkSession, url: str, query: str, properties: Mapping[str, str]) -> list:
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**properties).load().collect()


def ranges(spark: SparkSession, url: str, table: str, key: str, parts: int, properties: Mapping[str, str], after: int | None = None) -> list[tuple[int, int, int]]:
    """(first key, last key, rows) of at most some `parts` ranges in order, of keys above `after`. key and table as the database spells them."""
    above = f"{key} IS NOT NULL" if after is None else f"{key} > {after}"

    def cells(low: int, high: int) -> list[tuple[int, int, int]]:
        width = (high - low) // CELLS + 1
        if sqlite.at(url):
            counts = [f"SELECT MIN({key}), MAX({key}), COUNT(*) FROM {table} WHERE {key} >= {i} AND {key} <= {min(i + width - 1, high)}" for i in range(low, high + 1, width)]
            found = sqlite.select(spark, url, counts, "lo long, hi long, n long", tasks=parts).where("n > 0").collect()
            return sorted((r.lo, r.hi, r.n) for r in found)
        offset = f"({key} - {low})"
        cell = f"SELECT ({offset} - MOD({offset}, {width})) / {width} AS cell, {key} AS k FROM {table} WHERE {key} >= {low} AND {key} <= {high}"
        found = _one(spark, url, f"SELECT MIN(k) AS lo, MAX(k) AS hi, COUNT(*) AS n FROM ({cell}) c GROUP BY cell", properties)
        return sorted((int(r[0]), int(r[1]), int(r[2])) for r in found)

    if sqlite.at(url):
        ends = ", ".join(f"(SELECT {f}({key}) FROM {table} WHERE {above})" for f in ("MIN", "MAX"))  # by the index's ends
        (low, high), = sqlite.select(spark, url, [f"SELECT {ends}"], "lo long, hi long").collect()
        left = [] if low is None else cells(low, high)
        n = sum(c[2] for c in left)
    else:
        (low, high, n), = _one(spark, url, f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {table} WHERE {above}", properties)
        left = [(int(low), int(high), int(n))] if n else []
    if not n:
        return []
    share, fine = -(-int(n) // parts), []
    while left:
        low, high, n = left.pop()
        if n <= share // 4 or low == high:
            fine.append((low, high, n))
        elif high - low < CELLS:
            fine += cells(low, high)  # a key each
        else:
            left += cells(low, high)
    out: list[tuple[int, int, int]] = []
    for low, high, n in sorted(fine):
        if out and out[-1][2] + n <= share:
            out[-1] = (out[-1][0], high, out[-1][2] + n)
        else:
            out.append((low, high, n))
    return out


def read(spark: SparkSession, url: str, table: str, key: str, parts: int, properties: Mapping[str, str], after: int | None = None) -> DataFrame:
    """The table's rows with keys above `after`, a partition for each range."""
    found = ranges(spark, url, table, key, parts, properties, after)
    return _of(spark, url, table, key, found, properties)


def _of(spark: SparkSession, url: str, table: str, key: str, found: list[tuple[int, int, int]], properties: Mapping[str, str]) -> DataFrame:
    wanted = [f"{key} >= {low} AND {key} <= {high}" for low, high, _ in found] or ["1 = 0"]
    if sqlite.at(url):
        schema = sqlite.schema(url, table)
        columns = ", ".join(map(sqlite.named, schema.names))
        return sqlite.select(spark, url, [f"SELECT {columns} FROM {table} WHERE {w}" for w in wanted], schema)
    return spark.read.jdbc(url, table, predicates=wanted, properties=dict(properties))


def _ledger(spark: SparkSession, out: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/ledger")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "upto long")
    return spark.read.schema("upto long").parquet(f"{out}/ledger")


def export_new(spark: SparkSession, url: str, table: str, key: str, out: str, parts: int, properties: Mapping[str, str]) -> int:
    """Write what is new since the last export; returns the rows that ranges counted."""
    last = _ledger(spark, out).agg(F.max("upto")).first()[0]
    found = ranges(spark, url, table, key, parts, properties, last)
    if not found:
        return 0
    upto = found[-1][1]
    _of(spark, url, table, key, found, properties).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/rows/upto={upto}")
    spark.range(1).select(F.lit(upto).cast("long").alias("upto")).write.mode("overwrite").parquet(f"{out}/ledger/number={upto}")
    return sum(n for *_, n in found)


def exported(spark: SparkSession, out: str) -> DataFrame:
    """Rows of all finished exports, with upto, the last key of the one that wrote them."""
    rows = spark.read.parquet(f"{out}/rows").withColumn("upto", F.col("upto").cast("long"))
    return rows.join(_ledger(spark, out).select("upto").distinct(), "upto", "left_semi")
