"""Appends to database tables that add a batch's rows once, however often tasks, calls or drivers fail and start again.

A batch has a name. Its rows are first written to a folder of that name and cut into parts by file and place, so that every later attempt has the same
parts, whatever the rows' values and whatever made them. Tasks write parts to a staging table of the attempt, a transaction a task; a task that ran
twice leaves two copies, which differ by their number, and one whole copy of each part is moved. A move is one transaction of the database: the part's rows
go to the table, and (batch, part) to the ledger, whose key refuses a second one. Only names, numbers and statements pass through the driver.

A task holds its own transaction where the database is an SQLite file in a shared folder: its parts' rows and their entries are one transaction, and a
task that runs again finds the entries and leaves the rows.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from itertools import chain

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utterlake.sources import sqlite
from utterlake.sources.tables import Files, retry

#: Rows of a file that stay together in a part.
RUN = 10_000
#: The ledger's part number for a batch that is complete.
WHOLE = -1


@F.pandas_udf(T.LongType())
def _attempt(part: pd.Series) -> pd.Series:
    """Number of the task attempt that writes a row."""
    return pd.Series(TaskContext.get().taskAttemptId(), index=part.index)


@contextmanager
def _transaction(spark: SparkSession, url: str, properties: Mapping[str, str]) -> Iterator:
    """A statement whose effects are all kept, or none where an error leaves the block."""
    java = spark._jvm.java
    settings = java.util.Properties()
    for k, v in properties.items():
        settings.setProperty(k, v)
    connection = java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        yield connection
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _run(connection, statement: str, *values) -> int:
    prepared = connection.prepareStatement(statement)
    for i, v in enumerate(values, 1):
        prepared.setString(i, v) if isinstance(v, str) else prepared.setLong(i, v)
    n = prepared.executeUpdate()
    prepared.close()
    return n


def _write(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append") -> None:
    df.write.jdbc(url, table, mode, {"batchsize": "1000", **properties})


def _ledger(spark: SparkSession, url: str, ledger: str, batch: str, properties: Mapping[str, str]) -> set[int]:
    """Parts of the batch that the table holds."""
    if sqlite.at(url):
        with sqlite.transaction(url, write=True) as c:
            c.execute(f"CREATE TABLE IF NOT EXISTS {ledger} (batch TEXT NOT NULL, part BIGINT NOT NULL, n BIGINT NOT NULL, PRIMARY KEY (batch, part))")
            return {r[0] for r in c.execute(f"SELECT part FROM {ledger} WHERE batch = ?", (batch,))}
    with _transaction(spark, url, properties) as c:
        there = c.getMetaData().getTables(None, None, "%", None)
        names = set()
        while there.next():
            names.add(there.getString("TABLE_NAME").lower())
        if ledger.rsplit(".", 1)[-1].lower() not in names:
            _run(c, f"CREATE TABLE {ledger} (batch VARCHAR(200) NOT NULL, part BIGINT NOT NULL, n BIGINT NOT NULL, PRIMARY KEY (batch, part))")
            return set()
    rows = spark.read.jdbc(url, ledger, properties=dict(properties))
    batch_column, part = rows.columns[:2]
    return {int(r[0]) for r in rows.where(F.col(batch_column) == batch).select(part).collect()}


def _parts(spark: SparkSession, folder: str, parts: int) -> DataFrame:
    """A stored batch's rows with _part: runs of RUN rows of a file, dealt to parts."""
    rows = spark.read.parquet(folder)
    run = F.xxhash64(F.col("_metadata.file_name"), F.floor(F.col("_metadata.row_index") / RUN))
    return rows.withColumn("_part", F.pmod(run, F.lit(parts)))


def _move(spark: SparkSession, url: str, stage: str, table: str, ledger: str, batch: str, part: int, copy: int, columns: list[str], quote: str, properties: Mapping[str, str]) -> int:
    """A part's rows from the staging table to the table, together with its entry in the ledger."""
    q = lambda name: f"{quote}{name}{quote}"
    names = ", ".join(map(q, columns))
    with _transaction(spark, url, properties) as c:
        n = _run(c, f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} WHERE {q('_part')} = ? AND {q('_copy')} = ?", part, copy)
        _run(c, f"INSERT INTO {ledger} (batch, part, n) VALUES (?, ?, ?)", batch, part, n)
    return n


def _enter(url: str, table: str, ledger: str, batch: str, batches: Iterator[pa.RecordBatch]) -> None:
    """A task's rows to the table, together with the entries of their parts in the ledger; parts that it has already are left out."""
    filled = (b for b in batches if b.num_rows)
    first = next(filled, None)
    if first is None:
        return
    with sqlite.transaction(url, write=True) as c:
        done = pa.array([r[0] for r in c.execute(f"SELECT part FROM {ledger} WHERE batch = ?", (batch,))], pa.int64())
        added: Counter = Counter()
        for b in chain([first], filled):
            b = b.filter(pc.invert(pc.is_in(b.column("_part"), value_set=done)))
            added.update(b.column("_part").to_pylist())
            sqlite.insert(c, table, b.drop_columns(["_part"]))
        c.executemany(f"INSERT INTO {ledger} (batch, part, n) VALUES (?, ?, ?)", [(batch, part, n) for part, n in sorted(added.items())])


def _append_by_tasks(left: DataFrame, url: str, table: str, ledger: str, batch: str, parts: int) -> int:
    """append_once for what is left of a batch, by transactions of tasks."""
    sqlite.create(url, table, left.drop("_part").schema)

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _enter(url, table, ledger, batch, batches)
        yield from ()

    def held() -> int:
        with sqlite.transaction(url) as c:
            return c.execute(f"SELECT COALESCE(SUM(n), 0) FROM {ledger} WHERE batch = ?", (batch,)).fetchone()[0]

    before = held()
    left.repartition(parts, "_part").mapInArrow(entered, "n long").write.format("noop").mode("overwrite").save()  # all rows of a part in a task
    added = held() - before
    with sqlite.transaction(url, write=True) as c:
        c.execute(f"INSERT INTO {ledger} (batch, part, n) VALUES (?, ?, 0)", (batch, WHOLE))
    return added


def append_once(df: DataFrame, url: str, table: str, batch: str, folder: str, parts: int = 32, properties: Mapping[str, str] | None = None, ledger: str = "append_ledger") -> int:
    """Add df to the table as `batch`; returns the rows that this call added: 0 for a batch that is complete, the rest for one that was cut short.

    The table is made if it is absent. A batch's rows are those that its first call wrote to folder, which later calls take from there; it goes
    once the batch is complete. One part is one transaction, so `parts` says how large these are. A call that is killed can leave its staging table
    (<table>_stage_...), which no other reads; an SQLite database (`sources.sqlite`) needs none. Columns named _part or _copy are an error. A batch without rows only enters the ledger.
    """
    spark, properties = df.sparkSession, dict(properties or {})
    if {"_part", "_copy"} & set(df.columns):
        raise ValueError("_part and _copy are names of the staging table")
    done = _ledger(spark, url, ledger, batch, properties)
    if WHOLE in done:
        return 0
    files, name = Files(spark, folder), batch.encode().hex()
    if not files.exists(f"{name}/_SUCCESS"):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    rows = _parts(spark, f"{folder}/{name}", parts)
    if sqlite.at(url):
        added = _append_by_tasks(rows.where(~F.col("_part").isin(sorted(done))) if done else rows, url, table, ledger, batch, parts)
        files.remove(name)
        return added
    _write(rows.drop("_part").limit(0), url, table, properties)

    def staged() -> tuple[str, list[tuple[int, int]]]:
        stage = f"{table}_stage_{uuid.uuid4().hex[:12]}"
        left = rows.where(~F.col("_part").isin(sorted(done))) if done else rows
        _write(left.repartition(parts, "_part").withColumn("_copy", _attempt("_part")), url, stage, properties, "error")
        copies = spark.read.jdbc(url, stage, properties=properties).groupBy("_part").agg(F.min("_copy").alias("copy"))  # a row a part
        return stage, sorted((int(r[0]), int(r[1])) for r in copies.collect())

    stage, found = retry(staged)
    with _transaction(spark, url, properties) as c:
        quote = c.getMetaData().getIdentifierQuoteString().strip()
    try:
        added = sum(retry(lambda p=p, copy=copy: _move(spark, url, stage, table, ledger, batch, p, copy, df.columns, quote, properties)) for p, copy in found)
        with _transaction(spark, url, properties) as c:
            _run(c, f"INSERT INTO {ledger} (batch, part, n) VALUES (?, ?, ?)", batch, WHOLE, 0)
    finally:
        with _transaction(spark, url, properties) as c:
            _run(c, f"DROP TABLE {stage}")
    files.remove(name)
    return added
