"""Tables of an SQLite database: one file in a folder that the driver and all executors share, opened by each task that needs it.

Any number of tasks read at a time, and one writes, while the others wait at the file's lock; the folder's file system must keep such locks between
processes of all hosts. Rows go from and to tasks alone, batch by batch: the driver makes tables, reads ledgers and hands out statements. A URL is sqlite:<path>.
"""

from __future__ import annotations

import re
import sqlite3
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEME = "sqlite:"
#: Seconds that a task waits for others to write.
WAIT = 7200
#: Rows that a task holds as it reads.
ROWS = 10_000
#: Spark type -> type of a column.
TYPES = {"bigint": "BIGINT", "int": "INT", "double": "DOUBLE", "string": "TEXT"}
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}


def at(url: str) -> bool:
    return url.startswith(SCHEME)


def new(folder: str) -> str:
    """URL of a database in the folder, which all executors share; it is made if it is absent."""
    path = re.sub(r"^file:/+", "/", folder)
    if not path.startswith("/"):
        raise ValueError(f"{folder}: an SQLite database needs a folder that every host mounts")
    Path(path).mkdir(parents=True, exist_ok=True)
    sqlite3.connect(f"{path}/database.sqlite").close()
    return f"{SCHEME}{path}/database.sqlite"


@contextmanager
def transaction(url: str, write: bool = False) -> Iterator[sqlite3.Connection]:
    """Statements whose effects are all kept, or none where an error leaves the block."""
    # no database is made where there is none, as in a folder that isn't shared; readers may have to roll back what a lost writer left
    connection = sqlite3.connect(f"file:{quote(url.removeprefix(SCHEME))}?mode=rw", timeout=WAIT, isolation_level=None, uri=True)
    try:
        connection.execute("BEGIN IMMEDIATE" if write else "BEGIN")
        yield connection
        connection.execute("COMMIT")
    except BaseException:
        if connection.in_transaction:
            connection.execute("ROLLBACK")
        raise
    finally:
        connection.close()


def named(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


def create(url: str, table: str, schema: T.StructType, key: str | None = None) -> None:
    """Make the table if it is absent, with an index on the key. Other types than those of TYPES are an error."""
    for f in schema:
        if f.dataType.simpleString() not in TYPES:
            raise ValueError(f"{f.name}: no type for {f.dataType.simpleString()}")
    columns = ", ".join(f"{named(f.name)} {TYPES[f.dataType.simpleString()]}" for f in schema)
    with transaction(url, write=True) as c:
        c.execute(f"CREATE TABLE IF NOT EXISTS {table} ({columns})")
        if key:
            c.execute(f"CREATE INDEX IF NOT EXISTS {table}_{key} ON {table} ({named(key)})")


def schema(url: str, table: str) -> T.StructType:
    spark_types = {v: k for k, v in TYPES.items()}
    with transaction(url) as c:
        return T.StructType.fromDDL(", ".join(f"`{name}` {spark_types[kind]}" for _, name, kind, *_ in c.execute(f"PRAGMA table_info({table})")))


def insert(connection: sqlite3.Connection, table: str, rows: pa.RecordBatch) -> None:
    """Add rows to the table. NaN is an error, as SQLite would keep it as null."""
    for name, column in zip(rows.schema.names, rows.columns):
        if pa.types.is_floating(column.type) and pc.any(pc.is_nan(column)).as_py():
            raise ValueError(f"{name}: SQLite has no NaN")
    names, places = ", ".join(map(named, rows.schema.names)), ", ".join("?" * rows.num_columns)
    connection.executemany(f"INSERT INTO {table} ({names}) VALUES ({places})", zip(*(column.to_pylist() for column in rows.columns)))


def select(spark: SparkSession, url: str, statements: list[str], schema: T.StructType | str, tasks: int | None = None) -> DataFrame:
    """What the statements return, a partition for each of them or, in their order, `tasks` partitions for all."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = pa.schema([(f.name, ARROW[f.dataType.simpleString()]) for f in schema])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with transaction(url) as c:
                for i in batch.column(0).to_pylist():
                    found = c.execute(statements[i])
                    while rows := found.fetchmany(ROWS):
                        yield pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows), fields)], schema=fields)

    return spark.range(0, len(statements), 1, min(tasks or len(statements), len(statements))).mapInArrow(read, schema)
