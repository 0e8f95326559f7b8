"""Incremental forms of batch operators, as Structured Streaming queries that stop once they have read what is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def files(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """A stream of the files that arrive under path."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def folder_of(path: str) -> str:
    """A path that the file stream takes whether it is a file or a folder."""
    above, name = path.rsplit("/", 1)
    return f"{above}/{name.replace('.parquet', '.parque[t]')}"


def run(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Hand all that is new to write(batch, number), then stop; a later run goes on from the checkpoint."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    return q


def to_parquet(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Append what is new to out, exactly once."""
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def first_pids(stream: DataFrame, pid: str = "pid") -> DataFrame:
    """Rows whose pid hasn't been seen. State holds every pid, without a time limit, as PIDs have no time."""
    return stream.dropDuplicates([pid])


def age_ranges(stream: DataFrame, key: list[str], age: str) -> DataFrame:
    """Least and largest known age by key, kept up to date; zero and unknown ages don't count. Use update or complete mode."""
    known = F.when(F.col(age) > 0, F.col(age))
    return stream.groupBy(*key).agg(F.min(known).alias("min_age"), F.max(known).alias("max_age"))


def upsert(base: str, key: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that keeps the latest row of each key: one folder a batch, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/batch={number:09d}")

    return write


def latest(spark: SparkSession, base: str, key: list[str]) -> DataFrame:
    """The table that upsert() has written."""
    rows = spark.read.parquet(base).drop("batch")
    rest = [c for c in rows.columns if c not in key and c != "_batch"]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "_batch").alias("_row")).select(*key, "_row.*")


def windows(stream: DataFrame, time: str, width: str, slide: str | None = None, late: str = "10 minutes", by: list[str] | None = None) -> DataFrame:
    """Counts by (sliding) event-time window; rows later than `late` are dropped."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w, *(by or [])).agg(F.count("*").alias("n"))


def sessions(stream: DataFrame, time: str, gap: str, by: list[str], late: str = "10 minutes") -> DataFrame:
    """Counts by session: rows of a key with less than `gap` between them."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n"))
