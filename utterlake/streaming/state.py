"""Own state in streams: PIDs that are forgotten once they have not been seen for a while, and late rows that are kept apart.

Spark's own stateful operators drop rows behind the watermark without a trace, and dropDuplicates() without a time holds every PID for ever. Here a
row behind the watermark is handed on as late, and a PID's state goes when a timer finds it unused for `ttl`; both follow event time, so that a
stream read again in the same batches gives the same rows. State lives in the RocksDB store, outside the memory of the tasks.

Statuses: first (no row of the PID within ttl before it), repeat, late (behind the watermark as the batch began; changes no state), and expired, which no
row stands for: at the time when a PID is forgotten. Rows without PID or time are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SETTING = "spark.sql.streaming.stateStore.providerClass"


class Sightings(StatefulProcessor):
    """When a PID was last seen; one timer for each PID, set anew when it finds the PID seen since."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def _rows(self, pid: str, found: list[tuple[int, str]]) -> Iterator[pd.DataFrame]:
        if found:
            at, status = zip(*found)
            yield pd.DataFrame({"pid": [pid] * len(at), "at": at, "status": status})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = max(0, timerValues.getCurrentWatermarkInMs())
        last = self.last.get()[0] if self.last.exists() else None
        timed, found = last is not None, []
        for at in sorted(int(x) for batch in rows for x in batch["at"]):
            if at < mark:
                found.append((at, "late"))
                continue
            fresh = last is None or at > last + self.ttl
            if fresh and last is not None:
                found.append((last + self.ttl, "expired"))
            found.append((at, "first" if fresh else "repeat"))
            last = at if last is None else max(last, at)
        if last is not None:
            self.last.update((last,))
            if not timed:
                self.handle.registerTimer(last + self.ttl)
        yield from self._rows(key[0], found)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        end = self.last.get()[0] + self.ttl
        if end > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(end)
            return
        self.last.clear()
        yield from self._rows(key[0], [(end, "expired")])

    def close(self) -> None:
        pass


def sightings(stream: DataFrame, pid: str, time: str, ttl_seconds: int, late: str = "10 minutes") -> DataFrame:
    """pid, at (ms since 1970), status of a stream's rows. late: how far the watermark stays behind the latest time seen."""
    stream.sparkSession.conf.set(_SETTING, PROVIDER)
    at = F.unix_millis(F.col(time).cast("timestamp"))
    # the number carries no watermark with it, so that Spark leaves late rows in
    marked = stream.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    rows = marked.where(F.col(pid).isNotNull() & F.col(time).isNotNull()).select(F.col(pid).cast("string").alias("pid"), at.alias("at"))
    return rows.groupBy("pid").transformWithStateInPandas(Sightings(1000 * ttl_seconds), "pid string, at long, status string", "Append", "EventTime")


def tables(base: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that puts late rows in base/late, all others in base/seen; a repeated batch replaces its own folders."""

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        for name, where in (("late", "status = 'late'"), ("seen", "status <> 'late'")):
            kept.where(where).write.mode("overwrite").parquet(f"{base}/{name}/batch={number:09d}")
        kept.unpersist()

    return write


def read(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Rows of late or seen, as tables() has written them."""
    return spark.read.schema("pid string, at long, status string").parquet(f"{base}/{name}").select("pid", "at", "status")
