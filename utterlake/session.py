"""Sessions set up for this library."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with CONF; further settings as keyword arguments with _ for the dots."""
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    for k, v in (CONF | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


_scratch: list[str] = []


def scratch_dir(spark: SparkSession, tag: str = "plans") -> str:
    """A fresh path for intermediate tables in the shared folder that spark.checkpoint.dir names.

    Where none is set, which only local sessions may do, it lies in a temporary folder that goes with this process.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _scratch:
            _scratch.append(tempfile.mkdtemp(prefix="utterlake-"))
            atexit.register(shutil.rmtree, _scratch[0], True)
        base = "file://" + _scratch[0]
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written to the shared folder and read back, so that what follows doesn't compute it again, whatever executor is lost."""
    path = scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
