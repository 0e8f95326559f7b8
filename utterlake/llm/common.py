"""Helpers that the training-data operators share: the shared scratch folder, and hashing of byte spans."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []
_shipped: set[str] = set()


def _session_dir(spark: SparkSession) -> str:
    """The folder of a session's intermediate tables, under the one that spark.checkpoint.dir names, which all executors share.

    Where the setting is absent, which only a local session may leave so, a temporary folder of this process stands in.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="utterlake-"))
            atexit.register(shutil.rmtree, _own_dir[0], True)
        base = "file://" + _own_dir[0]
    return f"{base.rstrip('/')}/utterlake/{sc.applicationId}"


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A fresh path in the session's shared folder."""
    return f"{_session_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def clean(spark: SparkSession) -> None:
    """Delete all that operators have left in the session's shared folder; DataFrames that they returned cannot be read after it."""
    remove(spark, _session_dir(spark))


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of a session, in case they cannot import it by themselves."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="utterlake-")) / f"{package.name}.zip"
    atexit.register(shutil.rmtree, target.parent, True)
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


#: Codecs of tables whose rows repeat long stretches of each other; others take Spark's default, which costs less time.
CODECS = {"chat-examples": "zstd"}


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: what follows doesn't recompute it, whatever executor is lost."""
    path = shared_dir(df.sparkSession, tag)
    writer = df.write.option("compression", CODECS[tag]) if tag in CODECS else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system that Spark can open."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_cut(df: DataFrame) -> None:
    """Delete the files behind a DataFrame that cut() returned and that nothing reads any more."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _places(n: int) -> np.ndarray:
    """Odd multipliers for the first n positions of a span; grown on demand, the same in every process."""
    global _PLACE
    if n > len(_PLACE):
        more = np.arange(len(_PLACE), 1 << int(n - 1).bit_length(), dtype=np.uint64)
        _PLACE = np.concatenate([_PLACE, mix64(more + np.uint64(0xA5A5A5A5)) | np.uint64(1)])
    return _PLACE


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans buf[starts:ends] (ascending, disjoint, none empty); equal spans hash equally."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    place = np.arange(int(lens.sum()), dtype=np.int64)
    first = np.cumsum(lens) - lens
    place -= np.repeat(first, lens)
    whole = len(place) == ends[-1] - starts[0]
    data = buf[starts[0] : ends[-1]] if whole else buf[place + np.repeat(starts, lens)]
    val = _BYTE[data]
    val *= _places(int(lens.max()))[place]
    return mix64(np.add.reduceat(val, first) + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def joined_bytes(texts, end: int = 0xFF) -> tuple[np.ndarray, np.ndarray]:
    """All texts as UTF-8 in one array, each followed by a byte that no UTF-8 holds, and where each text starts (null: empty)."""
    parts = [b"" if t is None else t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]
    lens = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    tail = bytes([end])
    return np.frombuffer(tail.join(parts) + tail, np.uint8), np.cumsum(lens) - lens


def text_slices(column, limit: int = 2_000_000):
    """(first, last) row ranges of an Arrow string column, each of about limit bytes or a single longer text."""
    import pyarrow.compute as pc

    lens = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    total = np.cumsum(lens)
    at = 0
    while at < len(lens):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + limit, "right")))
        yield at, to
        at = to
