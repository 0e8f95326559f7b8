"""Requested documents out of token shards: only the tails of shards and the frames that hold the documents are read.

A task reads a shard's last bytes, its seek table and its document index (some 17 bytes a document), and names the frames of each document. The rows of
requested documents are kept by a semi-join, opened to one row a frame and shuffled by frame, so that a frame is read and decompressed once for all
documents in it and a long document's frames spread over tasks. Pieces are put together by document.

Defined cases: a doc_id that no shard holds gives no row; one that several documents have gives all of them, each by its place; null finds nothing,
and repeated requests count once. A document of the end id alone is returned as such. A damaged frame is an error for the documents in it alone.
Shards are read by ranges through the file system that pyarrow opens for their path, from every executor.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from utterlake.llm.tokens import SEEK_MAGIC, Shard

#: Bytes read at a shard's end at first; more only where the seek table is longer.
TAIL = 1 << 16
PIECE = "frame int, at long, size long, raw_size long, check long, first long, last long"
_PLACES = f"doc_id long, shard string, in_shard long, n_tokens long, dtype string, pieces array<struct<{', '.join(x.replace(' ', ':', 1) for x in PIECE.split(', '))}>>"


def opened(path: str):
    """A file to seek in, by its path as Spark spells it."""
    if path.startswith("file:"):
        return open("/" + path[5:].lstrip("/"), "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system.open_input_file(inner)


class _Ranges:
    """A file whose slices are read as they are asked for."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self._read = read

    def __getitem__(self, part: slice) -> bytes:
        return self._read(int(part.start), int(part.stop - part.start))


class RangedShard(Shard):
    """A shard read through read(offset, n): its tail at once, frames when asked for."""

    def __init__(self, read: Callable[[int, int], bytes], length: int):
        held_from = max(0, length - TAIL)
        tail = read(held_from, length - held_from)
        if tail[-4:] != SEEK_MAGIC:
            raise ValueError("not a shard: the seek table is missing")
        n, _ = struct.unpack_from("<IB", tail, len(tail) - 9)
        table_at = length - 9 - 12 * n
        tail = tail if table_at >= held_from else read(table_at, length - table_at)
        table = np.frombuffer(tail, "<u4", 3 * n, len(tail) - 9 - 12 * n).reshape(n, 3).astype(np.int64)
        self.sums, self.size, self.raw_size = table[:, 2], table[:, 0], table[:, 1]
        self.at, self.raw_at = np.cumsum(self.size) - self.size, np.cumsum(self.raw_size) - self.raw_size
        index_at = int(self.at[-1])
        self.content = tail[index_at - held_from :] if index_at >= held_from and len(tail) == length - held_from else read(index_at, int(self.size[-1]))
        self._index(0)
        self.content, self._last = _Ranges(read), (-1, b"")

    def pieces(self, row: int) -> list[dict]:
        """The frames of a document, and which of their bytes are its own."""
        a = int(self.starts[row]) * self.dtype.itemsize
        b = a + int(self.counts[row]) * self.dtype.itemsize
        i, out = int(np.searchsorted(self.raw_at[:-1], a, "right")) - 1, []
        while a < b:
            base, n = int(self.raw_at[i]), int(self.raw_size[i])
            out.append({"frame": i, "at": int(self.at[i]), "size": int(self.size[i]), "raw_size": n, "check": int(self.sums[i]), "first": a - base, "last": min(b - base, n)})
            a, i = base + n, i + 1
        return out


def _reader(file) -> Callable[[int, int], bytes]:
    def read(offset: int, n: int) -> bytes:
        file.seek(offset)
        return file.read(n)

    return read


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def places(spark: SparkSession, out: str) -> DataFrame:
    """A row for each document of the shards under out: doc_id, shard (its path), in_shard, n_tokens, dtype, pieces (the frames it lies in)."""
    files = spark.read.format("binaryFile").load(out).where("length > 0").select("path", "length")  # contents are not read
    arrow = _arrow(_PLACES)

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(*(c.to_pylist() for c in batch.columns)):
                with opened(path) as file:
                    s = RangedShard(_reader(file), length)
                for a in range(0, len(s.docs), 5_000):
                    rows = range(a, min(a + 5_000, len(s.docs)))
                    yield pa.RecordBatch.from_pylist([{"doc_id": s.docs[i], "shard": path, "in_shard": i, "n_tokens": int(s.counts[i]), "dtype": s.dtype.str, "pieces": s.pieces(i)} for i in rows], arrow)

    return files.mapInArrow(tails, _PLACES)


def requested(spark: SparkSession, out: str, wanted: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, shard, in_shard, n_tokens, ids (array<int>, the end id included) of the documents whose ids wanted holds."""
    keys = wanted.select(F.col(doc_id).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    found = places(spark, out).join(keys, "doc_id", "left_semi")
    pieces = found.select("doc_id", "shard", "in_shard", "n_tokens", "dtype", F.posexplode("pieces").alias("number", "p")).select("*", "p.*").drop("p")
    pieces = pieces.repartition("shard", "frame").sortWithinPartitions("shard", "frame")
    schema = "doc_id long, shard string, in_shard long, n_tokens long, number int, ids array<int>"
    arrow, names = _arrow(schema), pieces.columns

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        held, path, file, raw = None, None, None, b""
        for batch in batches:
            for a in range(0, len(batch), 64):  # at most 64 frames' ids in a batch
                rows = []
                for values in zip(*(c.to_pylist() for c in batch.slice(a, 64).columns)):
                    r = dict(zip(names, values))
                    if r["shard"] != path:
                        if file is not None:
                            file.close()
                        path, file = r["shard"], opened(r["shard"])
                    if (path, r["frame"]) != held:
                        raw = zstandard.ZstdDecompressor().decompress(_reader(file)(r["at"], r["size"]), max_output_size=r["raw_size"])
                        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != r["check"]:
                            raise ValueError(f"frame {r['frame']} of {path} is damaged")
                        held = (path, r["frame"])
                    ids = np.frombuffer(raw[r["first"] : r["last"]], r["dtype"]).astype(np.int32)
                    rows.append({k: r[k] for k in ("doc_id", "shard", "in_shard", "n_tokens", "number")} | {"ids": ids})
                yield pa.RecordBatch.from_pylist(rows, arrow)
        if file is not None:
            file.close()

    parts = pieces.mapInArrow(cut_out, schema)
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("number", "ids"))), lambda x: x["ids"]))
    return parts.groupBy("doc_id", "shard", "in_shard", "n_tokens").agg(whole.alias("ids"))
