"""Target-distribution importance resampling: documents drawn in proportion to how much more a target corpus uses their word runs.

Features are all runs of up to RUNS consecutive words, hashed to BUCKETS buckets. A bucket's gain is the scaled log ratio of its smoothed
shares of the target's and of the documents' features; a document weighs the sum of its features' gains. With Gumbel noise from a hash of the
doc_id added, the highest scores are a draw without replacement by weight (Gumbel top-k).

Inverted postings. Each task cuts its documents in blocks and writes, for each block and bucket, the postings (document, count) as one row of bytes.
Postings are shuffled by bucket, in which each bucket's gain, from the counts of both corpora, meets its postings; contributions go on by
block, those of a task added up while memory lasts, and are reduced to each document's weight. Counts are added up in the tasks first. A bucket of
very many blocks is split by block (SPLIT), each part with the gain, so that no task holds a whole frequent bucket.

Ranks. Scores are range-partitioned, and a row's rank is its place in its partition behind the rows of those before it, so that no task sorts all of them.

Defined cases: null, empty and wordless texts have no features, weigh 0 and are never drawn; a null doc_id counts as an empty string
in the noise, and goes behind others in ties; repeated rows each count and are each drawn on their own; other columns are ignored; an empty target leaves
gains by the documents' shares alone; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.llm.common import cut, text_slices

RUNS = 3
BUCKETS = 10_000
SHARE = (5, 100)
LEAST_WORDS = 20
SEED = 42

#: Documents and features of a block; a longer document has one of its own.
BLOCK_DOCS, BLOCK_FEATURES = 1 << 14, 4_000_000
#: Blocks of a part of a bucket; bytes of sums that a task holds.
SPLIT, HELD = 4096, 64 << 20

_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))

_ROW = "bucket int, block long, n long, low binary, high binary, times binary"
_DOCS = -1  # the bucket of a block's own row: ids, which of them are null, and numbers of words


def _features_of(words: np.ndarray | int):
    return sum(np.maximum(words - k, 0) for k in range(RUNS))


def _hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each feature's bucket and the number of its text; words of each text."""
    words = [(t or b"").translate(_WORDS).split() for t in texts]
    n = np.fromiter(map(len, words), np.int64, len(words))
    flat = list(chain.from_iterable(words))
    of, left = np.repeat(np.arange(len(words)), n), np.repeat(np.cumsum(n), n) - np.arange(len(flat))
    spaced, crc = [b" " + w for w in flat], list(map(crc32, flat))
    buckets, docs = [], []
    for k in range(RUNS):
        crc = list(map(crc32, spaced[k:], crc)) if k else crc  # a run's checksum goes on from that of the run before its last word
        got = np.fromiter(crc, np.uint32, len(crc))
        inside = left[: len(got)] > k
        buckets.append(got[inside] % np.uint32(BUCKETS))
        docs.append(of[: len(got)][inside])
    return np.concatenate(buckets), np.concatenate(docs), n


def _slices(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    """A binary array of consecutive slices of data, of `sizes` bytes."""
    ends = np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


class _Block:
    """Documents of one task whose postings are written together."""

    def __init__(self):
        self.ids, self.words, self.codes, self.features = [], [], [], 0

    def add(self, ids: pa.Array, texts: list[bytes | None]) -> None:
        bucket, doc, n = _hashed(texts)
        at = sum(map(len, self.ids))
        self.codes.append(bucket << np.uint32(14) | (doc + at).astype(np.uint32))
        self.ids.append(ids)
        self.words.append(n)
        self.features += len(bucket)

    def rows(self, number: int) -> pa.RecordBatch:
        codes = np.sort(np.concatenate(self.codes))
        first = np.flatnonzero(np.diff(codes, prepend=codes[:1] + np.uint32(1)))
        code, times = codes[first], np.diff(first, append=len(codes))
        more = (times + 254) // 255  # a count over 255 takes several postings
        code, rest = np.repeat(code, more), np.repeat(times, more)
        rest -= 255 * (np.arange(len(code)) - np.repeat(np.cumsum(more) - more, more))
        bucket, doc = code >> np.uint32(14), (code & np.uint32(0x3FFF)).astype(np.int64)
        start = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint32(1)))
        step = np.diff(doc, prepend=0)
        step[start] = doc[start]
        sizes = np.diff(start, append=len(bucket))
        total = np.add.reduceat(np.minimum(rest, 255), start) if len(start) else start
        ids = pa.concat_arrays(self.ids)
        own = [ids.fill_null(0).to_numpy().astype("<i8"), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), np.concatenate(self.words).astype("<i8")]
        postings = [step & 255, step >> 8, np.minimum(rest, 255)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(bucket[start].astype(np.int32), np.int32(_DOCS))),
                pa.array(np.full(len(start) + 1, number)),
                pa.array(np.append(total, len(ids))),
                *[pa.concat_arrays([_slices(sizes, x.astype(np.uint8)), pa.array([y.tobytes()], pa.binary())]) for x, y in zip(postings, own)],
            ],
            ["bucket", "block", "n", "low", "high", "times"],
        )


def postings(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of each block: one for each bucket (n features; steps between its documents in low and high bytes; counts), and one of its documents."""

    def scan(batches):
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for a, b in text_slices(texts):
                for i in range(a, b, 1024):
                    j = min(b, i + 1024)
                    block.add(batch.column(0).slice(i, j - i), texts.slice(i, j - i).to_pylist())
                    if block.features >= BLOCK_FEATURES or sum(map(len, block.ids)) > BLOCK_DOCS - 1024:
                        yield block.rows(number)
                        number, block = number + 1, _Block()
        if block.ids:
            yield block.rows(number)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(scan, _ROW)


def _counts(blocks: DataFrame) -> DataFrame:
    """bucket, n: the features of each bucket, at most BUCKETS rows."""
    return cut(blocks.where(F.col("bucket") >= 0).groupBy("bucket").agg(F.sum("n").alias("n")), "resample-counts")


def gains(of_docs: DataFrame, of_target: DataFrame) -> DataFrame:
    """bucket, gain from the counts (bucket, n) of both corpora."""
    s, t = (x.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for x in (of_docs, of_target))
    both = of_docs.withColumnRenamed("n", "s").join(of_target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["t"])
    ratio = f"((t + 1D) * {float(s + BUCKETS)!r}D) / ((s + 1D) * {float(t + BUCKETS)!r}D)"
    return both.select("bucket", F.expr(f"floor(1000D * ln({ratio}))").alias("gain"))


def _contributions(rows: DataFrame) -> DataFrame:
    """block, low, high, times: sums of gains (times, 8 bytes each) of documents (steps in low and high bytes), from buckets whose gain comes first."""

    def flush(sums: dict):
        parts = []
        for block, v in sums.items():
            doc = np.flatnonzero(v)
            step = np.diff(doc, prepend=0)
            parts.append((block, (step & 255).astype(np.uint8).tobytes(), (step >> 8).astype(np.uint8).tobytes(), v[doc].tobytes()))
        for i in range(0, len(parts), 64):
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*parts[i : i + 64]), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["block", "low", "high", "times"])

    def scan(batches):
        sums, gain, of = {}, 0, None
        for batch in batches:
            for bucket, block, n, low, high, times in zip(*[c.to_pylist() for c in batch.columns[:6]]):
                if low is None:
                    gain, of = n, bucket
                    continue
                assert bucket == of, "a bucket's gain comes before its postings"
                if block not in sums:
                    if len(sums) * BLOCK_DOCS * 8 >= HELD:
                        yield from flush(sums)
                        sums = {}
                    sums[block] = np.zeros(BLOCK_DOCS, np.int64)
                doc = np.cumsum(np.frombuffer(low, np.uint8).astype(np.int64) + (np.frombuffer(high, np.uint8).astype(np.int64) << 8))
                worth = np.frombuffer(times, np.uint8).astype(np.int64) * gain
                if len(doc) and (np.diff(doc) == 0).any():
                    np.add.at(sums[block], doc, worth)
                else:
                    sums[block][doc] += worth
        yield from flush(sums)

    return rows.mapInArrow(scan, "block long, low binary, high binary, times binary")


def weights(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight for each document."""
    blocks = cut(postings(docs, doc_id=doc_id, text=text), "resample-blocks")
    of_target = _counts(postings(target.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"))))
    gain = gains(_counts(blocks), of_target)
    parts = blocks.where(F.col("bucket") == _DOCS).count() // SPLIT + 1
    empty = F.lit(None).cast("binary")
    gain = gain.select("bucket", F.lit(0).cast("long").alias("block"), F.col("gain").alias("n"), empty.alias("low"), empty.alias("high"), empty.alias("times"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    met = blocks.where(F.col("bucket") >= 0).withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")).unionByName(gain)
    met = met.repartition("bucket", "part").sortWithinPartitions("bucket", "part", F.col("low").isNotNull())
    given = _contributions(met)
    own = blocks.where(F.col("bucket") == _DOCS).select("block", "low", "high", "times", F.lit(0).alias("turn"))

    def total(batches):
        state = None  # of the block at hand: ids, words, weights

        def rows():
            ids, words, sums = state[1:]
            n = _features_of(words)
            return pa.RecordBatch.from_arrays([ids, pa.array(words), pa.array(n), pa.array(sums)], ["doc_id", "n_words", "n_features", "weight"])

        for batch in batches:
            for block, low, high, times, turn in zip(*[c.to_pylist() for c in batch.columns]):
                if not turn:
                    if state:
                        yield rows()
                    words = np.frombuffer(times, "<i8")
                    ids = pa.array(np.frombuffer(low, "<i8"), mask=np.frombuffer(high, np.uint8).astype(bool))
                    state = (block, ids, words, np.zeros(len(words), np.int64))
                else:
                    doc = np.cumsum(np.frombuffer(low, np.uint8).astype(np.int64) + (np.frombuffer(high, np.uint8).astype(np.int64) << 8))
                    state[3][doc] += np.frombuffer(times, np.int64)
        if state:
            yield rows()

    both = own.unionByName(given.withColumn("turn", F.lit(1))).repartition("block").sortWithinPartitions("block", "turn")
    return both.mapInArrow(total, "doc_id long, n_words long, n_features long, weight long")


def ranks(rows: DataFrame, k: int, order: list) -> DataFrame:
    """rows with rank (from 1) of the first k in `order`, null for the others."""
    dealt = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt = cut(dealt, "resample-dealt")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each partition
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    before = cut(sizes.select("_part", before.alias("_before")), "resample-before")
    some = dealt.join(before, "_part")
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order)) + F.col("_before")
    first = some.where(F.col("_before") < k).withColumn("rank", place.cast("long"))  # partitions behind the first k aren't sorted
    first = first.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return first.unionByName(some.where(F.col("_before") >= k).withColumn("rank", F.lit(None).cast("long"))).drop("_part", "_before")


def resample(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank for each document; rank is null for those that aren't drawn.

    Of the documents with least_words words or more, the share with the highest scores is drawn.
    """
    found = weights(docs, target, doc_id=doc_id, text=text)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = cut(found.withColumn("score", F.col("weight") + noise), "resample-scored")
    long_enough = scored.where(F.col("n_words") >= least_words)
    k = share[0] * long_enough.count() // share[1]
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")]
    drawn = ranks(long_enough, k, order)
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
