"""Near-duplicate classes by SimHash fingerprints: deletion-variant signatures, equality join, verification, components.

Fingerprint. Bit b is 1 if over half of a text's shingles, repeats included, have bit b in their 64-bit hash (XXH64, seed 42).

Links. Fingerprints link if at most `reach` bits differ. The 64 bits are cut into reach // 2 + 1 segments, so that of two linked
fingerprints one segment differs by one bit at most. Each distinct fingerprint emits 64 keys, one for each bit: the bit's
segment without that bit. Two segments that differ in one bit share the key of that bit; equal ones share all. Fingerprints
meet by equal keys, and what is linked there is verified on all 64 bits; a pair is emitted under the first key that it shares.

Hot keys. A bucket of more than PAIRS members emits a forest that spans its linked members instead of pairs. One of more than
BUCKET members is cut again: what is left of the bits beside its segment still differs by `reach` at most, so the same cut
applies to them, and members meet by both keys. A bucket that is too large even so is dealt out in chunks, and each two chunks
meet in a task of their own. Nothing is capped; a task holds BUCKET fingerprints of a bucket at most.

Defined cases: a text without words, or null, has fingerprint zero and is linked like any other; one of fewer words than a shingle is one
shingle; repeated rows share a fingerprint; component_id is the smallest doc_id that links reach, null only if all those are;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import cut, drop_cut, text_slices
from utterlake.llm.near import merge_labels

REACH = 4
WORDS = 4
SEED = 42
PAIRS = 32
BUCKET = 16_384
#: Shingles that are hashed and added up at a time.
CHUNK = 1 << 16


def segments(width: int, reach: int) -> list[tuple[int, int]]:
    """(first bit, bit behind the last) of each segment of `width` bits: so many that one differs by one bit at most."""
    n = max(2, reach // 2 + 1)
    ends = [width * i // n for i in range(n + 1)]
    return list(zip(ends, ends[1:]))


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a text in UTF-8."""
    from xxhash import xxh64_intdigest

    found = (text or b"").lower().split()  # of bytes: A-Z alone, and the white space that parts words
    if not found:
        return 0
    flat = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    n = max(1, len(found) - words + 1)
    starts, ends = [0, *(ends[: n - 1] + 1).tolist()], ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        parts = map(flat.__getitem__, map(slice, starts[i : i + CHUNK], ends[i : i + CHUNK]))
        h = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), "<u8", min(CHUNK, n - i))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, fp: the fingerprint of each document as a long."""

    def scan(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                part = batch.slice(a, b - a)
                fps = np.array([fingerprint(t, words) for t in part.column(1).cast(pa.binary()).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(scan, "doc_id long, fp long")


def _keys(of: str, width: int, reach: int) -> str:
    """SQL of an array of the keys of bits: for each bit its number in the top six bits, and its segment without it."""
    made = []
    for low, high in segments(width, reach):
        part = f"(shiftrightunsigned({of}, {low}) & {(1 << (high - low)) - 1}L)"
        made.append(f"transform(sequence({low}, {high - 1}), j -> shiftleft(CAST(j AS LONG), 58) | ({part} & ~shiftleft(1L, j - {low})))")
    return f"concat({', '.join(made)})"


def _first_bit(x: np.ndarray, reach: int) -> np.ndarray:
    """The bit of the first key that two fingerprints share, from the bits in which they differ."""
    out = np.full(len(x), -1, np.int64)
    for low, high in reversed(segments(64, reach)):
        part = (x >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
        bit = np.bitwise_count(part - (part > 0).astype(np.uint64)).astype(np.int64)  # of a single bit: its number
        out = np.where(np.bitwise_count(part) <= 1, low + bit, out)
    return out


def forest(fps: np.ndarray, reach: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that span the components of distinct fingerprints."""
    left, found = fps, []
    while len(left):
        open_, left = [left[:1]], left[1:]
        while open_ and len(left):
            some = open_.pop()
            for one in some:
                near = np.bitwise_count(left ^ one) <= reach
                if near.any():
                    got, left = left[near], left[~near]
                    found.append((np.full(len(got), one), got))
                    open_.append(got)
    return found


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.uint64) for i in (0, 1))
    a, b = a.view(np.int64), b.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _bucket_links(rows: DataFrame, reach: int, pairs: int) -> DataFrame:
    """Links (a, b) within buckets of rows (key, fp), each of which fits a task. Buckets of up to `pairs` members give each pair under its first key."""

    def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(first, len(key)))
        found = []
        few = np.repeat((sizes > 1) & (sizes <= pairs), sizes)
        k, f = key[few], fp[few]
        for d in range(1, int(sizes[sizes <= pairs].max(initial=1))):
            i = np.flatnonzero(k[d:] == k[:-d])
            x = f[i] ^ f[i + d]
            near = np.bitwise_count(x) <= reach
            i, x = i[near], x[near]
            own = _first_bit(x, reach) == (k[i].view(np.uint64) >> np.uint64(58)).astype(np.int64)
            found.append((f[i[own]], f[i[own] + d]))
        for s, n in zip(first[sizes > pairs].tolist(), sizes[sizes > pairs].tolist()):
            found += forest(fp[s : s + n], reach)
        return _edges(found)

    def scan(batches):
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last bucket may go on
            if last:
                yield links(key[:last], fp[:last])
                key, fp = key[last:], fp[last:]
        if len(key):
            yield links(key, fp)

    return rows.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(scan, "a long, b long")


def _hot(rows: DataFrame, bucket: int) -> DataFrame:
    """key, n of buckets with more than `bucket` rows, added up in the tasks first."""
    return cut(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket), "simhash-hot")


def links(classes: DataFrame, reach: int = REACH, bucket: int = BUCKET, pairs: int = PAIRS) -> DataFrame:
    """Links (a, b) that join distinct fingerprints (fp) to their components."""
    rows = classes.select("fp", F.explode(F.expr(_keys("fp", 64, reach))).alias("key"))
    hot = _hot(rows, bucket)
    if not hot.take(1):
        return _bucket_links(rows, reach, pairs)
    out = [_bucket_links(rows.join(hot, "key", "left_anti"), reach, pairs)]
    again = rows.join(hot.select("key"), "key")
    for low, high in segments(64, reach):
        rest = again.where(f"shiftrightunsigned(key, 58) BETWEEN {low} AND {high - 1}")
        rest = rest.withColumn("rest", F.expr(f"(fp & {(1 << low) - 1}L) | " + (f"shiftleft(shiftrightunsigned(fp, {high}), {low})" if high < 64 else "0L")))
        rest = rest.select("fp", "key", F.explode(F.expr(_keys("rest", 64 - (high - low), reach))).alias("more"))
        rest = rest.select("fp", F.xxhash64("key", "more").alias("key"))  # equal hashes of unlike keys only join buckets
        large = _hot(rest, bucket)
        if not large.take(1):
            out.append(_bucket_links(rest, reach, 1))
            continue
        out.append(_bucket_links(rest.join(large, "key", "left_anti"), reach, 1))
        last = F.floor((F.col("n") - 1) / (bucket // 2))
        chunks = rest.join(large, "key").withColumn("last", last).withColumn("c", F.pmod(F.xxhash64(F.lit(3), "fp"), F.col("last") + 1))
        chunks = chunks.withColumn("d", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        out.append(_bucket_links(chunks.select("fp", F.xxhash64("key", F.least("c", "d"), F.greatest("c", "d")).alias("key")), reach, 1))
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole


def near_fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, reach: int = REACH, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each document."""
    signed = cut(fingerprints(docs, doc_id=doc_id, text=text, words=words), "simhash-signed")
    classes = cut(signed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    edges = cut(links(classes, reach, bucket).distinct(), "simhash-edges")
    labels = merge_labels(classes.select(F.col("fp").alias("key"), F.col("fp").alias("comp")), edges)
    named = classes.join(labels, classes["fp"] == labels["key"]).select("fp", "comp", "first_id")
    least = cut(named.groupBy("comp").agg(F.min("first_id").alias("component_id")), "simhash-least")
    of_fp = cut(named.join(least, "comp").select("fp", "component_id"), "simhash-named")
    drop_cut(edges)
    return signed.join(of_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
