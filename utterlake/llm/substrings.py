"""Exact substring removal: bytes covered by a string of `length` bytes that also starts anywhere else.

How repeats meet. Every window of `length` bytes has an anchor, its 16-byte gram of least hash (the first such). Equal windows
have equal anchors at the same offset, so they meet under their anchor's hash. A span is all windows of one anchor, laid
over each other: some 1.5 windows' bytes for half a window's worth of starts.
  1. Spans whose anchor is found once are dropped, and copies of a text are added up.
  2. Spans are counted by hash of their bytes, their kind. A kind found twice repeats in full.
  3. Where an anchor has several kinds, one text of each is sent for. The spans of an anchor with up to HOT kinds meet in one
     task, some 0.4 MB at most. They are cut into blocks of 32 bytes counted from the anchor, the distinct blocks are ranked, and
     all suffixes of the resulting strings are sorted by linear grouping (suffix.py). Neighbours that agree on 11 blocks form
     classes, and windows are equal if their first whole block has the same class and the bytes to both sides are equal.
  4. An anchor with more kinds (a passage that very many documents hold in different surroundings) is never gathered. Its spans
     are cut into parts of STEP offsets, and a part has two digests: of all its bytes, and of its core, the bytes that all its
     windows share. Parts of equal bytes are added up and repeat in full; a part whose core no other part has holds no
     repeated window; of the few that remain (at a passage's ends) each window is counted by its own digest.
  5. Found runs go back to all documents that hold the kind and are merged; what is left is hashed.

Counts are added up in the tasks before anything is shuffled, and what is joined by a key that many rows may share is joined between
written tables, whose hot partitions Spark splits (adaptive skew joins).

Windows are judged on the input, overlaps count, and a match never crosses documents. Kinds are compared by two 64-bit hashes
(anchor and span), parts and windows of hot anchors by 128-bit digests, windows of the others byte by byte.

Defined cases: a null text is empty; texts shorter than length keep all their bytes; documents with the same doc_id are
each judged by themselves; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import _BYTE, cut, drop_cut, mix64, text_slices
from utterlake.llm.suffix import suffix_array

LENGTH, GRAM = 400, 16
BLOCK, WHOLE = 32, 11
#: Kinds of an anchor beyond which its spans are not gathered, and the offsets of a part of such a span.
HOT, STEP = 500, 32
#: Bytes of spans that a task sorts at a time; an anchor's spans stay together.
BATCH = 1 << 20
#: Bytes of a text that are hashed at a time; pieces overlap, so that windows don't depend on it.
PIECE = 1 << 22

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's base and of its inverse."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_B, _B_INV)):
            p = np.full(1 << int(n - 1).bit_length(), b, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


class Rolling:
    """Hashes of any substrings of an array of bytes."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _power(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:-1], out=self.sums[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of bytes a to b; equal bytes, equal hashes."""
        return mix64((self.sums[b] - self.sums[a]) * self.inverse[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def spans(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """anchor, lo, hi, anchor hash, span hash: a row for each anchor of a text; windows start hi to lo bytes before it."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    roll = Rolling(data)
    at = np.arange(len(data) - gram + 1)
    h = roll(at, at + gram)
    bits = np.uint64(max(1, int(PIECE + length).bit_length()))
    packed = (h >> bits << bits) | at.astype(np.uint64)
    anchor = (_least(packed, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(first[1:], n) - 1
    p = anchor[first]
    hi, lo = p - first, p - last
    own = roll(first, last + length)
    return p, lo, hi, h[p], mix64(own + hi.astype(np.uint64) * np.uint64(1009) + lo.astype(np.uint64))


def text_spans(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """spans() of a text of any size, piece by piece."""
    if len(data) <= PIECE:
        return spans(data, length, gram)
    parts = []
    for a in range(0, len(data) - length + 1, PIECE - length + 1):  # each window in one piece
        p, *rest = spans(data[a : a + PIECE], length, gram)
        parts.append((p + a, *rest))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _bytes(value: str | None) -> np.ndarray:
    return np.frombuffer((value or "").encode("utf-8", "surrogatepass"), np.uint8)


def _beside(data: np.ndarray, start: np.ndarray, block: np.ndarray, length: int) -> np.ndarray:
    """The bytes of each window that lie outside of its WHOLE blocks: a row each, those before the first block first."""
    n = length - WHOLE * BLOCK
    at = np.arange(n)[None, :] + start[:, None]
    return data[np.where(at < block[:, None], at, at + WHOLE * BLOCK)]


def repeated_offsets(blobs: list[bytes], lo: np.ndarray, hi: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each span (its bytes, and the least and largest offset of its windows) the runs of offsets whose windows other spans hold too."""
    lens = np.array([len(b) for b in blobs], np.int64)
    left = -hi % BLOCK  # padding, so that blocks are counted from the anchor
    n_blocks = -(-(left + lens) // BLOCK)
    base = np.cumsum(n_blocks) - n_blocks
    data = np.zeros(int(n_blocks.sum()) * BLOCK, np.uint8)
    for blob, b, pad in zip(blobs, base.tolist(), left.tolist()):
        data[b * BLOCK + pad : b * BLOCK + pad + len(blob)] = np.frombuffer(blob, np.uint8)
    blocks = data.view(np.dtype((np.void, BLOCK)))
    _, rank = np.unique(blocks, return_inverse=True)
    # strings one behind the other, each ended by 0
    place = np.arange(len(rank)) + np.repeat(np.arange(len(blobs)), n_blocks)
    text = np.zeros(len(rank) + len(blobs), np.int64)
    text[place] = rank.reshape(-1) + 1
    order = suffix_array(text)
    order = order[order <= len(text) - WHOLE]
    runs = np.lib.stride_tricks.sliding_window_view(text, WHOLE)
    new = np.ones(len(order), np.int64)
    for i in range(1, len(order), 100_000):
        s = slice(i, i + 100_000)
        new[s] = (runs[order[s]] != runs[order[i - 1 : i - 1 + len(order[s])]]).any(axis=1)
    group = np.zeros(len(text), np.int64)
    group[order] = np.cumsum(new)

    count = hi - lo + 1
    owner = np.repeat(np.arange(len(blobs)), count)
    offset = np.repeat(hi, count) - (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
    start = (base * BLOCK + left + hi)[owner] - offset  # of the window, in data
    block = -(-start // BLOCK)
    roll = Rolling(data)
    head = roll(start, block * BLOCK)
    tail = roll(block * BLOCK + WHOLE * BLOCK, start + length)
    key = mix64(head + mix64(tail + mix64(group[block + owner].astype(np.uint64) * np.uint64(BLOCK) + (block * BLOCK - start).astype(np.uint64))))
    beside = lambda at: _beside(data, start[at], block[at] * BLOCK, length)
    codes, _ = pd.factorize(key)
    again = np.bincount(codes)[codes] > 1
    hit = np.flatnonzero(again)
    if len(hit):
        first = np.empty(codes.max() + 1, np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        first = first[codes[hit]]
        alike = (group[(block + owner)[hit]] == group[(block + owner)[first]]) & ((block * BLOCK - start)[hit] == (block * BLOCK - start)[first])
        for i in range(0, len(hit), 100_000):
            c = slice(i, i + 100_000)
            alike[c] &= (beside(hit[c]) == beside(first[c])).all(axis=1)
        if not alike.all():  # different windows with one hash: counted by what they hold
            exact = [(int(group[block[i] + owner[i]]), int(block[i] * BLOCK - start[i]), beside(np.array([i])).tobytes()) for i in range(len(start))]
            number: dict = {}
            codes = np.array([number.setdefault(x, len(number)) for x in exact], np.int64)
            again = np.bincount(codes)[codes] > 1
    edge = again & np.append(True, (owner[1:] != owner[:-1]) | ~again[:-1])
    close = again & np.append((owner[1:] != owner[:-1]) | ~again[1:], True)
    out: list[list[tuple[int, int]]] = [[] for _ in blobs]
    for o, top, bottom in zip(owner[edge].tolist(), offset[edge].tolist(), offset[close].tolist()):
        out[o].append((bottom, top))
    return out


def _positions(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """doc, t1, t2 (hashes of the text), p, lo, hi, fp, sh: a row for each anchor."""

    def scan(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(3)):
                part = batch.slice(a, b - a)
                found = [text_spans(_bytes(t), length, gram) for t in part.column(3).to_pylist()]
                row = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                p, lo, hi, fp, sh = (np.concatenate(x) for x in zip(*found))
                head = [part.column(i).take(row) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*head, pa.array(p), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(fp.view(np.int64)), pa.array(sh.view(np.int64))], ["doc", "t1", "t2", "p", "lo", "hi", "fp", "sh"])

    long_enough = docs.where(F.octet_length("text") >= length).select("doc", "t1", "t2", "text")
    return long_enough.mapInArrow(scan, "doc long, t1 long, t2 long, p long, lo int, hi int, fp long, sh long")


def _packed(docs: DataFrame) -> DataFrame:
    """docs (doc, t1, t2, text) with the text as a zstandard frame, which takes less room on its way to its spans."""
    import zstandard

    def scan(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for a, b in text_slices(batch.column(3)):
                part = batch.slice(a, b - a)
                z = [press.compress(_bytes(t).tobytes()) for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(z, pa.binary())], ["doc", "t1", "t2", "z"])

    return docs.select("doc", "t1", "t2", "text").mapInArrow(scan, "doc long, t1 long, t2 long, z binary")


def _unpack(z: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z)


def _asked(batches, rows_of, types: list, names: list[str], size: int = BATCH):
    """rows_of(text's bytes, span asked for) as batches of about `size` bytes in the last column."""
    out: list[tuple] = []
    n = 0
    for batch in batches:
        for text, asked in zip(batch.column(0), batch.column(1).to_pylist()):
            raw = _unpack(text.as_py())
            for x in asked:
                for row in rows_of(raw, x):
                    out.append(row)
                    n += len(row[-1])
                if n > size:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out, n = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


_SPAN = {"fp": pa.int64(), "sh": pa.int64(), "lo": pa.int32(), "hi": pa.int32(), "settled": pa.bool_()}


def _spans_of(batches, length: int):
    """Rows fp, sh, lo, hi, settled, bytes: the spans that a text is asked for."""

    def rows_of(raw, x):
        yield x["fp"], x["sh"], x["lo"], x["hi"], x["n"] > 1, raw[x["p"] - x["hi"] : x["p"] - x["lo"] + length]

    return _asked(batches, rows_of, [*_SPAN.values(), pa.binary()], [*_SPAN, "bytes"])


def _digest(fp: int, d: int, width: int, data: bytes) -> bytes:
    """128 bits of what windows at offsets d to d + width - 1 before the anchor hold."""
    return hashlib.blake2b(data, digest_size=16, key=struct.pack("<qii", fp, d, width)).digest()


def _hot_parts(batches, length: int):
    """Rows fp, sh, lo, hi, settled, core, whole, bytes: hot spans in parts of STEP offsets."""

    def rows_of(raw, x):
        p, lo, hi, fp = x["p"], x["lo"], x["hi"], x["fp"]
        for d in range(lo // STEP * STEP, hi + 1, STEP):
            a, b = max(lo, d), min(hi, d + STEP - 1)
            blob = raw[p - b : p - a + length]
            core = _digest(fp, d, 0, raw[p - d : p - d - STEP + 1 + length])  # the same, whatever the part's own ends
            yield fp, x["sh"], a, b, x["n"] > 1, core, _digest(fp, a, b - a + 1, blob), blob

    return _asked(batches, rows_of, [*_SPAN.values(), *[pa.binary()] * 3], [*_SPAN, "core", "whole", "bytes"])


def _hot_windows(batches, length: int):
    """Rows fp, sh, at, settled, window: each window of the parts, by digest."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    for batch in batches:
        for i in range(0, len(batch), 2000):
            rows = []
            for fp, sh, lo, hi, settled, blob in zip(*(c.to_pylist() for c in batch.slice(i, 2000).columns)):
                rows += [(fp, sh, d, settled, _digest(fp, d, 1, blob[hi - d : hi - d + length])) for d in range(lo, hi + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["fp", "sh", "at", "settled", "window"])


def _find(batches, length: int):
    """Rows fp, sh, lo, hi (runs of offsets that repeat) from spans sorted by anchor, of which none has more than HOT."""
    held: list[tuple] = []
    size = 0

    def flush(rows: list):
        codes, _ = pd.factorize(np.array([r[0] for r in rows]))
        several = np.bincount(codes)[codes] > 1
        rows = [r for r, s in zip(rows, several.tolist()) if s]
        if not rows:
            return None
        runs = repeated_offsets([r[5] for r in rows], np.array([r[2] for r in rows], np.int64), np.array([r[3] for r in rows], np.int64), length)
        got = [(r[0], r[1], a, b) for r, x in zip(rows, runs) if not r[4] for a, b in x]
        if got:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["fp", "sh", "lo", "hi"])
        return None

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for r in zip(*columns):
            if size > BATCH and r[0] != held[-1][0]:
                if (out := flush(held)) is not None:
                    yield out
                held, size = [], 0
            held.append(r)
            size += len(r[5])
    if held and (out := flush(held)) is not None:
        yield out


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """t1, t2, runs (array of struct<a, b>, byte ranges that repeated windows cover, unmerged) for each text with any.

    docs: doc, t1, t2, text, where t1 and t2 are hashes of text.
    """
    found = cut(_positions(docs, length, gram), "substr-spans")
    twice = cut(found.groupBy("fp").count().where("count > 1").select("fp"), "substr-anchors")
    # a place in a text and the first window there (a text's pieces may share an anchor) determine the rest; grouping by them alone
    # leaves the join free to split a hot anchor
    same = [F.first(c).alias(c) for c in ("lo", "fp", "sh")]
    kept = cut(found.join(twice, "fp").groupBy("t1", "t2", "p", "hi").agg(*same, F.count("*").alias("n"), F.min("doc").alias("doc")), "substr-kept")
    drop_cut(found)
    all_kinds = cut(kept.groupBy("fp", "sh").agg(F.sum("n").alias("n"), F.min(F.struct("doc", "t1", "t2", "p", "lo", "hi")).alias("one")), "substr-kinds")
    per_anchor = cut(all_kinds.groupBy("fp").agg(F.count("*").alias("kinds"), F.sum("n").alias("rows")).where("rows > 1").drop("rows"), "substr-anchors")
    kinds = cut(all_kinds.join(per_anchor, "fp"), "substr-kinds")
    drop_cut(all_kinds)
    hot = F.col("kinds") > HOT
    asked = kinds.where("kinds > 1").select("one.doc", "one.t1", "one.t2", hot.alias("hot"), F.struct("one.p", "one.lo", "one.hi", "fp", "sh", "n").alias("x"))
    asked = asked.groupBy("doc", "t1", "t2").agg(*[F.collect_list(F.when(c, F.col("x"))).alias(name) for name, c in (("cold", ~F.col("hot")), ("hot", F.col("hot")))])  # at most a text's own spans
    own = _packed(docs.where(F.octet_length("text") >= length)).withColumn("doc", F.coalesce("doc", F.lit(0).cast("long")))
    asked = asked.withColumn("doc", F.coalesce("doc", F.lit(0).cast("long")))
    texts = cut(own.join(asked, ["doc", "t1", "t2"]).select("z", "cold", "hot"), "substr-texts")
    spans_of = texts.where(F.size("cold") > 0).select("z", "cold").mapInArrow(lambda it: _spans_of(it, length), "fp long, sh long, lo int, hi int, settled boolean, bytes binary")
    found_in = spans_of.repartition("fp").sortWithinPartitions("fp").mapInArrow(lambda it: _find(it, length), "fp long, sh long, lo int, hi int")
    some = kinds.where("n > 1").select("fp", "sh", "one.lo", "one.hi").unionByName(found_in)
    of_hot = texts.where(F.size("hot") > 0).select("z", "hot")
    if of_hot.take(1):
        some = some.unionByName(_hot_repeats(of_hot, length))
    runs = cut(some, "substr-runs")
    for done in (twice, per_anchor, kinds, texts):
        drop_cut(done)
    at = kept.select("t1", "t2", "p", "fp", "sh").join(runs, ["fp", "sh"])
    covered = F.struct((F.col("p") - F.col("hi")).alias("a"), (F.col("p") - F.col("lo") + length).alias("b"))
    return at.groupBy("t1", "t2").agg(F.collect_list(covered).alias("runs"))


def _hot_repeats(texts: DataFrame, length: int) -> DataFrame:
    """fp, sh, lo, hi: the runs of offsets that repeat, of spans of hot anchors, by counts alone."""
    parts = cut(texts.mapInArrow(lambda it: _hot_parts(it, length), "fp long, sh long, lo int, hi int, settled boolean, core binary, whole binary, bytes binary"), "substr-parts")
    alike = cut(parts.groupBy("whole").count().where("count > 1").select("whole"), "substr-alike")
    full = parts.where("NOT settled").select("fp", "sh", "lo", "hi", "whole").join(alike, "whole").drop("whole")
    # one part for each content; it stands for several if it came up several times or is settled
    few = parts.groupBy("core", "whole").agg(*[F.first(c).alias(c) for c in ("fp", "sh", "lo", "hi", "bytes")], (F.max("settled") | (F.count("*") > 1)).alias("settled"))
    few = cut(few, "substr-parts")
    met = cut(few.groupBy("core").agg(F.count("*").alias("n"), F.min("settled").alias("done")).where("n > 1 AND NOT done").select("core"), "substr-cores")
    open_ = few.join(met, "core").select("fp", "sh", "lo", "hi", "settled", "bytes")
    windows = cut(open_.mapInArrow(lambda it: _hot_windows(it, length), "fp long, sh long, at int, settled boolean, window binary"), "substr-windows")
    again = cut(windows.groupBy("window").count().where("count > 1").select("window"), "substr-again")
    single = windows.where("NOT settled").join(again, "window").select("fp", "sh", F.col("at").alias("lo"), F.col("at").alias("hi"))
    return full.unionByName(single)


def _merged(runs: list | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in runs or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _prepared(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    own = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return own.select("doc", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2"), "text")


def _with_runs(docs: DataFrame, doc_id: str, text: str, length: int, gram: int) -> DataFrame:
    own = _prepared(docs, doc_id, text)
    found = cut(repeats(own, length, gram), "substr-found")
    return _packed(own).join(found, ["t1", "t2"], "left").select("doc", "z", "runs")


def removal(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each document."""
    if length < (WHOLE + 2) * BLOCK - 16 or length - gram < 1:
        raise ValueError(f"length must be at least {(WHOLE + 2) * BLOCK - 16}")

    def scan(batches):
        for batch in batches:
            rows = []
            for t, runs in zip(batch.column(1), batch.column(2)):
                raw = _unpack(t.as_py())
                gone = _merged(runs.as_py())
                digest, at = hashlib.sha256(), 0
                for a, b in gone:
                    digest.update(raw[at:a])
                    at = b
                digest.update(raw[at:])
                rows.append((len(raw), sum(b - a for a, b in gone), len(gone), digest.hexdigest()))
            n, removed, n_spans, sha = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_runs(docs, doc_id, text, length, gram).mapInArrow(scan, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remaining(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id and the bytes that are left of each text (removal may cut within a character)."""

    def scan(batches):
        for batch in batches:
            kept = []
            for t, runs in zip(batch.column(1), batch.column(2)):
                raw, at, out = _unpack(t.as_py()), 0, []
                for a, b in _merged(runs.as_py()):
                    out.append(raw[at:a])
                    at = b
                kept.append(b"".join([*out, raw[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], ["doc_id", "kept"])

    return _with_runs(docs, doc_id, text, length, gram).mapInArrow(scan, "doc_id long, kept binary")
