"""Token-ID output: independent zstandard frames, a document index, and a trailing seek table with per-frame checksums.

A shard is one file in the public seekable zstandard layout:

    data frame | padding | data frame | padding | ... | document index | seek table

* Data frames are independent zstandard frames (with content checksums) of FRAME_IDS token ids, little-endian unsigned.
* Document index and padding are skippable frames, so that any zstandard decoder reads a shard as the plain id stream.
* The seek table holds, for each frame, compressed size, decompressed size, and the low 32 bits of the xxh64 of its
  content. It ends in the 4 magic bytes of that layout.

Spark's text writer puts its line separator behind each row. The separator is set to those 4 magic bytes: they close
the seek table, and elsewhere they are the payload of a padding frame. So shards are written frame by frame through
Spark's committer, to any store, and a lost executor only repeats its own shards. Behind SHARD_ROWS - 1
frames a shard takes in the slice of documents at hand and ends, and the task's next shard begins, so a shard's size is bounded
by that, a slice and one document.

Defined cases: strings of added tokens inside a text are ordinary text, or with as_text=False, the library's default, their ids;
a null or empty text is the end id alone; rows with equal doc_id follow each other by hash of their text; a null
doc_id comes first; an empty table gives no documents; columns other than the two named are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.llm.common import cut, hash_spans, joined_bytes, remove, shared_dir, text_slices

SEEK_MAGIC = struct.pack("<I", 0x8F92EAB1)
SEEK_FRAME, INDEX_FRAME, PAD_FRAME = 0x184D2A5E, 0x184D2A5D, 0x184D2A50
PAD = struct.pack("<II", PAD_FRAME, len(SEEK_MAGIC))
FRAME_IDS = 1 << 16
#: Rows of the writer that make a shard: a frame each, the last with the index (some 0.4 GB).
SHARD_ROWS = 4096
#: Units that a worker remembers; beyond, it starts afresh. Changes speed, never ids.
CACHE_UNITS = 500_000
#: Bytes of text that are encoded at a time (or one longer text); a shard ends behind such a slice.
SLICE = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]] = True
_WIDE_SPACE = np.zeros(256, bool)
_WIDE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def unit_starts(buf: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Where texts may be cut so that each piece has the ids it has inside the whole text.

    The vocabulary's pattern never lets a piece of text cross the start of a space or a lone line feed behind a
    non-space, the end of such a line feed, or a step from an ASCII letter to ASCII punctuation other than an
    apostrophe. Places next to what may be a wider Unicode space are left uncut.
    """
    n = len(buf)
    cut_at = np.zeros(n + 1, bool)
    space = _SPACE[buf]
    after = ~space
    wide = _WIDE_SPACE[buf]
    after[1:] &= ~wide[:-1]  # the second byte of a two-byte space
    after[2:] &= ~(wide[:-2] & (buf[:-2] != 0xC2))  # the third byte of a three-byte space
    cut_at[1:n] = after[:-1] & (buf[1:] == 0x20)
    lone = np.zeros(n, bool)
    lone[1:-1] = after[:-2] & (buf[1:-1] == 0x0A) & ~space[2:] & ~wide[2:]
    cut_at[:n] |= lone
    cut_at[1:] |= lone
    cut_at[1:n] |= _LETTER[buf[:-1]] & _PUNCT[buf[1:]]
    cut_at[docs] = True
    cut_at[docs[1:] - 1] = True  # the end marks
    cut_at[n - 1] = True
    return np.flatnonzero(cut_at[:n])


def _splits(path: str) -> bool:
    """Whether a tokenizers file cuts texts by the pattern that unit_starts() knows: bytes of the plain text, no normalizer."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    pre, model = said.get("pre_tokenizer") or {}, said.get("model") or {}
    own = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return bool(own and not said.get("normalizer") and model.get("type", "BPE") == "BPE" and not model.get("dropout"))


class Encoder:
    """Whole texts to ids with the tokenizers library; each distinct unit of text is encoded once and remembered.

    Units are found by hash and compared byte by byte. Texts are encoded whole, as the library has it, if they hold a string of an added
    token that isn't to be text, if a unit's hash belongs to another unit, or if the vocabulary cuts texts in ways of its own.
    """

    def __init__(self, path: str, end_id: int, cache_units: int = CACHE_UNITS, as_text: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = as_text
        added = self.lib.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if not (as_text and t.special)]
        self.splits = _splits(path)
        self.dtype = np.dtype("<u2" if max(self.lib.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.end_id, self.cache_units = end_id, cache_units
        self.width = self._widths()
        self._clear()

    def _widths(self) -> np.ndarray:
        """Bytes of text that each id of a byte-level vocabulary stands for: a character of its string each."""
        out = np.zeros(self.lib.get_vocab_size(), np.int64)
        for piece, i in self.lib.get_vocab().items():
            out[i] = len(piece)
        return out

    def _clear(self) -> None:
        end = np.array([0xFF], np.uint8)
        self.keys, self.unit_of = hash_spans(end, np.array([0]), np.array([1])), np.zeros(1, np.int64)  # hashes in order, and their units
        self.at, self.len = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.ids = np.array([self.end_id], self.dtype)
        self.raw, self.raw_at, self.raw_len = end, np.zeros(1, np.int64), np.ones(1, np.int64)

    def _look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit remembered for each hash, and which hashes have none."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.unit_of[at], np.flatnonzero(self.keys[at] != keys)

    def _learn(self, units: list[bytes], keys: np.ndarray) -> np.ndarray:
        """The numbers under which units are remembered from now on. Units that start with a space and end in none keep their ids when joined, so they are encoded many at a time."""
        texts = [u.decode("utf-8", "surrogatepass") for u in units]
        plain, odd = [], []
        for i, t in enumerate(texts):
            (plain if t[0] == " " and len(t) > 1 and not t[1].isspace() and not t[-1].isspace() else odd).append(i)
        size = np.fromiter(map(len, units), np.int64, len(units))
        ids, lens = [], []
        groups = [plain[i : i + 400] for i in range(0, len(plain), 400)]
        joined = self.lib.encode_batch_fast(["".join([texts[i] for i in g]) for g in groups], add_special_tokens=False)
        for k, e in enumerate(joined):
            got = np.array(e.ids, self.dtype)
            ends, want = np.cumsum(self.width[got]), np.cumsum(size[groups[k]])
            last = np.searchsorted(ends, want)
            if last[-1] >= len(ends) or (ends[last] != want).any():  # never seen: then each unit by itself
                odd += groups[k]
                groups[k] = []
                continue
            ids.append(got)
            lens.append(np.diff(last, prepend=-1))
        alone = [e.ids for e in self.lib.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False)]
        ids += [np.array(x, self.dtype) for x in alone]
        lens = np.concatenate([*lens, np.fromiter(map(len, alone), np.int64, len(alone))])
        base, first = len(self.ids), len(self.at)
        self.ids = np.concatenate([self.ids, *ids])
        self.at = np.concatenate([self.at, base + np.cumsum(lens) - lens])
        self.len = np.concatenate([self.len, lens])
        order = np.array([i for g in groups for i in g] + odd)
        number = np.empty(len(units), np.int64)
        number[order] = first + np.arange(len(units))
        self.raw_at = np.concatenate([self.raw_at, len(self.raw) + np.cumsum(size[order]) - size[order]])
        self.raw_len = np.concatenate([self.raw_len, size[order]])
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join([units[i] for i in order.tolist()]), np.uint8)])
        by = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[by])
        self.keys, self.unit_of = np.insert(self.keys, at, keys[by]), np.insert(self.unit_of, at, number[by])
        return number

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its end id, and the count for each text."""
        whole = {i for i, t in enumerate(texts) if t and (not self.splits or any(x in t for x in self.added))}
        ids, counts, wrong = self._by_units([None if i in whole else t for i, t in enumerate(texts)])
        whole |= wrong
        if not whole:
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i, e in zip(sorted(whole), self.lib.encode_batch_fast([texts[i] for i in sorted(whole)], add_special_tokens=False)):
            parts[i] = np.array([*e.ids, self.end_id], self.dtype)
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def _other_bytes(self, buf: np.ndarray, docs: np.ndarray, starts: np.ndarray, ends: np.ndarray, unit: np.ndarray) -> set[int]:
        """Texts in which a unit isn't, byte by byte, the remembered one of its hash."""
        lens = ends - starts
        bad = lens != self.raw_len[unit]
        if not bad.any():
            differs = self.raw[np.arange(len(buf)) + np.repeat(self.raw_at[unit] - starts, lens)] != buf
            if not differs.any():
                return set()
            bad = np.add.reduceat(differs, starts) > 0
        else:
            bad |= [buf[a:b].tobytes() != self.raw[at : at + n].tobytes() for a, b, at, n in zip(starts, ends, self.raw_at[unit], self.raw_len[unit])]
        return set((np.searchsorted(docs, starts[bad], "right") - 1).tolist())

    def _by_units(self, texts: list) -> tuple[np.ndarray, np.ndarray, set[int]]:
        """Ids and counts as of encode(), and the texts for which they don't hold."""
        buf, docs = joined_bytes(texts)
        starts = unit_starts(buf, docs)
        ends = np.append(starts[1:], len(buf))
        codes, unique = pd.factorize(hash_spans(buf, starts, ends))
        if len(self.at) + len(unique) > self.cache_units and len(self.at) > 1:
            self._clear()
        unit, missing = self._look(unique)
        if len(missing):
            first = np.empty(len(unique), np.int64)
            first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            raw, at = buf.tobytes(), first[missing]
            unit[missing] = self._learn([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())], unique[missing])
        unit = unit[codes]
        lens = self.len[unit]
        before = np.cumsum(lens) - lens
        total = int(before[-1] + lens[-1])
        ids = self.ids[np.repeat(self.at[unit] - before, lens) + np.arange(total)]
        counts = np.diff(np.append(before[np.searchsorted(starts, docs)], total))
        return ids, counts, self._other_bytes(buf, docs, starts, ends, unit)


_encoders: dict = {}


def encoder(path: str, end_id: int, as_text: bool = True) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    key = (path, end_id, as_text)
    if key not in _encoders:
        _encoders[key] = Encoder(path, end_id, as_text=as_text)
    return _encoders[key]


def _frames(batches: Iterator[pa.RecordBatch], enc: Encoder, frame_ids: int, shard_rows: int, slice_bytes: int) -> Iterator[bytes]:
    """Rows of a task's shards, each but the last of shard_rows rows: padded data frames, then index and seek table, all without the closing 4 bytes."""
    import xxhash
    import zstandard

    press = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
    held: list[np.ndarray] = []
    n_held, table, docs, counts = 0, [], [], []

    def frame(ids: np.ndarray) -> bytes:
        raw = ids.tobytes()
        out = press.compress(raw) + PAD
        table.append((len(out) + len(SEEK_MAGIC), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        return out

    def end(frames: list[bytes]) -> bytes:
        """The row that ends a shard: frames that are left, document index and seek table."""
        n = np.concatenate(counts).astype("<i8")
        named = np.array([d is not None for d in docs], np.uint8)
        body = np.array([d or 0 for d in docs], "<i8").tobytes() + named.tobytes() + n.tobytes()
        head = json.dumps({"docs": len(docs), "ids": int(n.sum()), "dtype": enc.dtype.str, "end_id": enc.end_id}).encode()
        index = zstandard.ZstdCompressor(level=3).compress(struct.pack("<I", len(head)) + head + body)
        index = struct.pack("<II", INDEX_FRAME, len(index)) + index
        table.append((len(index), 0, 0))
        seek = b"".join(struct.pack("<III", *x) for x in table) + struct.pack("<IB", len(table), 0x80)
        return SEEK_MAGIC.join([*frames, index + struct.pack("<II", SEEK_FRAME, len(seek) + 4) + seek])

    for batch in batches:
        names, texts = batch.column(0), batch.column(1)
        for a, b in text_slices(texts, slice_bytes):
            ids, n = enc.encode(texts.slice(a, b - a).to_pylist())
            docs.extend(names.slice(a, b - a).to_pylist())
            counts.append(n)
            held.append(ids)
            n_held += len(ids)
            if n_held < frame_ids:
                continue
            flat, at = np.concatenate(held), 0
            while len(flat) - at >= frame_ids and len(table) < shard_rows - 1:
                yield frame(flat[at : at + frame_ids])
                at += frame_ids
            if len(table) == shard_rows - 1:  # full: all that is left of the documents so far goes into the last row
                yield end([frame(flat[i : i + frame_ids]) for i in range(at, len(flat), frame_ids)])
                held, n_held, table, docs, counts = [], 0, [], [], []
            else:
                held, n_held = [flat[at:]], len(flat) - at
    if docs:
        yield end([frame(np.concatenate(held))] if n_held else [])


def write_shards(df: DataFrame, out: str, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, frame_ids: int = FRAME_IDS, shard_rows: int = SHARD_ROWS, slice_bytes: int = SLICE, as_text: bool = True) -> None:
    """Encode df in ascending doc_id order into shards under out; the order of shards is that of the numbers in their file names.

    tokenizer: path of a tokenizers file that every executor can open. as_text: whether strings of special tokens are text. The texts are range-partitioned by document,
    which is the only shuffle; sampling for it reads ids and hashes alone.
    """
    if shard_rows < 2:
        raise ValueError("a shard takes 2 rows at least")
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def shard(batches):
        for value in _frames(batches, encoder(tokenizer, end_id, as_text), frame_ids, shard_rows, slice_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], ["value"])

    frames = rows.mapInArrow(shard, "value binary").select(F.col("value").cast("string").alias("value"))
    frames.write.option("encoding", "ISO-8859-1").option("lineSep", SEEK_MAGIC.decode("latin-1")).option("maxRecordsPerFile", shard_rows).text(out)


class Shard:
    """Random access to one shard: only the frames that a document lies in are decompressed."""

    def __init__(self, content: bytes):
        self.content, self.docs, self.frames = content, [], []
        if not content:
            self.counts = self.starts = np.zeros(0, np.int64)
            return
        if content[-4:] != SEEK_MAGIC:
            raise ValueError("not a shard: the seek table is missing")
        n, flags = struct.unpack_from("<IB", content, len(content) - 9)
        table = np.frombuffer(content, "<u4", 3 * n, len(content) - 9 - 12 * n).reshape(n, 3).astype(np.int64)
        self.sums = table[:, 2]
        self.at = np.cumsum(table[:, 0]) - table[:, 0]
        self.size = table[:, 0]
        self.raw_at = np.cumsum(table[:, 1]) - table[:, 1]
        self.raw_size = table[:, 1]
        self._index(int(self.at[-1]))
        self._last = (-1, b"")

    def _index(self, at: int) -> None:
        import zstandard

        magic, size = struct.unpack_from("<II", self.content, at)
        if magic != INDEX_FRAME:
            raise ValueError("not a shard: the document index is missing")
        body = zstandard.ZstdDecompressor().decompress(self.content[at + 8 : at + 8 + size])
        (k,) = struct.unpack_from("<I", body)
        self.head = json.loads(body[4 : 4 + k])
        n = self.head["docs"]
        ids = np.frombuffer(body, "<i8", n, 4 + k)
        named = np.frombuffer(body, np.uint8, n, 4 + k + 8 * n)
        self.docs = [int(d) if ok else None for d, ok in zip(ids.tolist(), named.tolist())]
        self.counts = np.frombuffer(body, "<i8", n, 4 + k + 9 * n)
        self.starts = np.cumsum(self.counts) - self.counts
        self.dtype = np.dtype(self.head["dtype"])

    def frame(self, i: int) -> bytes:
        """Frame i decompressed, its checksum compared with the seek table's."""
        import xxhash
        import zstandard

        if self._last[0] != i:
            raw = zstandard.ZstdDecompressor().decompress(self.content[self.at[i] : self.at[i] + self.size[i]], max_output_size=int(self.raw_size[i]))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i} is damaged")
            self._last = (i, raw)
        return self._last[1]

    def ids(self, row: int) -> np.ndarray:
        """The ids of the shard's row-th document, its end id included."""
        a = int(self.starts[row]) * self.dtype.itemsize
        b = a + int(self.counts[row]) * self.dtype.itemsize
        i, out = int(np.searchsorted(self.raw_at[:-1], a, "right")) - 1, []
        while a < b:
            raw, base = self.frame(i), int(self.raw_at[i])
            out.append(raw[a - base : b - base])
            a, i = base + len(raw), i + 1
        return np.frombuffer(b"".join(out), self.dtype)


def _place(shard: str) -> tuple[int, int]:
    """Task and number within the task that a shard's name gives."""
    found = re.match(r"part-(\d+)-.*?-c(\d+)", shard)
    return (int(found[1]), int(found[2]))


def read_shards(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, shard, in_shard: what the shards under out say of each document.

    One row for each shard comes to the driver (its name and its number of ids), none for documents.
    """
    files = spark.read.format("binaryFile").load(out).select("path", "content")

    def docs(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = Shard(content.as_py())
                name = path.rsplit("/", 1)[-1]
                for a in range(0, len(s.docs), 10_000):
                    rows = range(a, min(a + 10_000, len(s.docs)))
                    crc = [zlib.crc32(s.ids(i).astype("<u4").tobytes()) for i in rows]
                    part = slice(rows.start, rows.stop)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(rows, pa.int64()), pa.array(s.docs[part], pa.int64()), pa.array(s.starts[part]), pa.array(s.counts[part]), pa.array(crc, pa.int64())], ["shard", "in_shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    rows = cut(files.mapInArrow(docs, "shard string, in_shard long, doc_id long, start long, n_tokens long, ids_crc32 long"), "token-docs")
    sizes = sorted(((r.shard, r.n) for r in rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()), key=lambda x: _place(x[0]))
    base, at = [], 0
    for shard, n in sizes:
        base.append((shard, at))
        at += n
    bases = F.broadcast(spark.createDataFrame(base, "shard string, base long"))
    return rows.join(bases, "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "shard", "in_shard")


def token_output(df: DataFrame, tokenizer: str, *, out: str | None = None, keep: bool = True, **columns) -> DataFrame:
    """write_shards() and read_shards() in one. out: where shards go (default: the shared folder); keep=False removes them after reading."""
    spark = df.sparkSession
    out = out or shared_dir(spark, "token-shards")
    write_shards(df, out, tokenizer, **columns)
    rows = read_shards(spark, out)
    if not keep:
        remove(spark, out)
    return rows
