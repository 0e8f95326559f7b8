"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and split into words. An item's windows are its runs of `span` words; an item of fewer words
is one window. A document word inside any occurrence of a window is hit.

Both sides hash every run of `gram` words and keep, of every span - gram + 1 runs in a row, the one of least hash (the last
such). Two texts that share `span` words share the runs in them, so they keep a fingerprint in common: no shared span of that
length is missed. A fingerprint in common is extended to the windows of `span` words around it in the document; a window is a
hit if the items hold it, which is looked up once and then compared word by word. So each document position costs the same,
however often a fingerprint or a window is repeated on either side. Items shorter than `span` have one window, kept whole
under its own length. Windows that the same items hold share one list of them.

The benchmark is read in blocks of at most BLOCK_WORDS words (or one longer item), whose index of some 60 bytes a word is
broadcast. One block needs one pass over the documents. With more, documents are numbered and written once, each block's pass
writes only the documents that it hits, and those are joined to the documents by number.

Defined cases: a null text has no words; an item without words has no window; items with a null id are left out; equal
items and repeated documents are each judged by themselves; an empty benchmark hits nothing; a document table's other
columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utterlake.llm.common import cut, hash_spans, joined_bytes, mix64, text_slices

SPAN, GRAM = 10, 5
BLOCK_WORDS = 1_000_000

#: Bytes that make up words: lower-case letters, digits, and all of UTF-8's longer characters; capitals become small.
_LOWER = np.zeros(256, np.uint8)
_LOWER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LOWER[0x80:0xFF] = np.arange(0x80, 0xFF)


def word_table(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts in order, and where each text's words start (with the end of the last)."""
    buf, docs = joined_bytes(texts)
    low = _LOWER[buf]
    inside = np.zeros(len(low) + 1, np.int8)
    inside[:-1] = low != 0
    edge = np.diff(inside, prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return hash_spans(low, starts, ends), np.append(np.searchsorted(starts, docs), len(starts))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out = mix64(out + words[j : j + m]) if j else mix64(words[:m] + np.uint64(n))
    return out


def winnow(words: np.ndarray, bounds: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept runs of all texts."""
    grams = gram_hashes(words, gram)
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), grams[:0]
    lens = np.diff(bounds)
    left = np.repeat(bounds[1:], lens) - np.arange(len(words))  # words left in the text
    least, at = grams[:n].copy(), np.arange(n)
    for j in range(1, span - gram + 1):
        lower = grams[j : j + n] <= least
        np.copyto(least, grams[j : j + n], where=lower)
        at[lower] = np.flatnonzero(lower) + j
    keep = np.unique(at[left[:n] >= span])
    return keep, grams[keep]


def _window_hashes(words: np.ndarray, starts: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of the runs of n words that begin at starts."""
    out = np.full(len(starts), n + (seed << 8), np.uint64)
    for j in range(n):
        out = mix64(out + words[starts + j])
    return out


def _same_words(a: np.ndarray, at: np.ndarray, b: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """Whether the runs of n words at `at` in a and at `to` in b agree, word for word."""
    ok = np.ones(len(at), bool)
    for j in range(n):
        ok &= a[at + j] == b[to + j]
    return ok


def _window_table(words: np.ndarray, starts: np.ndarray, owner: np.ndarray, n: int, lists: dict[bytes, int]) -> dict:
    """The distinct windows of n words at starts: sorted hashes, where each lies in words, and the list of the items that hold it.

    Hashes are drawn anew until no two different windows share one.
    """
    seed = 0
    while True:
        h = _window_hashes(words, starts, n, seed)
        order = np.lexsort((owner, h))
        h, at, who = h[order], starts[order], owner[order]
        new = np.append(True, h[1:] != h[:-1])
        first = np.flatnonzero(new)
        if _same_words(words, at, words, at[first][np.cumsum(new) - 1], n).all():
            break
        seed += 1
    numbers = np.empty(len(first), np.int64)
    for i, (a, b) in enumerate(zip(first.tolist(), [*first[1:].tolist(), len(h)])):
        held = who[a:b]
        if b - a > 1:
            held = held[np.append(True, held[1:] != held[:-1])]
        numbers[i] = lists.setdefault(held.tobytes(), len(lists))
    return {"n": n, "seed": seed, "hash": h[first], "at": at[first], "list": numbers}


def build_index(items: list[tuple[str, str]], span: int = SPAN, gram: int = GRAM) -> dict:
    """What documents are matched against; items: (id, text). Equal word sequences share an entry."""
    words, bounds = word_table([t for _, t in items])
    same: dict[bytes, int] = {}
    names: list[list[str]] = []
    kept = []
    for i, (name, _) in enumerate(items):
        w = words[bounds[i] : bounds[i + 1]]
        if not len(w):
            continue
        key = w.tobytes()
        if key not in same:
            same[key] = len(names)
            names.append([])
            kept.append(w)
        names[same[key]].append(name)
    flat = np.concatenate([*kept, np.zeros(0, np.uint64)]).astype(np.uint64)
    lens = np.array([len(w) for w in kept], np.int64)
    ends = np.cumsum(lens)
    _, prints = winnow(flat, np.append(0, ends), span, gram)
    lists: dict[bytes, int] = {}
    tables = {}
    item, left = np.repeat(np.arange(len(lens)), lens), np.repeat(ends, lens) - np.arange(len(flat))
    starts = np.flatnonzero(left >= span)
    if len(starts):
        tables[span] = _window_table(flat, starts, item[starts], span, lists)
    for n in sorted(set(lens[lens < span].tolist())):
        who = np.flatnonzero(lens == n)
        tables[n] = _window_table(flat, ends[who] - n, who, n, lists)
    holders = [np.frombuffer(key, np.int64) for key in lists]
    return {"names": names, "words": flat, "prints": np.unique(prints), "tables": tables, "holders": holders, "span": span, "gram": gram}


def _found(words: np.ndarray, starts: np.ndarray, table: dict, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of starts whose window the table has, and the number of each one's list of items."""
    h = _window_hashes(words, starts, table["n"], table["seed"])
    at = np.minimum(np.searchsorted(table["hash"], h), len(table["hash"]) - 1)
    like = np.flatnonzero(table["hash"][at] == h)
    like = like[_same_words(words, starts[like], flat, table["at"][at[like]], table["n"])]
    return starts[like], table["list"][at[like]]


def _candidates(words: np.ndarray, bounds: np.ndarray, left: np.ndarray, index: dict) -> np.ndarray:
    """Starts of the windows that hold a fingerprint of the index: up to span - gram words before it."""
    span, gram, keys = index["span"], index["gram"], index["prints"]
    at, prints = winnow(words, bounds, span, gram)
    at = at[keys[np.minimum(np.searchsorted(keys, prints), len(keys) - 1)] == prints]
    around = np.zeros(len(words) + 1, np.int64)
    np.add.at(around, np.maximum(at - (span - gram), 0), 1)
    np.add.at(around, at + 1, -1)
    return np.flatnonzero((np.cumsum(around[:-1]) > 0) & (left >= span))


def find_hits(texts: list, index: dict) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], list[list[str]]]:
    """For each text: its number of words, (starts, ends) of hit runs of words, and the names of items that occur."""
    words, bounds = word_table(texts)
    lens = np.diff(bounds)
    left = np.repeat(bounds[1:], lens) - np.arange(len(words))
    runs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
    names: list[list[str]] = [[]] * len(texts)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for n, table in index["tables"].items():
        starts = _candidates(words, bounds, left, index) if n == index["span"] else np.flatnonzero(left >= n)
        if len(starts):
            a, number = _found(words, starts, table, index["words"])
            found.append((a, a + n, number))
    if not found:
        return lens, runs, names
    a, b, number = (np.concatenate(x) for x in zip(*found))
    text = np.searchsorted(bounds, a, "right") - 1
    order = np.argsort(text, kind="stable")
    a, b, number, text = a[order], b[order], number[order], text[order]
    first = np.flatnonzero(np.diff(text, prepend=-1))
    for i, j in zip(first.tolist(), [*first[1:].tolist(), len(text)]):
        t = int(text[i])
        runs[t] = (a[i:j] - bounds[t], b[i:j] - bounds[t])
        held = np.unique(np.concatenate([index["holders"][x] for x in np.unique(number[i:j]).tolist()]))
        names[t] = sorted({x for e in held.tolist() for x in index["names"][e]})
    return lens, runs, names


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int):
    """Items in blocks of a bounded number of words, one block in the driver at a time."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("string").alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    block, n = [], 0
    for r in rows.toLocalIterator():
        size = len(r.t) // 2 + 1
        if block and n + size > limit:
            yield block
            block, n = [], 0
        block.append((r.i, r.t))
        n += size
    yield block


def hits(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM, block_words: int = BLOCK_WORDS, keep_text: bool = True) -> DataFrame:
    """docs with n_words, hit_runs (array of struct<start, stop> in words, merged) and items behind their own columns.

    The three come last, so that own columns of those names do no harm: address them by place.
    keep_text=False gives nulls for the text.
    """
    if not 1 <= gram <= span:
        raise ValueError("gram must lie between 1 and span")
    spark = docs.sparkSession
    k = docs.columns.index(text)
    run = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    n_own = len(docs.columns)
    plain = docs.toDF(*[f"_c{i}" for i in range(n_own)])
    own = plain.schema
    schema = T.StructType([*own.fields, T.StructField("n_words", T.LongType()), T.StructField("hit_runs", run), T.StructField("items", T.ArrayType(T.StringType()))])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    def passed(rows: DataFrame, block: list, schema: T.StructType, pack) -> DataFrame:
        """rows through the index of a block; pack makes columns of a part of rows and what find_hits() says of it."""
        shared = spark.sparkContext.broadcast(build_index(block, span, gram))
        at = rows.columns.index(f"_c{k}")

        def scan(batches):
            for batch in batches:
                for a, b in text_slices(batch.column(at)):
                    part = batch.slice(a, b - a)
                    n, runs, names = find_hits(part.column(at).to_pylist(), shared.value)
                    merged = [[{"start": s, "stop": e} for s, e in merge_runs(x, y)] for x, y in runs]
                    found = [pa.array(n.astype(np.int64)), pa.array(merged, run_type), pa.array(names, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*pack(part), *found], schema.names)

        return rows.mapInArrow(scan, schema)

    def own_columns(part):
        return [pa.nulls(len(part), c.type) if i == k and not keep_text else c for i, c in enumerate(part.columns)]

    blocks = _blocks(benchmark, item_id, item_text, block_words)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        return passed(plain, block, schema, own_columns).toDF(*docs.columns, "n_words", "hit_runs", "items")

    numbered = cut(plain.withColumn("_row", F.monotonically_increasing_id()), "decontam-rows")
    narrow = T.StructType([T.StructField("_row", T.LongType()), *schema.fields[n_own:]])
    texts, hit = numbered.select("_row", f"_c{k}"), F.size("hit_runs") > 0
    first = cut(passed(texts, block, narrow, lambda part: [part.column(0)]), "decontam-hits")
    found = first.where(hit)
    while following is not None:
        found = found.unionByName(cut(passed(texts, following, narrow, lambda part: [part.column(0)]).where(hit), "decontam-hits"))
        following = next(blocks, None)
    found = found.groupBy("_row").agg(F.flatten(F.collect_list("hit_runs")).alias("_runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"))
    out = numbered.join(first.select("_row", "n_words"), "_row").join(found.withColumn("_runs", _merged("_runs")), "_row", "left")
    if not keep_text:
        out = out.withColumn(f"_c{k}", F.lit(None).cast(own[k].dataType))
    runs, items = F.coalesce("_runs", F.array().cast(run)), F.coalesce("_items", F.array().cast("array<string>"))
    return out.select(*own.names, "n_words", runs, items).toDF(*docs.columns, "n_words", "hit_runs", "items")


def _merged(runs: str) -> Column:
    """An array of struct<start, stop>, sorted, touching and overlapping runs made one."""

    def add(done: Column, r: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["stop"], r["stop"]).alias("stop"))
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown))
        return F.when(F.coalesce(r["start"] <= last["stop"], F.lit(False)), joined).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(F.array_sort(F.col(runs)), F.slice(F.col(runs), 1, 0), add)


def merge_runs(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each document."""
    text = options.get("text", "text")
    found = hits(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias(text)), benchmark, keep_text=False, **options)
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda s, r: s + r["stop"] - r["start"])
    joined = F.array_join(F.array_sort("items"), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents of docs that hold no window of the benchmark."""
    found = hits(docs, benchmark, **options)
    n = len(docs.columns)
    found = found.toDF(*[f"_c{i}" for i in range(n)], "_n", "_runs", "_items").where(F.size("_runs") == 0)
    return found.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])
