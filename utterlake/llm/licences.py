"""Licence scan: sparse TF-IDF cosine of headers and licence files to templates, then inheritance down directories.

Templates are customary statements and, in licence_texts/, the whole texts and standard notices of common licences. Passages of a
document are its lines, its runs of comment lines and of other lines without an empty line between them (a wrapped notice or
header is one), and every licence file as a whole. A passage's vector holds its words with weight tf * idf; idf comes
from the number of documents that hold a word, counted over all documents for all words, and serves both sides of the
cosine. A document's own licence is that of the most similar template if the cosine reaches `threshold`, of whole texts before
statements, as several licences share sentences; that rights are reserved decides only where no licence does, and only if the
passage says so in these words. A document without one takes that of the nearest
directory at or above its own that has a licence file (a name such as LICENSE or COPYING) with a licence of its own.

Only passages that hold one of a template's rare words can reach the threshold (checked when the weights are made), so
the others are passed over without being scored, and a template is passed over if the words that a passage shares with it
hold too little of its length. The counts of the templates' words and of the COMMON words that most documents
hold are handed to the scan; the counts of all others, each in few documents, are joined to the words of the scored passages. Words
are compared by 64-bit hashes, and scores are rounded to 12 digits, as sums run in no fixed order. Directories are made distinct
before they are joined with their ancestors, so a directory with a third of all files counts as one.

Defined cases: null and empty texts have no licence of their own; a null path has no directory, so nothing is inherited; of
several licence files in a directory the most similar counts, then the one of least path; repeated rows are judged alike;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import cut, hash_spans, joined_bytes, text_slices
from utterlake.llm.decontam import _LOWER, word_table

THRESHOLD = 0.7
#: How many words' counts the scan holds at most, the commonest; the others are joined. Changes speed, never scores.
COMMON = 20_000
#: (word, count) pairs that a counting task holds before it adds them up, and sums it holds before it hands them on.
HELD, FLUSH = 2_000_000, 1_000_000
#: Customary licence statements and the openings of licence texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
)
#: Licences that decide only where no other does, and the words that a passage must hold in a row for them.
WEAK = {"proprietary": ("all", "rights", "reserved")}
#: What opens a line of comment.
COMMENT = re.compile(r"\s*(#|//|/?\*|--|;|%|<!--|rem\b|\.\.\s)", re.IGNORECASE)
#: Names of licence files, without ending, in lower case.
FILE_NAMES = ("license", "licence", "copying", "notice", "unlicense")


def words_of(text: str) -> list[str]:
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def whole_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text) of the files in licence_texts/, which the driver reads."""
    files = sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))
    return tuple((f.stem.removesuffix("-header"), f.read_text()) for f in files)


def blocks(lines: list[str]) -> list[tuple[int, int]]:
    """(first, end) of the runs of several comment lines, and of several other lines that aren't empty."""
    out, at, kind = [], 0, None
    for i, line in enumerate([*lines, ""]):
        now = "comment" if COMMENT.match(line) else "text" if line.strip() else None
        if now != kind:
            if kind and i - at > 1:
                out.append((at, i))
            at, kind = i, now
    return out


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, t in templates for w in words_of(t)})


class Weights:
    """idf of the found words and the templates' words, and the templates' vectors."""

    def __init__(self, n_docs: int, found: dict[str, int], templates=TEMPLATES, threshold: float = THRESHOLD):
        self.rare = math.log(n_docs + 1) + 1
        self.idf = {w: math.log((n_docs + 1) / (found.get(w, 0) + 1)) + 1 for w in {*vocabulary(templates), *found}}
        self.threshold, self.templates = threshold, []
        self.anchors: set[str] = set()
        for name, text in templates:
            v = {w: n * self.idf[w] for w, n in Counter(words_of(text)).items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            v = {w: x / norm for w, x in v.items()}
            self.templates.append((name, v))
            # words, commonest first, stop being needed as long as they alone cannot reach the threshold
            rest = 0.0
            for w in sorted(v, key=lambda w: (self.idf[w], w)):
                rest += v[w] ** 2
                if math.sqrt(rest) >= threshold - 1e-9:
                    self.anchors.add(w)

    def best(self, words: list[str]) -> tuple[str | None, float]:
        """The most similar template's licence and cosine; the first in order among equals."""
        v = {w: n * self.idf.get(w, self.rare) for w, n in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        name, top = None, 0.0
        for template, t in self.templates:
            cos = sum(t[w] * v[w] for w in sorted(t.keys() & v.keys())) / norm if norm else 0.0
            if cos > top + 1e-12:
                name, top = template, cos
        return name, top


def _keys(words: list[str]) -> np.ndarray:
    """Hashes of words, as word_table() has them."""
    buf, starts = joined_bytes(words)
    low = _LOWER[buf]
    return hash_spans(low, starts, starts + np.array([len(w.encode()) for w in words]))


def document_counts(docs: DataFrame, text: str) -> DataFrame:
    """key, n: the number of documents that hold each word, by its hash, and the number of all documents under a null key."""
    rows = docs.select(F.col(text).cast("string").alias("text"))

    def added(held):
        keys, n = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.add.reduceat(n, first)

    def table(keys, n):
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n, pa.int64())], ["key", "n"])

    def scan(batches):
        held, size, total = [], 0, 0
        for batch in batches:
            total += len(batch)
            for a, b in text_slices(batch.column(0)):
                words, bounds = word_table(batch.column(0).slice(a, b - a).to_pylist())
                if not len(words):
                    continue
                order = np.argsort(words, kind="stable")
                words, doc = words[order], np.repeat(np.arange(b - a), np.diff(bounds))[order]
                new = np.append(True, (words[1:] != words[:-1]) | (doc[1:] != doc[:-1]))
                words = words[new].view(np.int64)
                held.append(added([(words, np.ones(len(words), np.int64))]))
                size += len(held[-1][0])
                if size > HELD:
                    held = [added(held)]
                    size = len(held[0][0])
                    if size > FLUSH:
                        yield table(*held[0])
                        held, size = [], 0
        if held:
            yield table(*added(held))
        yield table(pa.array([None], pa.int64()), [total])

    return rows.mapInArrow(scan, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def is_licence_file(path: Column) -> Column:
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    return F.coalesce(F.split_part(name, F.lit("."), F.lit(1)).isin(*FILE_NAMES), F.lit(False))


def own_licences(docs: DataFrame, *, doc_id: str = "doc_id", path: str = "path", text: str = "text", templates=TEMPLATES, texts: tuple[tuple[str, str], ...] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, is_file, own_licence, own_score (that of the best template, null without any rare word of one).

    templates and texts: (licence, text) of statements and of whole texts (default: whole_texts()), which are matched alike.
    """
    n_statements = len(templates)
    templates = (*templates, *(whole_texts() if texts is None else texts))
    counts = cut(document_counts(docs, text), "licence-words")
    vocab = vocabulary(templates)
    vocab_keys = _keys(vocab).view(np.int64).tolist()
    known = {r.key: r.n for r in counts.where(F.col("key").isNull() | F.col("key").isin(vocab_keys)).collect()}
    n_docs = known.pop(None, 0)
    weights = Weights(n_docs, {w: known[k] for w, k in zip(vocab, vocab_keys) if k in known}, templates, threshold)
    held = counts.where("key IS NOT NULL")
    total = held.agg(F.sum("n")).first()[0] or 0
    known |= {r.key: r.n for r in held.where(F.col("n") * COMMON >= total).collect()}  # at most COMMON words can hold so large a share
    known_keys = np.array(sorted(known), np.int64)
    known_idf = np.log((n_docs + 1) / (np.array([known[k] for k in sorted(known)], np.float64) + 1)) + 1
    anchors = np.sort(_keys(sorted(weights.anchors)))
    key_of = dict(zip(vocab, vocab_keys))
    vectors = []  # whether it is a whole text, keys in order, their share of the vector, and weight with which a passage's counts are multiplied
    for i, (name, v) in enumerate(weights.templates):
        of = np.array([key_of[w] for w in v], np.int64)
        order = np.argsort(of)
        share = np.array(list(v.values()))[order]
        vectors.append((name, i >= n_statements, of[order], share, share * np.array([weights.idf[w] for w in v])[order]))
    phrases = {name: _keys(list(w)) for name, w in WEAK.items()}
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(path).cast("string").alias("path"), is_licence_file(F.col(path)).alias("is_file"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"))

    def holds(words: np.ndarray, phrase: np.ndarray) -> bool:
        at = np.flatnonzero(words[: max(0, len(words) - len(phrase) + 1)] == phrase[0])
        return any((words[i : i + len(phrase)] == phrase).all() for i in at.tolist())

    def passage(words: np.ndarray) -> list[dict]:
        """The best template's licence and product with the passage, the square of its known part, and its other words; for strong and weak licences."""
        keys, n = np.unique(words.view(np.int64), return_counts=True)
        best: dict[bool, tuple[str, float, bool]] = {}
        for licence, full, of, share, weight in vectors:
            at = np.minimum(np.searchsorted(of, keys), len(of) - 1)
            mine = of[at] == keys
            at = at[mine]
            if (share[at] ** 2).sum() < threshold**2 - 1e-9:
                continue  # whatever else the passage holds, the cosine stays below
            weak = licence in WEAK
            dot = float((weight[at] * n[mine]).sum())
            if dot > best.get(weak, ("", 0.0, False))[1] * (1 + 1e-12) and (not weak or holds(words, phrases[licence])):
                best[weak] = (licence, dot, full)
        if not best:
            return []
        at = np.minimum(np.searchsorted(known_keys, keys), len(known_keys) - 1)
        found = known_keys[at] == keys
        square = float(((n[found] * known_idf[at[found]]) ** 2).sum())
        return [{"name": name, "full": full, "dot": dot, "square": square, "keys": keys[~found], "times": n[~found]} for name, dot, full in best.values()]

    def tried(text: str, whole: bool) -> list[dict]:
        lines = text.split("\n")
        words, bounds = word_table(lines)
        at = np.minimum(np.searchsorted(anchors, words), len(anchors) - 1)
        marks = np.flatnonzero(anchors[at] == words)
        runs = {(i, i + 1) for i in range(len(lines))} | set(blocks(lines)) | ({(0, len(lines))} if whole else set())
        out = []
        for a, b in sorted(runs):
            first, end = bounds[a], bounds[b]
            if np.searchsorted(marks, end) > np.searchsorted(marks, first):
                out += passage(words[first:end])
        return out

    kind = pa.list_(pa.struct([("name", pa.string()), ("full", pa.bool_()), ("dot", pa.float64()), ("square", pa.float64()), ("keys", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]))

    def scan(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(4)):
                part = batch.slice(a, b - a)
                texts, files = part.column(4).to_pylist(), part.column(2).to_pylist()
                words, bounds = word_table(texts)
                at = np.minimum(np.searchsorted(anchors, words), len(anchors) - 1)
                hits = set((np.searchsorted(bounds, np.flatnonzero(anchors[at] == words), "right") - 1).tolist())
                found = [tried(t, f) if i in hits else None for i, (t, f) in enumerate(zip(texts, files))]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(found, kind)], ["doc_id", "path", "is_file", "row", "found"])

    schema = "doc_id long, path string, is_file boolean, row long, found array<struct<name:string,full:boolean,dot:double,square:double,keys:array<long>,times:array<long>>>"
    judged = cut(rows.mapInArrow(scan, schema), "licence-lines")
    lines = judged.where("found IS NOT NULL").select("row", F.posexplode("found").alias("line", "f")).select("row", "line", "f.*")
    others = lines.select("row", "line", F.explode(F.arrays_zip("keys", "times")).alias("w")).select("row", "line", "w.*").withColumnRenamed("keys", "key")
    idf = F.log((F.lit(n_docs) + 1) / (F.col("n") + 1)) + 1
    more = others.join(counts, "key").groupBy("row", "line").agg(F.sum(F.pow(F.col("times") * idf, 2)).alias("more"))
    score = F.round(F.col("dot") / F.sqrt(F.col("square") + F.coalesce("more", F.lit(0.0))), 12)
    scored = lines.drop("keys", "times").join(more, ["row", "line"], "left").withColumn("score", score)
    below = F.col("score") < threshold
    best = scored.groupBy("row").agg(F.min(F.struct(below.alias("below"), F.col("name").isin(*WEAK).alias("weak"), (~F.col("full")).alias("part"), (-F.col("score")).alias("s"), "line", "name")).alias("b"))
    best = best.select("row", F.when(~F.col("b.below"), F.col("b.name")).alias("own_licence"), (-F.col("b.s")).alias("own_score"))
    return judged.drop("found").join(best, "row", "left").drop("row")


def scan(docs: DataFrame, **options) -> DataFrame:
    """doc_id, path, own_licence, own_score, licence, basis ('own', 'inherited', null) and from_path for each document."""
    own = cut(own_licences(docs, **options), "licence-own")
    parts = F.split("path", "/")
    own = own.withColumn("dir", F.when(F.col("path").isNotNull(), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")))
    files = own.where("is_file AND own_licence IS NOT NULL AND dir IS NOT NULL").groupBy(F.col("dir").alias("above"))
    given = files.agg(F.min(F.struct((-F.col("own_score")).alias("s"), "path", "own_licence")).alias("best"))
    given = given.select("above", F.col("best.path").alias("given_path"), F.col("best.own_licence").alias("given"))
    dirs = own.where("own_licence IS NULL AND dir IS NOT NULL").select("dir").distinct()
    steps = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, 1, n), "/").alias("above")))).alias("a"))
    above = above.select("dir", "a.depth", "a.above")
    nearest = above.join(given, "above").groupBy("dir").agg(F.max(F.struct("depth", "given_path", "given")).alias("near"))
    out = own.join(nearest, "dir", "left")
    licence = F.coalesce("own_licence", "near.given")
    basis = F.when(F.col("own_licence").isNotNull(), "own").when(F.col("near.given").isNotNull(), "inherited")
    source = F.when(F.col("own_licence").isNotNull(), F.col("path")).otherwise(F.col("near.given_path"))
    return out.select("doc_id", "path", "own_licence", "own_score", licence.alias("licence"), basis.alias("basis"), source.alias("from_path"))
