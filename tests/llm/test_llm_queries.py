"""Queries of the training-data operators against their SQL, and the pipeline against its stages' brute force, on the smallest tables."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from test_llm import contamination, near_components
from utterlake.llm import quality, queries, substrings

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, con, name):
    df = queries.queries()[name](spark, SF)
    cur = con.execute(queries.oracle_sql()[name])
    columns, want = [c[0] for c in cur.description], cur.fetchall()
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    plain = lambda rows: sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in rows)
    assert sorted(df.columns) == sorted(columns) and plain(got) == plain(want)


def test_pipeline(spark):
    """Each stage keeps columns and only drops or repeats rows; the last counts what is left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, left, SF).cache()
        assert after.columns == columns and after.subtract(left).count() == 0, name
        left = after
    end = corpus_pipeline.STAGES[-1][1](spark, left, SF).collect()
    assert len(end) == left.count() and sorted(r.doc_id for r in end) == sorted(r.doc_id for r in left.collect())
    whole = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert whole == sorted(map(tuple, end))


def test_stages_by_brute_force(spark):
    """The rows that each stage keeps of the smallest documents, by their definitions in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = sorted(docs.select("doc_id", "text", "source").collect())
    stages = dict(corpus_pipeline.STAGES)
    kept = lambda name: Counter(r.doc_id for r in stages[name](spark, docs, SF).select("doc_id").collect())

    scores = {r.doc_id: r.score for r in quality.scores(docs, labels).collect()}
    assert kept("quality") == Counter(d for d, s in scores.items() if s >= 0.5)

    comps = near_components([r.text for r in rows], 5)
    assert kept("near_dedup") == Counter(rows[i].doc_id for i, (_, c) in enumerate(comps) if c == i)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert kept("decontaminate") == Counter(d for d, x in contamination([(r.doc_id, r.text) for r in rows], items) if not x[-1])

    size = defaultdict(int)
    for r in rows:
        size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    low, high, goal = 0.0, 4.0 * sum(size.values()), 1.5 * sum(size.values())
    for _ in range(200):  # the level at which sources, none above twice its size, hold the goal
        level = (low + high) / 2
        low, high = (level, high) if sum(min(2 * n, weight[s] * level) for s, n in size.items()) < goal else (low, level)
    want = Counter()
    for r in rows:
        rate = min(2 * size[r.source], weight[r.source] * high) / size[r.source] if size[r.source] else 0
        rate = round(rate, 9)
        draw = int(hashlib.md5(f"9:{r.doc_id}".encode()).hexdigest()[:8], 16) / 2**32
        want[r.doc_id] = int(rate) + (draw < rate - int(rate))
    assert kept("mix") == +want


def repeated_windows(texts, length=400):
    """(bytes removed, runs, digest of what is left) of each text, from hashes of all windows by two products of the bytes."""
    data = [(t or "").encode() for t in texts]
    rng = np.random.default_rng(77)
    value = rng.integers(1, 2**62, 256, dtype=np.uint64)
    hashes = []
    for b in data:
        n = len(b) - length + 1
        if n < 1:
            hashes.append(np.zeros(0, np.uint64))
            continue
        level, width = value[np.frombuffer(b, np.uint8)], 1  # of 1, 2, 4, ... bytes, and 400 = 256 + 128 + 16
        out, done = None, 0
        for k in range(9):
            if length >> k & 1:
                part = level[done : done + n]
                out = part.copy() if out is None else (out ^ (out >> np.uint64(29))) * np.uint64(0xD1342543DE82EF95) + part
                done += width
            if k < 8:
                level = (level[:-width] ^ (level[:-width] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C55) + level[width:]
                width *= 2
        hashes.append(out)
    flat = np.concatenate(hashes)
    order = np.argsort(flat, kind="stable")
    same = flat[order][1:] == flat[order][:-1]
    again = np.zeros(len(flat), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    at = 0
    for b, h in zip(data, hashes):
        cover = np.zeros(len(b) + 1, np.int64)
        starts = np.flatnonzero(again[at : at + len(h)])
        at += len(h)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + length, -1)
        gone = np.cumsum(cover)[: len(b)] > 0
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        yield int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are absent")
def test_substrings_of_all_documents(spark):
    """Each of 10,000 documents by brute force, from one table and dealt over many tasks with most anchors counted as hot."""
    table = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"])
    want = dict(zip(table["doc_id"].to_pylist(), repeated_windows(table["text"].to_pylist())))
    for sf, hot in (("/root/testdata/sf0.1", substrings.HOT), ("/root/testdata/sf0.1", 2)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(substrings, "HOT", hot)
            rows = queries.op3_substring_removal(spark, sf).collect()
        assert len(rows) == len(want) and {r.doc_id: tuple(r)[2:] for r in rows} == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are absent")
def test_quality_of_held_out_documents(spark):
    """Accuracy, and the chance that a good document scores above a bad one, on labels that were not learned from."""
    sf = "/root/testdata/sf0.1"
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op5_quality(spark, sf).collect() if r.held_out and marks.get(r.doc_id) is not None]
    good, bad = (np.sort([r.score for r in rows if marks[r.doc_id] == k]) for k in (1, 0))
    above = (np.searchsorted(bad, good, "left") + np.searchsorted(bad, good, "right")).sum() / 2
    accuracy, auc = np.mean([r.predicted == marks[r.doc_id] for r in rows]), above / (len(good) * len(bad))
    print(f"held out {len(rows)}, bad {len(bad)}, accuracy {accuracy:.4f}, AUC {auc:.4f}")
    assert accuracy > 0.95 and auc > 0.97


@pytest.mark.parametrize("rows", [[], [(None, None), (None, ""), (None, "one two three four five six"), (None, "one two three four five six"), (3, "one two three four five six"), (4, "ab " * 3000), (4, "ab " * 3000), (5, None)]])
def test_pipeline_on_odd_documents(spark, tmp_path, rows):
    """No documents, null ids, null and repetitive texts, and repeated rows: no stage fails, adds or changes a row."""
    for name in ("labels", "benchmark"):
        os.symlink(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, None, None if i else "s", None) for i, t in rows], schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, left, str(tmp_path)).cache()
        assert after.columns == left.columns and after.subtract(left).count() == 0, name
        if name != "mix":
            assert not Counter(map(tuple, after.collect())) - Counter(map(tuple, left.collect())), name
        left = after
    end = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in end) == Counter(r.doc_id for r in left.collect())
    at = 0
    for r in sorted(end, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
