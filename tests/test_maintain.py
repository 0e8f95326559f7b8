"""A release kept up to date by a stream against a rebuild from the files as they are."""

import random
from collections import Counter

import pytest

from utterlake.streaming import ingest, maintain


def rebuilt(files):
    """Tokens and frequencies of files (path -> corpus, utterances)."""
    tokens, counts = set(), Counter()
    for path, (corpus, said) in files.items():
        for order, who, words in said:
            for i, w in enumerate([w for w in words if w is not None], 1):
                tokens.add((corpus, path, order, i, who, w))
                counts[corpus, who, w] += w != ""
    return tokens, +counts


@pytest.fixture
def batches():
    """Four batches of events with files that come, change, move to another corpus, go, come back, and are named twice."""
    rng = random.Random(8)
    said = lambda: [(i, rng.choice(["CHI", "MOT"]), [rng.choice(["a", "b", "c", "", None, "d"]) for _ in range(rng.randrange(6))]) for i in range(rng.randrange(4))]
    out, files = [], {}
    for b in range(4):
        events = []
        for p in rng.sample([f"f{i}" for i in range(12)], 7):
            for at in range(rng.choice([1, 1, 2])):
                gone = rng.random() < 0.25
                events.append((p, 10 * b + at, gone or None, rng.choice(["x", "x", "y"]), None if gone else said()))
        out.append(events)
        for p, _, gone, corpus, words in sorted(events, key=lambda e: e[1]):
            files.pop(p, None)
            if not gone:
                files[p] = (corpus, words)
    return out, files


def state(spark, base):
    token = {tuple(r) for r in maintain.table(spark, base, "token").select("corpus", "path", "utterance_order", "token_order", "speaker", "gloss").collect()}
    frequency = {(r.corpus, r.speaker, r.gloss): r.n for r in maintain.table(spark, base, "frequency").collect()}
    return token, frequency


def test_stream_equals_rebuild(spark, tmp_path, batches):
    events, files = batches
    folder = f"file://{tmp_path}/events"
    for e in events:
        spark.createDataFrame(e, maintain.EVENT).coalesce(1).write.mode("append").parquet(folder)
    ingest.run(ingest.files(spark, folder, maintain.EVENT, maxFilesPerTrigger=1), f"{tmp_path}/state", maintain.writer(f"{tmp_path}/out", 4))
    assert state(spark, f"{tmp_path}/out") == rebuilt(files)
    sums = {(r.corpus, r.speaker): (r.num_utterances, r.num_tokens) for r in maintain.summaries(spark, f"{tmp_path}/out", ["corpus", "speaker"]).collect()}
    want = {}
    for corpus, said in files.values():
        for _, who, words in said:
            n, t = want.get((corpus, who), (0, 0))
            want[corpus, who] = (n + 1, t + sum(w is not None for w in words))
    assert sums == want


def test_repeated_and_compacted_batches(spark, tmp_path, batches):
    """A batch that runs again leaves the same tables; a compacted state is the same, smaller, and can be gone on from."""
    events, files = batches
    frames = [spark.createDataFrame(e, maintain.EVENT) for e in events]
    write = maintain.writer(f"{tmp_path}/out", 4)
    for i, f in enumerate(frames[:3]):
        write(f, i)
    write(frames[2], 2)
    maintain.compacted(spark, f"{tmp_path}/out", f"{tmp_path}/compact")
    assert state(spark, f"{tmp_path}/out") == state(spark, f"{tmp_path}/compact")
    assert spark.read.parquet(f"{tmp_path}/compact/token").count() <= spark.read.parquet(f"{tmp_path}/out/token").count()
    for base in ("out", "compact"):
        maintain.writer(f"{tmp_path}/{base}", 4)(frames[3], 3)
        assert state(spark, f"{tmp_path}/{base}") == rebuilt(files)


def test_few_rows_for_a_small_change(spark, tmp_path):
    """A word changed in a long file is one row out and one row in; a removal of an unknown file is none."""
    said = [(i, "CHI", ["w"] * 100) for i in range(50)]
    write = maintain.writer(f"{tmp_path}/out", 4)
    write(spark.createDataFrame([("f", 1, False, "x", said)], maintain.EVENT), 0)
    said[7] = (7, "CHI", ["w"] * 99 + ["v"])
    write(spark.createDataFrame([("f", 2, False, "x", said), ("g", 2, True, None, None), (None, 2, False, "x", said)], maintain.EVENT), 1)
    log = spark.read.parquet(f"{tmp_path}/out/token").where("batch = 1").collect()
    assert sorted((r.utterance_order, r.token_order, r.gloss, r.n) for r in log) == [(7, 100, "v", 1), (7, 100, "w", -1)]
    assert {(r.gloss, r.n) for r in maintain.table(spark, f"{tmp_path}/out", "frequency").collect()} == {("w", 4999), ("v", 1)}
    write(spark.createDataFrame([], maintain.EVENT), 2)
    assert maintain.table(spark, f"{tmp_path}/out", "token").count() == 5000 and maintain.table(spark, f"{tmp_path}/none", "token").count() == 0
