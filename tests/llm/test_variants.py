"""SimHash components, spelling variants and importance resampling against brute force, with nulls, empties, ties, repeats and clashing columns."""

import math
import os
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from utterlake.llm import queries, resample, simhash, spelling
from utterlake.llm.common import ship

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def components(links, ids):
    """Smallest id that links reach, of pairs of positions."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        root[find(a)] = find(b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def plain_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    runs = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


ODD = [None, "", " \t\n", "one", "ONE", "two words", "a b c d", "A\x0bb  C\x0cd", "é è ê ÉÈ", "x\x00y z\x00 w v", "so " * 20_000, "w " * 4 + "end", "y" * 100_000, "a b c d"]


def test_fingerprints(spark):
    rng = random.Random(1)
    texts = [*ODD, *(" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 60))) for _ in range(50))]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, fp string, key int")
    got = {r.doc_id: r.fp % 2**64 for r in simhash.fingerprints(docs).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def near_points(rng, centres, n, most):
    """Fingerprints a few bits from a few centres, and bits between them."""
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.randrange(most)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("bucket,pairs", [(16_384, 32), (16_384, 2), (40, 8), (6, 2)])
def test_links_of_fingerprints(spark, bucket, pairs):
    """All components, whether buckets list pairs, span forests, are cut again or dealt in chunks."""
    rng = random.Random(bucket)
    centres = [rng.getrandbits(64) for _ in range(3)] + [0, 2**64 - 1]
    for step in (5, 6, 9):
        centres.append(centres[0] ^ sum(1 << b for b in rng.sample(range(64), step)))
    fps = near_points(rng, centres, 400, 6) + [rng.getrandbits(64) for _ in range(50)]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    want = components(links, list(range(len(fps))))
    assert len(set(want)) > 60
    classes = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    edges = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(classes, 4, bucket, pairs).collect()]
    at = {f: i for i, f in enumerate(fps)}
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    assert components([(at[a], at[b]) for a, b in edges], list(range(len(fps)))) == want
    if pairs >= 32 and bucket > len(fps):
        assert len(edges) <= len(links) * 1.05, "pairs come once"


@pytest.mark.parametrize("reach", [0, 1, 3, 7])
def test_links_at_other_distances(spark, reach):
    rng = random.Random(reach)
    fps = near_points(rng, [rng.getrandbits(64) for _ in range(12)], 200, reach + 2)
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= reach]
    classes = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    at = {f: i for i, f in enumerate(fps)}
    got = [(at[r.a % 2**64], at[r.b % 2**64]) for r in simhash.links(classes, reach).collect()]
    assert components(got, list(range(len(fps)))) == components(links, list(range(len(fps))))


def brute(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    return Counter((d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, components(near, [d for d, _ in rows])))


def test_components_of_odd_documents(spark):
    rows = [*enumerate(ODD, 5), (None, "none"), (None, "none"), (5, "again"), (5, "again"), (900, "none")]
    docs = spark.createDataFrame([(*r, "c", 3) for r in rows], "doc_id long, text string, component_id string, fp int")
    assert Counter(map(tuple, simhash.near_fingerprints(docs).collect())) == brute(rows)
    assert simhash.near_fingerprints(docs.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
def test_op11_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert Counter(map(tuple, queries.op11_fingerprints(spark, SF).collect())) == brute(rows)


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, noise=None):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    form, near = {}, {}
    for w in n:
        others = [x for x in n if one_apart(w, x)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n[w], near[w], form[w], n.get(form[w]), root))
    return out


@pytest.mark.parametrize("noise", [None, 3])
def test_spelling(spark, noise):
    """Chains of forms, ties, transpositions (two apart), repeated letters, letters beyond ASCII, words of many letters."""
    long = "abcdefghij" * 300
    words = {"letter": 700, "lettr": 9, "leter": 6, "letters": 30, "leters": 6, "lettesr": 5, "mitten": 25, "mittens": 5, "kitten": 25, "bitten": 125, "ÀÉéèçàü": 5, "Éàéèçàü": 60, "éàéèçàü": 9,
             "aaaaaa": 5, "aaaaaaa": 25, "baaaaaa": 125, "baaaaab": 625, "×÷×÷×÷": 7, long: 50, long[:1500] + long[1501:]: 5, long + "k": 5, "x" + long[2:]: 5, "rare": 90, "sixsix": 4}
    rng = random.Random(2)
    bag = [w if rng.random() < 0.7 or len(w) > 99 else w.upper() if w.isascii() else w for w, c in words.items() for _ in range(c)]
    rng.shuffle(bag)
    rows = [(i, rng.choice([" ", "-", "1", "\n"]).join(bag[a : a + 100])) for i, a in enumerate(range(0, len(bag), 100))] + [(None, "letter letter"), (7, None), (8, ""), (9, "letter"), (9, "letter")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, word int")
    got = spelling.variants(docs, noise=noise).select("word", "n", "n_near", "form", "form_n", "root").collect()
    want = plain_variants(rows, noise)
    assert len(got) == len(want) and set(map(tuple, got)) == want
    if noise is None:
        assert ("leters", 6, 1, "letters", 30, "letter") in want  # a chain of two
    assert spelling.variants(docs.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
def test_op12_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op12_spelling(spark, SF).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert set(map(tuple, got)) == plain_variants(rows, 199)


def plain_resample(rows, target):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return len(words), Counter(zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1))

    docs = [features(t) for _, t in rows]
    s, t = (sum((f for _, f in x), Counter()) for x in (docs, [features(x) for x in target]))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in s}
    out = []
    for (d, _), (n, f) in zip(rows, docs):
        weight = sum(gain[b] * c for b, c in f.items())
        h = int(sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((i for i, r in enumerate(out) if r[4] >= 20), key=lambda i: (-out[i][3], out[i][0] is None, out[i][0], out[i][2]))
    rank = {i: p + 1 for p, i in enumerate(able[: 5 * len(able) // 100])}
    return Counter((*r[:4], rank.get(i)) for i, r in enumerate(out))


@pytest.mark.parametrize("docs_a_block,features,split", [(1 << 14, 4_000_000, 4096), (1100, 2000, 2)])
def test_resampling(spark, monkeypatch, docs_a_block, features, split):
    """Weights and ranks, in one block or many; a document of one word many times, ties, repeats."""
    monkeypatch.setattr(resample, "BLOCK_DOCS", docs_a_block)
    monkeypatch.setattr(resample, "BLOCK_FEATURES", features)
    monkeypatch.setattr(resample, "SPLIT", split)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "日本", "X9"]
    texts = [" ".join(rng.choice(words[: rng.choice([20, 304])]) for _ in range(rng.choice([0, 1, 2, 19, 20, 21, 90]))) for _ in range(400)]
    rows = [*enumerate(texts), *enumerate(ODD, 1000), (None, texts[5]), (None, texts[5]), (3, texts[3]), (2000, "the " * 30_000), (2001, "w1, w2;w3" * 50)]
    target = [" ".join(rng.choice(words[:40]) for _ in range(50)) for _ in range(20)] + [None, "", "one"]
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, block int, bucket string").repartition(3)
    got = resample.resample(docs, spark.createDataFrame([(i, t) for i, t in enumerate(target)], "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == plain_resample(rows, target)


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 20), (2, None)], "doc_id long, text string")
    got = resample.resample(docs, docs.limit(0), share=(50, 100))
    assert Counter(map(tuple, got.select("doc_id", "n_features").collect())) == Counter({(1, 40 + 39 + 38): 1, (2, 0): 1})
    assert resample.resample(docs.limit(0), docs).collect() == []


def test_ranks_over_partitions(spark):
    """Ranks run on over range partitions, also where many rows tie."""
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") * 7919 % 13).alias("score"))
    got = resample.ranks(rows.repartition(7), 1234, [F.desc("score"), F.asc("doc_id")]).collect()
    want = sorted(((-r.score, r.doc_id) for r in got))
    assert {r.doc_id: r.rank for r in got if r.rank} == {d: i + 1 for i, (_, d) in enumerate(want[:1234])} and len(got) == 5000


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
def test_op13_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert Counter(map(tuple, queries.op13_resampling(spark, SF).collect())) == plain_resample(rows, target)


def test_deletion_keys_meet():
    """Words at distance one share a key; no word has a key twice."""
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 3, n)) for n in rng.integers(1, 9, 300)] + ["é" * 7, "é" * 8]
    keys, number = spelling.deletion_keys(words)
    of = [set(keys[number == i].tolist()) for i in range(len(words))]
    assert sum(map(len, of)) == len(keys)
    assert all(of[i] & of[j] for i in range(len(words)) for j in range(i) if one_apart(words[i], words[j]))
