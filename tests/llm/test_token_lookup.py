"""Requested documents read by ranges from token shards."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, "/opt/tokenizers")
public_tokenizers = pytest.importorskip("tokenizers")

from utterlake.llm import token_lookup, tokens  # noqa: E402

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def shards(spark, tmp_path_factory):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choice(["river", "stone", "Ünder", "42", "walks"]) for _ in range(rng.choice([0, 1, 30, 400])))) for i in range(300)]
    texts += [(300, "long " * 30_000), (301, None), (302, ""), (7, "a second seven"), (None, "unnamed")]
    out = f"file://{tmp_path_factory.mktemp('shards')}/t"
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    tokens.write_shards(df, out, VOCABULARY, frame_ids=1000, shard_rows=12, slice_bytes=4000)
    enc = public_tokenizers.Tokenizer.from_file(VOCABULARY)
    return out, {(i, t): enc.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts}


def files(out):
    return sorted(p for p in Path(out.removeprefix("file://")).glob("part-*") if p.stat().st_size)


def test_requested_documents_and_no_others(spark, shards):
    out, ids = shards
    assert len(files(out)) > 2
    wanted = [7, 7, 300, 301, 302, None, 9999, *range(50, 90)]
    got = token_lookup.requested(spark, out, spark.createDataFrame([(i, "x") for i in wanted], "k long, shard string"), "k").collect()
    want = sorted(v for (i, _), v in ids.items() if i in set(wanted) - {None})
    assert sorted(list(r.ids) for r in got) == want and all(len(r.ids) == r.n_tokens for r in got)
    assert {r.doc_id for r in got} == set(wanted) - {None, 9999} and sum(r.doc_id == 7 for r in got) == 2
    assert token_lookup.requested(spark, out, spark.createDataFrame([], "doc_id long")).count() == 0


def test_bytes_read(shards, monkeypatch):
    out, _ = shards
    monkeypatch.setattr(token_lookup, "TAIL", 64)
    path = max(files(out), key=lambda p: p.stat().st_size)
    content, seen = path.read_bytes(), []

    def read(offset, n):
        seen.append((offset, n))
        return content[offset : offset + n]

    whole, ranged = tokens.Shard(content), token_lookup.RangedShard(read, len(content))
    tail = len(content) - int(whole.at[-1])
    assert ranged.docs == whole.docs and sum(n for _, n in seen) <= tail + 64 + 9 + 12 * len(whole.at)
    for row in range(0, len(whole.docs), 5):
        seen.clear()
        assert ranged.ids(row).tolist() == whole.ids(row).tolist()
        assert sum(n for _, n in seen) <= sum(p["size"] for p in ranged.pieces(row))


def test_damage_elsewhere_does_not_matter(spark, shards, tmp_path):
    out, ids = shards
    path = next(p for p in files(out) if len(tokens.Shard(p.read_bytes()).at) > 4)
    content = bytearray(path.read_bytes())
    s = token_lookup.RangedShard(lambda a, n: bytes(content[a : a + n]), len(content))
    last = s.docs[-1]
    hit = {p["frame"] for p in s.pieces(len(s.docs) - 1)}
    own = next(f for f in range(len(s.at) - 1) if f not in hit)
    for i in range(int(s.at[own]) + 8, int(s.at[own]) + 40):
        content[i] ^= 0xFF
    (tmp_path / path.name).write_bytes(content)
    ask = lambda k: token_lookup.requested(spark, f"file://{tmp_path}", spark.createDataFrame([(k,)], "doc_id long")).collect()
    assert list(ask(last)[0].ids) in [v for (i, _), v in ids.items() if i == last]
    broken = next(d for k, d in enumerate(s.docs) if d is not None and own in {p["frame"] for p in s.pieces(k)})
    with pytest.raises(Exception, match="(?i)damaged|zstd|decompress"):
        ask(broken)
