import random
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from utterlake.functions import lexical as L


def one_way(words):
    factors, tokens, types, ratio = 0.0, 0, set(), 1.0
    for w in words:
        tokens += 1
        types.add(w)
        ratio = len(types) / tokens
        if ratio <= 0.72:
            factors, tokens, types, ratio = factors + 1, 0, set(), 1.0
    if tokens:
        factors += (1 - ratio) / (1 - 0.72)
    return len(words) / factors if factors > 0 else -1.0


def plain_mtld(words):
    return None if len(words) < 50 else (one_way(words) + one_way(words[::-1])) / 2


def plain_hdd(words):
    n = len(words)
    return None if n < 50 else sum((1 - comb(n - c, 42) / comb(n, 42)) / 42 for c in Counter(words).values())


def test_against_plain_python(spark):
    rng = random.Random(3)
    rows = [[f"w{int(rng.expovariate(1 / v))}" for _ in range(n)] for n in (0, 1, 49, 50, 51, 120, 700) for v in (3, 30)]
    rows += [["a"] * 50, [str(i) for i in range(50)]]
    got = spark.createDataFrame([(i, w) for i, w in enumerate(rows)], "i int, w array<string>").select("i", L.mtld(F.col("w")), L.hdd(F.col("w"))).collect()
    for i, m, h in got:
        assert m == (None if plain_mtld(rows[i]) is None else pytest.approx(plain_mtld(rows[i])))
        assert h == (None if plain_hdd(rows[i]) is None else pytest.approx(plain_hdd(rows[i])))
    assert got[-2][1] == pytest.approx(2.0) and got[-2][2] == pytest.approx(1 / 42)
    assert got[-1][1] == -1.0 and got[-1][2] == pytest.approx(1.0)


def test_reader_mlu(spark):
    w = lambda *pairs: [{"word": a, "pos": b} for a, b in pairs]
    u = [w(("go-PAST", "v"), ("home", "n")), w(("go-PAST", "v"), ("home", "n")), [], w(("xx", "unk")), w(("oh", "co"), ("yes", "adv")), w(("it", None))]
    got = spark.createDataFrame([(u,), ([],)], "u array<array<struct<word:string,pos:string>>>").select(L.reader_mlu(F.col("u"))).collect()
    # 3 morphemes and one utterance; the filler utterances add 2 - 1 and 1 - 1 morphemes and no utterance
    assert [r[0] for r in got] == [pytest.approx(4.0), 0.0]
