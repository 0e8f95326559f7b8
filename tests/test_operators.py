import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from utterlake.operators import build, identity, quality
from utterlake.streaming import ingest


def files(spark, rows):
    return spark.createDataFrame(rows, "corpus string, path string, name string, truth string")


def test_rules(spark):
    rows = [
        *[("dirs", p, None, t) for p, t in (("Adam/020304.cha", "1"), ("Adam/020318.cha", "1"), ("Eve/010600.cha", "2"), ("Sarah/1.cha", None))],
        *[("alpha", p, None, t) for p, t in (("a01.cha", "1"), ("a02.cha", "1"), ("b01.cha", "2"))],
        *[("coded", p, None, None) for p in ("020304.cha", "020318.cha")],
        *[("named", p, n, None) for p, n in (("x1.cha", "Ann"), ("x2.cha", "Bob"))],
        *[("messy", p, None, t) for p, t in (("q1.cha", "1"), ("q1.cha2", "2"), ("q2.cha", "1"))],
    ]
    got = {r.corpus: r for r in identity.learn(files(spark, rows)).collect()}
    assert (got["dirs"].rule, got["dirs"].passed) == ("subdir1", True) and got["alpha"].rule == "alpha_prefix"
    assert not got["messy"].passed or got["messy"].rule in ("file", "stem", "before_last_sep")
    rules = {r.corpus: r.rule for r in identity.rules(files(spark, rows)).collect()}
    assert rules["coded"] == "single" and rules["named"] == "name2026"
    keys = {(r.corpus, r.path): r.key for r in identity.assign(files(spark, rows)).collect()}
    assert keys["dirs", "Adam/020318.cha"] == "truth:1" and keys["dirs", "Sarah/1.cha"] == "rule:Sarah" and keys["named", "x1.cha"] == "rule:Ann"


def test_imperfect_rules_and_examples(spark):
    rows = [("m", p, None, t) for p, t in (("a/1.cha", "x"), ("a/1.xml", "y"), ("b/1.cha", "y"), ("b/1.xml", "x"))]
    got = identity.learn(files(spark, rows).withColumn("path", F.lit("a/1.cha"))).first()
    assert not got.passed and 0 < got.score < 1 and round(got.score, 4) == got.score
    assert identity.examples(files(spark, rows).withColumn("path", F.lit("a/1.cha"))).count() == 3


def test_matching(spark):
    new = spark.createDataFrame([("P1", "s", "c", "x/1.cha"), (None, "s", "c", "x/2.cha"), (None, "s", "c", "x/3.cha")], "pid string, source string, corpus_name string, path string")
    old = spark.createDataFrame([(1, "P1", "s", "c", "1.cha", "A"), (2, None, "s", "c", "2.xml", "B"), (3, None, "s", "c", "3.xml", "C"), (4, None, "s", "c", "y/3.xml", "D")], "id long, pid string, source string, corpus_name string, filename string, child string")
    fixes = spark.createDataFrame([(2, "Z")], "transcript_id long, new_child_id string")
    assert {r.path: r.truth for r in identity.matched(new, old, fixes).collect()} == {"x/1.cha": "A", "x/2.cha": "Z", "x/3.cha": None}


def test_release_differences(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, None, 3.0)], "id long, s string, d double")
    b = spark.createDataFrame([(1, "x", 1.0), (2, "z", None), (4, "w", 4.0)], "id long, s string, d double")
    assert quality.changed_values(a, a, ["id"]).count() == 0 and quality.changed_rows(a, a, ["id"], ["s"]).where("status <> 'same'").count() == 0
    assert {(r.id, r["column"], r.old, r.new) for r in quality.changed_values(a, b, ["id"]).collect()} == {(2, "s", "y", "z"), (2, "d", "2.0", None)}
    assert {(r.id, r.status) for r in quality.changed_rows(a, b, ["id"], ["s"]).collect()} == {(1, "same"), (2, "changed"), (3, "only_old"), (4, "only_new")}
    pairs = spark.createDataFrame([(i,) for i in (1, 3, 4, 9)], "id long")
    assert {(r.id, r.empty) for r in quality.emptiness(pairs, a, b, "id").collect()} == {(1, "neither"), (3, "new"), (4, "old"), (9, "both")}
    assert [r.id for r in quality.orphans(a, "id", b).orderBy("id").collect()] == [3]
    assert quality.same_values(a.select("id"), a.select("id").union(a.select("id"))) and not quality.same_values(a.select("id"), b.select("id"))


def test_scores(spark):
    df = spark.createDataFrame([("g", "n", "n"), ("g", "n", "v"), ("g", "v", "v"), ("h", "adj", "n"), ("h", "n", "n")], "grp string, gold string, pred string")
    m = {r.gold: (r.n, r.v) for r in quality.confusion(df, "gold", "pred", ["n", "v"], normalize=True).collect()}
    assert m["n"] == (pytest.approx(2 / 3), pytest.approx(1 / 3)) and m["adj"] == (1.0, 0.0)
    r = quality.micro_scores(df, "gold", "pred").first()
    assert (r.precision, r.recall) == (pytest.approx(3 / 5), pytest.approx(3 / 4))
    got = {r.grp: (r.precision, r.recall) for r in quality.scores_by_group(df, "grp", "gold", "pred").collect()}
    assert got["h"] == (0.5, 1.0) and got["g"] == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    loose = {r.grp: r.precision for r in quality.scores_by_group(df, "grp", "gold", "pred", fixed=False).collect()}
    assert loose["h"] == pytest.approx(2 / 3)


def plain_keys(path, name):
    """Rules in order of preference with their keys of a file, in plain Python."""
    parts = path.split("/")
    stem = re.sub(r"(?s)(.)\.[^.]*$", r"\1", parts[-1])
    found = lambda p: m.group() if (m := re.search(p, stem)) else None
    one = parts[0] if len(parts) > 1 else None
    both = lambda b: None if one is None or b is None else f"{one}|{b}"
    alpha, digits, tail = found(r"^[A-Za-z]+"), found(r"^[0-9]+"), found(r"[0-9]+$")
    before = re.match(r"^(.*)[_-][^_-]+$", stem)
    out = [("subdir1", one), ("subdir2", "/".join(parts[:2]) if len(parts) > 2 else None), ("alpha_prefix", alpha), ("stem", stem), ("digit_prefix", digits), ("digit_suffix", tail)]
    out += [("before_last_sep", before.group(1) if before else None), ("subdir1+alpha_prefix", both(alpha)), ("subdir1+digit_prefix", both(digits)), ("subdir1+digit_suffix", both(tail)), ("subdir1+stem", both(stem))]
    out += [(f"prefix{k}", stem[:k] if len(stem) >= k else None) for k in (6, 5, 4, 3, 2)]
    return [*out, ("name2026", name), ("file", path), ("single", "corpus_child")]


def plain_learn(rows):
    """Rule, passed, score of each corpus with known files, by trying every rule."""
    corpora = defaultdict(list)
    for corpus, path, name, truth in rows:
        corpora[corpus].append((dict(plain_keys(path, name)), name, truth))
    order = [r for r, _ in plain_keys("x", None)]
    out = {}
    for corpus, fs in corpora.items():
        known = [(k, t) for k, _, t in fs if t is not None]
        if not known:
            continue
        named = sum(n is not None for _, n, _ in fs) / len(fs) >= 0.95
        tried = []
        for i, rule in enumerate(order):
            pairs = [(k[rule], t) for k, t in known]
            purity = lambda side: sum(max([x[1 - side] for x in pairs if x[side] == v].count(w) for w in {x[1 - side] for x in pairs if x[side] == v}) for v in {x[side] for x in pairs}) / len(pairs)
            passes = None not in {k for k, _ in pairs} and len({k for k, _ in pairs}) == len({t for _, t in pairs}) == len(set(pairs))
            score = round((purity(0) + purity(1)) / 2, 4)
            place = -1 if rule == "name2026" and named else i
            n_keys = len({k[rule] for k, _, _ in fs})
            tried.append(((0, rule.startswith("prefix"), n_keys, place) if passes else (1, -score, place), rule, passes, 1.0 if passes else score))
        out[corpus] = min(tried)[1:]
    return out


def test_rules_by_trying_all(spark):
    """The choice of each corpus against plain Python, over corpora that call for different rules."""
    rng = random.Random(12)
    kids = ["Adam", "Eve", "Sarah"]
    shapes = {
        "dirs": lambda k, i: f"{k}/{i:06d}.cha", "deep": lambda k, i: f"lab/{k}/{i:04d}.cha", "alpha": lambda k, i: f"{k[:3].lower()}{i}.cha",
        "digits": lambda k, i: f"{kids.index(k) + 1}{'ab'[i % 2]}{chr(99 + i)}.cha", "suffix": lambda k, i: f"{'xyzw'[i % 4]}{chr(97 + i)}{kids.index(k) + 10}.cha", "sep": lambda k, i: f"0{kids.index(k)}x_{i}.cha",
        "two": lambda k, i: f"{'ab'[kids.index(k) % 2]}/{k[0]}{i}.cha", "prefix": lambda k, i: f"9{k[:2]}{'pqrs'[i % 4]}{i}.cha", "none": lambda k, i: f"{i}.cha",
        "noise": lambda k, i: f"{rng.choice(kids)}/{rng.choice('ab')}{i}.cha", "named": lambda k, i: f"{i}z.cha",
        "bare": lambda k, i: f"{k.lower()}{'' if i % 4 else 'q'}{i}.cha", "fewest": lambda k, i: f"{k.lower()}{'' if i % 4 else 'q'}{i}_{kids.index(k) + 10}.cha",
    }
    rows = []
    for corpus, shape in shapes.items():
        for i in range(14):
            kid = kids[i % 3]
            rows.append((corpus, shape(kid, i), kid if corpus == "named" else None, kid if i % 4 else None))
    rows.append(("unknown", "a/b.cha", None, None))
    got = {r.corpus: (r.rule, r.passed, r.score) for r in identity.learn(files(spark, rows)).collect()}
    want = plain_learn(rows)
    assert got == want
    assert len({rule for rule, _, _ in want.values()}) >= 5


def test_counts(spark):
    df = spark.createDataFrame([("  12 dog\n   3 the\nTotal\n",)], "out string").select(F.explode(quality.unigram_counts(F.col("out"))).alias("x")).select("x.*")
    assert [(r.word, r.n) for r in df.collect()] == [("dog", 12), ("the", 3)]
    votes = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("a", "y", 4), ("a", "x", 2), ("b", None, 1)], "k string, v string, o int")
    assert [tuple(r) for r in quality.majority(votes, ["k"], "v", "o").collect()] == [("a", "y")]
    elements = spark.createDataFrame([("mor",), ("zz",)], "element string")
    assert [r.read for r in quality.schema_coverage(elements, "find('mor')").orderBy("element").collect()] == [True, False]


def test_streams_equal_batches(spark, tmp_path):
    rows = spark.createDataFrame([(i % 7, f"p{i % 5}", float(i % 4)) for i in range(60)], "who long, pid string, age double")
    rows.limit(30).write.parquet(f"{tmp_path}/in")
    stream = lambda: ingest.files(spark, f"{tmp_path}/in", rows.schema)
    first = lambda: ingest.to_parquet(ingest.first_pids(stream()).select("pid"), f"{tmp_path}/out", f"{tmp_path}/s1")
    ages = lambda: ingest.run(ingest.age_ranges(stream(), ["who"], "age"), f"{tmp_path}/s2", ingest.upsert(f"{tmp_path}/ages", ["who"]), "update")
    first()
    ages()
    rows.subtract(rows.limit(0)).write.mode("append").parquet(f"{tmp_path}/in")
    assert sorted(r.pid for r in first().collect()) == sorted({f"p{i}" for i in range(5)})
    ages()
    everything = spark.read.parquet(f"{tmp_path}/in")
    known = F.when(F.col("age") > 0, F.col("age"))
    want = everything.groupBy("who").agg(F.min(known).alias("min_age"), F.max(known).alias("max_age"))
    assert sorted(map(tuple, ingest.latest(spark, f"{tmp_path}/ages", ["who"]).select("who", "min_age", "max_age").collect())) == sorted(map(tuple, want.collect()))


def test_event_time(spark, tmp_path):
    spark.sql("SELECT timestamp'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 7) AS ts, id % 2 AS k FROM range(40)").write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    for name, df in (("w", ingest.windows(ingest.files(spark, f"{tmp_path}/in", schema), "ts", "1 hour")), ("s", ingest.sessions(ingest.files(spark, f"{tmp_path}/in", schema), "ts", "30 minutes", ["k"]))):
        got = []
        ingest.run(df, f"{tmp_path}/{name}", lambda b, _, got=got: got.extend(b.collect()), "append")
        assert all(r.n > 0 for r in got)


def test_full_block_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(build, "BLOCK", 10)
    rows = spark.createDataFrame([(i % 2, f"f{i % 3}", i) for i in range(18)], "c int, path string, n int")
    got = build.numbered(rows.where("n < 12"), F.col("c"), "path", "n")
    assert sorted(r.id for r in got.where("c = 0").collect()) == list(range(11, 17))
    assert build.block_usage({"t": got}).collect() == [("t", 6, True)]
    assert build.block_usage({"t": build.numbered(rows, F.col("c"), "path", "n")}).collect() == [("t", 9, False)]
    with pytest.raises(Exception, match="block of ids is full"):
        build.numbered(rows.withColumn("c", F.lit(0)), F.col("c"), "path", "n").collect()


def test_numbering_by_file_equals_numbering_by_corpus(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(c, f"{c}/f{f}", n) for c in range(3) for f in range(9) for n in range(rng.randrange(5))], "c int, path string, n int")
    sizes = rows.groupBy(F.col("c").alias("block"), "path").agg(F.count("*").alias("n"))
    a, b = (sorted(map(tuple, build.numbered(rows, F.col("c"), "path", "n", sizes=s).select("path", "n", "id").collect())) for s in (None, sizes))
    assert a == b
