"""Token getters with and without an index of glosses."""

import pytest
from pyspark.sql import functions as F

from utterlake import api
from utterlake.sources import tables

PATTERNS = [["th%"], ["%1", "a_7"], ["none"], ["%"], ["*"], ["w\\%%"], ["A%"], "w6"]


@pytest.fixture
def release(spark, tmp_path):
    base = f"file://{tmp_path}"
    word = F.concat(F.element_at(F.array(*map(F.lit, ("w", "th", "a", "w%", "A", "é"))), (F.col("id") % 6 + 1).cast("int")), (F.col("id") % 40).cast("string"))
    rows = spark.range(6000).select(F.col("id"), F.when(F.col("id") % 11 > 0, word).alias("gloss"), (F.col("id") % 3).alias("corpus_id"), F.when(F.col("id") % 2 == 0, "Mother").alias("speaker_role"))
    tables.write_table(rows, base, "1", "token")
    return api.Release(spark, base, "1"), rows


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_index_gives_the_same_tokens(spark, release, monkeypatch):
    r, _ = release
    want = [(ids(r.tokens(p)), ids(r.tokens(p, role="Mother"))) for p in PATTERNS]
    assert r.glosses() is None and [len(a) > 0 for a, _ in want] == [p != ["none"] for p in PATTERNS]
    index = r.index_glosses()
    assert index.count() == r.table("token").select("gloss").where("gloss IS NOT NULL").distinct().count() and r.glosses() is not None
    for few in (0, api.FEW):
        monkeypatch.setattr(api, "FEW", few)
        assert [(ids(r.tokens(p)), ids(r.tokens(p, role="Mother"))) for p in PATTERNS] == want
        assert r.tokens("th%").columns == r.tokens("*").columns


def test_stale_index_is_not_used(spark, release):
    r, rows = release
    r.index_glosses()
    tables.write_table(rows.withColumn("gloss", F.concat(F.lit("new"), "gloss")), r.base, r.version, "token")
    assert r.glosses() is None and len(ids(r.tokens("newth%"))) == len(ids(rows.where("gloss LIKE 'th%'")))
    r.index_glosses()
    assert r.glosses() is not None and r.tokens("th%").count() == 0 and r.tokens("newth%").count() > 0


def test_filters_reach_the_scan(spark, release, monkeypatch):
    r, _ = release
    r.index_glosses()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    few = plan(r.tokens("th3%"))
    assert "Join" not in few and "PushedFilters: [In(gloss" in few
    monkeypatch.setattr(api, "FEW", 0)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        many = plan(r.tokens("th3%"))
        assert "LeftSemi" in many and "might_contain" in many
    finally:
        for k in settings:
            spark.conf.unset(k)
