"""Queries that compare releases and keep them up to date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.operators import release_diff
from utterlake.plans.adapters import UTT, table, utt
from utterlake.plans.catalogue import query
from utterlake.session import scratch_dir
from utterlake.sources import append, keyset, sqlite, tables
from utterlake.streaming import ingest, maintain, state

PATH = ("collection", "corpus", "transcript")
ARRAY = "array<struct<order:int,speaker:string,tokens:array<string>>>"


def two_releases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events as rows of transcripts (a type's events of a user), before and after edits.

    In two types rows are left out, added and changed, but for one corpus; of two others a corpus goes, or changes its name.
    """
    events = table(spark, sf_dir, "events")
    names = [F.col("event_type").alias("collection"), F.concat(F.lit("c"), F.col("user_id") % 10).alias("corpus"), F.concat(F.lit("u"), "user_id").alias("transcript")]
    old = events.select(*names, "event_id", F.col("event_id").cast("double").alias("place"), "ts", "value", "props")
    edited = F.col("collection").isin("click", "view") & (F.col("corpus") != "c3")
    k = F.col("event_id")
    changed = edited & (k % 83 == 2)
    kept = old.where(~(edited & (k % 97 == 0)) & ~((F.col("collection") == "signup") & (F.col("corpus") == "c7")))
    kept = kept.withColumns(
        {
            "corpus": F.when((F.col("collection") == "purchase") & (F.col("corpus") == "c5"), "new").otherwise(F.col("corpus")),
            "props": F.when(changed & (k % 166 == 2), F.lit(None)).otherwise(F.col("props")),
            "value": F.when(changed, F.col("value") + 1).otherwise(F.col("value")),
        }
    )
    added = old.where(edited & (k % 89 == 1)).withColumns({"place": F.col("place") + 0.5, "value": -1 - F.col("value")})
    return old, kept.unionByName(added)


_TWO = """
o AS (SELECT event_type AS c1, 'c' || user_id % 10 AS c2, 'u' || user_id AS c3, event_id AS k, event_id::DOUBLE AS place, ts, value, props FROM events),
e AS (SELECT *, c1 IN ('click', 'view') AND c2 <> 'c3' AS edited FROM o),
a AS (
  SELECT 0 AS side, c1, c2, c3, place, ts, value, props,
    NOT (edited AND (k % 97 = 0 OR k % 83 = 2)) AND NOT (c1 = 'signup' AND c2 = 'c7') AND NOT (c1 = 'purchase' AND c2 = 'c5') AS m FROM e
  UNION ALL SELECT 1, c1, CASE WHEN c1 = 'purchase' AND c2 = 'c5' THEN 'new' ELSE c2 END, c3, place, ts,
    CASE WHEN edited AND k % 83 = 2 THEN value + 1 ELSE value END, CASE WHEN edited AND k % 166 = 2 THEN NULL ELSE props END,
    NOT (edited AND k % 83 = 2) AND NOT (c1 = 'purchase' AND c2 = 'c5')
  FROM e WHERE NOT (edited AND k % 97 = 0) AND NOT (c1 = 'signup' AND c2 = 'c7')
  UNION ALL SELECT 1, c1, c2, c3, place + 0.5, ts, -1 - value, props, false FROM e WHERE edited AND k % 89 = 1)"""


def stored_trees(spark: SparkSession, old: DataFrame, new: DataFrame) -> list[DataFrame]:
    """Hash trees of two releases, written next to them and read back."""
    base, columns = scratch_dir(spark), release_diff.compared(old, new, PATH, "place")
    for version, rows in (("2025.1", old), ("2026.1", new)):
        tables.write_table(release_diff.tree(rows, PATH, "place", columns), base, version, "hash_tree", None)
    return [tables.read_table(spark, base, version, "hash_tree") for version in ("2025.1", "2026.1")]


@query(f"""WITH {_TWO},
g AS (
  SELECT c1, c2, c3, count(*) FILTER (side = 0) AS n_old, count(*) FILTER (side = 1) AS n_new, bool_or(NOT m) AS d, 3 - grouping(c1) - grouping(c2) - grouping(c3) AS level
  FROM a GROUP BY GROUPING SETS ((), (c1), (c1, c2), (c1, c2, c3))),
s AS (SELECT *, CASE WHEN n_old = 0 THEN 'only_new' WHEN n_new = 0 THEN 'only_old' WHEN d THEN 'changed' END AS status FROM g)
SELECT x.level::INTEGER AS level, x.c1 AS collection, x.c2 AS corpus, x.c3 AS transcript, x.status, nullif(x.n_old, 0) AS n_old, nullif(x.n_new, 0) AS n_new
FROM s x LEFT JOIN s p ON p.level = x.level - 1 AND (x.level < 2 OR p.c1 = x.c1) AND (x.level < 3 OR p.c2 = x.c2)
WHERE x.status IS NOT NULL AND (x.level = 0 OR p.status = 'changed')""")
def release_tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that differ between two releases, found by their stored hash trees, from the whole down to transcripts."""
    nodes = release_diff.differing(*stored_trees(spark, *two_releases(spark, sf_dir)), len(PATH))
    values = F.from_json("key", "array<string>")
    return nodes.select("level", *[F.get(values, F.lit(i)).alias(c) for i, c in enumerate(PATH)], "status", "n_old", "n_new")


@query(f"""WITH {_TWO},
b AS (SELECT * FROM a WHERE (c1, c2, c3) IN (SELECT (c1, c2, c3) FROM a GROUP BY c1, c2, c3 HAVING min(side) = 0 AND max(side) = 1)),
p AS (SELECT *, row_number() OVER t AS pos, count(*) FILTER (m) OVER t AS gap FROM b WINDOW t AS (PARTITION BY side, c1, c2, c3 ORDER BY place)),
l AS (SELECT *, row_number() OVER (PARTITION BY side, c1, c2, c3, gap ORDER BY pos) AS k FROM p WHERE NOT m),
x AS (SELECT * FROM l WHERE side = 0),
y AS (SELECT * FROM l WHERE side = 1)
SELECT coalesce(x.c1, y.c1) AS collection, coalesce(x.c2, y.c2) AS corpus, coalesce(x.c3, y.c3) AS transcript,
  CASE WHEN x.k IS NULL THEN 'only_new' WHEN y.k IS NULL THEN 'only_old' ELSE 'changed' END AS status, x.pos AS old_n, y.pos AS new_n,
  CASE WHEN x.k IS NOT NULL AND y.k IS NOT NULL THEN concat_ws(',', CASE WHEN x.ts IS DISTINCT FROM y.ts THEN 'ts' END,
    CASE WHEN x.value IS DISTINCT FROM y.value THEN 'value' END, CASE WHEN x.props IS DISTINCT FROM y.props THEN 'props' END) END AS columns
FROM x FULL JOIN y ON x.c1 = y.c1 AND x.c2 = y.c2 AND x.c3 = y.c3 AND x.gap = y.gap AND x.k = y.k""")
def release_rows_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that differ within transcripts of two releases of unequal shape: an inserted row moves none behind it."""
    old, new = two_releases(spark, sf_dir)
    nodes = release_diff.differing(*stored_trees(spark, old, new), len(PATH))
    keys = nodes.where(f"level = {len(PATH)} AND status = 'changed'")
    rows = release_diff.changed_rows(old, new, PATH, "place", keys)
    values = F.from_json("key", "array<string>")
    return rows.select(*[F.get(values, F.lit(i)).alias(c) for i, c in enumerate(PATH)], "status", "old_n", "new_n", F.array_join("columns", ",").alias("columns"))


def _event_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three batches of events: conversations as they first were, with later changes and additions, and with removals."""
    turns = utt(spark, sf_dir).select("conv_id", F.struct(F.col("order").cast("int").alias("order"), F.col("role").alias("speaker"), "tokens").alias("u"))
    files = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("u")).alias("utterances"))
    k, us = F.col("conv_id"), F.col("utterances")
    small = F.transform(us, lambda u: F.struct(u["order"].alias("order"), u["speaker"].alias("speaker"), F.transform(u["tokens"], F.lower).alias("tokens")))
    users = F.filter(us, lambda u: u["speaker"] == "user")

    def event(where: Column, at: int, utterances: Column | None) -> DataFrame:
        gone = F.lit(utterances is None)
        return files.where(where).select(k.cast("string").alias("path"), F.lit(at).cast("long").alias("at"), gone.alias("removed"), F.concat(F.lit("c"), k % 3).alias("corpus"), (F.lit(None) if utterances is None else utterances).cast(ARRAY).alias("utterances"))

    batches = (
        [event(k % 4 != 3, 1, F.when(k % 5 == 0, F.slice(us, 1, 2)).otherwise(us))],
        [event(k % 4 == 3, 2, us), event(k % 5 == 0, 2, F.when(k % 10 == 0, small).otherwise(us)), event(k % 35 == 0, 1, None)],
        [event(k % 7 == 0, 3, users), event(k % 6 == 1, 4, None), event(k % 6 == 1, 3, small), event(k % 11 == 10, 4, us)],
    )
    return [reduce(DataFrame.unionByName, events) for events in batches]


def _maintained(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_dir(spark)
    for events in _event_batches(spark, sf_dir):  # what has come since the last run is a batch, of any number of files
        events.write.mode("append").parquet(f"{base}/events")
        ingest.run(ingest.files(spark, f"{base}/events", maintain.EVENT), f"{base}/state", maintain.writer(f"{base}/release", parts=8))
    return f"{base}/release"


_LEFT = f"""{UTT},
s AS (
  SELECT 'c' || conv_id % 3 AS corpus, role AS speaker, conv_id, ord,
    CASE WHEN conv_id % 10 = 0 AND conv_id % 7 <> 0 AND conv_id % 11 <> 10 THEN list_transform(tokens, lambda w: lower(w)) ELSE tokens END AS tokens
  FROM u WHERE conv_id % 6 <> 1 AND NOT (conv_id % 7 = 0 AND conv_id % 11 <> 10 AND role <> 'user'))"""


@query(f"WITH {_LEFT} SELECT corpus, speaker, gloss, count(*) AS n FROM (SELECT corpus, speaker, unnest(tokens) AS gloss FROM s) GROUP BY ALL")
def maintained_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word frequencies after three batches of added, changed and removed files, none of which built the table again."""
    return maintain.table(spark, _maintained(spark, sf_dir), "frequency")


@query(f"WITH {_LEFT} SELECT corpus, speaker, count(*) AS num_utterances, sum(len(tokens))::BIGINT AS num_tokens, round(sum(len(tokens)) / count(*), 6) AS mlu_w FROM s GROUP BY ALL")
def maintained_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of speakers after the same batches."""
    out = maintain.summaries(spark, _maintained(spark, sf_dir), ["corpus", "speaker"])
    return out.withColumn("mlu_w", F.round("mlu_w", 6))


@query("""WITH b AS (SELECT max(event_id) // 2 AS middle, max(ts) - INTERVAL 10 MINUTE AS mark FROM events),
l AS (SELECT user_id, epoch_us(ts) // 1000 AS t, 'late' AS status FROM events, b WHERE event_id <= middle AND event_id % 20 = 0 AND ts < mark),
o AS (SELECT user_id, epoch_us(ts) // 1000 AS t, lag(epoch_us(ts) // 1000) OVER w AS before, lead(epoch_us(ts) // 1000) OVER w AS behind FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, t, CASE WHEN before IS NULL OR t > before + 28800000 THEN 'first' ELSE 'repeat' END AS status FROM o),
x AS (SELECT user_id, t + 28800000 AS t, 'expired' AS status FROM o, b WHERE behind > t + 28800000 OR (behind IS NULL AND t + 28800000 <= epoch_us(mark) // 1000))
SELECT user_id::VARCHAR AS pid, t AS "at", status FROM (SELECT * FROM l UNION ALL SELECT * FROM s UNION ALL SELECT * FROM x)""")
def stream_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as PIDs that are forgotten after eight hours; the third batch repeats rows of the first, which come late and go to a table of their own."""
    base, events = scratch_dir(spark), table(spark, sf_dir, "events")
    middle = F.lit(events.agg(F.max("event_id")).first()[0] // 2)
    k = F.col("event_id")
    for part in (k <= middle, k > middle, (k <= middle) & (k % 20 == 0)):  # what has come since the last run is a batch, of any number of files
        events.where(part).write.mode("append").parquet(f"{base}/events")
        stream = ingest.files(spark, f"{base}/events", events.schema)
        ingest.run(state.sightings(stream, "user_id", "ts", 8 * 3600), f"{base}/state", state.tables(f"{base}/out"))
    return state.read(spark, f"{base}/out", "seen").unionByName(state.read(spark, f"{base}/out", "late"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey * 10 > 9 * m THEN o_orderkey * 1000000 ELSE o_orderkey END AS id, CASE WHEN o_orderkey <= m // 2 THEN 1 ELSE 2 END AS export
FROM orders, (SELECT max(o_orderkey) AS m FROM orders)""")
def keyset_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database table with uneven ids exported twice, the second time for its new rows alone. The database lies in the shared folder."""
    rows, base = table(spark, sf_dir, "orders").select("o_orderkey"), scratch_dir(spark)
    most = rows.agg(F.max("o_orderkey")).first()[0] or 0
    k = F.col("o_orderkey")
    rows = rows.withColumn("id", F.when(k * 10 > 9 * most, k * 1_000_000).otherwise(k))
    url = sqlite.new(f"{base}/database")
    sqlite.create(url, "orders", rows.schema, key="id")
    for batch, new in (("old", k <= most // 2), ("new", k > most // 2)):
        append.append_once(rows.where(new), url, "orders", batch, f"{base}/batches", 8)
        keyset.export_new(spark, url, "orders", '"id"', base, 8, {})
    number = F.dense_rank().over(W.orderBy("upto"))
    exports = keyset.exported(spark, base).select("upto").distinct().withColumn("export", number)  # a row for each export
    return keyset.exported(spark, base).join(exports, "upto").select("o_orderkey", "id", "export")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderkey % 3 AS batch FROM orders")
def appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table appended to a database in three batches, each of which comes twice. The database lies in the shared folder."""
    base, k = scratch_dir(spark), F.col("o_orderkey") % 3
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", k.alias("batch"))
    url = sqlite.new(f"{base}/database")
    for batch in (0, 1, 0, 2, 1, 2):
        append.append_once(rows.where(k == batch), url, "orders", f"batch {batch}", f"{base}/batches", 8)
    return keyset.read(spark, url, "orders", "rowid", 8, {})
