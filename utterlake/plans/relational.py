"""Queries of joins, sets, windows, aggregates and release comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.operators import build, morphology, quality
from utterlake.plans.adapters import table
from utterlake.plans.catalogue import query


@query("""SELECT r_name, n_name, c_mktsegment, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def denormalized_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with the names of their dimensions; nation and region have a fixed, small number of rows."""
    t = lambda n: table(spark, sf_dir, n)
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = t("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "n_name", "r_name")
    facts = t("lineitem").select("l_orderkey", "l_quantity").join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return facts.join(people, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name", "n_name", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SELECT doc_id, md5(text) AS pid FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS n FROM documents) WHERE n = 1")
def pid_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("pid"))
    return build.first_copies(rows, "source", "doc_id").select("doc_id", "pid")


@query("SELECT doc_id FROM documents WHERE source < 'src14' AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE source >= 'src14')")
def crossbank_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("pid"))
    return build.not_in_bank(rows.where("source < 'src14'"), rows.where("source >= 'src14'")).select("doc_id")


@query("SELECT doc_id, lang, source, EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id AND toxic = 1) AS toxic FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(labels, "doc_id", "left_semi")
    toxic = labels.where("toxic = 1").select("doc_id", F.lit(True).alias("toxic")).distinct()
    return rows.join(toxic, "doc_id", "left").withColumn("toxic", F.coalesce("toxic", F.lit(False)))


@query("""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'new' WHEN b.o_orderkey IS NULL THEN 'old' ELSE 'both' END AS side, a.o_totalprice AS old_price, b.o_totalprice AS new_price
FROM (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) a FULL JOIN (SELECT * FROM orders WHERE o_orderkey % 5 <> 0) b ON a.o_orderkey = b.o_orderkey""")
def release_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    both = quality.align(rows.where("o_orderkey % 3 <> 0"), rows.where("o_orderkey % 5 <> 0"), "o_orderkey")
    side = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "old").otherwise("both")
    return both.select("o_orderkey", side.alias("side"), F.col("old.o_totalprice").alias("old_price"), F.col("new.o_totalprice").alias("new_price"))


def _mutated(rows: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return rows.where(key % 50 != 0).withColumns({"c_acctbal": F.when(key % 20 == 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")), "c_name": F.when(key % 30 == 1, F.lit(None)).otherwise(F.col("c_name"))})


@query("""SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n,
  CASE WHEN c_custkey % 20 = 1 OR c_custkey % 30 = 1 THEN 'changed' ELSE 'same' END AS status FROM customer""")
def release_row_hash_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two releases compared by hash and position."""
    rows = table(spark, sf_dir, "customer")
    new = rows.where("c_custkey % 50 <> 0").unionByName(rows.where("c_custkey % 50 = 0"))
    key = F.col("c_custkey")
    new = new.withColumns({"c_acctbal": F.when(key % 20 == 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")), "c_name": F.when(key % 30 == 1, F.lit(None)).otherwise(F.col("c_name"))})
    out = quality.changed_rows(rows, new, ["c_nationkey"], ["c_custkey"])
    return out.select("c_nationkey", F.col("n").cast("long").alias("n"), "status")


@query("""SELECT c_custkey, 'c_acctbal' AS "column" FROM customer WHERE c_custkey % 50 <> 0 AND c_custkey % 20 = 1 UNION ALL SELECT c_custkey, 'c_name' FROM customer WHERE c_custkey % 50 <> 0 AND c_custkey % 30 = 1""")
def release_column_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return quality.changed_values(rows, _mutated(rows), ["c_custkey"]).select("c_custkey", "column")


@query("""WITH u AS (SELECT p_name, any_value(p_partkey) AS only_key FROM part GROUP BY p_name HAVING count(*) = 1)
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_partkey ELSE only_key END AS found FROM part LEFT JOIN u USING (p_name)""")
def fallback_lookup_unambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By key where there is one, else by a name that stands for one part only."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    alone = parts.groupBy("p_name").agg(F.count("*").alias("n"), F.min("p_partkey").alias("by_name")).where("n = 1").drop("n")
    direct = parts.where("p_partkey % 2 = 0").select("p_partkey", F.col("p_partkey").alias("by_key"))
    return parts.join(direct, "p_partkey", "left").join(alone, "p_name", "left").select("p_partkey", F.coalesce("by_key", "by_name").alias("found"))


IMPLICIT = """SELECT p_brand, count(*) AS n, sum(CASE WHEN l_quantity >= CAST(split_part(bounds, '-', 1) AS INT) AND l_quantity <= CAST(split_part(bounds, '-', 2) AS INT) THEN 1 ELSE 0 END) AS inside,
  sum(CASE WHEN p_type LIKE concat('%', word, '%') THEN 1 ELSE 0 END) AS named
FROM lineitem, (SELECT *, '10-30' AS bounds, substr(p_type, 1, 3) AS word FROM part) p WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND p_size > 20 GROUP BY p_brand"""


@query(IMPLICIT)
def implicit_join_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL as written: a comma join with equalities in WHERE, and checks of ranges and containment."""
    text = IMPLICIT.replace("FROM lineitem,", "FROM {lineitem},").replace("FROM part)", "FROM {part})")
    return spark.sql(text, lineitem=table(spark, sf_dir, "lineitem"), part=table(spark, sf_dir, "part"))


@query("""WITH l(code3, name, code1) AS (VALUES ('en', 'English', 'eng'), ('de', 'German', 'deu'), ('fr', 'French', 'fra')), m(code1, models) AS (VALUES ('eng', 3), ('deu', 2))
SELECT lang AS code, name, n, CASE WHEN models > 0 THEN 'yes' ELSE 'no' END AS has_model, round(n / (sum(n) OVER ())::DOUBLE, 6) AS share
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang) LEFT JOIN l ON lang = code3 LEFT JOIN m ON l.code1 = m.code1""")
def two_left_joins_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "documents").groupBy(F.concat(F.col("lang"), F.lit(" xxx")).alias("language")).agg(F.count("*").alias("n"))
    codes = spark.createDataFrame([("en", "English", "eng"), ("de", "German", "deu"), ("fr", "French", "fra")], "code3 string, name string, code1 string")
    models = spark.createDataFrame([("eng", 3), ("deu", 2)], "code1 string, models int")
    return quality.model_coverage(counts, codes, models).withColumn("share", F.round("share", 6))


@query("""WITH a AS (SELECT source, lang, count(DISTINCT doc_id) AS old_n FROM documents WHERE doc_id % 4 <> 0 GROUP BY ALL), b AS (SELECT source, lang, count(DISTINCT doc_id) AS new_n FROM documents WHERE doc_id % 3 <> 0 GROUP BY ALL)
SELECT source, lang, coalesce(old_n, 0) AS old_n, coalesce(new_n, 0) AS new_n, round(CASE WHEN coalesce(old_n, 0) > 0 THEN 100 * (coalesce(new_n, 0) - old_n) / old_n::DOUBLE END, 6) AS percent_change FROM a FULL JOIN b USING (source, lang)""")
def children_per_corpus_two_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    count = lambda df, name: df.groupBy("source", "lang").agg(F.countDistinct("doc_id").alias(name))
    both = count(rows.where("doc_id % 4 <> 0"), "old_n").join(count(rows.where("doc_id % 3 <> 0"), "new_n"), ["source", "lang"], "full_outer").fillna(0)
    return both.withColumn("percent_change", F.round(F.try_divide(100 * (F.col("new_n") - F.col("old_n")), F.col("old_n")), 6))


@query("""WITH a AS (SELECT l_suppkey, count(*) AS old_n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1), b AS (SELECT l_suppkey, count(*) AS new_n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
SELECT l_suppkey, coalesce(old_n, 0) AS old_n, coalesce(new_n, 0) AS new_n, coalesce(new_n, 0) - coalesce(old_n, 0) AS change, coalesce(new_n, 0) > coalesce(old_n, 0) AS grew FROM a FULL JOIN b USING (l_suppkey)""")
def tokens_per_child_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where("l_suppkey IS NOT NULL")
    count = lambda df, name: df.groupBy("l_suppkey").agg(F.count("*").alias(name))
    both = count(rows.where("l_linestatus = 'F'"), "old_n").join(count(rows.where("l_returnflag <> 'R'"), "new_n"), "l_suppkey", "full_outer").fillna(0)
    return both.withColumns({"change": F.col("new_n") - F.col("old_n"), "grew": F.col("new_n") > F.col("old_n")})


@query("SELECT o_orderkey, 'new' AS empty FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that one side knows and the other has no rows of."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.emptiness(orders, orders, lines, "o_orderkey").where("empty <> 'neither'")


@query("SELECT c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'P' EXCEPT SELECT c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderpriority = '5-LOW'")
def setdiff_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names of one selection that another lacks."""
    names = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    return names.where("o_orderstatus = 'P'").select("c_name").subtract(names.where("o_orderpriority = '5-LOW'").select("c_name"))


@query("""WITH a AS (SELECT DISTINCT l_suppkey % 40 AS k FROM lineitem WHERE l_quantity > 25), b AS (SELECT s_suppkey % 60 AS k FROM supplier)
SELECT 'both' AS side, k FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'first', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'second', k FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""")
def set_symmetric(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "lineitem").where("l_quantity > 25").select((F.col("l_suppkey") % 40).alias("k")).distinct()
    b = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 60).alias("k"))
    mark = lambda df, side: df.select(F.lit(side).alias("side"), "k")
    return mark(a.intersect(b), "both").unionByName(mark(a.subtract(b), "first")).unionByName(mark(b.subtract(a), "second"))


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def union_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


# lineitem in the role of morphology rows: one row for each order, line and part, numbered without ties
LINES = """x AS (SELECT l_orderkey AS u, l_linenumber, l_partkey, l_suppkey, count(*) AS copies FROM lineitem GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY l_linenumber, l_partkey, l_suppkey) AS id FROM x)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("u"), "l_linenumber", "l_partkey", "l_suppkey").agg(F.count("*").alias("copies"))
    return x.withColumn("id", F.row_number().over(W.partitionBy("u").orderBy("l_linenumber", "l_partkey", "l_suppkey")).cast("long"))


@query(f"""WITH {LINES}, y AS (SELECT *, l_partkey % 3 = 0 AS is_compound, l_linenumber AS w_fk, l_suppkey % 7 = 0 AS sep, lag(l_linenumber) OVER w AS before, lag(l_suppkey % 7 = 0) OVER w AS before_sep, row_number() OVER w AS n FROM m WINDOW w AS (PARTITION BY u ORDER BY id)),
z AS (SELECT u, id, (NOT is_compound) OR n = 1 OR before IS NULL OR w_fk <> before OR before_sep AS counted FROM y)
SELECT u, id, counted, sum(counted::INT) OVER (PARTITION BY u ORDER BY id ROWS UNBOUNDED PRECEDING)::BIGINT AS gra_counted FROM z""")
def cumulative_compound_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).withColumns({"is_compound": F.col("l_partkey") % 3 == 0, "w_fk": F.col("l_linenumber"), "is_separated_prefix": F.col("l_suppkey") % 7 == 0, "gra_index": F.col("l_linenumber")})
    return morphology.compound_index(rows, ["u"]).select("u", "id", "counted", "gra_counted")


@query(f"WITH {LINES} SELECT u, id, coalesce(sum(1 + l_partkey % 3) OVER (PARTITION BY u ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chunk FROM m")
def chunk_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each item's main chunk lies: the sum of the items before it and their clitics."""
    before = W.partitionBy("u").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    return _lines(spark, sf_dir).select("u", "id", F.coalesce(F.sum(1 + F.col("l_partkey") % 3).over(before), F.lit(0)).alias("chunk"))


@query(f"""WITH {LINES}, g AS (SELECT u, id, l_linenumber AS gra_index, l_partkey % 9 AS gra_head FROM m), s AS (SELECT u, max(gra_index) + 1 AS after, list(DISTINCT gra_index) AS ids FROM g GROUP BY u),
h AS (SELECT g.*, gra_head = 0 OR gra_head = after OR list_contains(ids, gra_head) AS good_head FROM g JOIN s USING (u))
SELECT u, id, gra_index, gra_head, good_head FROM h WHERE u IN (SELECT u FROM h GROUP BY u HAVING NOT bool_and(good_head))""")
def group_max_head_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("u", "id", F.col("l_linenumber").alias("gra_index"), (F.col("l_partkey") % 9).cast("int").alias("gra_head"))
    return morphology.bad_heads(rows, ["u"]).withColumn("gra_head", F.col("gra_head").cast("long"))


@query("SELECT lang, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS place FROM documents) WHERE place <= 3")
def top_examples_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n_chars"), "doc_id"))
    return table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars", place.alias("place")).where("place <= 3").drop("place")


@query("SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS place FROM events GROUP BY user_id, event_type) WHERE place = 1")
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.majority(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("""WITH t AS (SELECT l_orderkey, sum(round(l_extendedprice, 2)) AS s FROM lineitem GROUP BY 1)
SELECT round(corr(o_totalprice, s), 6) AS r, round(corr(o_totalprice, s), 6) > 0.997 AS alike FROM orders JOIN t ON o_orderkey = l_orderkey""")
def pearson_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.round("l_extendedprice", 2)).alias("s"))
    both = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").join(sums, "o_orderkey")
    r = F.round(F.corr("o_totalprice", "s"), 6)
    return both.agg(r.alias("r"), (r > 0.997).alias("alike"))


# a plain rule in the role of an annotator: long documents are taken for good ones
PREDICTED = "p AS (SELECT quality::VARCHAR AS gold, CASE WHEN n_chars > 800 THEN '1' WHEN n_chars > 400 THEN '0' ELSE 'none' END AS predicted, lang FROM labels JOIN documents USING (doc_id))"


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    guess = F.when(F.col("n_chars") > 800, "1").when(F.col("n_chars") > 400, "0").otherwise("none")
    return rows.select(F.col("quality").cast("string").alias("gold"), guess.alias("predicted"), "lang")


@query(f"""WITH {PREDICTED} SELECT gold, round(count(*) FILTER (predicted = '0') / count(*)::DOUBLE, 6) AS p0, round(count(*) FILTER (predicted = '1') / count(*)::DOUBLE, 6) AS p1, round(count(*) FILTER (predicted = 'none') / count(*)::DOUBLE, 6) AS pnone FROM p GROUP BY gold""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quality.confusion(_predicted(spark, sf_dir), "gold", "predicted", ["0", "1", "none"], normalize=True)
    return m.select("gold", *[F.round(F.col(f"`{c}`"), 6).alias(f"p{c}") for c in ("0", "1", "none")])


_SCORE = "round(tp / p::DOUBLE, 6) AS precision, round(CASE WHEN g > 0 THEN tp / g::DOUBLE END, 6) AS recall, round(CASE WHEN g > 0 AND tp > 0 THEN 2 * (tp / p::DOUBLE) * (tp / g::DOUBLE) / (tp / p::DOUBLE + tp / g::DOUBLE) END, 6) AS f1"


@query(f"""WITH {PREDICTED}, s AS (SELECT count(*) FILTER (gold = predicted) AS tp, count(*) AS p, count(*) FILTER (gold IN (SELECT predicted FROM p)) AS g FROM p) SELECT {_SCORE} FROM s""")
def precision_recall_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.micro_scores(_predicted(spark, sf_dir), "gold", "predicted")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(f"""WITH {PREDICTED}, s AS (SELECT lang, count(*) FILTER (gold = predicted) AS tp, count(*) AS p, count(*) FILTER (EXISTS (SELECT 1 FROM p q WHERE q.lang = p.lang AND q.predicted = p.gold)) AS g FROM p GROUP BY lang) SELECT lang, {_SCORE} FROM s""")
def scores_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.scores_by_group(_predicted(spark, sf_dir), "lang", "gold", "predicted")
    return out.select("lang", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type")


@query("SELECT user_id % 10 AS g, event_type, count(*) AS n FROM events GROUP BY ALL")
def counter_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters made by user, as maps, added up by group."""
    rows = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    counters = rows.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("counter"))
    entries = counters.select((F.col("user_id") % 10).alias("g"), F.explode("counter").alias("event_type", "n"))
    return quality.merged_counts(entries, ["g", "event_type"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag) + grouping(l_linestatus) AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.grouping("l_returnflag").cast("long") + F.grouping("l_linestatus").cast("long")
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), level.alias("level"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey > 700 ORDER BY c_custkey LIMIT 50")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of rows behind a key."""
    from utterlake.sources.tables import page

    return page(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", 700, 50)


@query("SELECT user_id, min(value) FILTER (value > 0) AS min_age, max(value) FILTER (value > 0) AS max_age, arg_min(event_type, event_id) AS first_type FROM events GROUP BY user_id")
def participants_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is first said of each person, and the range of their known ages."""
    known = F.when(F.col("value") > 0, F.col("value"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(known).alias("min_age"), F.max(known).alias("max_age"), F.min_by("event_type", "event_id").alias("first_type"))


@query("""SELECT a.lang, a.n, round((a.top / a.n::DOUBLE + b.top / a.n::DOUBLE) / 2, 4) AS score, a.others = 1 AND b.others = 1 AS passes FROM
(SELECT lang, sum(top) AS top, max(o) AS others, sum(n)::BIGINT AS n FROM (SELECT lang, s, max(c) AS top, count(*) AS o, sum(c) AS n FROM (SELECT lang, source AS s, n_chars % 5 AS t, count(*) AS c FROM documents GROUP BY ALL) GROUP BY ALL) GROUP BY lang) a
JOIN (SELECT lang, sum(top) AS top, max(o) AS others FROM (SELECT lang, t, max(c) AS top, count(*) AS o FROM (SELECT lang, source AS s, n_chars % 5 AS t, count(*) AS c FROM documents GROUP BY ALL) GROUP BY ALL) GROUP BY lang) b USING (lang)""")
def partition_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    from utterlake.operators.identity import agreement

    rows = table(spark, sf_dir, "documents").select("lang", F.col("source").alias("key"), (F.col("n_chars") % 5).alias("truth"))
    return agreement(rows, ["lang"])


@query("SELECT conv_id, CASE WHEN count(DISTINCT role) FILTER (role = 'user') = 1 THEN conv_id * 10 + 1 END AS target_child_id, role AS speaker FROM conversations GROUP BY conv_id, role HAVING true")
def target_child_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each speaker with the one target child of the conversation, by a self join."""
    people = table(spark, sf_dir, "conversations").select("conv_id", F.col("role").alias("speaker")).distinct()
    targets = people.where("speaker = 'user'").withColumn("target_child_id", F.col("conv_id") * 10 + 1).drop("speaker")
    own = people.join(targets, "conv_id", "left")
    return own.select("conv_id", F.when(F.col("speaker") == "user", F.col("target_child_id")).alias("target_child_id"), "speaker")
