"""Queries of scalar functions, filters and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.functions import archival
from utterlake.functions import scalars as S
from utterlake.plans.adapters import table
from utterlake.plans.catalogue import query


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE nullif((o_orderkey % 7) * 365.25::DOUBLE + (o_orderkey % 12) * (365.25::DOUBLE / 12) + (o_orderkey % 30), 0) END AS age FROM orders""")
def age_days_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = F.when(k % 5 != 0, F.concat(F.lit("P"), k % 7, F.lit("Y"), F.lpad((k % 12).cast("string"), 2, "0"), F.lit("M"), k % 30, F.lit("DT12H")))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.age_days_iso(text).alias("age"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN nullif((o_orderkey % 7) * 365.25::DOUBLE, 0)
  ELSE nullif((o_orderkey % 7) * 365.25::DOUBLE + (o_orderkey % 12) * (365.25::DOUBLE / 12) + CASE WHEN o_orderkey % 4 = 3 THEN o_orderkey % 30 ELSE 0 END, 0) END AS age FROM orders""")
def age_days_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    y, m, d = (k % 7).cast("string"), F.lpad((k % 12).cast("string"), 2, "0"), F.lpad((k % 30).cast("string"), 2, "0")
    text = F.when(k % 4 == 0, F.lit("unknown")).when(k % 4 == 1, F.concat(y, F.lit(";"))).when(k % 4 == 2, F.concat(y, F.lit(";"), m)).otherwise(F.concat(y, F.lit(";"), m, F.lit("."), d))
    blank = F.when(k % 5 == 0, F.lit(" ")).when(k % 5 == 1, F.lit("\t ")).otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", S.age_days_chat(F.concat(blank, text, blank)).alias("age"))


@query("""SELECT o_orderkey, (12 * (o_orderkey % 7) + o_orderkey % 12 + CASE WHEN o_orderkey % 30 > 15 THEN 1 ELSE 0 END)::BIGINT AS months,
  ceil(12 * 30.5::DOUBLE * (o_orderkey % 7) + 30.5::DOUBLE * (o_orderkey % 12))::BIGINT AS archival_days FROM orders""")
def age_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    iso = F.concat(F.lit("P"), k % 7, F.lit("Y"), k % 12, F.lit("M"), k % 30, F.lit("D"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.age_months(iso).cast("long").alias("months"), S.age_days_archival(F.concat(k % 7, F.lit(";"), k % 12)).cast("long").alias("archival_days"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate::DATE END AS date FROM orders")
def chat_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.when(k % 9 == 0, F.lit("31-FOO-1962")).when(k % 2 == 0, F.upper(F.date_format(day, "dd-MMM-yyyy"))).when(k % 5 == 0, F.date_format(day, "d-MMM-yyyy")).otherwise(F.date_format(day, "dd-MMMM-yyyy"))
    blank = F.when(k % 7 == 0, F.lit("  ")).otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", S.chat_date(F.concat(blank, text, blank)).alias("date"))


@query(r"""SELECT page_id, split_part(url, '/', 3) AS host, regexp_replace(regexp_extract(url, '[^/]*$'), '(.)\.[^.]*$', '\1') AS stem,
  array_to_string(list_slice(string_split(url, '/'), 1, -2), '/') AS folder, regexp_extract(url, '^https?://(www\.|m\.|blog\.)?([a-z-]+)', 2) AS site,
  regexp_replace(split_part(url, '/', 3), '[^A-Za-z0-9]', '', 'g') AS plain, regexp_replace(split_part(url, '/', 5), '[0-9]', '', 'g') AS undigited FROM pages""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    host, last = F.split_part(url, F.lit("/"), F.lit(3)), F.split_part(url, F.lit("/"), F.lit(5))
    site = F.regexp_extract(url, r"^https?://(www\.|m\.|blog\.)?([a-z-]+)", 2)
    return table(spark, sf_dir, "pages").select("page_id", host.alias("host"), S.stem_name(url).alias("stem"), S.directory(url).alias("folder"), site.alias("site"), S.comparable_name(host).alias("plain"), S.strip_digits(last).alias("undigited"))


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE (c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AND c_acctbal BETWEEN 0 AND 5000 AND c_nationkey NOT IN (1, 2, 3)) OR (c_name LIKE '%11%' AND c_acctbal IS NOT NULL AND c_nationkey = 7)""")
def like_in_range_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE") & F.col("c_acctbal").between(0, 5000) & ~F.col("c_nationkey").isin(1, 2, 3)
    b = F.contains("c_name", F.lit("11")) & F.col("c_acctbal").isNotNull() & (F.col("c_nationkey") == 7)
    return table(spark, sf_dir, "customer").where(a | b).select("c_custkey", "c_name", "c_acctbal")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS brand FROM part WHERE p_partkey % 3 = 0 OR p_brand <> ''")
def exclude_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose brand isn't empty; unknown ones stay."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).alias("brand"))
    return rows.where(F.col("brand").isNull() | (F.col("brand") != ""))


@query("SELECT p_partkey, p_brand, p_type FROM part WHERE p_partkey % 3 <> 0")
def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty strings as nulls, then complete rows alone."""
    gap = F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.col("p_brand"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.nullif(gap, F.lit("")).alias("p_brand"), "p_type")
    return rows.dropna("any")


@query("""SELECT event_type, json_extract_string(props, '$.k')::BIGINT % 10 AS k, count(*) AS n, sum(value)::DECIMAL(38, 4)::DOUBLE AS total FROM
(SELECT event_type, props, round(value, 4)::DECIMAL(38, 4) AS value FROM events) GROUP BY ALL""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.try_variant_get(F.parse_json("props"), "$.k", "long") % 10
    rows = table(spark, sf_dir, "events").select("event_type", k.alias("k"), F.round("value", 4).cast("decimal(28,4)").alias("value"))
    return rows.groupBy("event_type", "k").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("total"))


@query("""SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value, CASE WHEN event_id % 2 = 0 THEN 'string' ELSE 'object' END AS kind,
  coalesce(json_extract_string(props, '$.missing'), 'none') AS fallback FROM events""")
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path with a fallback, the fields of an object, and dispatch on what a value is."""
    props = F.parse_json("props")
    mixed = F.parse_json(F.when(F.col("event_id") % 2 == 0, F.lit('"text"')).otherwise(F.col("props")))
    kind = F.when(F.schema_of_variant(mixed) == "STRING", "string").otherwise("object")
    rows = table(spark, sf_dir, "events")
    rows = rows.select("event_id", F.explode(F.try_variant_get(props, "$", "map<string,string>")).alias("key", "value"), kind.alias("kind"), F.coalesce(F.try_variant_get(props, "$.missing", "string"), F.lit("none")).alias("fallback"))
    return rows


_EXCLUDED = "('" + "', '".join(archival.EXCLUDED) + "')"


@query(rf"""WITH w AS (SELECT conv_id, turn, list_filter(list_transform(string_split_regex(text, '\s+'), lambda x: regexp_replace(x, '[.,]', '', 'g')), lambda x: x <> '') AS w FROM conversations),
m AS (SELECT conv_id, turn, w, list_transform(w, lambda x: 'n|' || x) AS m FROM w WHERE len(w) >= CASE WHEN turn % 3 = 0 THEN 2 ELSE 1 END)
SELECT conv_id, turn, array_to_string(CASE turn % 3 WHEN 0 THEN list_concat(['BRK', 'BRK'], m) WHEN 1 THEN list_concat(['BRK'], m)
  ELSE list_concat(['EXC'], list_transform(w, lambda x: CASE WHEN x IN {_EXCLUDED} THEN 'EXC' ELSE 'n|' || x END), ['NON-LINGUISTIC']) END, ' ') AS mor FROM m""")
def reformulation_realign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Morphology for words that are taken back, two or one (of turns that have as many), and for fillers and sounds that have none."""
    words = F.filter(F.transform(S.words(F.col("text")), lambda x: F.regexp_replace(x, "[.,]", "")), lambda x: x != "")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("w")).where(F.size("w") >= F.when(F.col("turn") % 3 == 0, 2).otherwise(1))
    item = lambda x: F.concat(F.lit("n|"), x)
    first, line, k = F.get("w", F.lit(0)), F.concat(F.array_join("w", " "), F.lit(" .")), F.col("turn") % 3
    gloss = F.when(k == 0, F.concat(F.lit("<"), first, F.lit(" "), F.get("w", F.lit(1)), F.lit("> [//] "), line)).otherwise(F.concat(first, F.lit(" [/] "), line))
    whole = archival.realign_reformulations(gloss, F.array_append(F.transform("w", item), "."))
    spoken = F.concat(F.array(F.lit("um")), F.col("w"), F.array(F.lit("&=laughs")))
    items = F.transform(F.filter("w", lambda x: ~x.isin(*archival.EXCLUDED)), item)
    return rows.select("conv_id", "turn", F.array_join(F.when(k < 2, whole).otherwise(archival.reconcile(spoken, items)), " ").alias("mor"))


@query(rf"""WITH w AS (SELECT conv_id, turn, list_filter(string_split_regex(regexp_replace(text, '[^0-9A-Za-z\s]', '', 'g'), '\s+'), lambda w: w <> '') AS w FROM conversations)
SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN ['EXC'] || list_transform(w, lambda x: CASE WHEN x IN {_EXCLUDED} THEN 'EXC' WHEN x = '0' THEN 'NO_UTT' ELSE 'n|' || x END) || ['NON-LINGUISTIC']
  WHEN 1 THEN ['NO_UTT'] ELSE NULL END AS mor FROM w""")
def reconciled_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns between a filler and a sound, which have no morphology, non-utterances, and turns with more morphology than words, which get none."""
    plain = F.filter(F.split(F.regexp_replace("text", r"[^0-9A-Za-z\s]", ""), r"\s+"), lambda w: w != "")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", plain.alias("w"), (F.col("turn") % 3).alias("k"))
    item = lambda w: F.concat(F.lit("n|"), w)
    own = F.transform(F.filter("w", lambda w: ~w.isin(*archival.EXCLUDED, *archival.NO_UTTERANCE)), item)
    spoken = F.when(F.col("k") == 0, F.concat(F.lit("um "), F.array_join("w", " "), F.lit(" &=laughs"))).when(F.col("k") == 1, "0").otherwise(F.array_join("w", " "))
    mor = F.when(F.col("k") == 0, own).when(F.col("k") == 1, F.array().cast("array<string>")).otherwise(F.array_append(F.transform("w", item), "v|more"))
    return rows.select("conv_id", "turn", archival.reconcile(S.clean_gloss(spoken), mor).alias("mor"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'imperative_emphatic' WHEN '2-HIGH' THEN 'question' WHEN '3-MEDIUM' THEN 'declarative' ELSE o_orderpriority END AS type FROM orders""")
def type_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table look-up that lets unknown codes through."""
    code = S.lookup(F.col("o_orderpriority"), {"1-URGENT": "e", "2-HIGH": "q", "3-MEDIUM": "p"}, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.utterance_type_legacy(code).alias("type"))


@query("""SELECT n_nationkey, (n_nationkey + 1) % 10 AS c, ((n_nationkey * 37) % 1000) // 100 || '.' || ((n_nationkey * 37) % 100) // 10 || '.' || (n_nationkey * 37) % 10 AS version,
  ((n_nationkey * 37) % 1000 + 1) // 100 || '.' || ((n_nationkey * 37 % 1000 + 1) % 100) // 10 || '.' || (n_nationkey * 37 % 1000 + 1) % 10 AS following FROM nation""")
def version_bump(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("n_nationkey") * 37 % 1000
    text = F.concat_ws(".", F.floor(v / 100).cast("string"), F.floor(v % 100 / 10).cast("string"), (v % 10).cast("string"))
    return table(spark, sf_dir, "nation").select("n_nationkey", ((F.col("n_nationkey") + 1) % 10).alias("c"), text.alias("version"), S.next_version(text).alias("following"))
