"""Queries that render the test tables as transcripts, read them back, learn identities, and stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.functions import lexical as L
from utterlake.operators import build, identity
from utterlake.plans.adapters import TOK, table, utt
from utterlake.plans.catalogue import query
from utterlake.session import scratch_dir as _folder
from utterlake.sources import chat_json, chat_text, talkbank_xml, xml_splits
from utterlake.streaming import ingest


def escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))


def _bare(w: Column, at: Column) -> Column:
    return F.concat(F.lit("<w>"), escaped(w), F.lit("</w>"))


def as_xml(rows: DataFrame, word: Callable[[Column, Column], Column] = _bare) -> DataFrame:
    """Conversations as TalkBank XML: path, text. word: the element of a word and its place."""
    u = F.concat(F.lit('<u who="'), escaped(F.col("role")), F.lit('" uID="u'), F.col("order") - 1, F.lit('">'), F.array_join(F.transform("tokens", word), ""), F.lit('<t type="p"/></u>'))
    body = L.ordered(u, F.col("order"))
    roles = F.array_join(F.transform(F.array_sort(F.collect_set("role")), lambda r: F.concat(F.lit('<participant id="'), r, F.lit('" role="'), r, F.lit('"/>'))), "")
    doc = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><CHAT xmlns="http://www.talkbank.org/ns/talkbank" PID="'), F.col("conv_id"), F.lit('"><Participants>'), F.col("roles"), F.lit("</Participants>"), F.array_join("body", ""), F.lit("</CHAT>"))
    # a given number of parts, which Spark doesn't merge: the reader that follows in the same tasks takes far longer than their bytes tell
    rows = rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "conv_id")
    return rows.groupBy("conv_id").agg(body.alias("body"), roles.alias("roles")).select(F.concat("conv_id", F.lit(".xml")).alias("path"), doc.alias("text"))


@query(f"WITH {TOK} SELECT conv_id::VARCHAR AS pid, role AS who, ord AS utterance_order, token_order, gloss AS word FROM t")
def xml_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = talkbank_xml.words(talkbank_xml.parsed(as_xml(utt(spark, sf_dir))), attribute="PID")
    return words.select(F.col("PID").alias("pid"), "who", F.col("utterance_order").cast("long").alias("utterance_order"), F.col("token_order").cast("long").alias("token_order"), "word")


def as_json(rows: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """Conversations as parsed-document JSON: path, text. Users are the target children. more: further fields of an utterance's line."""
    word = lambda w: F.struct(F.lit("word").alias("type"), w.alias("cleaned_text"))
    mark = F.struct(F.when(F.col("role") == "user", "question").otherwise("period").alias("type"))
    content = F.struct(F.transform("tokens", word).alias("content"), mark.alias("terminator"))
    line = F.struct(F.lit("utterance").alias("line_type"), F.struct(F.col("role").alias("speaker"), content.alias("content")).alias("main"), *[c.alias(k) for k, c in (more or {}).items()])
    people = F.collect_set("role")
    about = lambda r: F.struct(r.alias("code"), F.lit(None).cast("string").alias("name"), F.when(r == "user", "Target_Child").otherwise(F.initcap(r)).alias("role"))
    rows = rows.groupBy("conv_id").agg(L.ordered(line, F.col("order")).alias("lines"), F.map_from_entries(F.transform(F.array_sort(people), lambda r: F.struct(r, about(r)))).alias("participants"))
    files = rows.select(F.concat(F.lpad(F.col("conv_id").cast("string"), 8, "0"), F.lit(".json")).alias("path"), F.to_json(F.struct("lines", "participants")).alias("text"))
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism)  # as many splits as files of a corpus would have


@query(f"""WITH {TOK}, d AS (SELECT conv_id, role, count(DISTINCT lower(gloss)) AS types, count(*) AS nt FROM t GROUP BY ALL)
SELECT lpad(conv_id::VARCHAR, 8, '0') || '.json' AS filename, CASE role WHEN 'user' THEN 'Target_Child' WHEN 'assistant' THEN 'Assistant' ELSE 'System' END AS speaker_role,
  count(*) AS num_utterances, any_value(nt) AS num_tokens, any_value(types) AS num_types, round(any_value(nt) / count(*)::DOUBLE, 6) AS mlu_w FROM u JOIN d USING (conv_id, role) GROUP BY conv_id, role""")
def json_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole release built from parsed documents: its speaker summaries."""
    base = _folder(spark)
    parsed = f"{base}/documents"
    chat_json.parsed(as_json(utt(spark, sf_dir))).write.parquet(parsed)  # parsed once, read by every table
    docs = spark.read.parquet(parsed).withColumns({"collection_name": F.lit("Test"), "corpus_name": F.lit("Conversations")})
    corpora = spark.createDataFrame([("Test", "Conversations", "bank")], "collection_name string, corpus_name string, data_source string")
    tables = build.release(docs, corpora, scratch=f"{base}/scratch")
    files = tables["transcript"].select(F.col("id").alias("transcript_id"), "filename")
    whole = [F.col(c).cast("long").alias(c) for c in ("num_utterances", "num_tokens", "num_types")]
    return tables["transcript_by_speaker"].join(files, "transcript_id").select("filename", "speaker_role", *whole, F.round("mlu_w", 6).alias("mlu_w"))


@query(f"WITH {TOK} SELECT conv_id, ord AS utt_number, upper(left(role, 3)) AS speaker, len(list_filter(tokens, lambda w: regexp_replace(w, '[.,!?]', '', 'g') <> ''))::BIGINT AS num_words FROM u")
def chat_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as plain CHAT text, split again by Spark's own functions."""
    line = F.concat(F.lit("*"), F.upper(F.left("role", F.lit(3))), F.lit(":\t"), F.array_join("tokens", " "))
    rows = utt(spark, sf_dir).groupBy("conv_id").agg(L.ordered(line, F.col("order")).alias("lines"))
    files = rows.select(F.col("conv_id").cast("string").alias("path"), F.concat(F.lit("@Begin\n@Participants:\tCHI Target_Child\n"), F.array_join("lines", "\n"), F.lit("\n@End")).alias("text"))
    out = chat_text.utterances(files)
    words = F.filter(F.split("gloss", " "), lambda w: F.regexp_replace(w, r"[.,!?]", "") != "")
    return out.select(F.col("path").cast("long").alias("conv_id"), (F.col("utt_number") + 1).cast("long").alias("utt_number"), "speaker", F.size(words).cast("long").alias("num_words"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in the role of transcript files: sites as corpora, languages as folders; two of three are known, by the path's language."""
    url = F.col("url")
    host = F.regexp_extract(url, r"\.(example\.[a-z]+)/", 1)
    path = F.regexp_replace(F.regexp_extract(url, r"example\.[a-z]+/(.*)$", 1), r"[?#].*$", "")
    truth = F.when(F.col("page_id") % 3 != 0, F.split_part(path, F.lit("/"), F.lit(1)))
    return table(spark, sf_dir, "pages").select(host.alias("corpus"), F.concat(path, F.lit("#"), F.col("page_id")).alias("path"), F.lit(None).cast("string").alias("name"), truth.alias("truth"))


_FILES = r"""f AS (SELECT regexp_extract(url, '\.(example\.[a-z]+)/', 1) AS corpus, split_part(regexp_extract(url, 'example\.[a-z]+/(.*)$', 1), '/', 1) AS lang,
  regexp_replace(regexp_extract(url, 'example\.[a-z]+/(.*)$', 1), '[?#].*$', '') || '#' || page_id AS path, page_id % 3 <> 0 AS known FROM pages)"""


# each file's key by every rule, and each corpus's choice among them
_LEARN = _FILES + r""",
p AS (SELECT corpus, path, NULL::VARCHAR AS name, CASE WHEN known THEN lang END AS truth, string_split(path, '/') AS d, regexp_replace(string_split(path, '/')[-1], '(.)\.[^.]*$', '\1') AS stem FROM f),
x AS (SELECT *, CASE WHEN len(d) > 1 THEN d[1] END AS one, nullif(regexp_extract(stem, '^[A-Za-z]+'), '') AS alpha, nullif(regexp_extract(stem, '^[0-9]+'), '') AS digits, nullif(regexp_extract(stem, '[0-9]+$'), '') AS tail FROM p),
k AS (SELECT corpus, path, name, truth, unnest([
  {'r': 'subdir1', 'k': one}, {'r': 'subdir2', 'k': CASE WHEN len(d) > 2 THEN d[1] || '/' || d[2] END}, {'r': 'alpha_prefix', 'k': alpha}, {'r': 'stem', 'k': stem}, {'r': 'digit_prefix', 'k': digits},
  {'r': 'digit_suffix', 'k': tail}, {'r': 'before_last_sep', 'k': CASE WHEN regexp_matches(stem, '^.*[_-][^_-]+$') THEN regexp_extract(stem, '^(.*)[_-][^_-]+$', 1) END},
  {'r': 'subdir1+alpha_prefix', 'k': one || '|' || alpha}, {'r': 'subdir1+digit_prefix', 'k': one || '|' || digits}, {'r': 'subdir1+digit_suffix', 'k': one || '|' || tail}, {'r': 'subdir1+stem', 'k': one || '|' || stem},
  {'r': 'prefix6', 'k': CASE WHEN length(stem) >= 6 THEN left(stem, 6) END}, {'r': 'prefix5', 'k': CASE WHEN length(stem) >= 5 THEN left(stem, 5) END}, {'r': 'prefix4', 'k': CASE WHEN length(stem) >= 4 THEN left(stem, 4) END},
  {'r': 'prefix3', 'k': CASE WHEN length(stem) >= 3 THEN left(stem, 3) END}, {'r': 'prefix2', 'k': CASE WHEN length(stem) >= 2 THEN left(stem, 2) END},
  {'r': 'name2026', 'k': name}, {'r': 'file', 'k': path}, {'r': 'single', 'k': 'corpus_child'}]) AS s, unnest(range(19)) AS priority FROM x),
e AS (SELECT corpus, path, name, truth, s.r AS rule, s.k AS key, CASE WHEN s.r = 'name2026' AND avg((name IS NOT NULL)::INTEGER) OVER (PARTITION BY corpus, s.r) >= 0.95 THEN -1 ELSE priority END AS priority, s.r LIKE 'prefix%' AS risky FROM k),
n AS (SELECT corpus, rule, priority, risky, count(DISTINCT key) + max((key IS NULL)::INTEGER) AS n_keys FROM e GROUP BY ALL),
c AS (SELECT corpus, rule, key, truth, count(*) AS c FROM e WHERE truth IS NOT NULL GROUP BY ALL),
ck AS (SELECT corpus, rule, sum(top) AS top, max(others) AS others, sum(n) AS n FROM (SELECT corpus, rule, key, max(c) AS top, count(*) AS others, sum(c) AS n FROM c GROUP BY ALL) GROUP BY ALL),
ct AS (SELECT corpus, rule, sum(top) AS top, max(others) AS others FROM (SELECT corpus, rule, truth, max(c) AS top, count(*) AS others FROM c GROUP BY ALL) GROUP BY ALL),
h AS (SELECT corpus, rule, bool_or(key IS NULL) AS has_null FROM c GROUP BY ALL),
a AS (SELECT *, round((ck.top / ck.n::DOUBLE + ct.top / ck.n::DOUBLE) / 2, 4) AS score, NOT has_null AND ck.others = 1 AND ct.others = 1 AS passed FROM ck JOIN ct USING (corpus, rule) JOIN h USING (corpus, rule) JOIN n USING (corpus, rule)),
chosen AS (SELECT corpus, rule, passed, CASE WHEN passed THEN 1.0::DOUBLE ELSE score END AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY corpus ORDER BY passed DESC, CASE WHEN passed THEN risky END, CASE WHEN passed THEN n_keys END, CASE WHEN NOT passed THEN -score END, priority) AS place FROM a) WHERE place = 1)"""


@query(f"WITH {_LEARN} SELECT corpus, rule, passed, score FROM chosen")
def rule_learning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule by which each corpus names its children's files."""
    return identity.learn(_files(spark, sf_dir))


@query(f"""WITH {_LEARN},
g AS (SELECT corpus, count(DISTINCT one) AS subdirs, avg((one IS NOT NULL)::INTEGER) AS inside, bool_and(regexp_matches(stem, '^[0-9_]+$')) AS coded FROM x GROUP BY corpus),
rules AS (SELECT corpus, coalesce(rule, CASE WHEN subdirs >= 2 AND inside >= 0.8 THEN 'subdir1' WHEN coded THEN 'single' ELSE 'stem' END) AS rule FROM g LEFT JOIN chosen USING (corpus)),
own AS (SELECT e.* FROM e JOIN rules USING (corpus, rule)),
sure AS (SELECT corpus, key, min(truth) AS child FROM own WHERE truth IS NOT NULL AND key IS NOT NULL GROUP BY ALL HAVING min(truth) = max(truth))
SELECT corpus, path, coalesce('truth:' || coalesce(truth, child), 'rule:' || key, 'file:' || path) AS key, name FROM own LEFT JOIN sure USING (corpus, key)""")
def identity_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The child that each file is about, by truth, a rule's unambiguous key, a new key, or the file itself."""
    return identity.assign(_files(spark, sf_dir))


@query("SELECT DISTINCT md5(text) AS pid FROM documents")
def stream_dedup_pid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows of each pid, from a stream of document files."""
    path = f"{sf_dir}/documents.parquet"
    schema = spark.read.parquet(path).schema
    stream = ingest.files(spark, ingest.folder_of(path), schema, pathGlobFilter="*.parquet").select(F.md5("text").alias("pid"))
    out = _folder(spark)
    return ingest.to_parquet(ingest.first_pids(stream), f"{out}/data", f"{out}/state")


@query("SELECT user_id, min(value) FILTER (value > 0) AS min_age, max(value) FILTER (value > 0) AS max_age FROM events GROUP BY user_id")
def stream_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running age ranges from a stream of events."""
    path = f"{sf_dir}/events.parquet"
    stream = ingest.files(spark, ingest.folder_of(path), spark.read.parquet(path).schema)
    out = _folder(spark)
    ingest.run(ingest.age_ranges(stream, ["user_id"], "value"), f"{out}/state", ingest.upsert(f"{out}/data", ["user_id"]), "update")
    return ingest.latest(spark, f"{out}/data", ["user_id"])


@query(f"""WITH {TOK},
o AS (SELECT conv_id, ord, row_number() OVER (PARTITION BY conv_id % 3 ORDER BY conv_id, ord) AS utterance_order FROM u)
SELECT (conv_id % 3)::VARCHAR AS pid, role AS who, utterance_order, token_order, gloss AS word FROM t JOIN o USING (conv_id, ord)""")
def xml_by_utterance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as three long XML files, which tasks read by utterances."""
    out, rows = f"{_folder(spark)}/long", utt(spark, sf_dir).withColumn("pid", (F.col("conv_id") % 3).cast("string"))
    said = rows.select("pid", F.lit(1).alias("part"), "conv_id", "order", F.concat(F.lit('<u who="'), escaped(F.col("role")), F.lit('">'), F.array_join(F.transform("tokens", lambda w: _bare(w, F.lit(0))), ""), F.lit("</u>")).alias("value"))
    edge = lambda part, value: rows.select("pid").distinct().select("pid", F.lit(part).alias("part"), F.lit(0).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("order"), value.alias("value"))
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><CHAT xmlns="http://www.talkbank.org/ns/talkbank" PID="'), "pid", F.lit('"><Participants/>'))
    lines = said.unionByName(edge(0, head)).unionByName(edge(2, F.lit("</CHAT>"))).repartition("pid").sortWithinPartitions("pid", "part", "conv_id", "order")
    lines.select("pid", "value").write.partitionBy("pid").text(out)
    words = talkbank_xml.words(xml_splits.utterances(xml_splits.read(spark, out, "*.txt"), "PID"), attribute="PID")
    return words.select(F.col("PID").alias("pid"), "who", F.col("utterance_order").cast("long").alias("utterance_order"), F.col("token_order").cast("long").alias("token_order"), "word")
