"""Queries that write the test tables in the forms that corpora come in, read them back, and publish them as a release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from utterlake import schemas
from utterlake.api import Release
from utterlake.functions import lexical as L
from utterlake.functions import scalars as S
from utterlake.operators import build, identity, morphology, quality
from utterlake.plans.adapters import TOK, UTT, table, tok, utt
from utterlake.plans.catalogue import query
from utterlake.plans.transcripts import _folder, as_json, as_xml, escaped
from utterlake.sources import chat_json, chat_text, tables, talkbank_xml
from utterlake.streaming import ingest

# words in the role of analysed ones: short ones are fillers, those with x first are unintelligible, an s at the end is an inflection
_POS = "CASE WHEN length(gloss) <= 2 THEN 'co' WHEN gloss LIKE 'x%' THEN 'unk' ELSE 'n' END"
_STEM = "CASE WHEN gloss LIKE '%_s' THEN gloss[:-2] ELSE gloss END"
_FORM = f"{_STEM} || CASE WHEN gloss LIKE '%_s' THEN '-PL' ELSE '' END"


def _pos(w: Column) -> Column:
    return F.when(F.length(w) <= 2, "co").when(F.startswith(w, F.lit("x")), "unk").otherwise("n")


def _plural(w: Column) -> Column:
    return F.endswith(w, F.lit("s")) & (F.length(w) > 1)


def _stem(w: Column) -> Column:
    return F.when(_plural(w), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)


def _analysed(w: Column, at: Column) -> Column:
    """A word element with its morphology and the dependency on the word before."""
    affix = F.when(_plural(w), F.lit('<mk type="sfx">PL</mk>')).otherwise(F.lit(""))
    index = (at + 1).cast("string")
    return F.concat(
        F.lit("<w>"), escaped(w), F.lit('<mor type="mor"><mw><pos><c>'), _pos(w), F.lit("</c></pos><stem>"), escaped(_stem(w)), F.lit("</stem>"), affix,
        F.lit('</mw><gra type="gra" index="'), index, F.lit('" head="'), at.cast("string"), F.lit('" relation="LINK"/></mor></w>'),
    )


def _xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_xml(utt(spark, sf_dir), _analysed)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return talkbank_xml.parsed(_xml(spark, sf_dir))


def _long(*names: str) -> list[Column]:
    return [F.col(c).cast("long").alias(c) for c in names]


@query(f"WITH {TOK} SELECT conv_id::VARCHAR AS pid, role AS who, ord AS utterance_order, token_order, gloss AS word, {_POS} AS tag FROM t WHERE role IN ('user', 'assistant')")
def tagged_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tagged word stream of two speakers."""
    rows = talkbank_xml.tagged_words(_documents(spark, sf_dir), ["user", "assistant"], attribute="PID")
    return rows.select(F.col("PID").alias("pid"), "who", *_long("utterance_order", "token_order"), "word", "tag")


@query(f"""WITH {TOK} SELECT conv_id::VARCHAR AS pid, ord AS utterance_order, token_order, {_FORM} AS word, {_POS} AS pos,
  token_order || '|' || (token_order - 1) || '|LINK' AS relation FROM t WHERE role = 'assistant'""")
def stemmed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stems with inflections, parts of speech and dependencies of one speaker."""
    rows = talkbank_xml.words(_documents(spark, sf_dir), "assistant", stem=True, relation=True, attribute="PID")
    return rows.select(F.col("PID").alias("pid"), *_long("utterance_order", "token_order"), "word", "pos", "relation")


@query(f"WITH {UTT} SELECT conv_id || '.xml' AS path, ord AS utterance_order, role AS who, array_to_string(tokens, '|') AS words FROM u")
def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = talkbank_xml.sents(_documents(spark, sf_dir))
    return rows.select("path", *_long("utterance_order"), "who", F.array_join("words", "|").alias("words"))


@query(f"""WITH {TOK}, s AS (SELECT conv_id, ord, string_agg(gloss || '/' || {_POS}, ' ' ORDER BY token_order) AS words FROM t GROUP BY ALL)
SELECT u.conv_id || '.xml' AS path, u.ord AS utterance_order, coalesce(words, '') AS words FROM u LEFT JOIN s USING (conv_id, ord)""")
def tagged_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = talkbank_xml.tagged_sents(_documents(spark, sf_dir))
    joined = F.array_join(F.transform("words", lambda w: F.concat(w["word"], F.lit("/"), w["pos"])), " ")
    return rows.select("path", *_long("utterance_order"), joined.alias("words"))


@query(f"""WITH {TOK} SELECT conv_id || '.xml' AS transcript, ord - 1 AS utterance, gloss, {_POS} AS pos, {_STEM} AS stem, token_order AS gra_index, token_order - 1 AS gra_head,
  CASE WHEN gloss LIKE '%_s' THEN 'PL' END AS affix, CASE WHEN gloss LIKE '%_s' THEN 'sfx' END AS affix_type FROM t""")
def word_morpheme_affix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables of words, morphemes and affixes, joined again by their keys."""
    w, mor, mk = morphology.trio(_xml(spark, sf_dir))
    mor = mor.select("transcript", F.col("id").alias("mor_fk"), F.col("w_fk").alias("id"), F.col("pos").alias("mor_pos"), "stem", *_long("gra_index", "gra_head"))
    # stored files are far smaller than their rows, so that Spark would broadcast tables that grow with the corpus
    rows = w.join(mor.hint("merge"), ["transcript", "id"]).join(mk.select("transcript", "mor_fk", "affix", "affix_type").hint("merge"), ["transcript", "mor_fk"], "left")
    return rows.select("transcript", F.col("u_fk").cast("long").alias("utterance"), "gloss", F.col("mor_pos").alias("pos"), "stem", "gra_index", "gra_head", "affix", "affix_type")


@query(f"""WITH {TOK} SELECT lpad(conv_id::VARCHAR, 8, '0') || '.json' AS path, ord AS utterance_order, token_order, gloss, {_STEM} AS stem, {_POS} AS pos,
  CASE WHEN gloss LIKE '%_s' THEN 2 ELSE 1 END AS num_morphemes, token_order AS gra_index, token_order - 1 AS gra_head FROM t""")
def json_morphology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Morphology and dependencies that parsed documents align with words by position."""
    part = lambda w: F.struct(F.struct(_pos(w).alias("pos"), _stem(w).alias("lemma"), F.when(_plural(w), F.array(F.lit("PL"))).otherwise(F.array().cast("array<string>")).alias("features")).alias("main"))
    places = F.when(F.size("tokens") > 0, F.sequence(F.lit(0), F.size("tokens") - 1)).otherwise(F.array().cast("array<int>"))
    relation = F.transform(places, lambda i: F.struct((i + 1).alias("index"), i.alias("head"), F.lit("LINK").alias("relation")))
    tier = lambda kind, items, relations: F.struct(F.lit(kind).alias("type"), F.struct(items.alias("items"), relations.alias("relations")).alias("data"))
    mor, gra = tier("Mor", F.transform("tokens", part), F.when(F.lit(False), relation)), tier("Gra", F.when(F.lit(False), F.transform("tokens", part)), relation)
    pairs = F.struct(
        F.struct(F.transform(places, lambda i: F.struct(i.alias("source_index"), i.alias("target_index"))).alias("pairs")).alias("mor"),
        F.struct(F.transform(places, lambda i: F.struct(i.alias("mor_chunk_index"), i.alias("gra_index"))).alias("pairs")).alias("gra"),
    )
    docs = chat_json.parsed(as_json(utt(spark, sf_dir), {"dependent_tiers": F.array(mor, gra), "alignments": pairs}))
    rows = docs.select("path", F.posexplode("utterances").alias("n", "u")).select("path", (F.col("n") + 1).cast("long").alias("utterance_order"), F.posexplode("u.tokens").alias("at", "t"))
    return rows.select("path", "utterance_order", (F.col("at") + 1).cast("long").alias("token_order"), "t.gloss", "t.stem", "t.pos", *[F.col(f"t.{c}").cast("long").alias(c) for c in ("num_morphemes", "gra_index", "gra_head")])


@query(f"""WITH {TOK}, n AS (SELECT conv_id, (SELECT count(*) FROM u x WHERE x.conv_id = c.conv_id) AS u, (SELECT count(*) FROM t x WHERE x.conv_id = c.conv_id) AS t FROM (SELECT DISTINCT conv_id FROM u) c)
SELECT 'utterance' AS name, max(u) AS largest, true AS fits FROM n UNION ALL SELECT 'token', max(t), true FROM n""")
def id_block_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most ids that a conversation's block holds, by table."""
    numbered = {"utterance": build.numbered(utt(spark, sf_dir), F.col("conv_id"), "order"), "token": build.numbered(tok(spark, sf_dir), F.col("conv_id"), "order", "token_order")}
    return build.block_usage(numbered)


@query(f"""WITH {TOK}, p AS (SELECT *, row_number() OVER (ORDER BY conv_id, ord, token_order) AS n FROM t)
SELECT 1000000000 + n AS id, conv_id, ord AS utterance_order, token_order, gloss FROM p""")
def ids_of_one_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens numbered through one corpus of all conversations, each conversation behind those before it."""
    sizes = utt(spark, sf_dir).groupBy(F.lit(0).alias("block"), "conv_id").agg(F.sum("num_tokens").alias("n"))
    rows = build.numbered(tok(spark, sf_dir), F.lit(0), "conv_id", "order", "token_order", sizes=sizes)
    return rows.select("id", "conv_id", F.col("order").alias("utterance_order"), "token_order", "gloss")


@query(f"WITH {UTT} SELECT role, round(sum(len(tokens)) / count(*)::DOUBLE, 6) AS mlu_w, count(*) AS num_utterances FROM u GROUP BY role")
def corpus_mlu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MLU in words of a corpus, from each conversation's, weighted by utterances."""
    each = utt(spark, sf_dir).groupBy("conv_id", "role").agg(F.avg("num_tokens").alias("mlu_w"), F.count("*").alias("num_utterances"))
    return build.corpus_mlu(each, ["role"]).withColumn("mlu_w", F.round("mlu_w", 6))


@query("""WITH a AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL), b AS (SELECT source, lang, max(n_chars) AS longest FROM documents WHERE doc_id % 2 = 0 GROUP BY ALL)
SELECT source, lang, n, longest FROM a NATURAL JOIN b""")
def natural_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    a = rows.groupBy("source", "lang").agg(F.count("*").alias("n"))
    b = rows.where("doc_id % 2 = 0").groupBy("source", "lang").agg(F.max("n_chars").alias("longest"))
    return tables.natural_join(a, b)


@query("""WITH s AS (SELECT source, sum(octet_length(encode(text))) AS size FROM documents GROUP BY source), p AS (SELECT *, row_number() OVER (ORDER BY size DESC, source) AS place FROM s)
SELECT source, size::BIGINT AS size, place, CASE WHEN (place - 1) % 8 < 4 THEN (place - 1) % 8 ELSE 7 - (place - 1) % 8 END AS worker FROM p""")
def files_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources in the order in which four workers take them up, the largest first."""
    sizes = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.octet_length("text")).alias("size"))
    return tables.by_size(sizes, "size", 4).select("source", "size", *_long("place", "worker"))


@query("""WITH f AS (SELECT 'first' AS bank, 1 AS place, CASE l WHEN 'en' THEN 'Dutch' ELSE l END || '/' || source || '/' || doc_id AS path FROM (SELECT lang AS l, source, doc_id FROM documents WHERE doc_id % 3 <> 0)
  UNION ALL SELECT 'second', 2, CASE l WHEN 'en' THEN 'Dutch' ELSE l END || '/' || source || '/' || doc_id FROM (SELECT lang AS l, source, doc_id FROM documents WHERE doc_id % 2 = 0))
SELECT regexp_replace(path, '^Dutch/', 'DutchAfrikaans/') AS path, max(bank) AS bank, max(path) AS source FROM f GROUP BY 1""")
def merged_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two banks' folders united, the second's files first, with one collection renamed."""
    path = F.concat_ws("/", F.when(F.col("lang") == "en", "Dutch").otherwise(F.col("lang")), "source", "doc_id")
    rows = table(spark, sf_dir, "documents")
    bank = lambda name, place, which: rows.where(which).select(F.lit(name).alias("bank"), F.lit(place).alias("place"), path.alias("path"))
    return tables.merge_trees(bank("first", 1, "doc_id % 3 <> 0").unionByName(bank("second", 2, "doc_id % 2 = 0")))


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 2 = 0 THEN c_nationkey END AS c_nationkey, CASE WHEN o_custkey % 2 = 0 THEN c_mktsegment ELSE o_orderstatus END AS o_orderstatus
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_custkey % 2 = 0""")
def rows_completed_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted first, with columns set or added for the keys computed since."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    computed = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("o_orderstatus"), "c_nationkey")
    return tables.update_columns(orders, computed, ["o_custkey"]).select("o_orderkey", "o_custkey", "c_nationkey", "o_orderstatus")


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def resumed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table exported in parts by three calls, the first two of which end early."""
    df, out = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), f"{_folder(spark)}/orders"
    ends = df.agg(F.max("o_orderkey")).first()[0] or 0
    for stop in (1, 2, None):
        tables.export_parts(df, out, "o_orderkey", ends // 5 + 1, stop)
    return tables.exported(spark, out)


@query("""SELECT source, doc_id, CASE WHEN source IN ('src0', 'src1') THEN upper(lang) ELSE lang END AS lang FROM documents""")
def per_collection_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in a folder for each collection, two of which are written again: all folders read back."""
    rows, out = table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), f"{_folder(spark)}/by-source"
    tables.write_by(rows, out, "source")
    tables.write_by(rows.where("source IN ('src0', 'src1')").withColumn("lang", F.upper("lang")), out, "source")  # replaces its own folders alone
    return spark.read.parquet(out).select("source", "doc_id", "lang")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as one CSV file with a header and read back."""
    out, rows = f"{_folder(spark)}/report", table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    tables.write_csv(rows, out)
    return spark.read.schema(rows.schema).option("header", True).csv(out)


@query(f"WITH {TOK} SELECT conv_id AS transcript_id, gloss, token_order::INTEGER AS token_order, role AS speaker_role, NULL::VARCHAR AS stem FROM t WHERE role = 'user' AND (gloss LIKE 'th%' OR gloss LIKE '%on')")
def release_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a role and of two patterns, from a written release: columns are cast and filled up on the way, and a second write replaces the first."""
    base = _folder(spark)
    rows = tok(spark, sf_dir).select(F.col("conv_id").alias("transcript_id"), F.lit(1).alias("corpus_id"), "gloss", F.col("token_order").cast("double").alias("token_order"), F.col("role").alias("speaker_role"), F.lit("x").alias("unlisted"))
    tables.write_table(rows.where("transcript_id % 2 = 0"), base, "2026.1", "token")
    tables.write_table(rows, base, "2026.1", "token")
    return Release(spark, base, "2026.1").tokens(["th%", "%on"], role="user").select("transcript_id", "gloss", "token_order", "speaker_role", "stem")


@query(f"WITH {UTT} SELECT conv_id AS transcript_id, count(*) AS n, sum(len(tokens))::BIGINT AS num_tokens FROM u WHERE role = 'assistant' GROUP BY conv_id")
def release_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL with a parameter over a release's tables, one of which was emptied by a write without rows."""
    base = _folder(spark)
    rows = utt(spark, sf_dir).select(F.col("conv_id").alias("transcript_id"), F.col("role").alias("speaker_role"), "num_tokens")
    tables.write_table(rows, base, "2026.1", "utterance")
    tables.write_table(rows, base, "2026.1", "participant")
    tables.write_table(rows.limit(0), base, "2026.1", "participant")
    text = "SELECT transcript_id, count(*) AS n, sum(num_tokens) AS num_tokens FROM utterance WHERE speaker_role = :role AND NOT EXISTS (SELECT 1 FROM participant) GROUP BY transcript_id"
    return Release(spark, base, "2026.1").sql(text, role="assistant")


@query("""SELECT 'orders' AS name, count(*) AS expected, count(*) AS found, true AS ok FROM orders UNION ALL SELECT 'part', count(*) + 1, count(*), false FROM part UNION ALL SELECT 'absent', 1, NULL, false""")
def release_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts after publishing against those before."""
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    said = spark.range(1).select(F.lit("absent").alias("name"), F.lit(1).cast("long").alias("rows"))
    said = said.unionByName(orders.agg(F.lit("orders").alias("name"), F.count("*").alias("rows"))).unionByName(part.agg(F.lit("part").alias("name"), (F.count("*") + 1).alias("rows")))
    return tables.reconcile_counts(said, {"orders": orders, "part": part}).select("name", "expected", "found", "ok")


@query("SELECT r_name AS shard, count(n_nationkey) AS rows FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def shards_built_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards with a marker each; a second call builds only what has none."""
    base, nation = _folder(spark), table(spark, sf_dir, "nation")
    regions = [(r.r_regionkey, r.r_name) for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect()]
    shard = lambda k: lambda: nation.where(F.col("n_regionkey") == k)
    spoiled = lambda: nation
    tables.build_once(spark, base, {name: shard(k) for k, name in regions[:2]})
    return tables.build_once(spark, base, {name: shard(k) if i > 1 else spoiled for i, (k, name) in enumerate(regions)})


@query("""SELECT 'bank' || s_nationkey % 3 AS bank, s_name AS corpus_path, s_suppkey % 7 AS n_cha FROM supplier WHERE s_suppkey % 7 > 0""")
def catalogue_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpora of a report in tab-separated values, without empty ones."""
    out = f"{_folder(spark)}/report"
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("bank"), F.col("s_nationkey") % 3).alias("bank"), F.col("s_name").alias("corpus_path"), (F.col("s_suppkey") % 7).alias("n_cha"))
    rows.write.option("sep", "\t").option("header", True).csv(out)
    return tables.catalogue(spark, out).withColumn("n_cha", F.col("n_cha").cast("long"))


@query("SELECT p_brand AS brand, p_partkey, CASE WHEN p_size > 10 THEN p_name END AS p_name FROM part")
def tagged_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files in a folder each, rows tagged with their file; NA reads as null."""
    out = f"{_folder(spark)}/csv"
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_name")).otherwise("NA").alias("p_name"), F.col("p_brand").alias("brand"))
    rows.write.partitionBy("brand").option("header", True).csv(out)
    back = tables.tagged_csv(spark, f"{out}/brand=*", schemas._schema("p_partkey:l p_name"))
    return back.select(F.url_decode(F.url_decode(F.regexp_extract("file", "brand=([^/]*)/", 1))).alias("brand"), "p_partkey", "p_name")


@query("SELECT c_nationkey::BIGINT AS corpus_id, c_name AS path, 'rule:' || c_custkey AS key, c_mktsegment AS name FROM customer")
def identity_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity maps written as JSON, a corpus each, and read back as rows."""
    out = f"{_folder(spark)}/maps"
    entry = F.struct(F.col("c_name"), F.struct(F.concat(F.lit("rule:"), "c_custkey").alias("key"), F.col("c_mktsegment").alias("name")))
    maps = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("corpus_id")).agg(F.map_from_entries(F.collect_list(entry)).alias("assignments"))
    tables.write_json(maps, out)
    rows = spark.read.schema("corpus_id long, assignments map<string,struct<key:string,name:string>>").json(out)
    return tables.assignments(rows)


@query("SELECT 'data/' || p_partkey || '.zip' AS file FROM part WHERE p_partkey % 5 > 1")
def log_saved_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that a mirror's log names as saved."""
    out, k = f"{_folder(spark)}/log", F.col("p_partkey")
    line = F.when(k % 5 == 0, F.concat(F.lit("Saving to: ‘data/"), k, F.lit("/index.html’"))).when(k % 5 == 1, F.concat(F.lit("--2020-- http://x/"), k)).otherwise(F.concat(F.lit("Saving to: ‘data/"), k, F.lit(".zip’")))
    table(spark, sf_dir, "part").select(line.alias("value")).write.text(out)
    return tables.saved_files(spark, out)


@query("""SELECT DISTINCT conv_id, CASE WHEN conv_id % 4 > 0 THEN '11312/c-' || conv_id END AS pid, CASE WHEN conv_id % 3 = 0 THEN 'Name' || conv_id END AS name FROM conversations""")
def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PID and child's name from the first bytes of CHAT files, with a continuation line."""
    k = F.col("conv_id")
    head = F.concat(
        F.lit("@UTF8\n"), F.when(k % 4 > 0, F.concat(F.lit("@PID:\t11312/c-"), k, F.lit("\n"))).otherwise(F.lit("")), F.lit("@Begin\n@Participants:\tMOT Mother,\n\tCHI "),
        F.when(k % 3 == 0, F.concat(F.lit("Name"), k, F.lit(" "))).otherwise(F.lit("")), F.lit("Target_Child\n*CHI:\thi .\n@End\n"),
    )
    files = table(spark, sf_dir, "conversations").select("conv_id").distinct().withColumn("content", F.encode(head, "UTF-8"))
    return files.select("conv_id", chat_text.pid_of(F.col("content")).alias("pid"), chat_text.child_name_of(F.col("content")).alias("name"))


@query(r"""SELECT conv_id, turn, trim(regexp_replace(regexp_replace(text, '[().:]', '', 'g') || ' do not know .', '\s+', ' ', 'g')) AS gloss,
  array_to_string(list_transform(string_split(replace(text, 'ß', 's'), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS titled, regexp_full_match(text, '[A-Z].*\.', 's') AS whole FROM conversations""")
def verbatim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verbatim lines as they were meant, each word capitalised, and a full match. (Engines differ on the capital of ß.)"""
    line = F.concat(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(" [=! laughs] dunno [: do not know] ."))
    whole = F.rlike("text", F.lit(r"(?s)\A[A-Z].*\.\z"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", S.adult_gloss(line).alias("gloss"), S.title_words(F.replace("text", F.lit("ß"), F.lit("s"))).alias("titled"), whole.alias("whole"))


@query(f"""WITH {TOK}, m AS (SELECT conv_id, ord, list(regexp_replace('n|' || gloss, '[!,?/.]', '', 'g') ORDER BY token_order) AS mor, list(gloss ORDER BY token_order) AS w FROM t GROUP BY ALL)
SELECT conv_id, ord AS utterance_order, array_to_string(mor, ' ') AS mor, w[1] AS word, CASE WHEN len(w) % 2 = 0 THEN 'even' ELSE 'NA' END AS tag FROM m""")
def mor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Morphology lines without punctuation items, and a word split from its tag."""
    items = F.array_join(F.transform("tokens", lambda w: F.concat(F.lit("n|"), w)), " cm|cm ")
    word, tag = S.tag_word(F.concat(F.get("tokens", F.lit(0)), F.when(F.size("tokens") % 2 == 0, "@even").otherwise("")))
    rows = utt(spark, sf_dir).where("num_tokens > 0")
    return rows.select("conv_id", F.col("order").alias("utterance_order"), F.array_join(S.clean_mor(F.concat(items, F.lit(" . end|end"))), " ").alias("mor"), word.alias("word"), tag.alias("tag"))


@query("""SELECT doc_id, CASE WHEN lang = 'en' THEN 'en/' || source || '/' || doc_id || '.xml' END AS inner_path, lang || '/' || source || '/' || doc_id || '.cha' AS shown FROM documents""")
def browser_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a file is shown on the web, and its path from a named folder on."""
    inner = F.concat_ws("/", "lang", "source", F.concat("doc_id", F.lit(".xml")))
    path = F.concat(F.when(F.col("doc_id") % 2 == 0, F.lit("/home/childes/data-xml/")).otherwise(F.lit("C:\\x\\childes\\")), inner)
    return table(spark, sf_dir, "documents").select("doc_id", S.path_from(F.concat(F.lit("/home/"), inner), "en").alias("inner_path"), talkbank_xml.browser_path(path).alias("shown"))


@query("SELECT * EXCLUDE (event_id, user_id, ts) FROM events")
def without_id_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without the columns whose names end in id, for comparing releases."""
    return S.no_id_columns(table(spark, sf_dir, "events").drop("ts"))


@query("""WITH old AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 > 0 THEN 'p' || o_orderkey END AS pid, o_orderpriority AS corpus, 'f' || o_orderkey % 4000 AS stem, CASE WHEN o_orderkey % 11 = 0 THEN -o_custkey ELSE o_custkey END AS child FROM orders WHERE o_orderkey % 7 > 0),
f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 'p' || o_orderkey END AS pid, o_orderpriority AS corpus, 'f' || o_orderkey % 4000 AS stem FROM orders),
a AS (SELECT corpus, stem, min(child) AS child FROM old GROUP BY ALL HAVING count(*) = 1)
SELECT o_orderkey, coalesce(old.child, a.child) AS truth FROM f LEFT JOIN old ON f.pid = old.pid LEFT JOIN a ON f.corpus = a.corpus AND f.stem = a.stem""")
def matched_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files matched with an older release by PID, else by a name that stands for one transcript only, after corrections."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.lit("bank").alias("source"), F.col("o_orderpriority").alias("corpus_name"))
    name = lambda end: F.concat(F.lit("a/f"), k % 4000, F.lit(end))
    old = orders.where(k % 7 > 0).select(k.alias("id"), F.when(k % 5 > 0, F.concat(F.lit("p"), k)).alias("pid"), "source", "corpus_name", name(".xml").alias("filename"), F.col("o_custkey").alias("child"))
    fixes = orders.where(k % 11 == 0).select(k.alias("transcript_id"), (-F.col("o_custkey")).alias("new_child_id"))
    files = orders.select("o_orderkey", F.when(k % 3 > 0, F.concat(F.lit("p"), k)).alias("pid"), "source", "corpus_name", name(".cha").alias("path"))
    return identity.matched(files, old, fixes).select("o_orderkey", "truth")


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n FROM events GROUP BY ALL")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by hour of a stream of events, brought up to date as they come."""
    path = f"{sf_dir}/events.parquet"
    stream = ingest.files(spark, ingest.folder_of(path), spark.read.parquet(path).schema).withColumn("ts", F.col("ts").cast("timestamp"))
    out = _folder(spark)
    counts = ingest.windows(stream, "ts", "1 hour", late="36500 days", by=["event_type"]).select("event_type", F.col("window.start").alias("start"), "n")
    ingest.run(counts, f"{out}/state", ingest.upsert(f"{out}/data", ["event_type", "start"]), "update")
    return ingest.latest(spark, f"{out}/data", ["event_type", "start"]).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""WITH e AS (SELECT DISTINCT event_type, event_id, s FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events))
SELECT event_type, s AS start, count(*) AS n FROM e GROUP BY ALL""")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the last hour, each half hour."""
    counts = ingest.windows(table(spark, sf_dir, "events"), "ts", "1 hour", "30 minutes", by=["event_type"])
    return counts.select("event_type", F.col("window.start").alias("start"), "n")


@query("""WITH o AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE, true) AS opens FROM events),
s AS (SELECT user_id, ts, sum(opens::INTEGER) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM o)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user with less than half an hour between them."""
    counts = ingest.sessions(table(spark, sf_dir, "events"), "ts", "30 minutes", ["user_id"])
    return counts.select("user_id", F.col("session_window.start").alias("start"), "n")


@query("""WITH s AS (SELECT o_orderpriority AS g, o_orderstatus IN ('P', 'F') AS a, o_totalprice > 100000 AS b FROM orders) SELECT g, bool_and(a = b) AS same FROM s GROUP BY g""")
def equal_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether two flags agree on every row of a group, nulls with nulls."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("g"), F.col("o_orderstatus").isin("P", "F").alias("a"), (F.col("o_totalprice") > 100000).alias("b"))
    return rows.groupBy("g").agg(F.bool_and(F.col("a").eqNullSafe(F.col("b"))).alias("same"))


@query(f"""WITH {UTT} SELECT conv_id, ord AS utt_number, CASE WHEN len(tokens) > 0 THEN array_to_string(list_transform(tokens, lambda w: 'n|' || w), ' ') END AS mor, 'turn ' || ord AS com, NULL::VARCHAR AS act FROM u""")
def tier_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers of CHAT text as columns: of a repeated one the last, null where there is none."""
    items = F.array_join(F.transform("tokens", lambda w: F.concat(F.lit("n|"), w)), " ")
    line = F.concat(F.lit("*CHI:\t"), F.array_join("tokens", " "), F.lit("\n%mor:\tfirst one\n%mor:\t"), items, F.lit("\n%com:\tturn\n\t"), F.col("order"))
    rows = utt(spark, sf_dir).groupBy("conv_id").agg(L.ordered(line, F.col("order")).alias("lines"))
    files = rows.select(F.col("conv_id").cast("string").alias("path"), F.concat(F.lit("@Begin\n@Participants:\tCHI Target_Child\n"), F.array_join("lines", "\n"), F.lit("\n@End\n")).alias("text"))
    out = chat_text.wide(chat_text.utterances(files), ["mor", "com", "act"])
    return out.select(F.col("path").cast("long").alias("conv_id"), (F.col("utt_number") + 1).cast("long").alias("utt_number"), F.nullif("mor", F.lit("")).alias("mor"), "com", "act")


@query(r"""WITH g AS (SELECT conv_id, turn, list_filter(string_split_regex(regexp_replace(text, '[^0-9A-Za-z\s''_@+&=]', '', 'g'), '\s+'), lambda w: w <> '') AS w FROM conversations)
SELECT conv_id, turn + 1 AS utt_number, unnest(range(len(w))) AS word_order, unnest(w) AS gloss, 'n|' || unnest(w) AS mor, 'NA' AS at_tags FROM g""")
def archival_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archival word table of CHAT text: each word with its morphology item."""
    items = F.array_join(F.transform(S.clean_gloss(F.col("text")), lambda w: F.concat(F.lit("n|"), w)), " ")
    line = F.concat(F.lit("*CHI:\t"), F.array_join("tokens", " "), F.lit("\n%mor:\t"), items, F.lit(" ."))
    rows = utt(spark, sf_dir).groupBy("conv_id").agg(L.ordered(line, F.col("order")).alias("lines"))
    files = rows.select(F.col("conv_id").cast("string").alias("path"), F.concat(F.lit("@Begin\n"), F.array_join("lines", "\n"), F.lit("\n@End\n")).alias("text"))
    out = chat_text.word_rows(chat_text.utterances(files))
    return out.select(F.col("path").cast("long").alias("conv_id"), (F.col("utt_number") + 1).cast("long").alias("utt_number"), F.col("word_order").cast("long").alias("word_order"), "gloss", "mor", "at_tags")


@query(f"WITH {TOK} SELECT role, gloss, count(*) AS own, count(*) AS theirs FROM t GROUP BY ALL")
def external_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts read from a frequency program's output next to those of the table."""
    own = build.frequencies(tok(spark, sf_dir), ["role"])
    lines = F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("  "), F.col("count"), F.lit(" "), F.col("gloss")))), "\n")
    printed = own.groupBy("role").agg(F.concat(F.lit("From file <a.cha>\n"), lines, F.lit("\n------\n")).alias("out"))
    theirs = printed.select("role", F.explode(quality.unigram_counts(F.col("out"))).alias("x")).select("role", F.col("x.word").alias("gloss"), F.col("x.n").alias("theirs"))
    return own.join(theirs, ["role", "gloss"], "left").select("role", "gloss", F.col("count").cast("long").alias("own"), F.col("theirs").cast("long").alias("theirs"))


@query("SELECT event_id, (SELECT c_name FROM customer WHERE c_custkey = user_id) AS name FROM events")
def looked_up_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name looked up for each row by its id, null where there is none: one join for all rows."""
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    return table(spark, sf_dir, "events").join(names, "user_id", "left").select("event_id", "name")


@query("""SELECT 'langs' AS name, (SELECT count(*) FROM (SELECT lang FROM documents WHERE doc_id % 2 = 0 EXCEPT SELECT lang FROM documents WHERE doc_id % 2 = 1)) + (SELECT count(*) FROM (SELECT lang FROM documents WHERE doc_id % 2 = 1 EXCEPT SELECT lang FROM documents WHERE doc_id % 2 = 0)) = 0 AS same
UNION ALL SELECT 'keys', (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)) + (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)) = 0""")
def same_value_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether two columns hold the same set of values."""
    docs = table(spark, sf_dir, "documents")
    langs = quality.same_values(docs.where("doc_id % 2 = 0").select("lang"), docs.where("doc_id % 2 = 1").select("lang"))
    keys = quality.same_values(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")))
    return spark.createDataFrame([("langs", langs), ("keys", keys)], "name string, same boolean")


@query("SELECT DISTINCT p_type AS element, contains('the reader knows ECONOMY and SMALL parts', p_type) AS read FROM part")
def elements_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which elements of a schema a reader's source names."""
    elements = table(spark, sf_dir, "part").select(F.col("p_type").alias("element")).distinct()
    return quality.schema_coverage(elements, "the reader knows ECONOMY and SMALL parts")


@query("SELECT r_name AS name FROM region")
def corpus_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpora found by the marker file in their folders, at any depth."""
    base = _folder(spark)
    for r in table(spark, sf_dir, "region").collect():
        tables.Files(spark, f"{base}/bank{r.r_regionkey % 2}/{r.r_name}").write(f"{r.r_name}.zip_placeholder", "")
    return tables.corpus_roots(spark, base).select("name")


@query("""SELECT column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' ELSE 'timestamp_ntz' END AS type
FROM (SELECT column_name, column_type AS data_type FROM (DESCRIBE orders))""")
def export_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of an export from a database's listing of its columns."""
    named = {"bigint": "bigint", "string": "varchar", "double": "double", "timestamp_ntz": "datetime"}
    listing = [(f.name, named[f.dataType.simpleString()], i + 1) for i, f in enumerate(table(spark, sf_dir, "orders").schema)]
    schema = tables.export_schema(spark.createDataFrame(listing, "column_name string, data_type string, ordinal_position int"))
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "column_name string, type string")


@query("SELECT doc_id FROM documents WHERE doc_id % 4 = 1 OR doc_id IN (SELECT l_orderkey FROM lineitem)")
def skipped_pids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents left after skipping the PIDs of a list kept as JSON; a document without a PID is never skipped."""
    out = f"{_folder(spark)}/skip"
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 4 != 1, F.col("doc_id").cast("string")).alias("pid"))
    known = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("pid")).distinct()
    tables.write_json(docs.where("pid IS NOT NULL").join(known, "pid", "left_anti").select("pid"), out)
    return build.not_in_bank(docs, spark.read.schema("pid string").json(out)).select("doc_id")


@query("SELECT n_regionkey::VARCHAR AS region, n_name AS name, row_number() OVER (ORDER BY 'region=' || n_regionkey || '/name=' || n_name) AS place, true AS filled FROM nation")
def corpus_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a tree of folders in order of path, without reading them."""
    out = f"{_folder(spark)}/tree"
    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), F.col("n_name").alias("name"), "n_nationkey")
    rows.repartition(1).write.partitionBy("region", "name").json(out)
    listed = tables.corpus_files(spark, out, "*.json").select("size", F.split("path", "/").alias("p"))
    rank = F.row_number().over(Window.orderBy(F.array_join("p", "/"))).cast("long")
    return listed.select(F.substring_index(F.col("p")[0], "=", -1).alias("region"), F.substring_index(F.col("p")[1], "=", -1).alias("name"), rank.alias("place"), (F.col("size") > 0).alias("filled"))


@query(f"WITH {UTT} SELECT lpad(conv_id::VARCHAR, 8, '0') || '.json' AS path, count(*) AS num_utterances, sum(len(tokens))::BIGINT AS num_tokens FROM u GROUP BY conv_id")
def external_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents put through an external program, whose output is parsed; here one that copies its input."""
    docs = chat_json.parsed(chat_json.run_parser(as_json(utt(spark, sf_dir)), ["cat"]).where("error IS NULL"))
    tokens_of = F.aggregate("utterances", F.lit(0), lambda n, u: n + F.size(u["tokens"]))
    return docs.select("path", F.size("utterances").cast("long").alias("num_utterances"), tokens_of.cast("long").alias("num_tokens"))


@query(f"""WITH {TOK} SELECT 'few' AS asked, conv_id AS transcript_id, gloss, token_order::INTEGER AS token_order, role AS speaker_role FROM t WHERE gloss LIKE 'th%' OR gloss LIKE '%on'
UNION ALL SELECT 'many', conv_id, gloss, token_order::INTEGER, role FROM t WHERE role = 'assistant' AND gloss LIKE '%_e%'""")
def indexed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of few and of many glosses, whose patterns meet an index of the release's glosses."""
    base = _folder(spark)
    rows = tok(spark, sf_dir).select(F.col("conv_id").alias("transcript_id"), (F.col("conv_id") % 4).alias("corpus_id"), "gloss", F.col("token_order").cast("int").alias("token_order"), F.col("role").alias("speaker_role"))
    tables.write_table(rows, base, "2026.1", "token")
    release = Release(spark, base, "2026.1")
    release.index_glosses()
    few, many = release.tokens(["th%", "%on"]), release.tokens("%_e%", role="assistant")
    columns = ("transcript_id", "gloss", "token_order", "speaker_role")
    return few.select(F.lit("few").alias("asked"), *columns).unionByName(many.select(F.lit("many").alias("asked"), *columns))
