"""Queries of lexical measures and token tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.functions import lexical as L
from utterlake.functions import scalars as S
from utterlake.operators import build, diversity, quality, types
from utterlake.plans.adapters import TOK, UTT, table, tok, utt
from utterlake.plans.catalogue import query

KEY = ["conv_id", "role"]
#: Roles that a conversation's summary is spread over; checked.
MOST_ROLES = 100

# one direction of MTLD over a list w of lower-cased words, as a fold with the state (factors, tokens, types, ttr)
_FOLD = """list_reduce(list_transform({w}, lambda x: {{'f': 0.0::DOUBLE, 'n': 0, 't': [x], 'r': 0.0::DOUBLE}}),
  lambda s, x: CASE WHEN (CASE WHEN list_contains(s.t, x.t[1]) THEN len(s.t) ELSE len(s.t) + 1 END) / (s.n + 1)::DOUBLE <= 0.72
    THEN {{'f': s.f + 1, 'n': 0, 't': []::VARCHAR[], 'r': 1.0::DOUBLE}}
    ELSE {{'f': s.f, 'n': s.n + 1, 't': CASE WHEN list_contains(s.t, x.t[1]) THEN s.t ELSE list_append(s.t, x.t[1]) END,
      'r': (CASE WHEN list_contains(s.t, x.t[1]) THEN len(s.t) ELSE len(s.t) + 1 END) / (s.n + 1)::DOUBLE}} END,
  {{'f': 0.0::DOUBLE, 'n': 0, 't': []::VARCHAR[], 'r': 1.0::DOUBLE}})"""
_ONE = "(CASE WHEN {s}.f + (CASE WHEN {s}.n > 0 THEN (1.0::DOUBLE - {s}.r) / (1.0::DOUBLE - 0.72::DOUBLE) ELSE 0 END) > 0 THEN len(w) / ({s}.f + (CASE WHEN {s}.n > 0 THEN (1.0::DOUBLE - {s}.r) / (1.0::DOUBLE - 0.72::DOUBLE) ELSE 0 END)) ELSE -1 END)"
_MTLD = f"""
g AS (SELECT conv_id, role, list(lower(gloss) ORDER BY ord, token_order) AS w FROM t GROUP BY ALL),
f AS (SELECT conv_id, role, w, {_FOLD.format(w="w")} AS a, {_FOLD.format(w="list_reverse(w)")} AS b FROM g),
m AS (SELECT conv_id, role, CASE WHEN len(w) >= 50 THEN ({_ONE.format(s="a")} + {_ONE.format(s="b")}) / 2 END AS mtld FROM f)"""
_HDD = """
c AS (SELECT conv_id, role, lower(gloss) AS g, count(*) AS c FROM t GROUP BY ALL),
n AS (SELECT conv_id, role, sum(c) AS n FROM c GROUP BY ALL),
p AS (SELECT conv_id, role, g, any_value(n) AS n, product(greatest(n - c - i, 0)::DOUBLE / (n - i)) AS p0
  FROM c JOIN n USING (conv_id, role), range(42) r(i) WHERE n >= 50 GROUP BY ALL),
h AS (SELECT conv_id, role, CASE WHEN any_value(n) >= 50 THEN sum((1 - p0) / 42) END AS hdd FROM p GROUP BY conv_id, role)"""


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = utt(spark, sf_dir)
    roles = sorted((r.role for r in rows.select("role").distinct().limit(MOST_ROLES + 1).collect()), key=lambda r: (r is None, r or ""))
    if len(roles) > MOST_ROLES:
        raise ValueError(f"more than {MOST_ROLES} roles")
    speakers = rows.select("conv_id").distinct().withColumn("role", F.explode(F.array(*map(F.lit, roles))))
    return build.speaker_summary(rows, speakers, KEY)


@query(
    f"""WITH {TOK}, {_MTLD}, {_HDD},
k AS (SELECT conv_id, role FROM (SELECT DISTINCT conv_id FROM u), (SELECT DISTINCT role FROM u)),
s AS (SELECT conv_id, role, count(*) AS n, avg(len(tokens)) AS mlu_w, sum(len(tokens)) AS nt FROM u GROUP BY ALL),
mm AS (SELECT conv_id, role, avg(m) AS mlu_m, sum(m) AS nm FROM (SELECT conv_id, role, ord, sum(len(string_split(gloss, '-'))) AS m FROM t GROUP BY ALL) GROUP BY ALL),
d AS (SELECT conv_id, role, count(DISTINCT lower(gloss)) AS types FROM t GROUP BY ALL)
SELECT k.conv_id, k.role, coalesce(s.n, 0)::BIGINT AS num_utterances, round(mlu_w, 6) AS mlu_w, round(mlu_m, 6) AS mlu_m, round(mtld, 6) AS mtld, round(hdd, 6) AS hdd,
  coalesce(types, 0)::BIGINT AS num_types, coalesce(nt, 0)::BIGINT AS num_tokens, coalesce(nm, 0)::BIGINT AS num_morphemes
FROM k LEFT JOIN s USING (conv_id, role) LEFT JOIN mm USING (conv_id, role) LEFT JOIN d USING (conv_id, role) LEFT JOIN m USING (conv_id, role) LEFT JOIN h USING (conv_id, role)"""
)
def transcript_by_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary measures for each conversation and role, silent roles included."""
    out = _summary(spark, sf_dir)
    whole = [F.col(c).cast("long").alias(c) for c in ("num_types", "num_tokens", "num_morphemes")]
    return out.select("conv_id", "role", F.col("num_utterances").cast("long").alias("num_utterances"), *[F.round(c, 6).alias(c) for c in ("mlu_w", "mlu_m", "mtld", "hdd")], *whole)


@query(f"WITH {TOK} SELECT conv_id, role, gloss, count(*) AS count FROM t GROUP BY ALL")
def token_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each word, as spelled, occurs by conversation and role."""
    return build.frequencies(tok(spark, sf_dir), KEY).withColumn("count", F.col("count").cast("long"))


@query(f"WITH {TOK} SELECT role, lower(gloss) AS gloss, count(*) AS count, count(DISTINCT conv_id) AS num_conversations FROM t GROUP BY ALL")
def token_frequency_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word frequencies without regard to case, by a case-insensitive collation."""
    folded = F.collate("gloss", "UTF8_LCASE")
    out = tok(spark, sf_dir).groupBy("role", folded.alias("g")).agg(F.count("*").alias("count"), F.countDistinct("conv_id").alias("num_conversations"))
    return out.select("role", F.collate(F.lower("g"), "UTF8_BINARY").alias("gloss"), "count", "num_conversations")


@query(f"WITH {TOK}, {_MTLD} SELECT conv_id, role, round(mtld, 6) AS mtld FROM m")
def mtld_by_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.flatten(L.ordered(F.transform("tokens", F.lower), F.col("order")))
    return utt(spark, sf_dir).where("num_tokens > 0").groupBy(*KEY).agg(words.alias("w")).select(*KEY, F.round(L.mtld(F.col("w")), 6).alias("mtld"))


@query(
    f"""WITH {TOK},
g AS (SELECT role, list(lower(gloss) ORDER BY conv_id, ord, token_order) AS w FROM t GROUP BY ALL),
f AS (SELECT role, w, {_FOLD.format(w="w")} AS a, {_FOLD.format(w="list_reverse(w)")} AS b FROM g)
SELECT role, len(w) AS n_words, CASE WHEN len(w) >= 50 THEN round(({_ONE.format(s="a")} + {_ONE.format(s="b")}) / 2, 6) END AS mtld FROM f"""
)
def mtld_of_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTLD over all that is said in a role, by chunks of 4,096 words."""
    rows = utt(spark, sf_dir).select("role", "conv_id", "order", F.transform("tokens", F.lower).alias("words"))
    out = diversity.mtld(rows, ["role"], ["conv_id", "order"], "words", chunk=4096, ahead=512)
    return out.select("role", "n_words", F.round("mtld", 6).alias("mtld"))


@query(f"WITH {TOK}, {_HDD} SELECT conv_id, role, round(hdd, 6) AS hdd FROM n LEFT JOIN h USING (conv_id, role)")
def hdd_by_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HD-D from word frequencies alone: no ordered words are gathered."""
    counts = tok(spark, sf_dir).groupBy(*KEY, F.lower("gloss").alias("g")).agg(F.count("*").alias("c"))
    # types that occur equally often weigh equally, so counts of counts are enough
    each = counts.groupBy(*KEY, "c").agg(F.count("*").alias("types"))
    total = each.groupBy(*KEY).agg(F.sum(F.col("c") * F.col("types")).alias("n"), F.collect_list(F.struct("c", "types")).alias("k"))
    one = lambda s, x: s + x["types"] * L.hdd_of_counts(F.array(x["c"]), F.col("n"))
    return total.select(*KEY, F.round(F.when(F.col("n") >= L.LEAST, F.aggregate("k", F.lit(0.0), one)), 6).alias("hdd"))


@query(r"""WITH w AS (SELECT lang, unnest(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS w FROM documents)
SELECT lang, count(DISTINCT lower(w)) AS num_types, count(*) AS num_tokens, round(count(DISTINCT lower(w)) / count(*)::DOUBLE, 6) AS ttr FROM w GROUP BY lang""")
def ttr_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select("lang", F.explode(S.words(F.col("text"))).alias("w"))
    # counts by type first: the hot language's words are added up before they meet
    types = words.groupBy("lang", F.lower("w").alias("w")).agg(F.count("*").alias("n"))
    out = types.groupBy("lang").agg(F.count("*").alias("num_types"), F.sum("n").alias("num_tokens"))
    return out.select("*", F.round(L.ttr(F.col("num_types"), F.col("num_tokens").cast("double")), 6).alias("ttr"))


@query(f"""WITH {UTT}
SELECT conv_id, ord AS utterance_order, array_to_string(tokens, ' ') AS gloss, len(tokens)::BIGINT AS num_tokens,
  CASE role WHEN 'user' THEN 'question' WHEN 'assistant' THEN 'declarative' ELSE 'missing CA terminator' END AS type,
  CASE role WHEN 'user' THEN '?' ELSE '.' END AS mark, ord = 1 AS opens FROM u""")
def utterance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    terminator = S.lookup(F.col("role"), {"user": "question", "assistant": "period"})
    rows = utt(spark, sf_dir).withColumn("type", S.utterance_type(terminator))
    return rows.select("conv_id", F.col("order").alias("utterance_order"), S.join_non_empty(F.col("tokens")).alias("gloss"), F.col("num_tokens").cast("long").alias("num_tokens"), "type", S.closing_punctuation(F.col("type")).alias("mark"), (F.col("order") == 1).alias("opens"))


@query(f"""WITH {TOK}
SELECT (conv_id + 1) * 1000000000 + row_number() OVER (PARTITION BY conv_id ORDER BY ord, token_order) AS id, conv_id, ord AS utterance_order, token_order, gloss FROM t""")
def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = build.numbered(tok(spark, sf_dir), F.col("conv_id"), "order", "token_order")
    return rows.select("id", "conv_id", F.col("order").alias("utterance_order"), "token_order", "gloss")


@query(f"""WITH {TOK}, p AS (SELECT conv_id, role, ord, token_order, gloss AS word, CASE WHEN length(gloss) <= 2 THEN 'co' WHEN gloss LIKE 'x%' THEN 'unk' ELSE 'n' END AS pos FROM t),
s AS (SELECT conv_id, role, ord, list({{'w': word, 'p': pos}} ORDER BY token_order) AS s, sum(len(string_split(word, '-'))) AS m, count(*) FILTER (pos = 'co') AS co, bool_or(pos = 'unk') AS unk FROM p GROUP BY ALL),
k AS (SELECT *, lag(s) OVER (PARTITION BY conv_id, role ORDER BY ord) AS before FROM s WHERE NOT unk)
SELECT conv_id, role, round(coalesce(CASE WHEN count(*) FILTER (co = 0) > 0 THEN sum(m - co) / (count(*) FILTER (co = 0))::DOUBLE END, 0), 6) AS mlu
FROM (SELECT conv_id, role FROM s GROUP BY ALL) LEFT JOIN (SELECT * FROM k WHERE before IS NULL OR s <> before) USING (conv_id, role) GROUP BY ALL""")
def reader_mlu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reader's MLU, with words of up to two letters as fillers and words that begin with x as unintelligible."""
    pos = lambda w: F.when(F.length(w) <= 2, "co").when(F.startswith(w, F.lit("x")), "unk").otherwise("n")
    rows = utt(spark, sf_dir).where("num_tokens > 0").withColumn("s", F.transform("tokens", lambda w: F.struct(w.alias("word"), pos(w).alias("pos"))))
    return rows.groupBy(*KEY).agg(L.ordered(F.col("s"), F.col("order")).alias("u")).select(*KEY, F.round(L.reader_mlu(F.col("u")), 6).alias("mlu"))


@query("""SELECT conv_id, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS contiguous,
  coalesce(bool_and(rises), true) AS increasing FROM (SELECT conv_id, turn, turn > lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS rises FROM conversations) GROUP BY conv_id""")
def order_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    falls = quality.increasing(rows, ["conv_id"], "turn", "turn").select("conv_id").distinct().withColumn("falls", F.lit(True))
    return quality.contiguous(rows, ["conv_id"], "turn", 0).join(falls, "conv_id", "left").select("conv_id", F.col("ok").alias("contiguous"), F.col("falls").isNull().alias("increasing"))


@query("SELECT conv_id, turn, md5(conv_id || ':' || turn) AS h FROM conversations ORDER BY h LIMIT 20")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 rows at random, the same ones each time: those of least hash."""
    h = F.md5(F.concat_ws(":", "conv_id", "turn"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", h.alias("h")).orderBy("h").limit(20)


@query(f"""WITH {TOK}, p AS (SELECT conv_id, ord, list(gloss ORDER BY token_order) AS a, list(reverse(gloss) ORDER BY token_order) FILTER (length(gloss) > 1 OR ord % 2 = 0) AS b FROM t GROUP BY ALL)
SELECT conv_id, ord AS utterance_order, unnest(range(1, len(a) + 1)) AS token_order, unnest(a) AS gloss, unnest(CASE WHEN len(a) = len(b) THEN b ELSE list_transform(a, lambda x: '') END) AS phonology FROM p""")
def phonology_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sounds given to words by position where there are as many of both, else left empty."""
    sounds = F.transform(F.filter("tokens", lambda w: (F.length(w) > 1) | (F.col("order") % 2 == 0)), F.reverse)
    given = F.when(F.size(sounds) == F.size("tokens"), sounds).otherwise(F.transform("tokens", lambda w: F.lit("")))
    rows = utt(spark, sf_dir).select("conv_id", F.col("order").alias("utterance_order"), F.posexplode(F.arrays_zip("tokens", given.alias("sounds"))).alias("at", "x"))
    return rows.select("conv_id", "utterance_order", (F.col("at") + 1).cast("long").alias("token_order"), F.col("x.tokens").alias("gloss"), F.col("x.sounds").alias("phonology"))


@query(r"""WITH g AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(text, '[^0-9A-Za-z\s''_@+&=]', '', 'g'), '\s+'), lambda w: regexp_replace(w, '[!-/:-@\[-`{-~]', '', 'g') <> '' AND NOT (length(w) > 5 AND length(regexp_replace(w, '[0-9_\^+U] *', '', 'g')) <= 2)) AS w FROM documents)
SELECT doc_id, len(w)::BIGINT AS num_words, md5(array_to_string(w, ' ')) AS digest FROM g""")
def gloss_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = S.clean_gloss(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(w).cast("long").alias("num_words"), F.md5(F.array_join(w, " ")).alias("digest"))


@query(f"""WITH {TOK}, r(word, replacement, stems, n) AS (VALUES ('the', 'going to', 'go to', 3), ('of', 'out of', 'out of', 2), ('and', '', '', 1))
SELECT conv_id, ord AS utterance_order, token_order, gloss, coalesce(replacement, '') AS replacement, coalesce(nullif(stems, ''), gloss) AS stem, coalesce(n, 1)::BIGINT AS num_morphemes
FROM t LEFT JOIN r ON t.gloss = r.word""")
def replacement_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spoken words that stand for several: the replacement's morphology joined on one token."""
    words = "array<struct<text:string,stem:string,n:int>>"
    fixture = spark.createDataFrame([("the", [("going", "go", 2), ("to", "to", 1)]), ("of", [("out", "out", 1), ("of", "of", 1)]), ("and", [])], f"word string, replaced {words}")
    rows = tok(spark, sf_dir).join(F.broadcast(fixture), F.col("gloss") == F.col("word"), "left")
    joined = lambda f: S.join_non_empty(F.transform(F.coalesce("replaced", F.array().cast(words)), lambda w: w[f]))
    n = F.aggregate(F.coalesce("replaced", F.array().cast(words)), F.lit(0), lambda s, w: s + w["n"])
    stem = F.coalesce(F.nullif(joined("stem"), F.lit("")), "gloss")
    return rows.select("conv_id", F.col("order").alias("utterance_order"), "token_order", "gloss", joined("text").alias("replacement"), stem.alias("stem"), F.coalesce(F.nullif(n, F.lit(0)), F.lit(1)).cast("long").alias("num_morphemes"))


@query(f"WITH {TOK} SELECT role, initial, n, round(n / (sum(n) OVER (PARTITION BY role))::DOUBLE, 6) AS share FROM (SELECT role, lower(left(gloss, 1)) AS initial, count(*) AS n FROM t GROUP BY ALL)")
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tok(spark, sf_dir).groupBy("role", F.lower(F.left("gloss", F.lit(1))).alias("initial")).agg(F.count("*").alias("n"))
    return out.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy("role")), 6))


@query(f"""WITH {TOK}
SELECT (3 - grouping(role) - grouping(corpus) - grouping(conv_id))::INTEGER AS level, role, corpus, conv_id, count(DISTINCT lower(gloss)) AS num_types, count(*) AS num_tokens,
  round(count(DISTINCT lower(gloss)) / count(*), 6) AS ttr
FROM (SELECT *, conv_id % 7 AS corpus FROM t) GROUP BY GROUPING SETS ((), (role), (role, corpus), (role, corpus, conv_id)) HAVING count(*) > 0""")
def types_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types, tokens and their ratio of transcripts, corpora, roles and the whole, all from the bitmaps of transcripts."""
    rows = tok(spark, sf_dir).select("role", (F.col("conv_id") % 7).alias("corpus"), "conv_id", "gloss")
    return types.by_level(rows, ["role", "corpus", "conv_id"], F.lower("gloss")).withColumn("ttr", F.round("ttr", 6))
