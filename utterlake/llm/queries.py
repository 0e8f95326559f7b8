"""Queries of the training-data operators over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.llm import chat, decontam, licences, mixing, near, quality, resample, simhash, spelling, substrings, tokens, topk, warc
from utterlake.llm.common import cut, shared_dir, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Path of the public vocabulary that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's ids lie in the id stream, and their checksum, as read back from the shards."""
    rows = tokens.token_output(_table(spark, sf_dir, "documents"), vocabulary(), keep=False, as_text=False)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of each query with all other vectors."""
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


SQL_OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""


def op3_substring_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without bytes covered by repeated 400-byte strings."""
    return substrings.removal(_table(spark, sf_dir, "documents"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type and payload of each page's record, as read back from the archives."""
    out = shared_dir(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), out)
    return warc.read_warc(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL_OP4 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS n
  FROM pages),
f AS (SELECT digest, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.n >= 100
"""


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document."""
    return quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside windows of the benchmark."""
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


SQL_OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT k, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT k, i, dw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
words AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT k, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT k, i, n FROM hit)) GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT k, item_id::VARCHAR AS id FROM hit) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)
"""


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document under links of at least 80 % shared two-word shingles."""
    return near.near_duplicates(_table(spark, sf_dir, "documents"), words=2)


SQL_OP7 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS doc_id, b AS reach FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a),
c AS (SELECT doc_id, min(reach) AS least FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) AS component_id,
  least(d.doc_id, coalesce(least, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def op8_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each conversation, read back from formatted segments and prefix-target examples with their contexts."""
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    formatted = cut(chat.format_turns(turns), "chat-segments")
    trained = cut(chat.prompts(formatted), "chat-examples")
    return chat.read_back(formatted, trained)


SQL_OP8 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(12 + length(replace(replace(replace(role, chr(92), '\s'), '<', '\l'), chr(10), '\n')) + 1
      + length(replace(replace(text, chr(92), '\s'), '<', '\l')) + 11)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    rows = mixing.copies(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"))


SQL_OP9 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight FROM s),
l AS (
  SELECT *, source_size / weight AS fill,
    (1.5::DOUBLE * sum(source_size) OVER ()
     - coalesce(sum(source_size * 2) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
g AS (SELECT level FROM l WHERE source_size * 2 > weight * level ORDER BY fill, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN source_size * 2 <= weight * level THEN (source_size * 2)::DOUBLE ELSE weight * (SELECT level FROM g) END AS target FROM l),
r AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS rate FROM t)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN ('0x' || substr(md5('9:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source / thousands / fifties / name, where each fiftieth document is a licence file."""
    n = F.col("doc_id")
    name = F.when(n % 50 == 0, F.lit("LICENSE")).otherwise(F.concat(n.cast("string"), F.lit(".txt")))
    return docs.withColumn("path", F.concat_ws("/", "source", F.floor(n / 1000).cast("string"), F.floor(n / 50).cast("string"), name))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of each document, by itself or from its directories."""
    return licences.scan(as_files(_table(spark, sf_dir, "documents")))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint of each document, and its component under links at 4 or fewer differing bits."""
    return simhash.near_fingerprints(_table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of each word, with one run in 199 misspelt."""
    rows = spelling.variants(_table(spark, sf_dir, "documents"), noise=spelling.NOISE)
    return rows.select("word", "form", "root", "n", "n_near", "form_n")


#: crc32 of the strings s of a table, byte by byte: a list of 256 remainders, then a fold over the bytes.
_CRC = """
crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS r),
{out} AS (
  SELECT s, xor(list_reduce(list_transform(range(1, 2 * octet_length(encode(s)) + 1, 2), lambda i: ('0x' || substr(hex(encode(s)), i, 2))::BIGINT),
    lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM {of}, crc)"""

SQL_OP12 = (
    r"""
WITH RECURSIVE d AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
c AS (SELECT id || ':' || run AS s, run, count(*) AS n FROM d WHERE length(run) >= 6 GROUP BY id, run),"""
    + _CRC.format(out="hashed", of="c")
    + r""",
o AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM c JOIN hashed USING (s)),
w AS (SELECT word, sum(n)::BIGINT AS n FROM o WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
k AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS g FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT x.word AS a, y.word AS b, y.n FROM k x JOIN k y ON x.g = y.g AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, w.word, w.n FROM k x JOIN w ON x.g = w.word
  UNION SELECT w.word, x.word, x.n FROM k x JOIN w ON x.g = w.word),
b AS (SELECT a, count(*) AS n_near, max(n) AS most FROM p GROUP BY a),
f AS (SELECT p.a, min(p.b) AS form, most FROM p JOIN b ON p.a = b.a AND p.n = b.most GROUP BY p.a, most),
g AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN f.most >= 5 * w.n THEN form END AS form, CASE WHEN f.most >= 5 * w.n THEN f.most END::BIGINT AS form_n
  FROM w LEFT JOIN b ON w.word = b.a LEFT JOIN f ON w.word = f.a),
t AS (
  SELECT word AS leaf, word AS at, form AS up FROM g
  UNION ALL SELECT t.leaf, g.word, g.form FROM t JOIN g ON t.up = g.word)
SELECT word, g.form, t.at AS root, n, n_near, form_n FROM g JOIN t ON t.leaf = g.word AND t.up IS NULL
"""
)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of each document towards the benchmark's word runs, and the rank of those that are drawn."""
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


SQL_OP13 = (
    r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (
  SELECT k, s, count(*) AS n FROM (
    SELECT k, array_to_string(w[i : i + m], ' ') AS s FROM (SELECT k, w, m, unnest(range(1, len(w) - m + 1)) AS i FROM d, (SELECT unnest([0, 1, 2]) AS m) WHERE len(w) > m))
  GROUP BY k, s),
bf AS (
  SELECT s, count(*) AS n FROM (
    SELECT array_to_string(w[i : i + m], ' ') AS s FROM (SELECT w, m, unnest(range(1, len(w) - m + 1)) AS i FROM b, (SELECT unnest([0, 1, 2]) AS m) WHERE len(w) > m))
  GROUP BY s),
every AS (SELECT s FROM df UNION SELECT s FROM bf),"""
    + _CRC.format(out="hashed", of="every")
    + r""",
db AS (SELECT k, h % 10000 AS bucket, sum(n) AS n FROM df JOIN hashed USING (s) GROUP BY k, bucket),
sb AS (SELECT bucket, sum(n)::DOUBLE AS s FROM db GROUP BY bucket),
tb AS (SELECT h % 10000 AS bucket, sum(n)::DOUBLE AS t FROM bf JOIN hashed USING (s) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000::DOUBLE * ln((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM sb) + 10000)
    / ((s + 1) * (coalesce((SELECT sum(t) FROM tb), 0) + 10000))))::BIGINT AS gain
  FROM sb LEFT JOIN tb USING (bucket)),
wt AS (SELECT k, sum(n * gain)::BIGINT AS weight FROM db JOIN gain USING (bucket) GROUP BY k),
sc AS (
  SELECT k, doc_id, len(w) AS words, (greatest(len(w), 0) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0))::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000::DOUBLE * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN wt USING (k)),
rk AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM sc WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * n // 100 THEN r END::BIGINT AS rank FROM sc LEFT JOIN rk USING (k)
"""
)


_QUERIES = [
    (op1_token_output, None),
    (op2_top_products, SQL_OP2),
    (op3_substring_removal, None),
    (op4_warc_revisits, SQL_OP4),
    (op5_quality, None),
    (op6_benchmark_hits, SQL_OP6),
    (op7_near_duplicates, SQL_OP7),
    (op8_chat_examples, SQL_OP8),
    (op9_source_mix, SQL_OP9),
    (op10_licences, None),
    (op11_fingerprints, None),
    (op12_spelling, SQL_OP12),
    (op13_resampling, SQL_OP13),
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {f.__name__: f for f, _ in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: sql for f, sql in _QUERIES if sql}
