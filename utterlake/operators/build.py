"""Corpus tables from parsed documents.

Ids are deterministic: a corpus owns a block of BLOCK ids, and rows are numbered within it in the order of file and
position. Utterances, tokens and morphemes are numbered within their file, behind the running total of the files before it, so only
a row for each file is ordered by corpus; AQE spreads everything else by its own keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake import schemas
from utterlake.functions import lexical as L
from utterlake.functions import scalars as S

BLOCK = 1_000_000_000
TARGET = "Target_Child"


def numbered(df: DataFrame, block: Column, *order: str, name: str = "id", sizes: DataFrame | None = None) -> DataFrame:
    """df with ids (block + 1) * BLOCK + n, n counted from 1 in the given order within a block. A block that overflows is an error.

    sizes: block, the first order column (which no two blocks share), and n, how many rows df has of it. Rows are then numbered
    within that column's values and put behind those before, so that no task holds all rows of a block.
    """
    if sizes is None:
        n = F.row_number().over(W.partitionBy(block).orderBy(*order)).cast("long")
    else:
        part = order[0]
        before = F.sum("n").over(W.partitionBy("block").orderBy(part).rowsBetween(W.unboundedPreceding, -1))
        df = df.join(sizes.select(part, F.coalesce(before, F.lit(0)).alias("_before")), part)
        n = F.col("_before") + F.row_number().over(W.partitionBy(part).orderBy(*order[1:]))
    fits = F.when(n < BLOCK, n).otherwise(F.raise_error(F.lit("a block of ids is full")).cast("long"))
    return df.withColumn(name, (block + 1) * F.lit(BLOCK).cast("long") + fits).drop("_before")


def block_usage(tables: Mapping[str, DataFrame], id: str = "id") -> DataFrame:
    """name, largest, fits: the most ids that any block of each table holds, and whether that leaves room in a block."""
    used = [df.agg(F.lit(name).alias("name"), F.max(F.pmod(F.col(id), F.lit(BLOCK))).alias("largest")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, used).withColumn("fits", F.coalesce(F.col("largest") < BLOCK - 1, F.lit(True)))


def sizes(docs: DataFrame) -> DataFrame:
    """corpus_id, path, utterances, tokens, morphemes: how many of each a document holds, without taking them apart."""
    def total(array: Column, of) -> Column:
        return F.coalesce(F.aggregate(array, F.lit(0).cast("long"), lambda n, x: n + of(x)), F.lit(0).cast("long"))

    size = lambda a: F.when(a.isNull(), 0).otherwise(F.size(a)).cast("long")
    said = F.col("utterances")
    n_tokens = total(said, lambda u: size(u["tokens"]))
    n_morphemes = total(said, lambda u: total(u["tokens"], lambda t: size(t["morphemes"])))
    return docs.select("corpus_id", "path", size(said).alias("utterances"), n_tokens.alias("tokens"), n_morphemes.alias("morphemes"))


def _of(counts: DataFrame | None, column: str, block: str = "corpus_id", part: str = "path") -> DataFrame | None:
    return None if counts is None else counts.select(F.col(block).alias("block"), part, F.col(column).alias("n"))


def dimensions(corpora: DataFrame) -> tuple[DataFrame, DataFrame]:
    """collection and corpus tables of corpora (collection_name, corpus_name, data_source), numbered by name from 1."""
    names = corpora.select("collection_name", "data_source").groupBy("collection_name").agg(F.min("data_source").alias("data_source"))
    collection = names.select(F.row_number().over(W.orderBy("collection_name")).cast("long").alias("id"), F.col("collection_name").alias("name"), "data_source")
    of = collection.select(F.col("id").alias("collection_id"), F.col("name").alias("collection_name"))
    corpus = corpora.select("collection_name", "corpus_name", "data_source").distinct().join(of, "collection_name")
    corpus = corpus.select(F.row_number().over(W.orderBy("collection_name", "corpus_name")).cast("long").alias("id"), F.col("corpus_name").alias("name"), "collection_id", "collection_name", "data_source")
    return collection, corpus


def first_copies(docs: DataFrame, *order: str) -> DataFrame:
    """docs without later rows of a pid; rows without a pid stay, and are dealt out by the order's columns, not to one task."""
    apart = F.when(F.col("pid").isNull(), F.xxhash64(*order))
    n = F.row_number().over(W.partitionBy("pid", apart).orderBy(*order))
    return docs.withColumn("_n", F.when(F.col("pid").isNotNull(), n).otherwise(1)).where("_n = 1").drop("_n")


def not_in_bank(docs: DataFrame, other: DataFrame) -> DataFrame:
    """docs whose pid the other bank lacks (rows without a pid stay). Spark broadcasts the pids if they are few."""
    return docs.join(other.select("pid").where("pid IS NOT NULL").distinct(), "pid", "left_anti")


def people(docs: DataFrame, identity: DataFrame | None = None) -> DataFrame:
    """A row for each participant of each document: corpus_id, path, position, code, name, role, age, is_target, identity_key, and what is said of them.

    Codes that speak without being declared are added with a null name and role. The target child is the one participant
    with that role; of none or several there is none. identity (corpus_id, path, key, name) renames target children.
    """
    declared = docs.select("corpus_id", "path", F.posexplode("participants").alias("position", "p")).select("corpus_id", "path", "position", "p.*")
    spoken = docs.select("corpus_id", "path", F.explode(F.array_distinct(F.transform("utterances", lambda u: u["speaker"]))).alias("code"))
    missing = spoken.where("code IS NOT NULL").join(declared.select("path", "code"), ["path", "code"], "left_anti").withColumn("position", F.lit(1_000_000))
    rows = declared.unionByName(missing, allowMissingColumns=True)
    n_targets = F.sum((F.col("role") == TARGET).cast("int")).over(W.partitionBy("path"))
    rows = rows.withColumns({"age": S.age_days_chat(F.col("age")), "is_target": F.coalesce((F.col("role") == TARGET) & (n_targets == 1), F.lit(False))})
    if identity is None:
        return rows.withColumn("identity_key", F.col("name"))
    known = identity.select("corpus_id", "path", F.col("key").alias("_key"), F.col("name").alias("_name"), F.lit(True).alias("_known"))
    rows = rows.join(known, ["corpus_id", "path"], "left")
    renamed = F.col("is_target") & F.coalesce("_known", F.lit(False))
    return rows.withColumns({"identity_key": F.when(renamed, F.col("_key")).otherwise(F.col("name")), "name": F.when(renamed, F.col("_name")).otherwise(F.col("name"))}).drop("_key", "_name", "_known")


def participants(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The participant table without denormalized names, and path, code -> participant id.

    A target child is one by corpus, code, identity and role; anyone else by that and the target child of the file. The first file
    (in path order) that names a person says what is known of them; ages widen the range, zero and unknown ones apart.
    """
    targets = rows.where("is_target").select("path", F.struct("code", "identity_key").alias("child"))
    rows = rows.join(targets, "path", "left").withColumn("child_key", F.when(~F.col("is_target"), F.col("child")))
    key = ["corpus_id", "code", "identity_key", "role", "child_key"]
    facts = ["name", "language", "group", "sex", "ses", "education", "custom"]
    first = F.min_by(F.struct(*facts, "path", "position"), F.struct("path", "position")).alias("first")
    age = F.when(F.col("age") > 0, F.col("age"))
    table = rows.groupBy(*key).agg(first, F.min(age).alias("min_age"), F.max(age).alias("max_age"))
    table = numbered(table.withColumns({"_path": F.col("first.path"), "_position": F.col("first.position")}), F.col("corpus_id"), "_path", "_position", "code")
    named = table.select(F.col("id").alias("speaker_id"), *[F.col(k).alias(f"_{k}") for k in key])
    ids = rows.join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]).select("path", "code", "speaker_id")
    child_ids = ids.join(targets.select("path", F.col("child.code").alias("code")), ["path", "code"]).select("path", F.col("speaker_id").alias("target_child_id"))
    of_person = ids.join(child_ids, "path", "left").groupBy("speaker_id").agg(F.min("target_child_id").alias("target_child_id"))
    table = table.join(of_person, table["id"] == of_person["speaker_id"], "left").select("id", "corpus_id", "code", "role", *[F.col(f"first.{f}").alias(f) for f in facts], "min_age", "max_age", "target_child_id")
    return table, ids


def transcripts(docs: DataFrame, rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The transcript table with its target child's name, age and sex."""
    child = rows.where("is_target").select("path", "code", F.col("name").alias("target_child_name"), F.col("age").alias("target_child_age"), F.col("sex").alias("target_child_sex"))
    child = child.join(ids, ["path", "code"]).withColumnRenamed("speaker_id", "target_child_id").drop("code")
    out = numbered(docs, F.col("corpus_id"), "path", name="transcript_id").join(child, "path", "left")
    return out.select("transcript_id", "corpus_id", "path", F.array_join("languages", " ").alias("language"), S.chat_date(F.col("date")).alias("date"), F.col("path").alias("filename"), "pid", "target_child_id", "target_child_name", "target_child_age", "target_child_sex")


def utterances(docs: DataFrame, transcript: DataFrame, rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The utterance table, with tokens kept in place as an array for tokens() and speaker summaries."""
    counts = _of(sizes(docs), "utterances")
    said = docs.select("path", F.posexplode("utterances").alias("at", "u")).select("path", (F.col("at") + 1).alias("utterance_order"), "u.*")
    who = rows.join(ids, ["path", "code"]).select("path", F.col("code").alias("speaker"), "speaker_id", F.col("name").alias("speaker_name"), F.col("role").alias("speaker_role"))
    out = said.join(transcript.drop("date", "filename", "pid"), "path").join(who, ["path", "speaker"], "left")
    field = lambda f: S.join_non_empty(F.transform("tokens", lambda t: t[f]))
    counted = F.filter(F.transform("tokens", lambda t: t["num_morphemes"]), lambda n: n.isNotNull())
    out = out.withColumns(
        {
            "gloss": field("gloss"), "stem": field("stem"), "part_of_speech": field("pos"),
            "actual_phonology": F.array_join("actual", " "), "model_phonology": F.array_join("model", " "),
            "type": S.utterance_type(F.col("terminator")),
            "num_tokens": F.size(F.filter("tokens", lambda t: t["gloss"] != "")),
            "num_morphemes": F.when(F.size(counted) > 0, F.aggregate(counted, F.lit(0), lambda a, n: a + n)),
            "media_start": F.col("start_ms") / 1000, "media_end": F.col("end_ms") / 1000, "media_unit": F.when(F.col("start_ms").isNotNull(), "s"),
            "speaker_code": F.col("speaker"),
        }
    )
    return numbered(out, F.col("corpus_id"), "path", "utterance_order", sizes=counts)


def tokens(utterance: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """The token table, with morphemes kept in place. counts: those of sizes(); without them a corpus is numbered as a whole."""
    head = ["corpus_id", "transcript_id", "speaker_id", "speaker_code", "speaker_name", "speaker_role", "target_child_id", "target_child_name", "target_child_age", "target_child_sex", "language", "path", "utterance_order"]
    rows = utterance.select(F.col("id").alias("utterance_id"), F.col("type").alias("utterance_type"), *head, F.posexplode("tokens").alias("at", "t"))
    rows = rows.select("*", "t.*").drop("t").withColumns({"token_order": F.col("at") + 1, "part_of_speech": F.col("pos"), "prefix": F.lit(""), "english": F.lit("")})
    return numbered(rows, F.col("corpus_id"), "path", "utterance_order", "at", sizes=_of(counts, "tokens")).drop("at", "pos")


def token_morphemes(token: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """The morpheme table; features are written as JSON. counts: as of tokens()."""
    rows = token.select(F.col("id").alias("token_id"), "utterance_id", "transcript_id", "corpus_id", "speaker_id", "speaker_role", "target_child_id", "language", "path", "utterance_order", "token_order", F.posexplode("morphemes").alias("at", "m"))
    rows = rows.select("*", (F.col("at") + 1).alias("morpheme_order"), "m.type", "m.lemma", "m.pos", F.to_json("m.features").alias("features"))
    return numbered(rows, F.col("corpus_id"), "path", "utterance_order", "token_order", "at", sizes=_of(counts, "morphemes")).drop("at", "m")


def speaker_summary(rows: DataFrame, speakers: DataFrame, key: list[str]) -> DataFrame:
    """Summary measures by key: num_utterances, mlu_w, mlu_m, mtld, hdd, num_types, num_tokens, num_morphemes.

    rows: an utterance each, with order, tokens (array of glosses), num_tokens and num_morphemes. speakers: every key that is to
    have a row; one without utterances has counts of 0 and no means. Types are lower-cased, in MTLD and HD-D as well.
    """
    glosses = F.filter(F.transform("tokens", lambda t: F.lower(t)), lambda t: t != "")
    each = rows.withColumn("_glosses", glosses)
    sums = each.groupBy(*key).agg(
        F.count("*").cast("int").alias("num_utterances"),
        F.avg("num_tokens").alias("mlu_w"),
        F.avg("num_morphemes").alias("mlu_m"),
        F.sum("num_tokens").cast("int").alias("num_tokens"),
        F.sum("num_morphemes").cast("int").alias("num_morphemes"),
        F.flatten(L.ordered(F.col("_glosses"), F.col("order"))).alias("_words"),
    )
    out = speakers.select(*key).distinct().join(sums.withColumn("_d", L.diversity(F.col("_words"))), key, "left")
    whole = [F.coalesce(c, F.lit(0)).alias(c) for c in ("num_utterances", "num_tokens", "num_morphemes")]
    return out.select(*key, "mlu_w", "mlu_m", *whole, F.coalesce("_d.num_types", F.lit(0)).alias("num_types"), "_d.mtld", "_d.hdd")


def corpus_mlu(summary: DataFrame, by: list[str]) -> DataFrame:
    """MLU in words of all utterances together, from summaries of parts (mlu_w, num_utterances): by, mlu_w, num_utterances."""
    said = F.sum(F.col("mlu_w") * F.col("num_utterances"))
    return summary.where("num_utterances > 0").groupBy(*by).agg((said / F.sum("num_utterances")).alias("mlu_w"), F.sum("num_utterances").alias("num_utterances"))


def frequencies(token: DataFrame, key: list[str], gloss: str = "gloss") -> DataFrame:
    """How often each non-empty gloss, as spelled, occurs by key."""
    return token.where(F.col(gloss) != "").groupBy(*key, gloss).agg(F.count("*").cast("int").alias("count"))


def admin(spark: SparkSession, version: str, date: str | None = None) -> DataFrame:
    """The one-row table of a release's date (today, if none is given) and version."""
    day = F.lit(date).cast("date") if date else F.current_date()
    return spark.range(1).select(F.lit(1).cast("long").alias("id"), day.alias("date"), F.lit(version).alias("version"))


def release(docs: DataFrame, corpora: DataFrame, identity: DataFrame | None = None, scratch: str | None = None) -> dict[str, DataFrame]:
    """All tables of documents (chat_json.DOCUMENT with corpus_name and collection_name) and their corpora, as schemas.TABLES has them.

    scratch: a shared folder for the people, transcripts and utterances that several tables are made of; without it each table
    makes them again.
    """

    def kept(df: DataFrame, name: str) -> DataFrame:
        if scratch is None:
            return df
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{scratch}/{name}")

    collection, corpus = dimensions(corpora)
    names = corpus.select(F.col("id").alias("corpus_id"), F.col("name").alias("corpus_name"), "collection_id", "collection_name")  # Spark broadcasts it if it is small
    docs = docs.where("error IS NULL").join(names, ["collection_name", "corpus_name"])
    docs = first_copies(docs, "corpus_id", "path").drop("corpus_name", "collection_name", "collection_id")
    rows = kept(people(docs, identity), "people")
    participant, ids = participants(rows)
    participant, ids = kept(participant, "participant"), kept(ids, "ids")
    transcript = kept(transcripts(docs, rows, ids), "transcript")
    utterance = kept(utterances(docs, transcript, rows, ids), "utterance")
    counts = sizes(docs)
    token = tokens(utterance, counts)
    named = lambda df: df.join(names, "corpus_id")
    key = ["corpus_id", "transcript_id", "speaker_id"]
    child = transcript.select("transcript_id", "language", "target_child_id", "target_child_name", "target_child_age", "target_child_sex")
    present = ids.join(transcript.select("path", "transcript_id", "corpus_id"), "path")
    roles = participant.select(F.col("id").alias("speaker_id"), F.col("role").alias("speaker_role"))
    said = utterance.withColumns({"order": F.col("utterance_order"), "tokens": F.transform("tokens", lambda t: t["gloss"])})
    tbs = speaker_summary(said, present, key).join(child, "transcript_id").join(roles, "speaker_id")
    tf = frequencies(token, key).join(child, "transcript_id").join(roles, "speaker_id")
    per_file = present.select(*key).distinct().groupBy(F.col("corpus_id").alias("block"), "transcript_id").agg(F.count("*").alias("n"))
    words_per_file = tf.groupBy(F.col("corpus_id").alias("block"), "transcript_id").agg(F.count("*").alias("n"))
    out = {
        "collection": collection,
        "corpus": corpus,
        "participant": named(participant),
        "transcript": named(transcript.withColumnRenamed("transcript_id", "id")),
        "utterance": named(utterance),
        "token": named(token),
        "token_morpheme": named(token_morphemes(token, counts)),
        "transcript_by_speaker": named(numbered(tbs, F.col("corpus_id"), "transcript_id", "speaker_id", sizes=per_file)),
        "token_frequency": named(numbered(tf, F.col("corpus_id"), "transcript_id", "speaker_id", "gloss", sizes=words_per_file)),
    }
    return {k: schemas.conform(v, schemas.TABLES[k]) for k, v in out.items()}
