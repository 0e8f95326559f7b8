"""Plain CHAT text: headers, speaker lines and tiers, split by Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake.functions import scalars as S
from utterlake.functions.archival import MARKERS, realign_reformulations, reconcile


def read(spark: SparkSession, root: str, pattern: str = "*.cha") -> DataFrame:
    """path, text of each file."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def header(text: Column, name: str) -> Column:
    """Content of the first @name header, or null."""
    return F.nullif(F.trim(F.regexp_extract(text, rf"(?m)^@{name}:\t?(.*)$", 1)), F.lit(""))


def utterances(files: DataFrame) -> DataFrame:
    """A row for each speaker line: path, utt_number, speaker, verbatim, gloss, tiers (map), and the file's headers.

    A tier that appears twice keeps its last content.
    """
    body = F.regexp_replace("text", r"\n@End\s*$", "")
    child = F.split(F.regexp_extract("text", r"(?m)^(@ID:.*Target_Child.*)$", 1), r"\|")
    at = lambda i: F.nullif(F.trim(F.coalesce(F.try_element_at(child, F.lit(i)), F.lit(""))), F.lit(""))
    rows = files.select(
        "path",
        header(F.col("text"), "Participants").alias("participants"),
        header(F.col("text"), "Date").alias("date"),
        header(F.col("text"), "Situation").alias("situation"),
        F.regexp_extract(at(1), r"@ID:\s*(\S+)", 1).alias("language"),
        at(2).alias("corpus"), at(4).alias("age"), at(5).alias("gender"),
        F.posexplode(F.slice(F.split(body, r"\n\*"), F.lit(2), F.lit(2_000_000_000))).alias("utt_number", "block"),
    )
    fields = F.split("block", r"\n%")
    said = F.substr(fields[0], F.lit(5))
    kept = F.filter(F.split(said, r"\n"), lambda x: ~F.startswith(x, F.lit("@")))
    tiers = F.transform(F.slice(fields, F.lit(2), F.lit(2_000_000_000)), lambda t: F.struct(F.left(t, F.lit(3)), F.trim(F.regexp_replace(F.substr(t, F.lit(5)), r"\s+", " "))))
    # the last of repeated tiers
    last = F.aggregate(tiers, F.create_map().cast("map<string,string>"), lambda m, t: F.map_concat(F.map_filter(m, lambda k, _: k != t["col1"]), F.create_map(t["col1"], t["col2"])))
    rows = rows.withColumns({"speaker": F.left(fields[0], F.lit(3)), "verbatim": F.trim(F.regexp_replace(F.array_join(kept, " "), r"\s+", " ")), "tiers": last})
    return rows.withColumn("gloss", S.adult_gloss(F.col("verbatim"))).drop("block")


def wide(rows: DataFrame, names: list[str]) -> DataFrame:
    """Tiers as columns; a tier that an utterance lacks is null."""
    return rows.select("*", *[F.col("tiers")[n].alias(n) for n in names]).drop("tiers")


def word_rows(rows: DataFrame) -> DataFrame:
    """A row for each word of utterances with a mor tier: gloss, mor, at_tags, word_order, and the utterance's columns.

    Utterances with more morphology items than words are left out.
    """
    words = S.clean_gloss(F.col("gloss"))
    plain = S.clean_mor(F.coalesce(F.col("tiers")["mor"], F.lit("")))
    mor = F.when(F.rlike("gloss", F.lit(MARKERS)), realign_reformulations(F.col("gloss"), plain)).otherwise(plain)
    rows = rows.withColumns({"_words": words, "_mor": mor}).withColumn("_mor", reconcile(F.col("_words"), F.col("_mor"))).where("_mor IS NOT NULL")
    rows = rows.withColumns({"sent_gloss": F.array_join("_words", " "), "sent_mor": F.array_join("_mor", " ")})
    rows = rows.withColumnRenamed("gloss", "utterance_gloss").select("*", F.posexplode(F.arrays_zip("_words", "_mor")).alias("word_order", "w"))
    word, tag = S.tag_word(F.col("w._words"))
    return rows.select(word.alias("gloss"), F.col("w._mor").alias("mor"), tag.alias("at_tags"), "word_order", *[c for c in rows.columns if c not in ("_words", "_mor", "w", "word_order")])


def head_field(content: Column, pattern: str, n_bytes: int = 4096) -> Column:
    """A header field from a file's first bytes (binary column): the pattern's first group, or null."""
    head = F.decode(F.substring(content, 1, n_bytes), "UTF-8")
    folded = F.regexp_replace(head, r"\n\t", " ")  # continuation lines
    return F.nullif(F.regexp_extract(folded, pattern, 1), F.lit(""))


def pid_of(content: Column) -> Column:
    return head_field(content, r"(?m)^@PID:\s*(\S+)")


def child_name_of(content: Column) -> Column:
    """How the participants header names CHI, null if it doesn't."""
    people = head_field(content, r"(?m)^@Participants:\s*(.*)$", 6000)
    return F.nullif(F.regexp_extract(people, r"(?:^|,)\s*CHI\s+(?!Target_Child)(\S+)\s+Target_Child", 1), F.lit(""))


def pids(spark: SparkSession, root: str) -> DataFrame:
    """Distinct PIDs of the CHAT files under root, from their headers alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.cha").load(root)
    return files.select(pid_of(F.col("content")).alias("pid")).where("pid IS NOT NULL").distinct()


def child_names(spark: SparkSession, root: str) -> DataFrame:
    """path, name: how each file's participants header names its CHI, null if it doesn't."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.cha").load(root)
    return files.select("path", child_name_of(F.col("content")).alias("name"))
