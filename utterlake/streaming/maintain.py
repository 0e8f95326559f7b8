"""A release kept up to date while files are added, changed and removed.

Events name a file, when it was seen, and its utterances, or that it is gone. A batch looks up the files that it names as they were before,
takes their rows back and puts in the new ones: what remains of both, row by row, goes as signed counts to the logs of tokens, utterances and
frequencies, so that a file with one changed word costs a few rows, and no table is built again. Tables are the sums of their logs.

A batch reads only what earlier batches wrote and replaces its own folder, so a batch that is repeated after a failure changes nothing. Files are
dealt out by a hash of their path (PARTS), and a batch reads those parts alone that its files fall in. compacted() adds a log up into a new one.

Of several events of a file in a batch the latest counts, of equally late ones a removal, else one by its hash. A removal of an unknown file does nothing. Null tokens are
no words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = 256
EVENT = "path string, at long, removed boolean, corpus string, utterances array<struct<order:int,speaker:string,tokens:array<string>>>"
_FILE = "path string, removed boolean, corpus string, utterances array<struct<order:int,speaker:string,tokens:array<string>>>, part int, batch int"
LOGS = {
    "utterance": "corpus string, path string, utterance_order int, speaker string, num_tokens int",
    "token": "corpus string, path string, utterance_order int, token_order int, speaker string, gloss string",
    "frequency": "corpus string, speaker string, gloss string",
}


def _folder(base: str, name: str, batch: int) -> str:
    return f"{base}/{name}/batch={batch:09d}"


def _read(spark: SparkSession, base: str, name: str, before: int | None = None) -> DataFrame:
    """A log's rows, those of batches below `before`; none if nothing was written yet."""
    schema = _FILE if name == "file" else f"{LOGS[name]}, n long, batch int"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{base}/{name}")
    return rows if before is None else rows.where(F.col("batch") < before)


def _latest(files: DataFrame, *order: str) -> DataFrame:
    rest = [c for c in files.columns if c not in ("path", "part")]
    return files.groupBy("path", "part").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("f")).select("path", "part", "f.*")


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("path"), F.lit(parts)).cast("int")


def _utterances(files: DataFrame, sign: int) -> DataFrame:
    rows = files.where("NOT removed").select("corpus", "path", F.explode("utterances").alias("u"))
    return rows.select("corpus", "path", F.col("u.order").alias("utterance_order"), F.col("u.speaker").alias("speaker"), F.filter("u.tokens", lambda t: t.isNotNull()).alias("tokens"), F.lit(sign).cast("long").alias("n"))


def _net(rows: DataFrame) -> DataFrame:
    key = [c for c in rows.columns if c != "n"]
    return rows.groupBy(*key).agg(F.sum("n").alias("n")).where("n <> 0")


def writer(base: str, parts: int = PARTS) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that brings the release under base up to date with a batch of events (EVENT)."""

    def write(events: DataFrame, number: int) -> None:
        spark = events.sparkSession
        named = events.where("path IS NOT NULL").withColumns({"removed": F.coalesce("removed", F.lit(False)), "part": _part(parts), "tie": F.xxhash64("corpus", "utterances")})
        _latest(named, "at", "removed", "tie").select("path", "removed", "corpus", "utterances", "part").hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(_folder(base, "file", number))
        new = _read(spark, base, "file").where(F.col("batch") == number)
        keys = new.select("path", "part")
        old = _read(spark, base, "file", number).join(keys, ["part", "path"], "left_semi")
        said = _utterances(new, 1).unionByName(_utterances(_latest(old, "batch"), -1))
        counted = said.select("corpus", "path", "utterance_order", "speaker", F.size("tokens").alias("num_tokens"), "n")
        _net(counted).write.mode("overwrite").parquet(_folder(base, "utterance", number))
        words = said.select("corpus", "path", "utterance_order", "speaker", "n", F.posexplode("tokens").alias("at", "gloss"))
        words = words.select("corpus", "path", "utterance_order", (F.col("at") + 1).alias("token_order"), "speaker", "gloss", "n")
        _net(words).write.mode("overwrite").parquet(_folder(base, "token", number))
        changed = _read(spark, base, "token").where(F.col("batch") == number)
        _net(changed.where("gloss <> ''").select("corpus", "speaker", "gloss", "n")).write.mode("overwrite").parquet(_folder(base, "frequency", number))

    return write


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Rows of utterance or token, or the counts (n) of frequency, as the batches so far have left them."""
    rows = _net(_read(spark, base, name).drop("batch"))
    return rows if name == "frequency" else rows.drop("n")


def summaries(spark: SparkSession, base: str, key: list[str]) -> DataFrame:
    """key (of corpus, path, speaker), num_utterances, num_tokens, mlu_w: sums over the log, without making the rows."""
    log = _read(spark, base, "utterance")
    sums = log.groupBy(*key).agg(F.sum("n").alias("num_utterances"), F.sum(F.col("n") * F.col("num_tokens")).alias("num_tokens")).where("num_utterances > 0")
    return sums.withColumn("mlu_w", F.col("num_tokens") / F.col("num_utterances"))


def compacted(spark: SparkSession, base: str, out: str) -> None:
    """The state under base as one batch under out, numbered as the last one, where the stream can go on."""
    files = _read(spark, base, "file")
    last = files.agg(F.max("batch")).first()[0]
    if last is None:
        return
    _latest(files, "batch").where("NOT removed").select("path", "removed", "corpus", "utterances", "part").write.partitionBy("part").parquet(_folder(out, "file", last))
    for name in LOGS:
        _net(_read(spark, base, name).drop("batch")).write.parquet(_folder(out, name, last))
