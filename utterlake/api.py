"""Reading a release: table getters by name, speaker and child, and SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utterlake import schemas
from utterlake.sources.tables import Files, read_table, release_views

Names = str | Sequence[str] | None

#: Glosses that a getter writes into its filter; of more it makes a join.
FEW = 500


def _fits(patterns: list[str]) -> Column:
    """Whether a gloss fits any of the patterns."""
    out: Column = F.lit(False)
    for p in patterns:
        out = out | F.col("gloss").like(p)
    return out


class Release:
    """The tables under base/version."""

    def __init__(self, spark: SparkSession, base: str, version: str):
        self.spark, self.base, self.version = spark, base, version

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base, self.version, name)

    def _get(self, table: str, age: tuple[float, float] | None = None, **wanted: Names) -> DataFrame:
        """Rows of a table whose columns are among the wanted values; ages are in months of 365.25 / 12 days."""
        df = self.table(table)
        for column, values in wanted.items():
            if values is not None:
                df = df.where(F.col(column).isin([values] if isinstance(values, str) else list(values)))
        if age is not None:
            month = 365.25 / 12
            df = df.where(F.col("target_child_age").between(age[0] * month, age[1] * month))
        return df

    def collections(self) -> DataFrame:
        return self.table("collection")

    def corpora(self, collection: Names = None) -> DataFrame:
        return self._get("corpus", collection_name=collection)

    def participants(self, collection: Names = None, corpus: Names = None, role: Names = None, sex: Names = None) -> DataFrame:
        return self._get("participant", collection_name=collection, corpus_name=corpus, role=role, sex=sex)

    def transcripts(self, collection: Names = None, corpus: Names = None, language: Names = None, age=None) -> DataFrame:
        return self._get("transcript", age, collection_name=collection, corpus_name=corpus, language=language)

    def utterances(self, collection: Names = None, corpus: Names = None, role: Names = None, language: Names = None, sex: Names = None, age=None) -> DataFrame:
        return self._get("utterance", age, collection_name=collection, corpus_name=corpus, speaker_role=role, language=language, target_child_sex=sex)

    def tokens(self, token: Names = "*", collection: Names = None, corpus: Names = None, role: Names = None, part_of_speech: Names = None, language: Names = None, age=None) -> DataFrame:
        """Tokens whose gloss fits any pattern of token (% stands for anything, * for all).

        Where the release has a current index of its glosses, patterns meet each gloss once. A few that fit become a filter of the scan; many
        are joined, and Spark can build a Bloom filter of them for the scan. Without the index patterns meet every token.
        """
        df = self._get("token", age, collection_name=collection, corpus_name=corpus, speaker_role=role, part_of_speech=part_of_speech, language=language)
        patterns = [token] if isinstance(token, str) else list(token or ["*"])
        if "*" in patterns:
            return df
        glosses = self.glosses()
        if glosses is None:
            return df.where(_fits(patterns))
        found = glosses.where(_fits(patterns)).select("gloss")
        few = [r.gloss for r in found.limit(FEW + 1).collect()]
        return df.where(F.col("gloss").isin(few)) if len(few) <= FEW else df.join(found, "gloss", "left_semi").select(*df.columns)

    def _token_files(self) -> str:
        """A digest of the names of the token table's files, which no two writes share."""
        return hashlib.sha256("\n".join(sorted(self.table("token").inputFiles())).encode()).hexdigest()

    def index_glosses(self) -> DataFrame:
        """Write the index of the release's glosses: each with its number of tokens, and what files it was made of. Written again, it replaces the last one."""
        made_of, name = self._token_files(), "gloss_index"
        files = Files(self.spark, f"{self.base}/{self.version}")
        files.remove(f"{name}.made_of")
        self.table("token").where("gloss IS NOT NULL").groupBy("gloss").agg(F.count("*").alias("n")).write.mode("overwrite").option("compression", "zstd").parquet(f"{files.folder}/{name}")
        files.write(f"{name}.made_of", made_of)
        return self.spark.read.parquet(f"{files.folder}/{name}")

    def glosses(self) -> DataFrame | None:
        """gloss, n of the index; None where there is none or where the token table was written since."""
        files = Files(self.spark, f"{self.base}/{self.version}")
        if not files.exists("gloss_index.made_of") or files.read("gloss_index.made_of") != self._token_files():
            return None
        return self.spark.read.schema("gloss string, n long").parquet(f"{files.folder}/gloss_index")

    def types(self, collection: Names = None, corpus: Names = None, role: Names = None, age=None) -> DataFrame:
        return self._get("token_frequency", age, collection_name=collection, corpus_name=corpus, speaker_role=role)

    def speaker_statistics(self, collection: Names = None, corpus: Names = None, role: Names = None, age=None) -> DataFrame:
        return self._get("transcript_by_speaker", age, collection_name=collection, corpus_name=corpus, speaker_role=role)

    def sql(self, query: str, **args) -> DataFrame:
        """SQL over the release's tables, with named parameters (:name)."""
        release_views(self.spark, self.base, self.version, [t for t in schemas.TABLES if self._has(t)])
        return self.spark.sql(query, args=args)

    def _has(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{self.version}/{table}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
