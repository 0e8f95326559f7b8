"""Scans of tables, catalogues and logs, and versioned sinks."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utterlake import schemas

# Database type -> Spark type of an export.
SQL_TYPES = {
    **dict.fromkeys(("tinyint", "smallint", "mediumint", "int", "bigint"), "bigint"),
    **dict.fromkeys(("char", "varchar", "text", "mediumtext", "longtext", "enum"), "string"),
    **dict.fromkeys(("float", "double", "decimal"), "double"),
    "date": "date",
    "datetime": "timestamp_ntz",
}


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def catalogue(spark: SparkSession, report: str) -> DataFrame:
    """bank, corpus_path, n_cha of a validation report, without empty corpora, in order."""
    rows = spark.read.csv(report, sep="\t", header=True)
    return rows.select("bank", "corpus_path", F.col("n_cha").try_cast("int").alias("n_cha")).where("n_cha > 0").orderBy("bank", "corpus_path")


def corpus_roots(spark: SparkSession, root: str, marker: str = ".zip_placeholder") -> DataFrame:
    """Folders that hold a marker file: folder, name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    listing = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    folders = set()  # markers are empty, and Spark's readers pass over empty files
    while listing.hasNext():
        file = listing.next().getPath()
        if file.getName().endswith(marker):
            folders.add((file.getParent().toString(), file.getParent().getName()))
    return spark.createDataFrame(sorted(folders), "folder string, name string")


def corpus_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path (below root), size of all files under root whose name matches, in order of path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toString().rstrip("/")
    return files.select(F.substring("path", F.lit(len(base) + 2), F.length("path")).alias("path"), F.col("length").alias("size")).orderBy("path")


def tagged_csv(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """All CSV files that a glob matches, each row with its file."""
    reader = spark.read.option("header", True).option("nullValue", "NA")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(pattern).withColumn("file", F.col("_metadata.file_path"))


def jdbc(spark: SparkSession, url: str, table: str, *, lower: int, upper: int, partitions: int, key: str = "id", properties: Mapping[str, str] | None = None) -> DataFrame:
    """A database table read by ranges of its key, one connection each."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=dict(properties or {}))


def export_schema(described: DataFrame) -> T.StructType:
    """Spark schema of an information_schema listing (column_name, data_type, ordinal_position); an unknown type is an error."""
    fields = []
    for r in described.orderBy("ordinal_position").collect():
        if r.data_type not in SQL_TYPES:
            raise ValueError(f"{r.column_name}: no type for {r.data_type}")
        fields.append(f"`{r.column_name}` {SQL_TYPES[r.data_type]}")
    return T.StructType.fromDDL(", ".join(fields))


def page(df: DataFrame, key: str, after: int, n: int) -> DataFrame:
    """The n rows whose keys follow `after`, in order."""
    return df.where(F.col(key) > after).orderBy(key).limit(n)


def saved_files(spark: SparkSession, log: str) -> DataFrame:
    """Files that a mirror's log names as saved, index pages left out."""
    lines = spark.read.text(log)
    kept = F.startswith("value", F.lit("Saving to:")) & ~F.contains("value", F.lit("index.html"))
    return lines.where(kept).select(F.regexp_replace(F.trim(F.regexp_replace("value", "^Saving to:", "")), "^[‘'\"]|[’'\"]$", "").alias("file"))


def identity_map(spark: SparkSession, path: str) -> DataFrame:
    """corpus_id, path, key, name of identity maps in JSON."""
    schema = "corpus_id long, bank string, corpus string, rule string, confidence string, assignments map<string,struct<key:string,name:string>>"
    rows = spark.read.schema(schema).json(path, multiLine=True)
    return assignments(rows)


def assignments(maps: DataFrame) -> DataFrame:
    """corpus_id, path, key, name of identity maps (corpus_id, assignments)."""
    return maps.select("corpus_id", F.explode("assignments").alias("path", "a")).select("corpus_id", "path", "a.key", "a.name")


# Sinks

Result = TypeVar("Result")


def retry(call: Callable[[], Result], attempts: int = 5, wait: float = 1.0, when: Callable[[Exception], bool] | None = None) -> Result:
    """call(), again after wait, 2 * wait, 3 * wait, ... seconds if it failed of a deadlock (or of what `when` says); the last failure is raised."""
    transient = when or (lambda e: "deadlock" in str(e).lower())
    for n in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:
            if n == attempts or not transient(e):
                raise
            time.sleep(n * wait)
    raise ValueError("attempts must be at least 1")


class Files:
    """Small files and renames in a folder of any file system that Spark can open."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._spark, self.folder, self._fs = spark, folder, self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self._path(f"{self.folder}/{name}" if name else self.folder)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self.path(name))

    def read(self, name: str) -> str:
        size = self._fs.getFileStatus(self.path(name)).getLen()
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readNBytes(size)).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str, overwrite: bool = True) -> None:
        """A file with all of text: under another name first, so that no reader sees a part of it. overwrite=False fails if it is there."""
        target = self.path(name) if not overwrite else self.path(f"_new-{name}")
        stream = self._fs.create(target, overwrite)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if overwrite:
            self.replace(f"_new-{name}", name)

    def replace(self, old: str, new: str) -> None:
        """Rename a file over one that may be there, in one step where the file system has it: a reader or a crash finds one of the two."""
        hadoop = self._spark._jvm.org.apache.hadoop.fs
        over = self._spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
        source = self._fs.makeQualified(self.path(old))
        context = hadoop.FileContext.getFileContext(source.toUri(), self._spark._jsc.hadoopConfiguration())
        context.rename(source, self._fs.makeQualified(self.path(new)), over)

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self.path(old), self.path(new)):
            raise OSError(f"{self.folder}/{old} cannot be renamed to {new}")

    def remove(self, name: str = "") -> None:
        self._fs.delete(self.path(name), True)

    def listed(self, name: str = "") -> list[str]:
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self.path(name))) if self.exists(name) else []

    @contextmanager
    def lock(self, name: str = "_lock"):
        """Held by one at a time: a file whose creation fails where it is there. A holder that dies leaves it for someone to remove."""
        self._fs.mkdirs(self.path())
        try:
            self.write(name, "", overwrite=False)
        except Exception as e:
            raise BlockingIOError(f"{self.folder} is being written by another") from e
        try:
            yield self
        finally:
            self.remove(name)


def export_parts(df: DataFrame, out: str, key: str = "id", rows: int = 50_000_000, stop_after: int | None = None) -> dict:
    """df as zstd parquet folders out/part-00000, ..., each the rows of a range of `rows` values of its key; returns {"rows", "parts", "done"}.

    A part is written under another name and renamed once whole; _progress.json says how far the export came and _done.json that it
    is complete. Called again, it goes on behind the last whole part, or does nothing if it is done. One export at a time holds the
    folder's lock. An empty table gives one part without rows. stop_after: end after so many parts of this call.
    """
    files = Files(df.sparkSession, out)
    with files.lock():
        if files.exists("_done.json"):
            return json.loads(files.read("_done.json"))
        state = json.loads(files.read("_progress.json")) if files.exists("_progress.json") else {"next": None, "parts": 0, "rows": 0}
        ends = df.agg(F.min(key).alias("a"), F.max(key).alias("b")).first()
        start = state["next"] if state["next"] is not None else ends.a
        written = 0
        while (ends.a is None and state["parts"] == 0) or (start is not None and start <= ends.b):
            if written == stop_after:
                return {"rows": state["rows"], "parts": state["parts"], "done": False}
            name = f"part-{state['parts']:05d}"
            rest = df if ends.a is None else df.where((F.col(key) >= start) & (F.col(key) < start + rows))
            rest.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/_new-{name}")
            if files.exists(name):  # renamed, but not yet in the progress file when the last call ended
                files.remove(name)
            files.rename(f"_new-{name}", name)
            start = None if start is None else start + rows
            state = {"next": start, "parts": state["parts"] + 1, "rows": state["rows"] + df.sparkSession.read.parquet(f"{out}/{name}").count()}
            files.write("_progress.json", json.dumps(state))
            written += 1
        done = {"rows": state["rows"], "parts": state["parts"], "done": True}
        files.write("_done.json", json.dumps(done))
        files.remove("_progress.json")
        return done


def exported(spark: SparkSession, out: str) -> DataFrame:
    """The whole parts of an export."""
    return spark.read.parquet(f"{out}/part-*")


def write_by(df: DataFrame, out: str, column: str) -> None:
    """One folder for each value of a column (a release's file for each collection); written again, a value replaces its own folder."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(out)


def update_columns(df: DataFrame, computed: DataFrame, key: list[str]) -> DataFrame:
    """df with its columns set to those of computed where the key is found there: rows inserted first and completed later, in one plan.

    A key that computed lacks keeps df's values; a null in computed sets null. computed has one row a key.
    """
    new = [c for c in computed.columns if c not in key]
    found = computed.select(*key, F.struct(*new).alias("_new"))
    rows = df.join(found, key, "left")
    value = lambda c: F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c) if c in df.columns else F.lit(None)).alias(c)
    return rows.select(*[value(c) if c in new else F.col(c) for c in df.columns], *[value(c) for c in new if c not in df.columns])


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """a and b joined on all columns that both have; without any it is an error, as every row would meet every other."""
    common = [c for c in a.columns if c in b.columns]
    if not common:
        raise ValueError("the tables share no column")
    return a.join(b, common, how)


def by_size(files: DataFrame, size: str, workers: int) -> DataFrame:
    """files with place (from 1, the largest first, ties by the other columns) and worker (place dealt to and fro): an order to schedule them in.

    For a catalogue of files, which one task orders.
    """
    rest = [c for c in files.columns if c != size]
    place = F.row_number().over(Window.orderBy(F.desc(size), *rest))
    rows = files.withColumn("place", place)
    turn = F.pmod(F.col("place") - 1, F.lit(2 * workers))
    return rows.withColumn("worker", F.when(turn < workers, turn).otherwise(2 * workers - 1 - turn))


#: Collections that the merged tree names otherwise.
RENAMED = {"Dutch": "DutchAfrikaans"}


def merge_trees(listing: DataFrame, renamed: Mapping[str, str] | None = None) -> DataFrame:
    """path, bank, source: what a merged tree holds at each path, and the file that it comes from.

    listing: bank, place (order of the banks), path (collection/corpus/...) of every file. Folders are united at every depth, a later bank's
    file replaces an earlier one's, and collections are renamed.
    """
    names = RENAMED if renamed is None else renamed
    first, rest = F.split_part("path", F.lit("/"), F.lit(1)), F.regexp_extract("path", "^[^/]*(.*)$", 1)
    to: Column = first
    for old, new in names.items():
        to = F.when(first == old, new).otherwise(to)
    return listing.groupBy(F.concat(to, rest).alias("target")).agg(F.max_by(F.struct("bank", "path"), F.struct("place", "path")).alias("w")).select(F.col("target").alias("path"), F.col("w.bank").alias("bank"), F.col("w.path").alias("source"))


def write_table(df: DataFrame, base: str, version: str, name: str, partition_by: str | None = "corpus_id") -> str:
    """A table of a release as zstd parquet under base/version/name. Written again, it replaces the partitions that it holds; an empty one leaves a file with its schema."""
    out = f"{base}/{version}/{name}"
    df = schemas.conform(df, schemas.TABLES[name]) if name in schemas.TABLES else df
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by and partition_by in df.columns and df.take(1):
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(out)
    return out


def read_table(spark: SparkSession, base: str, version: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{base}/{version}/{name}")
    return df.select(*[f.name for f in schemas.TABLES[name]]) if name in schemas.TABLES else df


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: Mapping[str, str] | None = None) -> None:
    """Rows into a database in batches of 1000. Overwriting starts again after a deadlock; appending doesn't, as it could add rows twice."""
    write = lambda: df.write.jdbc(url, table, mode, {"batchsize": "1000", **(properties or {})})
    retry(write) if mode == "overwrite" else write()


def write_csv(df: DataFrame, out: str) -> None:
    """One CSV file with a header, for reports that people read."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(out)


def write_json(df: DataFrame, out: str) -> None:
    df.write.mode("overwrite").json(out)


def build_once(spark: SparkSession, base: str, shards: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Build shards that have no marker yet: write each under base/data/shard=..., then its marker. Returns all markers (shard, rows)."""
    schema = "shard string, rows long"
    markers = f"{base}/markers"
    spark.createDataFrame([], schema).write.mode("append").parquet(markers)
    done = {r.shard for r in spark.read.schema(schema).parquet(markers).select("shard").distinct().collect()}
    for shard, build in shards.items():
        if shard not in done:
            out = f"{base}/data/shard={shard}"
            build().write.mode("overwrite").option("compression", "zstd").parquet(out)
            spark.read.parquet(out).agg(F.lit(shard).alias("shard"), F.count("*").alias("rows")).coalesce(1).write.mode("append").parquet(markers)
    return spark.read.schema(schema).parquet(markers)


def release_views(spark: SparkSession, base: str, version: str, names: list[str]) -> None:
    """Unversioned temporary views over the tables of a release."""
    for name in names:
        read_table(spark, base, version, name).createOrReplaceTempView(name)


def reconcile_counts(expected: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """name, expected, found, ok for each table of expected (name, rows)."""
    counts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("found")) for name, df in tables.items()]
    found = counts[0]
    for c in counts[1:]:
        found = found.unionByName(c)
    out = expected.select("name", F.col("rows").alias("expected")).join(found, "name", "left")
    return out.withColumn("ok", F.col("expected").eqNullSafe(F.col("found")))


def drop_all(spark: SparkSession, database: str) -> list[str]:
    """Drop every table of a database; returns their names."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{n}`")
    return names
