"""TalkBank XML read by utterances, so that one long file spreads over many tasks.

Spark's text source splits files of any length at a separator; with an utterance's end tag as the separator, each record holds one utterance and what stands
before it. A record is parsed by itself under the document's namespace. Numbers within a file are a place within the split and the running total of
the splits before it: a row a split is all that is ordered by file. The parsed rows are written once to the shared folder, so that every table is made
of the same splits.

Defined cases: a file that lacks its root's start or end, or that holds an utterance which doesn't parse, is an error row without utterances, as
for the reader of whole files; markup between utterances isn't looked at, so a fault there is no error here. Files are UTF-8 (no other
encoding has splits), their elements have the namespace of talkbank_xml and no prefix, and neither comments nor CDATA hold an utterance's tags. Empty files give no row.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from utterlake.session import stored
from utterlake.sources import talkbank_xml as X

END = "</u>"
_START = re.compile(r"<u(?=[\s/>])")
_ROOT_END = re.compile(r"</CHAT\s*>")
_NESTED = X.DOCUMENT.split("utterances array<", 1)[1].rsplit(">, error", 1)[0]
ROW = f"path string, block long, place int, attributes map<string,string>, participants array<map<string,string>>, ended boolean, u {_NESTED}, error string"


def _head(text: str) -> dict:
    """The root's attributes and the participants, of a text that breaks off behind them."""
    parser, out = ET.XMLPullParser(["start"]), {"attributes": None, "participants": []}
    try:
        parser.feed(text)
        started = [e for _, e in parser.read_events()]
    except ET.ParseError as e:
        return {"error": str(e)}
    if not started:
        return {"error": "no root element"}
    inside = {id(p) for box in started if box.tag == f"{X.NS}Participants" for p in box}
    people = [list(p.attrib.items()) for p in started if p.tag == f"{X.NS}participant" and id(p) in inside]
    return out | {"attributes": list(started[0].attrib.items()), "participants": people}


def _rows(text: str, first: bool) -> list[dict]:
    """What a record holds: the document's head, utterances (those without an end tag of their own among them), the root's end."""
    start, close = _START.search(text), _ROOT_END.search(text)
    out = [_head(text[: start.start() if start else close.start() if close else len(text)])] if first else []
    if start:
        body = text[start.start() : close.start()] if close else text[start.start() :] + END
        try:
            out += [{"u": X.utterance(u)} for u in ET.fromstring(f'<CHAT xmlns="{X.NS[1:-1]}">{body}</CHAT>').iter(f"{X.NS}u")]
        except ET.ParseError as e:
            out.append({"error": str(e)})
    return out + ([{"ended": True}] if close else [])


def read(spark: SparkSession, root: str, pattern: str = "*.xml") -> DataFrame:
    """ROW for all files under root that match pattern; documents() and utterances() take it."""
    records = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("lineSep", END).text(root)
    records = records.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    schema = to_arrow_schema(T.StructType.fromDDL(ROW))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, place, begun = None, 0, False  # a task reads its splits one behind the other
        for batch in batches:
            for a in range(0, len(batch), 512):
                found = []
                for path, block, text in zip(*(c.to_pylist() for c in batch.slice(a, 512).columns)):
                    if (path, block) != split:
                        split, place, begun = (path, block), 0, False
                    for row in _rows(text, block == 0 and not begun):
                        place += "u" in row
                        found.append({"path": path, "block": block, "place": place} | row)
                    begun = True
                yield pa.RecordBatch.from_pylist(found, schema)

    return stored(records.mapInArrow(walk, ROW), "xml")


def documents(rows: DataFrame) -> DataFrame:
    """path, attributes, participants, error of each file; the first two are null where there is an error."""
    whole = rows.groupBy("path").agg(
        F.max_by("attributes", F.col("attributes").isNotNull()).alias("a"),
        F.max_by("participants", F.col("attributes").isNotNull()).alias("p"),
        F.count("ended").alias("ends"),
        F.min("error").alias("e"),
    )
    error = F.coalesce("e", F.when(F.col("a").isNull(), "no start of the root").when(F.col("ends") != 1, "no single end of the root"))
    right = error.isNull()
    return whole.select("path", F.when(right, F.col("a")).alias("attributes"), F.when(right, F.col("p")).alias("participants"), error.alias("error"))


def utterances(rows: DataFrame, attribute: str | None = None) -> DataFrame:
    """A row for each utterance of files without error: path, utterance_order (from 1 in a file), UTTERANCE, and one of the root's attributes."""
    said = rows.where("u IS NOT NULL")
    counts = said.groupBy("path", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("before", before).where("block > 0").drop("n")  # a row a split, none for a file of one
    docs = documents(rows)
    out = said.join(offsets, ["path", "block"], "left").join(docs.where("error IS NOT NULL").select("path"), "path", "left_anti")
    order = (F.coalesce("before", F.lit(0)) + F.col("place")).cast("int").alias("utterance_order")
    if attribute is None:
        return out.select("path", order, "u.*")
    return out.join(docs.select("path", F.col("attributes")[attribute].alias(attribute)), "path").select("path", attribute, order, "u.*")
