"""Word, morphology and affix rows of TalkBank XML, and checks of their dependency indices."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake import schemas
from utterlake.session import stored
from utterlake.sources.talkbank_xml import NS

_WORD = "id int, u_fk int, gloss string, replacement string, pos string, form_marker string, form_marker_suffix string, incomplete_type string, unidentifiable_type string, has_compound boolean, has_clitic boolean, has_shortening boolean"
_MOR = "id int, u_fk int, w_fk int, is_compound boolean, clitic_type string, is_separated_prefix boolean, pos string, stem string, english string, gra_index int, gra_head int, gra_relation string, affixes array<struct<affix:string,affix_type:string>>"
NESTED = f"transcript string, words array<struct<{_WORD.replace(' ', ':').replace(',:', ',')}>>, mors array<struct<{_MOR.replace(' ', ':').replace(',:', ',')}>>"
_MARKS = {"cmp": "+", "cli": "~"}


def spelled(word: ET.Element) -> tuple[str, set[str]]:
    """A word's text with + in compounds, ~ before clitics and shortenings in parentheses; and which of those it has."""
    out, has = word.text or "", set()
    for part in word:
        tag = part.tag.removeprefix(NS)
        if tag == "wk" and part.get("type") in _MARKS:
            out += _MARKS[part.get("type")] + (part.tail or "")
            has.add(part.get("type"))
        elif tag == "shortening":
            out += f"({part.text or ''})" + (part.tail or "")
            has.add("shortening")
    return out, has


def _mor_rows(mor: ET.Element, **common) -> Iterator[dict]:
    """A row for each part of a mor, a mor-pre or a mor-post; a compound has several."""
    compound = mor.find(f"{NS}mwc")
    gra = next((g for g in mor.iterfind(f"{NS}gra") if g.get("type") == "gra"), None)
    number = lambda k: int(gra.get(k)) if gra is not None and gra.get(k) else None
    english = [x.text or "" for x in mor.iterfind(f"{NS}menx")]
    for mw in (mor if compound is None else compound).iterfind(f"{NS}mw"):
        pos = [x.text or "" for x in (*mw.iterfind(f"{NS}pos/{NS}c"), *mw.iterfind(f"{NS}pos/{NS}s"))]
        affixes = [{"affix": x.text, "affix_type": "prefix"} for x in mw.iterfind(f"{NS}mpfx")] + [{"affix": x.text, "affix_type": x.get("type")} for x in mw.iterfind(f"{NS}mk")]
        yield common | {
            "is_compound": compound is not None, "pos": ":".join(pos), "stem": mw.findtext(f"{NS}stem"), "english": "/".join(english) if english else None,
            "gra_index": number("index"), "gra_head": number("head"), "gra_relation": None if gra is None else gra.get("relation"), "affixes": affixes,
        }


def _word_mors(word: ET.Element, **common) -> Iterator[dict]:
    separated = word.get("separated-prefix") == "true"
    for mor in word.iterfind(f"{NS}mor"):
        if mor.get("type") == "mor":
            yield from _mor_rows(mor, **common, clitic_type=None, is_separated_prefix=separated)
            for kind in ("pre", "post"):
                for clitic in mor.iterfind(f"{NS}mor-{kind}"):
                    yield from _mor_rows(clitic, **common, clitic_type=kind, is_separated_prefix=separated)


def parse(transcript: str, text: str) -> dict:
    """All rows of a transcript; group elements are taken away first. Ids run over the transcript, without gaps."""
    root = ET.fromstring(re.sub(r"</?[ps]?g>", "", text))
    words: list[dict] = []
    mors: list[dict] = []
    for n, u in enumerate(root.iterfind(f"{NS}u")):
        for part in u:
            tag = part.tag.removeprefix(NS)
            if tag == "tagMarker":
                mor = part.find(f"{NS}mor")
                if mor is not None:
                    mors += _mor_rows(mor, u_fk=n, w_fk=None, clitic_type=None, is_separated_prefix=False)
            elif tag == "w":
                instead = part.findall(f"{NS}replacement/{NS}w")
                glosses = [spelled(x)[0] for x in instead]
                joined = None
                if glosses:
                    head = glosses[:1] if instead[0].get("separated-prefix") == "true" else []
                    joined = " ".join([*head, "_".join(glosses[len(head) :])])
                own, has = spelled(part)
                words.append(
                    {
                        "id": len(words), "u_fk": n, "gloss": own, "replacement": joined, "pos": part.get("pos"), "form_marker": part.get("formType"), "form_marker_suffix": part.get("formSuffix"),
                        "incomplete_type": part.get("type"), "unidentifiable_type": part.get("untranscribed"), "has_compound": "cmp" in has, "has_clitic": "cli" in has, "has_shortening": "shortening" in has,
                    }
                )
                for w in [part, *instead]:
                    mors += _word_mors(w, u_fk=n, w_fk=words[-1]["id"])
    return {"transcript": transcript, "words": words, "mors": [{"id": i, **m} for i, m in enumerate(mors)]}


def trio(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """w, mor and mk tables of files (path, text). Keys hold within a transcript, so join by transcript as well."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 16):
                part = batch.iloc[a : a + 16]
                yield pd.DataFrame([parse(p, t) for p, t in zip(part["path"], part["text"])])

    nested = stored(files.select("path", "text").mapInPandas(walk, NESTED), "mor")  # walked once for the three tables
    w = nested.select("transcript", F.inline("words"))
    mor = nested.select("transcript", F.inline("mors"))
    mk = mor.select("transcript", F.col("id").alias("mor_fk"), F.posexplode("affixes").alias("at", "a")).select("transcript", "mor_fk", "at", "a.*")
    mk = mk.withColumn("id", F.row_number().over(W.partitionBy("transcript").orderBy("mor_fk", "at")) - 1)
    return schemas.conform(w, schemas.W), schemas.conform(mor, schemas.MOR), schemas.conform(mk, schemas.MK)


def compound_index(mor: DataFrame, group: list[str] | None = None, order: str = "id") -> DataFrame:
    """mor with counted (a row that takes a dependency index: any but later parts of a compound) and gra_counted, their running number."""
    w = W.partitionBy(*(group or ["transcript", "u_fk"])).orderBy(order)
    before = F.lag("w_fk").over(w)
    opens = F.col("is_compound") & ((F.row_number().over(w) == 1) | before.isNull() | (F.col("w_fk") != before) | F.coalesce(F.lag("is_separated_prefix").over(w), F.lit(False)))
    counted = F.col("gra_index").isNotNull() & (~F.col("is_compound") | F.coalesce(opens, F.lit(False)))
    out = mor.withColumn("counted", counted)
    return out.withColumn("gra_counted", F.sum(F.col("counted").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))


def bad_heads(mor: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Rows of utterances in which some head is neither 0, nor one past the last index, nor an index."""
    w = W.partitionBy(*(group or ["transcript", "u_fk"]))
    good = (F.col("gra_head") == 0) | (F.col("gra_head") == F.max("gra_index").over(w) + 1) | F.array_contains(F.collect_set("gra_index").over(w), F.col("gra_head"))
    return mor.withColumn("good_head", good).withColumn("_all", F.bool_and(F.coalesce("good_head", F.lit(True))).over(w)).where("NOT _all").drop("_all")
