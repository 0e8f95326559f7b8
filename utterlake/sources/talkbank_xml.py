"""TalkBank XML transcripts.

Word elements mix text with child elements, which Spark's XML source flattens, so each document is read whole and walked
by an Arrow-batched function (one row a file in, nested rows out); all that follows is DataFrame code.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

NS = "{http://www.talkbank.org/ns/talkbank}"

MORPHOLOGY = "prefix string, pos string, stem string, suffix string, english string, clitic string, num_morphemes int"
TOKEN = f"gloss string, replacement string, relation string, {MORPHOLOGY}, token_order int, pho string, mod string, stem_form string"
UTTERANCE = f"u_id string, who string, terminator string, annotations array<struct<type:string,flavor:string,who:string,text:string>>, media struct<start:double,end:double,unit:string>, actual_pho array<string>, model_pho array<string>, tokens array<struct<{', '.join(x.replace(' ', ':', 1) for x in TOKEN.split(', '))}>>"
_NESTED = UTTERANCE.replace("u_id string", "u_id:string").replace("who string, t", "who:string, t").replace("terminator string", "terminator:string").replace("annotations array", "annotations:array").replace("media struct", "media:struct").replace("actual_pho array", "actual_pho:array").replace("model_pho array", "model_pho:array").replace("tokens array", "tokens:array")
DOCUMENT = f"path string, attributes map<string,string>, participants array<map<string,string>>, utterances array<struct<{_NESTED}>>, error string"


_W, _MOR, _MW, _POST, _GRA, _STEM, _LANGS, _REPLACEMENT = (f"{NS}{x}" for x in ("w", "mor", "mw", "mor-post", "gra", "stem", "langs", "replacement"))
_OF_MW = {f"{NS}mpfx": "prefix", f"{NS}stem": "stem", f"{NS}mk": "suffix"}
_OF_POS = {f"{NS}c": "c", f"{NS}s": "s"}
_POS, _ENGLISH = f"{NS}pos", f"{NS}menx"
_NO_MORPHOLOGY = {"prefix": "", "pos": "", "stem": "", "suffix": "", "english": "", "clitic": "", "num_morphemes": None}


def _texts(word: ET.Element, path: str) -> list[str]:
    return [x.text or "" for x in word.iterfind(path.replace("~", NS))]


def _read(word: ET.Element) -> tuple[dict, str, str]:
    """morphology(), relation() and stem_form() of a word, in one pass over its mor elements."""
    found: dict[str, list[str]] = {"prefix": [], "stem": [], "suffix": [], "c": [], "s": []}
    english = last = first_post = None
    posts: list[str] = []
    for mor in word.iter(_MOR):
        for part in mor:
            tag = part.tag
            if tag == _MW:
                for x in part:
                    kind = _OF_MW.get(x.tag)
                    if kind:
                        found[kind].append(x.text or "")
                    elif x.tag == _POS:
                        for y in x:
                            kind = _OF_POS.get(y.tag)
                            if kind:
                                found[kind].append(y.text or "")
            elif tag == _GRA:
                last = part if part.get("type") != "grt" else last
            elif tag == _POST:
                first_post = part if first_post is None else first_post
                posts += [x.text or "" for x in part.iterfind(f"{_MW}/{_STEM}")]
            elif tag == _ENGLISH and english is None:
                english = part.text or ""
    clitic = ""
    inner = None if first_post is None else first_post.find(f".//{_MW}")
    if inner is not None:
        clitic = " ".join((_texts(inner, p) or [""])[0] for p in (".//~pos/~c", ".//~stem", ".//~mk"))
    prefixes, suffixes, stem = found["prefix"], found["suffix"], (found["stem"] or [""])[0]
    n = len(prefixes) + bool(stem) + len(suffixes) + bool(clitic)
    pos = ":".join(found["c"][:1] + found["s"]) if found["c"] else ""
    out = {"prefix": " ".join(prefixes), "pos": pos, "stem": stem, "suffix": " ".join(suffixes), "english": english or "", "clitic": clitic, "num_morphemes": n or None}
    head = next(word.iter(_STEM), None)
    form = ("" if head is None else head.text or "") + ("-" + suffixes[0] if suffixes else "") + (" " + posts[0] if posts else "")
    return out, "" if last is None else "|".join(last.get(k) or "" for k in ("index", "head", "relation")), form


def morphology(word: ET.Element) -> dict:
    """Prefixes, part of speech with subcategories, stem, suffixes, translation, clitic, and the number of morphemes (null for none)."""
    return _read(word)[0]


def gloss(word: ET.Element) -> str:
    """Text of a word with its compound parts (after a +), prosody marks' tails and shortenings."""
    langs = next(word.iter(_LANGS), None)
    out = langs.tail if langs is not None and len(langs) else word.text
    out = out or ""
    for part in word:
        tag = part.tag.removeprefix(NS)
        if tag in ("wk", "p", "shortening"):
            out += ("+" if tag == "wk" else "") + (part.text or "") + (part.tail or "")
    return out.strip()


def relation(word: ET.Element) -> str:
    """index|head|relation of the last dependency that isn't the gold standard's."""
    return _read(word)[1]


def stem_form(word: ET.Element) -> str:
    """Stem, inflection behind a hyphen, and a clitic's stem."""
    return _read(word)[2]


def _merged(word: ET.Element, children: list[ET.Element]) -> dict:
    """A spoken word that stands for the words of its replacement: their morphology, joined by spaces."""
    parts = [morphology(c) for c in children]
    out = {k: " ".join(p[k] for p in parts if p[k]) for k in ("prefix", "pos", "stem", "suffix", "english", "clitic")}
    counted = [p["num_morphemes"] for p in parts if p["num_morphemes"]]
    relations = [r for r in map(relation, children) if r]
    return out | {"num_morphemes": sum(counted) if counted else None, "replacement": " ".join(c.text for c in children if c.text), "relation": " ".join(relations)}


def tokens(utterance: ET.Element, actual: list[str], model: list[str]) -> list[dict]:
    words = list(utterance.iter(_W))
    heard, meant = len(actual) == len(words), len(model) == len(words)
    out: list[dict] = []
    skip = 0
    for w in words:
        if skip:
            skip -= 1
            continue
        if w.get("type") == "omission":
            continue
        if not len(w):  # text alone
            own = _NO_MORPHOLOGY | {"gloss": (w.text or "").strip(), "stem_form": "", "replacement": "", "relation": ""}
        else:
            own, related, form = _read(w)
            box = next(w.iter(_REPLACEMENT), None)
            if box is not None and len(box):
                children = [x for x in w.iter(_W) if x is not w]
                own = _merged(w, children)
                skip = len(children)
            else:
                own["replacement"], own["relation"] = "", related
            own["gloss"], own["stem_form"] = gloss(w), form
        at = len(out)
        own["token_order"] = at + 1
        own["pho"] = actual[at] if heard else ""
        own["mod"] = model[at] if meant else ""
        out.append(own)
    return out


def utterance(u: ET.Element) -> dict:
    """An utterance's element as a row of UTTERANCE."""
    said = {k: ["".join(x.text or "" for x in w.iterfind(f"{NS}ph")) for w in u.iterfind(f".//{NS}pg/{NS}{k}/{NS}pw")] for k in ("actual", "model")}
    end, media = u.find(f".//{NS}t"), u.find(f".//{NS}media")
    number = lambda m, k: float(m.get(k)) if m.get(k) else None
    return {
        "u_id": u.get("uID"), "who": u.get("who"), "terminator": None if end is None else end.get("type"),
        "annotations": [{"type": a.get("type"), "flavor": a.get("flavor"), "who": a.get("who"), "text": a.text} for a in u.iter(f"{NS}a")],
        "media": None if media is None else {"start": number(media, "start"), "end": number(media, "end"), "unit": media.get("unit")},
        "actual_pho": said["actual"], "model_pho": said["model"], "tokens": tokens(u, said["actual"], said["model"]),
    }


def parse(path: str, text: str) -> dict:
    """A document as a row of DOCUMENT; a malformed one has its message in error and nothing else."""
    try:
        root = ET.fromstring(text)
    except ET.ParseError as e:
        return {"path": path, "attributes": None, "participants": None, "utterances": None, "error": str(e)}
    utterances = [utterance(u) for u in root.iter(f"{NS}u")]
    people = [dict(p.attrib) for p in root.iterfind(f".//{NS}Participants/{NS}participant")]
    return {"path": path, "attributes": dict(root.attrib), "participants": people, "utterances": utterances, "error": None}


def _listed(document: dict) -> dict:
    """A document with its maps as lists of pairs, as Arrow wants them."""
    pairs = lambda m: None if m is None else list(m.items())
    people = document["participants"]
    return document | {"attributes": pairs(document["attributes"]), "participants": None if people is None else [pairs(p) for p in people]}


def parsed(files: DataFrame) -> DataFrame:
    """Documents (DOCUMENT) of files (path, text)."""
    schema = to_arrow_schema(T.StructType.fromDDL(DOCUMENT))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 16):
                part = batch.slice(a, 16)
                rows = [parse(p, t) for p, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                yield pa.RecordBatch.from_pylist([_listed(r) for r in rows], schema)

    return files.select("path", "text").mapInArrow(walk, DOCUMENT)


def read(spark: SparkSession, root: str, pattern: str = "*.xml") -> DataFrame:
    """Documents of all files under root that match pattern."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    return parsed(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def corpus(docs: DataFrame) -> DataFrame:
    """path and the root element's attributes."""
    return docs.select("path", "attributes")


def participants(docs: DataFrame) -> DataFrame:
    """A row for each participant: path, position, code, and all attributes as a map."""
    return docs.select("path", F.posexplode("participants").alias("position", "attributes")).withColumn("code", F.col("attributes")["id"])


def utterances(docs: DataFrame, speaker: str | list[str] = "ALL", attribute: str | None = None) -> DataFrame:
    """A row for each utterance in order: path, utterance_order (from 1), and UTTERANCE; and one of the root's attributes, by its name.

    docs may be such rows already (those of xml_splits), as it may for all that follows; they then hold the attribute's column.
    """
    rows = docs
    if "utterances" in docs.columns:
        own = [] if attribute is None else [F.col("attributes")[attribute].alias(attribute)]
        rows = docs.select("path", *own, F.posexplode("utterances").alias("at", "u")).select("path", *([attribute] if attribute else []), (F.col("at") + 1).alias("utterance_order"), "u.*")
    return rows if speaker == "ALL" else rows.where(F.col("who").isin([speaker] if isinstance(speaker, str) else speaker))


def _word(stem: bool, replace: bool) -> Column:
    form = F.when(F.col("t.stem_form") != "", F.col("t.stem_form")).otherwise(F.col("t.gloss")) if stem else F.col("t.gloss")
    return F.when(F.col("t.replacement") != "", F.col("t.replacement")).otherwise(form) if replace else form


def _exploded(docs: DataFrame, speaker, attribute: str | None = None) -> DataFrame:
    return utterances(docs, speaker, attribute).select("path", *([attribute] if attribute else []), "utterance_order", "who", F.explode("tokens").alias("t"))


def words(docs: DataFrame, speaker="ALL", *, stem: bool = False, relation: bool = False, replace: bool = False, strip_space: bool = True, attribute: str | None = None) -> DataFrame:
    """The word stream: path, utterance_order, who, token_order, word (and pos, relation; and one of the root's attributes)."""
    w = _word(stem, replace)
    extra = [F.col("t.pos").alias("pos"), F.col("t.relation").alias("relation")] if relation else []
    extra += [attribute] if attribute else []
    return _exploded(docs, speaker, attribute).select("path", "utterance_order", "who", "t.token_order", (F.trim(w) if strip_space else w).alias("word"), *extra)


def tagged_words(docs: DataFrame, speaker="ALL", **options) -> DataFrame:
    """The word stream with part-of-speech tags: word, tag (null where there is none)."""
    return words(docs, speaker, relation=True, **options).drop("relation").withColumn("tag", F.nullif("pos", F.lit(""))).drop("pos")


def sents(docs: DataFrame, speaker="ALL", *, stem: bool = False, replace: bool = False) -> DataFrame:
    """Each utterance as an array of words."""
    form = lambda t: F.when((t["stem_form"] != "") & F.lit(stem), t["stem_form"]).otherwise(t["gloss"])
    one = lambda t: F.when((t["replacement"] != "") & F.lit(replace), t["replacement"]).otherwise(form(t))
    return utterances(docs, speaker).select("path", "utterance_order", "who", F.transform("tokens", one).alias("words"))


def tagged_sents(docs: DataFrame, speaker="ALL", *, stem: bool = False) -> DataFrame:
    """Each utterance as an array of struct<word, pos>."""
    form = lambda t: F.when((t["stem_form"] != "") & F.lit(stem), t["stem_form"]).otherwise(t["gloss"])
    pair = lambda t: F.struct(form(t).alias("word"), F.nullif(t["pos"], F.lit("")).alias("pos"))
    return utterances(docs, speaker).select("path", "utterance_order", "who", F.transform("tokens", pair).alias("words"))


def browser_path(path: Column) -> Column:
    """Where a file is shown on the web: the part behind childes/ (and data-xml/) or from Eng-USA/ on, with the ending .cha."""
    clean = F.replace(path, F.lit("\\"), F.lit("/"))
    behind = F.regexp_extract(clean, r"(?i)/childes(?:/data-xml)?/(.*)\.xml", 1)
    usa = F.regexp_extract(clean, r"(?i)/Eng-USA/(.*)\.xml", 1)
    found = F.when(behind != "", behind).when(usa != "", F.concat(F.lit("Eng-USA/"), usa)).otherwise(F.regexp_replace(clean, r"\.xml$", ""))
    return F.when(F.endswith(found, F.lit(".cha")), found).otherwise(F.concat(found, F.lit(".cha")))
