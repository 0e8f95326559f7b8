"""Schemas of the corpus tables, finest grain last."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"l": T.LongType(), "i": T.IntegerType(), "d": T.DoubleType(), "s": T.StringType(), "t": T.DateType(), "b": T.BooleanType()}


def _schema(text: str) -> T.StructType:
    """'name:kind ...' with the one-letter kinds above; a name without a kind is a string."""
    out = []
    for part in text.split():
        name, _, kind = part.partition(":")
        out.append(T.StructField(name, _KINDS[kind or "s"]))
    return T.StructType(out)


_CHILD = "target_child_name target_child_age:d target_child_sex"
_SPEAKER = "speaker_code speaker_name speaker_role"
_KEYS = "collection_name collection_id:l corpus_id:l speaker_id:l target_child_id:l transcript_id:l"

COLLECTION = _schema("id:l name data_source")
CORPUS = _schema("id:l name collection_id:l collection_name data_source")
PARTICIPANT = _schema("id:l code name role corpus_id:l corpus_name min_age:d max_age:d language group sex ses education custom target_child_id:l collection_id:l collection_name")
TRANSCRIPT = _schema(f"id:l corpus_id:l corpus_name language date:t filename target_child_id:l {_CHILD} collection_id:l collection_name pid")
UTTERANCE = _schema(f"id:l gloss stem actual_phonology model_phonology type language num_morphemes:i num_tokens:i utterance_order:i corpus_name part_of_speech {_SPEAKER} {_CHILD} media_start:d media_end:d media_unit {_KEYS} ort spa")
TOKEN = _schema(f"id:l gloss language token_order:i replacement prefix part_of_speech stem actual_phonology model_phonology suffix num_morphemes:i english clitic utterance_type corpus_name {_SPEAKER} {_CHILD} {_KEYS} utterance_id:l gra_index:i gra_head:i gra_relation")
TOKEN_MORPHEME = _schema("id:l token_id:l morpheme_order:i type lemma pos features language utterance_id:l transcript_id:l corpus_id:l corpus_name speaker_id:l speaker_role target_child_id:l collection_id:l collection_name")
TRANSCRIPT_BY_SPEAKER = _schema(f"id:l speaker_role language {_CHILD} num_utterances:i mlu_w:d mlu_m:d mtld:d hdd:d num_types:i num_tokens:i num_morphemes:i {_KEYS}")
TOKEN_FREQUENCY = _schema(f"id:l gloss count:i speaker_role language {_CHILD} {_KEYS}")
ADMIN = _schema("id:l date:t version")
W = _schema("id:i u_fk:i gloss replacement pos form_marker form_marker_suffix incomplete_type unidentifiable_type has_compound:b has_clitic:b has_shortening:b transcript")
MOR = _schema("id:i u_fk:i w_fk:i is_compound:b clitic_type is_separated_prefix:b pos stem english gra_index:i gra_head:i gra_relation transcript")
MK = _schema("id:i mor_fk:i affix affix_type transcript")

TABLES = {
    "collection": COLLECTION, "corpus": CORPUS, "participant": PARTICIPANT, "transcript": TRANSCRIPT, "utterance": UTTERANCE, "token": TOKEN,
    "token_morpheme": TOKEN_MORPHEME, "transcript_by_speaker": TRANSCRIPT_BY_SPEAKER, "token_frequency": TOKEN_FREQUENCY, "admin": ADMIN,
    "w": W, "mor": MOR, "mk": MK,
}


def conform(df, schema: T.StructType):
    """df with exactly the schema's columns: cast by name, nulls for those it lacks."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
