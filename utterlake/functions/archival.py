"""Folds of the archival word table: reformulations, and words against morphology items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no morphology item, non-utterances, reformulation markers.
EXCLUDED = ("hmm", "hm", "mm", "uh", "uhh", "ah", "um", "uhhuh", "eh", "xxx", "yyy", "xx", "yy", "aw", "www", "er", "ka")
NO_UTTERANCE = ("0",)
MARKERS = r"\[//\]|\[/\]|\[/\?\]|\[///\]|\[/-\]"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once for the row: as part of a lambda's body it would be for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _last_is_punctuation(items: Column) -> Column:
    return F.regexp_replace(F.coalesce(F.try_element_at(items, F.lit(-1)), F.lit("x")), r"\p{Punct}", "") == ""


def realign_reformulations(gloss: Column, mor: Column) -> Column:
    """Morphology items for all words of a gloss that holds reformulations: BRK for words that a marker takes back.

    The gloss is read from its end. A marker opens a reformulation; it covers the one word before it, or all words
    back to < if it follows a >.
    """
    spaced = F.regexp_replace(F.regexp_replace(F.regexp_replace(gloss, r"[()]", ""), ">", " >"), "<", "< ")
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    words = F.when(_last_is_punctuation(words), F.slice(words, 1, F.size(words) - 1)).otherwise(words)
    items = F.when(_last_is_punctuation(mor), F.slice(mor, 1, F.size(mor) - 1)).otherwise(mor)
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("used"), F.lit(False).alias("inside"), F.lit(True).alias("fresh"))

    def step(back: Column, s: Column, w: Column) -> Column:
        marker = F.rlike(w, F.lit(MARKERS))
        opens, closes = s["inside"] & (w == ">"), s["inside"] & (w == "<")
        note = marker | opens | closes
        taken = F.when(s["inside"], F.lit("BRK")).otherwise(F.try_element_at(back, s["used"] + 1))
        single = s["inside"] & s["fresh"] & ~note
        return F.struct(
            F.when(note, s["out"]).otherwise(F.array_append(s["out"], taken)).alias("out"),
            (s["used"] + (~note & ~s["inside"]).cast("int")).alias("used"),
            F.when(marker, True).when(closes | single, False).otherwise(s["inside"]).alias("inside"),
            F.when(marker, True).when(opens | single, False).otherwise(s["fresh"]).alias("fresh"),
        )

    found = _let(F.reverse(items), lambda back: F.aggregate(F.reverse(words), start, lambda s, w: step(back, s, w), lambda s: F.reverse(s["out"])))
    return F.filter(found, lambda x: x.isNotNull())


def reconcile(words: Column, mor: Column) -> Column:
    """A morphology item for each word: placeholders for words that have none. Null where there are more items than words."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("offset"))

    def step(mor: Column, s: Column, w: Column) -> Column:
        name = F.when(F.contains(w, F.lit("&=")), "NON-LINGUISTIC").when(F.startswith(w, F.lit("&")) | w.isin(*EXCLUDED), "EXC").when(w.isin(*NO_UTTERANCE), "NO_UTT")
        own = F.try_element_at(mor, F.size(s["out"]) + 1 - s["offset"])
        return F.struct(F.array_append(s["out"], F.coalesce(name, own)).alias("out"), (s["offset"] + name.isNotNull().cast("int")).alias("offset"))

    longer = lambda words, mor: F.aggregate(words, start, lambda s, w: step(mor, s, w), lambda s: s["out"])
    both = F.struct(words.alias("words"), mor.alias("mor"))
    return _let(both, lambda x: F.when(F.size(x["words"]) > F.size(x["mor"]), longer(x["words"], x["mor"])).when(F.size(x["words"]) == F.size(x["mor"]), x["mor"]))
