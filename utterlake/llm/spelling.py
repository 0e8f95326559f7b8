"""Spelling variants of a corpus's words: symmetric-delete join, exact distance one, forms and roots.

Words come from runs of letters, counted over all texts: added up in the tasks first, so that no frequent word is a hot key. Each word
emits a key for itself and for each distinct single deletion. Two words at distance one share a key: that of the shorter, or
that of the deletion at the place that differs. Words meet by equal keys, and pairs are verified. A key is a 64-bit hash, made for all
deletions of a word from running sums, so that a word of n letters costs n steps and rows; unlike strings of equal hash only
add a pair to verify.

No bucket is hot: words are distinct, and those that give a key are it and it with one more letter. With an alphabet of A letters
that is A * (letters + 1) + 1 words at most.

Forms have at least `times` the word's count, so chains of forms end, after log(count) / log(times) steps at most; roots come
from pointer jumping, which halves the chains each round.

Defined cases: null and empty texts have no words; a null doc_id counts as an empty string in the noise's hash; ties between
forms go to the first in code-point order; repeated rows count each time; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import cut, drop_cut, mix64

RUN = "[a-zÀ-ÿ]+"
LETTERS, COUNT, TIMES = 6, 5, 5
#: One run in so many loses a letter, as typing errors would; drawn by a hash of document and run.
NOISE = 199

_LETTER = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))
_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def with_noise(run: Column, doc_id: Column, noise: int) -> Column:
    """run without one letter where the hash of document and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % noise == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", letters: int = LETTERS, count: int = COUNT, noise: int | None = None) -> DataFrame:
    """word, n: words of at least `letters` letters that occur at least `count` times. noise: see NOISE."""
    lower = F.translate(F.col(text).cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(F.col(doc_id).alias("_doc"), F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("_run"))
    runs = runs.where(F.length("_run") >= letters)  # the noise only shortens
    word = F.col("_run") if noise is None else with_noise(F.col("_run"), F.col("_doc"), noise)
    return runs.select(word.alias("word")).where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def deletion_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(key, number of the word) for each word (Latin-1, not empty) and each distinct string that one deletion leaves of it."""
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens)
    number = np.repeat(np.arange(len(words)), lens)
    place = np.arange(len(codes)) - np.repeat(ends - lens, lens)
    power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(0, int(lens.max(initial=0)) - 1), _BASE, np.uint64)]))
    term = _LETTER[codes] * power[place]
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
    whole = run[ends] - run[ends - lens]
    before = run[:-1] - np.repeat(run[ends - lens], lens)
    without = before + (whole[number] - before - term) * _BACK
    distinct = place == 0  # a letter like the one before it leaves the same string
    distinct[1:] |= codes[1:] != codes[:-1]
    size = lens.astype(np.uint64)
    keys = np.concatenate([mix64(whole + size * _LENGTH), mix64(without + (size[number] - np.uint64(1)) * _LENGTH)[distinct]])
    return keys, np.concatenate([np.arange(len(words)), number[distinct]])


def near_words(words: DataFrame) -> DataFrame:
    """a, b, word_a, n_a, word_b, n_b: each two of words (id, word, n) at distance one, once."""

    def scan(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = batch.column(1).to_pylist()
            at = np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // 500_000, prepend=-1)).tolist()
            for i, j in zip(at, [*at[1:], len(texts)]):
                keys, number = deletion_keys(texts[i:j])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids[i:j][number])], ["key", "id"])

    keys = words.select("id", "word").mapInArrow(scan, "key long, id long")
    x, y = keys.withColumnRenamed("id", "a"), keys.withColumnRenamed("id", "b")
    pairs = cut(x.join(y, "key").where("a < b").select("a", "b").distinct(), "spelling-pairs")
    of_a = words.select(F.col("id").alias("a"), F.col("word").alias("word_a"), F.col("n").alias("n_a"))
    of_b = words.select(F.col("id").alias("b"), F.col("word").alias("word_b"), F.col("n").alias("n_b"))
    return pairs.join(of_a, "a").join(of_b, "b").where(F.levenshtein("word_a", "word_b", 1) == 1)


def roots(forms: DataFrame) -> DataFrame:
    """word, root of forms (word, form): the last form that forms lead to."""
    found = cut(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = cut(found.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        drop_cut(found)
        found = joined.select("word", "root")
        if not joined.where("moved").take(1):
            return found


def variants(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", letters: int = LETTERS, count: int = COUNT, times: int = TIMES, noise: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n, root: a row for each word; form and form_n are null if no near word has `times` its count."""
    words = count_words(docs, doc_id=doc_id, text=text, letters=letters, count=count, noise=noise)
    words = cut(words.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    pairs = cut(near_words(words), "spelling-near")
    one = pairs.select(F.col("a").alias("id"), F.col("word_b").alias("other"), F.col("n_b").alias("other_n"))
    near = one.unionByName(pairs.select(F.col("b").alias("id"), F.col("word_a").alias("other"), F.col("n_a").alias("other_n")))
    best = near.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    is_form = -F.col("best.less") >= times * F.col("n")
    rows = words.join(best, "id", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    rows = cut(rows, "spelling-rows")
    of = roots(rows.where("form IS NOT NULL").select("word", "form"))
    return rows.join(of, "word", "left").withColumn("root", F.coalesce("root", "word"))
