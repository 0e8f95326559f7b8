"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a vector of counts and ratios. Each feature is cut into bins at quantiles; cyclic gradient boosting visits
the features in turn, fits a tree of up to three leaves on the feature's bins to the gradient of the log loss, and adds it, shrunk, to
the feature's lookup table. Pairs whose residuals a two-by-two split explains best get tables over coarse grids in
the same way. A score is the sum of one table entry for each feature and pair, through the logistic function.

The model is fitted in the driver on at most `sample` labelled rows (those of least hash of their id). They are chosen by id alone
and only they are turned into vectors for it; then one pass over all rows makes each row's vector and score. Labels of rows with crc32(doc_id as text) mod 3 = 1 are never used, so that they can measure accuracy.

Defined cases: null and empty texts have the vector of the empty text and get a score like any other; rows of labels with a null
quality or an unknown doc_id are ignored; without labels of both kinds every score is their mean (0.5 without any);
repeated rows score alike; other columns are ignored, or pass through good_documents() unchanged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utterlake.llm.common import cut, text_slices

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "punct", "symbol", "bang", "bar", "high", "stop", "line",
    "distinct", "top_word", "repeat_pair", "longest_word", "marked_word", "packed", "short_word", "capital_word",
)
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE = 200, 60, 0.15


def _of(*chars: str) -> bytes:
    """A table for bytes.translate that deletes nothing: used as the deletion set's complement."""
    keep = set("".join(chars).encode())
    return bytes(b for b in range(256) if b not in keep)


_UPPER, _DIGIT = _of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _of("0123456789")
_PUNCT, _SYMBOL = _of("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"), _of("#$%&*@^~=+<>\\{}[]_")
_HIGH = bytes(range(128))


def features(text: str | None) -> list[float]:
    """The vector of one text, in the order of FEATURES."""
    import zstandard

    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, m = max(1, len(raw)), max(1, len(words))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    marked = sum(1 for w in words if not w[-1:].isalnum() and not w[-2:-1].isalnum() and len(w) > 2)
    only = lambda drop: len(raw.translate(None, drop))
    packed = len(zstandard.ZstdCompressor(level=1).compress(raw)) if raw else 0
    return [
        math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / m, only(_UPPER) / n, only(_DIGIT) / n,
        only(_PUNCT) / n, only(_SYMBOL) / n, raw.count(b"!") / m, raw.count(b"|") / m, only(_HIGH) / n, raw.count(b".") / m,
        raw.count(b"\n") / m, len(counts) / m, max(counts.values(), default=0) / m, 1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        math.log1p(max(map(len, words), default=0)), marked / m, packed / n, sum(1 for w in words if len(w) < 3) / m, sum(1 for w in words if w[:1].isupper()) / m,
    ]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _leaves(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values, by bin, of a tree that splits the bins' gradients at most `depth` times, best split first."""
    value = np.zeros(len(g))
    spans = [(0, len(g))]
    for _ in range(depth):
        best = (1e-9, None, None)
        for a, b in spans:
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            left, right = cg[:-1] ** 2 / (ch[:-1] + 1), (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + 1)
            gain = left + right - cg[-1] ** 2 / (ch[-1] + 1)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (a, b), a + i + 1)
        if best[1] is None:
            break
        spans.remove(best[1])
        spans += [(best[1][0], best[2]), (best[2], best[1][1])]
    for a, b in spans:
        value[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return value


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The two-by-two split of a grid of gradients that explains most: its gain, and the values by cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a = cg[:-1, :-1], cg[:-1, -1:] - cg[:-1, :-1], cg[-1:, :-1] - cg[:-1, :-1]
    b = ch[:-1, :-1], ch[:-1, -1:] - ch[:-1, :-1], ch[-1:, :-1] - ch[:-1, :-1]
    a, b = (*a, cg[-1, -1] - sum(a)), (*b, ch[-1, -1] - sum(b))
    gain = sum(x**2 / (y + 1) for x, y in zip(a, b))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    value = np.empty_like(g)
    for k, (rows, cols) in enumerate(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
        value[rows, cols] = a[k][i, j] / (b[k][i, j] + 1)
    return float(gain[i, j]), value


class Model:
    """Lookup tables for binned features and pairs of features."""

    def __init__(self, base: float, edges: list[np.ndarray]):
        self.base, self.edges = base, edges
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int]] = []
        self.grids: list[np.ndarray] = []

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)]

    def coarse(self, k: int, bins: np.ndarray) -> np.ndarray:
        return bins * PAIR_BINS // (len(self.edges[k]) + 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        out = np.full(len(x), self.base)
        for b, t in zip(bins, self.tables):
            out += t[b]
        for (i, j), grid in zip(self.pairs, self.grids):
            out += grid[self.coarse(i, bins[i]), self.coarse(j, bins[j])]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.raw(x))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """The model for rows x and labels y (0 or 1)."""
    if not len(y) or y.min() == y.max():
        mean = (y.sum() + 0.5) / (len(y) + 1)
        return Model(math.log(mean / (1 - mean)), [np.zeros(0)] * x.shape[1])
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    m = Model(math.log(y.mean() / (1 - y.mean())), edges)
    bins = m.bins(x)
    f = np.full(len(y), m.base)
    for _ in range(ROUNDS):
        for k, b in enumerate(bins):
            p = _sigmoid(f)
            n = len(m.tables[k])
            step = RATE * _leaves(np.bincount(b, y - p, n), np.bincount(b, p * (1 - p), n), 2)
            m.tables[k] += step
            f += step[b]
    p = _sigmoid(f)
    size = PAIR_BINS * PAIR_BINS
    cells = {(i, j): m.coarse(i, bins[i]) * PAIR_BINS + m.coarse(j, bins[j]) for i in range(len(bins)) for j in range(i)}
    grid = lambda c, w: np.bincount(c, w, size).reshape(PAIR_BINS, PAIR_BINS)
    gains = {pair: _quadrants(grid(c, y - p), grid(c, p * (1 - p)))[0] for pair, c in cells.items()}
    m.pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    m.grids = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in m.pairs]
    for _ in range(PAIR_ROUNDS):
        for pair, table in zip(m.pairs, m.grids):
            p, c = _sigmoid(f), cells[pair]
            step = RATE * _quadrants(grid(c, y - p), grid(c, p * (1 - p)))[1]
            table += step
            f += step.reshape(-1)[c]
    return m


def featurize(docs: DataFrame) -> DataFrame:
    """doc_id, y, x (the feature vector) for each row of docs (doc_id, y, text)."""

    def scan(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(2)):
                part = batch.slice(a, b - a)
                x = [features(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    return docs.select("doc_id", "y", "text").mapInArrow(scan, "doc_id long, y int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", label_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` rows of docs that have a label and aren't held out: those whose doc_id has the least hash."""
    marks = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("y IN (0, 1)")
    marks = marks.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    usable = docs.select(F.col(doc_id).cast("long").alias("doc_id")).join(marks, "doc_id").select("doc_id", "y", place.alias("place"))
    # a cut by hash first, so that tasks send little more than the sample between them
    share = 1.3 * sample / max(1, usable.count())
    chosen = cut(usable.where(F.col("place") < share).orderBy("place", "doc_id", "y").limit(sample).distinct(), "quality-sample")
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    vectors = featurize(own.join(F.broadcast(chosen), "doc_id"))
    got = vectors.orderBy(place, "doc_id", "y", "x").limit(sample).select("x", "y").collect()
    x = np.array([r.x for r in got], np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.y for r in got], np.float64))


def scores(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, score, predicted for each document. options: those of train()."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id=doc_id, text=text, **options))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def scan(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                x = np.array([features(t) for t in batch.column(1).slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(model.value.score(x))], ["doc_id", "score"])

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored = rows.mapInArrow(scan, "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5, **options) -> DataFrame:
    """docs without the rows that score below threshold, in one pass. options: those of train()."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id=doc_id, text=text, **options))
    k, n = docs.columns.index(text), len(docs.columns)
    own = docs.toDF(*[f"_c{i}" for i in range(n)])

    def scan(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(k)):
                part = batch.slice(a, b - a)
                texts = part.column(k).cast(pa.string()).to_pylist()
                x = np.array([features(t) for t in texts])
                yield part.filter(pa.array(model.value.score(x) >= threshold))

    return own.mapInArrow(scan, T.StructType(own.schema.fields)).toDF(*docs.columns)
