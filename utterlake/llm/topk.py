"""Exact top-k search by inner product, with multi-resolution segment statistics.

Vectors are quantised to integers (floor(scale * x)). A vector is cut into segments; over a segment of L components, with
means m and deviations s, the squared distance of two vectors is at least L * ((m1 - m2)^2 + (s1 - s2)^2). With the lengths of both
vectors known, that lower bound on distance is an upper bound on their product, the sum over segments of L * (m1 * m2 + s1 * s2).
Bounds hold in any orthonormal basis, and are tight where a segment is short or its components small. So vectors are turned to the principal axes
of a bounded sample first; a level has the leading axes (AXES, as shares of all) as segments of one component each and the rest as one segment. A finer
level keeps the products of the axes that the coarser one had and adds those of its own.
Pairs of a query and a candidate whose bound is below the query's k-th best score so far are dropped, level by level, and only survivors of the last
level are multiplied out, exactly and in the given basis. While many pairs are left, a level's bounds are made for whole blocks as products of
matrices, then for listed pairs (FEW); the comparisons are the same. On vectors without any structure most pairs fall at the finest levels only.

Queries are taken in blocks of at most BLOCK rows, broadcast one block at a time (their size is fixed by BLOCK), and
all candidates are passed over once for each block; if there are several, quantised candidates are written once and read for each.
A block comes with floors: the k-th best score of each query among some SAMPLE candidates, drawn at random (at most twice as many). What lies below a
floor can't be among the k best of all, so tasks screen against it from their first row and hand on, of their own k best for
a query, only what reaches it: some k * n / SAMPLE rows a query of n candidates in all, however many tasks there are. Those are merged
by query. The sample bounds the search and replaces no part of it.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part; vectors of different lengths are
not compared; of rows that share a query's vec_id none is its candidate; if rows share a vec_id, the least vector is the query;
products beyond 64 bits are clipped to the ends of that range; ties go to the smaller vec_id, and equal candidates
(same vec_id and score) each take a rank; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.llm.common import cut, shared_dir

#: Equal segments of the levels where there is no sample to take axes from.
SEGMENTS = (4, 16)
#: Leading axes of the levels, as shares of all.
AXES = (1 / 8, 1 / 4, 1 / 2, 5 / 8, 3 / 4, 7 / 8)
BLOCK = 16_384
#: Candidates that floors are taken from.
SAMPLE = 2_048
#: Queries that a task screens at a time, and candidates: bounds its matrices to some 40 MB.
ROWS_Q, ROWS_C = 1_024, 2_048
#: Share of pairs below which bounds are made for listed pairs.
FEW = 0.02
_EXACT = 2.0**53


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def segment_stats(v: np.ndarray, segments: int) -> np.ndarray:
    """Columns whose products add up to the bound: sqrt(L) * mean and sqrt(L) * deviation of each segment."""
    cuts = np.linspace(0, v.shape[1], min(segments, v.shape[1]) + 1).astype(np.int64)
    out = []
    for a, b in zip(cuts, cuts[1:]):
        part = v[:, a:b]
        out += [part.mean(axis=1), part.std(axis=1)]
    lens = np.repeat(np.diff(cuts), 2)
    return np.stack(out, axis=1) * np.sqrt(lens)


def axes(sample: np.ndarray) -> np.ndarray:
    """The principal axes of some vectors as columns, those of most energy first."""
    largest = np.abs(sample).max(initial=0) or 1.0
    return np.linalg.eigh((sample / largest).T @ (sample / largest))[1][:, ::-1].copy()


def levels(v: np.ndarray, segments: tuple[int, ...], basis: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(own, rest) of each level: products of `own` over all levels so far and of this level's `rest` add up to the bound."""
    n = v.shape[1]
    leading = sorted({round(n * share) for share in AXES} - {0, n})
    if basis is None or not leading:
        return [(v[:, :0], segment_stats(v, k)) for k in segments]
    turned = v @ basis
    return [(turned[:, a:b], segment_stats(turned[:, b:], 1)) for a, b in zip([0, *leading], leading)]


class Best:
    """The k best candidates of each query so far: scores descending, ids ascending among equals; none below the least score to look for."""

    def __init__(self, n: int, k: int, least: np.ndarray | None = None):
        self.k = k
        self.rows = [np.zeros(0, np.int64)] * 3  # query, score, id
        self.floor = np.full(n, -np.inf) if least is None else least.copy()

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q, score, ids = (np.concatenate(x) for x in zip(self.rows, (q, score, ids)))
        order = np.lexsort((ids, -np.maximum(score, -(2**63) + 1), q))
        q, score, ids = q[order], score[order], ids[order]
        first = np.searchsorted(q, q, "left")
        rank = np.arange(len(q)) - first
        keep = (rank < self.k) & (score >= self.floor[q])
        self.rows = [q[keep], score[keep], ids[keep]]
        full = rank == self.k - 1
        self.floor[q[full]] = np.maximum(self.floor[q[full]], score[full])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows paired up, as 64-bit integers."""
    top = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if top < _EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    exact = [sum(int(x) * int(y) for x, y in zip(u, v)) for u, v in zip(a.tolist(), b.tolist())]
    return np.array([max(-(2**63), min(2**63 - 1, e)) for e in exact], np.int64)


def _paired(x: np.ndarray, y: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Products of rows q of x with rows c of y."""
    return np.concatenate([np.einsum("ij,ij->i", x[q[i : i + 65_536]], y[c[i : i + 65_536]]) for i in range(0, len(q), 65_536)] or [np.zeros(0)])


class Searcher:
    """Queries of one vector length against batches of candidates. tried: pairs; left: of them, those that each level leaves; made: products."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, segments: tuple[int, ...], least: np.ndarray | None = None, basis: np.ndarray | None = None):
        self.ids, self.v, self.segments, self.basis = ids, vectors, segments, basis
        self.levels = levels(vectors, segments, basis)
        self.best = Best(len(ids), k, least)
        self.k = k
        self.tried = self.made = 0
        self.left = [0] * len(self.levels)

    def add(self, ids: np.ndarray, v: np.ndarray) -> None:
        theirs = levels(v, self.segments, self.basis)
        for a in range(0, len(self.ids), ROWS_Q):
            rows = slice(a, a + ROWS_Q)
            if np.isinf(self.best.floor[rows]).any():  # no k-th best yet: a few candidates in full
                n = min(len(ids), 4 * self.k)
                q, c = (x.ravel() for x in np.meshgrid(np.arange(a, min(a + ROWS_Q, len(self.ids))), np.arange(n), indexing="ij"))
                self._exact(q, c, ids, v)
                rest = slice(n, None)
            else:
                rest = slice(0, None)
            self._screen(rows, rest, ids, v, theirs)

    def _screen(self, rows: slice, rest: slice, ids: np.ndarray, v: np.ndarray, theirs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Pairs of queries and candidates through the levels."""
        v, ids = v[rest], ids[rest]
        if not len(ids):
            return
        least = self.best.floor[rows] - self._slack(rows, v)
        alive = np.ones((len(least), len(ids)), bool)
        self.tried += alive.size
        known = 0.0  # products of the axes so far, of the block or of the pairs that are left
        q = c = None
        for level, (mine, other) in enumerate(zip(self.levels, theirs)):
            (x, tx), (y, ty) = (m[rows] for m in mine), (m[rest] for m in other)
            if q is None:
                known = known + x @ y.T
                alive &= known + tx @ ty.T >= least[:, None]
                self.left[level] += (n := np.count_nonzero(alive))
                if n < FEW * alive.size:
                    q, c = np.nonzero(alive)
                    known = known[q, c]
            else:
                known = known + _paired(x, y, q, c)
                keep = known + _paired(tx, ty, q, c) >= least[q]
                q, c, known = q[keep], c[keep], known[keep]
                self.left[level] += len(q)
        if q is None:
            q, c = np.nonzero(alive)
        for i in range(0, len(q), 1 << 17):
            part = slice(i, i + (1 << 17))
            self._exact(q[part] + rows.start, c[part], ids, v)

    def _slack(self, rows: slice, v: np.ndarray) -> np.ndarray:
        """More than rounding can take from a bound."""
        longest = np.sqrt(np.einsum("ij,ij->i", v, v).max(initial=0))
        return 1e-9 * (1 + np.sqrt(np.einsum("ij,ij->i", self.v[rows], self.v[rows])) * longest)

    def _exact(self, q: np.ndarray, c: np.ndarray, ids: np.ndarray, v: np.ndarray) -> None:
        other = self.ids[q] != ids[c]
        q, c = q[other], c[other]
        self.made += len(q)
        score = np.concatenate([products(self.v[q[i : i + 65_536]], v[c[i : i + 65_536]]) for i in range(0, len(q), 65_536)] or [np.zeros(0, np.int64)])
        self.best.add(q, score, ids[c])


def _query_blocks(queries: DataFrame, size: int):
    """Blocks of at most `size` queries: (ids, vectors) by vector length, one block in the driver at a time."""
    block: list = []
    for r in queries.toLocalIterator():
        block.append((r.vec_id, list(r.v)))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def _by_length(rows: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """ids and vectors of rows (id, vector), by vector length."""
    out = {}
    for n in {len(v) for _, v in rows}:
        own = [(i, v) for i, v in rows if len(v) == n]
        out[n] = (np.array([i for i, _ in own], np.int64), np.array([v for _, v in own], np.float64))
    return out


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 5, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding", segments: tuple[int, ...] = SEGMENTS, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of vectors' rows for each row of queries (same columns)."""
    spark = vectors.sparkSession

    def quantised(df: DataFrame) -> DataFrame:
        v = F.transform(F.col(embedding), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
        whole = F.transform(F.col(embedding), lambda x: x.cast("double"))
        return df.where(usable(whole) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))

    candidates = quantised(vectors)
    asked = quantised(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    out = shared_dir(spark, "top-k")
    candidates.select(F.lit(0).cast("long").alias("query_id"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0).write.parquet(out)
    blocks = _query_blocks(asked, block)
    rows, following = next(blocks, None), next(blocks, None)
    if following is not None:
        candidates = cut(candidates, "top-k-vectors")
    share = sample / max(1, vectors.count())
    drawn = candidates.where(F.rand(7) < share).limit(2 * sample).collect() if rows else []  # which ones they are changes no result
    known = _by_length([(r.vec_id, r.v) for r in drawn])
    while rows is not None:
        parts = {}
        for n, (ids, v) in _by_length(rows).items():
            basis = axes(known[n][1]) if n in known else None
            first = Searcher(ids, v, k, segments, basis=basis)
            if n in known:
                first.add(*known[n])
            parts[n] = (ids, v, first.best.floor, basis)
        shared = spark.sparkContext.broadcast(parts)

        def search(batches, shared=shared):
            searchers: dict[int, Searcher] = {}
            for batch in batches:
                ids, v = batch.column(0).to_numpy(), batch.column(1)
                lens = v.value_lengths().to_numpy(zero_copy_only=False)
                flat = v.flatten().to_numpy(zero_copy_only=False)
                at = np.cumsum(lens) - lens
                for n in np.unique(lens).tolist():
                    if n not in shared.value:
                        continue
                    if n not in searchers:
                        searchers[n] = Searcher(*shared.value[n][:2], k, segments, *shared.value[n][2:])
                    own = np.flatnonzero(lens == n)
                    m = flat[at[own][:, None] + np.arange(n)]
                    for i in range(0, len(own), ROWS_C):
                        searchers[n].add(ids[own[i : i + ROWS_C]], m[i : i + ROWS_C])
            for s in searchers.values():
                q, score, who = s.best.rows
                if len(q):
                    yield pa.RecordBatch.from_arrays([pa.array(s.ids[q]), pa.array(who), pa.array(score)], ["query_id", "vec_id", "score"])

        candidates.mapInArrow(search, "query_id long, vec_id long, score long").write.mode("append").parquet(out)
        shared.destroy()
        rows, following = following, next(blocks, None)
    found = spark.read.schema("query_id long, vec_id long, score long").parquet(out)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
