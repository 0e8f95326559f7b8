"""What differs between two releases: a hash tree that is followed into differing parts only, and rows aligned so that an inserted one is just that.

Tree. A row's digest covers its values but the ids (columns whose names end in "id") and its place. Digests of rows add up to those of
transcripts, these to corpora and collections: `tree()` is a table of nodes, made by partial aggregates without moving rows, and can be stored
with a release. `differing()` joins two trees level by level, each only below nodes that differ.

Rows. `changed_rows()` reads the rows of transcripts that differ; the others drop out before the first shuffle. A transcript's rows are cut in blocks
behind rows whose digest is divisible by BLOCK, so that an insertion changes the block it falls in and no other. Blocks that both
releases have are aligned by a longest common subsequence of their digests, then the rows of each gap between aligned blocks by one
of theirs. What is left between two aligned rows is paired in order as "changed"; the rest is "only_old" or "only_new". A task holds the block digests of a
transcript, or the row digests of a gap.

Digests have 64 bits. Nulls differ from all values. Equal rows of a transcript are told apart by their places.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.session import stored

BLOCK = 32


def compared(old: DataFrame, new: DataFrame, path: Sequence[str], order: str) -> list[str]:
    """Columns of both releases whose values count."""
    return [c for c in old.columns if c in new.columns and c not in (*path, order) and not c.endswith("id")]


def row_digest(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns, *[F.isnull(c) for c in columns])


def _added(*parts) -> Column:
    """A digest of a multiset of rows, the same for any order and grouping of them: sums of the halves of hashes."""
    h = F.xxhash64(*parts)
    return F.xxhash64(F.count(F.lit(1)), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32)))


def _key(path: Sequence[str]) -> Column:
    return F.to_json(F.array(*[F.col(c).cast("string") for c in path]), {"ignoreNullFields": "false"})


def tree(rows: DataFrame, path: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """level (from 0), key and parent (JSON lists of the path's values), n rows, digest of each node; path runs from the widest part to the transcript."""
    node = rows.groupBy(*path).agg(F.count("*").alias("n"), _added(order, row_digest(columns)).alias("digest"))
    out = None
    for level in range(len(path), -1, -1):
        parent = _key(path[: level - 1]) if level else F.lit(None).cast("string")
        part = node.select(F.lit(level).alias("level"), _key(path[:level]).alias("key"), parent.alias("parent"), "n", "digest")
        out = part if out is None else out.unionByName(part)
        if level:
            above = [F.col(c) for c in path[: level - 1]]
            node = node.groupBy(*above).agg(F.sum("n").alias("n"), _added(F.col(path[level - 1]).cast("string"), F.isnull(path[level - 1]), "digest").alias("digest"))
    return out


def differing(old: DataFrame, new: DataFrame, depth: int) -> DataFrame:
    """level, key, status (changed, only_old, only_new), n_old, n_new of nodes that differ between two trees; below a node that one release lacks, none is listed."""
    found, above = [], None
    for level in range(depth + 1):
        x, y = (t.where(F.col("level") == level).select("key", "parent", F.col("n").alias(f"n_{s}"), F.col("digest").alias(s)) for t, s in ((old, "old"), (new, "new")))
        if above is not None:
            x, y = (t.join(above, "parent", "left_semi") for t in (x, y))
        both = x.drop("parent").join(y.drop("parent"), "key", "full_outer")
        status = F.when(F.col("old").isNull(), "only_new").when(F.col("new").isNull(), "only_old").when(F.col("old") != F.col("new"), "changed")
        both = both.select(F.lit(level).alias("level"), "key", status.alias("status"), "n_old", "n_new").where("status IS NOT NULL")
        both = stored(both, "tree-level")
        above = both.where("status = 'changed'").select(F.col("key").alias("parent"))
        found.append(both)
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def common_subsequence(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Places (i, j) of a longest common subsequence.

    Bit j of the state after i items of a is 0 if the first j + 1 items of b give a longer one than the first j. A step is some operations on whole
    states, so time is len(a) * len(b) / 64 words; states are kept at intervals and made again in between when the path is read back.
    """
    lead = 0
    while lead < min(len(a), len(b)) and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ends = [(i, i) for i in range(lead)], [(len(a) - i, len(b) - i) for i in range(tail, 0, -1)]
    both = set(a[lead : len(a) - tail]) & set(b[lead : len(b) - tail])
    ia = [i for i in range(lead, len(a) - tail) if a[i] in both]
    ib = [j for j in range(lead, len(b) - tail) if b[j] in both]
    places: dict = {}
    for k, j in enumerate(ib):
        places[b[j]] = places.get(b[j], 0) | 1 << k
    full = (1 << len(ib)) - 1
    masks = [places[a[i]] for i in ia]

    def run(state: int, part: list[int]) -> list[int]:
        out = [state]
        for mask in part:
            hit = state & mask
            state = (state + hit | state - hit) & full
            out.append(state)
        return out

    step = max(1, int(len(ia) ** 0.5))
    kept = [full]
    for s in range(0, len(ia), step):
        kept.append(run(kept[-1], masks[s : s + step])[-1])
    found, j = [], len(ib)
    for s in range((len(ia) - 1) // step * step if ia else -1, -1, -step):
        states = run(kept[s // step], masks[s : s + step])
        i = len(states) - 1
        while i and j:
            if states[i] >> j - 1 & 1:
                j -= 1  # this item of b adds nothing
            elif states[i - 1] >> j - 1 & 1:
                i, j = i - 1, j - 1
                found.append((ia[s + i], ib[j]))
            else:
                i -= 1  # it did so without this item of a
    return ends[0] + found[::-1] + ends[1]


def _matched_blocks(table: pa.Table) -> pa.Table:
    """The partner of each block (null: none) and the gap between aligned blocks that it lies in."""
    side, start, digest = (table.column(c).to_numpy() for c in ("side", "start", "digest"))
    of = [np.flatnonzero(side == s)[np.argsort(start[side == s], kind="stable")] for s in (0, 1)]
    partner, gap = np.full(len(side), -1, np.int64), np.zeros(len(side), np.int64)
    for i, j in common_subsequence(digest[of[0]].tolist(), digest[of[1]].tolist()):
        partner[of[0][i]], partner[of[1][j]] = start[of[1][j]], start[of[0][i]]
    for rows in of:
        gap[rows] = np.cumsum(partner[rows] >= 0)
    return table.select(["key", "side", "start"]).append_column("partner", pa.array(partner, mask=partner < 0)).append_column("gap", pa.array(gap))


def _paired_rows(table: pa.Table) -> pa.Table:
    """Rows of a gap that differ: their places, null where a release has none."""
    side, pos, h = (table.column(c).to_numpy() for c in ("side", "pos", "h"))
    a, b = (np.flatnonzero(side == s)[np.argsort(pos[side == s])] for s in (0, 1))
    pairs, i, j = [], 0, 0
    for x, y in [*common_subsequence(h[a].tolist(), h[b].tolist()), (len(a), len(b))]:
        for k in range(max(x - i, y - j)):
            pairs.append((int(pos[a[i + k]]) if i + k < x else None, int(pos[b[j + k]]) if j + k < y else None))
        i, j = x + 1, y + 1
    old, new = zip(*pairs) if pairs else ((), ())
    return pa.table({"key": pa.array([table.column("key")[0].as_py()] * len(pairs), pa.string()), "old_n": pa.array(old, pa.int64()), "new_n": pa.array(new, pa.int64())})


def changed_rows(old: DataFrame, new: DataFrame, path: Sequence[str], order: str, keys: DataFrame, block: int = BLOCK) -> DataFrame:
    """key, status, old_n, new_n (places in the transcript), columns (names whose values differ in a changed row) of rows that differ, in the transcripts of keys (key)."""
    columns = compared(old, new, path, order)
    values = F.array(*[F.col(c).cast("string") for c in columns])
    sides = [df.select(_key(path).alias("key"), F.col(order).alias("order"), row_digest(columns).alias("h"), values.alias("v"), F.lit(s).alias("side")) for s, df in ((0, old), (1, new))]
    rows = sides[0].unionByName(sides[1]).join(keys.select("key"), "key", "left_semi")
    placed = rows.withColumn("pos", F.row_number().over(W.partitionBy("key", "side").orderBy("order", "h")).cast("long")).drop("order")
    w = W.partitionBy("key", "side").orderBy("pos")
    opens = F.lag(F.pmod("h", F.lit(block)) == 0).over(w)
    placed = placed.withColumn("opens", opens).withColumn("start", F.coalesce(F.max(F.when(F.col("opens"), F.col("pos"))).over(w), F.lit(1).cast("long"))).drop("opens")
    placed = stored(placed, "diff-rows")
    blocks = placed.groupBy("key", "side", "start").agg(_added(F.col("pos") - F.col("start"), "h").alias("digest"))
    matched = blocks.groupBy("key").applyInArrow(_matched_blocks, "key string, side int, start long, partner long, gap long")
    left = placed.select("key", "side", "start", "pos", "h").join(matched.where("partner IS NULL"), ["key", "side", "start"])
    pairs = left.select("key", "gap", "side", "pos", "h").groupBy("key", "gap").applyInArrow(_paired_rows, "key string, old_n long, new_n long")
    pairs = stored(pairs, "diff-pairs")
    of = [placed.where(F.col("side") == s).select("key", F.col("pos").alias(f"{n}_n"), F.col("v").alias(n)) for s, n in ((0, "old"), (1, "new"))]
    both = pairs.join(of[0], ["key", "old_n"], "left").join(of[1], ["key", "new_n"], "left")
    names = F.array(*[F.lit(c) for c in columns])
    differ = F.filter(names, lambda c, i: ~F.get("old", i).eqNullSafe(F.get("new", i)))
    status = F.when(F.col("old_n").isNull(), "only_new").when(F.col("new_n").isNull(), "only_old").otherwise("changed")
    return both.select("key", status.alias("status"), "old_n", "new_n", F.when(F.col("old_n").isNotNull() & F.col("new_n").isNotNull(), differ).alias("columns"))
