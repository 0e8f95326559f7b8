"""Near-duplicate classes of documents: circulant MinHash, banding, exact Jaccard verification, connected components.

Signature. A document is its set of word shingles. Two permutations give all coordinates: the first scatters shingles over a
circle of CIRCLE places (a bijective scrambling of their 64-bit hashes, then the top bits), the second is one fixed random
order `pi` of the places; coordinate k is the least pi of the set's places, all moved on by k. The k coordinates of
a shingle are thus k neighbours in pi, read in one go.

Links. Documents with equal sets form a class, and only classes go on. Classes that agree on all rows of a band share a
bucket. Of each bucket, pairs are tested on their full sets until its members are in one component or every pair has
been tested:
  1. each class with the first class (in a hashed order) of its buckets: one test a class settles most groups, whatever their size;
  2. buckets of up to SMALL classes: every pair not yet in one component;
  3. larger buckets: each class outside a bucket's largest component against all classes of that component, and then the
     classes outside against each other, block by block with their sets, until a link to each component is found.
A pair is left untested only if its estimated similarity (of BANDS * ROWS coordinates) is below the threshold by FLOOR, or if
a path already joins it, so no group is listed pair by pair and none is capped.

With 32 bands of 5 rows, a pair at similarity 0.8 shares no bucket with probability 3e-6.

Defined cases: null, empty and blank texts have no shingle and are linked with nothing; a text with fewer words than a shingle
is one shingle; repeated rows fall in one class; a null doc_id is never a component's name unless all its members' are
null; drop_copies() keeps one row of each component, of texts without a shingle one row of each doc_id and text, or every row
where such a doc_id is null; other columns are ignored, or pass through drop_copies() unchanged; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.llm.common import cut, drop_cut, hash_spans, joined_bytes, mix64, text_slices

BANDS, ROWS = 32, 5
CIRCLE_BITS = 20
SMALL = 16
FLOOR = 0.2
STRAYS, MEMBERS = 512, 2048

#: Bytes of words: all but white space, with capitals made small.
_WORD = np.arange(256, dtype=np.uint8)
_WORD[0x41:0x5B] = np.arange(0x61, 0x7B)
_WORD[[0x20, *range(0x09, 0x0E), 0xFF]] = 0
_NUL = 0xFE  # stands for the zero byte, which is part of words; no UTF-8 holds it
_WORD[0x00] = _NUL


def shingle_sets(texts: list, words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's word shingles."""
    buf, docs = joined_bytes(texts)
    low = _WORD[buf]
    inside = np.zeros(len(low) + 1, np.int8)
    inside[:-1] = low != 0
    edge = np.diff(inside, prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = hash_spans(low, starts, ends)
    at = np.append(np.searchsorted(starts, docs), len(starts)).tolist()
    m = max(0, len(h) - words + 1)
    runs = np.zeros(m, np.uint64)
    for j in range(words):
        runs = mix64(runs + h[j : j + m]) if j else mix64(h[:m] + np.uint64(words))
    out = []
    for a, b in zip(at, at[1:]):
        if b - a >= words:
            out.append(np.unique(runs[a : b - words + 1]))
        elif b > a:
            one = mix64(h[a : a + 1] + np.uint64(b - a))
            for x in h[a + 1 : b]:
                one = mix64(one + x)
            out.append(one)
        else:
            out.append(h[:0])
    return out


_circle: dict[int, np.ndarray] = {}


def circle(k: int) -> np.ndarray:
    """Row p: the second permutation's values at places p, p + 1, ..., p + k - 1 around the circle (a view)."""
    if k not in _circle:
        pi = np.random.default_rng(0xC1C).permutation(1 << CIRCLE_BITS).astype(np.uint32)
        _circle[k] = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[: k - 1]]), k)
    return _circle[k]


def signature(shingles: np.ndarray, k: int) -> np.ndarray:
    place = (mix64(shingles ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(64 - CIRCLE_BITS)).astype(np.int64)
    rows, out = circle(k), None
    for i in range(0, len(place), 4096):
        least = rows[place[i : i + 4096]].min(axis=0)
        out = least if out is None else np.minimum(out, least)
    return out


def _sign(docs: DataFrame, words: int, k: int) -> DataFrame:
    """doc_id, mark (hash of the text), n, key (128-bit digest of the set; null if empty), sig (16 bits of each coordinate), bands."""
    import xxhash

    def scan(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(2)):
                part = batch.slice(a, b - a)
                sets = shingle_sets(part.column(2).to_pylist(), words)
                sigs = [signature(s, k) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([None if s is None else s.astype("<u2").tobytes() for s in sigs], pa.binary()),
                    ],
                    ["doc_id", "mark", "n", "key", "sig"],
                )

    return docs.mapInArrow(scan, "doc_id long, mark long, n long, key binary, sig binary")


def _band_rows(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """key, band: a row for each class and band, band being a hash of the band's number and coordinates."""

    def scan(batches):
        number = mix64(np.arange(bands, dtype=np.uint64) + np.uint64(1))
        for batch in batches:
            for a in range(0, len(batch), 2000):
                part = batch.slice(a, 2000)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u2").reshape(len(part), bands, rows).astype(np.uint64)
                h = np.broadcast_to(number, (len(part), bands)).copy()
                for r in range(rows):
                    h = mix64(h + sig[:, :, r] + np.uint64(r))
                keys = pa.array(np.repeat(np.array(part.column(0).to_pylist(), object), bands), pa.binary())
                yield pa.RecordBatch.from_arrays([keys, pa.array(h.reshape(-1).view(np.int64))], ["key", "band"])

    return classes.select("key", "sig").mapInArrow(scan, "key binary, band long")


def _order(key: str, number: int) -> Column:
    return F.xxhash64(F.lit(number), key)


class _Links:
    """Tests of pairs of classes, and the components they make."""

    def __init__(self, members: DataFrame, classes: DataFrame, sets: DataFrame, k: int, part: int, whole: int):
        self.sigs = classes.select("key", "sig")
        self.known = sets.join(self.sigs, "key")
        self.sets, self.k, self.part, self.whole = sets, k, part, whole
        self.labels = cut(members.select("key").distinct().withColumn("comp", F.col("key")), "near-labels")
        self.tested: DataFrame | None = None
        self.written: list[DataFrame] = []

    def test(self, pairs: DataFrame) -> None:
        """pairs: a, b (a < b, distinct). Tests those not yet tested and joins the components of the similar ones."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = cut(pairs, "near-pairs")
        self.written.append(pairs)
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        k, least, part, whole = self.k, (self.part / self.whole - FLOOR) * self.k, self.part, self.whole

        def alike(batches):
            for batch in batches:
                for i in range(0, len(batch), 4000):
                    b = batch.slice(i, 4000)
                    x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(len(b), k) for c in (2, 3))
                    keep = pa.array((x == y).sum(axis=1) >= least)
                    yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

        def similar(batches):
            for b in batches:
                keep = []
                for x, y in zip(b.column(2), b.column(3)):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(whole * both >= part * (len(x) + len(y) - both))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

        likely = _both(pairs, self.sigs, "sig").mapInArrow(alike, "a binary, b binary")
        edges = cut(_both(likely, self.sets, "hashes").mapInArrow(similar, "a binary, b binary"), "near-edges")
        self.labels = merge_labels(self.labels, edges)

    def add(self, edges: DataFrame) -> None:
        self.labels = merge_labels(self.labels, cut(edges, "near-edges"))

    def open_buckets(self, members: DataFrame) -> DataFrame:
        """The rows (band, key, comp) of members whose buckets hold more than one component, with the bucket's size m."""
        rows = members.select("band", "key").join(self.labels, "key")
        rows = cut(rows, "near-rows")
        open_ = rows.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("m")).where("x <> y").select("band", "m")
        return cut(rows.join(cut(open_, "near-bands"), "band"), "near-open")


def _both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """a, b and table's column of each."""
    x = table.select(F.col("key").alias("b"), F.col(column).alias("of_b"))
    y = table.select(F.col("key").alias("a"), F.col(column).alias("of_a"))
    return pairs.join(x, "b").join(y, "a").select("a", "b", "of_a", "of_b")


def merge_labels(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (key, comp) after joining the components of each edge (a, b).

    Every component hooks onto the least of its neighbours, pointers jump twice in the same plan, and the edges between what
    is left go through the same again: each round at least halves the components that have edges.
    """

    def between(edges: DataFrame, names: DataFrame, key: str, comp: str) -> DataFrame:
        x = names.select(F.col(key).alias("a"), F.col(comp).alias("ca"))
        y = names.select(F.col(key).alias("b"), F.col(comp).alias("cb"))
        got = edges.join(x, "a").join(y, "b").where("ca <> cb")
        return cut(got.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "near-between")

    left = between(edges, labels, "key", "comp")
    while left.take(1):
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        for _ in range(2):
            up = roots.select(F.col("a").alias("root"), F.col("root").alias("above"))
            roots = roots.join(up, "root").select("a", F.col("above").alias("root"))
        roots = cut(roots, "near-roots")
        top = roots.select(F.col("a").alias("comp"), "root")
        labels = cut(labels.join(top, "comp", "left").select("key", F.coalesce("root", "comp").alias("comp")), "near-labels")
        left = between(left, roots, "a", "root")
    return labels


def _pairs(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _all_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of different components in buckets of at most SMALL classes."""
    small = rows.where(F.col("m") <= SMALL)
    x, y = small.select("band", F.col("key").alias("x"), F.col("comp").alias("cx")), small.select("band", F.col("key").alias("y"), F.col("comp").alias("cy"))
    return x.join(y, "band").where("x < y AND cx <> cy").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def _shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements of sorted `one` each of the others holds."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    lens = np.array([len(o) for o in others])
    return np.add.reduceat((one[at] == flat).astype(np.int64), np.cumsum(lens) - lens)


class _Block:
    """Classes with signatures and sets, to look for links between them."""

    def __init__(self, table: pa.Table, k: int, part: int, whole: int):
        self.keys = table.column("key").to_pylist()
        self.comp = table.column("comp").to_pylist()
        self.sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(-1, k)
        self.sets = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        self.least, self.part, self.whole = (part / whole - FLOOR) * k, part, whole

    def links(self, i: int, others: np.ndarray):
        """Those of others that are similar to i, the likeliest first, tested a few at a time."""
        same = (self.sig[others] == self.sig[i]).sum(axis=1)
        order = np.argsort(-same, kind="stable")
        order = others[order[same[order] >= self.least]]
        for a in range(0, len(order), 32):
            some = order[a : a + 32]
            both = _shared(self.sets[i], [self.sets[j] for j in some])
            union = len(self.sets[i]) + np.array([len(self.sets[j]) for j in some]) - both
            yield from some[self.whole * both >= self.part * union].tolist()

    def edge(self, i: int, j: int) -> tuple[bytes, bytes]:
        return tuple(sorted((self.keys[i], self.keys[j])))


def _edge_table(edges: list) -> pa.Table:
    a, b = zip(*edges) if edges else ((), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _largest(rows: DataFrame) -> DataFrame:
    """rows (band, key, comp) with big, the component that has most classes in the bucket."""
    sizes = rows.groupBy("band", "comp").count()
    return rows.join(cut(sizes.groupBy("band").agg(F.max(F.struct("count", "comp"))["comp"].alias("big")), "near-largest"), "band")


def _in_chunks(rows: DataFrame, by: str, size: int, chunk: str) -> DataFrame:
    """rows with the number of a chunk, drawn by hash so that chunks hold some `size` rows of a group, and last, the group's largest number."""
    last = rows.groupBy(by).agg(F.floor((F.count("*") - 1) / size).alias(f"last_{chunk}"))
    return rows.join(cut(last, "near-chunks"), by).withColumn(chunk, F.pmod(_order("key", 3), F.col(f"last_{chunk}") + 1))


def _until(last: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(last)))


def _outside_links(rows: DataFrame, links: _Links) -> DataFrame:
    """Links (a, b) between classes outside a bucket's largest component and that component, one for each class at most."""
    outside = _largest(rows).where("comp <> big").select("big", "key").distinct()
    inside = links.labels.join(outside.select(F.col("big").alias("comp")).distinct(), "comp").select(F.col("comp").alias("big"), "key")
    outside, inside = cut(_in_chunks(outside, "big", STRAYS, "i"), "near-outside"), cut(_in_chunks(inside, "big", MEMBERS, "j"), "near-inside")
    last_i, last_j = (cut(x.select("big", c).distinct(), "near-chunks") for x, c in ((outside, "last_i"), (inside, "last_j")))
    one = outside.join(last_j, "big").select("big", "i", _until("last_j").alias("j"), "key", F.lit(True).alias("stray"))
    other = inside.join(last_i, "big").select("big", _until("last_i").alias("i"), "j", "key", F.lit(False).alias("stray"))
    k, part, whole = links.k, links.part, links.whole

    def block(table: pa.Table) -> pa.Table:
        b = _Block(table, k, part, whole)
        stray = np.array(table.column("stray").to_pylist(), bool)
        members = np.flatnonzero(~stray)
        first = ((i, next(b.links(i, members), None)) for i in np.flatnonzero(stray).tolist())
        return _edge_table([b.edge(i, j) for i, j in first if j is not None])

    both = one.unionByName(other).join(links.known, "key").withColumn("comp", F.col("big"))
    return both.groupBy("big", "i", "j").applyInArrow(block, "a binary, b binary")


def _bands_of(sig: np.ndarray, one: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The first band in which each signature agrees with one."""
    return (sig == one).reshape(len(sig), bands, rows).all(axis=2).argmax(axis=1)


def _stray_links(rows: DataFrame, links: _Links, bands: int, n_rows: int) -> DataFrame:
    """Links (a, b) between classes outside their bucket's largest component; a pair is looked at in the first bucket that it shares."""
    stray = _in_chunks(_largest(rows).where("comp <> big").select("band", "key", "comp"), "band", STRAYS, "c")
    stray = stray.withColumn("d", _until("last_c"))
    stray = stray.select("band", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j"), "c", "key", "comp")
    k, part, whole = links.k, links.part, links.whole

    def block(table: pa.Table) -> pa.Table:
        b = _Block(table, k, part, whole)
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        chunk = np.array(table.column("c").to_pylist())
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        # the bucket's own band: the one in which all its classes agree and, of those, the least; checked pair by pair
        root = {c: c for c in b.comp}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        common = (b.sig == b.sig[0]).reshape(len(b.sig), bands, n_rows).all(axis=2).all(axis=0)
        own = int(common.argmax())
        edges = []
        for x in left.tolist():
            others = right[right > x] if i == j else right
            if not len(others):
                continue
            others = others[_bands_of(b.sig[others], b.sig[x], bands, n_rows) == own] if common.any() else others
            for y in b.links(x, np.array([y for y in others.tolist() if find(b.comp[y]) != find(b.comp[x])], np.int64)):
                if find(b.comp[x]) != find(b.comp[y]):
                    root[find(b.comp[x])] = find(b.comp[y])
                    edges.append(b.edge(x, y))
        return _edge_table(edges)

    return stray.join(links.known, "key").groupBy("band", "i", "j").applyInArrow(block, "a binary, b binary").distinct()


def _set_table(texts: DataFrame, words: int) -> DataFrame:
    """key, hashes: the sets of texts (key, text), once for each key."""

    def scan(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                part = batch.slice(a, b - a)
                sets = shingle_sets(part.column(1).to_pylist(), words)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "hashes"])

    return texts.mapInArrow(scan, "key binary, hashes binary")


def components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 5, threshold: tuple[int, int] = (80, 100), bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """A row for each document: doc_id, mark, n_shingles, component_id, comp.

    Documents with threshold[1] * shared >= threshold[0] * united shingles are linked; component_id is the smallest doc_id
    that links reach. mark is a hash of the text, to tell apart rows of the same doc_id. comp names the component itself, as
several may have equal or null component_ids where doc_ids are repeated or null; null for texts without a shingle.
    """
    k = bands * rows
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    marked = texts.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    signed = cut(_sign(marked, words, k), "near-signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark", "sig"))
    classes = signed.where("key IS NOT NULL").groupBy("key").agg(first.alias("f"))
    classes = cut(classes.select("key", F.col("f.doc_id").alias("doc_id"), F.col("f.mark").alias("mark"), F.col("f.sig").alias("sig")), "near-classes")
    members = _band_rows(classes, bands, rows)
    # hubs are added up in the tasks, then joined as a table: Spark splits the rows of a band that very many classes share
    shared = cut(members.groupBy("band").agg(F.count("*").alias("n"), F.min(_order("key", 0)).alias("least")).where("n > 1").drop("n"), "near-bands")
    members = cut(members.join(shared, "band"), "near-members")
    firsts = members.where(_order("key", 0) == F.col("least"))
    hubs = cut(firsts.groupBy("band").agg(F.min("key").alias("hub")), "near-hubs")
    members = cut(members.drop("least").join(hubs, "band"), "near-members")

    wanted = classes.join(members.select("key").distinct(), "key", "left_semi").select("key", F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    own = marked.join(wanted, marked["doc_id"].eqNullSafe(wanted["_id"]) & (marked["mark"] == wanted["_mark"]))
    sets = cut(_set_table(own.select("key", "text"), words).dropDuplicates(["key"]), "near-sets")

    links = _Links(members, classes, sets, k, *threshold)
    best = members.where("key <> hub").groupBy("key").agg(F.min(F.struct(_order("hub", 0).alias("o"), "hub")).alias("best"))
    links.test(best.select(*_pairs(F.col("key"), F.col("best.hub"))).distinct())
    left = links.open_buckets(members)
    links.test(_all_pairs(left))
    left = links.open_buckets(left.where(F.col("m") > SMALL))
    if left.take(1):  # both over the same components, so that together they cover every pair of a bucket
        links.add(_outside_links(left, links).unionByName(_stray_links(left, links, bands, rows)))

    for done in (members, sets, *links.written):
        drop_cut(done)
    named = classes.select("key", "doc_id").join(links.labels, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    least = cut(named.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "near-least")
    of_key = named.join(least, "comp").select("key", "component_id", "comp")
    out = signed.select("doc_id", "mark", F.col("n").alias("n_shingles"), "key").join(of_key, "key", "left")
    return out.select("doc_id", "mark", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "comp")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id = component_id) for each document."""
    return components(docs, **options).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without all but one row of each component: that of smallest doc_id (nulls last), then of least text hash.

    Texts without a shingle are linked with nothing, so of them only repeated rows go, unless their doc_id is null.
    """
    found = components(docs, doc_id=doc_id, text=text, **options)
    rows = found.groupBy("comp", "doc_id", "mark").agg(F.count("*").alias("n"))
    linked = rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark", "n")).alias("f"))
    alone = rows.where("comp IS NULL").select("doc_id", "mark", (F.col("doc_id").isNotNull() & (F.col("n") > 1)).alias("many"))
    kept = linked.select("f.doc_id", "f.mark", (F.col("f.n") > 1).alias("many")).unionByName(alone)
    kept = cut(kept.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "many"), "near-kept")
    n = len(docs.columns)
    own = docs.toDF(*[f"_c{i}" for i in range(n)])
    i, t = docs.columns.index(doc_id), docs.columns.index(text)
    own = own.withColumn("_of", F.xxhash64(F.col(f"_c{t}").cast("string")))

    def of(keys: DataFrame) -> DataFrame:
        return own.join(keys, own[f"_c{i}"].cast("long").eqNullSafe(F.col("_id")) & (own["_of"] == F.col("_mark")), "left_semi")

    out = of(kept.where("NOT many"))
    if kept.where("many").take(1):  # rows of equal doc_id and text: only they are numbered, so others are not shuffled for it
        again = of(kept.where("many")).withColumn("_id", F.col(f"_c{i}").cast("long"))
        first = F.row_number().over(W.partitionBy("_id", "_of").orderBy(F.lit(1)))
        out = out.unionByName(again.withColumn("_row", first).where("_row = 1").drop("_id", "_row"))
    return out.select(*[F.col(f"_c{j}").alias(c) for j, c in enumerate(docs.columns)])
