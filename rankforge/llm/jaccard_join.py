"""Exact Jaccard join of documents as a metric-space join with pivots.

A document is its set of distinct word shingles; two sets link when
``100 * intersection >= percent * union``, that is at a Jaccard distance of at most
eps = 1 - percent / 100.  The result is the components of the links.

1. Equal sets become one point with a multiplicity (a group of copies of any
   size is settled by a partial aggregation).
2. First level, pivots are single shingles: the nearest ones to a set are its
   own, and a set within eps of it misses at most eps * n of them.  So a set
   enters, in one global order (rare shingles first), the cells of its first
   floor(eps * n) + 1 shingles; linked sets share a cell.
3. Second level, pivots are documents: the first member of each cell.  Cells of
   the same pivot form its region; a set is replicated to the region of every
   pivot it shares a cell with, so linked sets share a region.
4. Each pivot is compared with all of its members inside the triangle-inequality
   windows: | |A| - |B| |, the difference of distances to the empty set, and the sum
   over ``BINS`` parts of the shingle space of the differences of set sizes are both at
   most |A ^ B|.  Pairs inside are verified on the sets.  That settles a region whose
   members are now one component.  Regions of linked pivots are then merged, and the
   unsettled ones are joined in blocks of about ``BLOCK`` members that meet in tasks;
   blocks of the region's largest component never meet each other.  Pairs of different
   components inside the windows are counted exactly, and only links that join
   components leave the task.

   This is where the method departs from pivots that create Voronoi cells, and from
   recursion: almost every text is at distance 0.9 or more from every sampled text, so
   the window of 2 * eps would copy it to nearly all cells (README, with figures).
   Cells of shared shingles stand in for them, blocks for the recursion.
5. Links are counted inside the components, where all of them are: the points of
   a component are dealt in blocks, every two blocks meet in one task, so every
   pair inside the windows is verified once, whatever regions it shares.  Per
   point the task sends the number of rows that the linked points stand for;
   ``jaccard_links`` lists the linked points themselves.

The components of a dense group of any size thus cost members x pivots; counting its
links costs its pairs, in tasks of bounded size, and sends one row per member and
block.  No region or component is held whole.  The global order comes from
counts of 2^``ORDER_BITS`` hash classes over the whole corpus (fixed size).

Defined results: null text is the empty text; a text without words has the empty
set and links with nothing; a text with fewer words than a shingle has one
shingle, the whole sequence; repeated rows and ids are rows of their own, a null
id counts last in a component; an empty table gives an empty result.
Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import discard, hash_texts, mix64, slices, stable, texts_of
from rankforge.operators.skew import lookup

ORDER_BITS = 16
BINS = 512                 # parts prune unrelated sets of up to about 50 times as many shingles
BLOCK = 512                # members of a region in one block
MAP_BITS = 29              # the filter of wanted rows holds at most 2^29 bits


def shingle_hashes(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles with repeats, and their cumulative number per text."""
    h, upto = hash_texts(texts)
    n = np.diff(upto)
    key = np.zeros(len(h), np.uint64)
    if len(h):
        for k in range(words):                        # windows that pass the end of their text are cut below
            key = key * np.uint64(0x9E3779B97F4A7C15) + np.roll(h, -k)
    short = np.flatnonzero((n > 0) & (n < words))
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    keep = np.ones(len(h), bool)
    last = np.repeat(upto[1:], n)
    keep[np.arange(len(h)) + words > last] = False
    for i in short.tolist():
        a, b = upto[i], upto[i + 1]
        whole = np.uint64(b - a)
        for w in h[a:b]:
            whole = mix64(np.array([whole], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w)[0]
        key[a], keep[a] = whole, True
    return mix64(key[keep]), np.concatenate([[0], np.cumsum(count)])


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    key, upto = shingle_hashes(texts, words)
    return [np.unique(key[a:b]) for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]


def row_key(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def class_counts(docs: DataFrame, words: int, text_col: str) -> np.ndarray:
    """Shingles of the corpus in each of 2^ORDER_BITS hash classes: a table of fixed size."""
    size = 1 << ORDER_BITS
    chunk = 1 << 12

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch, "text", 4_000_000):
                key, _ = shingle_hashes(texts_of(part.column("text")), words)
                total += np.bincount((key >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=size)
        rows = total.reshape(-1, chunk)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.array([zlib.compress(r.tobytes(), 1) for r in rows], pa.binary())],
                                         ["part", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(b), np.int64) for b in pdf["counts"])
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "counts": [zlib.compress(total.tobytes(), 1)]})

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "part long, counts binary")
    # two steps, so that no task adds up more than about the square root of the tasks
    rows = rows.withColumn("salt", F.floor(F.rand(1) * 16))
    some = rows.groupBy("part", "salt").applyInPandas(add, "part long, counts binary")
    got = some.groupBy("part").applyInPandas(add, "part long, counts binary").collect()
    out = np.zeros((size // chunk, chunk), np.int64)
    for r in got:
        out[r.part] = np.frombuffer(zlib.decompress(r.counts), np.int64)
    return out.reshape(-1)


def points(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, key, n, sig (of the set), cells, bins."""
    order = docs.sparkSession.sparkContext.broadcast(class_counts(docs, words, text_col))

    def run(batches):
        rank = order.value
        for batch in batches:
            for part in slices(batch, "text", 4_000_000):
                sets = shingle_sets(texts_of(part.column("text")), words)
                sig, cells, bins = [], [], []
                for s in sets:
                    n = len(s)
                    if not n:
                        sig.append(None)
                        cells.append(np.zeros(0, np.int64))
                        bins.append(b"")
                        continue
                    sig.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    enter = n - -(-percent * n // 100) + 1
                    freq = rank[(s >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
                    if enter < n:                        # all of the smallest counts, then ties by hash
                        pick = np.flatnonzero(freq <= np.partition(freq, enter - 1)[enter - 1])
                        first = s[pick[np.lexsort((s[pick], freq[pick]))[:enter]]]
                    else:
                        first = s
                    cells.append(first.astype(np.int64))
                    bins.append(np.minimum(np.bincount((s & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255)
                                .astype(np.uint8).tobytes())
                off = np.concatenate([[0], np.cumsum([len(c) for c in cells])])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sig, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate(cells), pa.int64())),
                     pa.array(bins, pa.binary())], ["id", "key", "n", "sig", "cells", "bins"])

    narrow = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, key long, n long, sig binary, cells array<long>, bins binary")


def wanted_map(keys: DataFrame) -> np.ndarray:
    """Bits of a hash filter for the ``key`` column, sized by the number of keys up to a fixed limit."""
    n = keys.count()
    bits = min(MAP_BITS, max(16, (16 * n).bit_length()))
    page = min(bits, 19)

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros(1 << page, bool)
        own[pdf["bit"].to_numpy() & ((1 << page) - 1)] = True
        return pd.DataFrame({"page": [int(key[0])], "bits": [np.packbits(own).tobytes()]})

    bit = F.pmod(F.xxhash64("key"), F.lit(1 << bits))
    rows = keys.select(bit.alias("bit")).distinct().groupBy(F.shiftright("bit", page).alias("page")) \
        .applyInPandas(pack, "page long, bits binary").collect()
    out = np.zeros((1 << bits - page, 1 << page >> 3), np.uint8)
    for r in rows:
        out[r.page] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def sets_of(docs: DataFrame, keys: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(rid, set) of the wanted points: the texts are read again, and only wanted rows give a set."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted_map(keys))
    size = len(shared.value) * 8

    def run(batches):
        bits = shared.value
        for batch in batches:
            at = batch.column("bit").to_numpy()
            hit = np.flatnonzero(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
            if not len(hit):
                continue
            for part in slices(batch.take(pa.array(hit)), "text", 4_000_000):
                sets = shingle_sets(texts_of(part.column("text")), words)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "set"])

    key = row_key(id_col, text_col)
    rows = docs.select(key.alias("key"), F.pmod(F.xxhash64(key), F.lit(size)).alias("bit"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "key long, set binary").dropDuplicates(["key"]).join(keys, "key").select("rid", "set")


def _need(percent: int):
    """Least intersection of two linked sets of na and nb shingles."""
    return F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / (100 + percent))


def in_windows(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (a, b, na, nb, bins_a, bins_b) that the triangle inequality leaves."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
                        for c in ("bins_a", "bins_b"))
            near = np.abs(one - two).sum(1) <= batch.column("room").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(near))

    sized = pairs.where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    return sized.withColumn("room", (F.col("na") + F.col("nb") - 2 * _need(percent)).cast("long")) \
        .select("a", "b", "room", "bins_a", "bins_b").mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, verified on the sets."""
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    one = sets.select(F.col("rid").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("rid").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, label): label is the least vertex of v's component; least labels spread with pointer jumping."""
    both = stable(edges.select(F.col("a").alias("v"), F.col("b").alias("w"))
                  .unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("w"))).distinct())
    step = stable(both.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("new")))
    while True:
        labels = step.select("v", F.col("new").alias("label"))
        near = both.join(labels.select(F.col("v").alias("w"), F.col("label").alias("l")), "w").groupBy("v").agg(F.min("l").alias("l"))
        nearest = labels.join(near, "v").select("v", "label", F.least("label", "l").alias("new"))
        jump = labels.select(F.col("v").alias("new"), F.col("label").alias("far"))
        before, step = step, stable(nearest.join(jump, "new").select("v", "label", F.least("new", "far").alias("new")))
        discard(before)
        if step.where("label <> new").isEmpty():
            discard(both)
            return step.select("v", F.col("new").alias("label"))


def _near(bins: np.ndarray, n: np.ndarray, label: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of a group are of different components and inside the triangle-inequality windows."""
    bins, size = bins.astype(np.int16), n[:, None] + n
    near = 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
    near &= label[:, None] != label
    room = size - 2 * -(-percent * size // (100 + percent))
    for i in np.flatnonzero(near.any(1)).tolist():
        at = np.flatnonzero(near[i])
        near[i, at] = np.abs(bins[at] - bins[i]).sum(1) <= room[i, at]
    return near


def _intersections(sets: list[np.ndarray], near: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the ``near`` pairs of a group."""
    out = np.zeros(near.shape, np.int64)
    a, b = np.nonzero(np.triu(near))
    if len(a) <= 4 * len(sets):
        for i, j in zip(a.tolist(), b.tolist()):
            out[i, j] = out[j, i] = len(sets[i]) + len(sets[j]) - len(np.union1d(sets[i], sets[j]))
        return out
    # many pairs: a product of the membership matrix with itself, some columns at a time
    own = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    keep = times[col] > 1
    own, col = own[keep], rank[col[keep]]
    order = np.argsort(col, kind="stable")
    own, col = own[order], col[order]
    total = np.zeros(near.shape, np.float64)
    for first in range(0, int(col[-1]) + 1 if len(col) else 0, 4096):
        lo, hi = np.searchsorted(col, [first, first + 4096])
        m = np.zeros((len(sets), 4096), np.float32)
        m[own[lo:hi], col[lo:hi] - first] = 1
        total += m @ m.T
    return np.rint(total).astype(np.int64)


def _groups(batches, keys: list[str], columns: list[str]):
    """The groups of a partition sorted by ``keys``: one group is held at a time."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in (*keys, *columns)))
    for _, own in itertools.groupby(rows(), key=lambda r: r[:len(keys)]):
        yield list(own)


def _dealt(members: DataFrame) -> DataFrame:
    """Members with (region, i, j, b): the pairs of blocks of at most about BLOCK members of a region, and the own block.

    A region of one block is dealt once; a larger one has every two of its blocks meet.
    """
    blocks = members.groupBy("region").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = lookup(members, blocks, "region", spread="rid", how="inner") \
        .withColumn("b", F.pmod(F.xxhash64("rid"), F.col("blocks").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    return own.select("*", other).withColumn("i", F.least("b", "o")).withColumn("j", F.greatest("b", "o")).drop("o", "blocks")


def _dealt_apart(members: DataFrame) -> DataFrame:
    """Members with (region, i, j) such that every two members of different components meet.

    The largest component of a region has blocks of its own, which never meet each other: a large group of near
    copies with a few outsiders costs its members times the blocks of the outsiders.
    """
    size = members.groupBy("region", "label").agg(F.count("*").alias("c"))
    parts = size.groupBy("region").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("all")).select(
        "region", F.col("top.label").alias("most"), F.ceil(F.col("top.c") / BLOCK).cast("int").alias("main"),
        F.ceil((F.col("all") - F.col("top.c")) / BLOCK).cast("int").alias("rest"))
    own = lookup(members, parts, "region", spread="rid", how="inner").where("rest > 0")
    inside = F.col("label") == F.col("most")
    blocks = F.when(inside, F.col("main")).otherwise(F.col("rest"))
    # blocks 0 .. rest - 1 hold the others, rest .. rest + main - 1 the largest component
    b = F.pmod(F.xxhash64("rid"), blocks.cast("long")).cast("int") + F.when(inside, F.col("rest")).otherwise(0)
    last = F.when(inside, F.col("rest")).otherwise(F.col("rest") + F.col("main")) - 1
    dealt = own.withColumn("b", b).select("*", F.explode(F.sequence(F.lit(0), last)).alias("o"))
    # a small region is one group
    small = (F.col("main") + F.col("rest") <= 2)
    return dealt.withColumn("i", F.when(small, 0).otherwise(F.least("b", "o"))).withColumn("j", F.when(small, 0).otherwise(F.greatest("b", "o"))) \
        .dropDuplicates(["region", "i", "j", "rid"]).drop("b", "o", "most", "main", "rest")


def near_members(members: DataFrame, percent: int, windows=_near) -> DataFrame:
    """(region, i, j, rid, n, bins, label) of the dealt members that have a pair in their windows.

    ``windows(bins, n, label, percent)`` tells which pairs of a group are of different components and may link.
    """
    names = ["region", "i", "j", "rid", "n", "bins", "label"]

    def run(batches):
        out = []

        def send():
            cols = list(zip(*out)) if out else [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for group in _groups(batches, names[:3], names[3:]):
            if len(group) > 1:
                bins = np.frombuffer(b"".join(r[5] for r in group), np.uint8).reshape(len(group), -1)
                n, label = (np.array([r[c] for r in group], np.int64) for c in (4, 6))
                out += [group[k] for k in np.flatnonzero(windows(bins, n, label, percent).any(1)).tolist()]
            if len(out) > 5000:
                yield send()
                out.clear()
        yield send()

    sized = _dealt_apart(members).select(names).repartition("region", "i", "j").sortWithinPartitions("region", "i", "j")
    return sized.mapInArrow(run, "region long, i int, j int, rid long, n long, bins binary, label long")


def joined_groups(members: DataFrame, percent: int, windows=_near) -> DataFrame:
    """(a, b): links that join the components of each group, found exactly on the sets."""
    names = ["region", "i", "j", "rid", "n", "bins", "label", "set"]

    def run(batches):
        for group in _groups(batches, names[:3], names[3:]):
            sets = [np.frombuffer(r[7], np.uint64) for r in group]
            bins = np.frombuffer(b"".join(r[5] for r in group), np.uint8).reshape(len(group), -1)
            n, label = (np.array([r[c] for r in group], np.int64) for c in (4, 6))
            near = windows(bins, n, label, percent)
            both = _intersections(sets, near)
            link = near & (100 * both >= percent * (n[:, None] + n - both))
            parent = {x: x for x in label.tolist()}

            def root(x):
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            a, b = [], []
            for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(link)))):
                x, y = root(int(label[i])), root(int(label[j]))
                if x != y:
                    parent[y] = x
                    a.append(group[i][3])
                    b.append(group[j][3])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    sized = members.select(names).repartition("region", "i", "j").sortWithinPartitions("region", "i", "j")
    return sized.mapInArrow(run, "a long, b long")


def links_inside(members: DataFrame, percent: int, listed: bool = False) -> DataFrame:
    """Links between the members (region, rid, n, bins, size, set) of each region, every pair verified once.

    (rid, times): sums of the sizes of the linked points, in parts; or ``listed``, (a, b): the linked points.
    """
    names = ["region", "i", "j", "b", "rid", "n", "bins", "size", "set"]
    out = ["a", "b"] if listed else ["rid", "times"]

    def run(batches):
        for group in _groups(batches, names[:3], names[3:]):
            i, j = group[0][1:3]
            rid, n, size = (np.array([r[c] for r in group], np.int64) for c in (4, 5, 7))
            # two different blocks: only pairs across them
            apart = rid if i == j else np.array([r[3] for r in group], np.int64)
            sets = [np.frombuffer(r[8], np.uint64) for r in group]
            near = _near(np.frombuffer(b"".join(r[6] for r in group), np.uint8).reshape(-1, BINS), n, apart, percent)
            both = _intersections(sets, near)
            link = near & (100 * both >= percent * (n[:, None] + n - both))
            if listed:
                one, two = np.nonzero(np.triu(link))
                cols = np.minimum(rid[one], rid[two]), np.maximum(rid[one], rid[two])
            else:
                some = link.any(1)
                cols = rid[some], (link @ size)[some]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], out)

    sized = _dealt(members).select(names).repartition("region", "i", "j").sortWithinPartitions("region", "i", "j")
    return sized.mapInArrow(run, ", ".join(f"{c} long" for c in out))


def _found(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, reps, of, named): the points of the rows, the distinct sets (rid, key, sig, size, ..), the label of each linked
    set, and of each set (sig, rid, label, component_id)."""
    rows = stable(points(docs, words, percent, id_col, text_col))
    some = rows.where("sig IS NOT NULL").groupBy("sig").agg(
        F.min("id").alias("first_id"), F.min("key").alias("key"), F.any_value("n").alias("n"), F.count("*").alias("size"),
        F.any_value("cells").alias("cells"), F.any_value("bins").alias("bins"))
    reps = stable(some.withColumn("rid", F.monotonically_increasing_id()))
    keys = reps.select("rid", "key")
    # regions: the first member of a cell is the pivot of everything in the cell
    own = reps.select("rid", F.explode("cells").alias("cell"))
    shared = own.groupBy("cell").agg(F.min("rid").alias("region"), F.max("rid").alias("last")).where("region < last").select("cell", "region")
    region = lookup(own, shared, "cell", spread="rid", how="inner").select("region", "rid").distinct()
    members = stable(region.join(reps.select("rid", "n", "bins"), "rid"))
    # each pivot meets the members of its region
    pivot = members.where("rid = region").select("region", F.col("n").alias("na"), F.col("bins").alias("bins_a"))
    met = members.where("rid <> region").join(pivot, "region").select(
        F.col("region").alias("a"), F.col("rid").alias("b"), "na", F.col("n").alias("nb"), "bins_a", F.col("bins").alias("bins_b"))
    pairs = stable(in_windows(met, percent))
    wanted = pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid"))).distinct().join(keys, "rid")
    sets = stable(sets_of(docs, wanted, words, id_col, text_col))
    links = stable(linked(pairs, sets, percent))
    discard(sets)
    # regions of linked pivots become one; those of several components are joined block by block
    label = components(links)
    of = label.withColumnRenamed("v", "rid")
    merged = members.join(label.select(F.col("v").alias("region"), F.col("label").alias("to")), "region", "left") \
        .select(F.coalesce("to", "region").alias("region"), "rid", "n", "bins").dropDuplicates(["region", "rid"])
    merged = stable(merged.join(of, "rid", "left").withColumn("label", F.coalesce("label", "rid")))
    mixed = merged.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("region")
    near = stable(near_members(merged.join(mixed, "region", "left_semi"), percent))
    sets = stable(sets_of(docs, near.select("rid").distinct().join(keys, "rid"), words, id_col, text_col))
    more = stable(joined_groups(near.join(sets, "rid"), percent))
    discard(sets)
    if not more.isEmpty():
        of = components(links.unionByName(more)).withColumnRenamed("v", "rid")
    classes = reps.select("rid", "sig", "first_id").join(of, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    least = classes.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return rows, reps, of, classes.join(least, "label").select("sig", "rid", "label", "component_id")


def _labelled(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Per row: id, key, n_shingles, component_id and the label of its component, null for a row without shingles."""
    return rows.select("id", "key", "n", "sig").join(named, "sig", "left").withColumnRenamed("n", "n_shingles").withColumn(
        "component_id", F.when(F.col("sig").isNull(), F.col("id")).otherwise(F.col("component_id")))


def _linked_members(docs: DataFrame, reps: DataFrame, of: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    own = of.select("rid", F.col("label").alias("region"))
    sets = sets_of(docs, own.select("rid").join(reps.select("rid", "key"), "rid"), words, id_col, text_col)
    return stable(own.join(reps.select("rid", "n", "bins", "size"), "rid").join(sets, "rid"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, key, n_shingles, n_links (rows that the row links with), component_id (least id of the component)."""
    rows, reps, of, named = _found(docs, words, percent, id_col, text_col)
    members = _linked_members(docs, reps, of, words, id_col, text_col)
    times = stable(links_inside(members, percent).groupBy("rid").agg(F.sum("times").alias("times")))
    discard(members)
    own = reps.select("rid", "size").join(times, "rid", "left").select("rid", (F.col("size") - 1 + F.coalesce("times", F.lit(0))).alias("links"))
    return _labelled(rows, named.join(own, "rid")).select("id", "key", "n_shingles", F.coalesce("links", F.lit(0)).alias("n_links"), "component_id")


def jaccard_links(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_a, id_b, size_a, size_b): the linked pairs of distinct sets, each by the least id and the number of its rows."""
    _, reps, of, _ = _found(docs, words, percent, id_col, text_col)
    pairs = links_inside(_linked_members(docs, reps, of, words, id_col, text_col), percent, listed=True)
    one, two = (reps.select(F.col("rid").alias(x), F.col("first_id").alias(f"id_{x}"), F.col("size").alias(f"size_{x}")) for x in "ab")
    return pairs.join(one, "a").join(two, "b").select("id_a", "id_b", "size_a", "size_b")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each component (the least id), with their own columns."""
    rows, _, _, named = _found(docs, words, percent, id_col, text_col)
    found = _labelled(rows, named)
    first = F.min(F.struct(F.col("id").isNull(), "id", "key"))["key"]     # null ids last; the label tells components apart, an id may not
    one = found.where("n_shingles > 0").groupBy("label").agg(first.alias("__key")) \
        .select("__key").unionByName(found.where("n_shingles = 0").select(F.col("key").alias("__key")).distinct())
    keyed = docs.withColumn("__key", row_key(id_col, text_col))
    return keyed.join(one, "__key", "left_semi").dropDuplicates(["__key"]).select(docs.columns)
