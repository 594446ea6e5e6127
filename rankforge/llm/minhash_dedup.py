"""Near duplicates by SuperMinHash signatures, banding, verification and union-find.

A document is its set of distinct word shingles; two sets link when
``100 * intersection >= percent * union``.  The result is the components of the
links; of each component the smallest id stays.

1. Equal sets become one point with a multiplicity, so copies of any number cost
   one partial aggregation.
2. The signature has ``VALUES`` entries.  Each shingle walks through a random
   permutation of them, entry by entry, and offers rank + fraction to the entry
   it meets; an entry keeps the least offer.  Because a shingle's ranks are a
   permutation, its entries are correlated and the estimate of the similarity
   varies less than with independent hashes.  The walk is level by level for many
   documents at once and stops, for each document, as soon as every entry has been
   met, because later levels only offer more.
3. ``ROWS`` entries make a band; points that share a band's key share a bucket.  At
   a similarity of 0.8 a pair misses all of the 40 bands with a probability of
   (1 - 0.8^5)^40 = 1.3e-7.  Buckets of the same members count once.
4. Every member of a bucket meets the bucket's first and last point.  Pairs whose
   sizes fit and whose signatures agree in at least ``least_agreement`` entries (six
   standard deviations under the threshold) are verified on the whole sets; links
   go through union-find.
5. Buckets that still hold several components are dealt in blocks of bounded
   size, those of the largest component never against each other, and all pairs of
   different components are verified exactly; the new links go through union-find
   again.
6. Union-find: tasks reduce their links to a forest, and the forest's least labels
   spread with pointer jumping over written tables.

No bucket is held whole, nothing is capped, and only hash pages and counters reach
the driver.  Defined results: null text is the empty text; a text without words has
the empty set, links with nothing and stays; a text with fewer words than a shingle
has one shingle, the whole sequence; repeated rows and ids are rows of their own; a
null id counts last in a component and is kept where its component has no id; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import discard, mix64, slices, stable, texts_of
from rankforge.llm.jaccard_join import components, joined_groups, linked, near_members, row_key, sets_of, shingle_hashes
from rankforge.operators.skew import lookup, salt_sides

VALUES = 200                    # entries of a signature
ROWS = 5                        # entries of a band
FRACTION = np.uint64(40)        # bits below the rank
STEP = np.uint64(0x9E3779B97F4A7C15)
UNMET = np.uint64((1 << 64) - 1)
CHUNK = 1 << 16                 # shingles that walk together
SLICE_BYTES = 1_000_000
FOREST = 200_000                # points of the links that a task holds at a time


def _offers(keys: np.ndarray, level: int, values: int) -> tuple[np.ndarray, np.ndarray]:
    """(offers, positions to swap with) of the shingles at one level of their walk."""
    bits = mix64(keys + np.uint64((level + 1) * int(STEP) & int(UNMET)))
    offer = (np.uint64(level) << FRACTION) | (bits >> np.uint64(24))
    return offer, level + ((bits & np.uint64(0xFFFFFF)).astype(np.int64) * (values - level) >> 24)


def _walk(entries: np.ndarray, keys: np.ndarray, owner: np.ndarray, left: np.ndarray) -> None:
    """Offers of all shingles (``keys``, of document ``owner``) to ``entries`` (documents x values), level by level.

    ``left``: entries of each document that nothing has met yet.
    """
    values = entries.shape[1]
    flat, order = entries.reshape(-1), None
    for level in range(values):
        offer, pick = _offers(keys, level, values)
        if order is None:
            slot = pick
        else:
            at = np.arange(len(keys))
            slot = order[at, pick].astype(np.int64)
            order[at, pick] = order[:, level]
        where = owner * values + slot
        fresh = np.unique(where[flat[where] == UNMET])
        np.minimum.at(flat, where, offer)
        left -= np.bincount(fresh // values, minlength=len(left))
        more = np.flatnonzero(left[owner] > 0)
        if not len(more):
            return
        if order is None:                                          # the first swap, only for those that walk on
            order = np.tile(np.arange(values, dtype=np.uint8), (len(more), 1))
            order[np.arange(len(more)), pick[more]] = 0
        elif len(more) < len(keys):
            order = order[more]
        keys, owner = keys[more], owner[more]


def signatures(sets: list[np.ndarray], values: int = VALUES) -> np.ndarray:
    """SuperMinHash signatures (rank above ``FRACTION`` bits of fraction) of sets of 64-bit hashes; empty sets stay unmet."""
    out = np.full((len(sets), values), UNMET, np.uint64)
    size = np.array([len(s) for s in sets], np.int64)
    upto = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < len(sets):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + CHUNK, "right")) - 1)
        if size[lo] > CHUNK:
            # a long set: parts fill entries of their own, the least offers hold; a walk may run on, it only offers more
            for at in range(0, int(size[lo]), CHUNK):
                part = np.full((1, values), UNMET, np.uint64)
                own = sets[lo][at:at + CHUNK]
                _walk(part, own, np.zeros(len(own), np.int64), np.full(1, values))
                np.minimum(out[lo:lo + 1], part, out=out[lo:lo + 1])
        elif upto[hi] > upto[lo]:
            part = out[lo:hi]
            _walk(part, np.concatenate(sets[lo:hi]), np.repeat(np.arange(hi - lo), size[lo:hi]), np.full(hi - lo, values))
        lo = hi
    return out


def band_keys(entries: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band and document."""
    bands = entries.shape[1] // rows
    parts = entries[:, :bands * rows].reshape(len(entries), bands, rows)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for k in range(rows):
        key = mix64(key * STEP + parts[:, :, k])
    return key.view(np.int64)


def least_agreement(percent: int, values: int = VALUES) -> int:
    """Entries in which two linked sets agree but for a chance of about 1e-9."""
    p = percent / 100
    return max(0, math.floor(values * p - 6 * math.sqrt(values * p * (1 - p))))


def points(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, key, n, sig (of the set, null if empty), bands, sketch (one byte of each entry)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                hashes, upto = shingle_hashes(texts_of(part.column("text")), words)
                sets = [np.unique(hashes[a:b]) for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]
                size = np.array([len(s) for s in sets])
                entries = signatures(sets)
                sketch = (mix64(entries) & np.uint64(255)).astype(np.uint8)
                bands = band_keys(entries)
                off = np.arange(len(sets) + 1, dtype=np.int32) * bands.shape[1]
                sig = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), pa.array(size, pa.int64()), pa.array(sig, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(bands.reshape(-1))),
                     pa.array([s.tobytes() for s in sketch], pa.binary())], ["id", "key", "n", "sig", "bands", "sketch"])

    narrow = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, key long, n long, sig binary, bands array<long>, sketch binary")


def _agree(one: np.ndarray, two: np.ndarray, na, nb, percent: int) -> np.ndarray:
    """Whether sizes fit and signatures agree (of rows, or of one row with many)."""
    fit = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
    fit &= (one == two).sum(-1) >= least_agreement(percent, one.shape[-1])
    return fit


def agreeing(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (a, b, na, nb, sketch_a, sketch_b) that may link."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sketch_a", "sketch_b"))
            near = _agree(one, two, batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(near))

    return pairs.select("a", "b", "na", "nb", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def apart_and_agreeing(sketch: np.ndarray, n: np.ndarray, label: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of a block are of different components and may link."""
    near = label[:, None] != label
    for i in np.flatnonzero(near.any(1)).tolist():
        at = np.flatnonzero(near[i])
        near[i, at] = _agree(sketch[at], sketch[i], n[at], n[i], percent)
    return near


def forest(edges: DataFrame) -> DataFrame:
    """Union-find inside each task: (a, b) with a the least point of b's tree; what a task holds is bounded."""
    def run(batches):
        parent: dict[int, int] = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        def send():
            pairs = [(top, x) for top, x in ((root(x), x) for x in list(parent)) if top != x]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
                if len(parent) >= FOREST:
                    yield send()
        yield send()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def buckets(reps: DataFrame) -> DataFrame:
    """(region, rid, first, last): the members of every bucket of two points or more, buckets of the same members once."""
    own = reps.select("rid", F.explode("bands").alias("region"))
    shared = own.groupBy("region").agg(F.min("rid").alias("first"), F.max("rid").alias("last"), F.count("*").alias("size"),
                                       F.bit_xor(F.xxhash64("rid")).alias("members")).where("first < last")
    distinct = shared.groupBy("first", "last", "size", "members").agg(F.min("region").alias("region")).select("region", "first", "last")
    return lookup(own, distinct, "region", spread="rid", how="inner").select("region", "rid", "first", "last")


def _pivot_pairs(members: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b, na, nb, sketch_a, sketch_b): each member with the first and the last point of its buckets."""
    met = members.select(F.explode(F.array("first", "last")).alias("a"), F.col("rid").alias("b")).where("a <> b")
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side, other in ("ab", "ba"):                               # either side may be the first point of a large bucket
        own = reps.select(F.col("rid").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"sketch_{side}"))
        left, right = salt_sides(pairs, own, [side], F.col(other))
        pairs = left.join(right, [side, "_salt"]).drop("_salt")
    return pairs


def _found(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, named): the points of the rows, and (sig, label, component_id) of each distinct set."""
    rows = stable(points(docs, words, id_col, text_col))
    some = rows.where("sig IS NOT NULL").groupBy("sig").agg(
        F.min("id").alias("first_id"), F.min("key").alias("key"), F.any_value("n").alias("n"),
        F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
    reps = stable(some.withColumn("rid", F.monotonically_increasing_id()))
    keys = reps.select("rid", "key")
    members = stable(buckets(reps))
    pairs = stable(agreeing(_pivot_pairs(members, reps), percent))
    wanted = pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid"))).distinct()
    sets = stable(sets_of(docs, wanted.join(keys, "rid"), words, id_col, text_col))
    links = stable(linked(pairs, sets, percent))
    discard(pairs, sets)
    label = components(forest(links))
    of = label.withColumnRenamed("v", "rid")
    # buckets of several components: all pairs of different components, block by block
    known = members.select("region", "rid").join(of, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    mixed = known.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("region")
    open_members = stable(lookup(known, mixed, "region", spread="rid", how="inner").join(
        reps.select("rid", "n", F.col("sketch").alias("bins")), "rid").select("region", "rid", "n", "bins", "label"))
    near = stable(near_members(open_members, percent, apart_and_agreeing))
    discard(open_members, members)
    sets = stable(sets_of(docs, near.select("rid").distinct().join(keys, "rid"), words, id_col, text_col))
    more = stable(joined_groups(near.join(sets, "rid"), percent, apart_and_agreeing))
    discard(near, sets)
    if not more.isEmpty():
        of = components(forest(links.unionByName(more))).withColumnRenamed("v", "rid")
    classes = reps.select("rid", "sig", "first_id").join(of, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    least = classes.groupBy("label").agg(F.min("first_id").alias("component_id"))
    left, right = salt_sides(classes, least, ["label"], F.col("rid"))
    named = stable(left.join(right, ["label", "_salt"]).select("sig", "label", "component_id"))
    discard(reps, links, more)
    return rows, named


def _labelled(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Per row: id, key, n_shingles, label, component_id (label null for a row without shingles)."""
    left, right = salt_sides(rows.select("id", "key", "n", "sig").where("n > 0"), named, ["sig"], F.col("key"))
    full = left.join(right, ["sig", "_salt"]).select("id", "key", F.col("n").alias("n_shingles"), "label", "component_id")
    none = rows.where("n = 0").select("id", "key", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("label"),
                                      F.col("id").alias("component_id"))
    return full.unionByName(none)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (least id of the component), kept (id = component_id)."""
    out = _labelled(*_found(docs, words, percent, id_col, text_col))
    return out.select("id", "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, exactly one of each component (the least id, null ids last), with their own columns."""
    found = _labelled(*_found(docs, words, percent, id_col, text_col))
    first = F.min(F.struct(F.col("id").isNull(), "id", "key"))["key"]
    one = found.where("n_shingles > 0").groupBy("label").agg(first.alias("__key")).select("__key") \
        .unionByName(found.where("n_shingles = 0").select(F.col("key").alias("__key")).distinct())
    keyed = docs.withColumn("__key", row_key(id_col, text_col))
    return keyed.join(one, "__key", "left_semi").dropDuplicates(["__key"]).select(docs.columns)
