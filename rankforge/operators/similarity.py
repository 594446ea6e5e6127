"""Cosine similarity by co-occurrence (J4, V4) and neighbour lists (K2, V5, V6).

The matrix stays a long table ``(key, id, w)``: similarity between two ids is
Σ_key w_a·w_b / (‖a‖·‖b‖).

``cosine_pairs`` is for asked pairs and whole similarity tables: only pairs that
share a key are ever produced, each unordered pair once (a < b), then mirrored.
Keys holding more than a chunk of rows are salted so no task gets a hot key's
whole pair set; the partial sum per (a, b) runs before the shuffle.

``top_neighbors`` is for the k best of every id and makes no pair table: ids are
packed into blocks of bounded entries, and a block meets, slice by slice, the
entries of other ids on its own keys as sparse products inside a task; only k
rows per id leave it.  What is shuffled is, per block, the entries on the
block's keys: never more than the products, nor than the matrix times the blocks.
Blocks are handled in rounds whose shuffle files are deleted, so that the disk in
use grows with the matrix, however many blocks a key has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.listsums import rounds_for
from rankforge.operators.ranking import running_total, top_n_per_group
from rankforge.operators.skew import lookup, salt_sides
from rankforge.session import discard, materialize, shuffles_released

BLOCK_ENTRIES = 100_000      # entries of one block of ids
BLOCK_IDS = 4096             # ids of one block
SLICE_BLOCKS = 16            # blocks whose ids a block meets at a time
ROW_ENTRIES = 256            # entries of one shuffled row: an Arrow batch of 10,000 rows stays at 60 MB
HEAVY_ENTRIES = 1_000_000    # an id with more entries is paired by joins
CELLS = 250_000              # products added up at a time


def norms(m: DataFrame, id_col: str) -> DataFrame:
    return m.groupBy(id_col).agg(F.sum(F.col("w") * F.col("w")).alias("nsq"))


def cosine_pairs(m: DataFrame, key: str, id_col: str, both_directions: bool = True) -> DataFrame:
    """m(key, id, w) with one row per (key, id) -> (id_a, id_b, dot, sim), a != b.

    Weights here are integer-valued sums, so dot products and squared norms are
    exact in any summation order; ``dot / (sqrt(na) * sqrt(nb))`` is then the
    same double in every engine and neighbour ties break identically.
    """
    # attach each id's squared norm to its rows first (a shuffle of the matrix,
    # not of the much larger pair table), then carry it through the pair sum
    n = norms(m, id_col)
    mn = m.join(n, id_col)
    a = mn.select(F.col(key).alias("_k"), F.col(id_col).alias("id_a"), F.col("w").alias("w_a"),
                  F.col("nsq").alias("na"))
    b = mn.select(F.col(key).alias("_k"), F.col(id_col).alias("id_b"), F.col("w").alias("w_b"),
                  F.col("nsq").alias("nb"))
    a, b = salt_sides(a, b, ["_k"], F.col("id_a"), counted=m.select(F.col(key).alias("_k")))
    dots = (a.join(b, ["_k", "_salt"]).where(F.col("id_a") < F.col("id_b"))
            .groupBy("id_a", "id_b").agg(F.sum(F.col("w_a") * F.col("w_b")).alias("dot"),
                                         F.max("na").alias("na"), F.max("nb").alias("nb")))
    half = dots.select("id_a", "id_b", "dot", (F.col("dot") / (F.sqrt("na") * F.sqrt("nb"))).alias("sim"))
    if not both_directions:
        return half
    # mirror in the same pass (explode), so the half table is computed once
    both = F.explode(F.array(
        F.struct(F.col("id_a").alias("a"), F.col("id_b").alias("b")),
        F.struct(F.col("id_b").alias("a"), F.col("id_a").alias("b"))))
    return half.select(both.alias("_d"), "dot", "sim").select(
        F.col("_d.a").alias("id_a"), F.col("_d.b").alias("id_b"), "dot", "sim")


def neighbors(pairs: DataFrame, k: int | None) -> DataFrame:
    """K2: per id_a the k most similar id_b with sim > 0 -> (id_a, id_b, sim, rank)."""
    p = pairs.where(F.col("sim") > 0).select("id_a", "id_b", "sim")
    return top_n_per_group(p, "id_a", "sim", k, id_col="id_b", rank_col="rank")


class _Block:
    """The rows of the ids of one block as flat arrays in key order."""

    def __init__(self, ids, norm, key, row, w):
        """From bytes or arrays, which are not copied."""
        self.ids, self.norm = np.frombuffer(ids, np.int64), np.sqrt(np.frombuffer(norm))
        self.key, self.row, self.w = np.frombuffer(key, np.int64), np.frombuffer(row, np.int32), np.frombuffer(w)


class _Lists:
    """The k best neighbours so far of the ids of a block."""

    def __init__(self, own: _Block, k: int):
        self.own, self.k = own, k
        self.row, self.id, self.sim = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.least = np.zeros(len(own.ids))             # a similarity must be above 0 to count
        self.multiplied = 0
        by = np.argsort(own.row, kind="stable")
        self.own_key, self.own_row, self.own_w = own.key[by], own.row[by].astype(np.int64), own.w[by]

    def meet(self, other: _Block):
        own, row, w = self.own, self.own_row, self.own_w
        lo, hi = np.searchsorted(other.key, self.own_key, "left"), np.searchsorted(other.key, self.own_key, "right")
        shared = hi > lo
        # what an id has on the other block's keys bounds its similarity to everything there
        reach = np.sqrt(np.bincount(row[shared], w[shared] ** 2, minlength=len(own.ids))) / own.norm
        may = reach * (1 + 1e-9) + 1e-9 >= self.least
        use = np.flatnonzero(shared & may[row])
        if not len(use):
            return
        lo, count, row, w = lo[use], (hi - lo)[use], row[use], w[use]
        upto = np.concatenate([[0], np.cumsum(count)])
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]]))       # whole ids at a time
        a = 0
        while a < len(first) - 1:
            z = max(a + 1, int(np.searchsorted(upto[first], upto[first[a]] + CELLS, "right")) - 1)
            self._found(other, *self._dots(other, lo, count, row, w, upto, first[a], first[z]))
            a = z
        self.multiplied += int(upto[-1])

    @staticmethod
    def _dots(other: _Block, lo, count, row, w, upto, a: int, z: int):
        """(row, place in other.ids, dot) with dot > 0, in this order, from the entries a..z of whole ids."""
        n, base = len(other.ids), int(row[a])
        dense = (int(row[z - 1]) - base + 1) * n
        if row[a] == row[z - 1] or dense <= 8 * int(upto[z] - upto[a]):
            dot = np.zeros(dense)
        else:
            dot = None
        while a < z:
            # a single id may have more products than are added up at a time
            e = z if dot is None else min(z, max(a + 1, int(np.searchsorted(upto, upto[a] + CELLS, "right")) - 1))
            c = count[a:e]
            at = np.repeat(lo[a:e] - (upto[a:e] - upto[a]), c) + np.arange(int(c.sum()))
            cell, x = np.repeat((row[a:e] - base) * n, c) + other.row[at], np.repeat(w[a:e], c) * other.w[at]
            if dot is not None:
                dot += np.bincount(cell, x, minlength=dense)
            a = e
        if dot is not None:
            cell = np.flatnonzero(dot > 0)
            dot = dot[cell]
        else:
            order = np.argsort(cell, kind="stable")
            cell, x = cell[order], x[order]
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            dot, cell = np.add.reduceat(x, first), cell[first]
            cell, dot = cell[dot > 0], dot[dot > 0]
        return base + cell // n, cell % n, dot

    def _found(self, other: _Block, row, at, dot):
        own = self.own
        sim = dot / (own.norm[row] * other.norm[at])
        q = np.round(sim, 9)
        keep = (q >= self.least[row]) & (sim > 0) & (own.ids[row] != other.ids[at])
        row, at, sim, q = row[keep], at[keep], sim[keep], q[keep]
        # the k first of each id by similarity, then id: pairs come in this order of ids
        order = np.argsort((row << 31) + (10 ** 9 - np.rint(q * 1e9).astype(np.int64)), kind="stable")
        by_rank = row[order]
        best = order[np.arange(len(order)) - np.searchsorted(by_rank, by_rank, "left") < self.k]
        self._add(row[best], other.ids[at[best]], sim[best])

    def _add(self, row, ids, sim):
        row, ids, sim = (np.concatenate(x) for x in ((self.row, row), (self.id, ids), (self.sim, sim)))
        order = np.lexsort((ids, -np.round(sim, 9), row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
        order = order[rank < self.k]
        self.row, self.id, self.sim = row[rank < self.k], ids[order], sim[order]
        last = np.flatnonzero(rank[rank < self.k] == self.k - 1)
        self.least[self.row[last]] = np.round(self.sim[last], 9)

    def rows(self) -> pa.RecordBatch:
        rank = np.arange(len(self.row)) - np.searchsorted(self.row, self.row, "left") + 1
        return pa.RecordBatch.from_arrays([pa.array(self.own.ids[self.row]), pa.array(self.id), pa.array(self.sim), pa.array(rank.astype(np.int32))],
                                          ["id_a", "id_b", "sim", "rank"])


def _block(parts: list) -> _Block:
    """The block of shuffled rows (keys, lengths, ids, w, nsq) that come in key order; the parts are given up."""
    key, length, i, w, nsq = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    order = np.argsort(i).astype(np.int32)
    new = np.concatenate([[True], np.diff(i[order]) != 0])
    row = np.empty(len(i), np.int32)
    row[order] = np.cumsum(new, dtype=np.int32) - 1
    first = order[new]
    return _Block(i[first], nsq[first], np.repeat(key, length), row, w)


_ENTRIES = ["ids", "w", "nsq"]


def _short_rows(lists: DataFrame) -> DataFrame:
    """Rows whose arrays hold at most ROW_ENTRIES entries each."""
    at = F.explode(F.sequence(F.lit(0), F.floor((F.size("ids") - 1) / ROW_ENTRIES).cast("int"))).alias("_at")
    cut = lists.select("*", at)
    return cut.select(*[c for c in lists.columns if c not in _ENTRIES],
                      *[F.slice(c, F.col("_at") * ROW_ENTRIES + 1, ROW_ENTRIES).alias(c) for c in _ENTRIES])


def _lists(entries: DataFrame, by: list) -> DataFrame:
    """(by, ids, w, nsq): the entries of each group as arrays."""
    e = entries.groupBy(*by).agg(F.collect_list(F.struct("id", "w", "nsq")).alias("e"))
    return e.select(*[c for c in e.columns if c != "e"], F.col("e.id").alias("ids"), F.col("e.w").alias("w"), F.col("e.nsq").alias("nsq"))


def _own_lists(entries: DataFrame) -> DataFrame:
    """(key, g, ids, w, nsq): the entries of block g on each key, written."""
    return materialize(_lists(entries, [F.col("key"), F.col("blk").alias("g")]))


def _slice_lists(entries: DataFrame) -> DataFrame:
    """(key, ord, ids, w, nsq): the entries of a slice of blocks on each key, in short rows."""
    return _short_rows(_lists(entries, [F.col("key"), F.floor(F.col("blk") / SLICE_BLOCKS).cast("int").alias("ord")]))


def _met_entries(own: DataFrame) -> int:
    """Entries that all blocks get together: every entry once for each block on its key."""
    by_key = own.groupBy("key").agg(F.count(F.lit(1)).alias("b"), F.sum(F.size("ids")).alias("n"))
    with shuffles_released(own.sparkSession):
        return int(by_key.agg(F.sum(F.col("b") * F.col("n"))).first()[0] or 0)


def _dealt(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """entries(key, id, w, nsq, blk) -> (rows (g, ord, key, ids, w, nsq), a written table they read).

    Block g gets its own entries (ord -1) and, per slice ord of blocks, the entries on its keys.  Blocks without a key
    in common never meet.
    """
    own = _own_lists(entries)
    return _dealt_to(own, _slice_lists(entries)), own


def _dealt_to(own: DataFrame, others: DataFrame) -> DataFrame:
    """The rows of ``_dealt`` for the blocks of ``own``."""
    # a key of very many blocks is split into salt buckets
    need, others = salt_sides(own.select("key", "g"), others, ["key"], F.col("g"), chunk=128)
    met = need.join(others.hint("merge"), ["key", "_salt"]).select("g", "ord", "key", *_ENTRIES)
    mine = _short_rows(own).select("g", F.lit(-1).alias("ord"), "key", *_ENTRIES)
    return mine.unionByName(met)


def top_neighbors(m: DataFrame, key: str, id_col: str, k: int, heavy: int = HEAVY_ENTRIES) -> DataFrame:
    """K2 without a pair table: m(key, id, w), one row per (key, id) -> (id_a, id_b, sim, rank), the k best with sim > 0.

    A task holds one block, the k best of its ids, and one slice of the other ids at a time, of which it gets the entries
    on the block's keys alone.  An id is left out of a product when its part on the slice's keys cannot beat its k-th
    best.  Ids with more than ``heavy`` entries do not fit a block; their pairs come from ``cosine_pairs``'s joins, and
    the lists are merged.
    """
    own = m.select(F.col(key).alias("key"), F.col(id_col).alias("id"), "w")
    size = materialize(own.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("w") * F.col("w")).alias("nsq")))
    # blocks of at most about BLOCK_ENTRIES entries and BLOCK_IDS ids: a running total over the ids
    light = running_total(size.where(F.col("n") <= heavy), [F.col("id").asc()], F.greatest(F.col("n"), F.lit(BLOCK_ENTRIES // BLOCK_IDS)), "_t", inclusive=False)
    blocks = light.select("id", F.col("nsq").cast("double").alias("nsq"), F.floor(F.col("_t") / BLOCK_ENTRIES).cast("int").alias("blk"))
    entries = materialize(own.join(blocks, "id").select(F.col("key").cast("long").alias("key"), F.col("id").cast("long").alias("id"),
                                                        F.col("w").cast("double").alias("w"), "nsq", "blk"))
    many = size.where(F.col("n") > heavy)
    top = entries.agg(F.max("blk")).first()[0]
    lists = None
    if top is not None:
        def after(found, o, parts):
            """The lists once the rows of slice ``o`` are there; a block's own entries come first."""
            if o == -1:
                return _Lists(_block(parts), k)
            if parts:
                found.meet(_block(parts))
            return found

        def run(batches):
            held, parts, found = (None, None), [], None
            for batch in batches:
                g, o = batch.column("g").to_numpy(), batch.column("ord").to_numpy()
                edge = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (o[1:] != o[:-1]), [True]]))
                for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    if (g[a], o[a]) != held:
                        found = after(found, held[1], parts)
                        if found is not None and g[a] != held[0]:
                            yield found.rows()
                        held, parts = (g[a], o[a]), []
                    cut = batch.slice(a, z - a)
                    arrays = [cut.column(c) for c in _ENTRIES]
                    parts.append([cut.column("key").to_numpy(), arrays[0].value_lengths().to_numpy(),
                                  *(x.flatten().to_numpy(zero_copy_only=False) for x in arrays)])
            if parts:
                yield after(found, held[1], parts).rows()

        tasks = int(m.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        own_lists = _own_lists(entries)
        rounds = rounds_for(_met_entries(own_lists), entries.count())
        others = _slice_lists(entries) if rounds == 1 else materialize(_slice_lists(entries))
        if rounds > 1:
            discard(entries)
        for r in range(rounds):
            rows = _dealt_to(own_lists.where(F.col("g") % rounds == r), others)
            at = F.floor(F.col("g") / rounds).cast("int")
            dealt = rows.repartitionById(min(int(top) // rounds + 1, 8 * tasks), at).sortWithinPartitions("g", "ord", "key")
            part = materialize(dealt.mapInArrow(run, "id_a long, id_b long, sim double, rank int"))
            lists = part if lists is None else lists.unionByName(part)
        discard(own_lists, others) if rounds > 1 else discard(own_lists)
    if many.isEmpty():
        discard(entries, size) if top is None or rounds == 1 else discard(size)
        return lists if lists is not None else m.sparkSession.createDataFrame([], "id_a long, id_b long, sim double, rank int")
    pairs = _pairs_with(own, size, many)
    both = pairs if lists is None else pairs.unionByName(lists.select("id_a", "id_b", "sim"))
    return top_n_per_group(both, "id_a", "sim", k, id_col="id_b", rank_col="rank")


def _pairs_with(own: DataFrame, size: DataFrame, many: DataFrame) -> DataFrame:
    """(id_a, id_b, sim) in both directions of the pairs that hold one of the ids ``many``."""
    mn = lookup(own, size.select("id", "nsq"), "id", spread="key", how="inner")
    a = lookup(mn, many.select("id"), "id", spread="key", how="inner").select("key", F.col("id").alias("id_a"), F.col("w").alias("w_a"), F.col("nsq").alias("na"))
    b = mn.select("key", F.col("id").alias("id_b"), F.col("w").alias("w_b"), F.col("nsq").alias("nb"))
    b, a = salt_sides(b, a, ["key"], F.col("id_b"))
    dots = (a.join(b, ["key", "_salt"]).where(F.col("id_a") != F.col("id_b"))
            .groupBy("id_a", "id_b").agg(F.sum(F.col("w_a") * F.col("w_b")).alias("dot"), F.max("na").alias("na"), F.max("nb").alias("nb")))
    sims = dots.select("id_a", "id_b", (F.col("dot") / (F.sqrt("na") * F.sqrt("nb"))).alias("sim")).where(F.col("sim") > 0)
    # a pair of two heavy ids is there in both directions already
    back = sims.join(many.select(F.col("id").alias("id_b")), "id_b", "left_anti").select(F.col("id_b").alias("id_a"), F.col("id_a").alias("id_b"), "sim")
    return sims.unionByName(back)
