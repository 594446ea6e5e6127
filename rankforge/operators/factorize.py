"""Truncated SVD with a bounded basis, and exact top scores.

The right singular vectors are eigenvectors of A = CᵀC, found by a locally optimal
block method (Knyazev 2001): the search space of a step is the current vectors X,
the direction P of the last change, the residuals V of the vectors that have not
converged, and AV, at most 4 (k + oversample) columns at any time.  Products with
A are one pass over whole rows where the column side fits a broadcast of checked
size, else block joins (``operators.blocks``); everything else of a step is one pass
that writes the basis with its images and a Gram matrix, and a small dense
problem on the driver.  Images are carried along, so nothing is multiplied twice,
converged vectors are no longer multiplied, and tables of earlier steps are
deleted.  Each step is a written table, so a lost executor costs one step.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.operators.blocks import (beside, block_index, blocks_of, columns, columns_at_a_time, dense, gram_of, id_blocks, mapped, panels, placed,
                                        product, row_panels, row_product, side_by_side, unblocked, with_gram)
from rankforge.operators.ranking import global_rank
from rankforge.session import discard, materialize


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list<double> column."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def gram(x: DataFrame, vec: str = "vec") -> np.ndarray:
    """XᵀX: one partial per partition, added up in two steps so that few reach the driver."""
    import pandas as pd

    def partial(batches):
        g = None
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column(vec))
                g = m.T @ m if g is None else g + m.T @ m
        if g is not None:
            yield pa.RecordBatch.from_arrays([pa.array([g.shape[0]], pa.int32()), pa.array([g.tobytes()], pa.binary())], ["r", "g"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in pdf["g"])
        return pd.DataFrame({"r": [pdf["r"].iloc[0]], "g": [total.tobytes()]})

    parts = x.select(vec).mapInArrow(partial, "r int, g binary")
    rows = parts.groupBy(F.pmod(F.spark_partition_id(), F.lit(16))).applyInPandas(add, "r int, g binary").collect()
    if not rows:
        return np.zeros((0, 0))
    r = rows[0]["r"]
    return sum(np.frombuffer(p["g"]) for p in rows).reshape(r, r)


def _root_inverse(g: np.ndarray, floor: float) -> np.ndarray:
    """M with (XM)ᵀ(XM) = I for XᵀX = g; directions at or below ``floor`` are dropped."""
    lam, v = np.linalg.eigh((g + g.T) / 2)
    keep = lam > floor
    return v[:, keep] / np.sqrt(lam[keep])


def _ritz(g: np.ndarray, wx: int, wp: int, wv: int, keep: int):
    """Rayleigh-Ritz on S = [X P V AV] from the Gram matrix of [X P AX AP V AV AAV].

    Returns (values, coefficients of the new X, AX, P, AP and of the residuals) over the columns of that matrix.
    """
    n = 2 * (wx + wp) + 3 * wv
    own = [*range(wx + wp), *range(2 * (wx + wp), 2 * (wx + wp) + 2 * wv)]                  # X P V AV
    image = [*range(wx + wp, 2 * (wx + wp)), *range(2 * (wx + wp) + wv, n)]                 # AX AP AV AAV
    s, a = np.eye(n)[:, own], np.eye(n)[:, image]
    k, h = s.T @ g @ s, s.T @ g @ a
    size = np.sqrt(np.maximum(np.diag(k), 1e-300))
    lam, u = np.linalg.eigh(k / size[:, None] / size)
    fine = lam > 1e-12 * lam.max()
    t = (u[:, fine] / np.sqrt(lam[fine])) / size[:, None]
    small = t.T @ ((h + h.T) / 2) @ t
    value, y = np.linalg.eigh(small)
    order = np.argsort(value)[::-1][:keep]
    value, c = value[order], t @ y[:, order]
    real = value > 1e-13 * max(value.max(initial=0.0), 1e-300)
    value, c = value[real], c[:, real]
    p = np.zeros((len(own), 0))
    if wx:                                             # the part of the new X outside the old one, orthogonal to the new one
        p = c.copy()
        p[:wx] = 0
        for _ in range(2):
            p -= c @ (c.T @ (k @ p))
        p = p @ _root_inverse(p.T @ k @ p, 1e-10)
    return value, s @ c, a @ c, s @ p, a @ p, a @ c - (s @ c) * value


def truncated_svd(entries: DataFrame, k: int, oversample: int = 20, seed: int = 42, tol: float = 1e-7, max_steps: int = 100):
    """entries(row, col, val) -> (row_factors(id, vec), col_factors(id, vec), sigma, residuals) with k factors.

    Factors are sorted by singular value, largest first.  ``residuals`` are
    |Cᵀ u - sigma v| / sigma for u = C v / sigma; all are at most ``tol``, or the call
    fails.  Directions whose singular value is zero (1e-6 of the largest) are not factors.
    """
    base = materialize(entries.select("row", "col", F.col("val").cast("double").alias("val")))
    (rows, row_blocks), (cols, col_blocks) = (block_index(base.select(c).distinct(), c) for c in ("row", "col"))
    at = placed(base, rows, cols)
    # passes over whole rows where a few columns of the column side can be broadcast, else block joins over both orders
    most = columns_at_a_time(col_blocks, max(k, 0) + oversample)
    whole = row_panels(at) if most else None
    by_cols, by_rows = (None, None) if whole is not None else (panels(at, "c", "r"), panels(at, "r", "c"))
    shared, halves = [], []
    row_ids, col_ids = id_blocks(rows), id_blocks(cols)
    discard(base, at)

    def times(x, width, square=False):
        to = col_blocks if square else row_blocks
        if width <= most:
            out, held = row_product(whole, x, width, col_blocks, to, square)
            shared.append(held)
            return out
        cuts, parts = [(a, min(a + most, width)) for a in range(0, width, most)], []
        for a, z in cuts:
            out, held = row_product(whole, columns(x, width, a, z), z - a, col_blocks, to, square)
            parts.append(materialize(out))
            held.destroy()
        halves.extend(parts)
        return side_by_side(parts, [z - a for a, z in cuts], to)

    def image(x, width):                              # Cᵀ C x
        if whole is not None:
            return times(x, width, square=True)
        return product(by_rows, product(by_cols, x, width, col_blocks, row_blocks), width, row_blocks, col_blocks)

    def start(b, raw, width):
        return np.random.default_rng([seed, b]).standard_normal((len(raw) // 8, width))

    def no_factors():
        none = F.array().cast("array<double>").alias("vec")
        return rows.select("id", none), cols.select("id", none), np.zeros(0), np.zeros(0)

    wx, wp, wv = 0, 0, max(k, 0) + oversample
    if k <= 0:
        return no_factors()
    # a step reads the table of the one before through ``carry``: the columns [X P AX AP V] of the next basis
    state = materialize(mapped(col_ids.withColumnRenamed("ids", "m"), functools.partial(start, width=wv)))
    total, carry, limit = wv, np.eye(wv), tol
    for _ in range(max_steps):
        v = carry[:, carry.shape[1] - wv:]
        once = materialize(image(mapped(state, lambda b, raw, t=total, v=v: dense(raw, t) @ v), wv))
        basis = beside(beside(state, once.withColumnRenamed("m", "m1"), "b", col_blocks, wv), image(once, wv).withColumnRenamed("m", "m2"), "b", col_blocks, wv)
        written = with_gram(basis, lambda r, t=total, c=carry, w=wv: np.hstack([dense(r["m"], t) @ c, dense(r["m1"], w), dense(r["m2"], w)]))
        discard(state, once, *halves)
        halves.clear()
        _destroy(shared)
        state, total, g = blocks_of(written), carry.shape[1] + 2 * wv, gram_of(written)
        if not len(g) or not np.trace(g[-wv:, -wv:]) > 0:
            return no_factors()
        value, x, ax, p, ap, r = _ritz(g, wx, wp, wv, k + oversample)
        size = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", r, g, r), 0))
        if (size[:k] <= limit * value[:k]).all():
            done = _polished(state, total, x, ax, min(k, len(value)))
            if done[2].max(initial=0.0) <= tol:
                break
            limit /= 3                                  # the estimate from sums was too small
        active = np.flatnonzero(size > 0.1 * limit * value)
        active = active if len(active) else np.arange(len(value))
        carry = np.hstack([x, p, ax, ap, r[:, active] / np.maximum(size[active], 1e-300)])
        wx, wp, wv = x.shape[1], p.shape[1], len(active)
    else:
        raise RuntimeError(f"the SVD has not converged: residual {(size[:k] / value[:k]).max():.2e} after {max_steps} steps")
    factors, sigma, residual = done
    discard(state)
    n = len(sigma)
    left = times(factors, n) if whole is not None else product(by_cols, factors, n, col_blocks, row_blocks)
    out = unblocked(mapped(left, lambda b, raw: dense(raw, n) / sigma), row_ids, n), unblocked(factors, col_ids, n), sigma, residual
    discard(factors, *halves, *((by_cols, by_rows) if whole is None else (whole,)), row_ids, col_ids, rows, cols)
    _destroy(shared)
    return out


def _destroy(shared: list):
    while shared:
        shared.pop().destroy()


def _polished(state: DataFrame, total: int, x: np.ndarray, ax: np.ndarray, k: int):
    """(column factors as dense blocks, sigma, residuals) of the first k Ritz vectors, from the vectors themselves."""
    both, w = np.hstack([x, ax]), x.shape[1]
    pair = with_gram(state, lambda r: dense(r["m"], total) @ both)
    g = gram_of(pair)
    lam, u = np.linalg.eigh(g[:w, :w])
    t = u / np.sqrt(lam)
    value, y = np.linalg.eigh(t.T @ ((g[:w, w:] + g[:w, w:].T) / 2) @ t)
    order = np.argsort(value)[::-1][:k]
    c, value = t @ y[:, order], value[order]
    # factors beside their residuals: the Gram matrix has the residuals' lengths free of cancellation
    last = with_gram(blocks_of(pair), lambda r: np.hstack([dense(r["m"], 2 * w)[:, :w] @ c, dense(r["m"], 2 * w)[:, w:] @ c - (dense(r["m"], 2 * w)[:, :w] @ c) * value]))
    residual = np.sqrt(np.maximum(np.diag(gram_of(last))[k:], 0)) / value
    factors = materialize(mapped(blocks_of(last), lambda b, raw: dense(raw, 2 * k)[:, :k]))
    discard(pair, last)
    return factors, np.sqrt(value), residual


# --- exact top scores of users over all items (J8) ----------------------------------------

ITEM_BLOCK = 2048          # items of one block
USER_BLOCK = 2048          # users that a task holds at a time
ROUND_BLOCKS = 8           # item blocks that a group of users meets in a round: what is sent stays in proportion to the users
_USER = "user_id long, vec array<double>, offset double, s long, ids array<long>, scores array<double>, cells long, open boolean"


def _item_blocks(items: DataFrame, radius: float, item_block: int) -> DataFrame:
    """(blk, bids, bvec, bbias, norm, bias): items in order of radius * |vec| + bias, packed by ``item_block``.

    ``norm`` and ``bias`` are the largest of a block, so a user scores at most |u| * norm + bias + offset in it.
    """
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    worth = items.select("item_id", "vec", "bias", norm.alias("norm")).withColumn("worth", F.col("norm") * radius + F.col("bias"))
    ranked = global_rank(worth, [F.col("worth").desc(), F.col("item_id").asc()], "at", kind="long")
    numbered = ranked.withColumn("blk", F.floor((F.col("at") - 1) / item_block))

    def run(batches):
        def packed(blk, rows):
            ids, bias = (np.concatenate(x) for x in ([r[0] for r in rows], [r[2] for r in rows]))
            vec = np.concatenate([r[1] for r in rows])
            order = np.argsort(ids, kind="stable")
            vec, bias = np.ascontiguousarray(vec[order]), bias[order]
            return pa.RecordBatch.from_arrays(
                [pa.array([blk]), *(pa.array([x.tobytes()], pa.binary()) for x in (ids[order], vec, bias)),
                 pa.array([float(np.sqrt((vec * vec).sum(1)).max())]), pa.array([float(bias.max())])],
                ["blk", "bids", "bvec", "bbias", "norm", "bias"])

        held, rows = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            blk = batch.column("blk").to_numpy()
            edge = np.flatnonzero(np.concatenate([[True], blk[1:] != blk[:-1], [True]]))
            for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if held is not None and blk[a] != held:
                    yield packed(held, rows)
                    rows = []
                held = int(blk[a])
                part = batch.slice(a, z - a)
                rows.append((part.column("item_id").to_numpy(), _matrix(part.column("vec")), part.column("bias").to_numpy(zero_copy_only=False)))
        if held is not None:
            yield packed(held, rows)

    sized = numbered.select("blk", "item_id", "vec", "bias").repartition("blk").sortWithinPartitions("blk")
    return materialize(sized.mapInArrow(run, "blk long, bids binary, bvec binary, bbias binary, norm double, bias double"))


class _Users:
    """The users of one group with the best items found so far."""

    def __init__(self, batch: pa.RecordBatch, keep: int):
        self.id, self.offset = batch.column("user_id").to_numpy(), batch.column("offset").to_numpy(zero_copy_only=False)
        self.vec, self.s = _matrix(batch.column("vec")), batch.column("s").to_numpy()
        self.limit = keep + self.s
        self.norm = np.sqrt((self.vec * self.vec).sum(1))
        self.cells = batch.column("cells").to_numpy().copy()
        size = np.diff(batch.column("ids").offsets.to_numpy())
        self.row = np.repeat(np.arange(len(self.id)), size)
        self.item, self.score = batch.column("ids").flatten().to_numpy(), batch.column("scores").flatten().to_numpy(zero_copy_only=False)
        self._cut()

    def _cut(self):
        """Keeps each user's first ``limit`` items and sets the least score that still counts."""
        q = np.round(self.score, 9)
        order = np.lexsort((self.item, -q, self.row))
        row = self.row[order]
        order = order[np.arange(len(row)) - np.searchsorted(row, row, "left") < self.limit[row]]
        self.row, self.item, self.score = self.row[order], self.item[order], self.score[order]
        n = np.bincount(self.row, minlength=len(self.id))
        last = np.cumsum(n) - 1
        self.least = np.where(self.limit == 0, np.inf, -np.inf)
        full = (n >= self.limit) & (n > 0)
        self.least[full] = np.round(self.score[last[full]], 9)

    def may_gain(self, norm, bias) -> np.ndarray:
        """Whether a block of items of at most this norm and bias can hold one of a user's best (ties included)."""
        most = self.norm * norm + bias + self.offset
        return most + 2e-9 + 1e-12 * np.abs(most) >= self.least

    def meet(self, ids: np.ndarray, vec: np.ndarray, bias: np.ndarray):
        top = float(np.sqrt((vec * vec).sum(1)).max())
        own = np.flatnonzero(self.may_gain(top, float(bias.max())))
        if not len(own):
            return
        self.cells[own] += len(ids)
        sc = self.vec[own] @ vec.T + self.offset[own, None] + bias
        r, c = np.nonzero(sc >= (self.least[own] - 1e-9 - 1e-15 * np.abs(self.least[own]))[:, None]) if np.isfinite(self.least[own]).all() else (None, None)
        if r is not None and len(r) <= 4 * int(self.limit[own].sum()):         # few can count: the cut sorts them out
            self.row, self.item = np.concatenate([self.row, own[r]]), np.concatenate([self.item, ids[c]])
            self.score = np.concatenate([self.score, sc[r, c]])
            self._cut()
            return
        q = np.round(sc, 9)
        limit = np.minimum(self.limit[own], len(ids))
        kth = -np.partition(-q, np.unique(np.maximum(limit, 1)) - 1, axis=1)[np.arange(len(own)), np.maximum(limit, 1) - 1]
        r, c = np.nonzero(q >= np.maximum(kth, self.least[own])[:, None])
        self.row, self.item = np.concatenate([self.row, own[r]]), np.concatenate([self.item, ids[c]])
        self.score = np.concatenate([self.score, sc[r, c]])
        self._cut()

    def rows(self, rest: list[tuple[float, float]]) -> pa.RecordBatch:
        still = np.zeros(len(self.id), bool)
        for norm, bias in rest:
            still |= self.may_gain(norm, bias)
        off = pa.array(np.concatenate([[0], np.cumsum(np.bincount(self.row, minlength=len(self.id)))]), pa.int32())
        voff = pa.array(np.arange(len(self.id) + 1) * self.vec.shape[1], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(self.id), pa.ListArray.from_arrays(voff, pa.array(self.vec.ravel())), pa.array(self.offset), pa.array(self.s),
             pa.ListArray.from_arrays(off, pa.array(self.item)), pa.ListArray.from_arrays(off, pa.array(self.score)),
             pa.array(self.cells), pa.array(still)], ["user_id", "vec", "offset", "s", "ids", "scores", "cells", "open"])


def _round(users: DataFrame, groups: int, blocks: DataFrame, keep: int, rest: list[tuple[float, float]]) -> DataFrame:
    """The users after meeting ``blocks``, in groups that a task holds one at a time; blocks go to every group of open users."""
    names = ["user_id", "vec", "offset", "s", "ids", "scores", "cells", "open"]
    none = [F.lit(None).cast(t).alias(c) for c, t in zip(names, ("long", "array<double>", "double", "long", "array<long>", "array<double>", "long", "boolean"))]
    own = users.select(F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int").alias("g"), F.lit(-1).cast("long").alias("ord"), *names,
                       *[F.lit(None).cast("binary").alias(c) for c in ("bids", "bvec", "bbias")])
    met = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.col("blk").alias("ord"), *none, "bids", "bvec", "bbias")

    def run(batches):
        held, parts, group = None, [], None
        for batch in batches:
            g, order = batch.column("g").to_numpy(), batch.column("ord").to_numpy()
            at = 0
            while at < batch.num_rows:
                if g[at] != held:
                    if parts or group is not None:
                        yield (group or _Users(_joined(parts), keep)).rows(rest)
                    held, parts, group = g[at], [], None
                past = at + 1
                if order[at] < 0:
                    while past < batch.num_rows and g[past] == held and order[past] < 0:
                        past += 1
                    parts.append(batch.slice(at, past - at).select(names))
                elif parts or group is not None:
                    if group is None:
                        group, parts = _Users(_joined(parts), keep), []
                    ids, bias = np.frombuffer(batch.column("bids")[at].as_py(), np.int64), np.frombuffer(batch.column("bbias")[at].as_py())
                    group.meet(ids, np.frombuffer(batch.column("bvec")[at].as_py()).reshape(len(ids), -1), bias)
                at = past
        if parts or group is not None:
            yield (group or _Users(_joined(parts), keep)).rows(rest)

    tasks = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.unionByName(met).repartitionById(min(groups, 8 * tasks), F.col("g")).sortWithinPartitions("g", "ord")
    return materialize(dealt.mapInArrow(run, _USER))


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def top_scores(users: DataFrame, items: DataFrame, keep: int, item_block: int = ITEM_BLOCK, user_block: int = USER_BLOCK) -> DataFrame:
    """Exact per-user top ``keep + s`` of offset_u + bias_i + <u, v_i> over all items: (user_id, item_id, score)."""
    found = top_lists(users, items, keep, item_block, user_block)
    if found is None:
        return users.sparkSession.createDataFrame([], SCORE_SCHEMA)
    return found.select("user_id", F.explode(F.arrays_zip("ids", "scores")).alias("x")) \
        .select("user_id", F.col("x.ids").alias("item_id"), F.col("x.scores").alias("score"))


def top_lists(users: DataFrame, items: DataFrame, keep: int, item_block: int = ITEM_BLOCK, user_block: int = USER_BLOCK) -> DataFrame | None:
    """(user_id, ids, scores, cells): the lists of ``top_scores`` and how many items each user was scored against.

    users(user_id, vec, offset, s), items(item_id, vec, bias).  Item blocks come in order of how much they can score;
    by Cauchy and Schwarz a user scores at most |u| * (largest norm) + (largest bias) + offset in a block.  The first
    round gives every user the first block, each further round four times as many blocks (at most ROUND_BLOCKS) to the users
    that can still gain from one; a user that cannot is done.  Blocks and groups of users meet by a shuffle, rounds are written tables,
    and only two numbers per block reach the driver, so neither plan nor broadcast grows with the catalog.
    """
    users = materialize(users.select("user_id", "vec", "offset", F.col("s").cast("long").alias("s")))
    head = users.agg(F.count("*").alias("n"), F.avg(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).alias("r")).first()
    blocks = _item_blocks(items, float(head.r or 0.0), item_block)
    bounds = [(r.norm, r.bias) for r in blocks.orderBy("blk").select("norm", "bias").collect()]
    if not head.n or not bounds:
        return None
    state = users.select("*", F.array().cast("array<long>").alias("ids"), F.array().cast("array<double>").alias("scores"),
                         F.lit(0).cast("long").alias("cells"), F.lit(True).alias("open"))
    done, open_users, at, size = None, head.n, 0, 1
    while at < len(bounds) and open_users:
        past = min(at + size, len(bounds))
        after = _round(state, max(1, -(-open_users // user_block)), blocks.where(F.col("blk").between(at, past - 1)), keep, bounds[past:])
        if at:
            discard(state)
        state = after.where("open")
        open_users = state.count()
        ready = after.where("NOT open").select("user_id", "ids", "scores", "cells")
        ready = materialize(ready) if open_users else ready
        done = ready if done is None else done.unionByName(ready)
        at, size = past, min(size * 4, ROUND_BLOCKS)
    discard(users, blocks)
    return done


SCORE_SCHEMA = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("item_id", T.LongType()),
                             T.StructField("score", T.DoubleType())])
