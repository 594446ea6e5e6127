"""Weighted sums over lists, user by user, without a table of candidates.

A user's row (via, a) asks for the list of ``via``; every entry (id, val) of the list adds a * val to the user's ``id``.
For User-CF ``via`` is a neighbour and the list its items, for Item-CF an item of the history and its neighbours.  Lists
are written once as short packed rows, which are joined and sent to the user, whose entries are added up inside a task, so
that an entry is 16 bytes of an array and never a row of its own.

Users are handled in rounds: a round sends at most ROUND_SHARE times the entries of the user rows and the lists (or
ROUND_LEAST where those are few), is written, and its shuffle files are deleted.  So the disk in use grows with the tables,
not with the candidates; the number of rounds depends on the length of the lists, not on the number of users.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.skew import chunk_rows, hot_keys, salt_sides
from rankforge.session import materialize, shuffles_released

ROW_ENTRIES = 256              # entries of one shuffled row
CELLS = 250_000                # entries that a task adds up at a time
ROUND_SHARE = 1.5              # entries that a round sends, in multiples of the rows and entries it is made from
ROUND_LEAST = 20_000_000       # entries that a round may send however small the tables are

FEW_ROUNDS = 4                 # rounds of users where a round sends in proportion to the tables already


def rounds_for(entries: int, tables: int) -> int:
    """Rounds in which so many ``entries`` are sent, made from ``tables`` entries."""
    return max(1, -(-int(entries) // max(ROUND_LEAST, int(ROUND_SHARE * tables))))


def in_user_rounds(users: DataFrame, rows: int, make) -> DataFrame:
    """``make(users, own)`` for all users, written in at most FEW_ROUNDS rounds of users of which each has ROUND_LEAST of ``rows`` or more.

    ``own`` is the condition on ``user_id`` that holds for a round's users, for other tables to be read by.
    """
    rounds = max(1, min(FEW_ROUNDS, int(rows) // ROUND_LEAST))
    out = None
    for r in range(rounds):
        own = F.pmod(F.xxhash64(F.col("user_id").cast("long")), F.lit(rounds)) == r if rounds > 1 else F.lit(True)
        part = materialize(make(users.where(own), own))
        out = part if out is None else out.unionByName(part)
    return out


def packed_lists(table: DataFrame, via: str, id_col: str, value: str) -> DataFrame:
    """(via, ids, vals): the entries of each ``via`` in rows of at most ROW_ENTRIES, written once."""
    own = table.select(F.col(via).cast("long").alias("via"), F.col(id_col).cast("long").alias("id"), F.col(value).cast("double").alias("val"))
    # the entries of a long list are collected in several parts
    hot = materialize(hot_keys(own, ["via"], chunk_rows(table.sparkSession)))
    part = F.lit(0)
    if not hot.isEmpty():
        own = own.join(F.broadcast(hot), "via", "left")
        part = F.pmod(F.xxhash64("id"), F.coalesce("_s", F.lit(1)))
    lists = own.groupBy("via", part.alias("_part")).agg(F.collect_list(F.struct("id", "val")).alias("e"))
    at = F.explode(F.sequence(F.lit(0), F.floor((F.size("e") - 1) / ROW_ENTRIES).cast("int"))).alias("_at")
    cut = lists.select("via", "e", at).select("via", F.slice("e", F.col("_at") * ROW_ENTRIES + 1, ROW_ENTRIES).alias("e"))
    return materialize(cut.select("via", F.col("e.id").alias("ids"), F.col("e.val").alias("vals")))


def _expanded(batch: pa.RecordBatch):
    """(row, ids, vals) of the entries of a batch; ``row``: the place of the entry's row in the batch."""
    ids, vals = batch.column("ids"), batch.column("vals")
    return (np.repeat(np.arange(batch.num_rows), ids.value_lengths().to_numpy(zero_copy_only=False)),
            ids.flatten().to_numpy(zero_copy_only=False), vals.flatten().to_numpy(zero_copy_only=False))


def _slices(batch: pa.RecordBatch):
    """The batch in runs of rows with about CELLS entries."""
    upto = np.cumsum(batch.column("ids").value_lengths().to_numpy(zero_copy_only=False))
    a = 0
    while a < batch.num_rows:
        z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + CELLS, "right")))
        yield batch.slice(a, z - a)
        a = z


def _by_user(batches, cells, shrink, finish):
    """``finish`` of the ``cells`` (arrays, the user first) of whole users; a user with very many is shrunk on the way."""
    held, least = None, CELLS
    for batch in batches:
        for part in _slices(batch):
            new = cells(part)
            if not len(new[0]):
                continue
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            cut = int(np.searchsorted(held[0], held[0][-1], "left"))
            if cut >= CELLS:
                yield finish([x[:cut] for x in held])
                held, least = [x[cut:] for x in held], CELLS
            if len(held[0]) - cut > 2 * least:
                held = shrink(held)
                least = max(CELLS, len(held[0]))
    if held is not None and len(held[0]):
        yield finish(held)


def _runs(*keys) -> np.ndarray:
    """Where a new run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = functools.reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _summed(held):
    """(user, id, num, den, seen) with one entry per user and id."""
    user, i, num, den, seen = held
    order = np.lexsort((i, user))
    user, i = user[order], i[order]
    first = _runs(user, i)
    return [user[first], i[first], *(np.add.reduceat(x[order], first) for x in (num, den)), np.maximum.reduceat(seen[order], first)]


def _asked_entries(hist: DataFrame, lists: DataFrame) -> tuple[int, int]:
    """(entries that all rows of ``hist`` ask for, rows of ``hist`` and entries of the lists)."""
    size = lists.groupBy("via").agg(F.sum(F.size("ids")).alias("n"))
    asked = hist.groupBy("via").agg(F.count(F.lit(1)).alias("c"))
    both = asked.join(size, "via", "full").select(F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("n", F.lit(0)).alias("n"))
    with shuffles_released(hist.sparkSession):
        r = both.agg(F.sum(F.col("c") * F.col("n")), F.sum(F.col("c") + F.col("n"))).first()
    return int(r[0] or 0), int(r[1] or 0)


def _in_rounds(hist: DataFrame, lists: DataFrame, own: DataFrame | None, run, schema: str, finish=lambda df: df) -> DataFrame:
    """``run`` over rows (user, kind, via, a, ids, vals) sorted by user: the rows ``own`` (user, ids, vals) with kind 0 first, then the lists.

    ``hist``: (user, via, a), a written table; ``finish``: what Spark does with a round's rows before they are written.
    """
    rounds = rounds_for(*_asked_entries(hist, lists))
    tasks = int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a ``via`` that very many users ask for, and a list of very many rows, are split into salt buckets
    left, right = salt_sides(hist, lists, ["via"], F.col("user"))
    right, left = salt_sides(right.withColumnRenamed("_salt", "_h"), left.withColumnRenamed("_salt", "_h"), ["via", "_h"], F.element_at("ids", 1), chunk=128)
    out = None
    for r in range(rounds):
        mine = F.pmod(F.xxhash64("user"), F.lit(rounds)) == r
        # lists are rows of arrays: never broadcast, whatever the planner takes their size for
        met = left.where(mine).join(right.hint("merge"), ["via", "_h", "_salt"]).select("user", F.lit(1).alias("kind"), "via", "a", "ids", "vals")
        if own is not None:
            met = met.unionByName(own.where(mine).select("user", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("via"), F.lit(0.0).alias("a"), "ids", "vals"))
        sized = met.repartition(tasks, "user").sortWithinPartitions("user", "kind")
        part = materialize(finish(sized.mapInArrow(run, schema)))
        out = part if out is None else out.unionByName(part)
    return out


def top_sums(hist: DataFrame, lists: DataFrame, n: int, seen: DataFrame | None = None, via_seen: bool = False, mean: bool = False) -> DataFrame:
    """(user, id, score, rank): each user's n first ids by (round(score, 9) desc, id), score = sum of a * val over the lists.

    hist(user, via, a), lists of ``packed_lists``.  ``mean`` divides by the sum of |a|.  Ids of ``seen`` (user, ids, vals),
    or with ``via_seen`` the user's own ``via``, are left out.
    """
    def cells(batch):
        row, ids, vals = _expanded(batch)
        user, a = batch.column("user").to_numpy()[row], batch.column("a").to_numpy(zero_copy_only=False)[row]
        known = (batch.column("kind").to_numpy()[row] == 0).astype(np.int8)
        got = [user, ids, a * vals, np.abs(a), known]
        if via_seen:
            mine, via = batch.column("user").to_numpy(), batch.column("via").to_numpy()
            none = np.zeros(len(mine))
            got = [np.concatenate(x) for x in zip(got, [mine, via, none, none, np.ones(len(mine), np.int8)])]
            order = np.argsort(got[0], kind="stable")
            got = [x[order] for x in got]
        return got

    def finish(held):
        user, i, num, den, known = _summed(held)
        keep = (known == 0) & (den > 0) if mean else known == 0
        user, i, score = user[keep], i[keep], num[keep] / den[keep] if mean else num[keep]
        order = np.lexsort((i, -np.round(score, 9), user))
        user = user[order]
        rank = np.arange(len(user)) - np.searchsorted(user, user, "left") + 1
        first = rank <= (len(rank) if n is None else n)
        order = order[first]
        return pa.RecordBatch.from_arrays([pa.array(user[first]), pa.array(i[order]), pa.array(score[order]), pa.array(rank[first].astype(np.int32))],
                                          ["user", "id", "score", "rank"])

    def run(batches):
        yield from _by_user(batches, cells, _summed, finish)

    return _in_rounds(hist, lists, seen, run, "user long, id long, score double, rank int")


def sources(hist: DataFrame, lists: DataFrame, asked: DataFrame, n: int, near: float, finish) -> DataFrame:
    """(user, id, via, val, a) of the lists that hold a user's asked ids, written after ``finish``.

    asked(user, ids, vals) as ``packed_lists`` gives it.  Of an asked pair's sources those come whose ``val`` is at least
    the n-th largest less ``near``, which is what any order by a value rounded to less than ``near`` can put first.
    """
    def cells(batch):
        row, ids, vals = _expanded(batch)
        return [batch.column("user").to_numpy()[row], ids, batch.column("kind").to_numpy()[row].astype(np.int8), batch.column("via").to_numpy()[row],
                vals, batch.column("a").to_numpy(zero_copy_only=False)[row]]

    def chosen(held):
        """The asked ids and the sources that may count, sorted by user, id and kind."""
        user, i, kind, via, val, a = held
        order = np.lexsort((-val, kind, i, user))
        user, i, kind, via, val, a = (x[order] for x in (user, i, kind, via, val, a))
        first = _runs(user, i)
        run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(user))))
        wanted = kind[first] == 0
        heads = np.add.reduceat(kind == 0, first)                  # an asked pair may come in several rows
        last = first + heads + n - 1
        past = last >= np.append(first[1:], len(user))
        least = np.where(past, -np.inf, val[np.minimum(last, len(user) - 1)] - near)
        keep = wanted[run] & ((kind == 0) | (val >= least[run]))
        return [x[keep] for x in (user, i, kind, via, val, a)]

    def found(held):
        user, i, kind, via, val, a = chosen(held)
        s = kind == 1
        return pa.RecordBatch.from_arrays([pa.array(x[s]) for x in (user, i, via, val, a)], ["user", "id", "via", "val", "a"])

    def run(batches):
        yield from _by_user(batches, cells, chosen, found)

    return _in_rounds(hist, lists, asked, run, "user long, id long, via long, val double, a double", finish)
