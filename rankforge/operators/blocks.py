"""A sparse matrix in panels and thin dense matrices in blocks, multiplied by joins.

Ids of a side are dealt by a hash into blocks of about ``BLOCK_IDS`` ids, in id
order inside a block.  A thin dense matrix is a table with one row per block
(b, m: the block's rows as doubles).  A sparse matrix is a table of panels: the
entries of one source block, cut by a hash of the target into parts of about
``PANEL_ENTRIES``, each one row of packed arrays in target order.

``product`` joins panels with the dense blocks of their source (broadcast up to
``BROADCAST_BYTES``, shuffled beyond), multiplies with whole arrays, and shuffles one
partial block per panel and target block to the target, where they are added up
one block at a time.  A task holds one panel and
one block, however many entries an id has.

Where no row has more than ``PANEL_ENTRIES`` entries, panels can hold whole rows
(``row_panels``).  ``row_product`` then multiplies by C, or by CᵀC in one pass with one
shuffle, for dense matrices that fit ``BROADCAST_BYTES`` (checked by the caller with ``fits``).  A wider one
is multiplied by so many of its columns at a time (``columns_at_a_time``), since columns do not depend on each other.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.skew import lookup
from rankforge.session import materialize

BLOCK_IDS = 2048
PANEL_ENTRIES = 100_000
BROADCAST_BYTES = 32 << 20      # dense blocks up to this size go to the panels, larger ones meet them by a shuffle
MAX_PASSES = 32         # passes over whole rows, beyond which block joins read less
TREE_ABOVE = 64          # partial Gram matrices from which they are added up by tasks first


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def block_index(ids: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """((id, b, p): block and place of each distinct id, written once; number of blocks)."""
    blocks = max(1, -(-ids.count() // BLOCK_IDS))
    own = ids.select(F.col(id_col).alias("id"), F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("b"))
    return materialize(own.withColumn("p", F.row_number().over(Window.partitionBy("b").orderBy("id")) - 1)), blocks


def id_blocks(index: DataFrame) -> DataFrame:
    """(b, ids): the ids of each block in order (64-bit integers)."""
    def run(batches):
        for b, (ids,) in _grouped(batches, "b", ["id"]):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([ids.astype(np.int64).tobytes()], pa.binary())], ["b", "ids"])

    sized = index.select("b", "p", "id").repartition("b").sortWithinPartitions("b", "p")
    return materialize(sized.mapInArrow(run, "b int, ids binary"))


def _grouped(batches, key, columns: list[str]):
    """(key, arrays) of the runs of equal ``key`` (a column or several) in a sorted partition; one run is held."""
    keys = [key] if isinstance(key, str) else key
    held, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy() for c in keys], 1)
        cols = [batch.column(c).to_numpy() for c in columns]
        edge = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]).any(1), [True]]))
        for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
            own = tuple(k[a].tolist())
            if held is not None and own != held:
                yield (held[0] if len(keys) == 1 else held), [np.concatenate(x) for x in zip(*parts)]
                parts = []
            held = own
            parts.append([c[a:z] for c in cols])
    if held is not None:
        yield (held[0] if len(keys) == 1 else held), [np.concatenate(x) for x in zip(*parts)]


def placed(entries: DataFrame, rows: DataFrame, cols: DataFrame) -> DataFrame:
    """(rb, rp, cb, cp, val) of entries(row, col, val); rows of a hot id are dealt over several tasks."""
    r = rows.select(F.col("id").alias("row"), F.col("b").alias("rb"), F.col("p").alias("rp"))
    c = cols.select(F.col("id").alias("col"), F.col("b").alias("cb"), F.col("p").alias("cp"))
    # both tables are as large as a side: their copies are never broadcast
    return materialize(lookup(lookup(entries, r, "row", "col", "inner", shuffled=True), c, "col", "row", "inner", shuffled=True)
                       .select("rb", "rp", "cb", "cp", "val"))


def panels(at: DataFrame, source: str, target: str) -> DataFrame:
    """Packed entries of ``placed`` by blocks of ``source`` ('r' or 'c'): (s, tb, tp, sp, val), each array in target order."""
    own = at.select(F.col(f"{source}b").alias("s"), F.col(f"{source}p").alias("sp"), F.col(f"{target}b").alias("tb"),
                    F.col(f"{target}p").alias("tp"), "val")
    return _packed(own, ["tb", "tp"])


def row_panels(at: DataFrame) -> DataFrame | None:
    """Packed entries of ``placed`` by blocks of rows, each row whole in one panel, in row order; None if a row is too long."""
    longest = at.groupBy("rb", "rp").count().agg(F.max("count").alias("n")).first()["n"]
    if longest is None or longest > PANEL_ENTRIES:
        return None
    own = at.select(F.col("rb").alias("s"), F.col("rp").alias("sp"), F.col("cb").alias("tb"), F.col("cp").alias("tp"), "val")
    return _packed(own, ["sp"])


def _packed(own: DataFrame, by: list[str]) -> DataFrame:
    """(s, tb, tp, sp, val): the entries of a block, cut by a hash of ``by`` into parts and sorted by it."""
    parts = own.groupBy("s").agg(F.ceil(F.count("*") / PANEL_ENTRIES).alias("parts"))
    dealt = lookup(own, parts, "s", "tp", "inner").withColumn("part", F.pmod(F.xxhash64(*by), F.col("parts")))
    kinds = [np.int32, np.int32, np.int32, np.float64]

    def run(batches):
        for (s, _), cols in _grouped(batches, ["s", "part"], ["tb", "tp", "sp", "val"]):
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32())] + [pa.array([c.astype(k).tobytes()], pa.binary()) for c, k in zip(cols, kinds)],
                                             ["s", "tb", "tp", "sp", "val"])

    sized = dealt.repartition(_tasks(own), "s", "part").sortWithinPartitions("s", "part", *by)
    return materialize(sized.mapInArrow(run, "s int, tb binary, tp binary, sp binary, val binary"))


def dense(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw).reshape(-1, width)


def dense_row(b: int, m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([np.ascontiguousarray(m).tobytes()], pa.binary())], ["b", "m"])


def dense_rows(batches):
    """(block, bytes) of the dense blocks in a table."""
    for batch in batches:
        for b, m in zip(batch.column("b").to_pylist(), batch.column("m")):
            yield b, m.as_py()


def mapped(x: DataFrame, f) -> DataFrame:
    """(b, f(b, bytes)) of each dense block."""
    def run(batches):
        for b, raw in dense_rows(batches):
            yield dense_row(b, f(b, raw))
    return x.select("b", "m").mapInArrow(run, "b int, m binary")


def fits(blocks: int, width: int) -> bool:
    """Whether ``blocks`` full dense blocks of this width may be broadcast."""
    return blocks * BLOCK_IDS * width * 8 <= BROADCAST_BYTES


def columns_at_a_time(blocks: int, width: int) -> int:
    """Columns of a dense matrix of so many blocks that may be broadcast together, 0 if not even MAX_PASSES passes do."""
    most = min(width, BROADCAST_BYTES // (blocks * BLOCK_IDS * 8))
    return most if most and -(-width // most) <= MAX_PASSES else 0


def beside(big: DataFrame, x: DataFrame, key: str, blocks: int, width: int) -> DataFrame:
    """``big`` joined with dense blocks on ``key``: broadcast where ``blocks`` full ones fit BROADCAST_BYTES, else shuffled."""
    return big.join(F.broadcast(x) if fits(blocks, width) else x, key)


def product(panel: DataFrame, x: DataFrame, width: int, x_blocks: int, blocks: int) -> DataFrame:
    """The panels' matrix times the ``x_blocks`` dense blocks ``x`` of their source: ``blocks`` dense blocks of the target."""
    def partial(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                tb, tp, sp = (np.frombuffer(batch.column(c)[i].as_py(), np.int32) for c in ("tb", "tp", "sp"))
                val, m = np.frombuffer(batch.column("val")[i].as_py()), dense(batch.column("m")[i].as_py(), width)
                first = np.flatnonzero(np.concatenate([[True], (tb[1:] != tb[:-1]) | (tp[1:] != tp[:-1])]))
                sums = np.add.reduceat(m[sp] * val[:, None], first, axis=0)
                tb, tp = tb[first], tp[first]
                edge = np.flatnonzero(np.concatenate([[True], tb[1:] != tb[:-1], [True]]))
                a, z = edge[:-1], edge[1:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb[a], pa.int32()), pa.array([tp[p:q].tobytes() for p, q in zip(a, z)], pa.binary()),
                     pa.array([sums[p:q].tobytes() for p, q in zip(a, z)], pa.binary())], ["b", "p", "m"])

    joined = beside(panel, x.select(F.col("b").alias("s"), "m"), "s", x_blocks, width).select("tb", "tp", "sp", "val", "m")
    parts = joined.mapInArrow(partial, "b int, p binary, m binary")
    return _added(parts, width, blocks)


def _added(parts: DataFrame, width: int, blocks: int) -> DataFrame:
    """(b, m): partial blocks (b, p: places, m: their rows) added up, one block at a time."""
    def add(batches):
        held, total = None, None
        for batch in batches:
            for b, p, m in zip(batch.column("b").to_pylist(), batch.column("p"), batch.column("m")):
                p, m = np.frombuffer(p.as_py(), np.int32), dense(m.as_py(), width)
                if b != held:
                    if held is not None:
                        yield dense_row(held, total)
                    held, total = b, np.zeros((0, width))
                if p[-1] >= len(total):
                    total = np.concatenate([total, np.zeros((int(p[-1]) + 1 - len(total), width))])
                total[p] += m
        if held is not None:
            yield dense_row(held, total)

    return parts.repartitionById(min(_tasks(parts), blocks), F.col("b")).sortWithinPartitions("b").mapInArrow(add, "b int, m binary")


def row_product(whole: DataFrame, x: DataFrame, width: int, x_blocks: int, blocks: int, square: bool = False):
    """(dense blocks of C x, or of CᵀC x where ``square``; the broadcast to destroy when they are written).

    ``whole``: C in ``row_panels``; ``x`` has ``x_blocks`` blocks for which ``fits`` holds; the result has ``blocks``.
    """
    found = {r.b: dense(r.m, width) for r in x.select("b", "m").collect()}                  # at most BROADCAST_BYTES
    none = np.zeros((0, width))
    own = [found.get(b, none) for b in range(x_blocks)]
    shared = whole.sparkSession.sparkContext.broadcast((np.cumsum([0, *map(len, own)]), np.concatenate(own)))

    def partial(batches):
        first, m = shared.value
        total, met = (np.zeros(m.shape), np.zeros(len(m), bool)) if square else (None, None)
        for batch in batches:
            for i in range(batch.num_rows):
                tb, tp, sp = (np.frombuffer(batch.column(c)[i].as_py(), np.int32) for c in ("tb", "tp", "sp"))
                val = np.frombuffer(batch.column("val")[i].as_py())[:, None]
                at = first[tb] + tp
                edge = np.flatnonzero(np.concatenate([[True], sp[1:] != sp[:-1]]))
                y = np.add.reduceat(m[at] * val, edge, axis=0)
                if not square:
                    yield part(batch.column("s")[i].as_py(), sp[edge], y)
                    continue
                y = np.repeat(y, np.diff(np.append(edge, len(sp))), axis=0) * val
                order = np.argsort(at, kind="stable")
                at = at[order]
                edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                total[at[edge]] += np.add.reduceat(y[order], edge, axis=0)
                met[at[edge]] = True
        if square:
            for b in range(len(first) - 1):
                p = np.flatnonzero(met[first[b]:first[b + 1]]).astype(np.int32)
                if len(p):
                    yield part(b, p, total[first[b] + p])

    def part(b, p, m):
        return pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([p.tobytes()], pa.binary()),
                                           pa.array([np.ascontiguousarray(m).tobytes()], pa.binary())], ["b", "p", "m"])

    return _added(whole.mapInArrow(partial, "b int, p binary, m binary"), width, blocks), shared


def columns(x: DataFrame, width: int, a: int, z: int) -> DataFrame:
    """The columns a..z of dense blocks."""
    return mapped(x, lambda b, raw: dense(raw, width)[:, a:z])


def side_by_side(parts: list[DataFrame], widths: list[int], blocks: int) -> DataFrame:
    """(b, m): dense blocks of the same rows, their columns one after the other."""
    if len(parts) == 1:
        return parts[0]
    def join(batches):
        held, found = None, []
        for batch in batches:
            for b, at, m in zip(batch.column("b").to_pylist(), batch.column("at").to_pylist(), batch.column("m")):
                if b != held and found:
                    yield dense_row(held, np.hstack(found))
                    found = []
                held = b
                found.append(dense(m.as_py(), widths[at]))
        if found:
            yield dense_row(held, np.hstack(found))

    own = functools.reduce(DataFrame.unionByName, [p.select("b", F.lit(i).alias("at"), "m") for i, p in enumerate(parts)])
    return own.repartitionById(min(_tasks(own), blocks), F.col("b")).sortWithinPartitions("b", "at").mapInArrow(join, "b int, m binary")


def with_gram(x: DataFrame, f) -> DataFrame:
    """(b, m, g): the blocks ``f(row as a dict)``, written, and one partial Gram matrix of them per task (b null)."""
    names = x.columns

    def run(batches):
        g = None
        for batch in batches:
            for i in range(batch.num_rows):
                m = f({c: batch.column(c)[i].as_py() for c in names})
                g = m.T @ m if g is None else g + m.T @ m
                yield pa.RecordBatch.from_arrays([*dense_row(batch.column("b")[i].as_py(), m).columns, pa.array([None], pa.binary())], ["b", "m", "g"])
        if g is not None:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int32()), pa.array([None], pa.binary()), pa.array([g.tobytes()], pa.binary())], ["b", "m", "g"])

    return materialize(x.mapInArrow(run, "b int, m binary, g binary"))


def gram_of(written: DataFrame) -> np.ndarray:
    """The Gram matrix of a table of ``with_gram``; many partials are added up by tasks first."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"g": [sum(np.frombuffer(b) for b in pdf["g"]).tobytes()]})

    parts = written.where("g IS NOT NULL").select("g")
    if len(written.inputFiles()) > TREE_ABOVE:
        parts = parts.groupBy(F.pmod(F.spark_partition_id(), F.lit(16))).applyInPandas(add, "g binary")
    got = [np.frombuffer(r.g) for r in parts.collect()]
    if not got:
        return np.zeros((0, 0))
    n = int(round(len(got[0]) ** 0.5))
    return sum(got).reshape(n, n)


def blocks_of(written: DataFrame) -> DataFrame:
    return written.where("b IS NOT NULL").select("b", "m")


def unblocked(x: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, vec): the rows of dense blocks with their ids."""
    def run(batches):
        for batch in batches:
            for own, m in zip(batch.column("ids"), batch.column("m")):
                own, m = np.frombuffer(own.as_py(), np.int64), dense(m.as_py(), width)
                off = pa.array(np.arange(len(own) + 1) * width, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.ListArray.from_arrays(off, pa.array(m.ravel()))], ["id", "vec"])

    return materialize(x.join(ids, "b").select("ids", "m").mapInArrow(run, "id long, vec array<double>"))
