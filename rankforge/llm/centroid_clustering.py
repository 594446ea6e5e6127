"""Exact k-means (Lloyd) over whole numbers, with heap-ordered bounds.

A kept vector has exactly ``dim`` components, none null or without a finite
value; component x counts as floor(scale * x).  The first centroids are the
``k`` vectors with the smallest SHA-256 of ``<seed>:<id>``.  Each round assigns
every vector to its nearest centroid (squared Euclidean distance; ties: the
smaller number), then moves every non-empty centroid to the floored mean of its
vectors.  After the last round the vectors are assigned once more.

1. Vectors are packed into blocks, one row of a written table each.  A block
   keeps, for each cluster, a heap of its vectors ordered by their gap: the
   distance to the second nearest centroid less the distance to their own, plus
   what the cluster has spent so far.
2. When centroids move, a gap shrinks at most by the drift of the own centroid
   plus the largest drift of another.  The driver adds that to what the cluster
   has spent (k numbers).  A task pops the vectors of a cluster whose gap is spent
   and scans only these against all centroids; the others cannot have changed.
   Gaps are kept a little too small, by more than the rounding of doubles, and an
   empty gap counts as spent, so ties are always scanned.
3. A task sends only the sums of the vectors that changed cluster, at most one
   row per cluster; added up in two steps, k rows reach the driver.
4. Every state is a written table that follows from the one before, so a lost
   executor repeats its blocks only; older states are deleted.

All distances and sums are exact: in doubles where every value stays under
2^53, in Python integers beyond.  Defined results: vectors that are not kept have
no row; with fewer than k kept vectors each is a first centroid; equal vectors and
repeated ids are rows of their own (ties of the hash go by the components, a null
id hashes as the empty text); an empty centroid stays; a distance or inertia that
no long can hold is given as 2^63 - 1; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import discard, stable

BLOCK = 2048                    # vectors of one block
EXACT = 1 << 22                 # whole components up to this have exact squared distances in doubles (up to 64 of them)
TOP = 1e140                     # components beyond are not finite once squared
LONG = (1 << 63) - 1
SLACK = 1e-12                   # far above the rounding of the few sums and roots in a gap


class Centroids:
    """Numbers 0 .. k - 1 with whole components, and what each cluster has spent."""

    def __init__(self, points: list[list[int]]):
        self.points, self.spent = points, [0.0] * len(points)

    def moved(self, sums: list[list[int]], counts: list[int]) -> Centroids:
        out = Centroids([[s // n for s in own] if n else old for own, n, old in zip(sums, counts, self.points)])
        drift = [math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))) * (1 + SLACK) for x, y in zip(out.points, self.points)]
        if len(drift) > 1:
            first, second = sorted(drift, reverse=True)[:2]
            out.spent = [s + d + (second if d == first else first) for s, d in zip(self.spent, drift)]
        return out

    def digest(self, cluster: int) -> str:
        return hashlib.sha256(",".join(map(str, self.points[cluster])).encode()).hexdigest()


def _kind(centroids: Centroids, vectors: np.ndarray):
    """doubles where they are exact, else Python integers."""
    top = max((abs(x) for p in centroids.points for x in p), default=0)
    return np.float64 if vectors.dtype == np.int32 and top <= EXACT and vectors.shape[1] <= 64 else object


def _as(kind, vectors: np.ndarray) -> np.ndarray:
    if kind is object and vectors.dtype == np.float64:
        return np.array([int(x) for x in vectors.reshape(-1).tolist()], object).reshape(vectors.shape)
    return vectors.astype(np.int64).astype(object) if kind is object else vectors.astype(kind)


def scan(vectors: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, gap to the second nearest) of each vector."""
    kind = _kind(centroids, vectors)
    v, c = _as(kind, vectors), np.array(centroids.points, kind)
    d = (v * v).sum(1)[:, None] - 2 * v.dot(c.T) + (c * c).sum(1)
    if kind is object:                                  # exact order first, then roots as doubles
        own = np.array([min(range(len(row)), key=row.__getitem__) for row in d.tolist()], np.int64)
        root = np.array([[math.sqrt(x) for x in row] for row in d.tolist()], np.float64).reshape(d.shape)
    else:
        own, root = d.argmin(1), np.sqrt(d)
    if d.shape[1] == 1:
        return own, np.full(len(v), np.inf)
    two = np.partition(root, 1, axis=1)[:, :2]
    return own, two[:, 1] - two[:, 0] - SLACK * (two[:, 1] + two[:, 0])


def distances(vectors: np.ndarray, own: np.ndarray, centroids: Centroids) -> list[int]:
    kind = _kind(centroids, vectors)
    gone = _as(kind, vectors) - np.array(centroids.points, kind)[own]
    return [min(int(d), LONG) for d in (gone * gone).sum(1).tolist()]


def pack(heaps: list[list[tuple[float, int]]]) -> bytes:
    size = np.array([len(h) for h in heaps], np.int32)
    flat = [e for h in heaps for e in h]
    return size.tobytes() + np.array([k for k, _ in flat], np.float64).tobytes() + np.array([m for _, m in flat], np.int32).tobytes()


def unpack(state: bytes, k: int) -> list[list[tuple[float, int]]]:
    size = np.frombuffer(state, np.int32, k)
    n = int(size.sum())
    flat = list(zip(np.frombuffer(state, np.float64, n, 4 * k).tolist(), np.frombuffer(state, np.int32, n, 4 * k + 8 * n).tolist()))
    return [flat[e - s:e] for s, e in zip(size.tolist(), np.cumsum(size).tolist())]


def spent_gaps(heaps: list[list[tuple[float, int]]], centroids: Centroids) -> tuple[list[int], list[int]]:
    """Pops the vectors whose gap their cluster has spent: (vectors, their clusters)."""
    members, clusters = [], []
    for c, heap in enumerate(heaps):
        limit = centroids.spent[c] * (1 + SLACK)
        while heap and heap[0][0] <= limit:
            members.append(heapq.heappop(heap)[1])
            clusters.append(c)
    return members, clusters


class Moves:
    """Sums and numbers of the vectors that a task has moved, by cluster."""

    def __init__(self, k: int):
        self.sums, self.counts = [None] * k, [0] * k

    def add(self, vectors: np.ndarray, old: np.ndarray, new: np.ndarray) -> None:
        whole = _as(object if vectors.dtype == np.float64 else np.int64, vectors)
        for cluster, sign in ((old, -1), (new, 1)):
            for c in np.unique(cluster[cluster >= 0]).tolist():
                own = whole[cluster == c]
                total = [sign * int(x) for x in own.sum(0)]
                self.sums[c] = total if self.sums[c] is None else [a + b for a, b in zip(self.sums[c], total)]
                self.counts[c] += sign * len(own)

    def rows(self) -> list[dict]:
        return [{"cluster": c, "n": n, "sums": list(map(str, s))} for c, (s, n) in enumerate(zip(self.sums, self.counts)) if s is not None]


def settle(heaps, vectors: np.ndarray, centroids: Centroids, members, clusters, moves: Moves | None) -> None:
    """Scans the popped vectors exactly and puts each in the heap of its cluster."""
    if not len(members):
        return
    at, old = np.asarray(members), np.asarray(clusters)
    own, gap = scan(vectors[at], centroids)
    for m, c, g in zip(at.tolist(), own.tolist(), gap.tolist()):
        heapq.heappush(heaps[c], (g + centroids.spent[c], m))
    if moves is not None:
        changed = own != old
        moves.add(vectors[at[changed]], old[changed], own[changed])


_MOVED = pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))]))
_STATE = "vectors binary, heaps binary, scanned long, moved array<struct<cluster:int,n:long,sums:array<string>>>"


def whole_numbers(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x): 32-bit integers where all are small, else whole doubles."""
    x = np.floor(np.asarray(column.flatten(), np.float64).reshape(-1, dim) * scale)
    return x.astype(np.int32) if not x.size or np.abs(x).max() <= EXACT else x


def _stored(x: np.ndarray) -> bytes:
    return (b"i" if x.dtype == np.int32 else b"d") + x.tobytes()


def _loaded(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.int32 if raw[:1] == b"i" else np.float64, offset=1).reshape(n, -1)


def _state_row(ids: pa.Array, raw: bytes | None, heaps: bytes | None, scanned: int, moved: list[dict]) -> pa.RecordBatch:
    held = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    return pa.RecordBatch.from_arrays([held, pa.array([raw], pa.binary()), pa.array([heaps], pa.binary()), pa.array([scanned], pa.int64()),
                                       pa.array([moved], _MOVED)], ["ids", "vectors", "heaps", "scanned", "moved"])


def _blocks(batches):
    """(ids, raw vectors, heaps) of the blocks in the batches of a state table."""
    for batch in batches:
        for i in range(batch.num_rows):
            raw = batch.column("vectors")[i].as_py()
            if raw is not None:
                yield batch.column("ids")[i].values, raw, batch.column("heaps")[i].as_py()


def first_state(kept: DataFrame, centroids: Centroids, dim: int, scale: int) -> DataFrame:
    k = len(centroids.points)

    def run(batches):
        moves, ids = Moves(k), None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids, x = part.column("id"), whole_numbers(part.column("embedding"), dim, scale)
                heaps = [[] for _ in range(k)]
                settle(heaps, x, centroids, range(len(x)), np.full(len(x), -1), moves)
                yield _state_row(ids, _stored(x), pack(heaps), len(x), [])
        if ids is not None:
            yield _state_row(ids.slice(0, 0), None, None, 0, moves.rows())

    kind = kept.schema["id"].dataType.simpleString()
    return stable(kept.mapInArrow(run, f"ids array<{kind}>, {_STATE}"))


def next_state(state: DataFrame, centroids: Centroids) -> DataFrame:
    k = len(centroids.points)

    def run(batches):
        moves, ids = Moves(k), None
        for ids, raw, held in _blocks(batches):
            heaps = unpack(held, k)
            members, clusters = spent_gaps(heaps, centroids)
            settle(heaps, _loaded(raw, len(ids)), centroids, members, clusters, moves)
            yield _state_row(ids, raw, pack(heaps), len(members), [])
        if ids is not None:
            yield _state_row(ids.slice(0, 0), None, None, 0, moves.rows())

    return stable(state.select("ids", "vectors", "heaps").mapInArrow(run, state.schema))


def assigned(state: DataFrame, centroids: Centroids) -> DataFrame:
    """(id, cluster, distance): the last assignment."""
    k = len(centroids.points)

    def run(batches):
        for ids, raw, held in _blocks(batches):
            heaps, x = unpack(held, k), _loaded(raw, len(ids))
            members, clusters = spent_gaps(heaps, centroids)
            settle(heaps, x, centroids, members, clusters, None)
            own = np.empty(len(x), np.int32)
            for c, heap in enumerate(heaps):
                own[[m for _, m in heap]] = c
            yield pa.RecordBatch.from_arrays([ids, pa.array(own), pa.array(distances(x, own, centroids), pa.int64())], ["id", "cluster", "distance"])

    kind = state.schema["ids"].dataType.elementType.simpleString()
    return state.select("ids", "vectors", "heaps").mapInArrow(run, f"id {kind}, cluster int, distance long")


def _add_moves(state: DataFrame, sums: list[list[int]], counts: list[int]) -> None:
    """Adds the moves of a state to the sums and counts of the clusters: at most k rows, in two steps of tasks."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = [str(sum(map(int, own))) for own in zip(*pdf["sums"])]
        return pd.DataFrame({"cluster": [pdf["cluster"].iloc[0]], "n": [int(pdf["n"].sum())], "sums": [total]})

    kind = "cluster int, n long, sums array<string>"
    rows = state.select(F.explode("moved").alias("m"), F.spark_partition_id().alias("task")).select("m.*", (F.col("task") % 61).alias("salt"))
    some = rows.groupBy("cluster", "salt").applyInPandas(add, kind)
    for r in some.groupBy("cluster").applyInPandas(add, kind).collect():
        counts[r.cluster] += r.n
        sums[r.cluster] = [a + int(b) for a, b in zip(sums[r.cluster], r.sums)]


def kept_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, embedding as doubles) of the vectors with ``dim`` finite components."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(TOP / scale), F.lit(False)))
    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("embedding")) \
        .where((F.size("embedding") == dim) & finite)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Centroids, list[int]]:
    """((id, cluster, distance) as a written table, final centroids, number of vectors scanned in each round)."""
    kept = kept_vectors(vectors, dim, scale, id_col, vector_col)
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = kept.select(F.sha2(text.cast("binary"), 256).alias("h"), "embedding").orderBy("h", "embedding").limit(k).collect()
    centroids = Centroids([[math.floor(x * scale) for x in r.embedding] for r in first])
    n = len(centroids.points)
    if not n:
        return kept.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), centroids, []
    sums, counts, scanned = [[0] * dim for _ in range(n)], [0] * n, []
    state = first_state(kept, centroids, dim, scale)
    for done in range(rounds):
        if done:
            before, state = state, next_state(state, centroids)
            discard(before)
        _add_moves(state, sums, counts)
        scanned.append(state.agg(F.sum("scanned")).first()[0])
        centroids = centroids.moved(sums, counts)
    out = stable(assigned(state, centroids))
    discard(state)
    return out, centroids, scanned


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """One row per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    rows, centroids, _ = cluster(vectors, **options)
    own = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("total")).collect()      # at most k rows
    every = min(LONG, sum(int(r.total) for r in own))
    names = [(r.cluster, min(LONG, int(r.total)), every, centroids.digest(r.cluster)) for r in own]
    table = rows.sparkSession.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
