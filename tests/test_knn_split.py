"""Neighbour lists without a pair table, and the chronological cut, against brute force."""
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import similarity as S
from rankforge.operators.split import chronological_split, labelled_chronological


def brute_neighbors(rows, k):
    vec = {}
    for key, i, w in rows:
        vec.setdefault(i, {})[key] = w
    norm = {i: np.sqrt(float(sum(w * w for w in v.values()))) for i, v in vec.items()}
    out = {}
    for a in vec:
        sims = []
        for b in vec:
            dot = float(sum(w * vec[b].get(key, 0) for key, w in vec[a].items())) if a != b else 0
            if dot > 0:
                sims.append((-round(dot / (norm[a] * norm[b]), 9), b))
        out[a] = [b for _, b in sorted(sims)[:k]]
    return {a: b for a, b in out.items() if b}


@pytest.mark.parametrize("ids,entries,heavy,k", [(1024, 200_000, 10**6, 5), (8, 60, 10**6, 5), (8, 60, 20, 5), (4, 40, 3, 50), (8, 60, 0, 2)])
def test_top_neighbors(spark, monkeypatch, ids, entries, heavy, k):
    """One block, many blocks, ids too heavy for a block, and all ids heavy."""
    monkeypatch.setattr(S, "BLOCK_IDS", ids)
    monkeypatch.setattr(S, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(S, "CELLS", 37)
    rnd = random.Random(ids + heavy)
    cells = {(rnd.randint(0, 30), rnd.randint(100, 160)) for _ in range(700)} | {(u, 100) for u in range(31)} | {(99, 999)}
    rows = [(u, i, float(rnd.choice([1, 2, 4, 5]))) for u, i in sorted(cells)]
    rows += [(u, 500, 2.0) for u in range(5)] + [(u, 501, 2.0) for u in range(5)] + [(u, 499, 4.0) for u in range(5)]     # equal similarities
    m = spark.createDataFrame(rows, "u long, i long, w double").repartition(3)
    got = {}
    for r in S.top_neighbors(m, "u", "i", k, heavy=heavy).orderBy("id_a", "rank").collect():
        got.setdefault(r.id_a, []).append(r.id_b)
        assert r.rank == len(got[r.id_a]) and r.sim > 0
    assert got == brute_neighbors(rows, k)


def test_bound_spares_products():
    """Once a list is full, an id with little on the other block's keys is left out."""
    def block(ids, rows):
        key, at, w = (np.array(x) for x in zip(*sorted(rows)))
        norm = np.bincount(at, w ** 2, minlength=len(ids)).astype(float)
        return S._Block(np.array(ids, np.int64).tobytes(), norm.tobytes(), key.astype(np.int64).tobytes(), at.astype(np.int32).tobytes(), w.astype(float).tobytes())
    own = block([1], [(1, 0, 5.0), (2, 0, 5.0), (3, 0, 1.0)])
    found = S._Lists(own, 1)
    found.meet(block([2], [(1, 0, 5.0), (2, 0, 5.0)]))
    done = found.multiplied
    found.meet(block([3], [(3, 0, 9.0)]))               # at most 1 / sqrt(51)
    assert found.multiplied == done == 2 and found.id.tolist() == [2]


def test_empty_matrix(spark):
    none = spark.createDataFrame([], "u long, i long, w double")
    assert S.top_neighbors(none, "u", "i", 3).count() == 0


def communities(spark, n):
    rnd = random.Random(5)
    rows = [(g * 100 + u, g * 100 + rnd.randint(0, 30), 1.0) for g in range(n) for u in range(20) for _ in range(6)]
    return spark.createDataFrame(sorted(set(rows)), "key long, id long, w double")


def dealt_entries(m, ids):
    entries = m.join(m.groupBy("id").agg(F.sum(F.col("w") * F.col("w")).alias("nsq")), "id").withColumn("blk", F.floor(F.col("id") / ids).cast("int"))
    rows, _ = S._dealt(entries)
    return rows.where("ord >= 0").select(F.sum(F.size("ids")), F.max(F.size("ids"))).first()


def test_blocks_get_the_entries_on_their_keys(spark, monkeypatch):
    """Blocks without a common key never meet, and no shuffled row is long however many ids a key has."""
    monkeypatch.setattr(S, "ROW_ENTRIES", 7)
    one, eight = (dealt_entries(communities(spark, n), 50)[0] for n in (1, 8))
    assert eight <= 8.8 * one                     # the matrix times the blocks would be 64 times as much
    total, longest = dealt_entries(spark.range(500).select(F.lit(1).cast("long").alias("key"), "id", F.lit(1.0).alias("w")), 100)
    assert total == 500 * 5 and longest == 7


def test_slices(spark, monkeypatch):
    """Lists are the same when a block meets many slices of short rows."""
    m = communities(spark, 2).unionByName(spark.range(200).select(F.lit(7).cast("long").alias("key"), "id", F.lit(2.0).alias("w"))) \
        .groupBy("key", "id").agg(F.sum("w").alias("w"))
    rows = [tuple(r) for r in m.select("key", "id", "w").collect()]
    for name, v in (("BLOCK_IDS", 8), ("BLOCK_ENTRIES", 60), ("SLICE_BLOCKS", 2), ("ROW_ENTRIES", 3), ("CELLS", 11)):
        monkeypatch.setattr(S, name, v)
    got = {}
    for r in S.top_neighbors(m, "key", "id", 4).orderBy("id_a", "rank").collect():
        got.setdefault(r.id_a, []).append(r.id_b)
    assert got == brute_neighbors(rows, 4)


def test_a_block_and_a_slice_stay_small():
    """Beside its rows of 38 MB, a full slice takes about 70 MB to sort and to multiply."""
    def part(rnd, keys, ids, first):
        key, own = np.arange(keys), np.full(keys, ids * 400 // keys)
        i = np.concatenate([first + rnd.choice(ids, n, replace=False) for n in own])
        return [key, own, i, np.ones(len(i)), np.full(len(i), 400.0)]

    rnd = np.random.default_rng(2)
    mine, slices = part(rnd, 10_000, 250, 0), part(rnd, 10_000, 4000, 250)
    lists = S._Lists(S._block([mine]), 5)
    parts = [slices]
    del slices
    tracemalloc.start()
    lists.meet(S._block(parts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 85e6


@pytest.mark.parametrize("ratio", [0.0, 0.2, 0.5, 0.999, 1.0])
def test_chronological_cut(spark, ratio):
    rnd = random.Random(3)
    rows = [(f"2024-01-{rnd.randint(1, 6):02d} {rnd.randint(0, 2):02d}:00:00" if rnd.random() < 0.9 else None,
             rnd.choice([1, 2, None]), rnd.randint(1, 3), "x") for _ in range(300)]
    rows += [("2024-01-03 01:00:00", 1, 1, "x")] * 40             # equal rows around the cut
    df = spark.createDataFrame(rows, "t string, user_id long, item_id long, note string").select(
        F.to_timestamp("t").cast("timestamp_ntz").alias("ts"), "user_id", "item_id", "note").repartition(4)

    def key(r):
        return tuple((x is None, x if x is not None else 0) for x in r)
    order = sorted(((r.ts, r.user_id, r.item_id, r.note) for r in df.collect()), key=key)
    cut = int(len(order) * (1 - ratio))
    train, test = chronological_split(df, ratio)
    assert sorted((tuple(r) for r in train.collect()), key=key) == order[:cut]
    assert sorted((tuple(r) for r in test.collect()), key=key) == order[cut:]


def test_split_plan_has_no_range_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("user_id"), F.col("id").alias("item_id"),
                                  F.timestamp_seconds(F.col("id") * 9000).cast("timestamp_ntz").alias("ts"))
    plan = labelled_chronological(df)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan
    assert labelled_chronological(df.limit(0)).count() == 0
