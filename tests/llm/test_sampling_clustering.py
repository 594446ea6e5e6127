"""Centroid clustering and importance resampling against brute force."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


# ---- op11

def brute_clusters(rows, k, rounds, scale=256):
    """(id, cluster, distance) of kept rows with Python integers, all pairs."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[math.floor(scale * x) for x in v] for _, v in kept]
    first = sorted(range(len(kept)), key=lambda j: (hashlib.sha256(f"2:{'' if kept[j][0] is None else kept[j][0]}".encode()).hexdigest(), kept[j][1]))
    cent = [whole[j] for j in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cent))
    for _ in range(rounds):
        own = [nearest(v)[1] for v in whole]
        for c in range(len(cent)):
            mine = [v for v, o in zip(whole, own) if o == c]
            if mine:
                cent[c] = [sum(x) // len(mine) for x in zip(*mine)]
    best = [nearest(v) for v in whole]
    out = []
    for (i, _), (d, c) in zip(kept, best):
        top = (1 << 63) - 1
        out.append((i, c, min(d, top), min(sum(min(x, top) for x, y in best if y == c), top), min(sum(min(x, top) for x, _ in best), top),
                    hashlib.sha256(",".join(map(str, cent[c])).encode()).hexdigest()))
    return sorted(out, key=str)


def vectors_of(kind, seed):
    rnd = random.Random(seed)
    if kind == "ties":                  # few distinct values: many equal distances
        return [(i, [float(rnd.randint(0, 2)) / 256 for _ in range(4)]) for i in range(200)]
    if kind == "blobs":
        mid = [[rnd.uniform(-1, 1) for _ in range(4)] for _ in range(6)]
        return [(i, [x + rnd.gauss(0, .05) for x in rnd.choice(mid)]) for i in range(400)]
    if kind == "huge":                  # sums and squares beyond doubles and longs
        return [(i, [rnd.choice([1e30, -3e37, 5e3, 1.0]) * rnd.random() for _ in range(4)]) for i in range(60)]
    if kind == "few":
        return [(i, [float(i), 0.0, 0.0, 1.0]) for i in range(3)]
    good = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(50)]
    bad = [(100, None), (101, []), (102, [1.0, 2.0, 3.0]), (103, [1.0, None, 2.0, 3.0]), (104, [float("nan")] * 4),
           (105, [float("inf"), 0.0, 0.0, 0.0]), (106, [0.0] * 5)]
    return good + bad + [(None, [0.5] * 4), (7, good[7][1]), (7, good[9][1]), (None, [0.25] * 4)]


@pytest.mark.parametrize("kind,k,rounds", [("ties", 9, 5), ("blobs", 7, 6), ("huge", 5, 3), ("few", 40, 2), ("odd", 6, 5), ("odd", 1, 2), ("blobs", 5, 0)])
def test_clusters_match_brute_force(spark, monkeypatch, kind, k, rounds):
    from rankforge.llm import centroid_clustering as C
    monkeypatch.setattr(C, "BLOCK", 16)
    rows = vectors_of(kind, 3)
    df = spark.createDataFrame([(*r, 1, 2.0, b"") for r in rows], "vec_id long, embedding array<double>, cluster int, distance double, heaps binary").repartition(3)
    got = C.clusters(df, k=k, rounds=rounds, dim=4)
    assert got.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows, k, rounds)
    if kind == "odd":
        assert C.clusters(df.limit(0), k=k, rounds=rounds, dim=4).count() == 0
        assert C.clusters(df.where("vec_id between 100 and 106"), k=k, rounds=rounds, dim=4).count() == 0


def test_heaps_spare_most_scans(spark):
    """All vectors are scanned in the first round only."""
    from rankforge.llm import centroid_clustering as C
    rows = vectors_of("blobs", 5) * 10
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    _, _, scanned = C.cluster(df, k=6, rounds=8, dim=4)
    assert scanned[0] == len(rows) and scanned[-1] < len(rows) // 3


def test_heap_state_round_trip():
    from rankforge.llm.centroid_clustering import Centroids, pack, spent_gaps, unpack
    heaps = [[(0.5, 1), (2.0, 0)], [], [(1.0, 2)]]
    assert unpack(pack(heaps), 3) == heaps
    c = Centroids([[0], [1], [2]])
    c.spent = [0.6, 9.0, 0.9]
    assert spent_gaps(heaps, c) == ([1], [0]) and heaps == [[(2.0, 0)], [], [(1.0, 2)]]


# ---- op12

def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranks(rows, target, percent=25, min_words=20, grams=2, buckets=10_000, seed=7):
    def found(text):
        w = brute_words(text)
        return [zlib.crc32(" ".join(w[i:i + g + 1]).encode()) % buckets for g in range(grams) for i in range(len(w) - g)]
    docs, bench = [found(t) for _, t in rows], [found(t) for t in target]
    s, t = (collections.Counter(x for f in side for x in f) for side in (docs, bench))
    S, T = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * S / ((s[b] + 1.0) * T))) for b in range(buckets)}
    out = []
    for (i, text), f in zip(rows, docs):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(brute_words(text))])
    order = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(order[:len(order) * percent // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_position_table_crc():
    from rankforge.llm.importance_resampling import long_crc, past_zeros, span_crcs
    rnd = np.random.default_rng(1)
    data = rnd.integers(0, 256, 3_000_000).astype(np.uint8)
    size = np.array([1, 2, 3, 127, 128, 129, 255, 256, 257, 4096, 100_000, 1_000_001, 2_100_000])
    start = rnd.integers(0, len(data) - size)
    assert span_crcs(data, start, size).tolist() == [zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(start, size)]
    many = rnd.integers(0, 2_000_000, 50_000), rnd.integers(1, 200, 50_000)              # overlapping spans over several chunks
    assert span_crcs(data, *many).tolist() == [zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(*many)]
    assert long_crc(data[:0]) == zlib.crc32(b"") and past_zeros(0, 1 << 35) == 0
    assert span_crcs(data, many[0][:0], many[1][:0]).tolist() == []


def test_features_of_odd_texts():
    from rankforge.llm.importance_resampling import features
    texts = ["Hello World é ab-c", "", None, "a" * 300 + " b " + "ß" * 200, "x", "x", "Yy`Zz {12} [] ", "日本 語 Ü", "\x00a\x7fb", "end"]
    for column in (pa.array(texts), pa.array(texts).slice(2, 6), pa.chunked_array([texts[:1], texts[1:]]).combine_chunks(), pa.array([], pa.string())):
        found, words = features(column, 3, 997)
        for i, t in enumerate(column.to_pylist()):
            w = brute_words(t)
            assert words[i] == len(w)
            for g, (text, bucket) in enumerate(found):
                assert bucket[text == i].tolist() == [zlib.crc32(" ".join(w[k:k + g + 1]).encode()) % 997 for k in range(len(w) - g)]


def test_importance_ranks(spark, odd_docs):
    from rankforge.llm.importance_resampling import importance_ranks, resample
    rnd = random.Random(4)
    vocab = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(rnd.choices(vocab[:30] if i % 3 else vocab, k=rnd.randint(0, 60)))) for i in range(300)]
    rows += [(None, rows[5][1] + " more words"), (9, rows[9][1]), (9, rows[9][1]), (400, "y" * 5000 + " z" * 40)]
    target = [" ".join(rnd.choices(vocab[40:], k=30)) for _ in range(20)] + [None, ""]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, score int, rank int").repartition(5)
    bench = spark.createDataFrame([(t, 3) for t in target], "text string, bucket int")
    for options in ({}, {"percent": 100, "min_words": 1, "grams": 1, "buckets": 64, "seed": 3}):
        got = importance_ranks(docs, bench, **options)
        assert sorted((tuple(r) for r in got.select("id", "n_features", "weight", "score", "rank").collect()), key=str) == brute_ranks(rows, target, **options)
    drawn = {r[0] for r in brute_ranks(rows, target) if r[4]}
    kept = resample(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == drawn
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for side, texts in ((bench, target), (bench.limit(0), [])):
        got = importance_ranks(odd_docs, side, percent=50)
        assert sorted((tuple(r) for r in got.select("id", "n_features", "weight", "score", "rank").collect()), key=str) == brute_ranks(odd, texts, percent=50)
    assert importance_ranks(odd_docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_importance_resampling"])
def test_query_matches_sql(spark, name):
    from rankforge.llm.queries import ORACLE, QUERIES
    ok, said, _, _ = compare(name, QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert ok, said
