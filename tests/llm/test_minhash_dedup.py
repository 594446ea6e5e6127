"""SuperMinHash near duplicates against a plain signature, brute force and SQL."""
import random

import numpy as np
import pytest

from oracle_check import compare, duck
from test_matching_operators import brute_components

SF = "/root/testdata/sf0.01"


def plain_signature(keys, values):
    """One shingle after the other, each with its whole permutation, without an early stop."""
    from rankforge.llm.minhash_dedup import _offers
    best = [None] * values
    for key in keys:
        order = list(range(values))
        for level in range(values):
            offer, pick = _offers(np.array([key], np.uint64), level, values)
            k = int(pick[0])
            order[level], order[k] = order[k], order[level]
            slot = order[level]
            best[slot] = int(offer[0]) if best[slot] is None else min(best[slot], int(offer[0]))
    return best


@pytest.mark.parametrize("values", [16, 64])
def test_signatures_equal_the_plain_walk(monkeypatch, values):
    from rankforge.llm import minhash_dedup as M
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 2, 3, 0, 20, 300, 1, 150)]
    want = [plain_signature(s, values) if len(s) else [int(M.UNMET)] * values for s in sets]
    for chunk in (1 << 16, 64, 7):                    # several documents together, and parts of one
        monkeypatch.setattr(M, "CHUNK", chunk)
        assert M.signatures(sets, values).tolist() == want
    assert M.signatures([], values).shape == (0, values)


def test_estimates_are_close_and_vary_less_than_independent_hashes():
    from rankforge.llm.minhash_dedup import signatures
    rnd = np.random.default_rng(1)
    got = []
    for _ in range(200):
        keys = rnd.integers(0, 1 << 63, 30).astype(np.uint64)
        one, two = np.sort(keys[:25]), np.sort(keys[5:])         # similarity 20 / 30
        a, b = signatures([one, two], 128)
        got.append((a == b).mean())
    s = 20 / 30
    assert abs(np.mean(got) - s) < 0.01 and np.var(got) < 0.8 * s * (1 - s) / 128


def family(rnd, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 99)}"
    return " ".join(w)


@pytest.mark.parametrize("words,percent,block", [(2, 80, 512), (2, 80, 5), (5, 80, 512)])
def test_near_duplicates(spark, odd_docs, monkeypatch, words, percent, block):
    from rankforge.llm import jaccard_join
    from rankforge.llm.minhash_dedup import keep_one, near_duplicates
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rnd = random.Random(block + words)
    base = [[f"w{rnd.randint(0, 3000)}" for _ in range(70)] for _ in range(4)]
    rows = [(k, family(rnd, rnd.choice(base), rnd.randint(0, 9))) for k in range(150)]      # links, near misses, chains
    rows += [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  b"), (1004, "a"), (1005, rows[0][1].upper()), (1004, "a"), (None, "own text"), (None, "a b")]
    docs = spark.createDataFrame([(*r, 1, b"", 2) for r in rows], "doc_id long, text string, n int, sketch binary, label int").repartition(5)
    got = near_duplicates(docs, words, percent)
    assert got.columns == ["id", "n_shingles", "component_id", "kept"]
    got = got.collect()
    want = brute_components(rows, words, percent)
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.id == r.component_id) for r in got)
    kept = keep_one(docs, words, percent)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id for r in kept.collect())), key=str) == sorted({c for _, _, c in want}, key=str)
    if words == 2 and block == 512:
        odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
        assert sorted(((r.id, r.n_shingles, r.component_id) for r in near_duplicates(odd_docs, 2).collect()), key=str) == brute_components(odd, 2, 80)
        assert near_duplicates(odd_docs.limit(0)).count() == keep_one(odd_docs.limit(0)).count() == 0


def test_forest_keeps_components(spark, monkeypatch):
    from rankforge.llm import minhash_dedup as M
    from rankforge.llm.jaccard_join import components
    monkeypatch.setattr(M, "FOREST", 10)               # tasks send their trees on before they end
    rnd = random.Random(2)
    edges = [(a, rnd.choice(range(a - a % 20, a - a % 20 + 20))) for a in range(200) for _ in range(2)]
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    want = {(r.v, r.label) for r in components(df).collect()}
    assert {(r.v, r.label) for r in components(M.forest(df)).collect()} == want
    assert M.forest(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op13_minhash_dedup", "op3_jaccard_join"])
def test_query_matches_sql(spark, name):
    from rankforge.llm.queries import ORACLE, QUERIES
    ok, said, _, _ = compare(name, QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert ok, said
