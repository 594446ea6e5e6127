"""SVD against NumPy, scoring against brute force, CSV round trip, codecs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import blocks
from rankforge.operators.factorize import gram, top_lists, top_scores, truncated_svd
from rankforge.plans.svd import SVD
from rankforge.sources import codec, io


def numpy_reference_svd(dense, k):
    u, s, vt = np.linalg.svd(dense, full_matrices=False)
    return u[:, :k], s[:k], vt[:k].T


@pytest.mark.parametrize("limits", [{}, {"PANEL_ENTRIES": 60, "BLOCK_IDS": 64}, {"PANEL_ENTRIES": 20}, {"BROADCAST_BYTES": 0, "BLOCK_IDS": 64}])
def test_truncated_svd_of_a_flat_spectrum(spark, monkeypatch, limits):
    # k + oversample far below the rank, singular values close together; whole rows, several blocks and panels of
    # them, rows too long for a panel, and a column side too large for a broadcast
    for name, value in limits.items():
        monkeypatch.setattr(blocks, name, value)
    rng = np.random.default_rng(3)
    dense = rng.normal(size=(400, 300)) * (rng.random((400, 300)) < 0.1)
    i, j = np.nonzero(dense)
    e = spark.createDataFrame([(int(a), int(b), float(dense[a, b])) for a, b in zip(i, j)], "row long, col long, val double")
    u, v, s, res = truncated_svd(e, 10, oversample=10)
    u_ref, s_ref, v_ref = numpy_reference_svd(dense, 10)
    assert np.abs(s / s_ref - 1).max() < 1e-10 and res.max() <= 1e-7
    assert np.abs(gram(u) - np.eye(10)).max() < 1e-9 and np.abs(gram(v) - np.eye(10)).max() < 1e-9
    V = np.zeros((300, 10))
    for r in v.collect():
        V[r["id"]] = r["vec"]
    assert np.abs(dense.T @ (dense @ V) - V * s ** 2).max() < 1e-5
    assert np.abs(np.abs((V * v_ref).sum(0)) - 1).max() < 1e-6


def test_truncated_svd_matches_numpy(spark):
    rng = np.random.default_rng(0)
    dense = rng.normal(size=(30, 20)) * (rng.random((30, 20)) < 0.4)
    rows = [(i, j, float(dense[i, j])) for i in range(30) for j in range(20) if dense[i, j] != 0]
    e = spark.createDataFrame(rows, "row long, col long, val double")
    u, v, s, _ = truncated_svd(e, 8, oversample=12)   # 20 directions span all columns: exact
    _, s_ref, _ = numpy_reference_svd(dense, 8)
    assert s == pytest.approx(s_ref, rel=1e-8)
    U = np.zeros((30, 8))
    V = np.zeros((20, 8))
    for r in u.collect():
        U[r["id"]] = r["vec"]
    for r in v.collect():
        V[r["id"]] = r["vec"]
    assert np.abs(U.T @ U - np.eye(8)).max() < 1e-8
    u_ref, s_ref, v_ref = numpy_reference_svd(dense, 8)
    assert np.abs(U @ np.diag(s) @ V.T - u_ref @ np.diag(s_ref) @ v_ref.T).max() < 1e-8


def test_top_scores_blocked_equals_brute(spark):
    rng = np.random.default_rng(1)
    nu, ni, k = 37, 53, 4
    uv, iv = rng.normal(size=(nu, k)), rng.normal(size=(ni, k))
    off, bias = rng.normal(size=nu), rng.normal(size=ni)
    users = spark.createDataFrame([(i, uv[i].tolist(), float(off[i]), 0) for i in range(nu)],
                                  "user_id long, vec array<double>, offset double, s long")
    items = spark.createDataFrame([(i, iv[i].tolist(), float(bias[i])) for i in range(ni)],
                                  "item_id long, vec array<double>, bias double")
    got = top_scores(users, items, 5, item_block=16, user_block=10)   # several blocks on each side
    best = {}
    for r in got.collect():
        best.setdefault(r["user_id"], []).append((r["score"], r["item_id"]))
    sc = uv @ iv.T + off[:, None] + bias[None, :]
    for u in range(nu):
        top = sorted(best[u], key=lambda t: (-round(t[0], 9), t[1]))[:5]
        exp = sorted(range(ni), key=lambda i: (-round(sc[u, i], 9), i))[:5]
        assert [i for _, i in top] == exp


def test_top_lists_score_few_cells_and_lose_nothing(spark):
    """Factors with decaying norms, as an SVD gives them: most blocks cannot beat a user's list; ties keep the smaller id."""
    rng = np.random.default_rng(7)
    nu, ni, k, keep = 60, 4000, 6, 5
    uv = rng.normal(size=(nu, k))
    iv = rng.normal(size=(ni, k)) / (1 + np.arange(ni) / 50)[:, None]
    iv[100:120] = iv[99]
    off, bias, seen = rng.normal(size=nu), rng.normal(size=ni) * 0.05, rng.integers(0, 4, nu)
    bias[100:120] = bias[99]
    users = spark.createDataFrame([(i, uv[i].tolist(), float(off[i]), int(seen[i])) for i in range(nu)],
                                  "user_id long, vec array<double>, offset double, s long").repartition(3)
    items = spark.createDataFrame([(i, iv[i].tolist(), float(bias[i])) for i in range(ni)], "item_id long, vec array<double>, bias double").repartition(4)
    lists = top_lists(users, items, keep, item_block=64, user_block=16).collect()
    sc = np.round(uv @ iv.T + off[:, None] + bias, 9)
    assert {r.user_id: r.ids for r in lists} == {u: sorted(range(ni), key=lambda i: (-sc[u, i], i))[:keep + seen[u]] for u in range(nu)}
    share = sum(r.cells for r in lists) / (nu * ni)
    print(f"share of user-item cells scored: {share:.3f}")
    assert share < 0.3
    assert top_lists(users.limit(0), items, keep) is None and top_lists(users, items.limit(0), keep) is None


def test_svd_model_unknown_ids(spark, hand):
    m = SVD(n_factors=2, oversample=3).fit(hand["interactions"], None, hand["items"])
    pairs = spark.createDataFrame([(1, 10), (-5, 10), (1, 12345)], "user_id long, item_id long")
    p = {(r["user_id"], r["item_id"]): r["score"] for r in m.predict(pairs).collect()}
    mu = m.mean.first()["mu"]
    assert p[(-5, 10)] == pytest.approx(mu) and p[(1, 12345)] == pytest.approx(mu)
    new = spark.createDataFrame([(-5,)], "user_id long")
    assert m.recommend(new, 3).count() == 0


def test_csv_round_trip(spark, hand, tmp_path):
    ints = hand["interactions"]
    path = str(tmp_path / "ints")
    io.write_table(codec.encode_interactions(ints), path, "csv")
    back = io.read_interactions_csv(spark, path)
    assert back.count() == ints.count()
    assert back.where(F.col("timestamp").isNull()).count() == 1     # the unparseable time


def test_parse_list(spark):
    df = spark.createDataFrame([("['a', 'b c']",), ("[]",), ("nonsense",), ('["x"]',)], "t string")
    got = [r[0] for r in df.select(codec.parse_list(F.col("t"))).collect()]
    assert got == [["a", "b c"], [], [], ["x"]]


def test_decode_rejects_unknown(spark, hand):
    ok, bad = codec.decode_interactions(hand["interactions"])
    assert [r["interaction_type"] for r in bad.collect()] == ["share"]
    assert ok.count() == 11
