"""Models against brute force on the hand set and on fixture L at sf0.001."""

import pytest
from pyspark.sql import functions as F

import brute
from helpers import SF_SMALL, rows

from rankforge.plans.hybrid import Hybrid
from rankforge.plans.knn import ItemCF, UserCF
from rankforge.plans.popularity import Popularity
from rankforge.sources import fixtures as fx


def _lists(df):
    out = {}
    for r in df.orderBy("user_id", "rank").collect():
        out.setdefault(r["user_id"], []).append((r["item_id"], r["score"]))
    return out


def _same(a, b):
    assert set(a) == set(b)
    for u in a:
        assert [i for i, _ in a[u]] == [i for i, _ in b[u]], u
        for (_, x), (_, y) in zip(a[u], b[u]):
            assert x == pytest.approx(y, rel=1e-9, abs=1e-12)


def test_popularity_hand(spark, hand):
    ints = hand["interactions"]
    m = Popularity(hand["as_of"]).fit(ints, hand["users"], hand["items"])
    got = {r["item_id"]: r["score"] for r in m.item_scores.collect()}
    exp = brute.popularity(ints.collect(), hand["as_of"])
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12)
    assert max(got.values()) == 1.0           # max-normalised
    assert got[30] == got[40]                 # the tie
    recs = m.recommend(hand["users"], 3)
    seen = {(r["user_id"], r["item_id"]) for r in ints.collect()}
    for r in recs.collect():
        assert (r["user_id"], r["item_id"]) not in seen
    # ranks are 1..m without gaps, ties broken by item id
    for u, lst in _lists(recs).items():
        assert len(lst) == min(3, 6 - len({i for (uu, i) in seen if uu == u}))
    trending = [r["item_id"] for r in m.trending(5).orderBy("rank").collect()]
    assert trending == [i for i, _ in brute.ordered(exp, 5)]
    assert trending.index(30) < trending.index(40)


def test_popularity_category_fallback(spark, hand):
    m = Popularity(hand["as_of"]).fit(hand["interactions"], None, hand["items"])
    in_b = [r["item_id"] for r in m.trending(5, "B").collect()]
    assert set(in_b) <= {30, 40, 50}
    unknown = [r["item_id"] for r in m.trending(5, "nope").orderBy("rank").collect()]
    assert unknown == [r["item_id"] for r in m.trending(5).orderBy("rank").collect()]


def test_popularity_rank_ties(spark, hand):
    m = Popularity(hand["as_of"]).fit(hand["interactions"], None, hand["items"])
    pr = {r["item_id"]: r["popularity_rank"] for r in m.popularity_rank(hand["items"]).collect()}
    assert pr[30] == pr[40]
    assert pr[20] == 1


@pytest.mark.parametrize("k", [2, 3])
def test_knn_hand(spark, hand, k):
    ints = hand["interactions"]
    m = brute.matrix(ints.collect())
    users = [1, 2, 3, 4, 9, -999]
    udf = spark.createDataFrame([(u,) for u in users], "user_id long")
    _same(_lists(ItemCF(k_neighbors=k).fit(ints).recommend(udf, 3)), {u: v for u, v in
          brute.item_cf(m, k, users, 3).items() if v})
    _same(_lists(UserCF(k_neighbors=k).fit(ints).recommend(udf, 3)), {u: v for u, v in
          brute.user_cf(m, k, users, 3).items() if v})


def test_similarity_properties(spark):
    ints = fx.interactions_l(spark, SF_SMALL)
    m = ItemCF(k_neighbors=5).fit(ints)
    s = m.similarity
    assert s.where((F.col("sim") <= 0) | (F.col("sim") > 1 + 1e-12)).count() == 0
    asym = s.alias("a").join(s.alias("b"), (F.col("a.item_id") == F.col("b.other_item_id"))
                             & (F.col("a.other_item_id") == F.col("b.item_id")), "left_anti")
    assert asym.count() == 0
    assert s.where(F.col("item_id") == F.col("other_item_id")).count() == 0


def test_knn_against_brute_force_sf0001(spark):
    ints = fx.interactions_l(spark, SF_SMALL)
    m = brute.matrix(ints.collect())
    users = sorted({u for u, _ in m})[:40]
    udf = spark.createDataFrame([(u,) for u in users], "user_id long")
    _same(_lists(ItemCF(k_neighbors=20).fit(ints).recommend(udf, 10)),
          {u: v for u, v in brute.item_cf(m, 20, users, 10).items() if v})


def test_hybrid_cold_and_new_user(spark, hand):
    h = Hybrid(hand["as_of"], cold_start_threshold=3, collaborative=("item_cf",), item_cf_k=3).fit(
        hand["interactions"], None, hand["items"])
    new = spark.createDataFrame([(-999,)], "user_id long")
    r = h.recommend(new, 3).orderBy("rank").collect()
    pop = Popularity(hand["as_of"]).fit(hand["interactions"]).recommend(new, 6).orderBy("rank").collect()
    # a new user: popularity only, normalised by its own max, weight 0.4
    assert [x["item_id"] for x in r] == [x["item_id"] for x in pop][:3]
    assert r[0]["score"] == pytest.approx(0.4)
    flags = h.with_cold_flag(hand["users"]).collect()
    assert {x["user_id"]: x["is_cold"] for x in flags} == {1: False, 2: False, 3: False, 4: True}
    assert h.weights == pytest.approx((0.5, 0.3, 0.2))


def test_hybrid_weights_normalised():
    h = Hybrid("2024-01-01 00:00:00", 2, 1, 1)
    assert h.weights == pytest.approx((0.5, 0.25, 0.25))


def test_knn_with_every_key_salted(spark, hand):
    """Hot-key salting must not change results: force a chunk of 2 rows so every key splits."""
    ints = hand["interactions"]
    m = brute.matrix(ints.collect())
    users = [1, 2, 3, 4, 9]
    udf = spark.createDataFrame([(u,) for u in users], "user_id long")
    spark.conf.set("rankforge.skew.chunkRows", "2")
    try:
        _same(_lists(ItemCF(k_neighbors=3).fit(ints).recommend(udf, 3)),
              {u: v for u, v in brute.item_cf(m, 3, users, 3).items() if v})
        _same(_lists(UserCF(k_neighbors=3).fit(ints).recommend(udf, 3)),
              {u: v for u, v in brute.user_cf(m, 3, users, 3).items() if v})
    finally:
        spark.conf.unset("rankforge.skew.chunkRows")
