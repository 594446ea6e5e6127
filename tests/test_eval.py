"""Splits and ranking metrics against direct Python on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from helpers import SF_SMALL

from rankforge.operators import split as SP
from rankforge.operators.features import item_content_vectors
from rankforge.plans import evaluate as EV
from rankforge.sources import fixtures as fx


def test_chronological_split_properties(spark):
    ints = fx.interactions_l(spark, SF_SMALL)
    n = ints.count()
    train, test = SP.chronological_split(ints, 0.2)
    assert train.count() == int(n * 0.8)
    assert train.count() + test.count() == n
    assert train.agg(F.max("ts")).first()[0] <= test.agg(F.min("ts")).first()[0]
    both = train.unionByName(test).groupBy(*ints.columns).count()
    orig = ints.groupBy(*ints.columns).count()
    assert both.exceptAll(orig).count() == 0 and orig.exceptAll(both).count() == 0


def test_random_split_repeatable(spark):
    ints = fx.interactions_l(spark, SF_SMALL)
    a, _ = SP.random_split(ints, 0.2, 7)
    b, _ = SP.random_split(ints.repartition(7), 0.2, 7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    frac = a.count() / ints.count()
    assert 0.7 < frac < 0.9


def test_metrics_against_python(spark):
    rnd = random.Random(3)
    recs, rel = [], []
    lists, truth = {}, {}
    for u in range(30):
        items = rnd.sample(range(40), 10)
        lists[u] = items
        truth[u] = set(rnd.sample(range(40), rnd.randint(0, 6)))
        recs += [(u, it, r + 1) for r, it in enumerate(items)]
        rel += [(u, it) for it in truth[u]]
    rdf = spark.createDataFrame(recs, "user_id long, item_id long, rank int")
    tdf = spark.createDataFrame(rel, "user_id long, item_id long")
    got = {r["user_id"]: r.asDict() for r in EV.per_user_metrics(rdf, tdf).collect()}
    for u in lists:
        exp = brute.user_metrics(lists[u], truth[u])
        for k, v in exp.items():
            assert got[u][k] == pytest.approx(v, abs=1e-12), (u, k)
            assert 0.0 <= got[u][k] <= 1.0


def test_diversity_identity_matches_pairs(spark):
    items = fx.items_l(spark, SF_SMALL)
    vec = item_content_vectors(items)
    v = {}
    for r in vec.collect():
        v.setdefault(r["item_id"], {})[r["feature"]] = r["w"]
    ids = sorted(v)[:12] + [10 ** 9]          # one item without a vector is skipped
    rdf = spark.createDataFrame([(1, i, k + 1) for k, i in enumerate(ids)], "user_id long, item_id long, rank int")
    got = EV.list_diversity(rdf, vec).first()["diversity"]
    have = [i for i in ids if i in v]
    tot, n = 0.0, 0
    for a in range(len(have)):
        for b in range(a + 1, len(have)):
            cos = sum(w * v[have[b]].get(f, 0.0) for f, w in v[have[a]].items())
            tot += 1 - cos
            n += 1
    assert got == pytest.approx(tot / n, abs=1e-12)


def test_catalog_is_not_broadcast(spark):
    """Vectors and shares, as large as the catalog, are shuffled; hot items change no result."""
    rdf = spark.createDataFrame([(u, i, i) for u in range(40) for i in (1, 2, 3, u + 10)], "user_id long, item_id long, rank int")
    vec = spark.createDataFrame([(i, f"c:{i % 3}", 0.6) for i in range(60)] + [(i, f"t:{i % 2}", 0.8) for i in range(60)],
                                "item_id long, feature string, w double")
    share = spark.createDataFrame([(i, 0.01) for i in range(60)], "item_id long, share double")
    plain = EV.list_diversity(rdf, vec)
    for df in (plain, EV.list_novelty(rdf, share)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("rankforge.skew.chunkRows", "4")
    try:
        salted = EV.list_diversity(rdf, vec)
        assert {r.user_id: round(r.diversity, 12) for r in salted.collect()} == {r.user_id: round(r.diversity, 12) for r in plain.collect()}
    finally:
        spark.conf.unset("rankforge.skew.chunkRows")


def test_coverage_and_novelty(spark):
    rdf = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 2, 1)], "user_id long, item_id long, rank int")
    items = spark.createDataFrame([(i,) for i in range(1, 5)], "item_id long")
    assert EV.catalog_coverage(rdf, items).first()["coverage"] == 0.5
    share = spark.createDataFrame([(1, 0.5)], "item_id long, share double")
    nov = {r["user_id"]: r["novelty"] for r in EV.list_novelty(rdf, share).collect()}
    import math
    assert nov[2] == pytest.approx(-math.log2(1e-10 + 1e-10))
    assert nov[1] == pytest.approx((-math.log2(0.5 + 1e-10) - math.log2(2e-10)) / 2)


def test_new_user_fits_read_one_table(spark, monkeypatch):
    """The join that makes the interactions runs once for all fits of new_user_recs."""
    from rankforge.plans.popularity import Popularity
    from rankforge.registry.hybrid_queries import new_user_recs
    plans, fit = [], Popularity.fit

    def seen(self, interactions, *rest):
        plans.append(interactions._jdf.queryExecution().optimizedPlan().toString())
        return fit(self, interactions, *rest)
    monkeypatch.setattr(Popularity, "fit", seen)
    assert new_user_recs(spark, SF_SMALL).count() > 0
    assert len(plans) == 2 and not any("Join" in p for p in plans)
