"""Sums over lists in rounds of users, against the joins and brute force."""
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from rankforge.operators import listsums as LS
from rankforge.operators import similarity as S
from rankforge.operators.ranking import top_n_per_group
from rankforge.plans.knn import ItemCF, UserCF


@pytest.fixture
def small(monkeypatch):
    """Many rounds, short rows and small sums."""
    for name, v in (("ROUND_LEAST", 800), ("ROUND_SHARE", 0.5), ("ROW_ENTRIES", 3), ("CELLS", 40)):
        monkeypatch.setattr(LS, name, v)


def interactions(spark, seed=3):
    rnd = random.Random(seed)
    kinds = ["view", "click", "like", "purchase", "odd"]
    data = [(rnd.randint(1, 40), rnd.randint(100, 130), rnd.choice(kinds)) for _ in range(500)]
    data += [(7, i, "view") for i in range(100, 131)] + [(u, 100, "like") for u in range(1, 30)]      # a full history, a hot item
    data += [(None, 100, "view"), (3, None, "view"), (50, 900, "view")]
    return spark.createDataFrame(data, "user_id long, item_id long, interaction_type string").repartition(3)


def listed(df):
    return [(r.user_id, r.item_id, round(r.score, 8), r["rank"]) for r in df.orderBy("user_id", "rank").collect()]


@pytest.mark.parametrize("model", [UserCF, ItemCF])
@pytest.mark.parametrize("exclude,hot", [(True, True), (False, False)])
def test_lists_are_the_first_scores(spark, small, model, exclude, hot):
    """In many rounds, with and without salted keys, the lists are the first rows of all scores."""
    if hot:
        spark.conf.set("rankforge.skew.chunkRows", "10")
    try:
        ints = interactions(spark)
        users = ints.select("user_id").unionByName(spark.range(1000, 1002).select(F.col("id").alias("user_id")))
        users = users.where("user_id IS NULL OR user_id <> 11")
        m = model(k_neighbors=4).fit(ints)
        got = m.recommend(users, 5, exclude)
        want = top_n_per_group(m.scores(users, exclude), "user_id", "score", 5)
        assert listed(got) == listed(want) and got.columns == ["user_id", "item_id", "score", "rank"]
    finally:
        spark.conf.unset("rankforge.skew.chunkRows")


def test_sources_are_the_joined_ones(spark, small):
    m = ItemCF(k_neighbors=6).fit(interactions(spark))
    asked = m.recommend(m.matrix, 8, exclude_seen=False).select("user_id", "item_id").unionByName(
        spark.createDataFrame([(7, 999), (2000, 100)], "user_id long, item_id long"))
    hist = m.matrix.select("user_id", F.col("item_id").alias("source_item_id"), F.col("w").alias("engagement"))
    nb = m.neighbors.select(F.col("item_id").alias("source_item_id"), F.col("neighbor_id").alias("item_id"), F.round("sim", 3).alias("similarity"))
    want = top_n_per_group(asked.join(hist, "user_id").join(nb, ["source_item_id", "item_id"]), ["user_id", "item_id"], "similarity", 3,
                           id_col="source_item_id", rank_col="src_rank")
    cols = ("user_id", "item_id", "source_item_id", "similarity", "engagement", "src_rank")
    assert rows(m.explain(asked), *cols) == rows(want, *cols) and want.count() > 300


def test_a_round_sends_a_bounded_part(spark, small):
    """What one round sends stays in proportion to the tables, however long the lists are."""
    assert LS.rounds_for(10_000, 100) == 13 and LS.rounds_for(10_000, 4000) == 5 and LS.rounds_for(50, 1) == 1 and LS.rounds_for(0, 0) == 1
    written = []
    m = ItemCF(k_neighbors=10).fit(interactions(spark))
    real = LS.materialize
    LS.materialize = lambda df: written.append(real(df)) or written[-1]
    try:
        m.recommend(m.matrix, 3)
    finally:
        LS.materialize = real
    users = [{r.user for r in p.select("user").collect()} for p in written if "rank" in p.columns]
    assert len(users) >= 5 and max(map(len, users)) < 20
    assert set.union(*users) == {r.user_id for r in m.scores(m.matrix).collect()} and sum(map(len, users)) == len(set.union(*users)) > 35


def test_neighbors_in_rounds(spark, monkeypatch):
    """Blocks dealt in several rounds give the lists of one round."""
    rnd = random.Random(9)
    cells = sorted({(rnd.randint(0, 40), rnd.randint(0, 90)) for _ in range(900)})
    m = spark.createDataFrame([(a, b, float(rnd.choice([1, 2, 4, 5]))) for a, b in cells], "key long, id long, w double")
    want = rows(S.top_neighbors(m, "key", "id", 4), "id_a", "id_b", "sim", "rank")
    monkeypatch.setattr(S, "BLOCK_IDS", 8)
    monkeypatch.setattr(S, "BLOCK_ENTRIES", 60)
    monkeypatch.setattr(S, "SLICE_BLOCKS", 2)
    for name, v in (("ROUND_LEAST", 3000), ("ROUND_SHARE", 0.5)):
        monkeypatch.setattr(LS, name, v)
    assert rows(S.top_neighbors(m, "key", "id", 4), "id_a", "id_b", "sim", "rank") == want
    got = rows(S.top_neighbors(m, "key", "id", 4, heavy=8), "id_a", "id_b", "sim", "rank")
    assert [(a, b, round(s, 9), r) for a, b, s, r in got] == [(a, b, round(s, 9), r) for a, b, s, r in want]
