"""All five models in the comparison and explanation tables; prediction, attribution and decoding on the hand set."""
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL

from rankforge.plans import explain as XP
from rankforge.plans.hybrid import Hybrid
from rankforge.sources import codec

MODELS = ["Popularity", "User-CF", "Item-CF", "SVD", "Hybrid"]


@pytest.fixture(scope="module")
def queries():
    import __spark_entry__ as E
    return E.queries()


def test_metrics_of_all_models(spark, queries):
    got = queries["model_metrics_all"](spark, SF_SMALL).toPandas()
    assert sorted(got.model.unique()) == sorted(MODELS)
    for metric, own in got.groupby("metric"):
        assert own.best.sum() == 1 and own[own.best].value.iloc[0] == own.value.fillna(0).max()
    long = queries["comparison_long"](spark, SF_SMALL).toPandas()
    both = long.merge(got, on=["model", "metric"])
    assert len(both) == len(long) and (both.value_x - both.value_y.fillna(0)).abs().max() < 1e-9
    bands = queries["metric_bands"](spark, SF_SMALL).toPandas().merge(got, on=["model", "metric"])
    assert (bands.band_x == bands.band_y).all() and got[got.metric == "map"].band.notna().all()


def test_explanations_of_all_models(spark, queries):
    got = queries["explained_recs_all"](spark, SF_SMALL)
    rows = got.drop("factors").toPandas()
    assert sorted(rows.model.unique()) == sorted(MODELS)
    assert rows.n_factors.between(3, 4).all() and rows.confidence.between(0.1, 0.99).all() and (rows.text != "").all()
    three = queries["explanation_confidence"](spark, SF_SMALL).toPandas().merge(rows, on=["model", "user_id", "item_id"])
    assert (three.confidence_x == three.confidence_y).all() and (three.n_factors_x == three.n_factors_y).all()
    said = queries["reason_templates"](spark, SF_SMALL).toPandas().merge(rows, on=["model", "user_id", "item_id"])
    assert len(said) and (said.text_x == said.text_y).all()
    five = queries["side_by_side_recs"](spark, SF_SMALL).toPandas().merge(rows, on=["model", "user_id", "rank"])
    assert (five.item_id_x == five.item_id_y).all()
    names = {r.model: r.n for r in got.select("model", F.transform("factors", lambda f: f["name"]).alias("n")).dropDuplicates(["model"]).collect()}
    assert names["SVD"][:3] == ["Predicted Fit", "Latent Dimensions", "Category"] and names["Hybrid"][:3] == ["Strategy", "Signals Used", "Category"]
    assert names["User-CF"][:3] == ["Similar Users", "Avg Similarity", "Category"]


@pytest.mark.parametrize("collaborative", [("svd", "item_cf"), ("item_cf",), ("svd",), ()])
def test_hybrid_prediction_equals_the_whole_list(spark, hand, collaborative):
    """The pair-driven score is the one in the fused list of the whole catalog."""
    m = Hybrid(hand["as_of"], cold_start_threshold=3, collaborative=collaborative, svd_factors=2).fit(hand["interactions"], hand["users"], hand["items"])
    users = spark.createDataFrame([(1,), (2,), (3,), (4,), (9,), (77,)], "user_id long")
    full = {(r.user_id, r.item_id): r.score for r in m.recommend(users, 50, exclude_seen=False).collect()}
    pairs = [(u, i) for u in (1, 2, 3, 4, 9, 77) for i in (10, 20, 30, 40, 50, 99, 123)]
    df = spark.createDataFrame(pairs + pairs[:2], "user_id long, item_id long")
    got = m.predict_score(df).collect()
    assert len(got) == len(pairs) + 2
    for r in got:
        assert r.score == pytest.approx(full.get((r.user_id, r.item_id), 0.0), abs=1e-6)


def test_attribution_adds_up(spark, hand):
    m = Hybrid(hand["as_of"], cold_start_threshold=3, svd_factors=2).fit(hand["interactions"], hand["users"], hand["items"])
    users = spark.createDataFrame([(1,), (2,), (3,), (4,), (77,)], "user_id long")
    recs = {(r.user_id, r.item_id): (r.rank, r.score) for r in m.recommend(users, 5).collect()}
    got = m.attribution(users, 5).collect()
    assert {(r.user_id, r.item_id): (r.rank, pytest.approx(r.score)) for r in got} == recs
    flags = {(r.user_id, r.item_id): r for r in m.explain(m.recommend(users, 5)).collect()}
    for r in got:
        own, f = r.components, flags[r.user_id, r.item_id]
        assert len(own) == f.n_signals and own[-1].model == "Trending"
        assert [c.model for c in own] == [n for n, has in (("Matrix Factorization", f.has_mf), ("Item Similarity", f.has_item_similarity),
                                                          ("Content Match", f.has_content), ("Trending", True)) if has]
        assert sum(c.share for c in own) <= 1 + 1e-9 and all(c.share >= -1e-9 or c.model == "Matrix Factorization" for c in own)
        assert all(c.reason.startswith("Because you watched: ") for c in own if c.model == "Item Similarity")


def test_decode_gives_reasons_and_defaults(spark):
    raw = spark.createDataFrame([("1", "u", "18-24", "male", "2024-01-01T10:00:00", "['a', 'b']", "true"), ("2", None, "teen", "x", "never", "[", "maybe"),
                                 (None, "u", "55+", "other", "2024-01-01T10:00:00.250000", None, None)],
                                "user_id string, username string, age_group string, gender string, signup_date string, preferred_categories string, is_premium string")
    ok, bad = codec.decode_rows(raw, "users")
    assert [(r.user_id, r.preferred_categories, r.is_premium, r.signup_date.hour) for r in ok.collect()] == [(1, ["a", "b"], True, 10)]
    assert {r.username: r.reasons for r in bad.collect()} == {
        None: ["missing username", "unknown age_group", "unknown gender", "bad signup_date", "bad preferred_categories", "bad is_premium"], "u": ["missing user_id"]}
    back = codec.encode_rows(ok, "users").first()
    assert (back.signup_date, back.preferred_categories) == ("2024-01-01T10:00:00", "['a', 'b']")
    few = spark.createDataFrame([(5, "T", "C")], "item_id long, title string, category string")          # absent columns get defaults
    got = codec.decode_rows(few, "items")[0].first()
    assert (got.tags, got.avg_rating, got.rating_count, got.description, got.release_date) == ([], 0.0, 0, "", None)
    plain = spark.createDataFrame([(1, 2, "view", "2024-01-01 00:00:00"), (1, 2, "share", None)], "user_id long, item_id long, interaction_type string, ts string")
    ok, bad = codec.decode_rows(plain, "interactions")
    assert ok.count() == 1 and bad.first().reasons == ["unknown interaction_type", "missing timestamp"]


def test_details_of_pairs_without_a_source(spark, hand):
    from rankforge.plans.knn import ItemCF, UserCF
    pairs = spark.createDataFrame([(77, 10, 1.0, 1), (1, 99, 1.0, 1)], "user_id long, item_id long, score double, rank int")
    for m in (ItemCF(2), UserCF(2)):
        m.fit(hand["interactions"], None, hand["items"])
        got = {r.item_id: r for r in XP.details(m, pairs, hand["items"]).collect()}
        assert len(got) == 2 and got[99].factors[2].value == "N/A" and got[10].factors[2].value == "A"
        assert got[10].factors[0].value in ("0 items you liked", "0 found") and got[10].factors[1].value == "N/A"
