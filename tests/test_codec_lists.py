"""List text, loading and fallbacks that no oracle row covers."""

import ast

from pyspark.sql import functions as F

from rankforge.sources import codec, io


def test_lists_with_quotes_commas_and_backslashes(spark):
    lists = [["it's", "b"], ['a"q', "c"], ["it's \"both\"", "x, y"], ["back\\slash", "new\nline", "tab\t"], [], ["", "'"], ["[x]", "\\'"], ["é", "日本"]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "id long, tags array<string>")
    text = df.select("id", codec.list_to_text(F.col("tags")).alias("t"))
    assert all(ast.literal_eval(r.t) == lists[r.id] for r in text.collect())
    assert all(r.tags == lists[r.id] for r in text.select("id", codec.parse_list(F.col("t")).alias("tags")).collect())
    written = spark.createDataFrame([(i, repr(x)) for i, x in enumerate(lists)], "id long, t string")
    assert all(r.tags == lists[r.id] for r in written.select("id", codec.parse_list(F.col("t")).alias("tags")).collect())


def test_texts_that_are_no_list(spark):
    bad = ["", "abc", "['a'", "['a' 'b'] x", "{'a': 1}", None, "['a',, 'b']", "[a]"]
    df = spark.createDataFrame([(x,) for x in bad], "t string")
    assert all(r.x == [] for r in df.select(codec.parse_list(F.col("t")).alias("x")).collect())
    long = "[" + ", ".join(f"'tag{i}'" for i in range(20_000)) + "]"
    assert spark.createDataFrame([(long,)], "t string").select(F.size(codec.parse_list(F.col("t"))).alias("n")).first().n == 20_000


def test_load_tables_through_spark(spark, hand, tmp_path):
    ints = hand["interactions"].select("user_id", "item_id", "interaction_type", F.col("ts").alias("timestamp"), "duration_seconds", "rating")
    for name, df in (("users", hand["users"]), ("items", hand["items"]), ("interactions", ints)):
        df.write.parquet(f"file://{tmp_path}/{name}.parquet")
    users, items, loaded = io.load_tables(spark, f"file://{tmp_path}", "parquet")
    assert (users.count(), items.count(), loaded.count()) == (4, 5, 12) and "ts" in loaded.columns


def test_category_without_scores_falls_back(spark, hand):
    from rankforge.plans.popularity import Popularity
    items = hand["items"].unionByName(spark.createDataFrame([(77, "Zeta", "EMPTY", [], 1.0)], hand["items"].schema))
    m = Popularity(as_of=hand["as_of"]).fit(hand["interactions"], hand["users"], items)
    everything = [tuple(r) for r in m.trending(10).collect()]
    assert everything and [tuple(r) for r in m.trending(10, "EMPTY").collect()] == everything
    assert 0 < len(m.trending(10, "A").collect()) < len(everything)
    assert m.recommend(hand["users"], 3, category="EMPTY").count() == m.recommend(hand["users"], 3).count()


def test_predict_score_of_all_models(spark, hand):
    from rankforge.plans.hybrid import Hybrid
    from rankforge.plans.knn import ItemCF, UserCF
    from rankforge.plans.popularity import Popularity
    from rankforge.plans.svd import SVD
    pairs = spark.createDataFrame([(1, 10), (1, 40), (999, 20)], "user_id long, item_id long")
    for m in (Popularity(as_of=hand["as_of"]), UserCF(), ItemCF(), SVD(n_factors=2), Hybrid(as_of=hand["as_of"], svd_factors=2)):
        got = m.fit(hand["interactions"], hand["users"], hand["items"]).predict_score(pairs).collect()
        assert len(got) == 3 and all(r.score is not None for r in got)
