"""Popularity family: A2, A3, M1, K7, W1, M8 on fixture L."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.plans.popularity import Popularity
from rankforge.registry.common import (AS_OF_L, DECAY_SQL, N_RECS, W_SQL, L, query)
from rankforge.sources import fixtures as fx

CATEGORY = "MEDIUM"


def popularity_model(spark, sf):
    return Popularity(AS_OF_L).fit(fx.interactions_l(spark, sf), fx.users_l(spark, sf), fx.items_l(spark, sf))


def POP_SQL(src: str = "interactions") -> str:
    """CTE ``sc(item_id, raw_score, score)``: decayed popularity over ``src``."""
    return f"""
, raw AS (SELECT item_id, sum({W_SQL()} * {DECAY_SQL('ts', AS_OF_L)}) AS raw_score
          FROM {src} GROUP BY item_id)
, sc AS (SELECT item_id, raw_score, raw_score / max(raw_score) OVER () AS score FROM raw)"""


SCORES_SQL = POP_SQL()


@query("popularity_scores", L(SCORES_SQL + """
SELECT item_id, round(raw_score, 6) AS raw_score, round(score, 6) AS score FROM sc"""))
def popularity_scores(spark, sf):
    m = popularity_model(spark, sf)
    return m.item_scores.select("item_id", F.round("raw_score", 6).alias("raw_score"),
                                F.round("score", 6).alias("score"))


@query("category_popularity_scores", L(SCORES_SQL + """
SELECT category, sc.item_id, round(score, 6) AS score FROM sc JOIN items USING (item_id)"""))
def category_popularity_scores(spark, sf):
    m = popularity_model(spark, sf)
    return m.category_scores().select("category", "item_id", F.round("score", 6).alias("score"))


def _recs_sql(category: str | None) -> str:
    cat = f"AND sc.item_id IN (SELECT item_id FROM items WHERE category = '{category}')" if category else ""
    return L(SCORES_SQL + f"""
, seen AS (SELECT DISTINCT user_id, item_id FROM interactions)
, cand AS (SELECT u.user_id, sc.item_id, sc.score FROM users u, sc
           WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.item_id = sc.item_id) {cat})
, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank
        FROM cand)
SELECT user_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {N_RECS}""")


@query("popularity_recs", _recs_sql(None))
def popularity_recs(spark, sf):
    m = popularity_model(spark, sf)
    r = m.recommend(fx.users_l(spark, sf), N_RECS, exclude_seen=True)
    return r.select("user_id", "item_id", F.round("score", 6).alias("score"), "rank")


@query("popularity_recs_category", _recs_sql(CATEGORY))
def popularity_recs_category(spark, sf):
    m = popularity_model(spark, sf)
    r = m.recommend(fx.users_l(spark, sf), N_RECS, exclude_seen=True, category=CATEGORY)
    return r.select("user_id", "item_id", F.round("score", 6).alias("score"), "rank")


def _trending_sql(category):
    cat = f"WHERE item_id IN (SELECT item_id FROM items WHERE category = '{category}')" if category else ""
    return L(SCORES_SQL + f"""
, r AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, item_id) AS rank FROM sc {cat})
SELECT item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {N_RECS}""")


@query("trending", _trending_sql(None))
def trending(spark, sf):
    m = popularity_model(spark, sf)
    return m.trending(N_RECS).select("item_id", F.round("score", 6).alias("score"), "rank")


@query("trending_by_category", _trending_sql(CATEGORY))
def trending_by_category(spark, sf):
    m = popularity_model(spark, sf)
    return m.trending(N_RECS, CATEGORY).select("item_id", F.round("score", 6).alias("score"), "rank")


@query("popularity_rank", L(SCORES_SQL + """
SELECT i.item_id, round(coalesce(sc.score, 0), 6) AS score,
       CAST(1 + (SELECT count(*) FROM sc s2 WHERE s2.score > coalesce(sc.score, 0)) AS INTEGER) AS popularity_rank,
       (SELECT count(*) FROM sc) AS total_items
FROM items i LEFT JOIN sc USING (item_id)"""))
def popularity_rank(spark, sf):
    m = popularity_model(spark, sf)
    r = m.popularity_rank(fx.items_l(spark, sf))
    return r.select("item_id", F.round("score", 6).alias("score"), "popularity_rank", "total_items")


@query("popularity_predict", L(SCORES_SQL + """
, pairs AS (SELECT DISTINCT CAST(user_id AS BIGINT) AS user_id,
                   CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events)
SELECT p.user_id, p.item_id, round(coalesce(sc.score, 0), 6) AS score
FROM pairs p LEFT JOIN sc USING (item_id)"""))
def popularity_predict(spark, sf):
    m = popularity_model(spark, sf)
    pairs = fx.interactions_e(spark, sf).select("user_id", "item_id").distinct()
    return m.predict_score(pairs).select("user_id", "item_id", F.round("score", 6).alias("score"))
