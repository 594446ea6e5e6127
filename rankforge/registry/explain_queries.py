"""Explanations and display tables on fixture L."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators.features import item_content_vectors, item_popularity_share
from rankforge.operators.skew import lookup
from rankforge.operators.vectors import pair_similarity
from rankforge.plans import explain as XP
from rankforge.plans import products as PR
from rankforge.registry.common import ITEM_CF_K, N_RECS, L, query
from rankforge.registry.knn_queries import ICF_SQL, TOPN_SQL, UCF_SQL, item_cf, user_cf
from rankforge.registry.popularity_queries import SCORES_SQL, popularity_model
from rankforge.session import materialize
from rankforge.sources import fixtures as fx

# --- oracle building blocks ---------------------------------------------------------------

POP_RECS_ALL = """
, seen AS (SELECT DISTINCT user_id, item_id FROM interactions)
, pcand AS (SELECT u.user_id, sc.item_id, sc.score FROM users u, sc
            WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.item_id = sc.item_id))
, pop_recs AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id
                   ORDER BY round(score, 9) DESC, item_id) AS INTEGER) AS rank FROM pcand) WHERE rank <= 10)
, prank AS (SELECT s1.item_id, s1.score, CAST(1 + (SELECT count(*) FROM sc s2 WHERE s2.score > s1.score) AS INTEGER)
                   AS popularity_rank FROM sc s1)"""

SHARE_SQL = """
, share AS (SELECT item_id, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM interactions GROUP BY item_id)"""

ICF_DETAILS = f"""
, icf_recs AS ({TOPN_SQL('icf').replace('round(score, 6) AS score', 'score')})
, src AS (SELECT r.user_id, r.item_id, m.item_id AS source_item_id, round(nb.sim, 3) AS similarity
          FROM icf_recs r JOIN m ON m.user_id = r.user_id JOIN item_nb nb ON nb.id = m.item_id AND nb.nbr = r.item_id)
, src3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
                          ORDER BY similarity DESC, source_item_id) AS src_rank FROM src) WHERE src_rank <= 3)
, det AS (SELECT s.user_id, s.item_id,
                 max(CASE WHEN src_rank = 1 THEN 'Because you watched: '
                          || coalesce(i.title, 'Item #' || CAST(s.source_item_id AS VARCHAR)) END) AS reason,
                 count(*) AS n_similar_items,
                 string_agg(coalesce(i.title, 'Item #' || CAST(s.source_item_id AS VARCHAR)), ', ' ORDER BY src_rank)
                   FILTER (WHERE src_rank <= 2) AS similar2
          FROM src3 s LEFT JOIN items i ON i.item_id = s.source_item_id GROUP BY 1, 2)
, rec AS (SELECT r.user_id, r.item_id, r.rank, r.score,
                 coalesce(it.title, 'Item #' || CAST(r.item_id AS VARCHAR)) AS item_title,
                 coalesce(d.reason, 'Recommended for you') AS primary_reason,
                 3 + CASE WHEN coalesce(sh.share, 0) > 0.01 THEN 1 ELSE 0 END AS n_factors,
                 coalesce(sh.share, 0) > 0.01 AS trending,
                 coalesce(d.n_similar_items, 0) AS n_similar_items, d.similar2
          FROM icf_recs r LEFT JOIN det d USING (user_id, item_id) LEFT JOIN items it ON it.item_id = r.item_id
          LEFT JOIN share sh ON sh.item_id = r.item_id)"""


def CONF_SQL(score: str, adj: str, nf: str, cold: str = "false") -> str:
    return (f"greatest(CAST(0.1 AS DOUBLE), least(CAST(0.99 AS DOUBLE), "
            f"least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), {score} / CAST(5 AS DOUBLE)))"
            f" + least(CAST(0.2 AS DOUBLE), {nf} * CAST(0.05 AS DOUBLE)) + CAST({adj} AS DOUBLE)"
            f" - CASE WHEN {cold} THEN CAST(0.3 AS DOUBLE) ELSE 0 END))")


# --- Spark helpers ----------------------------------------------------------------------------

def _item_cf_records(spark, sf):
    m, items = item_cf(spark, sf), fx.items_l(spark, sf)
    recs = m.recommend(fx.users_l(spark, sf), N_RECS)
    share = item_popularity_share(fx.interactions_l(spark, sf))
    return XP.explanation_records("Item-CF", recs, XP.details(m, recs, items), items, share)


@query("explanation_factors", L(ICF_SQL() + SHARE_SQL + ICF_DETAILS + """
, top AS (SELECT user_id, item_id, count(*) AS n, max(similarity) AS sim FROM src3 GROUP BY 1, 2)
, base AS (SELECT r.user_id, r.item_id, coalesce(t.n, 0) AS n, t.sim, coalesce(i.category, 'N/A') AS category, coalesce(sh.share, 0) AS share
           FROM icf_recs r LEFT JOIN top t USING (user_id, item_id) LEFT JOIN items i ON i.item_id = r.item_id LEFT JOIN share sh ON sh.item_id = r.item_id)
SELECT user_id, item_id, 1 AS place, 'Based on' AS name, n || ' items you liked' AS value, CAST(0.5 AS DOUBLE) AS contribution, 'Based on Based on' AS description FROM base
UNION ALL SELECT user_id, item_id, 2, 'Top Match', coalesce(printf('%.1f%%', round(sim * 100, 1)), 'N/A'), CAST(0.5 AS DOUBLE), 'Based on Top Match' FROM base
UNION ALL SELECT user_id, item_id, 3, 'Category', category, CAST(0.5 AS DOUBLE), 'Based on Category' FROM base
UNION ALL SELECT user_id, item_id, 4, 'Trending', printf('Top %.1f%%', round(share * 100, 1)), CAST(0.3 AS DOUBLE), 'Currently trending among users'
FROM base WHERE share > 0.01"""))
def explanation_factors(spark, sf):
    """The structured factors of every Item-CF explanation, one row each."""
    r = _item_cf_records(spark, sf).select("user_id", "item_id", F.posexplode("factors").alias("at", "f"))
    return r.select("user_id", "item_id", (F.col("at") + 1).alias("place"), "f.name", "f.value", "f.contribution", "f.description")


@query("explain_popularity", L(SCORES_SQL + POP_RECS_ALL + """
SELECT r.user_id, r.item_id, 'Trending item (#' || CAST(p.popularity_rank AS VARCHAR) || ' overall)' AS reason,
       round(p.score, 6) AS score, p.popularity_rank, (SELECT count(*) FROM sc) AS total_items,
       printf('This is currently #%d in popularity with a trending score of %.2f%%', p.popularity_rank,
              round(p.score * 100, 2)) AS explanation_text,
       coalesce(i.category, 'N/A') AS category
FROM pop_recs r JOIN prank p USING (item_id) LEFT JOIN items i USING (item_id)"""))
def explain_popularity(spark, sf):
    """X1 + W1 for every popularity recommendation."""
    m = popularity_model(spark, sf)
    recs = m.recommend(fx.users_l(spark, sf), N_RECS)
    e = XP.popularity_explanations(m, recs, fx.items_l(spark, sf))
    return e.select("user_id", "item_id", "reason", F.round("score", 6).alias("score"), "popularity_rank",
                    "total_items", "explanation_text", "category")


@query("explanation_records", L(ICF_SQL() + SHARE_SQL + ICF_DETAILS + f"""
SELECT user_id, item_id, rank, round(score, 6) AS score, item_title, primary_reason, n_factors, trending,
       n_similar_items, 'Item-CF' AS model_source,
       round({CONF_SQL('score', 0.05, 'n_factors')}, 6) AS confidence, false AS is_cold_start
FROM rec"""))
def explanation_records(spark, sf):
    """X6 + X8 (flat) for every Item-CF recommendation."""
    r = _item_cf_records(spark, sf)
    return r.select("user_id", "item_id", "rank", F.round("score", 6).alias("score"), "item_title", "primary_reason",
                    "n_factors", "trending", F.size("similar_titles").cast("long").alias("n_similar_items"),
                    "model_source", F.round("confidence", 6).alias("confidence"), "is_cold_start")


@query("explanation_narrative", L(ICF_SQL() + SHARE_SQL + ICF_DETAILS + f"""
, conf AS (SELECT *, {CONF_SQL('score', 0.05, 'n_factors')} AS confidence FROM rec)
SELECT user_id, item_id,
       concat_ws(chr(10), '**' || item_title || '**', chr(10) || '*' || primary_reason || '*',
                 CASE WHEN similar2 IS NOT NULL THEN chr(10) || 'Similar to: ' || similar2 END,
                 chr(10) || 'Confidence: ' || printf('%.0f', round_even(confidence * 100, 0)) || '%') AS narrative,
       'Recommended: ' || item_title || chr(10) || 'Reason: ' || primary_reason || chr(10) || 'Confidence: '
         || printf('%.0f', round_even(confidence * 100, 0)) || '%' AS summary
FROM conf"""))
def explanation_narrative(spark, sf):
    """Narrative and summary text of every Item-CF explanation."""
    return XP.narrative(_item_cf_records(spark, sf))


def _three_recs(spark, sf):
    users = fx.users_l(spark, sf)
    out = None
    for name, m in (("Popularity", popularity_model(spark, sf)), ("User-CF", user_cf(spark, sf)),
                    ("Item-CF", item_cf(spark, sf))):
        r = m.recommend(users, N_RECS).select(F.lit(name).alias("model"), "user_id", "item_id", "score", "rank")
        out = r if out is None else out.unionByName(r)
    return out


THREE_RECS_SQL = SCORES_SQL + POP_RECS_ALL + UCF_SQL() + ICF_SQL(with_m=False) + SHARE_SQL + f"""
, ucf_recs AS ({TOPN_SQL('ucf').replace('round(score, 6) AS score', 'score')})
, icf_recs AS ({TOPN_SQL('icf').replace('round(score, 6) AS score', 'score')})
, three AS (SELECT 'Popularity' AS model, user_id, item_id, score, rank FROM pop_recs
            UNION ALL SELECT 'User-CF', user_id, item_id, score, rank FROM ucf_recs
            UNION ALL SELECT 'Item-CF', user_id, item_id, score, rank FROM icf_recs)"""


@query("explanation_confidence", L(THREE_RECS_SQL + f"""
, nf AS (SELECT t.*, 3 + CASE WHEN coalesce(sh.share, 0) > 0.01 THEN 1 ELSE 0 END AS n_factors,
                CASE t.model WHEN 'Popularity' THEN -0.1 WHEN 'Item-CF' THEN 0.05 ELSE 0 END AS adj
         FROM three t LEFT JOIN share sh USING (item_id))
SELECT model, user_id, item_id, n_factors, round({CONF_SQL('score', 'adj', 'n_factors')}, 6) AS confidence FROM nf"""))
def explanation_confidence(spark, sf):
    """X7 for the popularity, User-CF and Item-CF lists, 3 model factors + trending (``explained_recs_all`` holds all five)."""
    t = _three_recs(spark, sf)
    share = item_popularity_share(fx.interactions_l(spark, sf))
    j = t.join(share.select("item_id", "share"), "item_id", "left")
    nf = F.lit(3) + (F.coalesce(F.col("share"), F.lit(0.0)) > XP.TRENDING_SHARE).cast("int")
    return j.select("model", "user_id", "item_id", nf.alias("n_factors"),
                    F.round(XP.confidence(F.col("score"), F.col("model"), nf, F.lit(False)), 6).alias("confidence"))


@query("reason_templates", L(THREE_RECS_SQL + ICF_DETAILS.replace(
        f", icf_recs AS ({TOPN_SQL('icf').replace('round(score, 6) AS score', 'score')})", "") + """
, typed AS (SELECT t.model, t.user_id, t.item_id,
                   CASE t.model WHEN 'Popularity' THEN 'trending' WHEN 'User-CF' THEN 'similar_users'
                                WHEN 'Item-CF' THEN 'similar_items' END AS reason_type,
                   coalesce(i.category, 'Unknown') AS category, d.reason
            FROM three t LEFT JOIN items i USING (item_id) LEFT JOIN det d USING (user_id, item_id))
SELECT model, user_id, item_id, reason_type,
       CASE reason_type WHEN 'trending' THEN 'Trending in ' || category
                        WHEN 'similar_users' THEN 'Users like you enjoyed this'
                        WHEN 'similar_items' THEN 'Because you watched ' || coalesce(replace(reason, 'Because you watched: ', ''), '')
                        ELSE 'Recommended for you' END AS text
FROM typed"""))
def reason_templates(spark, sf):
    """X10 for three models (``explained_recs_all`` holds all five): each list's reason type and its template, filled with category or source title."""
    t = _three_recs(spark, sf)
    items = fx.items_l(spark, sf).select("item_id", "category")
    rec = _item_cf_records(spark, sf).select("user_id", "item_id", F.element_at("similar_titles", 1).alias("src"))
    j = (t.join(items, "item_id", "left")
         .join(rec.withColumn("model", F.lit("Item-CF")), ["model", "user_id", "item_id"], "left"))
    rtype = (F.when(F.col("model") == "Popularity", "trending").when(F.col("model") == "User-CF", "similar_users")
             .when(F.col("model") == "Item-CF", "similar_items"))
    tpl = XP.template_for(rtype)
    text = F.replace(F.replace(tpl, F.lit("{items}"), F.coalesce("src", F.lit(""))),
                     F.lit("{category}"), F.coalesce("category", F.lit("Unknown")))
    return j.select("model", "user_id", "item_id", rtype.alias("reason_type"), text.alias("text"))


REASON_TYPES = {"Popularity": "trending", "User-CF": "similar_users", "Item-CF": "similar_items", "SVD": "personalized", "Hybrid": "personalized"}


@query("explained_recs_all")
def explained_recs_all(spark, sf):
    """D3, X6, X7 and X10 for all five models (checked by pytest: the truncated SVD has no SQL twin).

    One row per model, user and place: score, reason, factors, confidence and the filled template.
    """
    from rankforge.registry.model_queries import all_models
    ints, items, users = fx.interactions_l(spark, sf), fx.items_l(spark, sf), fx.users_l(spark, sf)
    share = item_popularity_share(ints)
    out = None
    for m in all_models():
        recs = materialize(m.fit(ints, None, items).recommend(users, N_RECS))
        rec = XP.explanation_records(m.name, recs, XP.details(m, recs, items), items, share)
        rec = lookup(rec, items.select("item_id", "category"), "item_id", shuffled=True)
        text = F.replace(F.replace(XP.template_for(F.lit(REASON_TYPES[m.name])), F.lit("{items}"), F.coalesce(F.try_element_at("similar_titles", F.lit(1)), F.lit(""))),
                         F.lit("{category}"), F.coalesce("category", F.lit("Unknown")))
        own = rec.select(F.lit(m.name).alias("model"), "user_id", "rank", "item_id", "item_title", F.round("score", 6).alias("score"), "primary_reason",
                         "factors", "n_factors", "n_similar_users", F.round("confidence", 6).alias("confidence"), "is_cold_start",
                         F.lit(REASON_TYPES[m.name]).alias("reason_type"), text.alias("text"))
        out = own if out is None else out.unionByName(own)
    return out


# --- display tables ----------------------------------------------------------------------------

@query("recs_with_titles", L(ICF_SQL() + f"""
, r AS ({TOPN_SQL('icf')})
SELECT r.user_id, r.item_id, r.rank, r.score, coalesce(i.title, 'Item #' || CAST(r.item_id AS VARCHAR)) AS title,
       coalesce(i.category, 'Unknown') AS category
FROM r LEFT JOIN items i USING (item_id)"""))
def recs_with_titles(spark, sf):
    """Item-CF lists with title / category defaults."""
    recs = item_cf(spark, sf).recommend(fx.users_l(spark, sf), N_RECS)
    t = PR.with_titles(recs, fx.items_l(spark, sf))
    return t.select("user_id", "item_id", "rank", F.round("score", 6).alias("score"), "title", "category")


@query("recs_display", L(ICF_SQL() + f"""
, r AS ({TOPN_SQL('icf')})
SELECT r.user_id, r.item_id, r.rank, coalesce(i.title, 'Item #' || CAST(r.item_id AS VARCHAR)) AS title,
       coalesce(i.category, 'Unknown') AS category,
       round(least(CAST(100 AS DOUBLE), greatest(CAST(0 AS DOUBLE),
             CASE WHEN r.score <= 1 THEN r.score * 100 ELSE r.score * 10 END)), 6) AS score_pct,
       CAST(round_even(coalesce(i.avg_rating, 0), 0) AS INTEGER) AS stars
FROM r LEFT JOIN items i USING (item_id)"""))
def recs_display(spark, sf):
    """P13 on Item-CF lists (scores above 1 shown x10, clamped)."""
    recs = item_cf(spark, sf).recommend(fx.users_l(spark, sf), N_RECS)
    d = PR.recs_display(recs.select("user_id", "item_id", "rank", F.round("score", 6).alias("score")),
                        fx.items_l(spark, sf))
    return d.select("user_id", "item_id", "rank", "title", "category", F.round("score_pct", 6).alias("score_pct"),
                    "stars")


@query("side_by_side_recs", L(THREE_RECS_SQL + """
SELECT model, user_id, item_id, round(score, 6) AS score, rank FROM three WHERE rank <= 5"""))
def side_by_side_recs(spark, sf):
    """D3: first 5 per user of the three models that have a SQL twin (``explained_recs_all`` holds all five)."""
    t = _three_recs(spark, sf)
    d = PR.side_by_side({m: t.where(F.col("model") == m).drop("model")
                         for m in ("Popularity", "User-CF", "Item-CF")}, 5)
    return d.select("model", "user_id", "item_id", F.round("score", 6).alias("score"), "rank")


@query("trending_titles", L(SCORES_SQL + """
, t AS (SELECT item_id, score, CAST(row_number() OVER (ORDER BY round(score, 9) DESC, item_id) AS INTEGER) AS rank
        FROM sc)
SELECT t.item_id, t.rank, round(t.score, 6) AS score, coalesce(i.title, 'Item #' || CAST(t.item_id AS VARCHAR)) AS title,
       coalesce(i.category, '') AS category
FROM t LEFT JOIN items i USING (item_id) WHERE t.rank <= 5"""))
def trending_titles(spark, sf):
    """Quick picks."""
    m = popularity_model(spark, sf)
    d = PR.trending_titles(m.trending(N_RECS), fx.items_l(spark, sf), 5)
    return d.select("item_id", "rank", F.round("score", 6).alias("score"), "title", "category")


@query("content_similarity", L(ICF_SQL() + """
, feats AS (SELECT DISTINCT item_id, feature FROM (
              SELECT item_id, 'c:' || category AS feature FROM items WHERE category IS NOT NULL
              UNION ALL SELECT item_id, 't:' || unnest(tags) FROM items))
, cv AS (SELECT item_id, feature, 1 / sqrt(count(*) OVER (PARTITION BY item_id)) AS w FROM feats)
, sims AS (SELECT nb.id AS item_id, nb.nbr AS neighbor_id, coalesce(sum(a.w * b.w), 0) AS content_sim
           FROM item_nb nb LEFT JOIN cv a ON a.item_id = nb.id
           LEFT JOIN cv b ON b.item_id = nb.nbr AND b.feature = a.feature GROUP BY 1, 2)
SELECT item_id, neighbor_id, round(content_sim, 6) AS content_sim FROM sims"""))
def content_similarity(spark, sf):
    """V2: content similarity of every Item-CF neighbour pair (missing vector -> 0)."""
    nb = item_cf(spark, sf, ITEM_CF_K).neighbors.select(F.col("item_id").alias("id_a"), F.col("neighbor_id").alias("id_b"))
    s = pair_similarity(nb, item_content_vectors(fx.items_l(spark, sf)))
    return s.select(F.col("id_a").alias("item_id"), F.col("id_b").alias("neighbor_id"),
                    F.round("sim", 6).alias("content_sim"))


@query("recs_with_explanations", L(ICF_SQL() + SHARE_SQL + ICF_DETAILS + f"""
SELECT user_id, item_id, rank, round(score, 6) AS score, item_title, primary_reason,
       round({CONF_SQL('score', 0.05, 'n_factors')}, 6) AS confidence
FROM rec WHERE rank <= 6"""))
def recs_with_explanations(spark, sf):
    """The explorer page's 6 recommendations per user with reason and confidence (Item-CF)."""
    r = _item_cf_records(spark, sf).where(F.col("rank") <= 6)
    return r.select("user_id", "item_id", "rank", F.round("score", 6).alias("score"), "item_title",
                    "primary_reason", F.round("confidence", 6).alias("confidence"))
