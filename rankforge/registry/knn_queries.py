"""Similarity, neighbours and the two kNN models on fixture L."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.plans.knn import ItemCF, UserCF
from rankforge.registry.common import ITEM_CF_K, N_RECS, USER_CF_K, W_SQL, L, query
from rankforge.sources import fixtures as fx

# --- oracle building blocks ----------------------------------------------------

def MAT_SQL(src: str = "interactions") -> str:
    return f"""
, m AS (SELECT user_id, item_id, sum({W_SQL()}) AS w FROM {src} GROUP BY user_id, item_id)"""


M_SQL = MAT_SQL()


def SIM_SQL(kind: str) -> str:
    """CTE ``{kind}_sim(id, other_id, sim)`` over m; kind is 'item' or 'user'."""
    key, idc = ("user_id", "item_id") if kind == "item" else ("item_id", "user_id")
    return f"""
, {kind}_nsq AS (SELECT {idc} AS id, sum(w * w) AS nsq FROM m GROUP BY {idc})
, {kind}_dot AS (SELECT a.{idc} AS id, b.{idc} AS other_id, sum(a.w * b.w) AS dot
                 FROM m a JOIN m b ON a.{key} = b.{key} AND a.{idc} <> b.{idc} GROUP BY 1, 2)
, {kind}_sim AS (SELECT d.id, d.other_id, d.dot, d.dot / (sqrt(x.nsq) * sqrt(y.nsq)) AS sim
                 FROM {kind}_dot d JOIN {kind}_nsq x ON x.id = d.id JOIN {kind}_nsq y ON y.id = d.other_id)"""


def NB_SQL(kind: str, k: int) -> str:
    """CTE ``{kind}_nb(id, nbr, sim, rk)``: top k by (round(sim, 9) desc, id)."""
    return f"""
, {kind}_nb AS (SELECT * FROM (
    SELECT id, other_id AS nbr, sim,
           row_number() OVER (PARTITION BY id ORDER BY round(sim, 9) DESC, other_id) AS rk
    FROM {kind}_sim WHERE sim > 0) WHERE rk <= {k})"""


def UCF_SQL(k: int = USER_CF_K, with_m: bool = True) -> str:
    """CTE ``ucf(user_id, item_id, score)``: unseen User-CF scores."""
    return (M_SQL if with_m else "") + SIM_SQL("user") + NB_SQL("user", k) + """
, ucf_all AS (SELECT nb.id AS user_id, m.item_id, sum(nb.sim * m.w) / sum(abs(nb.sim)) AS score
              FROM user_nb nb JOIN m ON m.user_id = nb.nbr GROUP BY 1, 2)
, ucf AS (SELECT * FROM ucf_all s WHERE NOT EXISTS
          (SELECT 1 FROM m WHERE m.user_id = s.user_id AND m.item_id = s.item_id))"""


def ICF_SQL(k: int = ITEM_CF_K, with_m: bool = True) -> str:
    """CTE ``icf(user_id, item_id, score)``: unseen Item-CF scores."""
    return (M_SQL if with_m else "") + SIM_SQL("item") + NB_SQL("item", k) + """
, icf_all AS (SELECT m.user_id, nb.nbr AS item_id, sum(nb.sim * m.w) AS score
              FROM m JOIN item_nb nb ON nb.id = m.item_id GROUP BY 1, 2)
, icf AS (SELECT * FROM icf_all s WHERE NOT EXISTS
          (SELECT 1 FROM m WHERE m.user_id = s.user_id AND m.item_id = s.item_id))"""


def TOPN_SQL(src: str, n: int = N_RECS) -> str:
    return f"""
SELECT user_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank
  FROM {src}) WHERE rank <= {n}"""


# --- Spark side ------------------------------------------------------------------

def item_cf(spark, sf, k=ITEM_CF_K):
    return ItemCF(k_neighbors=k).fit(fx.interactions_l(spark, sf), None, fx.items_l(spark, sf))


def user_cf(spark, sf, k=USER_CF_K):
    return UserCF(k_neighbors=k).fit(fx.interactions_l(spark, sf), None, fx.items_l(spark, sf))


def _r6(df, *cols):
    return df.select(*[F.round(c, 6).alias(c) if c in ("score", "sim", "similarity", "avg_similarity")
                       else F.col(c) for c in cols])


@query("item_similarity", L(M_SQL + SIM_SQL("item") + NB_SQL("item", 5) + """
SELECT id AS item_id, nbr AS other_item_id, round(sim, 6) AS sim FROM item_nb"""))
def item_similarity(spark, sf):
    """V4: each item's five most similar items (never the table of all pairs)."""
    m = item_cf(spark, sf, 5)
    return _r6(m.neighbors.withColumnRenamed("neighbor_id", "other_item_id"), "item_id", "other_item_id", "sim")


@query("user_similarity", L(M_SQL + SIM_SQL("user") + NB_SQL("user", 5) + """
SELECT id AS user_id, nbr AS other_user_id, round(sim, 6) AS sim FROM user_nb"""))
def user_similarity(spark, sf):
    """V4: each user's five most similar users (never the table of all pairs)."""
    m = user_cf(spark, sf, 5)
    return _r6(m.neighbors.withColumnRenamed("neighbor_id", "other_user_id"), "user_id", "other_user_id", "sim")


@query("item_neighbors", L(M_SQL + SIM_SQL("item") + NB_SQL("item", ITEM_CF_K) + """
SELECT id AS item_id, nbr AS neighbor_id, round(sim, 6) AS sim, CAST(rk AS INTEGER) AS rank FROM item_nb"""))
def item_neighbors(spark, sf):
    return _r6(item_cf(spark, sf).neighbors, "item_id", "neighbor_id", "sim", "rank")


@query("user_neighbors", L(M_SQL + SIM_SQL("user") + NB_SQL("user", USER_CF_K) + """
SELECT id AS user_id, nbr AS neighbor_id, round(sim, 6) AS sim, CAST(rk AS INTEGER) AS rank FROM user_nb"""))
def user_neighbors(spark, sf):
    return _r6(user_cf(spark, sf).neighbors, "user_id", "neighbor_id", "sim", "rank")


@query("user_cf_recs", L(UCF_SQL() + TOPN_SQL("ucf")))
def user_cf_recs(spark, sf):
    return _r6(user_cf(spark, sf).recommend(fx.users_l(spark, sf), N_RECS), "user_id", "item_id", "score", "rank")


@query("item_cf_recs", L(ICF_SQL() + TOPN_SQL("icf")))
def item_cf_recs(spark, sf):
    return _r6(item_cf(spark, sf).recommend(fx.users_l(spark, sf), N_RECS), "user_id", "item_id", "score", "rank")


@query("explain_user_cf", L(UCF_SQL() + f"""
, recs AS ({TOPN_SQL('ucf')})
, c AS (SELECT r.user_id, r.item_id, count(*) AS n_similar_users, avg(round(nb.sim, 3)) AS avg_similarity,
               min(nb.rk) AS first_rank
        FROM recs r JOIN user_nb nb ON nb.id = r.user_id AND nb.rk <= 5
        JOIN m ON m.user_id = nb.nbr AND m.item_id = r.item_id GROUP BY 1, 2)
, t AS (SELECT id AS user_id, count(*) AS total_neighbors FROM user_nb GROUP BY 1)
SELECT r.user_id, r.item_id, coalesce(c.n_similar_users, 0) AS n_similar_users,
       round(c.avg_similarity, 6) AS avg_similarity, coalesce(t.total_neighbors, 0) AS total_neighbors
FROM recs r LEFT JOIN c USING (user_id, item_id) LEFT JOIN t USING (user_id)"""))
def explain_user_cf(spark, sf):
    m = user_cf(spark, sf)
    recs = m.recommend(fx.users_l(spark, sf), N_RECS)
    e = m.explain(recs)
    return e.select("user_id", "item_id", "n_similar_users", F.round("avg_similarity", 6).alias("avg_similarity"),
                    "total_neighbors")


@query("explain_item_cf", L(ICF_SQL() + f"""
, recs AS ({TOPN_SQL('icf')})
, src AS (SELECT r.user_id, r.item_id, m.item_id AS source_item_id, round(nb.sim, 3) AS similarity,
                 m.w AS engagement
          FROM recs r JOIN m ON m.user_id = r.user_id
          JOIN item_nb nb ON nb.id = m.item_id AND nb.nbr = r.item_id)
, top3 AS (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
                                        ORDER BY similarity DESC, source_item_id) AS src_rank FROM src)
SELECT t.user_id, t.item_id, t.source_item_id, t.similarity, t.engagement, CAST(t.src_rank AS INTEGER) AS src_rank,
       coalesce(i.title, concat('Item #', CAST(t.source_item_id AS VARCHAR))) AS source_title,
       CASE WHEN t.src_rank = 1 THEN concat('Because you watched: ',
            coalesce(i.title, concat('Item #', CAST(t.source_item_id AS VARCHAR)))) END AS reason
FROM top3 t LEFT JOIN items i ON i.item_id = t.source_item_id WHERE t.src_rank <= 3"""))
def explain_item_cf(spark, sf):
    m = item_cf(spark, sf)
    items = fx.items_l(spark, sf)
    recs = m.recommend(fx.users_l(spark, sf), N_RECS)
    e = m.explain(recs)
    title = F.coalesce(F.col("title"), F.concat(F.lit("Item #"), F.col("source_item_id").cast("string")))
    return (e.join(items.select(F.col("item_id").alias("source_item_id"), "title"), "source_item_id", "left")
            .select("user_id", "item_id", "source_item_id", F.round("similarity", 6).alias("similarity"),
                    "engagement", "src_rank", title.alias("source_title"),
                    F.when(F.col("src_rank") == 1, F.concat(F.lit("Because you watched: "), title)).alias("reason")))


@query("item_cf_predict", L(ICF_SQL() + """
, pairs AS (SELECT DISTINCT CAST(user_id AS BIGINT) AS user_id,
                   CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events)
SELECT p.user_id, p.item_id, round(coalesce(s.score, 0), 6) AS score
FROM pairs p LEFT JOIN icf_all s USING (user_id, item_id)"""))
def item_cf_predict(spark, sf):
    """M8 for Item-CF: the pair's score in the user's unlimited list (seen included), else 0."""
    m = item_cf(spark, sf)
    pairs = fx.interactions_e(spark, sf).select("user_id", "item_id").distinct()
    return m.predict_score(pairs).select("user_id", "item_id", F.round("score", 6).alias("score"))
