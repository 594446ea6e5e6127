"""Splits, ranking metrics and model comparison on fixture L."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators import split as SP
from rankforge.operators.features import item_content_vectors, item_popularity_share
from rankforge.plans import compare as CMP
from rankforge.plans import evaluate as EV
from rankforge.plans.knn import ItemCF, UserCF
from rankforge.plans.popularity import Popularity
from rankforge.registry.common import AS_OF_L, ITEM_CF_K, N_RECS, USER_CF_K, W_SQL, L, query
from rankforge.registry.knn_queries import MAT_SQL, NB_SQL, SIM_SQL
from rankforge.registry.popularity_queries import POP_SQL
from rankforge.session import materialize
from rankforge.sources import fixtures as fx

TEST_RATIO = 0.2
KS = (5, 10, 20)

# --- oracle building blocks ----------------------------------------------------------

SPLIT_SQL = f"""
, ordered AS (SELECT *, row_number() OVER (ORDER BY ts NULLS LAST, user_id NULLS LAST, item_id NULLS LAST,
                     interaction_type NULLS LAST, duration_seconds NULLS LAST, rating NULLS LAST) AS _pos,
                     count(*) OVER () AS _n FROM interactions)
, train AS (SELECT user_id, item_id, interaction_type, ts, duration_seconds, rating FROM ordered
            WHERE _pos <= floor(_n * (1 - CAST({TEST_RATIO} AS DOUBLE))))
, test AS (SELECT user_id, item_id, interaction_type, ts, duration_seconds, rating FROM ordered
           WHERE _pos > floor(_n * (1 - CAST({TEST_RATIO} AS DOUBLE))))
, tu AS (SELECT DISTINCT user_id FROM test)
, rel AS (SELECT DISTINCT user_id, item_id FROM test WHERE item_id IS NOT NULL)
, nrel AS (SELECT user_id, count(*) AS n_relevant FROM rel GROUP BY user_id)
, share AS (SELECT item_id, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM train GROUP BY item_id)
, feats AS (SELECT DISTINCT item_id, feature FROM (
              SELECT item_id, 'c:' || category AS feature FROM items WHERE category IS NOT NULL
              UNION ALL SELECT item_id, 't:' || unnest(tags) FROM items))
, cv AS (SELECT item_id, feature, 1 / sqrt(count(*) OVER (PARTITION BY item_id)) AS w FROM feats)"""


def _topn(src, out):
    return f"""
, {out} AS (SELECT user_id, item_id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank
    FROM {src}) WHERE rank <= {N_RECS})"""


POP_RECS_SQL = POP_SQL("train") + """
, seen AS (SELECT DISTINCT user_id, item_id FROM train)
, pop_cand AS (SELECT tu.user_id, sc.item_id, sc.score FROM tu, sc
               WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = tu.user_id AND s.item_id = sc.item_id))""" \
    + _topn("pop_cand", "pop_recs")

KNN_BASE_SQL = MAT_SQL("train")

ICF_RECS_SQL = SIM_SQL("item") + NB_SQL("item", ITEM_CF_K) + """
, icf_all AS (SELECT m.user_id, nb.nbr AS item_id, sum(nb.sim * m.w) AS score
              FROM m JOIN item_nb nb ON nb.id = m.item_id WHERE m.user_id IN (SELECT user_id FROM tu) GROUP BY 1, 2)
, icf AS (SELECT * FROM icf_all s WHERE NOT EXISTS
          (SELECT 1 FROM m WHERE m.user_id = s.user_id AND m.item_id = s.item_id))""" + _topn("icf", "icf_recs")

UCF_RECS_SQL = SIM_SQL("user") + NB_SQL("user", USER_CF_K) + """
, ucf_all AS (SELECT nb.id AS user_id, m.item_id, sum(nb.sim * m.w) / sum(abs(nb.sim)) AS score
              FROM user_nb nb JOIN m ON m.user_id = nb.nbr WHERE nb.id IN (SELECT user_id FROM tu) GROUP BY 1, 2)
, ucf AS (SELECT * FROM ucf_all s WHERE NOT EXISTS
          (SELECT 1 FROM m WHERE m.user_id = s.user_id AND m.item_id = s.item_id))""" + _topn("ucf", "ucf_recs")


def _idcg(k):
    return (f"CASE WHEN n_relevant = 0 THEN 0 ELSE list_sum(list_transform(generate_series(1, least({k}, n_relevant)),"
            f" lambda i: 1 / log2(i + 1))) END")


def PER_USER_SQL(recs: str, t: str) -> str:
    """CTE ``pu_{t}``: wide per-user metrics of the list ``recs``."""
    sums = ",\n".join(
        f"  sum(CASE WHEN rank <= {k} THEN hit ELSE 0 END) AS h{k},"
        f" sum(CASE WHEN rank <= {k} AND hit = 1 THEN 1 / log2(rank + 1) ELSE 0 END) AS dcg{k}" for k in KS)
    cols = []
    for k in KS:
        p = f"(h{k} / CAST({k} AS DOUBLE))"
        r = f"(CASE WHEN n_relevant = 0 THEN 0 ELSE h{k} / CAST(n_relevant AS DOUBLE) END)"
        cols += [f'{p} AS "precision@{k}"', f'{r} AS "recall@{k}"',
                 f'(CASE WHEN {p} + {r} = 0 THEN 0 ELSE 2 * {p} * {r} / ({p} + {r}) END) AS "f1@{k}"',
                 f'(CASE WHEN n_relevant = 0 THEN 0 ELSE dcg{k} / ({_idcg(k)}) END) AS "ndcg@{k}"',
                 f'(CASE WHEN h{k} > 0 THEN CAST(1 AS DOUBLE) ELSE 0 END) AS "hit_rate@{k}"']
    cols.append('(CASE WHEN n_relevant = 0 THEN 0 ELSE ap / CAST(n_relevant AS DOUBLE) END) AS "map"')
    return f"""
, h_{t} AS (SELECT r.user_id, r.item_id, r.rank, CASE WHEN rel.item_id IS NULL THEN 0 ELSE 1 END AS hit
            FROM {recs} r LEFT JOIN rel USING (user_id, item_id))
, c_{t} AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM h_{t})
, s_{t} AS (SELECT user_id,
{sums},
  sum(CASE WHEN hit = 1 THEN cum / CAST(rank AS DOUBLE) ELSE 0 END) AS ap FROM c_{t} GROUP BY user_id)
, pu_{t} AS (SELECT user_id, n_relevant,
  {(','+chr(10)+'  ').join(cols)}
  FROM (SELECT s.*, coalesce(nrel.n_relevant, 0) AS n_relevant FROM s_{t} s LEFT JOIN nrel USING (user_id)) x)"""


def DIV_NOV_SQL(recs: str, t: str) -> str:
    """CTEs ``div_{t}(user_id, diversity)`` (brute-force pairs) and ``nov_{t}(user_id, novelty)``."""
    return f"""
, len_{t} AS (SELECT user_id, count(*) AS len FROM {recs} GROUP BY user_id)
, vr_{t} AS (SELECT user_id, item_id, rank FROM {recs} WHERE item_id IN (SELECT item_id FROM cv))
, vm_{t} AS (SELECT user_id, count(*) AS m FROM vr_{t} GROUP BY user_id)
, pr_{t} AS (SELECT a.user_id, a.item_id AS ia, b.item_id AS ib FROM vr_{t} a JOIN vr_{t} b
             ON a.user_id = b.user_id AND a.rank < b.rank)
, pd_{t} AS (SELECT p.user_id, p.ia, p.ib, coalesce(sum(ca.w * cb.w), 0) AS cos
             FROM pr_{t} p JOIN cv ca ON ca.item_id = p.ia
             LEFT JOIN cv cb ON cb.item_id = p.ib AND cb.feature = ca.feature GROUP BY 1, 2, 3)
, div_{t} AS (SELECT l.user_id, CASE WHEN l.len < 2 OR coalesce(vm.m, 0) < 2 THEN CAST(0 AS DOUBLE)
                 ELSE (SELECT avg(1 - cos) FROM pd_{t} d WHERE d.user_id = l.user_id) END AS diversity
              FROM len_{t} l LEFT JOIN vm_{t} vm USING (user_id))
, nov_{t} AS (SELECT r.user_id, avg(-log2(coalesce(share.share, 1e-10) + 1e-10)) AS novelty
              FROM {recs} r LEFT JOIN share USING (item_id) GROUP BY r.user_id)"""


def _metric_cols():
    out = []
    for k in KS:
        out += [f"precision@{k}", f"recall@{k}", f"f1@{k}", f"ndcg@{k}", f"hit_rate@{k}"]
    return out + ["map"]


def MODEL_METRICS_SQL(recs: str, t: str) -> str:
    """CTE ``mm_{t}(metric, value, n_users_evaluated)``: means over evaluated users + coverage."""
    names = _metric_cols() + ["diversity", "novelty"]
    avgs = ", ".join(f'avg("{n}") AS "{n}"' for n in names)
    return PER_USER_SQL(recs, t) + DIV_NOV_SQL(recs, t) + f"""
, all_{t} AS (SELECT pu.*, d.diversity, n.novelty FROM pu_{t} pu
              LEFT JOIN div_{t} d USING (user_id) LEFT JOIN nov_{t} n USING (user_id))
, wide_{t} AS (SELECT {avgs}, count(*) AS n_users_evaluated FROM all_{t})
, mm_{t} AS (
  SELECT metric, value, n_users_evaluated FROM (UNPIVOT wide_{t} ON {", ".join(f'"{n}"' for n in names)}
                                                 INTO NAME metric VALUE value)
  UNION ALL
  SELECT 'coverage', (SELECT count(DISTINCT item_id) FROM {recs})
                     / CAST((SELECT count(DISTINCT item_id) FROM items) AS DOUBLE),
         (SELECT n_users_evaluated FROM wide_{t}))"""


ALL_MODELS_SQL = (SPLIT_SQL + POP_RECS_SQL + KNN_BASE_SQL + UCF_RECS_SQL + ICF_RECS_SQL
                  + MODEL_METRICS_SQL("pop_recs", "pop") + MODEL_METRICS_SQL("ucf_recs", "ucf")
                  + MODEL_METRICS_SQL("icf_recs", "icf") + """
, metrics AS (SELECT 'Popularity' AS model, 0 AS model_order, * FROM mm_pop
              UNION ALL SELECT 'User-CF', 1, * FROM mm_ucf
              UNION ALL SELECT 'Item-CF', 2, * FROM mm_icf)""")


# --- Spark side --------------------------------------------------------------------------

def _setup(spark, sf):
    ints = fx.interactions_l(spark, sf)
    train, test = SP.chronological_split(ints, TEST_RATIO)
    return train, test, fx.items_l(spark, sf)


def _pop_recs(spark, sf):
    train, test, items = _setup(spark, sf)
    m = Popularity(AS_OF_L).fit(train, None, items)
    return m.recommend(test.select("user_id").distinct(), N_RECS), train, test, items


def _model_metrics(model, spark, sf):
    train, test, items = _setup(spark, sf)
    model.fit(train, None, items)
    recs = model.recommend(test.select("user_id").distinct(), N_RECS)
    m = EV.evaluate_recs(recs, test, items, item_popularity_share(train), item_content_vectors(items))
    return m.select("metric", F.round("value", 6).alias("value"), "n_users_evaluated")


def _three_models(spark, sf):
    train, test, items = _setup(spark, sf)
    share = item_popularity_share(train)
    vec = item_content_vectors(items)
    tu = test.select("user_id").distinct()
    named = []
    for model in (Popularity(AS_OF_L), UserCF(k_neighbors=USER_CF_K), ItemCF(k_neighbors=ITEM_CF_K)):
        model.fit(train, None, items)
        # a few rows, which the comparisons read several times; written, so that a model's shuffle files are deleted before the next
        named.append((model.name, materialize(EV.evaluate_recs(model.recommend(tu, N_RECS), test, items, share, vec))))
    return CMP.union_metrics(named)


@query("split_chronological", L(SPLIT_SQL + """
SELECT user_id, item_id, interaction_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, duration_seconds, rating,
       'train' AS split FROM train
UNION ALL
SELECT user_id, item_id, interaction_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, duration_seconds, rating,
       'test' AS split FROM test"""))
def split_chronological(spark, sf):
    lab = SP.labelled_chronological(fx.interactions_l(spark, sf), TEST_RATIO)
    return lab.select("user_id", "item_id", "interaction_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                      "duration_seconds", "rating", "split")


_SPLIT_COLUMNS = ["user_id", "item_id", "interaction_type", "duration_seconds", "rating", "ts"]


@query("split_random", L(f"""
SELECT user_id, item_id, interaction_type, duration_seconds, rating, ts,
       CASE WHEN CAST('0x' || substr(md5('42|' || {" || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _SPLIT_COLUMNS)}), 1, 8) AS BIGINT)
                 / CAST(4294967296 AS DOUBLE) < 1 - CAST({TEST_RATIO} AS DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM (SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts) FROM interactions)"""))
def split_random(spark, sf):
    """A hash that both engines have."""
    ints = fx.interactions_l(spark, sf).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).select(*_SPLIT_COLUMNS)
    train, test = SP.random_split(ints, TEST_RATIO, 42)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("test_relevant", L(SPLIT_SQL + """
SELECT user_id, item_id FROM rel"""))
def test_relevant(spark, sf):
    train, test, items = _setup(spark, sf)
    return EV.relevant_items(test)


@query("rec_hits", L(SPLIT_SQL + POP_RECS_SQL + """
SELECT r.user_id, r.item_id, r.rank, CASE WHEN rel.item_id IS NULL THEN 0 ELSE 1 END AS hit
FROM pop_recs r LEFT JOIN rel USING (user_id, item_id)"""))
def rec_hits(spark, sf):
    recs, train, test, items = _pop_recs(spark, sf)
    return EV.hit_table(recs, EV.relevant_items(test)).select("user_id", "item_id", "rank", "hit")


def _per_user_select(cols):
    return ", ".join(["user_id", "n_relevant"] + [f'round("{c}", 6) AS "{c}"' for c in cols])


@query("ranking_metrics_per_user", L(SPLIT_SQL + POP_RECS_SQL + PER_USER_SQL("pop_recs", "pop") + f"""
SELECT {_per_user_select(_metric_cols())} FROM pu_pop"""))
def ranking_metrics_per_user(spark, sf):
    recs, train, test, items = _pop_recs(spark, sf)
    pu = EV.per_user_metrics(recs, EV.relevant_items(test), KS)
    return pu.select("user_id", "n_relevant", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in _metric_cols()])


@query("average_precision", L(SPLIT_SQL + POP_RECS_SQL + PER_USER_SQL("pop_recs", "pop") + """
SELECT user_id, round("map", 6) AS ap FROM pu_pop"""))
def average_precision(spark, sf):
    recs, train, test, items = _pop_recs(spark, sf)
    pu = EV.per_user_metrics(recs, EV.relevant_items(test), KS)
    return pu.select("user_id", F.round("map", 6).alias("ap"))


@query("ndcg_at_k", L(SPLIT_SQL + POP_RECS_SQL + PER_USER_SQL("pop_recs", "pop") + """
SELECT user_id, round("ndcg@5", 6) AS ndcg_5, round("ndcg@10", 6) AS ndcg_10, round("ndcg@20", 6) AS ndcg_20
FROM pu_pop"""))
def ndcg_at_k(spark, sf):
    recs, train, test, items = _pop_recs(spark, sf)
    pu = EV.per_user_metrics(recs, EV.relevant_items(test), KS)
    return pu.select("user_id", *[F.round(F.col(f"`ndcg@{k}`"), 6).alias(f"ndcg_{k}") for k in KS])


@query("ndcg_graded", L(SPLIT_SQL + POP_RECS_SQL + f"""
, grel AS (SELECT user_id, item_id, sum({W_SQL()}) AS rel FROM test GROUP BY user_id, item_id)
, dcg AS (SELECT r.user_id, sum(g.rel / log2(r.rank + 1)) AS dcg FROM pop_recs r
          JOIN grel g USING (user_id, item_id) WHERE r.rank <= 10 GROUP BY r.user_id)
, ideal AS (SELECT user_id, sum(rel / log2(i + 1)) AS idcg FROM (
            SELECT user_id, rel, row_number() OVER (PARTITION BY user_id ORDER BY rel DESC, item_id) AS i FROM grel)
            WHERE i <= 10 GROUP BY user_id)
, u AS (SELECT DISTINCT user_id FROM pop_recs)
SELECT u.user_id, round(CASE WHEN coalesce(ideal.idcg, 0) = 0 THEN 0 ELSE coalesce(dcg.dcg, 0) / ideal.idcg END, 6)
       AS ndcg
FROM u LEFT JOIN dcg USING (user_id) LEFT JOIN ideal USING (user_id)"""))
def ndcg_graded(spark, sf):
    """E4 graded: relevance = Σ weight of the user's test rows on the item."""
    from rankforge.functions.exprs import event_weight
    recs, train, test, items = _pop_recs(spark, sf)
    rel = test.groupBy("user_id", "item_id").agg(F.sum(event_weight()).alias("rel"))
    return EV.ndcg_graded(recs, rel, 10).select("user_id", F.round("ndcg", 6).alias("ndcg"))


@query("list_diversity", L(SPLIT_SQL + POP_RECS_SQL + DIV_NOV_SQL("pop_recs", "pop") + """
SELECT user_id, round(diversity, 6) AS diversity FROM div_pop"""))
def list_diversity(spark, sf):
    recs, train, test, items = _pop_recs(spark, sf)
    return EV.list_diversity(materialize(recs.select("user_id", "item_id")), item_content_vectors(items)).select(
        "user_id", F.round("diversity", 6).alias("diversity"))


@query("list_novelty", L(SPLIT_SQL + POP_RECS_SQL + DIV_NOV_SQL("pop_recs", "pop") + """
SELECT user_id, round(novelty, 6) AS novelty FROM nov_pop"""))
def list_novelty(spark, sf):
    recs, train, test, items = _pop_recs(spark, sf)
    return EV.list_novelty(recs, item_popularity_share(train)).select("user_id", F.round("novelty", 6).alias("novelty"))


@query("catalog_coverage", L(SPLIT_SQL + POP_RECS_SQL + """
SELECT round((SELECT count(DISTINCT item_id) FROM pop_recs)
             / CAST((SELECT count(DISTINCT item_id) FROM items) AS DOUBLE), 6) AS coverage"""))
def catalog_coverage(spark, sf):
    recs, train, test, items = _pop_recs(spark, sf)
    return EV.catalog_coverage(recs, items).select(F.round("coverage", 6).alias("coverage"))


def _mm_sql(recs_block, recs, t):
    return L(SPLIT_SQL + recs_block + MODEL_METRICS_SQL(recs, t) + f"""
SELECT metric, round(value, 6) AS value, n_users_evaluated FROM mm_{t}""")


@query("model_metrics_popularity", _mm_sql(POP_RECS_SQL, "pop_recs", "pop"))
def model_metrics_popularity(spark, sf):
    return _model_metrics(Popularity(AS_OF_L), spark, sf)


@query("model_metrics_item_cf", _mm_sql(KNN_BASE_SQL + ICF_RECS_SQL, "icf_recs", "icf"))
def model_metrics_item_cf(spark, sf):
    return _model_metrics(ItemCF(k_neighbors=ITEM_CF_K), spark, sf)


@query("model_metrics_user_cf", _mm_sql(KNN_BASE_SQL + UCF_RECS_SQL, "ucf_recs", "ucf"))
def model_metrics_user_cf(spark, sf):
    return _model_metrics(UserCF(k_neighbors=USER_CF_K), spark, sf)


GRID_SQL = """
, names AS (SELECT DISTINCT metric FROM metrics)
, models AS (SELECT DISTINCT model, model_order FROM metrics)
, grid AS (SELECT n.metric, m.model, m.model_order, coalesce(x.value, 0) AS value
           FROM names n, models m LEFT JOIN metrics x ON x.metric = n.metric AND x.model = m.model)
, best AS (SELECT metric, model AS best_model, value AS best_value FROM (
           SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, model_order) AS r FROM grid)
           WHERE r = 1)"""


@query("best_model_per_metric", L(ALL_MODELS_SQL + GRID_SQL + """
SELECT metric, best_model, round(best_value, 6) AS best_value FROM best"""))
def best_model_per_metric(spark, sf):
    """C1 of the three models that have a SQL twin (``model_metrics_all`` holds all five)."""
    b = CMP.best_model_per_metric(_three_models(spark, sf))
    return b.select("metric", "best_model", F.round("best_value", 6).alias("best_value"))


_WIDE_NAMES = _metric_cols() + ["diversity", "novelty", "coverage"]


@query("model_comparison_wide", L(ALL_MODELS_SQL + f"""
SELECT model, model_order, {", ".join(f'round(max(CASE WHEN metric = {chr(39)}{n}{chr(39)} THEN value END), 6) AS "{n}"'
                                      for n in _WIDE_NAMES)}
FROM metrics GROUP BY model, model_order"""))
def model_comparison_wide(spark, sf):
    """C2 of the three models that have a SQL twin (``model_comparison`` holds all five)."""
    w = CMP.comparison_wide(_three_models(spark, sf), _WIDE_NAMES)
    return w.select("model", "model_order", *[F.round(F.col(f"`{n}`"), 6).alias(n) for n in _WIDE_NAMES])


@query("comparison_summary", L(ALL_MODELS_SQL + GRID_SQL + """
SELECT item, model, round(value, 6) AS value FROM (
  SELECT 'best_overall_map' AS item, model, value FROM (
     SELECT *, row_number() OVER (ORDER BY value DESC, model_order) AS r FROM grid WHERE metric = 'map') WHERE r = 1
  UNION ALL
  SELECT metric, best_model, best_value FROM best
  WHERE metric IN ('precision@10', 'recall@10', 'ndcg@10', 'map', 'coverage', 'diversity'))"""))
def comparison_summary(spark, sf):
    """C3 of the three models that have a SQL twin, without the timing line (times are not reproducible)."""
    s = CMP.summary(_three_models(spark, sf))
    return s.select("item", "model", F.round("value", 6).alias("value"))


@query("comparison_long", L(ALL_MODELS_SQL + """
, keys AS (SELECT unnest(['precision@5', 'precision@10', 'recall@10', 'ndcg@10', 'map']) AS metric)
, ms AS (SELECT DISTINCT model, model_order FROM metrics)
SELECT ms.model, ms.model_order, k.metric, round(coalesce(x.value, 0), 6) AS value
FROM keys k, ms LEFT JOIN metrics x ON x.metric = k.metric AND x.model = ms.model"""))
def comparison_long(spark, sf):
    """C4 of the three models that have a SQL twin (``model_metrics_all`` holds all five)."""
    c = CMP.comparison_long(_three_models(spark, sf))
    return c.select("model", "model_order", "metric", F.round("value", 6).alias("value"))


@query("metric_report", _mm_sql(POP_RECS_SQL, "pop_recs", "pop").rsplit("SELECT metric, round", 1)[0] + """
SELECT CASE WHEN regexp_matches(metric, 'precision|recall|f1|ndcg|hit_rate|map') THEN 'Ranking Metrics'
            ELSE 'Beyond-Accuracy Metrics' END AS section, metric, round(value, 4) AS value
FROM mm_pop""")
def metric_report(spark, sf):
    """Grouped report (value shown to 4 places)."""
    m = _model_metrics(Popularity(AS_OF_L), spark, sf)
    r = EV.metric_report(m)
    return r.select("section", "metric", F.round("value", 4).alias("value"))


@query("model_comparison")
def model_comparison(spark, sf):
    """E9 with times (rows only: times vary run to run)."""
    from rankforge.registry.model_queries import all_models
    train, test, items = _setup(spark, sf)
    metrics, times = CMP.compare_models(all_models(), train, test, None, items, N_RECS,
                                        item_content_vectors(items))
    return CMP.comparison_wide(metrics, _WIDE_NAMES, times)


@query("metric_bands", L(ALL_MODELS_SQL + """
SELECT model, metric, round(value, 6) AS value,
       CASE WHEN value >= 0.3 THEN 'green' WHEN value >= 0.15 THEN 'yellow' ELSE 'red' END AS band
FROM metrics WHERE metric IN ('precision@10', 'recall@10', 'ndcg@10', 'map', 'coverage', 'diversity')"""))
def metric_bands(spark, sf):
    """Colour band of the dashboard's six key metrics, three models (``model_metrics_all`` holds all five)."""
    from rankforge.functions.exprs import metric_band
    m = _three_models(spark, sf).where(F.col("metric").isin(*CMP.KEY_SUMMARY))
    return m.select("model", "metric", F.round("value", 6).alias("value"), metric_band(F.col("value")).alias("band"))


@query("model_metrics_all")
def model_metrics_all(spark, sf):
    """C1-C4 and P14 for all five models (checked by pytest: the truncated SVD has no SQL twin).

    One row per model and metric: value, whether it is the best of the five (ties: the first listed model), and the
    dashboard's band of its key metrics.
    """
    from rankforge.functions.exprs import metric_band
    from rankforge.registry.model_queries import all_models
    train, test, items = _setup(spark, sf)
    metrics, _ = CMP.compare_models(all_models(), train, test, None, items, N_RECS, item_content_vectors(items))
    best = CMP.best_model_per_metric(metrics).select("metric", "best_model")
    band = F.when(F.col("metric").isin(*CMP.KEY_SUMMARY), metric_band(F.coalesce("value", F.lit(0.0))))
    return metrics.join(best, "metric").select("model", "model_order", "metric", F.round("value", 6).alias("value"), "n_users_evaluated",
                                               (F.col("model") == F.col("best_model")).alias("best"), band.alias("band"))
