"""Scans, scalar expressions, aggregates, features and dashboard tables (S*, P*, A*, V1-V3, D*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.functions import exprs as X
from rankforge.operators import features as FT
from rankforge.operators.matrix import interaction_matrix, user_counts
from rankforge.registry.common import AS_OF_E, AS_OF_L, DECAY_SQL, W_SQL, E, L, query
from rankforge.sources import codec
from rankforge.sources import fixtures as fx

USER_ID = 10
ITEM_ID = 10
SEARCH = "12"


def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _ts_sql(c):
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


# --- S: scans, sinks, codecs -------------------------------------------------------

@query("interactions_scan", L("""
SELECT user_id, item_id, interaction_type, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp,
       duration_seconds, rating FROM interactions"""))
def interactions_scan(spark, sf):
    """S1 + S3: write the interactions as CSV with header, read them back with a fixed schema."""
    from rankforge.sources import io
    ints = fx.interactions_l(spark, sf)
    path = io.scratch_path(spark, "interactions_csv")
    io.write_table(codec.encode_interactions(ints), path, "csv")
    back = io.read_interactions_csv(spark, path)
    return back.select("user_id", "item_id", "interaction_type",
                       F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
                       "duration_seconds", "rating")


@query("interactions_encoded", L("""
SELECT user_id, item_id, interaction_type, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp,
       duration_seconds, rating FROM interactions"""))
def interactions_encoded(spark, sf):
    """to_dict encoding (enum -> text, time -> ISO text)."""
    return codec.encode_interactions(fx.interactions_l(spark, sf))


@query("interactions_rejected", E("""
SELECT user_id, item_id, interaction_type, 'unknown interaction_type' AS reason FROM interactions
WHERE interaction_type IS NULL OR interaction_type NOT IN ('view', 'click', 'like', 'purchase')"""))
def interactions_rejected(spark, sf):
    """Rows whose enum value is unknown are rejected (events carry signup / error)."""
    ok, bad = codec.decode_interactions(fx.interactions_e(spark, sf))
    return bad.select("user_id", "item_id", "interaction_type", "reason")


def _list_sql(col: str) -> str:
    return f"'[' || coalesce(array_to_string(list_transform({col}, lambda x: chr(39) || x || chr(39)), ', '), '') || ']'"


@query("users_encoded", L(f"""
SELECT user_id, username, age_group, gender, strftime(signup_date, '%Y-%m-%dT%H:%M:%S') AS signup_date,
       {_list_sql('preferred_categories')} AS preferred_categories, is_premium FROM users"""))
def users_encoded(spark, sf):
    """S4 for users: times as ISO text, lists as list text."""
    return codec.encode_rows(fx.users_l(spark, sf), "users")


@query("items_encoded", L(f"""
SELECT item_id, title, category, {_list_sql('tags')} AS tags, strftime(release_date, '%Y-%m-%dT%H:%M:%S') AS release_date,
       avg_rating, rating_count, description, image_url FROM items"""))
def items_encoded(spark, sf):
    """S4 for items."""
    return codec.encode_rows(fx.items_l(spark, sf), "items")


def _damaged_users(spark, sf):
    """The users' written form, with every seventh, eleventh, ... row damaged in one field and defaults left out."""
    u, k = codec.encode_rows(fx.users_l(spark, sf), "users"), F.col("user_id")
    return u.select("user_id", F.when(k % 13 != 0, F.col("username")).alias("username"), "age_group",
                    F.when(k % 7 == 0, "unsaid").otherwise(F.col("gender")).alias("gender"),
                    F.when(k % 11 == 0, "soon").otherwise(F.col("signup_date")).alias("signup_date"),
                    F.when(k % 5 != 0, F.col("preferred_categories")).alias("preferred_categories"),
                    F.when(k % 3 != 0, F.col("is_premium")).alias("is_premium"))


@query("users_rejected", L("""
, r AS (SELECT user_id, list_filter([CASE WHEN user_id % 13 = 0 THEN 'missing username' END, CASE WHEN user_id % 7 = 0 THEN 'unknown gender' END,
                                     CASE WHEN user_id % 11 = 0 THEN 'bad signup_date' END], lambda x: x IS NOT NULL) AS reasons,
               CASE WHEN user_id % 5 = 0 THEN 0 ELSE len(preferred_categories) END AS n_categories,
               CASE WHEN user_id % 3 = 0 THEN false ELSE is_premium END AS is_premium FROM users)
SELECT user_id, CASE WHEN len(reasons) = 0 THEN n_categories END AS n_categories, CASE WHEN len(reasons) = 0 THEN is_premium END AS is_premium,
       array_to_string(reasons, '; ') AS reasons FROM r"""))
def users_rejected(spark, sf):
    """S5 for users: decoded rows with defaults, rejected ones with the reason of every bad field."""
    ok, bad = codec.decode_rows(_damaged_users(spark, sf), "users")
    return ok.select("user_id", F.size("preferred_categories").cast("long").alias("n_categories"), "is_premium", F.lit("").alias("reasons")) \
        .unionByName(bad.select("user_id", F.lit(None).cast("long").alias("n_categories"), F.lit(None).cast("boolean").alias("is_premium"),
                                F.array_join("reasons", "; ").alias("reasons")))


@query("items_rejected", L("""
, r AS (SELECT *, list_filter([CASE WHEN item_id % 17 = 0 THEN 'missing title' END, CASE WHEN item_id % 9 = 0 THEN 'bad tags' END,
                               CASE WHEN item_id % 7 = 0 THEN 'bad release_date' END, CASE WHEN item_id % 19 = 0 THEN 'bad avg_rating' END],
                              lambda x: x IS NOT NULL) AS reasons FROM items)
SELECT item_id, array_to_string(reasons, '; ') AS reasons,
       CASE WHEN len(reasons) = 0 THEN CASE WHEN item_id % 4 = 0 THEN 0 ELSE avg_rating END END AS avg_rating,
       CASE WHEN len(reasons) = 0 THEN CASE WHEN item_id % 6 = 0 THEN '' ELSE description END END AS description,
       CASE WHEN len(reasons) = 0 THEN strftime(release_date, '%Y-%m-%d') END AS release_date FROM r"""))
def items_rejected(spark, sf):
    """S5 for items: defaults of missing fields, and the reasons of rejected rows."""
    k, it = F.col("item_id"), codec.encode_rows(fx.items_l(spark, sf), "items")
    raw = it.select("item_id", F.when(k % 17 != 0, F.col("title")).alias("title"), "category",
                    F.when(k % 9 == 0, "not a list").otherwise(F.col("tags")).alias("tags"),
                    F.when(k % 7 == 0, "2024-13-45").otherwise(F.col("release_date")).alias("release_date"),
                    F.when(k % 19 == 0, "many").when(k % 4 != 0, F.col("avg_rating").cast("string")).alias("avg_rating"),
                    "rating_count", F.when(k % 6 != 0, F.col("description")).alias("description"), "image_url")
    ok, bad = codec.decode_rows(raw, "items")
    none = F.lit(None)
    return ok.select("item_id", F.lit("").alias("reasons"), "avg_rating", "description", F.date_format("release_date", "yyyy-MM-dd").alias("release_date")) \
        .unionByName(bad.select("item_id", F.array_join("reasons", "; ").alias("reasons"), none.cast("double").alias("avg_rating"),
                                none.cast("string").alias("description"), none.cast("string").alias("release_date")))


@query("item_tags_parsed", L("""
SELECT item_id, len(tags) AS n_tags, array_to_string(tags, '|') AS tags_text FROM items"""))
def item_tags_parsed(spark, sf):
    """Tags written in their Python-list text form and parsed back."""
    items = fx.items_l(spark, sf)
    text = items.select("item_id", codec.list_to_text(F.col("tags")).alias("tags_repr"))
    parsed = text.select("item_id", codec.parse_list(F.col("tags_repr")).alias("tags"))
    return parsed.select("item_id", F.size("tags").cast("bigint").alias("n_tags"),
                         F.array_join("tags", "|").alias("tags_text"))


# --- P: scalar expressions -----------------------------------------------------------

@query("weighted_interactions", E(f"""
SELECT user_id, item_id, interaction_type, {W_SQL()} AS weight FROM interactions"""))
def weighted_interactions(spark, sf):
    """P1 on fixture E (signup / error weigh 1.0)."""
    i = fx.interactions_e(spark, sf)
    return i.select("user_id", "item_id", "interaction_type", X.event_weight("interaction_type").alias("weight"))


@query("implicit_score", L(f"""
SELECT user_id, item_id, interaction_type, duration_seconds, rating,
       round({W_SQL()}
             * CASE WHEN duration_seconds IS NOT NULL AND duration_seconds > 60
                    THEN least(CAST(1.5 AS DOUBLE), 1 + duration_seconds / CAST(300 AS DOUBLE)) ELSE 1 END
             * CASE WHEN rating IS NOT NULL AND rating <> 0 THEN rating / CAST(3 AS DOUBLE) ELSE 1 END, 6)
         AS implicit_score
FROM interactions"""))
def implicit_score(spark, sf):
    i = fx.interactions_l(spark, sf)
    return i.select("user_id", "item_id", "interaction_type", "duration_seconds", "rating",
                    F.round(X.implicit_score(), 6).alias("implicit_score"))


@query("time_decay", E(f"""
SELECT user_id, item_id, interaction_type, round({DECAY_SQL('ts', AS_OF_E)}, 6) AS decay FROM interactions"""))
def time_decay(spark, sf):
    """P3 on fixture E (sub-second times, floor of whole days)."""
    i = fx.interactions_e(spark, sf)
    return i.select("user_id", "item_id", "interaction_type",
                    F.round(X.time_decay("ts", AS_OF_E, 30), 6).alias("decay"))


@query("item_freshness", L(f"""
SELECT item_id, round({DECAY_SQL('release_date', AS_OF_L, 90)}, 6) AS freshness FROM items"""))
def item_freshness(spark, sf):
    """2^(-days/90), no release date gives 0.5."""
    it = fx.items_l(spark, sf)
    return it.select("item_id", F.round(X.freshness("release_date", AS_OF_L, 90), 6).alias("freshness"))


@query("user_history", L(f"""
SELECT user_id, item_id, interaction_type, {_ts_sql('ts')} AS ts FROM interactions WHERE user_id = {USER_ID}"""))
def user_history(spark, sf):
    """P5: one user's rows (the filter reaches the scan of orders)."""
    i = fx.interactions_l(spark, sf).where(F.col("user_id") == USER_ID)
    return i.select("user_id", "item_id", "interaction_type", _ts_text(F.col("ts")).alias("ts"))


@query("item_history", L(f"""
SELECT user_id, item_id, interaction_type, {_ts_sql('ts')} AS ts FROM interactions WHERE item_id = {ITEM_ID}"""))
def item_history(spark, sf):
    """One item's rows (pushed to the lineitem scan)."""
    i = fx.interactions_l(spark, sf).where(F.col("item_id") == ITEM_ID)
    return i.select("user_id", "item_id", "interaction_type", _ts_text(F.col("ts")).alias("ts"))


@query("item_lookup", L(f"""
SELECT item_id, title, category, avg_rating, rating_count FROM items WHERE item_id IN ({ITEM_ID}, -1)"""))
def item_lookup(spark, sf):
    """Point lookups; an absent id gives no row."""
    it = fx.items_l(spark, sf)
    return it.where(F.col("item_id").isin(ITEM_ID, -1)).select(
        "item_id", "title", "category", "avg_rating", "rating_count")


@query("user_search", L(f"""
SELECT user_id, username FROM users WHERE contains(CAST(user_id AS VARCHAR), '{SEARCH}')"""))
def user_search(spark, sf):
    """P8 with a search text: ids whose text contains it."""
    u = fx.users_l(spark, sf)
    return u.where(F.col("user_id").cast("string").contains(SEARCH)).select("user_id", "username")


@query("user_search_default", L("""
SELECT user_id, username FROM users ORDER BY user_id LIMIT 100"""))
def user_search_default(spark, sf):
    """P8 without search text: the first 100 users by id (a top-k feature)."""
    return fx.users_l(spark, sf).orderBy("user_id").limit(100).select("user_id", "username")


@query("minmax_scores", L(f"""
, raw AS (SELECT item_id, sum({W_SQL()}) AS s FROM interactions GROUP BY item_id)
, c AS (SELECT r.item_id, i.category, r.s FROM raw r JOIN items i USING (item_id))
SELECT item_id, category, round(CASE WHEN max(s) OVER w = min(s) OVER w THEN 0.5
            ELSE (s - min(s) OVER w) / (max(s) OVER w - min(s) OVER w) END, 6) AS norm_score
FROM c WINDOW w AS (PARTITION BY category)"""))
def minmax_scores(spark, sf):
    """P11 per category over the weighted item totals."""
    i = fx.interactions_l(spark, sf)
    raw = i.groupBy("item_id").agg(F.sum(X.event_weight()).alias("s"))
    c = raw.join(fx.items_l(spark, sf).select("item_id", "category"), "item_id")
    n = FT.minmax_by_group(c, "s", ["category"], "norm_score")
    return n.select("item_id", "category", F.round("norm_score", 6).alias("norm_score"))


@query("cold_start_users", L("""
, cnt AS (SELECT user_id, count(*) AS n FROM interactions GROUP BY user_id)
, u AS (SELECT user_id FROM users UNION ALL SELECT CAST(-999 AS BIGINT))
SELECT u.user_id, coalesce(cnt.n, 0) AS n_interactions, coalesce(cnt.n, 0) < 20 AS is_cold
FROM u LEFT JOIN cnt USING (user_id)"""))
def cold_start_users(spark, sf):
    """P15 with threshold 20 (L is warm), plus the new id -999."""
    users = fx.users_l(spark, sf).select("user_id").unionByName(
        spark.range(1).select(F.lit(-999).cast("long").alias("user_id")))
    return FT.cold_start_users(users, fx.interactions_l(spark, sf), 20)


# --- A: aggregates and features ---------------------------------------------------------

@query("interaction_matrix_implicit", E(f"""
SELECT user_id, item_id, sum(CASE interaction_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'like' THEN 4
                               WHEN 'purchase' THEN 5 END)::DOUBLE AS value
FROM interactions GROUP BY user_id, item_id"""))
def interaction_matrix_implicit(spark, sf):
    """A1 implicit on E: unknown types map to NULL (Q4), a cell of only unknowns is NULL."""
    return interaction_matrix(fx.interactions_e(spark, sf), "implicit")


@query("interaction_matrix_count", L("""
SELECT user_id, item_id, CAST(count(*) AS DOUBLE) AS value FROM interactions GROUP BY user_id, item_id"""))
def interaction_matrix_count(spark, sf):
    return interaction_matrix(fx.interactions_l(spark, sf), "count")


@query("interaction_matrix_rating", L("""
SELECT user_id, item_id, round(sum(coalesce(rating, CAST(3 AS DOUBLE))), 6) AS value
FROM interactions GROUP BY user_id, item_id"""))
def interaction_matrix_rating(spark, sf):
    m = interaction_matrix(fx.interactions_l(spark, sf), "rating")
    return m.select("user_id", "item_id", F.round("value", 6).alias("value"))


@query("user_activity_counts", L("""
SELECT user_id, count(*) AS n_interactions FROM interactions GROUP BY user_id"""))
def user_activity_counts(spark, sf):
    """A5."""
    return user_counts(fx.interactions_l(spark, sf))


@query("user_category_affinity", L(f"""
, uc AS (SELECT user_id, category, sum({W_SQL()}) AS weight
         FROM interactions JOIN items USING (item_id) GROUP BY user_id, category)
SELECT user_id, category, weight, round(weight / sum(weight) OVER (PARTITION BY user_id), 6) AS share FROM uc"""))
def user_category_affinity(spark, sf):
    """A6 + J1."""
    a = FT.user_category_affinity(fx.interactions_l(spark, sf), fx.items_l(spark, sf))
    return a.select("user_id", "category", "weight", F.round("share", 6).alias("share"))


@query("user_top_categories", L(f"""
, uc AS (SELECT user_id, category, sum({W_SQL()}) AS weight
         FROM interactions JOIN items USING (item_id) GROUP BY user_id, category)
SELECT * FROM (SELECT user_id, category, weight,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, category) AS INTEGER) AS cat_rank FROM uc)
WHERE cat_rank <= 3"""))
def user_top_categories(spark, sf):
    """K3."""
    t = FT.user_top_categories(fx.interactions_l(spark, sf), fx.items_l(spark, sf), 3)
    return t.select("user_id", "category", "weight", "cat_rank")


@query("user_features", L(f"""
SELECT user_id, count(*) AS n_interactions,
       CAST(coalesce(floor((epoch_us(TIMESTAMP '{AS_OF_L}') - epoch_us(max(ts))) / 86400000000), 365) AS BIGINT)
         AS days_since_active,
       sum({W_SQL()}) AS weighted_score,
       round(sum({W_SQL()}) / greatest(1, count(*)), 6) AS engagement_rate
FROM interactions GROUP BY user_id"""))
def user_features(spark, sf):
    """A7 scalars."""
    f = FT.user_features(fx.interactions_l(spark, sf), fx.items_l(spark, sf), AS_OF_L)
    return f.select("user_id", "n_interactions", "days_since_active", "weighted_score",
                    F.round("engagement_rate", 6).alias("engagement_rate"))


@query("user_affinity_vector", L(f"""
, cats AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS pos
           FROM (SELECT DISTINCT category FROM items))
, uc AS (SELECT user_id, category, sum({W_SQL()}) AS weight
         FROM interactions JOIN items USING (item_id) GROUP BY user_id, category)
SELECT user_id, category, pos, round(weight / sum(weight) OVER (PARTITION BY user_id), 6) AS share
FROM uc JOIN cats USING (category)"""))
def user_affinity_vector(spark, sf):
    """A7 vector, sparse: one row per non-zero entry with its position in sorted category order."""
    v = FT.user_affinity_vectors(fx.interactions_l(spark, sf), fx.items_l(spark, sf))
    return v.select("user_id", "category", "pos", F.round("share", 6).alias("share"))


@query("user_activity_score", L(f"""
, f AS (SELECT user_id, sum({W_SQL()}) AS ws,
               coalesce(floor((epoch_us(TIMESTAMP '{AS_OF_L}') - epoch_us(max(ts))) / 86400000000), 365) AS days
        FROM interactions GROUP BY user_id)
, u AS (SELECT user_id FROM users UNION ALL SELECT CAST(-999 AS BIGINT))
SELECT u.user_id, round(CASE WHEN f.user_id IS NULL THEN 0 ELSE (CAST(0.6 AS DOUBLE) * least(CAST(1 AS DOUBLE), f.ws / CAST(100 AS DOUBLE))
                        + CAST(0.4 AS DOUBLE) * greatest(CAST(0 AS DOUBLE), 1 - f.days / CAST(365 AS DOUBLE))) END, 6) AS activity_score
FROM u LEFT JOIN f USING (user_id)"""))
def user_activity_score(spark, sf):
    """A10; an unknown user scores 0."""
    f = FT.activity_score(FT.user_features(fx.interactions_l(spark, sf), None, AS_OF_L))
    users = fx.users_l(spark, sf).select("user_id").unionByName(
        spark.range(1).select(F.lit(-999).cast("long").alias("user_id")))
    return (users.join(f, "user_id", "left")
            .select("user_id", F.round(F.coalesce("activity_score", F.lit(0.0)), 6).alias("activity_score")))


@query("item_features", L(f"""
, cnt AS (SELECT item_id, count(*) AS n FROM interactions GROUP BY item_id)
, f AS (SELECT i.item_id, i.category, coalesce(cnt.n, 0) AS n_interactions,
               {DECAY_SQL('i.release_date', AS_OF_L, 90)} AS freshness, i.avg_rating, i.rating_count
        FROM items i LEFT JOIN cnt USING (item_id))
SELECT item_id, category, n_interactions, round(freshness, 6) AS freshness, avg_rating, rating_count,
       round(n_interactions / CAST(CASE WHEN max(n_interactions) OVER () = 0 THEN 1
                                        ELSE max(n_interactions) OVER () END AS DOUBLE), 6) AS popularity
FROM f"""))
def item_features(spark, sf):
    """A8 + A11."""
    f = FT.item_features(fx.items_l(spark, sf), fx.interactions_l(spark, sf), AS_OF_L)
    return f.select("item_id", "category", "n_interactions", F.round("freshness", 6).alias("freshness"),
                    "avg_rating", "rating_count", F.round("popularity", 6).alias("popularity"))


@query("item_popularity_share", L("""
SELECT item_id, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 9) AS share
FROM interactions GROUP BY item_id"""))
def item_popularity_share(spark, sf):
    """A12."""
    s = FT.item_popularity_share(fx.interactions_l(spark, sf))
    return s.select("item_id", "n", F.round("share", 9).alias("share"))


@query("content_vocabulary", L("""
, c AS (SELECT DISTINCT category AS value FROM items)
, t AS (SELECT DISTINCT unnest(tags) AS value FROM items)
, nc AS (SELECT count(*) AS n FROM c)
SELECT 'category' AS kind, value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS idx FROM c
UNION ALL
SELECT 'tag' AS kind, value, CAST(row_number() OVER (ORDER BY value) - 1 + (SELECT n FROM nc) AS INTEGER) AS idx
FROM t"""))
def content_vocabulary(spark, sf):
    """A15."""
    v = FT.content_vocabulary(fx.items_l(spark, sf))
    return v.select("kind", "value", F.col("idx").cast("int").alias("idx"))


CONTENT_SQL = """
, feats AS (SELECT DISTINCT item_id, feature FROM (
              SELECT item_id, 'c:' || category AS feature FROM items WHERE category IS NOT NULL
              UNION ALL SELECT item_id, 't:' || unnest(tags) FROM items))
, cv AS (SELECT item_id, feature, 1 / sqrt(count(*) OVER (PARTITION BY item_id)) AS w FROM feats)"""


@query("item_content_vectors", L(CONTENT_SQL + """
SELECT item_id, feature, round(w, 6) AS w FROM cv"""))
def item_content_vectors(spark, sf):
    """V1 in long form."""
    v = FT.item_content_vectors(fx.items_l(spark, sf))
    return v.select("item_id", "feature", F.round("w", 6).alias("w"))


@query("embedding_cosine", """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
, c AS (SELECT label, pos, avg(x) AS cx FROM e GROUP BY label, pos)
, d AS (SELECT e.vec_id, e.label, sum(e.x * c.cx) AS dot, sum(e.x * e.x) AS nx, sum(c.cx * c.cx) AS nc
        FROM e JOIN c USING (label, pos) GROUP BY e.vec_id, e.label)
SELECT vec_id, label, round(CASE WHEN nx = 0 OR nc = 0 THEN 0 ELSE dot / (sqrt(nx) * sqrt(nc)) END, 6) AS cosine
FROM d""")
def embedding_cosine(spark, sf):
    """V3: cosine of each embedding to its label's mean vector (zero norm -> 0)."""
    from rankforge.operators.vectors import cosine_to_centroid
    emb = fx.table(spark, sf, "embeddings")
    return cosine_to_centroid(emb, "vec_id", "embedding", "label").select(
        "vec_id", "label", F.round("cosine", 6).alias("cosine"))


@query("dataset_stats", L("""
SELECT (SELECT count(*) FROM users) AS n_users, (SELECT count(*) FROM items) AS n_items,
       (SELECT count(*) FROM interactions) AS n_interactions,
       (SELECT count(DISTINCT user_id) FROM interactions) AS n_active_users,
       (SELECT count(DISTINCT item_id) FROM interactions) AS n_active_items,
       round(1 - (SELECT count(*) FROM interactions)
                 / CAST((SELECT count(*) FROM users) * (SELECT count(*) FROM items) AS DOUBLE), 9) AS sparsity,
       round((SELECT count(*) FROM interactions) / CAST((SELECT count(*) FROM users) AS DOUBLE), 6)
         AS avg_interactions_per_user,
       round((SELECT count(*) FROM interactions) / CAST((SELECT count(*) FROM items) AS DOUBLE), 6)
         AS avg_interactions_per_item"""))
def dataset_stats(spark, sf):
    """A9 + A4 (+ D6 front-page counts)."""
    from rankforge.plans.products import dataset_statistics
    s = dataset_statistics(fx.users_l(spark, sf), fx.items_l(spark, sf), fx.interactions_l(spark, sf))
    return s.select("n_users", "n_items", "n_interactions", "n_active_users", "n_active_items",
                    F.round("sparsity", 9).alias("sparsity"),
                    F.round("avg_interactions_per_user", 6).alias("avg_interactions_per_user"),
                    F.round("avg_interactions_per_item", 6).alias("avg_interactions_per_item"))


@query("distinct_counts_merged", L("""
SELECT strftime(ts, '%Y') AS year, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, true AS users_within, true AS items_within
FROM interactions GROUP BY 1"""))
def distinct_counts_merged(spark, sf):
    """A4 from sketches: one per day, merged per year, beside exact counts; the estimates lie within the sketches' stated error."""
    from rankforge.plans.products import daily_sketches, merged_distinct, within_error
    ints = fx.interactions_l(spark, sf)
    year = F.date_format("day", "yyyy").alias("year")
    merged = merged_distinct(daily_sketches(ints), [year])
    exact = ints.groupBy(F.date_format("ts", "yyyy").alias("year")).agg(F.countDistinct("user_id").alias("n_users"), F.countDistinct("item_id").alias("n_items"))
    return merged.join(exact, "year").select("year", "n_users", "n_items", within_error("users", "n_users").alias("users_within"),
                                             within_error("items", "n_items").alias("items_within"))


@query("interaction_type_distribution", L("""
SELECT interaction_type, count(*) AS n, round(100 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS percent
FROM interactions GROUP BY interaction_type"""))
def interaction_type_distribution(spark, sf):
    """A18."""
    from rankforge.plans.products import type_distribution
    d = type_distribution(fx.interactions_l(spark, sf))
    return d.select("interaction_type", "n", F.round("percent", 6).alias("percent"))


@query("category_distribution", L("""
SELECT category, count(*) AS n FROM items GROUP BY category"""))
def category_distribution(spark, sf):
    """A9 category counts of the catalog."""
    return fx.items_l(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("category_popularity", L("""
SELECT category, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT category, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, category) AS rank
  FROM interactions JOIN items USING (item_id) GROUP BY category) WHERE rank <= 10"""))
def category_popularity(spark, sf):
    """Top 10 categories by interactions."""
    from rankforge.plans.products import category_popularity as cp
    return cp(fx.interactions_l(spark, sf), fx.items_l(spark, sf), 10)


@query("user_history_lists", L(f"""
SELECT user_id, item_id, count(*) AS n, {_ts_sql('min(ts)')} AS first_ts, {_ts_sql('max(ts)')} AS last_ts
FROM interactions GROUP BY user_id, item_id"""))
def user_history_lists(spark, sf):
    """A14 in long form: the seen set with counts and first / last time."""
    i = fx.interactions_l(spark, sf)
    return (i.groupBy("user_id", "item_id")
            .agg(F.count(F.lit(1)).alias("n"), _ts_text(F.min("ts")).alias("first_ts"),
                 _ts_text(F.max("ts")).alias("last_ts")))


# --- D: dashboard tables ---------------------------------------------------------------------

@query("user_profile", L(f"""
, cnt AS (SELECT user_id, count(*) AS n FROM interactions GROUP BY user_id)
SELECT u.user_id, u.username, u.age_group, u.gender, {_ts_sql('u.signup_date')} AS signup_date,
       u.is_premium, CAST(len(u.preferred_categories) AS INTEGER) AS n_preferences,
       coalesce(cnt.n, 0) AS interaction_count
FROM users u LEFT JOIN cnt USING (user_id)"""))
def user_profile(spark, sf):
    """D1."""
    from rankforge.plans.products import user_profile as up
    p = up(fx.users_l(spark, sf), fx.interactions_l(spark, sf))
    return p.select("user_id", "username", "age_group", "gender", _ts_text(F.col("signup_date")).alias("signup_date"),
                    "is_premium", "n_preferences", "interaction_count")


@query("recent_activity", L(f"""
SELECT user_id, item_id, title, category, interaction_type, ts, CAST(pos AS INTEGER) AS pos FROM (
  SELECT i.user_id, i.item_id, coalesce(it.title, 'Item #' || CAST(i.item_id AS VARCHAR)) AS title,
         coalesce(it.category, '') AS category, i.interaction_type, {_ts_sql('i.ts')} AS ts,
         row_number() OVER (PARTITION BY i.user_id ORDER BY i.ts DESC NULLS LAST, i.item_id, i.interaction_type,
                            i.duration_seconds NULLS LAST, i.rating NULLS LAST) AS pos
  FROM interactions i LEFT JOIN items it USING (item_id)) WHERE pos <= 10"""))
def recent_activity(spark, sf):
    """D2 + K6: the 10 newest rows per user with title and category (Q21: newest first)."""
    from rankforge.plans.products import recent_activity as ra
    r = ra(fx.interactions_l(spark, sf), fx.items_l(spark, sf), 10)
    return r.select("user_id", "item_id", "title", "category", "interaction_type",
                    _ts_text(F.col("ts")).alias("ts"), "pos")


@query("user_directory", L("""
SELECT user_id, CASE WHEN is_premium THEN '* ' || username || ' (ID: ' || CAST(user_id AS VARCHAR) || ')'
                     ELSE 'User: ' || username || ' (ID: ' || CAST(user_id AS VARCHAR) || ')' END AS label
FROM users ORDER BY user_id LIMIT 500"""))
def user_directory(spark, sf):
    """The first 500 users with a premium marker."""
    from rankforge.plans.products import user_directory as ud
    return ud(fx.users_l(spark, sf), 500)
