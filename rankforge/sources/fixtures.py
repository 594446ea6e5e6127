"""Derive the three recommender tables from the driver's TPC-H-like tables.

Fixture L: order lines are interactions (customer x part), parts are items and
customers are users.  Fixture E: the event log, item id in ``props.k``.  Both
are lazy projections, so filters and column pruning reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixtures (see FIXTURES.md).
AS_OF_L = "2001-11-05 00:00:00"
AS_OF_E = "2024-02-01 00:00:00"
AGE_GROUPS = ["13-17", "18-24", "25-34", "35-44", "45-54", "55+"]
GENDERS = ["male", "female", "other", "prefer_not_to_say"]
TYPE_WORDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_tax", "l_discount")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    q = F.col("l_quantity")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").cast("long").alias("user_id"),
                    F.col("l_partkey").cast("long").alias("item_id"),
                    F.when(q <= 25, "view").when(q <= 38, "click").when(q <= 45, "like")
                    .otherwise("purchase").alias("interaction_type"),
                    F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
                    F.when(q <= 25, (q * 10).cast("int")).alias("duration_seconds"),
                    F.when((q > 38) & (F.col("l_tax") < 0.025),
                           F.round(F.lit(3.5) + F.col("l_discount") * 10, 1)).alias("rating")))


def items_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").cast("long").alias("item_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.concat(F.split(F.col("p_name"), " "), F.array(F.col("p_brand"))).alias("tags"),
        F.when(size % 10 != 0,
               F.lit(AS_OF_L).cast("timestamp_ntz") - F.make_dt_interval(days=size * 10)).alias("release_date"),
        F.round(F.lit(1.0) + (F.col("p_partkey") % 41) / F.lit(10.0), 1).alias("avg_rating"),
        (size * 10).cast("long").alias("rating_count"),
        F.concat(F.lit("A "), F.lower(F.col("p_type")), F.lit(" "), F.col("p_name")).alias("description"),
        F.lit("").alias("image_url"))


def users_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def pick(values, idx):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (idx).cast("int") + 1)

    return c.select(
        k.cast("long").alias("user_id"),
        F.col("c_name").alias("username"),
        pick(AGE_GROUPS, k % 6).alias("age_group"),
        pick(GENDERS, k % 4).alias("gender"),
        (F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(days=(k % 365).cast("int"))).alias("signup_date"),
        F.array(pick(TYPE_WORDS, k % 6), pick(TYPE_WORDS, (k + 1) % 6)).alias("preferred_categories"),
        (F.col("c_acctbal") > 8900).alias("is_premium"))


def interactions_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("long").alias("user_id"),
        F.get_json_object(F.col("props"), "$.k").cast("long").alias("item_id"),
        F.col("event_type").alias("interaction_type"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.lit(None).cast("int").alias("duration_seconds"),
        F.lit(None).cast("double").alias("rating"))


def items_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of fixture E: the distinct item ids with category c<id mod 10>."""
    i = interactions_e(spark, sf_dir).select("item_id").where(F.col("item_id").isNotNull()).distinct()
    return i.select("item_id", F.concat(F.lit("c"), (F.col("item_id") % 10).cast("string")).alias("category"))


# --- the same views as DuckDB SQL text, for the oracle side --------------------

SQL_INTERACTIONS_L = """
SELECT CAST(o_custkey AS BIGINT) AS user_id, CAST(l_partkey AS BIGINT) AS item_id,
       CASE WHEN l_quantity <= 25 THEN 'view' WHEN l_quantity <= 38 THEN 'click'
            WHEN l_quantity <= 45 THEN 'like' ELSE 'purchase' END AS interaction_type,
       l_shipdate AS ts,
       CASE WHEN l_quantity <= 25 THEN CAST(l_quantity * 10 AS INTEGER) END AS duration_seconds,
       CASE WHEN l_quantity > 38 AND l_tax < 0.025
            THEN round(CAST(3.5 AS DOUBLE) + l_discount * 10, 1) END AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

SQL_ITEMS_L = """
SELECT CAST(p_partkey AS BIGINT) AS item_id, p_name AS title, p_type AS category,
       list_concat(string_split(p_name, ' '), [p_brand]) AS tags,
       CASE WHEN p_size % 10 <> 0
            THEN TIMESTAMP '2001-11-05 00:00:00' - p_size * 10 * INTERVAL 1 DAY END AS release_date,
       round(CAST(1 AS DOUBLE) + (p_partkey % 41) / CAST(10 AS DOUBLE), 1) AS avg_rating,
       CAST(p_size * 10 AS BIGINT) AS rating_count,
       concat('A ', lower(p_type), ' ', p_name) AS description, '' AS image_url
FROM part"""

SQL_USERS_L = """
SELECT CAST(c_custkey AS BIGINT) AS user_id, c_name AS username,
       ['13-17','18-24','25-34','35-44','45-54','55+'][CAST(c_custkey % 6 AS INT) + 1] AS age_group,
       ['male','female','other','prefer_not_to_say'][CAST(c_custkey % 4 AS INT) + 1] AS gender,
       TIMESTAMP '1995-01-01 00:00:00' + CAST(c_custkey % 365 AS INT) * INTERVAL 1 DAY AS signup_date,
       [['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'][CAST(c_custkey % 6 AS INT) + 1],
        ['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'][CAST((c_custkey + 1) % 6 AS INT) + 1]]
         AS preferred_categories,
       c_acctbal > 8900 AS is_premium
FROM customer"""

SQL_INTERACTIONS_E = """
SELECT CAST(user_id AS BIGINT) AS user_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
       event_type AS interaction_type, ts,
       CAST(NULL AS INTEGER) AS duration_seconds, CAST(NULL AS DOUBLE) AS rating
FROM events"""

SQL_ITEMS_E = """
SELECT DISTINCT item_id, concat('c', CAST(item_id % 10 AS VARCHAR)) AS category
FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events)
WHERE item_id IS NOT NULL"""
