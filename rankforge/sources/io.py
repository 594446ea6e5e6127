"""Sources and sinks (S1, S2, S3, S7): CSV and Parquet, with fixed schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.session import checkpoint_dir
from rankforge.sources.codec import parse_list

INTERACTIONS_CSV = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("interaction_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("duration_seconds", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
])

ITEMS_CSV = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("avg_rating", T.DoubleType()),
    T.StructField("rating_count", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("image_url", T.StringType()),
])

USERS_CSV = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("age_group", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("signup_date", T.StringType()),
    T.StructField("preferred_categories", T.StringType()),
    T.StructField("is_premium", T.BooleanType()),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """S3: CSV with header (arrays as their list text) or Parquet (native arrays)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def read_interactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Interactions with a fixed schema; the time text is parsed (bad text -> NULL)."""
    df = spark.read.schema(INTERACTIONS_CSV).option("header", True).csv(path)
    return df.withColumn("timestamp", F.try_to_timestamp("timestamp").cast("timestamp_ntz"))


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(ITEMS_CSV).option("header", True).csv(path)
    return (df.withColumn("tags", parse_list(F.col("tags")))
            .withColumn("release_date", F.try_to_timestamp("release_date").cast("timestamp_ntz")))


def read_users_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(USERS_CSV).option("header", True).csv(path)
    return (df.withColumn("preferred_categories", parse_list(F.col("preferred_categories")))
            .withColumn("signup_date", F.try_to_timestamp("signup_date").cast("timestamp_ntz")))


def load_tables(spark: SparkSession, data_dir: str, fmt: str = "csv"):
    """(users, items, interactions) from any folder or store that Spark reads, as CSV or Parquet.

    Generation of synthetic data is not built: a missing table is Spark's own
    error when the table is first named.
    """
    base = data_dir.rstrip("/")
    if fmt == "parquet":
        users, items, ints = (spark.read.parquet(f"{base}/{n}.parquet") for n in ("users", "items", "interactions"))
    else:
        users, items = read_users_csv(spark, f"{base}/users.csv"), read_items_csv(spark, f"{base}/items.csv")
        ints = read_interactions_csv(spark, f"{base}/interactions.csv")
    return users, items, ints.withColumnRenamed("timestamp", "ts") if "timestamp" in ints.columns else ints


def register_views(spark: SparkSession, users: DataFrame, items: DataFrame, interactions: DataFrame,
                   cache: bool = False) -> None:
    """The three tables as temp views (``users``, ``items``, ``interactions``), optionally cached."""
    for name, df in (("users", users), ("items", items), ("interactions", interactions)):
        (df.cache() if cache else df).createOrReplaceTempView(name)
