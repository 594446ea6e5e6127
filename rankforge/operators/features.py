"""User and item features (A6-A12, A15, K3, V1): DataFrame in, DataFrame out.

Everything is a grouped aggregate over the interaction table joined to the
item catalog; per-user groups are reduced to at most one row per category
before any window runs, so a heavy user never sorts its raw history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.exprs import days_between, event_weight, freshness
from rankforge.operators.matrix import with_totals
from rankforge.operators.ranking import dense_index, top_n_per_group
from rankforge.operators.skew import salt_sides
from rankforge.session import materialize


def user_category_weights(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Σ weight per (user, category); items missing from the catalog drop.

    Events are first summed per (user, item) on the map side, so a hot item
    brings one row per user to the join, and the join is salted.
    """
    # read twice, by the count of hot items and by the join
    cells = materialize(interactions.groupBy("user_id", "item_id")
                        .agg(F.sum(event_weight("interaction_type")).alias("weight")))
    left, right = salt_sides(cells, items.select("item_id", "category"), ["item_id"], F.col("user_id"))
    return (left.join(right, ["item_id", "_salt"])
            .groupBy("user_id", "category").agg(F.sum("weight").alias("weight")))


def user_category_affinity(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, category, weight, share); share = weight / user's total (total 0 -> 1)."""
    uc = user_category_weights(interactions, items)
    tot = F.sum("weight").over(Window.partitionBy("user_id"))
    return uc.withColumn("share", F.col("weight") / F.when(tot == 0, F.lit(1.0)).otherwise(tot))


def user_top_categories(interactions: DataFrame, items: DataFrame, k: int = 3) -> DataFrame:
    """K3: the k heaviest categories per user (ties by category name)."""
    uc = user_category_weights(interactions, items)
    return top_n_per_group(uc, "user_id", "weight", k, id_col="category", rank_col="cat_rank")


def category_vocabulary(items: DataFrame) -> DataFrame:
    """Sorted distinct categories with a 0-based index."""
    return dense_index(items.select("category").where(F.col("category").isNotNull()), "category", "idx")


def tag_vocabulary(items: DataFrame) -> DataFrame:
    tags = items.select(F.explode("tags").alias("tag")).where(F.col("tag").isNotNull())
    return dense_index(tags, "tag", "idx")


def content_vocabulary(items: DataFrame) -> DataFrame:
    """(kind, value, idx): categories 0..C-1 then tags C..C+T-1 (hybrid layout)."""
    cats = category_vocabulary(items)
    tags = tag_vocabulary(items)
    ncat = cats.agg(F.count(F.lit(1)).alias("_c"))
    t = with_totals(tags, ncat).select(F.lit("tag").alias("kind"), F.col("tag").alias("value"),
                                       (F.col("idx") + F.col("_c")).alias("idx"))
    c = cats.select(F.lit("category").alias("kind"), F.col("category").alias("value"), "idx")
    return c.unionByName(t)


def item_content_vectors(items: DataFrame) -> DataFrame:
    """V1 in long form: (item_id, feature, w); one-hot category + multi-hot tags, L2-normalised.

    ``feature`` is 'c:<category>' or 't:<tag>'.  An item with no feature has no
    rows (its zero vector stays zero).
    """
    c = items.where(F.col("category").isNotNull()).select(
        "item_id", F.concat(F.lit("c:"), F.col("category")).alias("feature"))
    t = items.select("item_id", F.explode("tags").alias("tag")).where(F.col("tag").isNotNull()).select(
        "item_id", F.concat(F.lit("t:"), F.col("tag")).alias("feature"))
    f = c.unionByName(t).distinct()
    return f.withColumn("w", F.lit(1.0) / F.sqrt(F.count(F.lit(1)).over(Window.partitionBy("item_id"))))


def user_features(interactions: DataFrame, items: DataFrame, as_of: str) -> DataFrame:
    """A7 scalars: n_interactions, days_since_active (no time -> 365), weighted_score, engagement_rate."""
    days = days_between(F.max("ts"), as_of)
    return (interactions.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_interactions"),
                 F.coalesce(days, F.lit(365)).cast("long").alias("days_since_active"),
                 F.sum(event_weight("interaction_type")).alias("weighted_score"))
            .withColumn("engagement_rate",
                        F.col("weighted_score") / F.greatest(F.lit(1), F.col("n_interactions"))))


def user_affinity_vectors(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """A7 vector, sparse: (user_id, category, pos, share) of the categories a user has met.

    ``pos`` is the category's place in the sorted vocabulary, joined like any
    other table; entries that are absent are 0.
    """
    vocabulary = category_vocabulary(items).select("category", F.col("idx").alias("pos"))
    return (user_category_affinity(interactions, items).join(vocabulary, "category")
            .select("user_id", "category", "pos", "share"))


def activity_score(features: DataFrame) -> DataFrame:
    """A10: 0.6*min(1, weighted/100) + 0.4*max(0, 1 - days/365)."""
    return features.withColumn(
        "activity_score",
        F.lit(0.6) * F.least(F.lit(1.0), F.col("weighted_score") / F.lit(100.0))
        + F.lit(0.4) * F.greatest(F.lit(0.0), F.lit(1.0) - F.col("days_since_active") / F.lit(365.0)))


def item_features(items: DataFrame, interactions: DataFrame | None, as_of: str,
                  halflife_days: float = 90.0) -> DataFrame:
    """A8 + A11: per catalog item n_interactions (0 if none), freshness, rating, popularity."""
    it = items.select("item_id", "category", "release_date", "avg_rating", "rating_count")
    if interactions is not None:
        cnt = interactions.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_interactions"))
        it = it.join(cnt, "item_id", "left")
    else:
        it = it.withColumn("n_interactions", F.lit(None).cast("long"))
    it = it.withColumn("n_interactions", F.coalesce(F.col("n_interactions"), F.lit(0)).cast("long"))
    top = it.agg(F.max("n_interactions").alias("_max"))
    it = with_totals(it, top)
    return it.select("item_id", "category", "n_interactions",
                     freshness("release_date", as_of, halflife_days).alias("freshness"),
                     "avg_rating", "rating_count",
                     (F.col("n_interactions") / F.when(F.col("_max") == 0, F.lit(1)).otherwise(F.col("_max")))
                     .alias("popularity"))


def item_popularity_share(interactions: DataFrame) -> DataFrame:
    """Count of the item / all interactions."""
    cnt = interactions.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    tot = interactions.agg(F.count(F.lit(1)).alias("_total"))
    return with_totals(cnt, tot).select("item_id", "n", (F.col("n") / F.col("_total")).alias("share"))


def cold_start_users(users: DataFrame, interactions: DataFrame, threshold: int = 5) -> DataFrame:
    """(user_id, n_interactions, is_cold); an unknown user has 0 and is cold."""
    cnt = interactions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_interactions"))
    return (users.select("user_id").join(cnt, "user_id", "left")
            .select("user_id", F.coalesce("n_interactions", F.lit(0)).alias("n_interactions"))
            .withColumn("is_cold", F.col("n_interactions") < threshold))


def minmax_by_group(df: DataFrame, score: str, group: list[str], out: str) -> DataFrame:
    """P11 per group: (s - min) / (max - min); all equal -> 0.5.

    min / max come from a grouped aggregate joined back, so a large group is
    reduced map-side instead of being sorted into one window task.
    """
    lim = df.groupBy(*group).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    j = df.join(lim, group)
    return j.withColumn(out, F.when(F.col("_hi") == F.col("_lo"), F.lit(0.5))
                        .otherwise((F.col(score) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))
                        ).drop("_lo", "_hi")
