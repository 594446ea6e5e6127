"""The user x item matrix as a long table (A1, A4, A5, A14) and small joins helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.exprs import event_weight


def weighted(interactions: DataFrame) -> DataFrame:
    """P1 on every row: adds ``w`` (unknown types weigh 1.0)."""
    return interactions.withColumn("w", event_weight("interaction_type"))


def user_item_weights(interactions: DataFrame) -> DataFrame:
    """A1 in the form every model uses: Σ weight per (user, item).

    Duplicate (user, item) rows sum, as the reference's COO -> CSR does.
    Hash aggregation is partial (map-side) before the shuffle.
    """
    return (interactions.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
            .groupBy("user_id", "item_id")
            .agg(F.sum(event_weight("interaction_type")).alias("w")))


def interaction_matrix(interactions: DataFrame, value_type: str = "implicit") -> DataFrame:
    """A1 with the reference's three modes.

    implicit: Σ weight, unknown type gives NULL (Q4, as the loader's map does);
    count:    number of rows per cell (the reference's "binary");
    binary:   1.0 for every filled cell (a true 0/1);
    rating:   Σ rating with missing rating = 3.0.
    """
    g = interactions.groupBy("user_id", "item_id")
    if value_type == "implicit":
        return g.agg(F.sum(event_weight("interaction_type", default=None)).alias("value"))
    if value_type == "count":
        return g.agg(F.count(F.lit(1)).cast("double").alias("value"))
    if value_type == "binary":
        return g.agg(F.lit(1.0).alias("value"))
    if value_type == "rating":
        return g.agg(F.sum(F.coalesce(F.col("rating"), F.lit(3.0))).alias("value"))
    raise ValueError(f"unknown value_type {value_type!r}")


def seen_pairs(interactions: DataFrame) -> DataFrame:
    """A14 in long form: distinct (user_id, item_id)."""
    return interactions.select("user_id", "item_id").where(F.col("item_id").isNotNull()).distinct()


def user_counts(interactions: DataFrame) -> DataFrame:
    """A5: interactions per user (rows, duplicates included)."""
    return interactions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_interactions"))


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach a one-row aggregate (e.g. a max or a grand total) to every row.

    The right side is a single row by construction, so broadcasting it is
    bounded; this replaces ``max(..) over ()``, which would pull every row into
    one task.
    """
    one = F.lit(1).alias("_one")
    return (df.select("*", one).join(F.broadcast(totals.select("*", one)), "_one").drop("_one"))
