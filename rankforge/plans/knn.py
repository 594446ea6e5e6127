"""M2 User-CF and M3 Item-CF (cosine kNN) with their explanations."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.listsums import packed_lists, sources, top_sums
from rankforge.operators.matrix import user_item_weights
from rankforge.operators.ranking import top_n_per_group
from rankforge.operators.similarity import cosine_pairs, top_neighbors
from rankforge.operators.skew import salt_sides
from rankforge.plans.base import Recommender, as_users
from rankforge.session import discard, materialize


def _fold_seen(cand: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Σ per (user, item) with the seen flag folded into the same aggregate.

    The seen pairs join the candidate stream as rows with ``_seen = 1``, so
    scoring and exclusion share one shuffle instead of an aggregate followed
    by an anti-join.
    """
    if seen is not None:
        cand = cand.unionByName(seen.select("user_id", "item_id", F.lit(0.0).alias("_num"),
                                            F.lit(0.0).alias("_den"), F.lit(1).alias("_seen")))
    return cand.groupBy("user_id", "item_id").agg(F.sum("_num").alias("_num"), F.sum("_den").alias("_den"),
                                                  F.max("_seen").alias("_seen"))


class UserCF(Recommender):
    """Score = Σ sim·w / Σ|sim| over the user's k nearest neighbours who have the item."""

    name = "User-CF"

    def __init__(self, k_neighbors: int = 50):
        super().__init__()
        self.k = k_neighbors
        # stored like the reference; cosine is the only metric it computes

    def fit(self, interactions, users=None, items=None):
        # A1 once per fit, shared by similarity, scoring and exclusion
        self.matrix = materialize(user_item_weights(interactions))
        self.items = items
        pairs = cosine_pairs(self.matrix, key="item_id", id_col="user_id")
        self.similarity = pairs.select(F.col("id_a").alias("user_id"), F.col("id_b").alias("other_user_id"),
                                       "dot", "sim")
        nb = top_neighbors(self.matrix, "item_id", "user_id", self.k)
        self.neighbors = nb.select(F.col("id_a").alias("user_id"), F.col("id_b").alias("neighbor_id"), "sim", "rank")
        self._fitted = True
        return self


    def scores(self, users: DataFrame, exclude_seen: bool = True) -> DataFrame:
        nb = self.neighbors.join(as_users(users), "user_id").select("user_id", "neighbor_id", "sim")
        m = self.matrix.select(F.col("user_id").alias("neighbor_id"), "item_id", "w")
        # a heavy neighbour (many items, in many lists) is split into salt buckets
        m, nb = salt_sides(m, nb, ["neighbor_id"], F.col("item_id"))
        cand = nb.join(m, ["neighbor_id", "_salt"]).select(
            "user_id", "item_id", (F.col("sim") * F.col("w")).alias("_num"), F.abs("sim").alias("_den"),
            F.lit(0).alias("_seen"))
        agg = _fold_seen(cand, self.matrix.join(as_users(users), "user_id") if exclude_seen else None)
        return agg.where((F.col("_den") > 0) & (F.col("_seen") == 0)).select(
            "user_id", "item_id", (F.col("_num") / F.col("_den")).alias("score"))

    @functools.cached_property
    def _histories(self):
        """The users' rows of the matrix as packed lists, written once."""
        return packed_lists(self.matrix, "user_id", "item_id", "w")

    def recommend(self, users, n=10, exclude_seen=True):
        """The first n of ``scores``; candidates are added up inside tasks, in rounds of users."""
        self._validate_fitted()
        u = materialize(as_users(users))
        near = materialize(self.neighbors.join(u, "user_id", "left_semi").select(
            F.col("user_id").alias("user"), F.col("neighbor_id").alias("via"), F.col("sim").alias("a")))
        seen = self._histories.withColumnRenamed("via", "user") if exclude_seen else None
        if seen is not None:
            seen = seen.join(u.select(F.col("user_id").alias("user")), "user", "left_semi")
        top = top_sums(near, self._histories, n, seen, mean=True)
        discard(near)
        return top.select(F.col("user").alias("user_id"), F.col("id").alias("item_id"), "score", "rank")

    def similar_users(self, users=None, n=10):
        nb = self.neighbors.where(F.col("rank") <= n)
        return nb.join(as_users(users), "user_id") if users is not None else nb

    def explain(self, pairs: DataFrame) -> DataFrame:
        """Among the 5 nearest neighbours, those who have the item.

        -> (user_id, item_id, n_similar_users, avg_similarity (of values rounded
        to 3), similar_users (first 3 by neighbour rank), total_neighbors).
        """
        p = pairs.select("user_id", "item_id")
        nb5 = self.neighbors.where(F.col("rank") <= 5)
        m = self.matrix.select(F.col("user_id").alias("neighbor_id"), "item_id", F.col("w").alias("strength"))
        contrib = (p.join(nb5, "user_id").join(m, ["neighbor_id", "item_id"])
                   .groupBy("user_id", "item_id")
                   .agg(F.count(F.lit(1)).alias("n_similar_users"),
                        F.avg(F.round("sim", 3)).alias("avg_similarity"),
                        F.slice(F.sort_array(F.collect_list(F.struct(
                            F.col("rank").alias("nr"), "neighbor_id", F.round("sim", 3).alias("similarity"),
                            "strength"))), 1, 3).alias("similar_users")))
        total = self.neighbors.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_neighbors"))
        return (p.join(contrib, ["user_id", "item_id"], "left").join(total, "user_id", "left")
                .select("user_id", "item_id",
                        F.coalesce("n_similar_users", F.lit(0)).alias("n_similar_users"),
                        "avg_similarity", "similar_users",
                        F.coalesce("total_neighbors", F.lit(0)).alias("total_neighbors")))


class ItemCF(Recommender):
    """Score = Σ over the user's items j of sim(j, i)·w_uj, over j's k neighbours."""

    name = "Item-CF"

    def __init__(self, k_neighbors: int = 30):
        super().__init__()
        self.k = k_neighbors

    def fit(self, interactions, users=None, items=None):
        self.matrix = materialize(user_item_weights(interactions))
        self.items = items
        pairs = cosine_pairs(self.matrix, key="user_id", id_col="item_id")
        self.similarity = pairs.select(F.col("id_a").alias("item_id"), F.col("id_b").alias("other_item_id"),
                                       "dot", "sim")
        nb = top_neighbors(self.matrix, "user_id", "item_id", self.k)
        self.neighbors = nb.select(F.col("id_a").alias("item_id"), F.col("id_b").alias("neighbor_id"), "sim", "rank")
        self._fitted = True
        return self


    def scores(self, users: DataFrame, exclude_seen: bool = True) -> DataFrame:
        hist = self.matrix.join(as_users(users), "user_id")
        nb = self.neighbors.select("item_id", "neighbor_id", "sim")
        # an item in very many histories is split into salt buckets (its k neighbours are copied)
        hist, nb = salt_sides(hist, nb, ["item_id"], F.col("user_id"))
        cand = hist.join(nb, ["item_id", "_salt"]).select(
            "user_id", F.col("neighbor_id").alias("item_id"), (F.col("sim") * F.col("w")).alias("_num"),
            F.lit(0.0).alias("_den"), F.lit(0).alias("_seen"))
        agg = _fold_seen(cand, self.matrix.join(as_users(users), "user_id") if exclude_seen else None)
        return agg.where(F.col("_seen") == 0).select("user_id", "item_id", F.col("_num").alias("score"))

    @functools.cached_property
    def _lists(self):
        """The items' neighbours as packed lists, written once."""
        return packed_lists(self.neighbors, "item_id", "neighbor_id", "sim")

    def _history(self, users) -> DataFrame:
        """(user, via, a): the users' cells, written."""
        own = self.matrix.join(users.select("user_id").distinct(), "user_id", "left_semi")
        return materialize(own.select(F.col("user_id").cast("long").alias("user"), F.col("item_id").cast("long").alias("via"),
                                      F.col("w").cast("double").alias("a")))

    def recommend(self, users, n=10, exclude_seen=True):
        """The first n of ``scores``; candidates are added up inside tasks, in rounds of users."""
        self._validate_fitted()
        hist = self._history(as_users(users))
        top = top_sums(hist, self._lists, n, via_seen=exclude_seen)
        discard(hist)
        return top.select(F.col("user").alias("user_id"), F.col("id").alias("item_id"), "score", "rank")

    def similar_items(self, items=None, n=10):
        nb = self.neighbors.where(F.col("rank") <= n)
        return nb.join(items.select("item_id"), "item_id") if items is not None else nb

    def explain(self, pairs: DataFrame) -> DataFrame:
        """The user's items having the target among their neighbours, top 3 by similarity.

        -> (user_id, item_id, source_item_id, similarity, engagement, src_rank).
        The reference sorts rounded similarities stably in history order; ties
        here break by source item id.
        """
        p = pairs.select("user_id", "item_id").distinct()
        asked = packed_lists(p.withColumn("_none", F.lit(0.0)), "user_id", "item_id", "_none").withColumnRenamed("via", "user")
        hist = self._history(p)

        def first(found):
            src = found.select(F.col("user").alias("user_id"), F.col("id").alias("item_id"), F.col("via").alias("source_item_id"),
                               F.round("val", 3).alias("similarity"), F.col("a").alias("engagement"))
            return top_n_per_group(src, ["user_id", "item_id"], "similarity", 3, id_col="source_item_id", rank_col="src_rank")

        out = sources(hist, self._lists, asked, 3, 0.0011, first)
        discard(hist, asked)
        return out
