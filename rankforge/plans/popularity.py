"""Time-decayed popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.exprs import event_weight, rank_key, time_decay
from rankforge.operators.candidates import first_unseen
from rankforge.operators.listsums import in_user_rounds
from rankforge.operators.matrix import seen_pairs, with_totals
from rankforge.operators.ranking import rank_by_score, running_total
from rankforge.plans.base import Recommender, as_users
from rankforge.session import materialize


class Popularity(Recommender):
    name = "Popularity"

    def __init__(self, as_of: str, time_decay_days: float = 30, use_time_decay: bool = True):
        super().__init__()
        self.as_of = as_of
        self.time_decay_days = time_decay_days
        self.use_time_decay = use_time_decay

    def fit(self, interactions: DataFrame, users: DataFrame | None = None,
            items: DataFrame | None = None) -> "Popularity":
        decay = (time_decay("ts", self.as_of, self.time_decay_days) if self.use_time_decay else F.lit(1.0))
        raw = (interactions.groupBy("item_id")
               .agg(F.sum(event_weight("interaction_type") * decay).alias("raw_score")))
        top = raw.agg(F.max("raw_score").alias("_max"))
        self.item_scores = materialize(with_totals(raw, top).select(
            "item_id", "raw_score", (F.col("raw_score") / F.nullif(F.col("_max"), F.lit(0.0))).alias("score")))
        self.seen = materialize(seen_pairs(interactions))
        self.n_seen = self.seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("s"))
        self.items = items
        self._fitted = True
        return self

    # --- ranked lists --------------------------------------------------------
    def _list(self, category: str | None = None) -> DataFrame:
        """(item_id, score) of the catalog, or of ``category`` (J1 inner join)."""
        s = self.item_scores
        if category is not None and self.items is not None:
            in_cat = s.join(self.items.where(F.col("category") == F.lit(category)).select("item_id"), "item_id")
            # Q14: a category without a scored item falls back silently to the global list
            if not in_cat.isEmpty():
                s = in_cat
        return s.select("item_id", "score")

    def ranked(self, category: str | None = None) -> DataFrame:
        """(item_id, score, rank) globally, or within ``category``."""
        return rank_by_score(self._list(category), "score", "item_id")

    def category_scores(self) -> DataFrame:
        """A3: (category, item_id, score), items missing from the catalog dropped."""
        return self.item_scores.join(self.items.select("item_id", "category"), "item_id")

    def recommend(self, users: DataFrame, n: int = 10, exclude_seen: bool = True,
                  category: str | None = None) -> DataFrame:
        self._validate_fitted()
        return self._first(as_users(users), self.ranked(category), n, exclude_seen)

    def _first(self, users: DataFrame, ranked: DataFrame, n: int, exclude_seen: bool, own=None) -> DataFrame:
        """The users' first n items of ``ranked``; ``own``: a condition on ``user_id`` that all of them meet."""
        seen = self.seen if own is None else self.seen.where(own)
        if exclude_seen:
            u = users.join(seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("s")), "user_id", "left")
        else:
            u = users.withColumn("s", F.lit(0))
        return first_unseen(u, ranked, seen if exclude_seen else None, n)

    def written_lists(self, users: DataFrame, n: int, exclude_seen: bool = True) -> DataFrame:
        """``recommend``, written in rounds of users."""
        self._validate_fitted()
        u, ranked = materialize(as_users(users)), materialize(self.ranked())
        return in_user_rounds(u, self.seen.count(), lambda some, own: self._first(some, ranked, n, exclude_seen, own))

    def trending(self, n: int = 10, category: str | None = None) -> DataFrame:
        """K7: top n without a user (no exclusion): a take of n, no rank of the whole catalog."""
        first = self._list(category).orderBy(rank_key(F.col("score")).desc(), F.col("item_id").asc()).limit(n)
        # n rows are left for this window
        return first.withColumn("rank", F.row_number().over(
            Window.orderBy(rank_key(F.col("score")).desc(), F.col("item_id").asc()))).select("item_id", "score", "rank")

    def predict_score(self, pairs: DataFrame) -> DataFrame:
        """M8: the pair's score in the global list, else 0 (no users x items)."""
        return (pairs.select("user_id", "item_id")
                .join(self.item_scores.select("item_id", "score"), "item_id", "left")
                .select("user_id", "item_id", F.coalesce(F.col("score"), F.lit(0.0)).alias("score")))

    def popularity_rank(self, items: DataFrame) -> DataFrame:
        """1 + number of strictly higher scores; an item without score gets 0.0."""
        s = self.item_scores.select("score")
        by_score = s.groupBy("score").agg(F.count(F.lit(1)).alias("_c"))
        higher = running_total(by_score, [F.col("score").desc()], F.col("_c"), "_higher", inclusive=False)
        total = self.item_scores.agg(F.count(F.lit(1)).alias("total_items"))
        zero_rank = s.where(F.col("score") > 0).agg(F.count(F.lit(1)).alias("_above_zero"))
        q = items.select("item_id").join(self.item_scores.select("item_id", "score"), "item_id", "left")
        q = q.join(higher.select("score", "_higher"), "score", "left")
        q = with_totals(with_totals(q, total), zero_rank)
        return q.select("item_id",
                        F.coalesce(F.col("score"), F.lit(0.0)).alias("score"),
                        (F.lit(1) + F.when(F.col("score").isNull(), F.col("_above_zero"))
                         .otherwise(F.col("_higher"))).cast("int").alias("popularity_rank"),
                        F.col("total_items"))
