"""Common model contract (the reference's abstract recommender, Spark-side).

``fit`` returns the model holding DataFrames; ``recommend(users, n,
exclude_seen)`` answers for every row of ``users`` at once and returns
``(user_id, item_id, score, rank)``.  One user is a one-row ``users``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.session import materialize


class Recommender:
    name = "Base"

    def __init__(self):
        self._fitted = False

    # --- contract ---------------------------------------------------------
    def fit(self, interactions: DataFrame, users: DataFrame | None = None,
            items: DataFrame | None = None) -> "Recommender":
        raise NotImplementedError

    def recommend(self, users: DataFrame, n: int = 10, exclude_seen: bool = True) -> DataFrame:
        raise NotImplementedError

    def scores(self, users: DataFrame, exclude_seen: bool = False) -> DataFrame:
        """Unlimited (user_id, item_id, score) list; used by ``predict_score``."""
        raise NotImplementedError

    def predict_score(self, pairs: DataFrame) -> DataFrame:
        """M8: score of each (user_id, item_id) in the user's full list, else 0."""
        self._validate_fitted()
        s = self.scores(pairs.select("user_id").distinct(), exclude_seen=False)
        return (pairs.join(s, ["user_id", "item_id"], "left")
                .select("user_id", "item_id", F.coalesce(F.col("score"), F.lit(0.0)).alias("score")))

    def batch_recommend(self, users: DataFrame, n: int = 10, exclude_seen: bool = True) -> DataFrame:
        """M9: the native form of every model."""
        return self.recommend(users, n, exclude_seen)

    def similar_users(self, users: DataFrame | None = None, n: int = 10) -> DataFrame:
        return None

    def similar_items(self, items: DataFrame | None = None, n: int = 10) -> DataFrame:
        return None

    state = ()   # attribute names of the fitted tables worth keeping

    def state_tables(self) -> list[DataFrame]:
        return [getattr(self, a) for a in self.state]

    def materialize(self) -> "Recommender":
        """Compute the fitted state once and cut its lineage (reliable checkpoint).

        The checkpoint lives in the shared ``spark.checkpoint.dir``, so a lost
        executor does not lose it, and later plans start from it instead of
        re-deriving the whole fit.
        """
        for a in self.state:
            setattr(self, a, materialize(getattr(self, a)))
        return self

    def _validate_fitted(self):
        if not self._fitted:
            raise RuntimeError(f"{self.name} must be fitted before use")


def as_users(users) -> DataFrame:
    """Accept a DataFrame with ``user_id``; keep only that column, distinct."""
    return users.select(F.col("user_id").cast("long").alias("user_id")).distinct()
