"""Truncated SVD of the bias-centred user x item matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.factorize import top_scores, truncated_svd
from rankforge.operators.matrix import user_item_weights, with_totals
from rankforge.operators.ranking import top_n_per_group
from rankforge.operators.vectors import dot
from rankforge.plans.base import Recommender, as_users
from rankforge.session import materialize


def bias_terms(matrix: DataFrame):
    """A13 over filled cells: (global mean, user bias table, item bias table).

    Cells are Σ weight > 0; a bias is the mean of the row (column) minus the
    global mean.
    """
    cells = matrix.where(F.col("w") > 0)
    mu = cells.agg(F.avg("w").alias("mu"))
    ub = with_totals(cells.groupBy("user_id").agg(F.avg("w").alias("_m")), mu).select(
        "user_id", (F.col("_m") - F.col("mu")).alias("user_bias"))
    ib = with_totals(cells.groupBy("item_id").agg(F.avg("w").alias("_m")), mu).select(
        "item_id", (F.col("_m") - F.col("mu")).alias("item_bias"))
    return mu, ub, ib


def centered(matrix: DataFrame, mu: DataFrame, ub: DataFrame, ib: DataFrame) -> DataFrame:
    """M4: w - (mean + user bias + item bias) on filled cells only."""
    c = with_totals(matrix.where(F.col("w") > 0).join(ub, "user_id").join(ib, "item_id"), mu)
    return c.select("user_id", "item_id", "w",
                    (F.col("w") - (F.col("mu") + F.col("user_bias") + F.col("item_bias"))).alias("centered"))


class SVD(Recommender):
    name = "SVD"
    state = ("user_bias", "item_bias", "mean")

    def __init__(self, n_factors: int = 50, oversample: int = 20, tol: float = 1e-5, seed: int = 42):
        super().__init__()
        self.n_factors = n_factors
        self.oversample = oversample
        self.tol = tol
        self.seed = seed

    def fit(self, interactions, users=None, items=None):
        self.items = items
        self.matrix = materialize(user_item_weights(interactions))
        self.mean, self.user_bias, self.item_bias = bias_terms(self.matrix)
        c = centered(self.matrix, self.mean, self.user_bias, self.item_bias)
        counts = self.matrix.agg(F.countDistinct("user_id").alias("u"), F.countDistinct("item_id").alias("i")).first()
        self.k = max(0, min(self.n_factors, counts["u"] - 1, counts["i"] - 1))
        entries = c.select(F.col("user_id").alias("row"), F.col("item_id").alias("col"),
                           F.col("centered").alias("val"))
        u, v, sigma, residual = truncated_svd(entries, self.k, self.oversample, self.seed, self.tol)
        self.k = len(sigma)
        self.sigma, self.residual = sigma, residual
        self.user_factors = u.select(F.col("id").alias("user_id"), F.col("vec").alias("factors"))
        self.item_factors = v.select(F.col("id").alias("item_id"), F.col("vec").alias("factors"))
        self._fitted = True
        return self

    def singular_values(self) -> DataFrame:
        spark = self.matrix.sparkSession
        return spark.createDataFrame([(i, float(s)) for i, s in enumerate(self.sigma)], "factor int, sigma double")

    def residuals(self) -> DataFrame:
        """(factor, sigma, residual): |C v - sigma u| / sigma of each factor."""
        return self.matrix.sparkSession.createDataFrame(
            [(i, float(s), float(r)) for i, (s, r) in enumerate(zip(self.sigma, self.residual))],
            "factor int, sigma double, residual double")

    def _sigma_col(self):
        return F.array(*[F.lit(float(s)) for s in self.sigma]) if self.k else F.array().cast("array<double>")

    def predict(self, pairs: DataFrame) -> DataFrame:
        """M6: mean + bu + bi + (u ⊙ σ)·v; an unknown user or item gives the mean."""
        p = pairs.select("user_id", "item_id")
        uf = self.user_factors.select("user_id", F.col("factors").alias("_u"))
        vf = self.item_factors.select("item_id", F.col("factors").alias("_v"))
        j = (p.join(self.user_bias, "user_id", "left").join(self.item_bias, "item_id", "left")
             .join(uf, "user_id", "left").join(vf, "item_id", "left"))
        j = with_totals(j, self.mean)
        us = F.zip_with(F.col("_u"), self._sigma_col(), lambda a, b: a * b)
        known = F.col("user_bias").isNotNull() & F.col("item_bias").isNotNull()
        latent = F.coalesce(dot(us, F.col("_v")), F.lit(0.0))
        score = F.when(known, F.col("mu") + F.col("user_bias") + F.col("item_bias") + latent).otherwise(F.col("mu"))
        return j.select("user_id", "item_id", score.alias("score"))

    def predict_score(self, pairs: DataFrame) -> DataFrame:
        """M8: the prediction itself; an unknown user or item gives the mean."""
        self._validate_fitted()
        return self.predict(pairs)

    def predict_bias(self, pairs: DataFrame) -> DataFrame:
        """The bias part of M6 (SQL-checkable)."""
        p = pairs.select("user_id", "item_id")
        j = with_totals(p.join(self.user_bias, "user_id", "left").join(self.item_bias, "item_id", "left"), self.mean)
        known = F.col("user_bias").isNotNull() & F.col("item_bias").isNotNull()
        return j.select("user_id", "item_id",
                        F.when(known, F.col("mu") + F.col("user_bias") + F.col("item_bias"))
                        .otherwise(F.col("mu")).alias("score"))

    def recommend(self, users, n=10, exclude_seen=True):
        """M7 + J8: every known user against every item, blocked; unknown users get nothing."""
        self._validate_fitted()
        u = as_users(users).join(self.user_factors, "user_id").join(self.user_bias, "user_id")
        sig = self._sigma_col()
        u = with_totals(u, self.mean).select(
            "user_id", F.zip_with("factors", sig, lambda a, b: a * b).alias("vec"),
            (F.col("mu") + F.col("user_bias")).alias("offset"))
        if exclude_seen:
            s = self.matrix.groupBy("user_id").agg(F.count(F.lit(1)).cast("long").alias("s"))
            u = u.join(s, "user_id", "left").withColumn("s", F.coalesce("s", F.lit(0)).cast("long"))
        else:
            u = u.withColumn("s", F.lit(0).cast("long"))
        items = self.item_factors.join(self.item_bias, "item_id").select(
            "item_id", F.col("factors").alias("vec"), F.col("item_bias").alias("bias"))
        cand = top_scores(u, items, n)
        if exclude_seen:
            cand = cand.join(self.matrix.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
        return top_n_per_group(cand, "user_id", "score", n).select("user_id", "item_id", "score", "rank")

    def explain(self, pairs: DataFrame, top: int = 3) -> DataFrame:
        """Predicted score and the factors with the largest |u·σ·v| (5 ranked, ``top`` shown)."""
        p = pairs.select("user_id", "item_id")
        uf = self.user_factors.select("user_id", F.col("factors").alias("_u"))
        vf = self.item_factors.select("item_id", F.col("factors").alias("_v"))
        j = p.join(uf, "user_id", "left").join(vf, "item_id", "left")
        k = max(self.k, 1)
        cvec = F.zip_with(F.zip_with(F.col("_u"), self._sigma_col(), lambda x, y: x * y), F.col("_v"),
                          lambda x, y: x * y)
        contrib = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.struct(
            i.alias("factor"), F.element_at(cvec, i + 1).alias("contribution"),
            F.element_at(F.col("_u"), i + 1).alias("user_affinity"),
            F.element_at(F.col("_v"), i + 1).alias("item_loading")))
        contrib = F.when(F.col("_u").isNotNull() & F.col("_v").isNotNull() & F.lit(self.k > 0), contrib)
        ranked = F.array_sort(contrib, lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1)
                              .when(F.abs(a["contribution"]) < F.abs(b["contribution"]), 1)
                              .otherwise(a["factor"] - b["factor"]))
        shown = F.transform(F.slice(ranked, 1, min(5, top)), lambda s: F.struct(
            s["factor"].alias("factor"), F.round(s["contribution"], 4).alias("contribution"),
            F.round(s["user_affinity"], 4).alias("user_affinity"), F.round(s["item_loading"], 4).alias("item_loading")))
        pred = self.predict(p)
        return (j.select("user_id", "item_id", shown.alias("latent_factors"))
                .join(pred, ["user_id", "item_id"])
                .select("user_id", "item_id", F.round("score", 3).alias("predicted_score"), "latent_factors",
                        F.lit(self.n_factors).alias("n_factors"),
                        F.format_string("Based on %d latent taste dimensions, predicted fit: %.2f",
                                        F.lit(self.n_factors), F.round("score", 2)).alias("explanation_text")))

    def user_embedding(self, users: DataFrame) -> DataFrame:
        """V7: factors per user, NULL if unknown."""
        return as_users(users).join(self.user_factors, "user_id", "left")

    def item_embedding(self, items: DataFrame) -> DataFrame:
        return items.select("item_id").join(self.item_factors, "item_id", "left")

