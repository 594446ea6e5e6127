"""Ranking metrics for all users at once.

Every metric is a grouped aggregate over the hit table ``recs ⟕ relevant``:
one shuffle by user, no per-user Python loop.  A user's list has at most n
rows, so the one window used (running hits for AP) sorts n rows per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.matrix import with_totals
from rankforge.operators.skew import lookup, salt_sides
from rankforge.session import materialize

K_VALUES = (5, 10, 20)
EPS = 1e-10
RANKING_WORDS = ("precision", "recall", "f1", "ndcg", "hit_rate", "map")


def relevant_items(test: DataFrame) -> DataFrame:
    """Distinct test items per user."""
    return test.select("user_id", "item_id").where(F.col("item_id").isNotNull()).distinct()


def hit_table(recs: DataFrame, relevant: DataFrame) -> DataFrame:
    """(user_id, item_id, rank, hit) for every recommended pair."""
    rel = relevant.select("user_id", "item_id", F.lit(1).alias("_rel"))
    return (recs.select("user_id", "item_id", "rank").join(rel, ["user_id", "item_id"], "left")
            .select("user_id", "item_id", "rank", F.coalesce("_rel", F.lit(0)).alias("hit")))


def _idcg(k, n_rel):
    m = F.least(F.lit(k), n_rel)
    return F.aggregate(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), F.lit(0.0),
                       lambda acc, i: acc + F.when(m >= 1, F.lit(1.0) / F.log2(i + 1)).otherwise(F.lit(0.0)))


def per_user_metrics(recs: DataFrame, relevant: DataFrame, k_values=K_VALUES) -> DataFrame:
    """E2-E4 per evaluated user: wide row with precision@k ... ndcg@k and map.

    Users without recommendations are not evaluated (Q8); a user with no
    relevant items scores 0 on recall, ndcg and map.
    """
    h = hit_table(recs, relevant)
    w = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.withColumn("_cum", F.sum("hit").over(w))
    aggs = [F.sum(F.when(F.col("hit") == 1, F.col("_cum") / F.col("rank")).otherwise(F.lit(0.0))).alias("_ap")]
    for k in k_values:
        ink = F.col("rank") <= k
        aggs.append(F.sum(F.when(ink, F.col("hit")).otherwise(F.lit(0))).alias(f"_h{k}"))
        aggs.append(F.sum(F.when(ink & (F.col("hit") == 1), F.lit(1.0) / F.log2(F.col("rank") + 1))
                          .otherwise(F.lit(0.0))).alias(f"_dcg{k}"))
    per = h.groupBy("user_id").agg(*aggs)
    nrel = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    per = per.join(nrel, "user_id", "left").withColumn("n_relevant", F.coalesce("n_relevant", F.lit(0)))
    nr = F.col("n_relevant")
    cols = [F.col("user_id"), nr]
    for k in k_values:
        hk = F.col(f"_h{k}")
        p = hk / F.lit(float(k))
        r = F.when(nr == 0, F.lit(0.0)).otherwise(hk / nr)
        cols += [p.alias(f"precision@{k}"), r.alias(f"recall@{k}"),
                 F.when(p + r == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r)).alias(f"f1@{k}"),
                 F.when(nr == 0, F.lit(0.0)).otherwise(F.col(f"_dcg{k}") / _idcg(k, nr)).alias(f"ndcg@{k}"),
                 F.when(hk > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"hit_rate@{k}")]
    cols.append(F.when(nr == 0, F.lit(0.0)).otherwise(F.col("_ap") / nr).alias("map"))
    return per.select(*cols)


def metric_names(k_values=K_VALUES) -> list[str]:
    out = []
    for k in k_values:
        out += [f"precision@{k}", f"recall@{k}", f"f1@{k}", f"ndcg@{k}", f"hit_rate@{k}"]
    return out + ["map"]


def to_long(wide: DataFrame, id_cols: list[str], names: list[str]) -> DataFrame:
    """Unpivot metric columns to (id..., metric, value)."""
    return wide.unpivot(id_cols, names, "metric", "value")


def ndcg_graded(recs: DataFrame, relevance: DataFrame, k: int = 10) -> DataFrame:
    """E4 with graded relevance (user_id, item_id, rel): DCG / ideal DCG over the top k rels.

    The ideal order is the user's relevance values sorted descending; only the
    first k are needed, so the window keeps k rows per user (group limit).
    """
    hits = recs.where(F.col("rank") <= k).join(relevance, ["user_id", "item_id"])
    dcg = hits.groupBy("user_id").agg(F.sum(F.col("rel") / F.log2(F.col("rank") + 1)).alias("_dcg"))
    w = Window.partitionBy("user_id").orderBy(F.col("rel").desc(), F.col("item_id"))
    ideal = (relevance.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= k)
             .groupBy("user_id").agg(F.sum(F.col("rel") / F.log2(F.col("_i") + 1)).alias("_idcg")))
    users = recs.select("user_id").distinct()
    out = users.join(dcg, "user_id", "left").join(ideal, "user_id", "left")
    return out.select("user_id", F.when(F.coalesce("_idcg", F.lit(0.0)) == 0, F.lit(0.0))
                      .otherwise(F.coalesce("_dcg", F.lit(0.0)) / F.col("_idcg")).alias("ndcg"))


def list_diversity(recs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Mean (1 - cos) over the pairs of a user's list, without forming pairs.

    With unit vectors u_i, Σ_{i<j} cos = (‖Σ u_i‖² - m) / 2, so the mean over
    the m(m-1)/2 pairs comes from one grouped sum per (user, feature).  Items
    without a vector are skipped; a list of fewer than 2 items, or fewer than 2
    vectors, scores 0.  ``vectors`` is the long, L2-normalised (item_id, feature, w).  ``recs`` is read several times:
    a written table is best.
    """
    packed = vectors.groupBy("item_id").agg(F.collect_list(F.struct("feature", "w")).alias("_f"))   # an item's few features
    # only an item in very many lists is copied, once per salt bucket
    left, right = salt_sides(recs.select("user_id", "item_id"), packed, ["item_id"], F.col("user_id"))
    r = left.join(right.hint("merge"), ["item_id", "_salt"], "left")
    lens = r.groupBy("user_id").agg(F.count(F.lit(1)).alias("_len"), F.count("_f").alias("_m"))
    s2 = (r.select("user_id", F.explode("_f").alias("_x")).groupBy("user_id", F.col("_x.feature").alias("_k"))
          .agg(F.sum("_x.w").alias("_s")).groupBy("user_id").agg(F.sum(F.col("_s") * F.col("_s")).alias("_sq")))
    d = lens.join(s2, "user_id", "left")
    mm = F.coalesce(F.col("_m"), F.lit(0))
    pairs = mm * (mm - 1) / 2
    sum_cos = (F.col("_sq") - mm) / 2
    return d.select("user_id", F.when((F.col("_len") < 2) | (mm < 2), F.lit(0.0))
                    .otherwise((pairs - sum_cos) / pairs).alias("diversity"))


def list_novelty(recs: DataFrame, popularity: DataFrame) -> DataFrame:
    """Mean of -log2(share + 1e-10); an unknown item has share 1e-10."""
    p = popularity.select("item_id", F.col("share"))
    j = lookup(recs.select("user_id", "item_id"), p, "item_id", shuffled=True)
    nov = -F.log2(F.coalesce(F.col("share"), F.lit(EPS)) + F.lit(EPS))
    return j.groupBy("user_id").agg(F.avg(nov).alias("novelty"))


def catalog_coverage(recs: DataFrame, items: DataFrame) -> DataFrame:
    """E5 + U4: distinct recommended items / catalog size (0 if the catalog is empty)."""
    rec = recs.agg(F.countDistinct("item_id").alias("_r"))
    cat = items.agg(F.countDistinct("item_id").alias("_c"))
    return with_totals(rec, cat).select(
        F.when(F.col("_c") == 0, F.lit(0.0)).otherwise(F.col("_r") / F.col("_c")).alias("coverage"))


def evaluate_recs(recs: DataFrame, test: DataFrame, items: DataFrame | None = None,
                  popularity: DataFrame | None = None, vectors: DataFrame | None = None,
                  k_values=K_VALUES) -> DataFrame:
    """Mean of every per-user metric over evaluated users -> (metric, value, n_users_evaluated).

    ``popularity`` (item_id, share) adds novelty, ``vectors`` adds diversity
    (Q20: the comparison passes them), ``items`` adds coverage.
    """
    # the list (users x n rows) feeds four aggregates: compute it once, cut lineage
    recs = materialize(recs.select("user_id", "item_id", "rank"))
    rel = relevant_items(test)
    per = per_user_metrics(recs, rel, k_values)
    names = metric_names(k_values)
    if vectors is not None:
        per = per.join(list_diversity(recs, vectors), "user_id", "left")
        names.append("diversity")
    if popularity is not None:
        per = per.join(list_novelty(recs, popularity), "user_id", "left")
        names.append("novelty")
    means = per.agg(*[F.avg(F.col(f"`{n}`")).alias(n) for n in names],
                    F.count(F.lit(1)).alias("n_users_evaluated"))
    if items is not None:   # one-row tables side by side, then a single unpivot
        means = with_totals(means, catalog_coverage(recs, items))
        names.append("coverage")
    return to_long(means, ["n_users_evaluated"], names).select("metric", "value", "n_users_evaluated")


def metric_report(metrics: DataFrame) -> DataFrame:
    """Metrics grouped into ranking / beyond-accuracy, sorted by name, with text lines."""
    name = F.col("metric")
    is_rank = None
    for wd in RANKING_WORDS:
        c = name.contains(wd)
        is_rank = c if is_rank is None else (is_rank | c)
    return metrics.select(
        F.when(is_rank, "Ranking Metrics").otherwise("Beyond-Accuracy Metrics").alias("section"),
        "metric", "value",
        F.concat(F.lit("  "), F.rpad(name, 25, " "), F.lit(" "), F.format_number(F.col("value"), 4)).alias("line"))
