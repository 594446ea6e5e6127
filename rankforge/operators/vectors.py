"""Vector operators on array columns (V2, V3) and in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Σ a_i * b_i of two equal-length numeric arrays (JVM-side higher-order functions)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """V3: cosine of two vectors; a zero norm gives 0."""
    na, nb = norm(a), norm(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def to_long(df: DataFrame, id_col: str, vec_col: str, keep: list[str] | None = None) -> DataFrame:
    """(id, pos, x) rows of an array column (1-based pos)."""
    keep = keep or []
    return df.select(id_col, *keep, F.posexplode(vec_col).alias("pos", "x")).select(
        id_col, *keep, (F.col("pos") + 1).alias("pos"), F.col("x").cast("double").alias("x"))


def cosine_to_centroid(df: DataFrame, id_col: str, vec_col: str, group: str) -> DataFrame:
    """V3 against each group's mean vector: (id, group, cosine).

    The centroid is a grouped mean per (group, position) with partial
    aggregation; the join back is on (group, position), the centroid side
    being one row per key.
    """
    lg = to_long(df, id_col, vec_col, [group])
    cen = lg.groupBy(group, "pos").agg(F.avg("x").alias("cx"))
    d = (lg.join(cen, [group, "pos"])
         .groupBy(id_col, group)
         .agg(F.sum(F.col("x") * F.col("cx")).alias("_dot"), F.sum(F.col("x") * F.col("x")).alias("_nx"),
              F.sum(F.col("cx") * F.col("cx")).alias("_nc")))
    return d.select(id_col, group, F.when((F.col("_nx") == 0) | (F.col("_nc") == 0), F.lit(0.0))
                    .otherwise(F.col("_dot") / (F.sqrt("_nx") * F.sqrt("_nc"))).alias("cosine"))


def pair_similarity(pairs: DataFrame, vectors: DataFrame, id_col: str = "item_id") -> DataFrame:
    """V2 for given pairs (id_a, id_b) over long vectors (id, feature, w); missing -> 0."""
    va = vectors.select(F.col(id_col).alias("id_a"), "feature", F.col("w").alias("w_a"))
    vb = vectors.select(F.col(id_col).alias("id_b"), "feature", F.col("w").alias("w_b"))
    shared = (pairs.select("id_a", "id_b").join(va, "id_a").join(vb, ["id_b", "feature"])
              .groupBy("id_a", "id_b").agg(F.sum(F.col("w_a") * F.col("w_b")).alias("sim")))
    return (pairs.select("id_a", "id_b").join(shared, ["id_a", "id_b"], "left")
            .select("id_a", "id_b", F.coalesce("sim", F.lit(0.0)).alias("sim")))
