"""Deterministic ranking helpers.

Order is always ``round(score, 9) DESC, id ASC`` (Q6), so Spark and any other
engine tie-break the same way whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.exprs import rank_key
from rankforge.session import materialize


def top_n_per_group(df: DataFrame, group: str | list[str], score: str, n: int | None,
                    id_col: str = "item_id", rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows per group (all if ``n`` is None) and number them.

    ``row_number() <= n`` is turned by Catalyst into a window group limit that
    also runs before the shuffle, so only n rows per group and partition move.
    """
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(rank_key(F.col(score)).desc(), F.col(id_col).asc())
    out = df.withColumn(rank_col, F.row_number().over(w))
    if n is not None:
        out = out.where(F.col(rank_col) <= n)
    return out


_LOCAL = (1 << 33) - 1      # monotonically_increasing_id: partition above, position in it below


def _positioned(df: DataFrame, order: list, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned on ``order`` with ``_p`` (range) and ``_l`` (0-based place in it), written once.

    Everything that follows reads this one table, so range totals and places
    always belong to the same partitioning, whatever columns a reader prunes.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_id", F.monotonically_increasing_id()))
    return materialize(ranged.withColumn("_p", F.shiftright("_id", 33).cast("int"))
                       .withColumn("_l", F.col("_id").bitwiseAND(F.lit(_LOCAL))).drop("_id"))


def _range_offsets(placed: DataFrame, value: Column) -> DataFrame:
    """(_p, _off): the total of ``value`` in all earlier ranges; one row per range."""
    totals = placed.groupBy("_p").agg(F.sum(value).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))


def running_total(df: DataFrame, order: list, value: Column, out_col: str,
                  inclusive: bool = True, partitions: int | None = None) -> DataFrame:
    """Σ value over all rows ordered before (and, if ``inclusive``, at) each row.

    Exact and distributed: one range partitioning, sums inside each range, plus
    the totals of the earlier ranges (one row per range, broadcast).
    """
    placed = _positioned(df.withColumn("_v", value), order, partitions)
    w_in = Window.partitionBy("_p").orderBy("_l").rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    local = placed.withColumn("_r", F.coalesce(F.sum("_v").over(w_in), F.lit(0)))
    out = local.join(F.broadcast(_range_offsets(placed, F.col("_v"))), "_p")
    return out.withColumn(out_col, F.col("_off") + F.col("_r")).drop("_p", "_l", "_r", "_off", "_v")


def global_rank(df: DataFrame, order: list, rank_col: str = "rank",
                partitions: int | None = None, kind: str = "int") -> DataFrame:
    """Exact 1..m row number over the whole table: the place in its range plus the sizes of earlier ranges."""
    placed = _positioned(df, order, partitions)
    out = placed.join(F.broadcast(_range_offsets(placed, F.lit(1))), "_p")
    return out.withColumn(rank_col, (F.col("_off") + F.col("_l") + 1).cast(kind)).drop("_p", "_l", "_off")


def rank_by_score(df: DataFrame, score: str, id_col: str, rank_col: str = "rank") -> DataFrame:
    """Global 1..m position by (round(score, 9) desc, id asc)."""
    return global_rank(df, [rank_key(F.col(score)).desc(), F.col(id_col).asc()], rank_col)


def dense_index(df: DataFrame, id_col: str, index_col: str) -> DataFrame:
    """0-based position of each distinct id in ascending order."""
    d = df.select(id_col).distinct()
    r = global_rank(d, [F.col(id_col).asc()], "_rk")
    return r.select(id_col, (F.col("_rk") - 1).alias(index_col))


def group_rank(df: DataFrame, groups: list[str], order: list, rank_col: str = "rank",
               partitions: int | None = None) -> DataFrame:
    """Exact 1..m row number within each group, safe for a group holding most rows.

    One range partitioning on (groups, order) spreads a large group over several
    ranges; a row's number is its place in the range, less where its group begins
    there, plus the rows of its group in earlier ranges (at most one row per
    range and group).
    """
    placed = _positioned(df, [*[F.col(g) for g in groups], *order], partitions)
    part = placed.groupBy("_p", *groups).agg(F.min("_l").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = part.select(F.col("_p").alias("_q"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                       (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    same = F.col("_p") == F.col("_q")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))      # rows without a group form one
    out = placed.join(offs, same)
    return (out.withColumn(rank_col, (F.col("_off") + F.col("_l") + 1).cast("int"))
            .drop("_p", "_l", "_q", "_off", *[f"_g{i}" for i in range(len(groups))]))
