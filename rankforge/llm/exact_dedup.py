"""Exact duplicates by a heavy-hitter split (DataFrame functions only).

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``; the SHA-256 of the normalised text stands for it.

1. Misra-Gries counters (``freqItems``, at most 1/support of them per task)
   propose frequent digests; an exact count verifies them.
2. The winners of the verified digests, at most 1/support rows whatever the
   data, are broadcast, and rows of those digests are settled on the map side.
3. All other digests, each under ``support`` of the rows, are aggregated and
   joined by an ordinary shuffle.

Defined results: null text is the empty text, and empty texts form one group;
of equal texts the longest original stays, then the smallest id, a null id
last, and of repeated rows exactly one; an empty table gives an empty result.
Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import stable

BLANKS = " \t\n\x0b\x0c\r"
SUPPORT = 0.001


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, chars) per row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256).alias("digest"),
                       F.char_length(text).cast("long").alias("chars"))


def _winners(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("none"), "id", "rid"))
    return rows.groupBy("digest").agg(first.alias("w"), F.count("*").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                support: float = SUPPORT) -> DataFrame:
    """One row per input row: id, digest, chars, keep_id, group_size, kept."""
    rows = stable(digests(docs, id_col, text_col).withColumn("rid", F.monotonically_increasing_id()))
    offered = rows.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    floor = max(2.0, rows.count() * support)
    heavy = stable(_winners(rows.join(F.broadcast(offered), "digest", "left_semi")).where(F.col("group_size") >= floor))
    split = rows.join(F.broadcast(heavy), "digest", "left")
    settled = split.where("w IS NOT NULL")
    light = split.where("w IS NULL").select(rows.columns)
    rest = light.join(_winners(light), "digest")
    return settled.select(rest.columns).unionByName(rest).select(
        "id", "digest", "chars", F.col("w.id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("w.rid")).alias("kept"))


def row_key(id_col, digest, chars):
    return F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("~")), digest, chars.cast("string"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    names = docs.columns
    kept = exact_dedup(docs, id_col, text_col, support).where("kept")
    keys = kept.select(row_key(F.col("id"), F.col("digest"), F.col("chars")).alias("__key"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select("*", row_key(F.col(id_col), F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256),
                                   F.char_length(text)).alias("__key"))
    # winners only: the key is unique but for repeated rows, which the shuffle of the join has brought together
    return own.join(keys, "__key", "left_semi").dropDuplicates(["__key"]).select(names)
