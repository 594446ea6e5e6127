"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle 1994).

A profile lists the ``TOP`` most frequent n-grams (1 to ``ORDER`` characters,
words padded with a blank) in order; equal counts are ordered by key.  The
language of a text is the one whose profile has the smallest out-of-place
distance to the text's own profile, over the whole text: each of the text's
n-grams adds the difference of its two ranks, or ``TOP`` when the language lacks
it.  Equal distances go to the first language by name.

Profiles are learned from at most ``per_lang`` distinct labelled texts of each
language, chosen by a hash of the id, and are broadcast: ``TOP`` entries per
language.  Prediction is one map-side pass.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text when nothing was learned.  The score is 1 minus the distance
over the largest possible one.  Letters are those of Unicode, in lower case.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import HashTable, mix64, slices, stable

TOP = 300
ORDER = 4
PER_LANG = 2000
SLICE_BYTES = 250_000       # texts handled together
_ALPHA = None


def _letters() -> np.ndarray:
    global _ALPHA
    if _ALPHA is None:
        _ALPHA = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _ALPHA


def ngram_keys(text: str, order: int = ORDER) -> np.ndarray | None:
    """Keys of all n-grams of a text with repeats; None without a letter."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    alpha = _letters()[code]
    if not alpha.any():
        return None
    # runs of other characters become one blank, and the text is padded
    code = np.where(alpha, code, 32)
    keep = alpha.copy()
    keep[1:] |= alpha[:-1]
    code = np.concatenate([[32], code[keep], [32]]).astype(np.uint64)
    if code[1] == 32:
        code = code[1:]
    if code[-2] == 32:
        code = code[:-1]
    gap = code == 32
    out = []
    key = np.zeros(len(code), np.uint64)
    whole = np.ones(len(code), bool)                  # no blank strictly inside
    for n in range(1, order + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        if n > 2:
            whole = whole[:m] & ~gap[n - 2:n - 2 + m]
        key = key[:m] * np.uint64(0x100000001B3) + code[n - 1:n - 1 + m] + np.uint64(1)
        pick = ~gap if n == 1 else ~gap[:m] | ~gap[n - 1:n - 1 + m] if n == 2 else whole
        out.append(mix64(key[pick] ^ np.uint64(n << 56)))
        if n == 2:
            whole = np.ones(m, bool)
    return np.concatenate(out)


def profile(keys: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent keys in order; equal counts by key."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n = np.diff(np.append(at, len(keys)))
    if len(at) > top:                                 # a cut that keeps all ties, before the ordering
        least = np.partition(n, len(n) - top)[len(n) - top]
        at, n = at[n >= least], n[n >= least]
    return keys[at[np.argsort(-n, kind="stable")[:top]]]


def added(counts: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, counts) with the keys of one more text."""
    key, n = np.unique(keys, return_counts=True)
    if counts is None:
        return key, n
    both, back = np.unique(np.concatenate([counts[0], key]), return_inverse=True)
    return both, np.bincount(back, np.concatenate([counts[1], n]), minlength=len(both)).astype(np.int64)


class Profiles:
    def __init__(self, langs: list[str], grams: dict[str, list[int]], top: int = TOP):
        self.langs, self.top = langs, top
        keys = np.unique(np.array([k for g in grams.values() for k in g], np.int64).astype(np.uint64))
        self.rank = np.full((len(keys) + 1, len(langs)), -1, np.int32)      # last row: n-grams no language has
        for j, lang in enumerate(langs):
            own = np.array(grams[lang], np.int64).astype(np.uint64)
            self.rank[np.searchsorted(keys, own), j] = np.arange(len(own))
        self.table = HashTable(keys, np.arange(len(keys)), len(keys))

    def predict(self, text: str | None) -> tuple[str, float]:
        keys = ngram_keys(text) if text and self.langs else None
        if keys is None:
            return "und", 0.0
        own = profile(keys, self.top)
        rank = self.rank[self.table.get(own)]
        away = np.where(rank < 0, self.top, np.abs(rank - np.arange(len(own))[:, None])).sum(0)
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (self.top * len(own)))


def learn(docs: DataFrame, per_lang: int = PER_LANG, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id", top: int = TOP) -> Profiles:
    """Profiles from the given rows with a language (the caller leaves out held-out rows)."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .where("lang IS NOT NULL AND text IS NOT NULL")
    n = {r.lang: r.n for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for lang, c in n.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_lang / c)).otherwise(share)
    draw = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    sample = own.where(draw < share).select("lang", "text", F.xxhash64("text").alias("h"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                by: dict[str, tuple[np.ndarray, np.ndarray]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    keys = ngram_keys(text)
                    if keys is not None:
                        by[lang] = added(by.get(lang), keys)
                for lang, (key, c) in by.items():
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.astype(np.int64)),
                                                      pa.array(c, pa.int64())], ["lang", "key", "n"])

    grams = sample.dropDuplicates(["lang", "h"]).mapInArrow(run, "lang string, key long, n long") \
        .groupBy("lang", "key").agg(F.sum("n").alias("n"))
    # keys are unsigned: order them as such
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.expr("key < 0"), "key")
    best = stable(grams.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top))
    found: dict[str, list[int]] = {}
    for r in best.orderBy("lang", "r").collect():                          # top rows per language
        found.setdefault(r.lang, []).append(r.key)
    return Profiles(sorted(found), found, top)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        p = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                got = [p.predict(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([g[0] for g in got], pa.string()),
                                                  pa.array([g[1] for g in got], pa.float64())], ["id", "lang_pred", "score"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, lang_pred string, score double")
