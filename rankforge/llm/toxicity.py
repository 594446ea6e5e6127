"""Toxicity by maximum-scoring segments of token log-odds.

Fit (on a bounded, documented sample of labelled rows: at most ``per_class``
distinct texts of each class, chosen by a hash of the id):

* every word gets the log-odds of standing in a toxic against a clean text
  (toxic texts count at most once for each different word it follows there, so
  that near copies and shared passages do not add up), with a Dirichlet prior
  of ``KAPPA`` pseudo-texts at the sample's share; log-odds within
  ``SIGNIFICANT`` posterior deviations are dropped, and a word that the sample
  lacks gets the log-odds of its opening bytes;
* a token scores its log-odds less ``DRIFT``, so ordinary prose has negative
  drift, and all maximal scoring segments (Ruzzo and Tompa) of a text are
  found in time linear in its tokens;
* a segment is put on the extreme-value scale of clean texts: with lambda from
  the scores of all clean tokens and K by maximum likelihood, lambda * score -
  ln(K * tokens) is minus the logarithm of how many such segments a clean text
  of that length would hold by chance.  Segments that a clean text would hold
  less than ``CHANCE`` times are significant; a text's statistic is the sum over its
  significant passages, or its best segment where none is significant.  Chance
  segments therefore do not add up, however long a clean text is;
* a logistic curve turns the statistic into a probability; it and the scale are
  fitted across two folds so that no text is judged by counts it is part of.

Scoring is one map-side pass over whole texts with the broadcast lexicon, whose
size is bounded by the sample.

Tokens are maximal runs of letters A-Z and non-ASCII bytes, with A-Z and the
Latin-1 capitals lowered.  Defined results: null is the empty text, which has
no passage and gets the score of a text without one; without labels of both
classes every score is the share of toxic labels (0 without labels); repeated
rows are scored alike; repeated labels of an id count once, as toxic if one is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import HashTable, crc_mod, discard, plain_words, slices, span_hashes, stable, texts_of

PER_CLASS = 10_000
KAPPA = 5.0
DRIFT = 1.0
SIGNIFICANT = 3.0      # deviations
OPENING = 5            # bytes
THRESHOLD = 0.3
CHANCE = 0.05          # expected number in a clean text of the same length


def keys_of(data, start, end) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of whole words and of their opening bytes."""
    return span_hashes(data, start, end), span_hashes(data, start, np.minimum(end, start + OPENING))


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, past, score) in linear time (Ruzzo and Tompa 1999)."""
    up = np.flatnonzero(score > 0)
    if not len(up):
        return []
    total = np.concatenate([[0.0], np.cumsum(score)])
    found: list[list] = []                       # [first, past, sum before, sum after]
    for i in up.tolist():                        # tokens without a positive score only lower the sums
        new = [i, i + 1, total[i], total[i + 1]]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]                  # nearest earlier one with a lower start; skips are not revisited
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(f[0], f[1], float(f[3] - f[2])) for f in found]


@dataclass
class Model:
    words: HashTable
    openings: HashTable
    scale: float = 1.0        # lambda
    k: float = 1.0            # K
    slope: float = 1.0
    shift: float = 0.0
    prior: float | None = None
    drift: float = DRIFT
    top: float = 0.0          # highest score of a token

    def token_scores(self, data, start, end) -> np.ndarray:
        word, opening = keys_of(data, start, end)
        s = self.words.get(word)
        miss = np.flatnonzero(np.isnan(s))
        s[miss] = self.openings.get(opening[miss])
        return np.nan_to_num(s, nan=0.0) - self.drift

    def passages(self, texts: list[str]):
        """Per text: (segments with first and past byte and score, number of tokens)."""
        data, start, end, upto, first = plain_words(texts)
        score = self.token_scores(data, start, end)
        out = []
        for k in range(len(texts)):
            a, b = int(upto[k]), int(upto[k + 1])
            own = score[a:b]
            seg = maximal_segments(own) if b > a and own.max() > 0 else []
            out.append(([(int(start[a + i] - first[k]), int(end[a + j - 1] - first[k]), s) for i, j, s in seg], b - a))
        return out

    def statistic(self, scores, n: int) -> float:
        """Sum over the significant segment scores, or the best one, each on the extreme-value scale of ``n`` tokens."""
        space = math.log1p(self.k * n)
        own = [self.scale * s - space for s in scores]
        sure = [x for x in own if x >= -math.log(CHANCE)]
        return sum(sure) if sure else max(own, default=-space)

    def significant(self, segments, n: int) -> list:
        """The segments that a clean text of ``n`` tokens would hold less than ``CHANCE`` times."""
        least = (math.log1p(self.k * n) - math.log(CHANCE)) / self.scale
        return [s for s in segments if s[2] >= least]

    def probability(self, x: float) -> float:
        if self.prior is not None:
            return self.prior
        z = self.slope * x + self.shift
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def sample_labels(labels: DataFrame, per_class: int, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(id, y): at most about ``per_class`` ids of each class, by a hash of the id."""
    one = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
           .groupBy("id").agg(F.max("y").alias("y")).where(crc_mod("id", 4) != 2))
    n = {r.y: r.n for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for y, c in n.items():
        share = F.when(F.col("y") == y, min(1.0, per_class / c)).otherwise(share)
    draw = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    return one.where(draw < share)


def _count(sample: DataFrame) -> DataFrame:
    """(fold, y, kind, key, n): distinct words and openings of each text, kind 0 and 1; kind 2 counts texts."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, start, end, upto, _ = plain_words(texts_of(part.column("text")))
                doc = np.repeat(np.arange(part.num_rows), np.diff(upto))
                fold, y = (part.column(c).to_numpy() for c in ("fold", "y"))
                cols = [[], [], [], [], []]
                for kind, key in enumerate(keys_of(data, start, end)):
                    pair = np.unique(np.rec.fromarrays([doc, key], names="d,k"))
                    cls = fold[pair.d] * 2 + y[pair.d]
                    got, n = np.unique(np.rec.fromarrays([cls, pair.k], names="c,k"), return_counts=True)
                    for col, v in zip(cols, (got.c // 2, got.c % 2, np.full(len(got), kind), got.k.astype(np.int64), n)):
                        col.append(v.astype(np.int64))
                cls, n = np.unique(fold * 2 + y, return_counts=True)
                for col, v in zip(cols, (cls // 2, cls % 2, np.full(len(cls), 2), np.zeros(len(cls)), n)):
                    col.append(v.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in cols],
                                                 ["fold", "y", "kind", "key", "n"])
    found = sample.mapInArrow(run, "fold long, y long, kind long, key long, n long")
    by = [F.sum(F.when((F.col("fold") == f) & (F.col("y") == y), F.col("n")).otherwise(0)).alias(f"n{f}{y}")
          for f in (0, 1) for y in (0, 1)]
    return found.groupBy("kind", "key").agg(*by)


def _contexts(sample: DataFrame, keys: list[np.ndarray]) -> DataFrame:
    """(kind, key, c0, c1): distinct preceding words of each candidate in the toxic texts of a fold."""
    wanted = sample.sparkSession.sparkContext.broadcast([HashTable(k, np.ones(len(k), np.int64), 0) for k in keys])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, start, end, upto, _ = plain_words(texts_of(part.column("text")))
                fold = np.repeat(part.column("fold").to_numpy(), np.diff(upto))
                word, opening = keys_of(data, start, end)
                before = np.concatenate([[0], word[:-1].astype(np.int64)])
                before[upto[:-1][upto[:-1] < len(word)]] = 0          # the first word of a text
                for kind, key in enumerate((word, opening)):
                    hit = wanted.value[kind].get(key) > 0
                    got = np.unique(np.rec.fromarrays([fold[hit], key[hit].astype(np.int64), before[hit]], names="f,k,b"))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (got.f, np.full(len(got), kind), got.k, got.b)],
                                                     ["fold", "kind", "key", "before"])
    pairs = sample.where("y = 1").mapInArrow(run, "fold long, kind long, key long, before long").distinct()
    return pairs.groupBy("kind", "key").agg(*[F.sum(F.when(F.col("fold") == f, 1).otherwise(0)).alias(f"c{f}") for f in (0, 1)])


def _lexicon(kind, key, clean, toxic, kappa: float = KAPPA, drift: float = DRIFT,
        z: float = SIGNIFICANT) -> Model:
    """Log-odds with Dirichlet priors from per-key numbers of clean and toxic texts."""
    texts = kind == 2
    n0, n1 = float(clean[texts].sum()), float(toxic[texts].sum())
    base = (n1 + 0.5) / (n0 + n1 + 1)

    def odds(c, t):
        """Log-odds against the sample's own, 0 where within ``z`` of their posterior deviations."""
        a, b = t + kappa * base, c + kappa * (1 - base)
        d = np.log(a / b) - math.log(base / (1 - base))
        return np.where(d > z * np.sqrt(1 / a + 1 / b), d, 0.0)

    o, w = kind == 1, kind == 0
    o_odds = odds(clean[o], toxic[o])
    openings = HashTable(key[o][o_odds > 0].astype(np.uint64), o_odds[o_odds > 0], np.nan)
    w_odds = odds(clean[w], toxic[w])
    keep = (w_odds > 0) | (clean[w] > 1)        # common clean words must not fall back to their opening
    top = max([*w_odds.tolist(), *o_odds.tolist()], default=0.0) - drift
    return Model(HashTable(key[w][keep].astype(np.uint64), w_odds[keep], np.nan), openings, drift=drift, top=top)


def _lambda(value: np.ndarray, n: np.ndarray, top: float) -> float:
    """The positive root of mean(exp(lambda * score)) = 1 over all clean tokens (``n`` of each ``value``) and one more of score ``top``.

    The extra token stands for what the clean sample did not show, so that the root exists.  1, the root for
    log likelihood ratios, where no score is positive or the mean is not negative.
    """
    value, n = np.append(value, top), np.append(n, 1).astype(float)
    p = n / n.sum()
    if value.max() <= 0 or (p * value).sum() >= 0:
        return 1.0
    low, high = 1e-3, 700 / value.max()
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * value)).sum() < 1 else (low, mid)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the smoothed logistic curve (Platt's targets), by damped Newton steps."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.1, math.log((n1 + 1) / (n0 + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * x).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", kappa: float = KAPPA, drift: float = DRIFT,
        z: float = SIGNIFICANT) -> Model:
    chosen = sample_labels(labels, per_class, id_col, label_col)
    joined = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(
        F.broadcast(chosen), "id")                                       # at most 2 * per_class ids
    # distinct texts: a group of copies must not fill the counts; the fold goes with the text
    one = joined.withColumn("h", F.xxhash64("text")).groupBy("h").agg(F.max(F.struct("y", "text")).alias("m"))
    sample = stable(one.select(F.col("m.text").alias("text"), F.col("m.y").cast("long").alias("y"),
                               F.pmod(F.col("h"), F.lit(2)).alias("fold")))
    counts = stable(_count(sample)).where("kind = 2 OR n01 + n11 > 1 OR n00 + n10 > 1").toPandas()   # bounded by the sample
    kind, key = counts["kind"].to_numpy(), counts["key"].to_numpy()
    n = {c: counts[c].to_numpy().astype(float) for c in ("n00", "n01", "n10", "n11")}
    texts = kind == 2
    # copies and shared passages: a word counts no more often than it follows different words
    base = n["n01"] + n["n11"], n["n00"] + n["n10"]
    risen = (base[0] > 1) & (base[0] * base[1][texts].sum() > base[1] * base[0][texts].sum())
    around = _contexts(sample, [key[risen & (kind == k)].astype(np.uint64) for k in (0, 1)]).toPandas()
    around = counts[["kind", "key"]].merge(around, "left", ["kind", "key"])
    for f in (0, 1):
        n[f"n{f}1"] = np.where(risen & ~texts, np.fmin(n[f"n{f}1"], np.nan_to_num(around[f"c{f}"].to_numpy())), n[f"n{f}1"])
    n1, n0 = float((n["n01"] + n["n11"])[texts].sum()), float((n["n00"] + n["n10"])[texts].sum())
    model = _lexicon(kind, key, n["n00"] + n["n10"], n["n01"] + n["n11"], kappa, drift, z)
    if not n0 or not n1:
        model.prior = n1 / (n0 + n1) if n0 + n1 else 0.0
        return model
    held = [_lexicon(kind, key, n["n10"], n["n11"], kappa, drift, z), _lexicon(kind, key, n["n00"], n["n01"], kappa, drift, z)]   # for fold 0: counts of fold 1
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def judge(batches):
        models = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts, fold = texts_of(part.column("text")), part.column("fold").to_pylist()
                best, every, size, bins, y = [], [], [], [], part.column("y").to_pylist()
                for f in (0, 1):
                    own = [i for i, g in enumerate(fold) if g == f]
                    if not own:
                        continue
                    mine = [texts[i] for i in own]
                    for i, (seg, m) in zip(own, models[f].passages(mine)):
                        best.append(max([s for *_, s in seg], default=0.0))
                        every.append([s for *_, s in seg])
                        size.append(m)
                        bins.append(y[i])
                yield pa.RecordBatch.from_arrays([pa.array(best, pa.float64()), pa.array(every, pa.list_(pa.float64())),
                                                  pa.array(size, pa.int64()), pa.array(bins, pa.int64())], ["best", "every", "n", "y"])

    def spread(batches):
        models = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                fold = part.column("fold").to_numpy()
                for f in (0, 1):
                    texts = texts_of(part.column("text").filter(pa.array(fold == f)))
                    data, start, end, _, _ = plain_words(texts)
                    value, c = np.unique(np.round(models[f].token_scores(data, start, end), 2), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(value, pa.float64()), pa.array(c, pa.int64())], ["s", "c"])

    hist = sample.where("y = 0").mapInArrow(spread, "s double, c long").groupBy("s").agg(F.sum("c").alias("c")).toPandas()
    if len(hist):
        model.scale = _lambda(hist["s"].to_numpy(), hist["c"].to_numpy(), model.top)
    judged = stable(sample.mapInArrow(judge, "best double, every array<double>, n long, y long"))
    seen = judged.select("best", "n").where("y = 0").toPandas()      # one row per sampled clean text
    size = seen["n"].to_numpy().astype(float)
    model.k = float(max(1e-9, len(seen) / max(1e-9, (size * np.exp(-model.scale * seen["best"].to_numpy())).sum())))
    space = F.log1p(F.lit(model.k) * F.col("n"))
    own = F.transform("every", lambda s: F.lit(model.scale) * s - space)
    sure = F.filter(own, lambda x: x >= -math.log(CHANCE))
    x = F.when(F.size(sure) > 0, F.aggregate(sure, F.lit(0.0), lambda a, v: a + v)).otherwise(F.coalesce(F.array_max(own), -space))
    fitted = judged.select(x.alias("x"), "y").toPandas()             # one row per sampled text
    discard(judged)
    x, y = fitted["x"].to_numpy(), fitted["y"].to_numpy()
    model.slope, model.shift = _logistic(x, y.astype(float))
    return model


def _scored(model, text_col: str):
    def run(batches):
        m = model.value
        for batch in batches:
            for part in slices(batch, text_col):
                found = m.passages(texts_of(part.column(text_col)))
                score = np.array([m.probability(m.statistic([s for *_, s in seg], n)) for seg, n in found], np.float64)
                yield part, score, [m.significant(seg, n) for seg, n in found]
    return run


def toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
             with_passages: bool = False) -> DataFrame:
    """Per row: id, score, predicted; ``with_passages`` adds the significant ones as (first byte, past byte, score) of the UTF-8 text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("first", pa.int64()), ("past", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for part, score, found in _scored(shared, "text")(batches):
            cols = [part.column("id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            if with_passages:
                cols.append(pa.array([[dict(zip(("first", "past", "score"), s)) for s in seg] for seg in found], pa.list_(passage)))
            yield pa.RecordBatch.from_arrays(cols, ["id", "score", "predicted", "passages"][:len(cols)])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    more = ", passages array<struct<first: long, past: long, score: double>>" if with_passages else ""
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, score double, predicted int{more}")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, score, _ in _scored(shared, text_col)(batches):
            yield part.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)
