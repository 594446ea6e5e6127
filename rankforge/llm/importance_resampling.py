"""Importance resampling towards a target distribution, with hashed n-gram features.

Features are the runs of 1 to ``grams`` consecutive words of a text, joined by
one space; a feature's bucket is the CRC-32 of its UTF-8 bytes modulo
``buckets``.  A bucket's gain is the floored thousandfold log ratio of its
smoothed shares in the target and in the source, a document's weight the floored
mean of its features' gains, its score the weight plus Gumbel noise drawn from
its id.  The highest scores of the long enough documents are a sample without
replacement in proportion to exp(weight / 1000).

CRC-32 is linear over bits, so the checksum of a span is the XOR of one table
entry per byte, ``position[distance from the span's end][byte]``, and of a
constant of its length.  All spans of a slice are looked up at once and reduced
with ``bitwise_xor.reduceat``.  Spans longer than the table are cut into blocks
of its length; neighbouring blocks are folded in pairs by the tables that move a
register past 2^k zero bytes.

1. Each task adds up its bucket counts; one aggregate gives the counts of all
   source and of all target texts (``buckets`` rows each).
2. A second pass gives each document's features and weight.
3. The rank is the place in one range partitioning by score and id, written
   once: no sort in one task, no join back to the texts.

Defined results: null text has no words, weight 0 and is never drawn for
``min_words`` above 0; a null id draws its noise as the empty text and comes last
among equal scores; repeated rows are rows of their own and take places one
after another; an empty source gives an empty result, an empty target has
zero counts; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import slices, stable
from rankforge.operators.ranking import global_rank

REACH_BITS = 7                       # the position table covers 2^7 bytes from a span's end
CHUNK_BYTES = 1_000_000              # feature bytes looked up at once
SLICE_BYTES = 500_000
_POLYNOMIAL = np.uint32(0xEDB88320)  # CRC-32, reflected
_ONES = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & np.uint32(1), (x >> np.uint32(1)) ^ _POLYNOMIAL, x >> np.uint32(1))
    return x


_BYTE = _byte_table()


def _past_zero(x: np.ndarray) -> np.ndarray:
    """Registers after one more zero byte."""
    return _BYTE[x & np.uint32(255)] ^ (x >> np.uint32(8))


def _moved(lanes: np.ndarray, x):
    """Registers moved by a linear map given as its values on each of the four bytes."""
    return (lanes[0][x & np.uint32(255)] ^ lanes[1][(x >> np.uint32(8)) & np.uint32(255)]
            ^ lanes[2][(x >> np.uint32(16)) & np.uint32(255)] ^ lanes[3][x >> np.uint32(24)])


def _zero_powers(count: int) -> list[np.ndarray]:
    """Maps of a register past 2^k zero bytes, k = 0 .. count - 1."""
    lane = np.arange(256, dtype=np.uint32)
    out = [_past_zero(np.stack([lane << np.uint32(8 * i) for i in range(4)]))]
    while len(out) < count:
        out.append(_moved(out[-1], out[-1]))
    return out


def _position_table(reach: int) -> np.ndarray:
    rows = [_BYTE]
    while len(rows) < reach:
        rows.append(_past_zero(rows[-1]))
    return np.stack(rows)


_POWERS = _zero_powers(40)
_REACH = 1 << REACH_BITS
_POSITION = _position_table(_REACH)
_FLAT = _POSITION.reshape(-1)


def past_zeros(register: int, n: int) -> np.uint32:
    """The register after ``n`` zero bytes."""
    x = np.array([register], np.uint32)
    for k in range(n.bit_length()):
        if n >> k & 1:
            x = _moved(_POWERS[k], x)
    return x[0]


_LENGTH = np.array([past_zeros(0xFFFFFFFF, n) for n in range(_REACH + 1)], np.uint32) ^ _ONES


def _folded(block: np.ndarray) -> np.uint32:
    """The register of a byte run of any length, from zero: blocks of the table's reach, folded in pairs."""
    rows = 1 << max(0, (-(-len(block) // _REACH) - 1).bit_length())
    padded = np.zeros(rows * _REACH, np.uint8)                     # leading zero bytes leave a zero register
    padded[len(padded) - len(block):] = block
    away = np.arange(_REACH - 1, -1, -1, dtype=np.int64) * 256
    part = np.bitwise_xor.reduce(_FLAT[away + padded.reshape(rows, _REACH)], axis=1)
    k = REACH_BITS
    while len(part) > 1:
        part = _moved(_POWERS[k], part[0::2]) ^ part[1::2]
        k += 1
    return part[0]


def long_crc(span: np.ndarray) -> np.uint32:
    """CRC-32 of one long span, a chunk of bytes at a time."""
    register = np.uint32(0)
    for at in range(0, len(span), CHUNK_BYTES):
        chunk = span[at:at + CHUNK_BYTES]
        register = past_zeros(int(register), len(chunk)) ^ _folded(chunk)
    return register ^ past_zeros(0xFFFFFFFF, len(span)) ^ _ONES


def span_crcs(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte spans ``data[start:start + size]`` (none empty; they may overlap)."""
    out = np.empty(len(start), np.uint32)
    far = size > _REACH
    for i in np.flatnonzero(far).tolist():
        out[i] = long_crc(data[start[i]:start[i] + size[i]])
    near = np.flatnonzero(~far)
    upto = np.concatenate([[0], np.cumsum(size[near])])
    lo = 0
    while lo < len(near):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + CHUNK_BYTES, "right")) - 1)
        own, first = near[lo:hi], upto[lo:hi] - upto[lo]
        n = size[own]
        step = np.arange(int(n.sum()), dtype=np.int64)
        byte = data[step + np.repeat(start[own] - first, n)]
        away = np.repeat(first + n - 1, n) - step
        out[own] = np.bitwise_xor.reduceat(_FLAT[(away << 8) + byte], first) ^ _LENGTH[n]
        lo = hi
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)                # of lowered bytes: digits, letters a-z and every byte of a non-ASCII character
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow text column and the n + 1 offsets of its texts (null: empty)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def joined_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all words, each followed by one space; word starts; word sizes; words before each text, n + 1)."""
    data, offsets = _bytes_of(column)
    low = _LOWER[data]
    inside = _WORD[low]
    first = np.zeros(len(low) + 1, bool)
    first[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:-1]
    closes[:-1] &= ~inside[1:] | first[1:-1]
    begin, size = np.flatnonzero(opens), np.flatnonzero(closes) - np.flatnonzero(opens) + 1
    start = np.concatenate([[0], np.cumsum(size + 1)])
    at = np.arange(start[-1]) + np.repeat(begin - start[:-1], size + 1)
    flat = low[np.minimum(at, max(len(low) - 1, 0))] if len(low) else low
    flat[start[1:] - 1] = 32
    return flat, start[:-1], size, np.searchsorted(begin, offsets, "left")


def features(column: pa.Array, grams: int, buckets: int):
    """((text index, bucket) of every feature, one pair of arrays for each run length; words per text)."""
    flat, start, size, upto = joined_words(column)
    words = np.diff(upto)
    text = np.repeat(np.arange(len(words)), words)
    last = np.repeat(upto[1:], words)
    out = []
    for g in range(grams):
        own = np.flatnonzero(np.arange(len(start)) + g < last)
        end = start[own + g] + size[own + g]
        out.append((text[own], (span_crcs(flat, start[own], end - start[own]) % np.uint32(buckets)).astype(np.int64)))
    return out, words


def bucket_counts(docs: DataFrame, grams: int, buckets: int, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket; tasks add up their own, one aggregate the tasks."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                for _, bucket in features(part.column("text"), grams, buckets)[0]:
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():                           # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + b) / ((s + 1)(T + b)))) of each of the b buckets, in doubles."""
    b = float(len(source))
    s_all, t_all = float(source.sum()) + b, float(target.sum()) + b
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, grams: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_features, weight (floored mean gain, 0 without features)."""
    buckets = len(gain)
    table = docs.sparkSession.sparkContext.broadcast(gain)          # one number a bucket

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found, words = features(part.column("text"), grams, buckets)
                n, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
                for text, bucket in found:
                    n += np.bincount(text, minlength=len(words))
                    # sums of whole numbers below 2^53 are exact in doubles
                    total += np.bincount(text, table.value[bucket], minlength=len(words)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(words.astype(np.int64)), pa.array(n),
                                                  pa.array(total // np.maximum(n, 1))], ["id", "n_words", "n_features", "weight"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col, seed: int):
    """Noise of an id: floor(-1000 ln(-ln u)), u from the first 32 bits of the SHA-256 of ``<seed>:<id>``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_ranks(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, grams: int = 2,
                     buckets: int = 10_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
                     target_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features, weight, score, rank (null for rows that are not drawn)."""
    gain = gains(bucket_counts(docs, grams, buckets, text_col), bucket_counts(target, grams, buckets, target_text_col))
    scored = stable(weights(docs, gain, grams, id_col, text_col).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)))
    long_enough = scored.where(F.col("n_words") >= min_words)
    draw = long_enough.count() * percent // 100
    ranked = global_rank(long_enough, [F.col("score").desc(), F.col("id").asc_nulls_last()], kind="long")
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return drawn.unionByName(scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The drawn rows of ``docs`` with their own columns (rows of one id are drawn together)."""
    ranks = importance_ranks(docs, target, percent, id_col=id_col, text_col=text_col, **options)
    drawn = ranks.where(F.col("rank").isNotNull()).select(F.col("id").alias("__id"), F.lit(True).alias("__in")).distinct()
    return docs.join(drawn, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
