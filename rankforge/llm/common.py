"""Helpers shared by the training-data operators.

Text passes run as ``mapInArrow``: Spark deals the rows, a task sees one Arrow
batch at a time and cuts it into slices of bounded size, so memory does not
depend on how many or how long the texts of a partition are (one text is the
smallest unit).  Nulls in a text column count as the empty text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.session import discard, materialize as stable, shuffles_released  # noqa: F401

SLICE_CHARS = 1_500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow text column, null as empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS):
    """Zero-copy slices of a batch holding at most ``limit`` bytes of ``column`` (or one row)."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i in range(n):
        if i > start and total + size[i] > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size[i])
    yield batch.slice(start, n - start)


def crc_mod(id_col: str, k: int):
    """crc32(id as text) mod k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % k


def crc_mod_py(value, k: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % k


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_M = 0x9E3779B97F4A7C15 | 1          # odd, so invertible modulo 2^64
_BLOCK = 1 << 16
_ONE, _ZERO = np.ones(1, np.uint64), np.zeros(1, np.uint64)    # typed: mixing with int64 would turn to floats
_POW = np.cumprod(np.concatenate([_ONE, np.full(_BLOCK, _M, np.uint64)]), dtype=np.uint64)
_INV = np.cumprod(np.concatenate([_ONE, np.full(_BLOCK, pow(_M, -1, 1 << 64), np.uint64)]), dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, doc_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of many texts laid end to end.

    ``data``: UTF-8 bytes with a space byte after every text; ``doc_end[i]``:
    position of the space that closes text i.  Words are the maximal runs
    without the bytes 09-0D and 20, with A-Z lowered.  Returns the hash of each
    word and, per text, the number of words before ``doc_end`` (cumulative).
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(doc_end), np.int64)
    space = _SPACE[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return span_hashes(_LOWER[data], start, end), np.searchsorted(start, doc_end, "left")


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``data[start:end]``, given in order and without overlap.

    A polynomial modulo 2^64 taken from prefix sums that restart every 64 KiB
    (longer spans are hashed in parts); it does not depend on where a span stands.
    """
    out = np.empty(len(start), np.uint64)
    done = 0
    with np.errstate(over="ignore"):
        while done < len(start):
            base = int(start[done])
            last = max(done + 1, int(np.searchsorted(end, base + _BLOCK, "right")))
            top = int(end[last - 1])
            if top - base > _BLOCK:                    # one span longer than a block
                out[done] = _long_word(data[base:top])
            else:
                part = (data[base:top].astype(np.uint64) + np.uint64(1)) * _POW[:top - base]
                pre = np.concatenate([_ZERO, np.cumsum(part, dtype=np.uint64)])
                s, e = start[done:last] - base, end[done:last] - base
                out[done:last] = mix64((pre[e] - pre[s]) * _INV[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            done = last
    return out


class HashTable:
    """Distinct 64-bit keys -> values by open addressing, filled and probed with whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing=-1):
        keys, values = np.asarray(keys).astype(np.uint64), np.asarray(values)
        size = 1 << max(10, int(len(keys) * 4).bit_length())
        self.mask, self.missing, self.steps = np.uint64(size - 1), missing, 0
        self.keys, self.values = np.zeros(size, np.uint64), np.full(size, missing, values.dtype)
        self.used = np.zeros(size, bool)
        todo = np.arange(len(keys))
        while len(todo):
            slot = ((mix64(keys[todo]) + np.uint64(self.steps)) & self.mask).astype(np.int64)
            free = np.flatnonzero(~self.used[slot])
            at, first = np.unique(slot[free], return_index=True)
            put = todo[free[first]]
            self.keys[at], self.values[at], self.used[at] = keys[put], values[put], True
            todo = np.delete(todo, free[first])
            self.steps += 1

    def get(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64, copy=False)
        h = mix64(keys)
        slot = (h & self.mask).astype(np.int64)
        same, used = self.keys[slot] == keys, self.used[slot]
        out = np.where(same & used, self.values[slot], self.missing)
        todo = np.flatnonzero(used & ~same)
        step = 1
        while len(todo) and step < self.steps:
            slot = ((h[todo] + np.uint64(step)) & self.mask).astype(np.int64)
            same, used = self.keys[slot] == keys[todo], self.used[slot]
            hit = same & used
            out[todo[hit]] = self.values[slot[hit]]
            todo = todo[used & ~same]
            step += 1
        return out


def _long_word(low: np.ndarray) -> np.uint64:
    h = np.uint64(len(low))
    for i in range(0, len(low), _BLOCK):
        part = low[i:i + _BLOCK].astype(np.uint64) + np.uint64(1)
        h = mix64(np.array([h * np.uint64(_M) + (part * _POW[:len(part)]).sum(dtype=np.uint64)], np.uint64))[0]
    return h


def hash_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a list of texts and cumulative word counts (length ``len(texts) + 1``)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8) if raw else np.zeros(0, np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64) - 1
    h, upto = word_hashes(data, ends)
    return h, np.concatenate([[0], upto]).astype(np.int64)


def plain_words(texts: list[str], digits: bool = False):
    """Words of many texts: maximal runs of letters A-Z (and digits) and non-ASCII bytes, lowered.

    Returns (lowered bytes, word starts, word ends, cumulative words per text, first byte of each text).
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8).copy()
    first = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)])
    upper = (data >= 65) & (data <= 90)
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data[upper] += 32
    inside = ((data >= 97) & (data <= 122)) | (data >= 128)
    if digits:
        inside |= (data >= 48) & (data <= 57)
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return data, start, end, np.searchsorted(start, first, "left"), first
