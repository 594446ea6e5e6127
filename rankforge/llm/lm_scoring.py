"""Language-model scores from an n-gram model with backoff, held as written tables.

Learning counts all training rows, in Spark:

* every token's count (the unigram level, exact and unpruned);
* every n-gram up to ``ORDER`` that stands in the training rows twice or more,
  level by level; an n-gram is told by its prefix and its suffix, and the keys of
  the level below, as a hash filter of at most 2^``MAP_BITS`` bits, keep most n-grams
  that cannot repeat out of the shuffle.

The model grows with the corpus: kept n-grams stay in partitioned tables, a row for a
range of keys, and meet those of their prefixes and suffixes by shuffles of such rows.
The key of an n-gram and its prefix give the suffix back, so it is not stored.  ``words``
and ``grams`` can bound a model to words and n-grams of at least 1/``words`` and
1/``grams`` of the tokens; by default nothing is left out.

Probabilities are by absolute discounting.  The failure weight of a context makes
its distribution sum to one.  The kept n-grams are the states of a backoff automaton:
from a state, the arc of a token leads to the n-gram one longer and carries its log
probability; without that arc, the failure arc leads to the state's suffix and carries
the failure weight.  Unknown words have the smoothed unigram and lead to the root.
The tables hold whole numbers: a state's count and sums over the arcs from it.  With the
counts of its prefix and suffix, which are states too, they give its arc and failure weight.

No task holds the whole automaton.  The rows are scored in ``ROUNDS`` parts, one after the
other, so that what one part gathers is deleted before the next.  Texts are cut into slices of
about ``SLICE`` bytes.  The ``TABLE`` or fewer most frequent states are broadcast; a slice asks
for the others that it may need, once each, by ranges of keys, and gets their columns in the
order asked.  Each slice then has the part of the automaton that its texts can reach, and one
traversal from left to right carries the state of every text and adds up the arcs.  Texts are
walked side by side, long ones in runs of ``RUN`` tokens, each from the state that the tokens
before it lead to.

Tokens: maximal runs without 09-0D and 20, A-Z lowered, then one end token.
Defined results: null is the empty text, whose only token is the end; rows are
scored one by one, so repeated rows give repeated results; without training
rows N and V are 0 and every token has probability 1.  Words and n-grams are told
apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
import itertools
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import discard, mix64, shuffles_released, slices, span_hashes, stable, texts_of

ORDER = 3
WORDS = math.inf           # all words and all repeated n-grams are in the model
GRAMS = math.inf
TABLE = 400_000
SUFFIXES = 50_000          # or fewer most frequent entries of a level are broadcast while the level above looks up its suffixes
DISCOUNT = 0.5
ADD = 0.1
FLUSH = 1_500_000          # distinct keys a task holds before it sends them on
RANGE_BYTES = 12_000_000   # training text whose n-grams share a range of keys, about
SLICE = 4_000_000          # bytes of the texts that are scored together, or one text
ROUNDS = 2                 # parts of the rows that are scored one after the other
RUN = 64                   # tokens of a text that are walked one after the other
MAP_BITS = 28              # a filter of keys holds at most 2^28 bits
END = np.uint64(0x0E0F)
ROW = "r int, kind long, body binary"
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)     # the first k bytes of eight
LONG = 64                  # bytes of a word that are hashed eight by eight
BLOCK = 250_000            # characters of the texts that are cut into words at once: what fits a core's cache
KEYS = 1 << 14             # keys that are made at once, likewise


def word_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and cumulative word counts (length ``len(texts) + 1``)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" " + b" ".join(raw) + b" " * 8, np.uint8)
    low = data | ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))
    space = (data == 32) | (data - np.uint8(9) < 5)
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    size = end - start
    eight = np.ndarray(len(low) - 7, "<u8", low, strides=(1,))         # the eight bytes from each place on
    out = mix64(eight[start] & _FIRST[np.minimum(size, 8)] ^ size.astype(np.uint64) * _GOLD)
    for k in range(8, LONG, 8):
        more = np.flatnonzero(size > k)
        out[more] = mix64(out[more] * _GOLD + (eight[start[more] + k] & _FIRST[np.minimum(size[more] - k, 8)]))
    long = np.flatnonzero(size > LONG)
    out[long] = span_hashes(low, start[long], end[long])
    upto = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return out, np.searchsorted(start, upto, "right")


def blocks(texts: list[str]):
    """Runs of the texts of about ``BLOCK`` characters, or one text."""
    upto = np.cumsum([0, *map(len, texts)])
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + BLOCK, "right")) - 1)
        yield texts[i:j]
        i = j


def stream(texts: list[str]):
    """(token keys with an end mark before and after each text, begin flags, index of each text's first mark and end)."""
    parts, upto = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for own in blocks(texts):
        h, more = word_keys(own)
        places = np.arange(len(h)) + 1 + 2 * np.repeat(np.arange(len(own)), np.diff(more))
        keys = np.full(len(h) + 2 * len(own), END)
        keys[places] = h
        parts.append(keys)
        upto.append(more[1:] + upto[-1][-1])
    keys, upto = np.concatenate(parts), np.concatenate(upto)
    first = upto[:-1] + 2 * np.arange(len(texts))
    past = upto[1:] + 2 * np.arange(1, len(texts) + 1)
    begin = np.zeros(len(keys), bool)
    begin[first] = True
    return keys, begin, first, past


def gram_key(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    out = np.empty(len(prefix), np.uint64)
    for i in range(0, len(out), KEYS):
        out[i:i + KEYS] = mix64(mix64(prefix[i:i + KEYS]) * _GOLD + suffix[i:i + KEYS])
    return out


def suffix_of(key: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """The suffix that ``gram_key`` was given: its steps backwards."""
    x = key ^ key >> np.uint64(31) ^ key >> np.uint64(62)
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ x >> np.uint64(27) ^ x >> np.uint64(54)
    x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return (x ^ x >> np.uint64(30) ^ x >> np.uint64(60)) - mix64(prefix) * _GOLD


def grams(keys: np.ndarray, begin: np.ndarray, order: int):
    """Per order: the key of the n-gram that ends at each place, and whether it lies in one text."""
    out = [(keys, np.ones(len(keys), bool))]
    for _ in range(1, order):
        g, ok = out[-1]
        out.append((gram_key(np.roll(g, 1), g), np.roll(ok, 1) & ok & ~begin))
    return out


def in_order(x: np.ndarray):
    """(places of the values in order, the values in order).

    The first bits of a value and its place are sorted as one number, which is faster than sorting places.
    """
    low, n = x.min(initial=np.uint64(2**64 - 1)), len(x)
    wide, place = (int(x.max(initial=0)) - int(low)).bit_length() if n else 0, max(n - 1, 0).bit_length()
    if not wide:
        return np.arange(n), x
    up = np.uint64(64 - wide)
    last = np.uint64((1 << place) - 1)
    y = x - low << up & ~last
    y |= np.arange(n, dtype=np.uint64)
    y.sort()
    y &= last
    by = y.view(np.int64)
    key = x[by]
    wrong = np.flatnonzero(key[1:] < key[:-1])
    if len(wrong):                                         # values that differ in their last bits only
        top = key - low << up & ~last
        at = np.flatnonzero(np.isin(top, top[wrong]))
        by[at] = by[at[np.argsort(key[at], kind="stable")]]
        key = x[by]
    return by, key


def starts(key: np.ndarray) -> np.ndarray:
    """First place of each of the values, which are in order."""
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    return np.flatnonzero(new)


def distinct(x: np.ndarray):
    """(values in order, a place of each, per place the number of its value)."""
    by, key = in_order(x)
    start = starts(key)
    back = np.empty(len(x), np.int64)
    back[by] = np.repeat(np.arange(len(start)), np.diff(start, append=len(x)))
    return key[start], by[start], back


def sums(parts: list[tuple[np.ndarray, ...]], added: int = 1) -> list[np.ndarray]:
    """Parts (key, columns that are added up, other columns of the key), one entry for each key, in order."""
    columns = [np.concatenate(x) for x in zip(*parts)]
    by, key = in_order(columns[0])
    start = starts(key)
    one = by[start]
    if len(start) == len(key):
        return [key, *(x[one] for x in columns[1:])]
    return [key[start], *(np.add.reduceat(x[by], start) for x in columns[1:1 + added]), *(x[one] for x in columns[1 + added:])]


def found_at(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each value among the sorted keys, -1 where it is not."""
    if not len(keys):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, at, -1)


# ---- columns as bytes: a shuffled row holds the entries of one range of keys

def pack(*columns: np.ndarray) -> bytes:
    """Whole numbers, the lowest bytes of all first, then the next ones, without the bytes that no number needs."""
    head, body = [], []
    for x in columns:
        x = np.ascontiguousarray(x).astype("<u8", copy=False)
        wide = (int(x.max(initial=0)).bit_length() + 7) // 8
        head.append(len(x) << 8 | wide)
        body.append(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T[:wide]).tobytes())
    return np.array([len(head), *head], "<i8").tobytes() + b"".join(body)


def unpack(raw: bytes) -> list[np.ndarray]:
    k = int(np.frombuffer(raw, "<i8", 1)[0])
    at, out = 8 + 8 * k, []
    for x in np.frombuffer(raw, "<i8", k, 8).tolist():
        n, wide = x >> 8, x & 255
        own = np.zeros((n, 8), np.uint8)
        own[:, :wide] = np.frombuffer(raw, np.uint8, n * wide, at).reshape(wide, n).T
        out.append(own.reshape(-1).view("<u8"))
        at += n * wide
    return out


def entries(r: int, bits: int, keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted keys of a range, as their gaps, and columns."""
    return pack(np.diff(keys, prepend=np.uint64(r << 64 - bits)), *columns)


def entries_of(r: int, bits: int, raw: bytes, width: int) -> list[np.ndarray]:
    """Keys and columns, ``width`` arrays in all; columns that were not packed are zero."""
    gaps, *columns = unpack(raw)[:width]
    more = [np.zeros(len(gaps), np.uint64)] * (width - 1 - len(columns))
    return [np.cumsum(gaps, dtype=np.uint64) + np.uint64(r << 64 - bits), *columns, *more]


def by_range(keys: np.ndarray, bits: int):
    """(range, slice of the sorted keys) of the ranges that hold any."""
    edge = np.searchsorted(keys, np.arange(1, 1 << bits).astype(np.uint64) << np.uint64(64 - bits)).tolist()
    return [(r, slice(a, z)) for r, (a, z) in enumerate(zip([0, *edge], [*edge, len(keys)])) if z > a]


def _row(r: int, kind: int, body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([kind], pa.int64()), pa.array([body], pa.binary())], ["r", "kind", "body"])


def _rows(batches):
    for batch in batches:
        for r, kind, body in zip(batch.column("r").to_pylist(), batch.column("kind").to_pylist(), batch.column("body")):
            yield r, kind, body.as_py()


def _sent(parts: list, bits: int, kind: int, added: int):
    """Rows of the summed parts, one for each range."""
    key, *columns = sums(parts, added)
    for r, own in by_range(key, bits):
        yield _row(r, kind, entries(r, bits, key[own], *(x[own] for x in columns)))


def _met(rows: DataFrame, bits: int, run) -> DataFrame:
    """Rows of one range meet in one task, range by range, kinds in order."""
    tasks = min(1 << bits, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartitionById(tasks, F.col("r") % tasks).sortWithinPartitions("r", "kind").mapInArrow(run, ROW)


# ---- learning

def _counted(docs: DataFrame, orders: tuple[int, ...], bits: int, below: np.ndarray | None = None) -> DataFrame:
    """Rows (r, order, entries: key, c, prefix) of all words or of the n-grams that stand twice or more, counted over all texts.

    A task adds up its own n-grams and sends them packed, one row per range of keys: the distinct words of the range
    once, and places in them for each n-gram.  A range, sized by the training text, is added up in one task.
    ``below``: filter of the keys of the order below, which keeps n-grams that cannot repeat out of the shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(below)

    def find(texts):
        keys, begin, _, _ = stream(texts)
        levels = grams(keys, begin, max(orders))
        for m in orders:
            key, ok = levels[m - 1]
            if m == 1:
                own = np.sort(key[~begin])
                start = starts(own)
                yield m, [own[start], np.diff(start, append=len(own))]
                continue
            at = np.flatnonzero(ok)
            if shared.value is not None:
                may = may_hold(shared.value, levels[m - 2][0])
                at = at[may[at] & may[at - 1]]
            by, own = in_order(key[at])
            start = starts(own)
            first = at[by[start]] - m + 1
            yield m, [own[start], np.diff(start, append=len(own)), *(keys[first + j] for j in range(m))]

    def send(m, parts):
        key, c, *words = sums(parts) if len(parts) > 1 else parts[0]       # every part is summed and in order
        for r, own in by_range(key, bits):
            if m == 1:
                yield _row(r, m, entries(r, bits, key[own], c[own]))
                continue
            word, _, at = distinct(np.concatenate([w[own] for w in words]))
            yield _row(r, m, pack(np.diff(word, prepend=np.uint64(0)), c[own], at))

    def run(batches):
        held, size = {m: [] for m in orders}, dict.fromkeys(orders, 0)
        for batch in batches:
            for part in slices(batch, "text", 4_000_000):
                for m, own in find(texts_of(part.column("text"))):
                    held[m].append(own)
                    size[m] += len(own[0])
                    if size[m] > FLUSH:
                        held[m] = [sums(held[m])]
                        size[m] = len(held[m][0][0])
                        if size[m] > FLUSH // 2:
                            yield from send(m, held[m])
                            held[m], size[m] = [], 0
        for m in orders:
            if held[m]:
                yield from send(m, held[m])

    def part_of(r, m, raw):
        if m == 1:
            return entries_of(r, bits, raw, 2)
        gaps, c, at = unpack(raw)
        level = list(np.cumsum(gaps, dtype=np.uint64)[at.astype(np.int64)].reshape(m, -1))
        while len(level) > 2:                                      # as ``grams`` builds its keys
            level = [gram_key(x, y) for x, y in zip(level, level[1:])]
        return [gram_key(*level), c, level[0]]

    def add(batches):
        for (r, m), rows in itertools.groupby(_rows(batches), lambda x: x[:2]):
            parts, size = [], 0
            for _, _, raw in rows:
                parts.append(part_of(r, m, raw))
                size += len(parts[-1][0])
                if size > FLUSH and len(parts) > 8:
                    parts = [sums(parts)]
                    size = 0
            own = sums(parts)
            if m > 1:
                own = [x[own[1] > 1] for x in own]
            yield _row(r, m, entries(r, bits, *own))

    out = stable(_met(docs.mapInArrow(run, ROW), bits, add))
    shared.destroy()
    return out


def key_filter(tables: list[DataFrame], number: int, bits: int) -> np.ndarray:
    """Bits of a filter for the keys of the tables (by their first bits), sized by their number up to a fixed limit."""
    page = max(bits + 3, min(MAP_BITS, max(16, (16 * number).bit_length()))) - bits

    def run(batches):
        for r, kind, raw in _rows(batches):
            own = np.zeros(1 << page, bool)
            own[(entries_of(r, bits, raw, 1)[0] << np.uint64(bits)) >> np.uint64(64 - page)] = True
            yield _row(r, kind, np.packbits(own).tobytes())

    out = np.zeros((1 << bits, 1 << page >> 3), np.uint8)
    for table in tables:
        for x in table.mapInArrow(run, ROW).collect():
            out[x.r] |= np.frombuffer(x.body, np.uint8)
    return out.reshape(-1)


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return bits[(at >> np.uint64(3)).view(np.int64)] << (at.astype(np.uint8) & np.uint8(7)) > 127


def _classes(c: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(c) * 8).astype(np.int64)


def _histogram(table: DataFrame) -> list:
    """(class of counts, number of entries, sum of their counts), largest class first."""
    def run(batches):
        for _, _, raw in _rows(batches):
            c = unpack(raw)[1]
            n, total = np.bincount(_classes(c)), np.bincount(_classes(c), c)
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0]), pa.array(total[n > 0].astype(np.int64))], ["level", "n", "c"])

    with shuffles_released(table.sparkSession):
        return table.mapInArrow(run, "level long, n long, c long").groupBy("level").agg(F.sum("n").alias("n"), F.sum("c").alias("c")).orderBy(F.desc("level")).collect()


def _frequent(table: DataFrame, hist: list, limit: int, bits: int, width: int) -> list[np.ndarray]:
    """The entries of the largest classes of counts, at most ``limit``."""
    held, least = 0, 1 << 30
    for x in hist:
        if held + x.n > limit:
            break
        held, least = held + x.n, x.level
    return _collected(table, lambda key, c, *_: _classes(c) >= least, bits, width)


def _collected(table: DataFrame, wanted, bits: int, width: int) -> list[np.ndarray]:
    def run(batches):
        for r, kind, raw in _rows(batches):
            own = entries_of(r, bits, raw, width)
            keep = wanted(*own)
            yield _row(r, kind, entries(r, bits, *(x[keep] for x in own)))

    parts = [entries_of(x.r, bits, x.body, width) for x in table.mapInArrow(run, ROW).collect()]
    return sums(parts, 0) if parts else [np.zeros(0, np.uint64)] * width


def _within(table: DataFrame, below: np.ndarray, least: float, bits: int) -> DataFrame:
    """The n-grams of ``table`` that stand ``least`` times and whose prefix and suffix are among the sorted keys ``below``."""
    shared = table.sparkSession.sparkContext.broadcast(below)

    def run(batches):
        for r, kind, raw in _rows(batches):
            key, c, prefix = entries_of(r, bits, raw, 3)
            keep = (c >= least) & (found_at(shared.value, prefix) >= 0) & (found_at(shared.value, suffix_of(key, prefix)) >= 0)
            yield _row(r, kind, entries(r, bits, key[keep], c[keep], prefix[keep]))

    out = stable(table.mapInArrow(run, ROW))
    shared.destroy()
    return out


def _contexts(lower: DataFrame, upper: DataFrame, hist: list, bits: int) -> DataFrame:
    """Rows of ``lower`` (r, order, entries: key, c, arcs, used, below) with what leads on to ``upper``.

    For the n-grams of ``upper`` that a key is the prefix of: their number, the sum of their counts and the sum of
    the counts of their suffixes.  Suffixes are looked up where their range is; the most frequent ones are broadcast.
    """
    shared = lower.sparkSession.sparkContext.broadcast(_frequent(lower, hist, SUFFIXES, bits, 2))

    def ask(batches):
        known, asked, size = [], [], 0

        def send():
            yield from _sent(known, bits, 2, 3)
            suffix, prefix, c = (np.concatenate(x) for x in zip(*asked))
            by, suffix = in_order(suffix)
            prefix, c = prefix[by], c[by]
            for r, own in by_range(suffix, bits):
                yield _row(r, 1, entries(r, bits, suffix[own], prefix[own], c[own]))

        for r, _, raw in _rows(batches):
            key, c, prefix = entries_of(r, bits, raw, 3)
            suffix = suffix_of(key, prefix)
            at = found_at(shared.value[0], suffix)
            hit = at >= 0
            known.append((prefix[hit], np.ones(hit.sum(), np.uint64), c[hit], shared.value[1][at[hit]]))
            asked.append((suffix[~hit], prefix[~hit], c[~hit]))
            size += len(key)
            if size > FLUSH:
                yield from send()
                known, asked, size = [], [], 0
        if size:
            yield from send()

    def look_up(batches):
        held, size = [], 0
        for r, rows in itertools.groupby(_rows(batches), lambda x: x[0]):
            key, c = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            for _, kind, raw in rows:
                if kind == 0:
                    key, c = entries_of(r, bits, raw, 2)
                elif kind == 1:
                    suffix, prefix, own = entries_of(r, bits, raw, 3)
                    held.append((prefix, np.ones(len(own), np.uint64), own, c[np.searchsorted(key, suffix)]))
                else:
                    held.append(entries_of(r, bits, raw, 4))
                size += len(held[-1][0]) if kind else 0
                if size > FLUSH:
                    held = [sums(held, 3)]
                    size = len(held[0][0])
                    if size > FLUSH // 2:
                        yield from _sent(held, bits, 1, 3)
                        held, size = [], 0
        if held:
            yield from _sent(held, bits, 1, 3)

    def add(batches):
        for r, rows in itertools.groupby(_rows(batches), lambda x: x[0]):
            key, c, *out = [np.zeros(0, np.uint64)] * 5
            for _, kind, raw in rows:
                if kind == 0:
                    key, c = entries_of(r, bits, raw, 2)
                    out = [np.zeros(len(key), np.uint64) for _ in range(3)]
                else:
                    prefix, *more = entries_of(r, bits, raw, 4)
                    at = np.searchsorted(key, prefix)
                    for x, y in zip(out, more):
                        x[at] += y
            yield _row(r, 0, entries(r, bits, key, c, *out))

    plain = lower.withColumn("kind", F.lit(0).cast("long"))
    summed = _met(plain.unionByName(upper.mapInArrow(ask, ROW)), bits, look_up)
    out = stable(_met(plain.unionByName(summed), bits, add))
    shared.destroy()
    return out


@dataclass
class Model:
    """What every task holds: the most frequent states, and a filter of the keys of all."""
    tokens: int = 0                    # N
    distinct: int = 0                  # V
    order: int = ORDER
    bits: int = 4                      # the first bits of a key are its range
    # the broadcast states: key, c and, of the n-grams one longer, their number, the sum of their counts and that of their suffixes
    table: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.uint64)] * 5)
    rest: np.ndarray = field(default_factory=lambda: np.zeros(1 << 13, np.uint8))

    @property
    def mass(self) -> float:
        return self.tokens + ADD * (self.distinct + 1)

    @property
    def unknown(self) -> float:
        return math.log10(ADD / self.mass)


def learn(docs: DataFrame, text_col: str = "text", order: int = ORDER, words: float = WORDS, grams_share: float = GRAMS,
          table: int = TABLE) -> tuple[Model, list[DataFrame]]:
    """(what is broadcast, the tables of all states: rows of a range of keys).

    The kept keys of a bounded model are collected and broadcast, order by order, while it is learned: at most ``words`` words and
    ``grams_share`` n-grams, but all of an order that has no bound where the other has one.
    """
    own = docs.select(F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    bits = max(4, (size // RANGE_BYTES).bit_length())
    counts = _counted(own, (1, 2)[:order], bits)
    written, states = [counts], []
    level = counts.where("kind = 1")
    hist = _histogram(level)
    model = Model(sum(x.c for x in hist), sum(x.n for x in hist), order, bits)
    bounded = math.isfinite(words) or math.isfinite(grams_share)
    if bounded:
        below = _collected(level, lambda key, c: c * words >= model.tokens, bits, 2)[0]
    number = model.distinct
    for m in range(2, order + 1):
        found = counts.where("kind = 2") if m == 2 else _counted(own, (m,), bits, key_filter([level], sum(x.n for x in hist), bits))
        if m > 2:
            written.append(found)
        if bounded:
            found = _within(found, below, model.tokens / grams_share, bits)
            written.append(found)
            below = _collected(found, lambda key, *_: np.ones(len(key), bool), bits, 1)[0]
        states.append(_contexts(level, found, hist, bits))
        level, hist = found, _histogram(found)
        number += sum(x.n for x in hist)

    def plain(batches):
        for r, _, raw in _rows(batches):
            yield _row(r, 0, pack(*unpack(raw)[:2]))

    states.append(stable(level.mapInArrow(plain, ROW)))
    discard(*written)
    both = functools.reduce(DataFrame.unionByName, states)
    model.table = _frequent(both, _histogram(both), table, bits, 5)
    model.rest = key_filter(states, number, bits)
    return model, states


# ---- scoring

def reach(model: Model, texts: list[str]):
    """The stream of the texts; per order: places of n-grams that may be states, and their keys."""
    keys, begin, first, past = stream(texts)
    levels, may = [], None
    for m, (g, ok) in enumerate(grams(keys, begin, model.order), 1):
        if may is not None:                                # only with its prefix and its suffix
            ok = ok & may & np.roll(may, 1)
        at = np.flatnonzero(ok)
        own = g[at]
        hit = np.flatnonzero(may_hold(model.rest, own))
        at = at[hit]
        levels.append((at, own[hit]))
        if m < model.order:
            may = np.zeros(len(g), bool)
            may[at] = True
    return (keys, begin, first, past), levels


def wanted(model: Model, levels: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of each order's keys, given once each and in order: (those that are not broadcast, in order; places among the broadcast ones or -1)."""
    places = [found_at(model.table[0], own) for own in levels]
    return np.sort(np.concatenate([own[place < 0] for own, place in zip(levels, places)])), places


class Automaton:
    """The states that some texts can reach: those broadcast and those gathered (columns for the keys that ``wanted`` names)."""

    def __init__(self, model: Model, texts: list[str], gathered: list[np.ndarray]):
        self.model, self.texts = model, len(texts)
        self.stream, levels = reach(model, texts)
        levels = [(at, *distinct(own)) for at, own in levels]
        want, places = wanted(model, [own for _, own, _, _ in levels])
        columns = [np.concatenate(x).astype(float) for x in zip(model.table[1:], gathered)]
        # ends[p, m]: the state of m tokens that ends at place p, or -1
        self.ends = np.full((len(self.stream[0]), model.order + 1), -1, np.int32)
        arcs, backs, size, lower = [], [], 0, None
        for m, ((at, own, one, number), place) in enumerate(zip(levels, places), 1):
            rest = np.flatnonzero(place < 0)
            place[rest] = len(model.table[0]) + np.searchsorted(want, own[rest])
            count = columns[0][place]
            live = np.flatnonzero(count)
            c, one = count[live], at[one[live]]
            state = np.full(len(own), -1, np.int32)
            state[live] = size + np.arange(len(live))
            size += len(live)
            self.ends[at, m] = state[number]
            # an arc: by the counts of the prefix and, for the weight of a failure arc, of the suffix
            arcs.append(np.log10((c + ADD) / model.mass) if m == 1 else np.log10((c - DISCOUNT) / lower[one - 1]))
            if m == model.order:                           # no arcs lead on from the longest
                break
            n, used, below = (x[place[live]] for x in columns[1:])
            with np.errstate(divide="ignore", invalid="ignore"):
                under = (below + ADD * n) / model.mass if m == 1 else (below - DISCOUNT * n) / lower[one]
                # what a context's arcs leave, over what the lower order leaves
                left = (c - used + DISCOUNT * n) / c
                backs.append(np.where(n > 0, np.log10(np.maximum(left, 1e-12) / np.maximum(1 - under, 1e-12)), 0.0))
            lower = np.zeros(len(self.ends))
            lower[at] = count[number]
        self.arc = np.concatenate([*arcs, [model.unknown]])        # -1: an unknown word
        self.back = np.concatenate([*backs, np.zeros(0)])

    def score(self):
        """Per text: tokens, known tokens, log10 of the unigrams, log10 of the model."""
        _, begin, first, past = self.stream
        order, n, wide = self.model.order, self.texts, self.model.order + 1
        inside = ~begin
        text = np.repeat(np.arange(n), past - first - 1)
        word = self.ends[:, 1][inside]
        base = self.arc[word]
        known = np.bincount(text, word >= 0, minlength=n).astype(np.int64)
        # runs: (first token, number of tokens, text), longest first
        size = past - first - 1
        per = -(-size // RUN)
        own = np.repeat(np.arange(n), per)
        skip = RUN * (np.arange(len(own)) - np.repeat(np.cumsum(per) - per, per))
        start, length = first[own] + 1 + skip, np.minimum(size[own] - skip, RUN)
        by = np.argsort(-length, kind="stable")
        own, start, length = own[by], start[by], length[by]
        state, level = np.full(len(own), -1, np.int32), np.zeros(len(own), np.int64)
        for m in range(1, order):                          # the state that the tokens before a run lead to
            s = self.ends[start - 1, m]
            state, level = np.where(s >= 0, s, state), np.where(s >= 0, m, level)
        total, ends = np.zeros(len(own)), self.ends.reshape(-1)
        for t, live in enumerate(np.searchsorted(-length, -np.arange(length.max(initial=0))).tolist()):
            at, s, lev = (start[:live] + t) * wide, state[:live], level[:live]
            for m in range(order - 1, 0, -1):              # failure arcs, from the longest states down
                fail = np.flatnonzero(lev == m)
                fail = fail[ends[at[fail] + m + 1] < 0]
                total[fail] += self.back[s[fail]]
                lev[fail] = m - 1
                s[fail] = ends[at[fail] - wide + m - 1]    # the root's is -1
            to = ends[at + lev + 1]                        # the arc of the token; without it (an unknown word) the root stays
            total[:live] += self.arc[to]
            lev += 1
            np.minimum(lev, order - 1, out=lev)
            lev[to < 0] = 0
            s[:] = ends[at + lev]
        return size, known, np.bincount(text, base, minlength=n), np.bincount(own, total, minlength=n)


def _gathered(cut: DataFrame, states: list[DataFrame], shared, bits: int) -> DataFrame:
    """Rows (range, slice, columns of the keys that it asks for, in order), found one range of keys at a time."""
    def ask(batches):
        for batch in batches:
            for sid, texts in zip(batch.column("sid").to_pylist(), batch.column("texts")):
                model = shared.value
                levels = [np.sort(own) for _, own in reach(model, texts_of(texts.values))[1]]
                keys, _ = wanted(model, [own[starts(own)] for own in levels])
                for r, own in by_range(keys, bits):
                    yield _row(r, sid, entries(r, bits, keys[own]))

    def answer(batches):
        for r, rows in itertools.groupby(_rows(batches), lambda x: x[0]):
            held, model = [], None
            for _, sid, raw in rows:
                if sid < 0:                                        # the states of a range come before what is asked of it
                    held.append(entries_of(r, bits, raw, 5))
                    continue
                if model is None:
                    known, *columns = sums(held, 0) if held else [np.zeros(0, np.uint64)] * 5
                    model = [np.append(x, np.uint64(0)) for x in columns]      # -1: zero, not a state
                keys, = entries_of(r, bits, raw, 1)
                at = found_at(known, keys)
                yield _row(r, sid, pack(*(x[at] for x in model)))

    dealt = functools.reduce(DataFrame.unionByName, [*(x.withColumn("kind", F.lit(-1).cast("long")) for x in states), cut.mapInArrow(ask, ROW)])
    return _met(dealt, bits, answer).withColumnRenamed("kind", "sid")


def lm_scores(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
              words: float = WORDS, grams: float = GRAMS, table: int = TABLE) -> DataFrame:
    """Per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score; learned from ``train``."""
    model, states = learn(train, text_col, order, words, grams, table)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def cuts(batches):
        n = 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                off = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() << 32 | n], pa.int64()),
                                                  pa.ListArray.from_arrays(off, part.column("id")), pa.ListArray.from_arrays(off, part.column("text"))],
                                                 ["sid", "ids", "texts"])
                n += 1

    def walk(batches):
        last, held = None, []
        for batch in batches:
            for i, sid in enumerate(batch.column("sid").to_pylist()):
                if sid != last:
                    last, held = sid, []
                body = batch.column("body")[i]
                if body.is_valid:                                  # the states of a slice, in order, come before its texts
                    held.append(unpack(body.as_py()))
                    continue
                own = [np.concatenate(x) for x in zip(*held)] if held else [np.zeros(0, np.uint64)] * 4
                out = Automaton(shared.value, texts_of(batch.column("texts")[i].values), own).score()
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, *map(pa.array, out)], ["id", "n_tokens", "n_known", "base_score", "score"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    scored = []
    for k in range(ROUNDS):
        part = narrow.where(F.pmod(F.xxhash64("id", "text"), F.lit(ROUNDS)) == k)
        cut = stable(part.mapInArrow(cuts, f"sid long, ids array<{kind}>, texts array<string>"))
        found = stable(_gathered(cut, states, shared, model.bits))
        both = found.unionByName(cut, allowMissingColumns=True)
        scored.append(stable(both.repartition("sid").sortWithinPartitions("sid", F.col("body").isNull(), "r").mapInArrow(
            walk, f"id {kind}, n_tokens long, n_known long, base_score double, score double")))
        discard(cut, found)
    discard(*states)
    shared.destroy()
    return functools.reduce(DataFrame.unionByName, scored).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
