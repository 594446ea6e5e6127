"""Benchmark decontamination by spaced-seed hashing.

A seed is a window of tokens of which a fixed mask selects some positions, so
that a substitution on an ignored position leaves its hash unchanged.  All
seeds of the benchmark (each mask at each position) are hashed into a table;
the seeds of every document are joined with it on the map side.  A hit fixes an
item and an alignment, which is verified on the tokens themselves: the best
ungapped stretch (match +1, substitution -2) around the hit must hold at least
``MIN_MATCH`` equal tokens (all of a shorter item) at an identity of
``IDENTITY`` or more.  Items shorter than the masks are matched whole, token by
token, through the same hash join.

The benchmark side is broadcast in blocks of about ``BLOCK_BYTES`` of text, so a
benchmark of any size is covered and no row of the documents is shuffled.  After
every ``BLOCKS_AT_ONCE`` blocks the result so far is written, so that no stage
holds more of them.  Hits are verified ``CELLS`` at a time, however common a seed is.

Tokens are runs of letters, digits and other non-ASCII characters, lowered (A-Z,
Latin-1 capitals), so punctuation does not hide a passage; in scripts that are
written without blanks (``UNSPACED``) every character is a token.  Defined results:
null or empty texts match nothing; items without a token are not searched; an
empty benchmark matches nothing; repeated rows are reported each; repeated
benchmark rows give one row per distinct id and alignment result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankforge.llm.common import HashTable, discard, mix64, plain_words, slices, span_hashes, stable, texts_of

# fixed masks of weight 6; 0 marks an ignored position
MASKS = ("111111", "1111011", "11101011", "110110101")
MIN_MATCH = 10
IDENTITY = 0.8
BLOCK_BYTES = 8_000_000
BLOCKS_AT_ONCE = 4
CELLS = 2_000_000          # token comparisons at a time
# fixed values: Unicode ranges of scripts written without blanks (Thai to Tibetan, Myanmar, Khmer, kana, CJK)
UNSPACED = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
            (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))
# fixed values: Unicode ranges of punctuation beyond ASCII
PUNCTUATION = ((0x00A0, 0x00A9), (0x00AB, 0x00B1), (0x00B4, 0x00B4), (0x00B6, 0x00B8), (0x00BB, 0x00BB), (0x00BF, 0x00BF),
               (0x2000, 0x206F), (0x3000, 0x303F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the characters of more than one byte, their code points) of UTF-8 bytes."""
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at].astype(np.int64)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & np.where(size == 2, 0x1F, np.where(size == 3, 0x0F, 0x07))
    for k in (1, 2, 3):
        more = size > k
        point[more] = point[more] << 6 | data[np.minimum(at[more] + k, len(data) - 1)] & 0x3F
    return at, point


def _in(point: np.ndarray, ranges) -> np.ndarray:
    hit = np.zeros(len(point), bool)
    for low, high in ranges:
        hit |= (point >= low) & (point <= high)
    return hit


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, tokens before each text, n + 1)."""
    data, start, end, upto, first = plain_words(texts, digits=True)
    at, point = code_points(data)
    single, silent = _in(point, UNSPACED), _in(point, PUNCTUATION)
    if single.any() or silent.any():
        inside = np.zeros(len(data) + 1, bool)
        for k in np.unique(end - start).tolist():                     # bytes of words, one length at a time
            own = start[end - start == k]
            if k <= 64:
                for j in range(k):
                    inside[own + j] = True
            else:
                for a in own.tolist():
                    inside[a:a + k] = True
        size = 2 + (data[at] >= 0xE0) + (data[at] >= 0xF0)
        cut = np.zeros(len(data) + 1, bool)                           # a token begins here
        for j in range(4):
            inside[at[silent & (size > j)] + j] = False
        cut[at[single]] = True
        cut[at[single] + size[single]] = True
        before = np.concatenate([[False], inside[:-1]])
        start = np.flatnonzero(inside & (~before | cut))
        stop = ~inside[:-1] & before[:-1] | (inside[:-1] & before[:-1] & cut[:-1])
        end = np.append(np.flatnonzero(stop), [len(data)] if before[-1] else np.zeros(0, np.int64))
        upto = np.searchsorted(start, first, "left")
    return span_hashes(data, start, end), upto


def seed_keys(tok: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """Hash of every window of ``tok`` under a mask."""
    m = len(tok) - len(mask) + 1
    key = np.full(max(m, 0), salt, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1" and m > 0:
            key = key * np.uint64(0x9E3779B97F4A7C15) + tok[k:k + m]
    return mix64(key)


class Seeds:
    """The hashed seeds of one block of benchmark items."""

    def __init__(self, ids: list, texts: list[str], min_match: int = MIN_MATCH, identity: float = IDENTITY):
        self.min_match, self.identity = min_match, identity
        tok, upto = tokens(texts)
        self.ids, self.items = [], []
        for k, i in enumerate(ids):
            own = tok[upto[k]:upto[k + 1]]
            if len(own):
                self.ids.append(i)
                self.items.append(own)
        # items below the weight of the masks are matched whole
        short = sorted({len(t) for t in self.items if len(t) < len(MASKS[0])})
        self.masks = [*MASKS, *("1" * n for n in short)]
        keys, item, place = [], [], []
        for s, mask in enumerate(self.masks):
            for k, t in enumerate(self.items):
                if s >= len(MASKS) and len(t) != len(mask):
                    continue
                key = seed_keys(t, mask, s)
                keys.append(key)
                item.append(np.full(len(key), k))
                place.append(np.arange(len(key)))
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        item = np.concatenate(item) if item else np.zeros(0, np.int64)
        place = np.concatenate(place) if place else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        key, self.item, self.place = key[order], item[order], place[order]
        own, self.first, self.size = np.unique(key, return_index=True, return_counts=True)
        self.table = HashTable(own, np.arange(len(own)))
        self.maybe = np.zeros(1 << 20, bool)           # most seeds of a document end here
        self.maybe[(own >> np.uint64(44)).astype(np.int64)] = True

    def search(self, tok: np.ndarray, upto: np.ndarray):
        """Verified overlaps: arrays (text, item, matched, length, first token in the text)."""
        out = []
        for s, mask in enumerate(self.masks):
            key = seed_keys(tok, mask, s)
            at = np.flatnonzero(self.maybe[(key >> np.uint64(44)).astype(np.int64)])
            entry = self.table.get(key[at])
            at, entry = at[entry >= 0], entry[entry >= 0]
            hits = np.concatenate([[0], np.cumsum(self.size[entry])])
            lo = 0
            while lo < len(at):                                              # a common seed's hits, some at a time
                hi = max(lo + 1, int(np.searchsorted(hits, hits[lo] + CELLS, "right")) - 1)
                n = self.size[entry[lo:hi]]
                post = np.repeat(self.first[entry[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                pos = np.repeat(at[lo:hi], n)
                out += self._alignments(tok, upto, pos, self.item[post], pos - self.place[post])
                lo = hi
        return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5

    def _alignments(self, tok, upto, pos, item, shift):
        """Verified overlaps of hits, each alignment once."""
        text = np.searchsorted(upto, pos, "right") - 1
        found = np.unique(np.stack([item, text, shift], 1), axis=0)
        edge = np.flatnonzero(np.diff(found[:, 0], prepend=-1, append=-1))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            k = int(found[a, 0])
            step = max(1, CELLS // len(self.items[k]))
            for i in range(a, b, step):
                own = found[i:min(i + step, b)]
                yield self._verify(tok, upto, self.items[k], k, own[:, 1], own[:, 2])

    def _verify(self, tok, upto, want, k, text, shift):
        at = shift[:, None] + np.arange(len(want))
        inside = (at >= upto[text][:, None]) & (at < upto[text + 1][:, None])
        same = inside & (tok[np.clip(at, 0, len(tok) - 1)] == want)
        score = np.concatenate([np.zeros((len(text), 1)), np.cumsum(np.where(same, 1, -2), 1)], 1)
        low = np.minimum.accumulate(score, 1)
        past = (score - low).argmax(1)
        rows = np.arange(len(text))
        first = np.where(np.arange(score.shape[1]) <= past[:, None], score, np.inf).argmin(1)
        hits = np.concatenate([np.zeros((len(text), 1), np.int64), np.cumsum(same, 1)], 1)
        matched, length = hits[rows, past] - hits[rows, first], past - first
        ok = (matched >= min(self.min_match, len(want))) & (matched >= self.identity * length)
        return text[ok], np.full(int(ok.sum()), k), matched[ok], length[ok], shift[ok] + first[ok]


def seed_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES):
    """Broadcast seed tables, one per block of the benchmark."""
    own = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL").distinct()
    total = own.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        rows = own.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).orderBy("id", "text").collect()   # about one block
        yield benchmark.sparkSession.sparkContext.broadcast(Seeds([r.id for r in rows], [r.text for r in rows]))


def _searched(seeds, text_col: str):
    def run(batches):
        s = seeds.value
        for batch in batches:
            for part in slices(batch, text_col):
                tok, upto = tokens(texts_of(part.column(text_col)))
                yield part, upto, s.search(tok, upto), s
    return run


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per contaminated document and item: id, item_id, matched, length, item_tokens, first_token."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = narrow.schema["id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    spec = f"id {kinds[0]}, item_id {kinds[1]}, matched long, length long, item_tokens long, first_token long"
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    out = None
    for block, seeds in enumerate(seed_blocks(benchmark, item_col, item_text_col), start=1):
        def run(batches, seeds=seeds):
            for part, upto, (text, item, matched, length, first), s in _searched(seeds, "text")(batches):
                order = np.lexsort((first, -matched, item, text))
                best = order[np.flatnonzero(np.concatenate([[True], (np.diff(text[order]) != 0) | (np.diff(item[order]) != 0)]))] \
                    if len(order) else order
                if not len(best):
                    continue
                cols = [part.column("id").take(pa.array(text[best])), pa.array([s.ids[i] for i in item[best].tolist()], item_type),
                        pa.array(matched[best], pa.int64()), pa.array(length[best], pa.int64()),
                        pa.array([len(s.items[i]) for i in item[best].tolist()], pa.int64()),
                        pa.array(first[best] - upto[text[best]], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["id", "item_id", "matched", "length", "item_tokens", "first_token"])
        found = narrow.mapInArrow(run, spec)
        out = found if out is None else out.unionByName(found)
        if block % BLOCKS_AT_ONCE == 0:
            out = stable(out)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, with their own columns."""
    written = []
    for block, seeds in enumerate(seed_blocks(benchmark, item_col, item_text_col), start=1):
        def run(batches, seeds=seeds):
            for part, _, (text, *_), _ in _searched(seeds, text_col)(batches):
                keep = np.ones(part.num_rows, bool)
                keep[text] = False
                yield part.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
        if block % BLOCKS_AT_ONCE == 0:
            docs = stable(docs)
            discard(*written)
            written = [docs]
    return docs
