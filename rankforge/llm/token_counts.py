"""Token counts of a byte-level BPE by a two-tier lookup on the map side.

The tokens of a text are the sum over its pre-tokens.  Tier one is a compact
hash table (64-bit key of the pre-token's bytes -> number of tokens) of the
pre-tokens that are frequent in the corpus, broadcast to all tasks; tier two is
a bounded cache in each worker, which encodes a pre-token it has not met with
the tokenizers library.  No row of pre-tokens is ever shuffled: a first pass
keeps Misra-Gries counters in every task and sends only those over
1/``FREQUENT`` of the task's pre-tokens; of their sums the table takes those
over 1/``FREQUENT`` of all, so at most ``FREQUENT`` rows whatever the data.  The
table decides speed alone, never a count.

Pre-tokens are found with whole arrays of code points, by the rule of the
byte-level pre-tokenizer: contractions, an optional blank before a run of
letters, digits or other signs, and runs of white space that leave their last
character to what follows.

Defined results: null is the empty text (0 bytes, 0 tokens); a special string
inside a text counts as one token and parts the text, as the library's default.
"""

from __future__ import annotations

import json
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import HashTable, slices, span_hashes, texts_of

FREQUENT = 20_000
CACHE_KEYS = 400_000
LETTER, NUMBER, OTHER, BLANK = 0, 1, 2, 3
# fixed values: the code points with the Unicode property White_Space
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_CLASS = None


def char_classes() -> np.ndarray:
    global _CLASS
    if _CLASS is None:
        first = [unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)]
        _CLASS = np.array([LETTER if c == "L" else NUMBER if c == "N" else OTHER for c in first], np.uint8)
        _CLASS[WHITE] = BLANK
    return _CLASS


def pre_tokens(segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all segments, start and end byte of each pre-token, segment of each)."""
    whole = "".join(segments)
    n = len(whole)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none, none
    code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kind = char_classes()[code]
    edge = np.zeros(n + 3, bool)                        # a segment starts here
    seg_end = np.cumsum([len(s) for s in segments])
    edge[0] = True
    edge[seg_end] = True
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    # a run of white space leaves its last character to what follows in the segment
    after = np.flatnonzero(run[1:] & ~edge[1:n] & (kind[:-1] == BLANK)) + 1
    start[after - 1] = True
    start[after[code[after - 1] == 32]] = False
    # contractions: an apostrophe that stands alone between a word, or the start, and letters
    i = np.flatnonzero((code == 39) & run)
    i = i[i + 1 < n]
    i = i[(kind[i + 1] == LETTER) & ~edge[i + 1] & (edge[i] | (code[i - 1] != 32))]
    one = code[i + 1]
    two = np.where((i + 2 < n) & ~edge[i + 2], code[np.minimum(i + 2, n - 1)], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for hit, size in ((short, 2), (long & ~short, 3)):
        at = i[hit]
        start[at + 1] = False
        if size == 3:
            start[at + 2] = False
        rest = at + size
        start[rest[rest < n]] = True
    at = np.flatnonzero(start)
    width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
    byte = np.concatenate([[0], np.cumsum(width)])
    begin = byte[at]
    return (np.frombuffer(whole.encode("utf-8"), np.uint8), begin, np.append(begin[1:], byte[-1]),
            np.searchsorted(seg_end, at, "right"))


class Counter:
    """Counts of pre-tokens by key: the broadcast table, then the worker's cache, then the library."""

    def __init__(self, path: str, frequent: HashTable | None = None):
        import os

        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = special_strings(path)
        self.frequent = frequent
        self._forget()

    def _forget(self):
        self.keys, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.cache = HashTable(self.keys, self.sizes)

    def segments(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Texts parted at special strings; the text of each segment and the specials of each text."""
        parts, of, specials = [], [], np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            own = [t]
            for s in self.special:
                if s in t:
                    own = [p for x in own for p in x.split(s)]
            specials[k] = len(own) - 1
            parts += own
            of += [k] * len(own)
        return parts, np.array(of, np.int64), specials

    def encode_sizes(self, words: list[str]) -> np.ndarray:
        return np.array([len(e.ids) for e in self.tokenizer.encode_batch(words, add_special_tokens=False)], np.int64)

    def sizes_of(self, data, begin, end) -> np.ndarray:
        key = span_hashes(data, begin, end)
        size = self.frequent.get(key) if self.frequent is not None else np.full(len(key), -1, np.int64)
        todo = np.flatnonzero(size < 0)
        size[todo] = self.cache.get(key[todo])
        todo = todo[size[todo] < 0]
        if len(todo):
            new, first, back = np.unique(key[todo], return_index=True, return_inverse=True)
            where = todo[first]
            fresh = self.encode_sizes([data[a:b].tobytes().decode() for a, b in zip(begin[where].tolist(), end[where].tolist())])
            size[todo] = fresh[back]
            if len(self.keys) > CACHE_KEYS:
                self._forget()
            self.keys, self.sizes = np.concatenate([self.keys, new]), np.concatenate([self.sizes, fresh])
            self.cache = HashTable(self.keys, self.sizes)
        return size

    def count(self, texts: list[str]) -> np.ndarray:
        parts, of, specials = self.segments(texts)
        data, begin, end, seg = pre_tokens(parts)
        return specials + np.bincount(of[seg], self.sizes_of(data, begin, end), minlength=len(texts)).astype(np.int64)


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    added = conf.get("added_tokens") or []
    plain = all(not (a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]) for a in added)
    pre = conf.get("pre_tokenizer") or {}
    if (conf.get("normalizer") or not plain or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or not pre.get("use_regex", True) or conf["model"].get("ignore_merges")):
        raise ValueError("only byte-level BPE files without normalizer or prefix blank are supported")
    return sorted((a["content"] for a in added), key=len, reverse=True)


def frequent_pre_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """(pre_token, n): at most ``frequent`` of the most frequent, from counters that every task keeps of those over 1/frequent of its own."""
    def run(batches):
        special = Counter(tokenizer_path)
        keys, count, words = np.zeros(0, np.uint64), np.zeros(0, np.int64), {}
        total = 0
        for batch in batches:
            for part in slices(batch, "text"):
                parts, _, _ = special.segments(texts_of(part.column("text")))
                data, begin, end, _ = pre_tokens(parts)
                short = end - begin <= 64
                key = span_hashes(data, begin, end)[short]
                total += len(end)
                own, first, n = np.unique(key, return_index=True, return_counts=True)
                # add, then take the smallest kept count from all (Misra-Gries)
                allk, back = np.unique(np.concatenate([keys, own]), return_inverse=True)
                sums = np.bincount(back, np.concatenate([count, n]), minlength=len(allk)).astype(np.int64)
                if len(allk) > 2 * frequent:
                    sums -= np.partition(sums, -2 * frequent)[-2 * frequent]
                keep = sums > 0
                keys, count = allk[keep], sums[keep]
                place = np.flatnonzero(short)[first]
                live = np.isin(own, keys)
                fresh = {int(k): data[begin[p]:end[p]].tobytes().decode() for k, p in zip(own[live], place[live]) if int(k) not in words}
                words = {k: w for k in keys.tolist() if (w := words.get(k) or fresh.get(k)) is not None}
        send = count * frequent >= total
        names = [words[k] for k in keys[send].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(count[send], pa.int64()),
                                          pa.array([total if i == 0 else 0 for i in range(len(names))], pa.int64())],
                                         ["pre_token", "n", "total"])

    found = docs.selectExpr(f"`{text_col}` AS text").mapInArrow(run, "pre_token string, n long, total long")
    sums = found.groupBy("pre_token").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    # the sums of the counters stay below the true counts, so at most ``frequent`` of them pass
    return sums.orderBy(F.desc("n"), "pre_token").limit(frequent).select("pre_token", "n")


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    top = [r.pre_token for r in frequent_pre_tokens(docs, tokenizer_path, text_col, frequent).collect()]   # at most ``frequent``
    raw = [w.encode() for w in top]
    end = np.cumsum([len(r) for r in raw], dtype=np.int64)
    keys = span_hashes(np.frombuffer(b"".join(raw) or b"\0", np.uint8), np.concatenate([[0], end[:-1]]).astype(np.int64) if top else end, end)
    table = docs.sparkSession.sparkContext.broadcast(HashTable(keys, Counter(tokenizer_path).encode_sizes(top) if top else np.zeros(0, np.int64)))

    def run(batches):
        counter = Counter(tokenizer_path, table.value)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part.column("text"))
                n = counter.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                     pa.array(n > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    narrow = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
