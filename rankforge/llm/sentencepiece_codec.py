"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

``Codec.encode`` equals the sentencepiece library (BPE models with identity
normalisation, dummy prefix and byte fallback).  A text is cut into words at
places no piece spans (before a run of U+2581, and around line feeds); the
distinct words of a slice of texts go through rounds over flat symbol arrays:

* look up the rank of every neighbouring pair (one hash table, all words at once),
* take the minimum rank of each word (segmented reduction),
* merge the occurrences of that rank from left to right, all words at once,
* compact the arrays; words without a pair drop out.

Several occurrences in one word are merged together only when the merged piece
is part of no pair of equal or better rank; otherwise the leftmost alone is
merged in that round, as the library's queue would.  Words above
``LONG_WORD`` symbols use the same queue order with a heap, so that a text
without blanks costs n log n.

``Codec.decode`` gathers piece bytes by the same flat layout and decodes runs of
byte pieces as UTF-8, a faulty byte giving U+FFFD.

Defined results: null is the empty text (ids: begin, end; decoded empty);
U+2581 in a text is a blank to the library and decodes to one.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rankforge.llm.common import HashTable, slices

SPACE = "▁"
WORD = re.compile(r" +[^ \n]*|[^ \n]+|\n+")
ODD = f"^ | {{2}}|\\x00|{SPACE}"       # texts whose words the plain split would not find
NONE = np.iinfo(np.int32).max
LONG_WORD = 4096
TEXT_BYTES = 1_000_000        # texts handled together; decoding needs some forty times as much


class Codec:
    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        piece = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = np.full(256, -1, np.int64)
        plain, raw = [], [b""] * n
        byte_value = np.full(n, -1, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                byte_value[i] = int(piece[i][1:-1], 16)
                self.byte_id[byte_value[i]] = i
            elif sp.is_unknown(i):
                raw[i] = sp.decode([i]).encode()
            elif not sp.is_control(i):
                plain.append(i)
                raw[i] = piece[i].replace(SPACE, " ").encode()
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte fallback")
        for probe in ("á ﬁ", "  x  "):
            if sp.decode(sp.encode(probe)) != probe:
                raise ValueError("only models with identity normalisation are supported")
        if any(SPACE in piece[i].lstrip(SPACE) or "\n" in piece[i] for i in plain):
            raise ValueError("a piece spans a word boundary")
        ident = {piece[i]: i for i in plain}
        # equal scores share a rank; 0 is the best
        ranks = {s: k for k, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        rank = np.full(n, NONE, np.int32)
        for i in plain:
            rank[i] = ranks[sp.get_score(i)]
        left, right, made = [], [], []
        for i in plain:
            for k in range(1, len(piece[i])):
                a, b = ident.get(piece[i][:k]), ident.get(piece[i][k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(i)
        left, right, made = (np.array(x, np.int64) for x in (left, right, made))
        best = np.full(n, NONE, np.int32)              # best rank of a pair that a piece is part of
        np.minimum.at(best, left, rank[made])
        np.minimum.at(best, right, rank[made])
        self.together = best > rank                     # all occurrences may be merged in one round
        self.rank, self.n = rank, n
        self.pairs = HashTable(left << 32 | right, made)
        self.char = np.full(0x110000, -1, np.int64)
        for p, i in ident.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.char[ord(" ")] = self.char[ord(SPACE)]
        self.byte_value = byte_value
        self.raw_len = np.array([len(r) for r in raw], np.int64)
        self.raw_at = np.concatenate([[0], np.cumsum(self.raw_len)])[:-1]
        self.raw = np.frombuffer(b"".join(raw) or b"\0", np.uint8)
        self.dummy = np.zeros(n, bool)                 # pieces whose first blank a text does not show at its start
        self.dummy[[i for i in plain if piece[i].startswith(SPACE)]] = True

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece each pair makes, -1 if none."""
        return self.pairs.get(left << 32 | right)

    def _symbols(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Character pieces of all words end to end, and the word of each.

        A character without a piece stands as its bytes, noted as -1 - id: they merge with nothing.
        """
        off = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
        raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
        lead = (raw & 0xC0) != 0x80
        code = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        sym = self.char[code]
        lead_at = np.flatnonzero(lead)
        width = np.diff(np.append(lead_at, len(raw)))
        word = np.repeat(np.arange(len(words)), np.diff(off))[lead_at]
        strange = sym < 0
        if not strange.any():
            return sym, word
        times = np.where(strange, width, 1)
        out = np.repeat(sym, times)
        out[np.repeat(strange, times)] = -1 - self.byte_id[raw[np.repeat(strange, width)]]
        return out, np.repeat(word, times)

    def merge_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all words and the number of ids of each."""
        ids, word = self._symbols(words)
        live = (np.bincount(word, minlength=len(words)) <= LONG_WORD)[word]
        done_ids, done_word = [], []
        for k in np.unique(word[~live]):
            done_ids.append(np.array(self._queue(ids[word == k].tolist()), np.int64))
            done_word.append(np.full(len(done_ids[-1]), k))
        ids, word = ids[live], word[live]
        while len(ids):
            same = np.flatnonzero((word[:-1] == word[1:]) & (ids[:-1] >= 0) & (ids[1:] >= 0))
            made = self.pair(ids[same], ids[same + 1])
            ok = made >= 0
            same, made = same[ok], made[ok]
            if not len(same):
                break
            w, r = word[same], self.rank[made]
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            low = np.repeat(np.minimum.reduceat(r, first), np.diff(np.append(first, len(w))))
            pick = np.flatnonzero(r == low)
            at, made, w = same[pick], made[pick], w[pick]
            # leftmost first: of a chain of overlapping pairs every second one
            chain = np.concatenate([[False], at[1:] == at[:-1] + 1])
            head = np.maximum.accumulate(np.where(chain, 0, np.arange(len(at))))
            take = (np.arange(len(at)) - head) % 2 == 0
            lead = np.concatenate([[True], w[1:] != w[:-1]])
            whole = np.logical_and.reduceat(self.together[made], np.flatnonzero(lead))
            take &= lead | whole[np.cumsum(lead) - 1]
            at, made = at[take], made[take]
            ids = ids.copy()
            ids[at] = made
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            alive = np.zeros(len(words), bool)
            alive[w] = True
            ids, word = ids[keep], word[keep]
            stay = alive[word]                    # words that merged nothing are finished
            done_ids.append(ids[~stay])
            done_word.append(word[~stay])
            ids, word = ids[stay], word[stay]
        done_ids.append(ids)
        done_word.append(word)
        ids, word = np.concatenate(done_ids), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        ids = ids[order]
        ids = np.where(ids < 0, -1 - ids, ids).astype(np.int32)
        return ids, np.bincount(word, minlength=len(words)).astype(np.int64)

    def _queue(self, sym: list[int]) -> list[int]:
        """The same merges for one long word: a queue by (rank, place)."""
        n = len(sym)
        ids, nxt, prv = list(sym), list(range(1, n + 1)), list(range(-1, n - 1))
        arr = np.array(sym, np.int64)
        both = np.flatnonzero((arr[:-1] >= 0) & (arr[1:] >= 0))
        made = self.pair(arr[both], arr[both + 1])
        heap = [(int(self.rank[m]), int(i), int(ids[i]), int(ids[i + 1]), int(m))
                for i, m in zip(both, made) if m >= 0]
        heapq.heapify(heap)
        seen: dict[tuple[int, int], int] = {}
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = m, None
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for x in (prv[i], i):
                y = nxt[x] if x >= 0 else n
                if y < n and ids[x] >= 0 and ids[y] >= 0:
                    p = ids[x], ids[y]
                    if p not in seen:
                        seen[p] = int(self.pair(np.array(p[:1], np.int64), np.array(p[1:], np.int64))[0])
                    if seen[p] >= 0:
                        heapq.heappush(heap, (int(self.rank[seen[p]]), x, *p, seen[p]))
        return [x for x in ids if x is not None]

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts end to end, as a dictionary array, and how many each text has."""
        odd = pc.fill_null(pc.match_substring_regex(texts, ODD), False)
        plain = texts.filter(pc.invert(odd))
        cut = pc.if_else(pc.equal(plain, ""), "", pc.binary_join_element_wise(" ", plain, ""))
        cut = pc.replace_substring(pc.replace_substring(cut, "\n", "\0\n\0"), " ", "\0 ")
        lists = pc.split_pattern(cut, "\0")
        if pc.any(odd).as_py():
            other = pa.array([WORD.findall(" " + t.replace(SPACE, " ")) for t in texts.filter(odd).to_pylist()], lists.type)
            place = np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")
            back = np.empty(len(place), np.int64)
            back[place] = np.arange(len(place))
            lists = pa.concat_arrays([lists, other]).take(pa.array(back))
        return lists.flatten().dictionary_encode(), pc.list_value_length(lists).to_numpy().astype(np.int64)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, with begin and end ids, and the number of ids of each text."""
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string()), "")
        coded, count = self.words(texts)
        ids, length = self.merge_words(coded.dictionary)
        start = np.cumsum(length) - length
        k = coded.indices.to_numpy()
        size = length[k]
        upto = np.concatenate([[0], np.cumsum(size)])
        text_words = np.concatenate([[0], np.cumsum(count)])
        per_text = upto[text_words[1:]] - upto[text_words[:-1]] + 2
        out = np.empty(int(per_text.sum()), np.int32)
        end = np.cumsum(per_text)
        first = end - per_text
        body = np.ones(len(out), bool)
        body[first], body[end - 1] = False, False
        out[first], out[end - 1] = self.bos, self.eos
        out[body] = ids[np.arange(int(upto[-1])) + np.repeat(start[k] - upto[:-1], size)]
        return out, per_text

    def decode(self, ids: np.ndarray, per_text: np.ndarray) -> list[str]:
        """The text of each run of ids, as the library decodes it."""
        return [d.decode() for d in self.decode_utf8(ids, per_text)]

    def decode_utf8(self, ids: np.ndarray, per_text: np.ndarray) -> list[bytes]:
        ids = ids.astype(np.int64)
        if (ids < 0).any() or (ids >= self.n).any():
            raise ValueError("id outside the vocabulary")
        size = self.raw_len[ids].copy()
        byte = self.byte_value[ids]
        is_byte = byte >= 0
        size[is_byte] = 1
        upto = np.concatenate([[0], np.cumsum(size)])
        src = np.arange(int(upto[-1])) + np.repeat(self.raw_at[ids] - upto[:-1], size)
        src[upto[:-1][is_byte]] = 0
        data = self.raw[src]
        data[upto[:-1][is_byte]] = byte[is_byte]
        data = data.tobytes()
        ends = np.cumsum(per_text)
        # ids without bytes (begin, end, ...) inside a text part a run of byte pieces
        silent = np.concatenate([[0], np.cumsum(size == 0)])
        bytes_upto = np.concatenate([[0], np.cumsum(is_byte & (byte >= 128))])
        out = []
        for a, b in zip((ends - per_text).tolist(), ends.tolist()):
            part = data[upto[a]:upto[b]]
            if bytes_upto[b] > bytes_upto[a] and not (silent[max(a, b - 1)] == silent[min(a + 1, b)] and _valid(part)):
                out.append(self._decode_faulty(ids[a:b], is_byte[a:b], byte[a:b]).encode())
                continue
            if part.startswith(b" ") and self.dummy[ids[a:b][size[a:b] > 0][0]]:
                part = part[1:]                 # the dummy prefix
            out.append(part)
        return out

    def _decode_faulty(self, ids, is_byte, byte) -> str:
        """Runs of byte pieces that are no UTF-8: every faulty byte becomes U+FFFD."""
        parts, run, first = [], bytearray(), True
        for i, isb, b in zip(ids.tolist(), is_byte.tolist(), byte.tolist()):
            if isb:
                run.append(b)
                first = False
                continue
            parts.append(_bytes_to_text(bytes(run)))
            run.clear()
            piece = self.raw[self.raw_at[i]:self.raw_at[i] + self.raw_len[i]].tobytes().decode()
            if first and piece:
                piece, first = piece[1:] if self.dummy[i] else piece, False
            parts.append(piece)
        return "".join([*parts, _bytes_to_text(bytes(run))])


def _valid(part: bytes) -> bool:
    try:
        part.decode("utf-8")
        return True
    except UnicodeDecodeError:
        return False


def _bytes_to_text(run: bytes) -> str:
    out, i = [], 0
    while i < len(run):
        for k in (1, 2, 3, 4):
            try:
                out.append(run[i:i + k].decode("utf-8"))
                i += k
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            i += 1
    return "".join(out)


@functools.lru_cache(maxsize=1)
def codec_of(path: str) -> Codec:
    """The codec of a worker, which serves its later tasks too."""
    return Codec(path)


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  with_values: bool = False) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded if ``with_values``).

    One map-side pass without a shuffle; ids and decoded texts leave the task only on request.
    """
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if with_values:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    spec = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_values else "")

    def run(batches):
        codec = codec_of(model_path)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                ids, count = codec.encode(part.column("text"))
                decoded = codec.decode_utf8(ids, count)
                raw, end = memoryview(ids.astype("<u4")).cast("B"), np.cumsum(count)
                cols = [part.column("id"), pa.array(count, pa.int64()),
                        pa.array([hashlib.sha256(raw[4 * (e - n):4 * e]).hexdigest() for e, n in zip(end.tolist(), count.tolist())], pa.string()),
                        pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())]
                if with_values:
                    cols += [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], end]), pa.int32()), pa.array(ids, pa.int32())),
                             pa.array([d.decode() for d in decoded], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["id"] + [f[0] for f in fields])

    narrow = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    id_type = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {id_type}, {spec}")
