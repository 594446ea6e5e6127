"""Tokenizers, language id, toxicity: against the libraries, brute force or held-out accuracy."""
import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.01"


def sha(b):
    return hashlib.sha256(b).hexdigest()


# ---- op1

@pytest.fixture(scope="module")
def pieces():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    return path, sentencepiece.SentencePieceProcessor(model_file=path)


def odd_strings(n=2000, seed=1):
    rnd = random.Random(seed)
    chars = [*"abcdefghi  ingthe\n\t▁ éß𝒳梦\0<>|\"'", "‍", "�", " "]
    return ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_codec_equals_library(pieces):
    from rankforge.llm.sentencepiece_codec import Codec
    path, sp = pieces
    codec = Codec(path)
    texts = ["", " ", "   ", "\n", "a" * 500, " " * 700, "ab" * 3000, " " * 6000 + "x", "▁", "a▁b", "<s></s><unk><0x0A>", *odd_strings()]
    ids, n = codec.encode(texts)
    want = sp.encode(texts, add_bos=True, add_eos=True)
    end = np.cumsum(n)
    assert [ids[e - k:e].tolist() for e, k in zip(end, n)] == want
    assert codec.decode(ids, n) == sp.decode(want)


def test_codec_decodes_any_ids(pieces):
    from rankforge.llm.sentencepiece_codec import Codec
    path, sp = pieces
    rnd = random.Random(3)
    runs = [[rnd.randint(0, 300) if rnd.random() < 0.7 else rnd.randint(0, 31999) for _ in range(rnd.randint(0, 12))] for _ in range(5000)]
    got = Codec(path).decode(np.array([i for r in runs for i in r]), np.array([len(r) for r in runs]))
    assert got == sp.decode(runs)


def test_op1_equals_library(spark, pieces):
    from rankforge.llm.queries import QUERIES
    path, sp = pieces
    got = {r.doc_id: r for r in QUERIES["op1_sentencepiece"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = sp.encode(r.text or "", add_bos=True, add_eos=True)
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(sp.decode(ids).encode()))


def test_op1_odd_rows(spark, odd_docs, pieces):
    from rankforge.llm.sentencepiece_codec import encode_decode
    path, sp = pieces
    got = encode_decode(odd_docs, path, with_values=True).collect()
    assert sorted(r.decoded for r in got) == sorted(r.text or "" for r in odd_docs.collect())
    assert all(r.ids == sp.encode(r.decoded, add_bos=True, add_eos=True) for r in got)
    assert encode_decode(odd_docs.limit(0), path).count() == 0


# ---- op9

def test_token_counts_equal_library(spark, odd_docs):
    from tokenizers import Tokenizer

    from rankforge.llm.queries import QUERIES
    from rankforge.llm.token_counts import Counter, token_counts
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rnd = random.Random(2)
    parts = [*"ab  '''stmdrevel12!\n\t\r éß梦 ", "<|endoftext|>", "'ll", "'re", "\x1c", "\x85", "𝒳", "½"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(5000)] + ["", "a" * 20000, " " * 1000 + "x"]

    def want(t):
        return len(tok.encode(t or "", add_special_tokens=False).ids)
    counter = Counter(path)
    assert counter.count(texts).tolist() == [want(t) for t in texts]
    got = {r.doc_id: r for r in QUERIES["op9_token_counts"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n = want(r.text)
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len((r.text or "").encode()), n, n > 512)
    # a table of a few pre-tokens and a table of many change nothing
    for frequent in (1, 50):
        odd = token_counts(odd_docs, path, frequent=frequent).collect()
        assert sorted(r.n_tokens for r in odd) == sorted(want(r.text) for r in odd_docs.collect())
    assert token_counts(odd_docs.limit(0), path).count() == 0


def test_token_counts_cache_is_bounded(monkeypatch):
    from rankforge.llm import token_counts as t
    monkeypatch.setattr(t, "CACHE_KEYS", 5)
    counter = t.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    for k in range(20):
        assert counter.count([f"word{k} word{k} again"]).tolist() == t.Counter(public_tokenizers.path("byte_bpe_50k.json")).count([f"word{k} word{k} again"]).tolist()
    assert len(counter.keys) < 20


# ---- op2

def test_profiles_equal_plain_counting():
    from rankforge.llm.language_id import Profiles, ngram_keys, profile
    text = "The cat, the CAT; über!! "
    padded = " the cat the cat über "
    grams = [padded[i:i + n] for n in range(1, 5) for i in range(len(padded) - n + 1)]
    grams = [g for g in grams if g.strip() and " " not in g[1:-1]]
    keys = ngram_keys(text)
    assert len(keys) == len(grams) and len(set(keys.tolist())) == len(set(grams))
    assert sorted(np.unique(keys, return_counts=True)[1].tolist()) == sorted(pd.Series(grams).value_counts().tolist())
    top = profile(keys, 5)
    n = dict(zip(*np.unique(keys, return_counts=True)))
    assert top.tolist() == sorted(n, key=lambda k: (-n[k], k))[:5]
    # out-of-place distance by hand: equal profiles have distance 0, a tie goes to the first name
    p = Profiles(["aa", "bb"], {"aa": top.astype(np.int64).tolist(), "bb": top.astype(np.int64).tolist()}, 5)
    assert p.predict(text) == ("aa", 1.0)
    assert p.predict("12 %%") == p.predict("") == p.predict(None) == ("und", 0.0)


def test_op2_held_out_accuracy(spark):
    from rankforge.llm.queries import QUERIES
    got = QUERIES["op2_language_id"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs) and both.score.between(0, 1).all()
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    held = both[both.held_out & both.lang.notna()]
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_op2_odd_rows(spark, odd_docs):
    from rankforge.llm.language_id import identify, learn
    got = identify(odd_docs, learn(odd_docs)).collect()
    assert len(got) == odd_docs.count()
    assert {r.lang_pred for r in got if r.id in (2, 3, 4, 8)} == {"und"}
    assert {r.lang_pred for r in got if r.id in (1, 6)} == {"en"}
    none = learn(odd_docs.limit(0))
    assert {r.lang_pred for r in identify(odd_docs, none).collect()} == {"und"}
    assert identify(odd_docs.limit(0), none).count() == 0


# ---- op6

def test_maximal_segments_equal_brute_force():
    from rankforge.llm.toxicity import maximal_segments
    rnd = random.Random(4)

    def brute(s, lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += s[j]
                if total > 0 and (best is None or total > best[2] or total == best[2] and (i, j + 1) == best[:2]):
                    best = (i, j + 1, total)
        return [] if best is None else [*brute(s, lo, best[0]), best, *brute(s, best[1], hi)]
    for _ in range(300):
        # distinct powers keep ties away, where the two may differ in what they join
        s = [rnd.choice([-1, 1]) * rnd.randint(1, 50) + rnd.random() for _ in range(rnd.randint(0, 15))]
        got = maximal_segments(np.array(s))
        assert [g[:2] for g in got] == [b[:2] for b in brute(s, 0, len(s))]
        assert all(abs(g[2] - b[2]) < 1e-9 for g, b in zip(got, brute(s, 0, len(s))))


def test_op6_held_out(spark):
    from rankforge.llm.queries import QUERIES
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    toxic = held.toxic == 1
    assert (held.predicted[toxic] == 1).mean() > 0.9 and (held.predicted[~toxic] == 1).mean() < 0.01


def test_op6_long_clean_text(spark):
    """Chance segments do not add up: all clean labelled texts joined into one are clean, with one toxic text inside not."""
    from rankforge.llm.common import crc_mod_py
    from rankforge.llm.toxicity import fit, toxicity
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    joined = docs.join(labels, "doc_id").orderBy("doc_id").collect()
    clean = " ".join(r.text for r in joined if r.toxic == 0 and r.text)
    toxic = [r.text for r in joined if r.toxic == 1 and r.text and crc_mod_py(r.doc_id, 4) != 2]
    assert len(clean.split()) > 50_000 and toxic
    rows = [(1, clean), (2, clean + " " + " ".join(toxic))]
    got = {r.id: r for r in toxicity(spark.createDataFrame(rows, "doc_id long, text string"), model, with_passages=True).collect()}
    assert got[1].predicted == 0 and got[2].predicted == 1
    assert len(got[2].passages) > len(got[1].passages)


def test_lambda_is_the_root():
    from rankforge.llm.toxicity import _lambda
    value, n = np.array([-1.0, 0.5, 2.0]), np.array([9000, 50, 5])
    root = _lambda(value, n, 3.0)
    p = np.append(n, 1) / 9056
    assert abs((p * np.exp(root * np.append(value, 3.0))).sum() - 1) < 1e-6
    assert _lambda(np.array([-1.0]), np.array([5]), -1.0) == 1.0


def test_op6_odd_rows(spark, odd_docs):
    from rankforge.llm.toxicity import fit, keep_clean, toxicity
    names = ["v" + "".join("abcdefghij"[int(c)] for c in str(i % 97)) for i in range(400)]     # different words before the same one
    rows = [(i, f"{names[i]} {bad} said text number {i} word{i}") for i in range(400) for bad in ["idiot" if i % 4 == 0 else "friend"]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(3, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    model = fit(docs, labels)
    got = {r.id: r for r in toxicity(docs, model, with_passages=True).collect()}
    assert all(r.predicted == int(i % 4 == 0) for i, r in got.items())
    assert all(rows[i][1].encode()[p.first:p.past] == b"idiot" for i, r in got.items() for p in r.passages)
    assert keep_clean(docs, model).count() == 300 and keep_clean(odd_docs, model).columns == odd_docs.columns
    assert keep_clean(odd_docs, model).count() == toxicity(odd_docs, model).count() == odd_docs.count()
    assert toxicity(odd_docs.limit(0), model).count() == keep_clean(odd_docs.limit(0), model).count() == 0
    # one class, or no labels at all
    assert {r.score for r in toxicity(docs, fit(docs, labels.where("toxic = 1"))).collect()} == {1.0}
    assert {r.score for r in toxicity(docs, fit(docs, labels.limit(0))).collect()} == {0.0}
