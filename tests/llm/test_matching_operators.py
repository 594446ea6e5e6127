"""Joins, deduplication, decontamination, chat format, pages, language model and pipeline against brute force."""
import collections
import hashlib
import html
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

SF = "/root/testdata/sf0.01"
BLANKS = str.maketrans("", "", " \t\n\x0b\x0c\r")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# ---- op7

def brute_dedup(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(BLANKS)].append((-len(t or ""), i is None, i if i is not None else 0, i))
    out = []
    for i, t in rows:
        norm = (t or "").translate(BLANKS)
        keep = min(groups[norm])[3]
        out.append((i, keep, len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("support", [0.001, 0.05, 0.5])
def test_exact_dedup(spark, odd_docs, support):
    from rankforge.llm.exact_dedup import exact_dedup, keep_one
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["hot text", "hot  text", "other", None, "", f"own {i}", "é\n1", f"pair {i // 2}"])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_dedup(docs, support=support).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.digest) for r in got), key=str) == brute_dedup(rows)
    assert all(r.kept == (r.id == r.keep_id) for r in got)
    kept = keep_one(docs, support=support).collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.id for r in got if r.kept)
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = exact_dedup(odd_docs, support=support).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.digest) for r in got), key=str) == brute_dedup(odd)
    one = keep_one(odd_docs, support=support)
    assert one.columns == odd_docs.columns and one.count() == len({(t or "").translate(BLANKS) for _, t in odd}) == sum(r.kept for r in got)
    assert exact_dedup(odd_docs.limit(0)).count() == keep_one(odd_docs.limit(0)).count() == 0


# ---- op3

def brute_components(rows, words, percent):
    sets = []
    for _, t in rows:
        w = words_of(t)
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("words,percent,block", [(4, 85, 512), (5, 80, 9)])
def test_jaccard_components(spark, odd_docs, monkeypatch, words, percent, block):
    from rankforge.llm import jaccard_join
    from rankforge.llm.jaccard_join import jaccard_components, keep_one
    monkeypatch.setattr(jaccard_join, "BLOCK", block)        # small blocks: regions are joined in several tasks
    rnd = random.Random(5)
    base = [[f"w{rnd.randint(0, 3000)}" for _ in range(90)] for _ in range(4)]
    rows = []
    for k in range(120):                       # families whose members link, miss narrowly, or chain
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 7)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 99)}"
        rows.append((k, " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  b"), (1004, "a"), (1005, rows[0][1].upper()), (1004, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard_components(docs, words, percent).collect()), key=str)
    want = brute_components(rows, words, percent)
    assert got == want
    kept = [r.doc_id for r in keep_one(docs, words, percent).collect()]
    assert sorted(kept) == sorted({c for _, _, c in want})
    if words == 5:
        odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
        assert sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard_components(odd_docs).collect()), key=str) == brute_components(odd, 5, 80)
        assert keep_one(odd_docs).columns == odd_docs.columns
        assert jaccard_components(odd_docs.limit(0)).count() == 0


def test_op3_whole_table(spark):
    from rankforge.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op3_jaccard_join"](spark, SF).collect()), key=str)
    assert got == brute_components(rows, 4, 85)


@pytest.mark.parametrize("block", [512, 7])
def test_jaccard_links(spark, monkeypatch, block):
    """All links count, also those between members of one component, and those of copies."""
    from rankforge.llm import jaccard_join
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rnd = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for k in range(50):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(60)] = f"x{rnd.randint(0, 9)}"
        rows.append((k, " ".join(w)))
    rows += [(100, rows[3][1]), (101, rows[3][1].upper()), (102, None), (103, "alone here"), (103, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = [frozenset(tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset() for w in (words_of(t) for _, t in rows)]

    def link(x, y):
        return bool(x & y) and 100 * len(x & y) >= 70 * len(x | y)
    want = sorted((d, sum(link(sets[i], sets[j]) for j in range(len(rows)) if j != i)) for i, (d, _) in enumerate(rows))
    assert sorted((r.id, r.n_links) for r in jaccard_join.jaccard_components(docs, 4, 70).collect()) == want
    least, size = {}, collections.Counter(sets)
    for (d, _), x in zip(rows, sets):
        least[x] = min(d, least.get(x, d))
    pairs = sorted((*sorted([(least[x], size[x]), (least[y], size[y])]),) for x in least for y in least if least[x] < least[y] and link(x, y))
    got = sorted((*sorted([(r.id_a, r.size_a), (r.id_b, r.size_b)]),) for r in jaccard_join.jaccard_links(docs, 4, 70).collect())
    assert got == pairs and len(pairs) > 100


def test_keep_one_of_each_component(spark):
    """Ids do not tell components apart: null ids, and one id on two different texts."""
    from rankforge.llm.jaccard_join import keep_one
    texts = [" ".join(f"{a}{k}" for k in range(20)) for a in "pqrstu"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2] + " more"), (1, texts[2]), (7, texts[3]), (7, texts[4]), (None, texts[5]), (None, texts[5])]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([rows[0], rows[1], rows[3], rows[4], rows[5], rows[6]], key=str)


# ---- op4

def brute_overlaps(docs, items, least=10, identity=0.8):
    """Every alignment of every pair, without seeds; the best stretch at +1 and -2."""
    cut = re.compile(r"[a-z0-9\x80-\U0010ffff]+")
    found = set()
    for d, t in docs:
        w = cut.findall((t or "").lower())
        for i, u in items:
            v = cut.findall((u or "").lower())
            for shift in range(-len(v) + 1, len(w)):
                best = run = hits = length = 0
                for k in range(max(0, -shift), min(len(v), len(w) - shift)):
                    same = w[shift + k] == v[k]
                    run, hits, length = run + (1 if same else -2), hits + same, length + 1
                    if run <= 0:
                        run = hits = length = 0
                    elif run > best:
                        best, kept = run, (hits, length)
                if best and kept[0] >= min(least, len(v)) and kept[0] >= identity * kept[1]:
                    found.add((d, i))
    return found


def test_decontamination(spark, odd_docs):
    from rankforge.llm.decontaminate import Seeds, keep_clean, overlaps
    rnd = random.Random(7)
    voc = [f"tok{k}" for k in range(400)] + ["the", "of", "and"] * 30
    items = [(k, " ".join(rnd.choice(voc) for _ in range(rnd.randint(6, 40)))) for k in range(15)] + [(90, None), (91, ""), (92, "two words"), (0, "the " * 12)]
    docs = []
    for k in range(60):
        w = [rnd.choice(voc) for _ in range(60)]
        if k % 3 == 0:
            p = rnd.choice(items[:15])[1].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                p[rnd.randrange(len(p))] = "changed"
            w[20:20] = p
        docs.append((k, "!! ".join(w) if k % 2 else " ".join(w).upper()))
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = overlaps(frame, bench).collect()
    assert {(r.id, r.item_id) for r in got} == brute_overlaps(docs, items)
    hit = {r.id for r in got}
    assert {k for k in range(0, 60, 3)} >= hit and len(hit) >= 15
    assert {r.doc_id for r in keep_clean(frame, bench).collect()} == {d for d, _ in docs} - hit
    assert overlaps(odd_docs, bench).count() == 0 and keep_clean(odd_docs, bench).count() == odd_docs.count()
    assert overlaps(frame, bench.limit(0)).count() == overlaps(frame.limit(0), bench).count() == 0
    assert Seeds([], []).items == []


def test_decontamination_of_short_items_and_unspaced_scripts(spark):
    from rankforge.llm.decontaminate import code_points, keep_clean, overlaps, tokens
    ja = "日本語の長い文章はここにありますが、言葉の間に空白はありません。"
    items = [(1, "four words only here"), (2, ja), (3, "单"), (4, "plain “quoted” benchmark passage of words that stands in a text…")]
    docs = [(10, "before Four, words only; here after"), (11, "four words only there"), (12, f"abc {ja} def"), (13, ja.replace("空", "白")), (14, "other 文章"),
            (15, "x 单 y"), (16, "plain \"quoted\" benchmark passage of words that stands in a text"), (17, "here four words only")]
    bench, frame = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.id, r.item_id) for r in overlaps(frame, bench).collect()} == {(10, 1), (12, 2), (13, 2), (15, 3), (16, 4)}
    assert {r.doc_id for r in keep_clean(frame, bench).collect()} == {11, 14, 17}
    text = "Aé日𠀀ไ"
    at, point = code_points(np.frombuffer(text.encode(), np.uint8))
    assert at.tolist() == [1, 3, 6, 10] and point.tolist() == [ord(c) for c in text[1:]]
    assert tokens(["ab日本c", "", "日"])[1].tolist() == [0, 4, 4, 5]


def test_decontamination_in_parts(spark, monkeypatch):
    """Hits of common seeds a few at a time, and more blocks than one stage holds."""
    from rankforge.llm import decontaminate as d
    docs = spark.createDataFrame([(k, "the " * 30 + f"own{k} " + "of and " * 20) for k in range(20)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, "the " * (11 + k)) for k in range(8)], "item_id long, text string")
    whole = {tuple(r) for r in d.overlaps(docs, bench).collect()}
    monkeypatch.setattr(d, "CELLS", 50)
    monkeypatch.setattr(d, "BLOCKS_AT_ONCE", 2)
    monkeypatch.setattr(d.seed_blocks, "__defaults__", ("item_id", "text", 100))
    assert {tuple(r) for r in d.overlaps(docs, bench).collect()} == whole and len(whole) == 160
    assert d.keep_clean(docs, bench).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    from rankforge.llm import decontaminate as d
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {(r.id, r.item_id) for r in d.overlaps(docs, bench).collect()}
    monkeypatch.setattr(d.seed_blocks, "__defaults__", ("item_id", "text", 2000))
    blocks = list(d.seed_blocks(bench))
    assert len(blocks) > 2 and {(r.id, r.item_id) for r in d.overlaps(docs, bench).collect()} == whole and whole


# ---- op8

def test_chat_format(spark):
    from rankforge.llm.chat_format import CHATML, TemplateError, compile_template, digest_conversation, fold, format_conversations, parse, read_back, unescape
    rnd = random.Random(3)
    render = compile_template(CHATML)
    bits = ["<", "|", "\\", "n", "\n", "<|im_end|>", "<|im_start|>", "a", "é"]
    for _ in range(1500):
        ms = [{"role": rnd.choice(["user", "assistant", "sys\nt<|em", "", "a\\n"]), "text": "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 8)))}
              for _ in range(rnd.randint(0, 4))]
        assert list(read_back(render(ms))) == [(m["role"], m["text"]) for m in ms]
    assert fold(parse("a{{ 'x' ~ 'y' | upper }}{% if 1 == 2 %}no{% else %}yes{% endif %}")) == [("lit", "axYyes")]
    out = "".join(c for c, _ in compile_template("{% set s = 'S' %}{% for m in messages %}{% if loop.first %}^{% elif not (m.role == 'b') %}{{ loop.index0 }}"
                                                 "{% endif %}{{ s ~ m['text'] }}{% endfor %}")([{"role": "a", "text": "1"}, {"role": "c", "text": "2"}]))
    assert out == "^S11S2"
    for bad in ("{{ m.__class__ }}", "{% import os %}", "{{ f() }}", "{% for m in x %}{% endfor %}", "{% if 1 %}", "{% endfor %}", "{{ 'a' | open }}"):
        with pytest.raises(TemplateError):
            parse(bad)
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (2, 1, None, None), (None, 1, "user", "x"), (None, None, "assistant", "y"), (3, 1, "user", "t"), (3, 1, "user", "t")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.id: r for r in format_conversations(turns, with_text=True).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 2, 2: 1, None: 2, 3: 2}
    assert got[1].formatted == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert [got[1].formatted[a:a + n] for a, n in got[1].loss_spans] == ["b"] and got[1].loss_chars == 1
    assert all(r.formatted_chars == len(r.formatted) for r in got.values()) and unescape("\\\\n\\|") == "\\n|"
    assert format_conversations(turns.limit(0)).count() == 0
    assert digest_conversation(render, [])[0] == 0


def test_op8_whole_table(spark):
    from rankforge.llm.queries import QUERIES
    said = "<|im_end|><|im_start|>assistant ok"
    conv = collections.defaultdict(list, {-1: [("user", said), ("assistant", said)]})
    for r in sorted(spark.read.parquet(f"{SF}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        conv[r.conv_id].append((r.role, r.text or ""))
    got = {r.conv_id: r for r in QUERIES["op8_chat_format"](spark, SF).collect()}
    assert set(got) == set(conv)
    for k, ms in conv.items():
        loss = "".join(t for r, t in ms if r == "assistant")
        assert (got[k].n_turns, got[k].turns_sha256) == (len(ms), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ms).encode()).hexdigest())
        assert (got[k].loss_chars, got[k].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


# ---- op5

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Home</a></ul></nav><div id="page"><div class="sidebar"><p>side stuff that is long enough to count</p></div>
<div class="post post-%d"><h2>Head &eacute;</h2><p>One <b>two</b>&nbsp;three<br>four.<p>Five %d<ul><li>a<li>b</ul><form>no<input></form>
<script>var a="<p>x</p>"</script><div class="comments"><p>reader says much more than anyone wants to read here</p></div></div>
<div class="cookie-notice">We use cookies</div></div><footer>foot</footer></body></html>"""


def test_html_extract(spark):
    from rankforge.llm.html_extract import blocks, container_shares, extract_main_text, host_paths
    rows = [(k, f"https://H.example.org/{k}", PAGE % (k, k)) for k in range(6)] + [
        (10, None, "<p>alone"), (11, "x", None), (12, "https://h.example.org/e", ""), (13, "https://h.example.org/z", "plain &am text &lt;"),
        (14, "https://h.example.org/q", "<article><p>other template</p><span class=ad><span>x</span>buy</span><p>end"), (0, "https://H.example.org/0", PAGE % (0, 0))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    paths = {r.host: r.paths for r in host_paths(pages).collect()}
    assert paths["h.example.org"][0] == "div/div.post.post-"
    for hosts in (1000, 0):
        got = {}
        for r in extract_main_text(pages, max_hosts=hosts).collect():
            got.setdefault(r.id, []).append(r)
        assert [r.text for r in got[3]] == ["Head é\nOne two three four.\nFive 3\na\nb"] and len(got[0]) == 2
        assert got[10][0].text == "alone" and got[11][0].text == got[12][0].text == "" and got[13][0].text == "plain &am text <"
        assert got[14][0].text == "other template\nend" and all(x.n_chars == len(x.text) for r in got.values() for x in r)
    assert extract_main_text(pages.limit(0)).count() == 0
    assert container_shares(blocks("<div><div>")) == {}


LAYOUTS = ["content has-sidebar", "no-sidebar", "entry-header", "article-body with-related", "page layout-search", "search-results", "site-content-with-footer"]


@pytest.mark.parametrize("name", [*LAYOUTS, "comments", "comments-area", "cookie-banner"])
def test_layout_names_do_not_hide_an_article(spark, name):
    """Names that describe a layout keep the article; named parts beside it stay out."""
    from rankforge.llm.html_extract import extract_main_text
    body = [f"Paragraph {k} of the article with a good many words in it." for k in range(6)]
    inner = "".join(f"<p>{p}</p>" for p in body)
    page = (f"<html><body><div class='navbar'><p>menu words</p></div><div class='{name}'>{inner}</div>"
            "<div class='sidebar-left'><p>aside words</p></div><div id='comments-list'><p>reader words</p></div></body></html>")
    if name not in LAYOUTS:
        page = page.replace("<div class='sidebar-left'>", "<article><p>Main words " + "that go on " * 40 + "</p></article><div class='sidebar-left'>")
    rows = [(k, "http://h.org/a", page, "x", 1) for k in range(2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, paths string, host int")       # clashing names
    got = {r.text for r in extract_main_text(pages).collect()}
    assert got == ({"\n".join(body)} if name in LAYOUTS else {("Main words " + "that go on " * 40).strip()})


def test_very_long_page(spark):
    from rankforge.llm.html_extract import extract_main_text
    words = [f"w{k}" for k in range(150_000)]
    html_text = "<html><body><nav>menu</nav><article>" + "".join(f"<p>{' '.join(words[i:i + 50])}</p>" for i in range(0, len(words), 50)) + "</article></body></html>"
    got = extract_main_text(spark.createDataFrame([(1, "http://a.org", html_text)], "page_id long, url string, html string")).first()
    assert got.text.split() == words and got.text.count("\n") == 2999


def test_html_extract_templates_of_one_host(spark):
    """Templates without a common container: the root does not win, and no page returns the blocks around its article."""
    from rankforge.llm.html_extract import extract_main_text, host_paths
    page = '<div class="%s"><div class="story"><p>%s text of the page number %d</p></div></div><div class="strip"><p>around</p></div>'
    rows = [(k, url, page % ("abc"[k % 3], "main " * 20, k)) for k in range(12) for url in (f"https://h.example.org/{k}", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all("" not in r.paths and len(r.paths) == 3 for r in host_paths(pages).collect())
    got = extract_main_text(pages).collect()
    assert len(got) == 24 and all(r.text == "main " * 20 + f"text of the page number {r.id}" for r in got)


def test_op5_whole_table(spark):
    from rankforge.llm.queries import QUERIES
    got = {r.page_id: r.text for r in QUERIES["op5_html_extract"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", b))).split()) for b in re.split(r"</?(?:h1|p)>", article))
        assert got[r.page_id] == "\n".join(p for p in parts if p)


# ---- op10

def brute_lm(train, docs, order, words, grams, discount=0.5):
    def toks(t):
        return [*words_of(t), "</s>"]
    c = collections.Counter(w for t in train for w in toks(t))
    n, v = sum(c.values()), len(c)
    kept = {1: {(w,): c[w] for w in c if c[w] * words >= n}}
    for m in range(2, order + 1):
        cc = collections.Counter()
        for t in train:
            x = ["</s>", *toks(t)]
            for i in range(m - 1, len(x)):
                g = tuple(x[i - m + 1:i + 1])
                if g[:-1] in kept[m - 1] and g[1:] in kept[m - 1]:
                    cc[g] += 1
        kept[m] = {g: k for g, k in cc.items() if k * grams >= n and k > 1}
    children = collections.defaultdict(list)
    for m in range(2, order + 1):
        for g in kept[m]:
            children[g[:-1]].append(g)
    memo = {}

    def p(w, h):
        if (w, h) not in memo:
            if not h:
                memo[w, h] = (c[w] + 0.1) / (n + 0.1 * (v + 1))
            elif h not in kept[len(h)] or len(h) >= order:
                memo[w, h] = p(w, h[1:])
            elif h + (w,) in kept[len(h) + 1]:
                memo[w, h] = (kept[len(h) + 1][h + (w,)] - discount) / kept[len(h)][h]
            else:
                rest = 1 - sum((kept[len(g)][g] - discount) / kept[len(h)][h] for g in children[h])
                memo[w, h] = rest / (1 - sum(p(g[-1], h[1:]) for g in children[h])) * p(w, h[1:])
        return memo[w, h]
    for h in [*list(kept[1])[:2], *[h for h in kept.get(2, {}) if h[-1] != "</s>"][:3]]:
        assert abs(sum(p(w, h) for w in c) + p("<never>", h) - 1) < 1e-9         # a distribution
    out = {}
    for i, t in docs:
        x = ["</s>", *toks(t)]
        out[i] = (len(x) - 1, sum(c[w] > 0 for w in x[1:]), n, sum(math.log10(p(w, ())) for w in x[1:]),
                  sum(math.log10(p(x[k], tuple(x[max(0, k - order + 1):k]))) for k in range(1, len(x))))
    return out


def check_lm(got, want):
    assert set(got) == set(want)
    for i, w in want.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == w[:3]
        assert abs(got[i].base_score - w[3]) < 1e-6 and abs(got[i].score - w[4]) < 1e-6


@pytest.mark.parametrize("bounds", [dict(order=3, words=40, grams=1500, table=10), dict(order=4, words=100, grams=3000, table=5), dict(order=1, words=60, grams=400, table=1000)])
def test_lm_scores(spark, bounds):
    from rankforge.llm.lm_scoring import lm_scores
    rnd = np.random.default_rng(1)
    voc = ["the", "of", "a", "b", "c", "D", "é", *(f"w{i}" for i in range(40))]
    weight = np.array([20, 15, 10, 8, 6, 5, 3, *[1] * 40]) / 107
    rows = [(i, " ".join(rnd.choice(voc, p=weight) for _ in range(rnd.integers(0, 200)))) for i in range(100)] + [(100, ""), (101, None), (102, "unseen words only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.id: r for r in lm_scores(docs, docs.where("doc_id % 10 <> 0 AND doc_id < 102"), **bounds).collect()}
    check_lm(got, brute_lm([t for i, t in rows if i % 10 and i < 102], rows, bounds["order"], bounds["words"], bounds["grams"]))


def test_op10_whole_table(spark):
    from rankforge.llm import lm_scoring as m
    from rankforge.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES["op10_lm_scoring"](spark, SF).collect()}
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    check_lm(got, brute_lm(train, rows, m.ORDER, m.WORDS, m.GRAMS))
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0) for i, r in got.items())


def test_lm_keeps_every_repeated_ngram(spark):
    """A rare pair of rare words in a corpus of many tokens is in the model: no share of the tokens is asked for."""
    from rankforge.llm.lm_scoring import lm_scores
    rows = [(0, "rare pair"), (1, "rare pair"), (2, "pair rare"), (3, "once")] + [(10 + i, "the " * 5000) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.id: r for r in lm_scores(docs, docs, table=2).collect()}
    check_lm(got, brute_lm([t for _, t in rows], rows, 3, math.inf, math.inf))
    assert got[0].score - got[0].base_score > 8             # both tokens and the end are followed n-grams, not plain words


def test_lm_tables_stay_small(spark, monkeypatch):
    """What is written at once stays near the text's size though most n-grams are states."""
    from pathlib import Path

    from rankforge.llm import lm_scoring as m
    from rankforge.session import checkpoint_dir
    rnd = np.random.default_rng(5)
    words = np.array([f"word{k:x}" for k in range(30_000)])
    rows = [(2 * i + j, t) for i in range(400) for t in [" ".join(words[rnd.integers(0, 30_000, 500)])] for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).localCheckpoint()
    size, held, top, write = sum(len(t) for _, t in rows), [], Path(checkpoint_dir(spark).removeprefix("file:")), m.stable
    before = set(top.glob("table-*"))

    def stable(df):
        out = write(df)
        held.append(sum(f.stat().st_size for d in set(top.glob("table-*")) - before for f in d.rglob("*.parquet")))
        return out
    monkeypatch.setattr(m, "stable", stable)
    got = {r.id: r for r in m.lm_scores(docs, docs, table=1000).collect()}
    assert len(got) == 800 and all(r.n_known == r.n_tokens == 501 and r.score > r.base_score for r in got.values())
    assert max(held) < 3 * size


def test_lm_packed_columns():
    from rankforge.llm import lm_scoring as m
    rnd = np.random.default_rng(6)
    prefix, suffix = (rnd.integers(0, 1 << 64, 1000, np.uint64) for _ in range(2))
    key = m.gram_key(prefix, suffix)
    assert (m.suffix_of(key, prefix) == suffix).all()
    columns = [key, suffix, np.arange(1000, dtype=np.int64), np.zeros(1000, np.uint64), key[:3], key[:0]]
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(m.unpack(m.pack(*columns)), columns, strict=True))
    for r, own in m.by_range(np.sort(key), 4):
        assert (m.entries_of(r, 4, m.entries(r, 4, np.sort(key)[own]), 1)[0] == np.sort(key)[own]).all()


def test_lm_keys_in_order(monkeypatch):
    """Keys are sorted with their places as one number: sorting places (``argsort``) was most of the CPU time of learning and scoring."""
    from rankforge.llm import lm_scoring as m
    rnd = np.random.default_rng(8)
    some = rnd.integers(0, 1 << 64, 30_000, np.uint64)
    x = np.concatenate([some, some[:10_000], rnd.permutation(some)])
    want, back = np.unique(x, return_inverse=True)
    count, sort, sorted_places = np.bincount(back), np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda x, *a, **k: sorted_places.append(len(x)) or sort(x, *a, **k))
    key, at, number = m.distinct(x)
    assert (key == want).all() and (x[at] == key).all() and (number == back).all()
    key, c, other = m.sums([(x[:100], np.ones(100, np.int64), ~x[:100]), (x[100:], np.ones(len(x) - 100, np.int64), ~x[100:])])
    assert (key == want).all() and (c == count).all() and (other == ~want).all()
    assert max(sorted_places, default=0) < 1000
    for x in (np.zeros(0, np.uint64), np.full(1, 7, np.uint64), np.full(9, 1 << 63, np.uint64),
              rnd.permutation(np.concatenate([np.arange(3000, dtype=np.uint64), np.arange(500, dtype=np.uint64) + np.uint64(1 << 63)]).repeat(3)),      # alike but for their last bits
              np.array([(1 << 64) - 1, 0, 5, 0, 4], np.uint64)):
        by, key = m.in_order(x)
        assert (key == np.sort(x)).all() and (x[by] == key).all() and sorted(by) == list(range(len(x)))


def test_lm_words_by_blocks(monkeypatch):
    """Words have one key wherever they stand, and texts are cut block by block: whole slices at once did not fit a core's cache."""
    from rankforge.llm import lm_scoring as m
    odd = ["a", "A", "a\0", "\0a", "\0", "é", "É", "[", "{", "abcdefgh", "abcdefghi", "ABCDEFGHIJ", "\x1f", "\x85", "\u3000x", "x\u2028y", *("w" * k for k in range(1, 200)),
           "v" + "w" * 199, "日本語" * 50, "x" * 100_000, "x" * 100_000 + "y"]
    rnd = np.random.default_rng(9)
    texts = [*([" ", "\n", "\t\r", "\x0b\x0c "][i % 4].join(odd[j] for j in rnd.integers(0, len(odd), rnd.integers(0, 12))) + " " * (i % 3) for i in range(150)),
             "", " ", "".join(odd), " ".join(odd)]
    words = [words_of(t) for t in texts]
    h, upto = m.word_keys(texts)
    assert np.diff(upto).tolist() == [len(w) for w in words]
    seen = {}
    assert all(seen.setdefault(w, k) == k for w, k in zip(itertools.chain(*words), h.tolist(), strict=True)) and len(set(seen.values())) == len(seen)
    whole, sizes, cut = m.stream(texts), [], m.word_keys
    monkeypatch.setattr(m, "word_keys", lambda own: sizes.append((len(own), sum(map(len, own)))) or cut(own))
    for limit in (1, 1000, 250_000):
        monkeypatch.setattr(m, "BLOCK", limit)
        assert all((x == y).all() and len(x) == len(y) for x, y in zip(m.stream(texts), whole, strict=True))
        assert all(n == 1 or chars <= limit for n, chars in sizes) and len(sizes) > 1
    keys, begin, first, past = whole
    assert (keys[first] == m.END).all() and (keys[past - 1] == m.END).all() and begin.sum() == len(texts) and past[-1] == len(keys)
    assert (np.concatenate([keys[a + 1:z - 1] for a, z in zip(first, past)]) == h).all()
    assert [len(x) for x in m.stream([])] == [0, 0, 0, 0]


def test_op10_odd_rows(spark, odd_docs):
    from rankforge.llm.lm_scoring import lm_scores
    got = lm_scores(odd_docs, odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r.n_known == r.n_tokens for r in got)
    none = lm_scores(odd_docs, odd_docs.limit(0)).collect()
    assert {(r.n_known, r.train_tokens) for r in none} == {(0, 0)} and all(abs(r.score) < 1e-9 for r in none)
    assert lm_scores(odd_docs.limit(0), odd_docs).count() == 0


# ---- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from rankforge.llm.common import stable
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, stage in p.STAGES:
        tables.append(stable(stage(spark, tables[-1], SF)))
    assert all(t.columns == docs.columns and t.dtypes == docs.dtypes for t in tables[:-1])
    rows = [[(r.doc_id, r.text) for r in t.select("doc_id", "text").collect()] for t in tables[:-1]]
    assert {i for i, _, _ in brute_components(rows[2], 5, 80)} == {i for i, _ in rows[2]}
    assert sorted(i for i, _ in rows[2]) == sorted({k for _, k, _, _ in brute_dedup(rows[1])})
    assert sorted(i for i, _ in rows[3]) == sorted({c for _, _, c in brute_components(rows[2], 5, 80)})
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {i for i, _ in rows[3]} - {i for i, _ in rows[4]}
    assert gone == {i for i, t in rows[3] if any(" ".join(u.split()) in " ".join(t.split()) for _, u in bench)}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rejected = {i for i, _ in rows[0]} - {i for i, _ in rows[1]}
    assert rejected and sum(labels.get(i, 1) == 0 for i in rejected) <= 0.01 * len(rows[0])
    assert sorted(r.doc_id for r in tables[-1].collect()) == sorted(i for i, _ in rows[4])
    assert sorted(map(str, p.run(spark, SF).collect())) == sorted(map(str, tables[-1].collect()))


def test_pipeline_odd_rows(spark, odd_docs):
    import corpus_pipeline as p
    for docs in (odd_docs, odd_docs.limit(0)):
        out = docs
        for name, stage in p.STAGES[:-1]:
            out = stage(spark, out, SF)
            assert out.columns == docs.columns
        assert p.STAGES[-1][1](spark, out, SF).count() <= docs.count()
