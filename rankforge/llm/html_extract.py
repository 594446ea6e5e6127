"""Main text of web pages by consensus paths of a host.

1. Every page scores its containers: the unlinked text of a block counts for the
   container that holds it and, with a loss per level, for those around it.
   The scores, as shares of the page, belong to generalised paths: tags and
   classes from the body down, digits removed.  A page votes with its share for
   its own best container, of equal ones the outermost.
2. Spark sums the votes per (host, path) and keeps the ``PATHS`` best of a host.
3. Pages are read again: the text of the elements on that one of the host's paths
   which has the largest share of the page.  The root counts only where it is the
   page's own best.  A page without any of them uses its own best container, a
   page of nothing but links and headers the host's first path that it has, else
   all of its blocks.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out by tag, role and class name.  A name counts when a
class or id is that name, or a compound that holds it; names of
layouts (``has-sidebar``, ``no-sidebar``, ``with-related``) and of parts of an
article (``entry-header``) do not.  An element left out only for a compound name
stays when it holds more than half of the page's unlinked text.  References are
decoded, white space inside a block becomes one blank, blocks are joined by a
line feed.  Line breaks are white space, not blocks.

The winners are joined by host; they are broadcast while there are at most
``MAX_HOSTS`` hosts (``PATHS`` short strings each) and shuffled beyond, where
Spark splits the rows of a large host (adaptive skew join).

Defined results: a null or empty page, or one without text, gives the empty
text; a null or odd url belongs to the host ''; rows are independent, so
repeated pages give repeated rows; equal votes go to the first path by name.
"""

from __future__ import annotations

import html as references
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import slices, stable

PATHS = 5
MAX_HOSTS = 100_000
LOSS = 0.8

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
            "ul caption option".split())
CONTAINER = set("body main article section div td center blockquote figure ul ol dl table details".split())
DROP_TAG = set("nav footer aside form button select dialog menu svg math head object audio video canvas map".split())
DROP_ROLE = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
# fixed values: names of elements that are no main text
DROP_NAMES = set("""ad ads advert adverts advertisement adsense banner promo promos promotion promotions sponsor sponsors sponsored
comment comments commentlist disqus respond reply replies sidebar side-bar aside cookie cookies consent gdpr notice notices
notification alert newsletter subscribe subscription signup sign-up login share sharing social related recommended breadcrumb
breadcrumbs menu nav navbar navigation footer foot header masthead topbar popup pop-up modal overlay widget widgets pagination
pager toolbar search skip-link""".split())
# fixed values: first words of compounds that describe a layout or a part of an article
LAYOUT = set("has no with without is not layout hide show hidden col cols column columns".split())
PART = set("entry post article content page section".split())
NAME_PARTS = re.compile(r"[-_]+")
# an open element is closed by the start of these (the common omitted end tags)
CLOSES = {"p": BLOCK - {"option", "body", "html", "caption"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
          "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
          "option": {"option"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"select"}, "thead": {"table"}, "tbody": {"table"}}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTR = re.compile(r"class|id|role|hidden|style", re.I)
DIGITS = re.compile(r"\d+")


def _attributes(source: str) -> dict[str, str]:
    out = {}
    for m in re.finditer(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", source):
        out.setdefault(m[1].lower(), next((g for g in m.groups()[1:] if g is not None), ""))
    return out


class _Element:
    __slots__ = ("tag", "path", "dropped", "header", "doubts")

    def __init__(self, tag, path, dropped, header, doubts):
        self.tag, self.path, self.dropped, self.header, self.doubts = tag, path, dropped, header, doubts


def blocks(page: str):
    """The text blocks of a page in order: (paths of the containers around it, outermost first, text, linked share, in a header).

    Blocks inside an element of a doubtful name are left out unless the element holds most of the page.
    """
    found = all_blocks(page)
    if not any(doubts for *_, doubts in found):
        return [b[:4] for b in found]
    worth: dict[int, float] = {}
    total = 0.0
    for _, text, linked, header, doubts in found:
        own = 0.0 if header else len(text) * (1 - linked)
        total += own
        for d in doubts:
            worth[d] = worth.get(d, 0.0) + own
    out = {d for d, w in worth.items() if w <= total / 2}
    return [b[:4] for b in found if out.isdisjoint(b[4])]


def all_blocks(page: str):
    """Blocks with the elements of a doubtful name around them."""
    stack: list[_Element] = [_Element("", (), False, False, ())]
    doubtful = 0
    text: list[str] = []
    linked = 0
    total = 0
    links = 0
    out = []

    def flush():
        nonlocal linked, total
        if text:
            whole = " ".join(references.unescape("".join(text)).split())
            if whole:
                top = stack[-1]
                out.append((top.path, whole, min(1.0, linked / max(1, total)), top.header, top.doubts))
            text.clear()
        linked = total = 0

    def add(s):
        nonlocal linked, total
        if s and not stack[-1].dropped:
            text.append(s)
            n = len(s.strip())
            total += n
            if links:
                linked += n

    at = 0
    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:                                   # comment or declaration
            continue
        tag = tag.lower()
        if m[1]:                                          # end tag
            if tag in BLOCK:
                flush()
            if tag == "br":
                text.append(" ")
            if tag == "a" and links:
                links -= 1
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("table", "body") and tag not in ("html", "body", "table"):
                    break
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else size
            continue
        if tag == "br" or tag in VOID:
            if tag in BLOCK:
                flush()
            else:
                text.append(" " if tag == "br" else "")
            continue
        if tag not in BLOCK and tag not in DROP_TAG:
            if tag == "a" and not m[3].rstrip().endswith("/"):
                links += 1
            if stack[-1].dropped and stack[-1].tag == tag:
                stack.append(stack[-1])                   # so that its end tag does not end the dropped element
                continue
            if not m[3] or not ATTR.search(m[3]):
                continue                                  # inline without a class: nothing to keep
        if tag in BLOCK:
            flush()
            links = 0
            for i in range(len(stack) - 1, 0, -1):
                own = stack[i].tag
                if own in CLOSES and tag in CLOSES[own]:
                    del stack[i:]
                    if own != "td" and own != "th":
                        break
                elif own in CONTAINER or tag in LIMITS and own in LIMITS[tag]:
                    break
        attr = _attributes(m[3]) if m[3] else {}
        if tag not in BLOCK and tag not in DROP_TAG:
            # inline elements matter only where they hide what they hold
            if not _hidden(tag, attr) and not _named(tag, attr):
                continue
        above = stack[-1]
        named = _named(tag, attr)
        dropped = above.dropped or _hidden(tag, attr) or named == "out" or named == "doubt" and tag not in BLOCK
        header = above.header or tag == "header"
        doubts = above.doubts
        if named == "doubt" and not dropped:
            doubtful += 1
            doubts = (*doubts, doubtful)
        path = above.path
        if tag in CONTAINER and tag != "body" and not dropped:
            names = sorted({DIGITS.sub("", c) for c in attr.get("class", "").lower().split()} - {""})
            path = (*path, ".".join([tag, *names]))
        if not m[3].rstrip().endswith("/") or tag in BLOCK:
            stack.append(_Element(tag, path, dropped, header, doubts))
    flush()
    return out


def _hidden(tag: str, attr: dict[str, str]) -> bool:
    if tag in DROP_TAG or attr.get("role", "").lower() in DROP_ROLE or "hidden" in attr or attr.get("aria-hidden") == "true":
        return True
    if tag in ("body", "html", "main", "article"):
        return False
    return "style" in attr and bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attr["style"], re.I))


def _named(tag: str, attr: dict[str, str]) -> str:
    """Whether the names of an element say that it is no main text: 'out', 'doubt' (a compound) or ''."""
    if tag in ("body", "html", "main", "article", "header"):
        return ""
    said = ""
    for name in (attr.get("class", "") + " " + attr.get("id", "")).lower().split():
        if name in DROP_NAMES:
            return "out"
        parts = [p for p in NAME_PARTS.split(name) if p]
        if len(parts) < 2 or parts[0] in LAYOUT:
            continue
        held = set(parts) | {"-".join(pair) for pair in zip(parts, parts[1:])}
        if parts[0] in PART:
            held -= {"header", "head"}
        if held & DROP_NAMES:
            said = "doubt"
    return said


def container_shares(found) -> dict[str, float]:
    """Score of each generalised path, as a share of the page."""
    score: dict[str, float] = {}
    total = 0.0
    for path, text, linked, header in found:
        worth = len(text) * (1 - linked)
        if header or worth <= 0:
            continue
        total += worth
        for up in range(len(path) + 1):
            own = "/".join(path[:len(path) - up])
            score[own] = score.get(own, 0.0) + worth * LOSS ** up
    return {p: s / total for p, s in score.items()} if total else {}


def own_best(shares: dict[str, float]) -> str:
    return min(shares, key=lambda p: (-shares[p], p))


def text_on(found, paths) -> str:
    """The text on the one of ``paths`` with the largest share of the page, else of its own best container."""
    def inside(path):
        cut = tuple(path.split("/")) if path else ()
        # a header belongs to the article only when it stands inside its container
        return [t for p, t, _, header in found if p[:len(cut)] == cut and (cut or not header)]
    shares = container_shares(found)
    if shares:
        best = own_best(shares)
        had = [p for p in paths if p in shares and (p or not best)]
        return "\n".join(inside(min(had, key=lambda p: -shares[p]) if had else best))
    return "\n".join(next(filter(None, map(inside, [*paths, ""])), []))


def _host(url_col: str):
    host = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(host)


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: int = PATHS) -> DataFrame:
    """(host, paths): the best generalised paths of each host, best first."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                votes: dict[tuple[str, str], float] = {}
                for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                    shares = container_shares(blocks(page or ""))
                    if shares:
                        path = own_best(shares)
                        votes[host, path] = votes.get((host, path), 0.0) + shares[path]
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()),
                                                  pa.array(list(votes.values()), pa.float64())], ["host", "path", "votes"])

    voted = pages.select(_host(url_col).alias("host"), F.col(html_col).alias("html")) \
        .mapInArrow(run, "host string, path string, votes double").groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    return (voted.withColumn("r", F.row_number().over(order)).where(F.col("r") <= keep).groupBy("host")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "path"))), lambda x: x["path"]).alias("paths")))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      max_hosts: int = MAX_HOSTS) -> DataFrame:
    """Per row: id, url, text, n_chars."""
    winners = stable(host_paths(pages, url_col, html_col))
    few = winners.count() <= max_hosts
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _host(url_col).alias("host"))
    joined = own.join(F.broadcast(winners) if few else winners, "host", "left").select("id", "url", "html", "paths")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                text = [text_on(blocks(page), paths or []) if page else ""
                        for page, paths in zip(part.column("html").to_pylist(), part.column("paths").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(text, pa.string()),
                                                  pa.array([len(t) for t in text], pa.int64())], ["id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, url string, text string, n_chars long")
