"""Main text of web pages: flat blocks classified by a decision tree.

A page is cut into a flat list of text blocks at block-level tags.  Each block
has its word count and link density, those of the blocks before and after it,
and three marks of where it stands: how many open elements announce page
furniture (``nav``, ``class="sidebar"``...), how many announce the article,
and whether the page announces an article at all.  A small decision tree,
grown from the labelled table below, says which blocks are main text.  So a
page without any helpful markup is judged by words and links of neighbouring
blocks alone.  A class name is a weak mark: one that only states something of
the page (``has-sidebar``, ``no-comments``) counts for nothing, and where no
block is left, the marks around the largest article are taken back.

Pages are independent of each other: one pass, no shuffle.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after",
            "furniture", "article", "page_has_article"]

#: Labelled blocks: the nine features (link density in percent) and 1 for main text.
LABELLED = """
180  0  90  0 120  0  0 1 1  1
 60  5  80  0  70  0  0 1 1  1
 25  0   8  0  90  0  0 2 1  1
  8  0   0  0  60  0  0 1 1  1
  6  0   4 90  75  0  0 1 1  1
  3  0  40  0  55  0  0 1 1  1
  1  0  30  0  20  0  0 2 1  1
  2  0   1  0   3  0  0 1 1  1
 12 40  60  0  45  0  0 1 1  1
  7 90  50  0  60  0  0 1 1  1
 15 30  20 10   9  0  0 1 1  1
 45 20   5  0   4 80  0 1 1  1
 90  0 120  0   0  0  0 1 1  1
  5  0  80  0   7 20  0 1 1  1
350  2  60  0  40  0  0 1 1  1
  4 100  90  0 100  0  0 1 1  1
  8  0  60  0   4 100  0 1 1  1
 12  0  40  0   2 100  0 1 1  1
  5  0   5 100  3 100  0 1 1  1
  3  0   0  0   1 100  0 2 1  1
 20  0  30  0   6 90  0 1 1  1
  2  0  70  0   2 100  0 1 1  1
  9  5   2 100 12 80  0 2 1  1
 16  0   4 60   5 70  0 1 1  1
  4 100  20  0  15  0  0 1 1  1
  6 100   9  0   8  0  0 1 1  1
  7 90   10  0  12  0  0 1 1  1
 11 70    3  0   6  0  0 1 1  1
  3 100   3 100   3 100  0 1 1  0
  2 100   4 100   2 100  0 1 1  0
  4 100   5  95   3 100  0 2 1  0
  1 100   1 100   2 100  0 1 1  0
 30  0  90  0  80  0  1 1 1  0
  9  0  60  0  70  0  1 1 1  0
120  0 100  0  50  0  2 1 1  0
 14  0  30  0  12  0  1 2 1  0
  6 50  70  0   6 60  1 1 1  0
 40  0  35  0  45  0  2 1 1  0
 70  0  60  0  10  0  1 1 1  0
  2  0  50  0   9  0  1 1 1  0
220  0  90  0  40  0  1 1 1  0
  8  0   1 100   6  0  1 0 1  0
 11 10  80  0   0  0  1 0 1  0
  1 100   1 100   1 100  1 0 1  0
 60  0  40  0  50  0  1 0 1  0
 20  0   6  0  10  0  0 0 1  0
  7  0   5  0  70  0  0 0 1  0
 90  0  80  0  20 10  0 0 1  0
 12 70   9 80   8 90  0 0 1  0
  4  0   0  0   9  0  0 0 1  0
160  0  20  0  30  0  0 0 1  0
  9  0 120  0   4  0  0 0 1  0
 80  0  60  0  70  0  0 0 0  1
150  3  90  0 100  0  0 0 0  1
 40  5  60  0  30  0  0 0 0  1
 22  0  50  0  45  0  0 0 0  1
 18  0  70  0  60  0  0 0 0  1
 30 10   8  0  90  0  0 0 0  1
  8  0  10 60  85  0  0 0 0  1
  6  0  60  0  75  0  0 0 0  1
 12  0  90  0  40  0  0 0 0  1
  5  0  40  0  50  0  0 0 0  1
  9 10  45  0  35  5  0 0 0  1
 55 15  30  0   6  0  0 0 0  1
 28  0   0  0   0  0  0 0 0  1
 35  0   4 100  5  90  0 0 0  1
  7  0  30  0  20  0  0 0 0  1
  24  5   6  0   2  0  0 0 0  1
 45  0  60  0   3  0  0 0 0  1
 90  0  70  0   0  0  0 0 0  1
 60  0  40  0   4 100  0 0 0  1
 33  0  50  0   5 90  0 0 0  1
 29  0  12  0   2 100  0 0 0  1
 38  8   3 90   4  0  0 0 0  1
  2  0  24  5  26  0  0 0 0  1
  4  0  31  0  27  0  0 0 0  1
  2 100   2 100   3 100  0 0 0  0
  5  90   4 100   6  80  0 0 0  0
  1 100   0   0   2 100  0 0 0  0
 14  80   9  70  12  90  0 0 0  0
 40  75  10  80  20  70  0 0 0  0
  6   0   3 100   4 100  0 0 0  0
  9   0  12   0   0   0  0 0 0  0
  4   0   6   0   5   0  0 0 0  0
  8  20   7  30   3  60  0 0 0  0
  3   0   0   0   5  90  0 0 0  0
 10   0   8   0   9  40  0 0 0  0
  6  70  60   0   5  90  0 0 0  0
 12  60  80   0  90   0  0 0 0  0
 70   0  60   0  80   0  1 0 0  0
 15   0  90   0   8   0  1 0 0  0
  9   0   5   0  70   0  1 0 0  0
130   0  20   0  10   0  2 0 0  0
  5 100   5 100   5 100  1 0 0  0
 30   0  80   0  90   0  1 0 0  0
"""


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2):
    """A decision tree by Gini impurity: a leaf is a label, an inner node
    (feature, threshold, left for <=, right).  Ties go to the first feature and
    the lowest threshold, so the tree is the same on every machine."""
    majority = int(2 * y.sum() > len(y))
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return majority
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= cut
            nl = int(left.sum())
            if min(nl, len(y) - nl) < least:
                continue
            pl, pr = y[left].mean(), y[~left].mean()
            impurity = (nl * pl * (1 - pl) + (len(y) - nl) * pr * (1 - pr)) / len(y)
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, float(cut)
    if best is None:
        return majority
    _, f, cut = best
    left = x[:, f] <= cut
    return f, cut, grow(x[left], y[left], depth - 1, least), grow(x[~left], y[~left], depth - 1, least)


def decide(tree, row) -> int:
    while isinstance(tree, tuple):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def trained_tree(labelled: str = LABELLED):
    t = np.array([line.split() for line in labelled.strip().splitlines()], float)
    return grow(t[:, :-1], t[:, -1])


BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog
dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup
hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody
td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
SILENT = frozenset("""script style noscript template svg math iframe object select textarea button
canvas audio video title head datalist""".split())
#: What may stand in a head; anything else ends it.
HEAD = frozenset("title meta link base style script noscript template head html".split())
#: Raw text: nothing inside is markup but the end tag.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset search".split())
#: Words of class, id and role that announce page furniture, and the article.
FURNITURE = frozenset("""ad ads adv advert adverts advertisement advertising alert aside banner
breadcrumb breadcrumbs callout comment comments commentlist complementary consent contentinfo cookie
cookies copyright dialog discussion disqus feedback footer form gdpr header legal login masthead menu
menubar modal nav navbar navigation newsletter notice notification overlay pager pagination
paywall popup promo promoted promotion recommended recommendations related replies reply respond
responses search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe
subscription toolbar topbar trending widget widgets""".split())
ARTICLE = frozenset("article articlebody entry post story main".split())
#: A name with one of these tells what a page has or lacks, not what an element is.
STATES = frozenset("has have no non none not with without".split())
#: Silent elements that never hold their like: one without an end tag ends at the next block.
UNNESTED = frozenset("button select datalist canvas audio video".split())
CHOICES = frozenset("option optgroup hr".split())
#: What an open element ends besides p, where it is the innermost open block.
ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
HINTS = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _marks(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element is furniture by its kind, whether it only announces
    furniture (a name, or a form, which may hold a whole page), and whether it
    announces the article."""
    if tag in ("html", "body"):
        return False, False, False
    words = set()
    for m in HINTS.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = set(re.split(r"[^a-z]+", CAMEL.sub(" ", name).lower()))
            if not parts & STATES:
                words |= parts
    article = tag in ("article", "main") or bool(words & ARTICLE)
    if tag == "main":
        return False, False, True
    bad = words & FURNITURE
    if article and bad == {"header"}:  # the article's own heading
        bad = set()
    hard = (tag in FURNITURE_TAGS and tag != "form" or tag == "header" and not in_article
            or bool(HIDDEN.search(attributes)))
    soft = not hard and (bool(bad) or tag == "form")
    return hard, soft, article and not hard and not soft


def parse(html: str) -> tuple[list[tuple], list[int]]:
    """The blocks with a word, and the announcements of furniture.

    A block: (text, words, words inside links, elements around it that are
    furniture by kind, its innermost announcement, articles around it,
    innermost announcement around the innermost article).  Announcements are
    numbered from 1 in page order; the list gives the one around each.  Takes
    time in proportion to the page."""
    out, texts, stack = [], [], []
    open_blocks, open_tags = [], {}  # places in the stack; open elements of each tag
    above, softs, articles = [0], [0], []
    hard = silent = links = 0
    words_linked = 0

    def flush():
        nonlocal texts, words_linked
        text = " ".join("".join(texts).split())
        if text:
            out.append((text, text.count(" ") + 1, words_linked, hard, softs[-1], len(articles),
                        articles[-1] if articles else -1))
        texts, words_linked = [], 0

    def close(k: int):
        nonlocal hard, silent, links
        while len(stack) > k:
            tag, h, s, a, quiet = stack.pop()
            open_tags[tag] -= 1
            hard -= h
            silent -= quiet
            links -= tag == "a"
            if s:
                softs.pop()
            if a:
                articles.pop()
        while open_blocks and open_blocks[-1] >= k:
            open_blocks.pop()

    def text(part: str):
        nonlocal words_linked
        if stack and stack[-1][0] == "head" and part.strip():
            close(len(stack) - 1)
        if part and not silent:
            part = unescape(part)
            texts.append(part)
            if links:
                words_linked += len(part.split())

    at, n = 0, len(html)
    unended = []  # places of silent elements without an end tag
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        text(html[at:lt])
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        m = TAG.match(html, lt)
        if not m:
            if not re.match(r"</?[A-Za-z!?]", html[lt:lt + 3]):
                text("<")  # a lone sign
                at = lt + 1
            else:
                end = html.find(">", lt)  # broken or no element: skip it
                at = n if end < 0 else end + 1
            continue
        at = m.end()
        tag, attributes = m[2].lower(), m[3]
        if tag in BLOCK:
            flush()
        elif tag == "br":
            texts.append(" ")
        if m[1]:
            if open_tags.get(tag):  # all that the search passes is closed
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                close(k)
            continue
        if stack and stack[-1][0] == "head" and tag not in HEAD:
            close(len(stack) - 1)
        if tag in BLOCK:  # an open p ends at the next block, li at the next li, and so on
            while unended and tag not in CHOICES:
                k = unended.pop()
                if k < len(stack) and stack[k][0] in UNNESTED:
                    close(k)
            if open_blocks and (stack[open_blocks[-1]][0] == "p"
                                or stack[open_blocks[-1]][0] in ENDS.get(tag, ())):
                close(open_blocks[-1])
        if tag == "body":
            close(0)
        if tag in VOID:
            continue
        if tag in RAW:  # jump to the end tag
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            at = n if end is None else end.start()
            if end is None:
                break
        if tag in UNNESTED:
            other = re.compile(rf"<(/?){tag}(?=[\s/>])", re.I).search(html, at)
            if other is None or not other[1]:
                unended.append(len(stack))
        h, s, a = _marks(tag, attributes, bool(articles))
        if tag in BLOCK:
            open_blocks.append(len(stack))
        stack.append((tag, h, s, a, tag in SILENT))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        if s:
            above.append(softs[-1])
            softs.append(len(above) - 1)
        if a:
            articles.append(softs[-1])
        hard += h
        silent += tag in SILENT
        links += tag == "a"
    flush()
    return out, above


def wrappers(parsed: list[tuple], above: list[int]) -> set[int]:
    """The announcements around the articles with most words among those that
    only announcements make furniture; ties go to the first."""
    words = {}
    for b in parsed:
        if not b[3] and b[4] and b[4] == b[6]:
            words[b[4]] = words.get(b[4], 0) + b[1]
    out, at = set(), max(words, key=lambda s: (words[s], -s), default=0)
    while at:
        out.add(at)
        at = above[at]
    return out


def marked(parsed: list[tuple], above: list[int], void=frozenset()) -> list[tuple]:
    """(text, words, words inside links, furniture, article) of each block;
    announcements in ``void`` do not count."""
    depth = [0]
    for s in range(1, len(above)):
        depth.append(depth[above[s]] + (s not in void))
    return [(*b[:3], b[3] + depth[b[4]], b[5]) for b in parsed]


def blocks(html: str) -> list[tuple]:
    """(text, words, words inside links, furniture, article) of each block with a word."""
    return marked(*parse(html))


def features(found: list[tuple]) -> list[tuple]:
    """``FEATURES`` of each block."""
    has_article = int(any(b[4] and not b[3] for b in found))
    size = [(0, 0.0), *((b[1], 100.0 * b[2] / b[1]) for b in found), (0, 0.0)]
    return [(*size[i + 1], *size[i], *size[i + 2], b[3], b[4], has_article)
            for i, b in enumerate(found)]


def main_text(html: str, tree) -> tuple[str, int, int]:
    """The main text, the number of blocks and of those kept."""
    parsed, above = parse(html)
    kept = []
    for void in (lambda: set(), lambda: wrappers(parsed, above)):
        found = marked(parsed, above, void())
        kept = [b[0] for b, row in zip(found, features(found)) if decide(tree, row)]
        if kept:
            break
    return "\n\n".join(kept), len(parsed), len(kept)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row per page: id, url, main text, its code points and block counts.

    A NULL or empty page, or one without main text, gives an empty text.  Pages
    are read whole.  White space inside a block becomes one space; blocks are
    joined by two newlines.  Repeated rows give repeated results; NULL ids and
    urls stay NULL; other columns are ignored; an empty table gives no rows."""
    tree = trained_tree()
    kind = dict(pages.dtypes)[id_col]

    def run(batches):
        for ids, urls, htmls in slices(batches, "_id", "_url", "_html"):
            got = [main_text(h, tree) for h in htmls]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(urls, pa.string()),
                 pa.array([g[0] for g in got], pa.string()),
                 *(pa.array([g[k] for g in got], pa.int64()) for k in (1, 2))],
                names=["_id", "_url", "text", "n_blocks", "n_kept"])

    rows = pages.select(F.col(id_col).cast("string").alias("_id"),
                        F.col(url_col).cast("string").alias("_url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_html"))
    found = rows.mapInArrow(
        run, "_id string, _url string, text string, n_blocks long, n_kept long")
    return found.select(F.col("_id").cast(kind).alias("page_id"), F.col("_url").alias("url"), "text",
                        F.char_length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")
