import time

import pytest

from panelforge.llm.html_extract import (LABELLED, blocks, decide, extract_main_text, features, main_text,
                                         trained_tree)

TREE = trained_tree()
LONG = ("This is a paragraph of the article which has enough words to be told from the short pieces around it, "
        "whatever they may be")


def text(html):
    return main_text(html, TREE)[0]


def test_tree_fits_its_table():
    rows = [[float(x) for x in line.split()] for line in LABELLED.strip().splitlines()]
    assert len(rows) < 200
    assert sum(decide(TREE, r[:-1]) == r[-1] for r in rows) >= 0.97 * len(rows)


@pytest.mark.parametrize("html,want", [
    ("", ""), ("   ", ""), ("<p></p>", ""), ("<html><body></body></html>", ""),
    (f"<article><p>{LONG}</p></article>", LONG),
    (f"<article><h1>A  title</h1><p>{LONG}</p><p>Short.</p></article>", f"A title\n\n{LONG}\n\nShort."),
    (f"<nav><a href=/>Home</a></nav><article><p>{LONG}</p></article><footer>&copy; {LONG}</footer>", LONG),
    (f"<article><p>{LONG}</p><div class='ad'>{LONG}</div><aside>{LONG}</aside></article>", LONG),
    (f"<article><p>{LONG}</p></article><section id=comments><p>{LONG}</p></section>", LONG),
    (f"<header><h1>Site</h1></header><main><p>{LONG}</p></main><div class='cookie-notice'>{LONG}</div>", LONG),
    (f"<article><p>{LONG}<script>var a='</p>x';</script><style>p{{}}</style></p></article>", LONG),
    (f"<article><form><label>Mail</label> {LONG}</form><p>{LONG}</p></article>", LONG),
    ("<article><p>a &lt;b&gt; &amp; &eacute;&#8212;&#x41; &nbsp; c</p></article>", "a <b> & é—A c"),
    (f"<article><p>{LONG}<p><b>Unclosed<br>line", f"{LONG}\n\nUnclosed line"),
    (f"<article><p title='a>b'>{LONG}</p><!-- <p>no</p> --></article>", LONG),
    (f"<div><h2>Title</h2><p>{LONG}</p><p>{LONG} indeed</p></div><div class=sidebar>{LONG}</div>",
     f"Title\n\n{LONG}\n\n{LONG} indeed"),
])
def test_pages(html, want):
    assert text(html) == want


def test_broken_markup_ends():
    for html in ("<" * 50_000, "<a" * 50_000, "<p a=\"" + "x" * 100_000, "</" * 9999, "<!--" * 9999, "<script>" + "<p>" * 9999):
        blocks(html)


def test_rows(spark):
    page = f"<nav><a>x</a></nav><article><p>{LONG}</p></article>"
    long = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", long)]
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows],
                               "page_id long, url string, html string, text string, n_chars int")
    got = extract_main_text(df).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in got) == sorted(
        [(1, "u", len(LONG))] * 2 + [(2, "", 0), (0, "v", 0), (3, "w", 5000 * len(LONG) + 2 * 4999)])
    assert all(r.text is not None and len(r.text) == r.n_chars for r in got)
    assert extract_main_text(df.limit(0)).count() == 0


def test_a_head_without_end():
    from panelforge.llm.html_extract import blocks
    for page in ("<head><meta charset=utf-8><p>The text", "<html><head><title>No</title><script>no</script><div>The text",
                 "<head><link rel=a>\n<title>No</title>\n The text", "<head><noscript><p>no</p></noscript></head><p>The text",
                 "<head><title>No</title><img src=a>The text", "<title>No</title><p>The text"):
        assert [b[0] for b in blocks(page)] == ["The text"], page


@pytest.mark.parametrize("opened", [
    '<div class="has-sidebar"><article>', '<div class="content no-comments"><main>', '<div class="page alert-none"><article>',
    '<div class="article-search-results"><article>', '<form id=all><div class=search><div class=post>',
    '<div class="content no-comments">', '<div class="page alert-none">'])
def test_a_wrapper_does_not_hide_its_article(opened):
    assert text(f"{opened}<h2>Title</h2><p>{LONG}</p></div>") == f"Title\n\n{LONG}"


def test_only_the_largest_article_loses_its_wrapper():
    page = (f"<div class=layout-sidebar><article><p>{LONG}</p><p>{LONG} too</p></article>"
            f"<div class=related><article><p>{LONG}</p></article></div></div><nav><article>{LONG * 9}</article></nav>")
    assert text(page) == f"{LONG}\n\n{LONG} too"
    story = f"<div><h2>Title</h2><p>{LONG}</p></div><div class=comments><article><p>{LONG * 9}</p></article></div>"
    assert text(story) == f"Title\n\n{LONG}"


@pytest.mark.parametrize("opened", ["<button>Menu", "<select><option>a<option>b", "<button>Menu <button>More", "<video src=a>"])
def test_silence_without_end(opened):
    assert text(f"{opened}<article><p>{LONG}</p><p>{LONG}</p></article>") == f"{LONG}\n\n{LONG}"
    assert text(f"<article><p>{LONG}</p>{opened}<p>{LONG}</p></article>") == f"{LONG}\n\n{LONG}"


def test_silence_with_end():
    assert text(f"<article><p>{LONG}</p><button><div>{LONG}</div></button><select><option>a</select></article>") == LONG


def test_time_is_linear():
    began = time.time()
    for page in ("<b>" * 60_000 + "</i>" * 60_000, "<b>" * 60_000 + "<hr>" * 60_000, "<button>" * 60_000,
                 "<div class=ad>" * 30_000 + "<p>x" * 30_000, "<select>" * 30_000 + "<hr>" * 30_000, "<b><p>" * 30_000):
        blocks(page)
    assert time.time() - began < 30


def test_features_by_hand():
    page = "<nav><a>one two</a></nav><article><p>a b <a>c d</a></p><div class=ad>e</div></article>"
    assert features(blocks(page)) == [(2, 100.0, 0, 0.0, 4, 50.0, 1, 0, 1), (4, 50.0, 2, 100.0, 1, 0.0, 0, 1, 1),
                                      (1, 0.0, 4, 50.0, 0, 0.0, 1, 1, 1)]
