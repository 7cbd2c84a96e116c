"""Extraction: hand-made pages, template removal per host, the given pages."""

import html
import re
import time

from conftest import SF_SMALL
from netscope.llm import site_templates as S


def text(source):
    return S.Page(source).text(set())


def test_article_page():
    page = """<html><head><title>T &amp; x</title></head><body><header>Site</header><nav><ul><li><a href=x>m</a></ul></nav>
    <div class="cookie-notice">We use</div><main><article><h1>Head &lt;1&gt;</h1><p>One <b>two</b>\n three<p>four&nbsp;five
    <div class="ad">buy</div><p>six <a href="y">link</a> <span class='ad'>x</span>end</p><form><p>mail</p></form><ul><li>x<li>y</ul>
    <aside>side</aside><section id="comments"><p>troll</p></section><table><tr><td>c1<td>c2</table>tail text<br>more</article></main>
    <footer>foot</footer><script>var a="</div>"</script></body></html>"""
    assert text(page).split("\n") == ["Head <1>", "One two three", "four five", "six link end", "x", "y", "c1", "c2", "tail text more"]


def test_broken_pages():
    assert text(None) == text("") == text(" \n ") == text("<html><head><title>x") == ""
    assert text("plain &amp; simple < 3") == "plain & simple < 3"
    assert text("<p>a<p>b</div></p>c") == "a\nb\nc"
    assert text("<article><p>cut of") == "cut of"
    assert text("<div hidden>h</div><!-- <p>no</p> --><p>yes") == "yes"
    assert len(text("<p>" + "word " * 50_000)) == 50_000 * 5 - 1


def test_reader_comments_go():
    """Comments after or in a main element go whole; a page that only has such a wrapper keeps its article."""
    for tail in ('<section id="comments"><article><p>I liked it</p></article></section>',
                 '<div class="comment-replies"><main><p>I liked it</main></div>', '<article class="comment"><p>I liked it</article>'):
        assert text(f"<article><p>One</p>{tail}<p>Two</p></article>") == "One\nTwo", tail
        assert text(f"<article><p>One</p><p>Two</article>{tail}") == "One\nTwo", tail
    assert text('<div class="comments"><article><p>One</p></article></div>') == "One"
    assert text('<article class="comment"><p>One</p></article>') == "One"


def test_hostile_pages_take_linear_time():
    """A page four times as long takes some four times as long, not sixteen."""
    def seconds(page):
        begin = time.process_time()
        text(page)
        return time.process_time() - begin

    for piece in ("<script ", "<a ", "<div>", "<main>", "<!", "</", "</x ", '<a "', "<p><div><a>", '<div class="related-posts"><a>x',
                  '<div class="ad">', "<ul>", "<p>x", "<li>", "</div>", "<![CDATA[", "&lt", '<a "<a" '):
        short, long = (seconds(piece * n) for n in (8_000, 32_000))
        assert long < 8 * short + 0.3, (piece, short, long)
    assert seconds("<script " * 130_000) < 5


def test_templates_recur_per_host(spark):
    """Without an article element the recurring blocks of a host go, the same block elsewhere stays."""
    rows = []
    for i in range(12):
        rows.append((i, f"http://one.org/{i}", f"<div><p>All rights kept by One</p></div><div><p>story {i} of one</p></div>"))
    rows += [(20, "http://two.org/a", "<div><p>All rights kept by One</p></div><p>two</p>"), (21, None, "<p>no url</p>"),
             (22, "http://two.org/b", None), (None, "x", "<p>null id</p>"), (20, "http://two.org/a", "<p>two</p>")]
    docs = spark.createDataFrame([(*r, "x", [1]) for r in rows], "page_id long, url string, html string, text string, trees array<int>")
    got = S.extract(docs).collect()
    assert len(got) == len(rows)
    by = {(r["page_id"], r["text"]) for r in got}
    assert {(i, f"story {i} of one") for i in range(12)} <= by
    assert (20, "All rights kept by One\ntwo") in by and (21, "no url") in by and (22, "") in by and (None, "null id") in by
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert S.extract(docs.limit(0)).count() == 0


def test_shared_passages_of_articles_stay(spark):
    """Copies of an article on one host are no template."""
    rows = [(i, "http://one.org/x", f"<nav><ul><li><a href=a>home</a></ul></nav><article><p>same words</p><p>page {i % 2}</p></article>")
            for i in range(10)]
    got = S.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"same words\npage 0", "same words\npage 1"}


def test_given_pages(spark):
    """The pages' articles, by the plainest means."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = S.query(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))]
        assert r["text"] == "\n".join(x for x in blocks if x)


def test_marking_words_never_drop_the_page():
    """Parts of class words and other attributes say nothing; what holds the article isn't dropped by a word."""
    inner = "<article><p>the story</p></article>"
    for page in ('<body class="no-sidebar">' + inner, '<div class="content-with-sidebar">' + inner,
                 '<main class="main has-banner"><p>the story</p></main>', '<article class="post share-enabled"><p>the story',
                 '<article class="promo"><p>the story', '<html class="popup"><body id="search"><p>the story',
                 f'<div class="widget"><div id="sidebar"><p>menu</p>{inner}</div></div>', f'<span class="promo">{inner}</span>',
                 '<article data-post-id="promo-1" data-role="ad"><p data-class="ad">the story',
                 '<div class="popup"><div role="main" class="banner"><p>the story</div></div>',
                 '<article><div class="has-banner"><p>the story</p></div><p class="skip-nav">x</p><div id="comments">troll</div></article>'):
        assert text(page) == "the story", page
    links = "<ul><li><a href=a>one other</a><li><a href=b>two other</a></ul>"
    story = "<p>" + "the long story " * 9 + "</p>"
    assert text(f'<article>{story}<div class="related-posts">{links}</div></article>') == ("the long story " * 9).strip()
    assert text(f'<article><div class="related-posts">{links}</div></article>') == "one other\ntwo other"


def test_blocks_inside_articles_recur(spark):
    """On a host of any size; copies of an article aren't counted and changed copies keep their text."""
    notice = "<div><p>Read all of it in our paper</p></div>"
    story = lambda i: f"<h1>Title {i}</h1><p>story {i} told in some {i} words</p><p>and an end {i}</p>"
    rows = [(i, f"http://one.org/a/{i}", f"<article>{story(i)}{notice if i < 8 else ''}</article>") for i in range(100)]
    rows += [(200 + i, f"http://one.org/b/{i}", f"<p>plain story {i}</p>" + (notice if i < 5 else "")) for i in range(50)]
    rows += [(300 + i, f"http://two.org/{i}", f"<article>{story(0)}{notice}</article>") for i in range(9)]
    version = "".join(f"<p>paragraph {k} of a long report</p>" for k in range(8))
    rows += [(400 + i, "http://three.org/x", f"<article>{version}<p>as of {i} o'clock</p></article>") for i in range(9)]
    got = {r["page_id"]: r["text"] for r in S.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)).collect()}
    assert len(got) == len(rows)
    for i, t in got.items():
        if i < 100:
            assert t == text(f"<article>{story(i)}</article>")
        elif i < 300:
            assert t == f"plain story {i - 200}"
        else:
            assert t == text(next(r[2] for r in rows if r[0] == i))
