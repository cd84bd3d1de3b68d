"""Main text of pages: planted articles, broken markup, and the vote of a host's pages."""

import html
import re
import time

import numpy as np
import pytest

from tallyrisk.llm.entries import op13_html
from tallyrisk.llm.pages import extract_pages, main_text, read_page

LONG = "Plain words of the story, told at some length so that it counts. " * 8


def tidy(*parts):
    return " ".join(" ".join(parts).split())


@pytest.mark.parametrize("page,want", [
    ("", ""),
    ("no tags at all", "no tags at all"),
    ("<p>one<p>two", "one two"),
    ("<article><h1>T</h1><p><b>un<i>clo</i>sed<br>line<p>next</article><footer>f</footer>", "T unclosed line next"),
    ("<article><p>a &lt;b&gt; &amp;amp; caf&eacute; &#8364;&#x20AC; &copy</p></article>", "a <b> &amp; café €€ ©"),
    ("<article><p>3 < 4 and 5 <6 <</p></article>", "3 < 4 and 5 <6 <"),
    ("<article><p>a\n\t b  c</p>\n\n<p> d</p></article>", "a b c d"),
    ("<article><p>a</p><!-- <p>no</p> --><p>b</p><!-- open <p>c</p>", "a b"),
    ("<article><script>if (a < b) x = '</p><p>no</p>';</script><p>a</p><STYLE>p{}</STYLE><p>b</p><script>open <p>c", "a b"),
    ("<article><p title='a>b' data-x=\"</article>\">in</p> out</article>", "in out"),
    ("<article><ul><li>one<li>two<ul><li>in</ul><li>three</ul></article>", "one two in three"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
    ("<article><p>kept</p><p>cut <a href='x", "kept cut"),
    ("<article></div></span></p><p>a</p></article></article>", "a"),
    ("<article><p>x<span>y</span>z</p><div>d</div>e</article>", "xyz d e"),
    ("<nav>menu</nav><p>text</p><form>f<p>g</p></form><noscript><p>n</p></noscript>", "text"),
    ("<head><title>t</title><p>body begins</p>", "body begins"),
    ("<article><p>a</p><p hidden>b</p><p style='display: none'>c</p><p aria-hidden=true>d</p></article>", "a"),
    ("<svg><text>no</text></svg><template><p>no</p></template><p>yes</p><select><option>no</select>", "yes"),
])
def test_pages_read_as_browsers_read_them(page, want):
    assert main_text(page, []) == want


def full_page(body, host_part=""):
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body class='has-sidebar'>"
            f"<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></ul></nav>"
            f"<div class='cookie-notice'>We use cookies.</div><div id=sidebar><p>{LONG}</p></div>{body}"
            f"<section id='comments'><article class=comment><p>{LONG * 3}</p></article></section>"
            f"<div class='ad-box'>Buy</div><aside>{LONG}</aside><div role=search>s</div>{host_part}"
            f"<footer>&copy; us</footer><script>track('</p>')</script></body></html>")


@pytest.mark.parametrize("body", [
    f"<article class='post has-comments'><h1>Title</h1><p>{LONG}</p><p>End.</p></article>",
    f"<main><h1>Title</h1><div class=text><p>{LONG}</p><p>End.</p></div></main>",
    f"<div class='story story-17'><h1>Title</h1><div class=b><p>{LONG}<p>End.</div></div>",
    f"<div id=content><article><h1>Title</h1><section><p>{LONG}</p></section><section><p>End.</p></section></article></div>",
    f"<article><h1>Title</h1><div class='share-buttons'>Tweet</div><p>{LONG}</p><div class=newsletter>Join</div><p>End.</p></article>",
])
def test_article_without_what_stands_beside_it(body):
    assert main_text(full_page(body), []) == tidy("Title", LONG, "End.")


def rows_of(found):
    return {r["page_id"]: r["text"] for r in found.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows],
                                 "page_id long, url string, html string, text string, path int")


def test_the_hosts_votes_decide(spark):
    """Where one page's loudest container is another one, the path of the host's other pages is taken."""
    usual = "<div class='entry-{0}'><p>Story {0}. {1}</p></div><div class=extra><p>{2}</p></div>"
    rows = [(i, "http://a.org/x", usual.format(i, LONG, "Short.")) for i in range(12)]
    rows.append((90, "http://A.org:80/y", usual.format(90, "", LONG * 3)))
    rows.append((91, "https://b.org/y", usual.format(91, "", LONG * 3)))
    got = rows_of(extract_pages(frame(spark, rows)))
    assert got[3] == tidy("Story 3.", LONG) and got[90] == "Story 90."
    assert got[91] == tidy(LONG * 3)  # its host knows no other page


def test_several_templates_of_a_host(spark):
    rows = [(i, "http://a.org", f"<article><p>{LONG}{i}</p></article>") for i in range(6)]
    rows += [(10 + i, "http://a.org", f"<div class=note><p>{LONG}{i}</p></div><article><p>teaser</p></article>") for i in range(6)]
    got = rows_of(extract_pages(frame(spark, rows)))
    assert got[0] == tidy(LONG + "0") and got[12] in (tidy(LONG + "2"), "teaser")


def test_nulls_empties_repeats_and_hostless(spark):
    page = f"<article><p>{LONG}</p></article>"
    rows = [(1, None, page), (1, None, page), (2, "mailto:x", None), (3, "http://a.org", ""), (None, "http://a.org", "<p> </p>"),
            (4, "http://a.org", "<p>" + "word " * 300_000 + "</p>")]
    found = extract_pages(frame(spark, rows))
    assert found.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    got = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in found.collect()))
    story = tidy(LONG)
    assert got == [(0, "", 0), (1, story, len(story)), (1, story, len(story)), (2, "", 0), (3, "", 0), (4, tidy("word " * 300_000), 1_499_999)]
    assert extract_pages(frame(spark, [])).count() == 0


def test_broken_markup_takes_linear_time():
    for piece in ("<div>", "<p><b>", "</div>", "<a b='", "<ul><li>", "<table><td>", "<x", "<!--", "<script>", "&", "<div class='a1 b2'><span>"):
        start = time.time()
        read_page(piece * 40_000).candidate()
        assert time.time() - start < 20, piece


def test_random_pages_keep_every_planted_word():
    """Words of the article are unique: exactly they come out, in order, whatever the nesting around them."""
    rng = np.random.default_rng(7)
    for trial in range(60):
        words = [f"w{trial}x{i}" for i in range(80)]
        article, at = "<article class='post-%d'>" % trial, 0
        while at < len(words):
            n = int(rng.integers(1, 9))
            chunk = html.escape(" ".join(words[at:at + n]))
            at += n
            article += rng.choice([f"<p>{chunk}</p>", f"<p>{chunk} ", f"<div><section><p>{chunk}</p></section></div>", f"<h2>{chunk}</h2>",
                                   f"<ul><li>{chunk}</li></ul>", f"<blockquote>{chunk}</blockquote>", f"<p><i><b>{chunk}</i></b></p>",
                                   f"{chunk}<br>", f"<table><tr><td>{chunk}</td></tr></table>", f"<div class=ad>no</div><p>{chunk}</p>"])
        page = full_page(article + "</article>", host_part="<div class='related'><p>no</p></div>")
        assert main_text(page, []).split() == words


def test_entry_equals_the_planted_articles(spark, small_dir):
    want = {}
    for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect():
        inside = re.search("<article>(.*?)</article>", r["html"] or "", re.S).group(1)
        want[r["page_id"]] = tidy(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inside))))
    got = op13_html(spark, small_dir)
    assert rows_of(got) == want and [r["n_chars"] for r in got.collect()] == [len(r["text"]) for r in got.collect()]
