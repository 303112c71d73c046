"""Extraction from pages whose main text is known, as they are put together from it."""

from __future__ import annotations

import html
import random
import time

import numpy as np
import pytest

from stationhour.llm import html_text

WORDS = "the river carried old boats past quiet towns while market people watched light fall over water & stone".split()
LONG = "This paragraph is long enough to be told from menus, and it says something of its own about the page that it is on."


def page(body: str) -> str:
    return (f"<!DOCTYPE html><html><head><title>T</title></head><body><nav><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav>{body}"
            "<footer>someone</footer></body></html>")


def lines(*paragraphs: str) -> str:
    return "".join(f"<p>{x}</p>" for x in paragraphs)


def test_all_regions_stay():
    one, two = "First. " + LONG, "Second. " + LONG
    assert html_text.main_text(page(f"<article><h2>A</h2>{lines(one)}</article><article><h2>B</h2>{lines(two, 'Short.')}</article>")) == f"A\n{one}\nB\n{two}\nShort."


def test_a_teaser_does_not_replace_the_text():
    body = [f"{i}. {LONG}" for i in range(6)]
    got = html_text.main_text(page(f"<div class='text'><h1>Head</h1>{lines(*body)}</div><article>{lines('A teaser. ' + LONG)}</article>"))
    assert got.startswith("Head\n" + "\n".join(body))


def test_text_outside_of_a_heavier_article_goes():
    assert html_text.main_text(page(f"<article>{lines(LONG, LONG, LONG)}</article><div>Some company, all rights reserved.</div>")) == "\n".join([LONG] * 3)


@pytest.mark.parametrize("open_tag", ["<div class='with-sidebar'>", "<article class='has-comments'>", "<div class='no-ads page'>", "<div class='banner'>", "<div id='search'>",
                                      "<article class='share'>", "<div class='sidebar'>"])
def test_a_wrapper_is_not_boilerplate(open_tag):
    tag = open_tag[1:].split()[0]
    inner = f"<h1>Head</h1>{lines(LONG, 'Short.')}"
    assert html_text.main_text(page(f"{open_tag}{inner}</{tag}>")) == f"Head\n{LONG}\nShort."


@pytest.mark.parametrize("heading", ["<h2 id='related-work'>X</h2>", "<section id='search'><h2>X</h2></section>", "<h2 id='notice-periods'>X</h2>", "<h2 class='search'>X</h2>",
                                     "<header><h2>X</h2></header>", "<div class='related-work'>X</div>"])
def test_parts_of_an_article_stay(heading):
    assert html_text.main_text(page(f"<article>{lines(LONG)}{heading}{lines(LONG)}</article>")) == f"{LONG}\nX\n{LONG}"


BOILERPLATE = ["<div class='ad'>{}</div>", "<aside>{}</aside>", "<div class='cookie-notice'>{}</div>", "<section class='comments'><h3>Comments</h3><p>{}</p></section>",
               "<div class='comment-list'><article class='comment'><p>{}</p></article></div>", "<form><p>{}</p><input></form>", "<div class='newsletter box'>{}</div>",
               "<div class=site-footer>{}</div>", "<script>var x = '<p>{}</p>';</script>", "<style>/* {} */</style>", "<div class='related-posts'><p>{}</p></div>",
               "<nav>{}</nav>", "<div hidden>{}</div>", "<p class='ad'>{}<p>", "<div role='complementary'>{}</div>", "<!-- {} -->", "<noscript>{}</noscript>",
               "<div id='comments'><p>{}</p></div>", "<ul><li><a href=/1>one</a></li>\n<li><a href=/2>two</a></li>\n<li><a href=/3>{}</a></li></ul>"]


@pytest.mark.parametrize("kind", BOILERPLATE)
@pytest.mark.parametrize("inside", [True, False])
def test_boilerplate_goes(kind, inside):
    noise = kind.format("Noise of some length.")
    main = lines(*[LONG] * 4)
    body = f"<article>{main}{noise}{lines('End.')}</article>" if inside else f"{noise}<article>{main}{lines('End.')}</article>{noise}"
    assert html_text.main_text(page(body)) == "\n".join([LONG] * 4 + ["End."])


def test_line_breaks_and_references():
    assert html_text.main_text(page(f"<article><p>One<br>two<br/>three &amp; &#x41;&lt;b&gt; {LONG}</p></article>")) == f"One two three & A<b> {LONG}"


def sentence(rng) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(2, 60))).capitalize() + "."


def test_generated_pages():
    """Articles of any number of paragraphs among boilerplate, in several kinds of wrapper: exactly the article comes back."""
    rng = random.Random(4)
    for _ in range(300):
        paragraphs = [sentence(rng) for _ in range(rng.randint(1, 25))] + [LONG]
        marked = []
        for x in paragraphs:
            kind = rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<div><p>\n{}\t</p></div>", "<p><b>{}</b></p>"])
            marked.append(kind.format(html.escape(x)))
            if rng.random() < 0.15:
                marked.append(rng.choice(BOILERPLATE).format("Noise."))
        before = "".join(rng.choice(BOILERPLATE).format("Noise.") for _ in range(rng.randint(0, 3)))
        body = f"{before}<{{0}}>{''.join(marked)}</{{0}}>{before}".replace("{0}", rng.choice(["article", "main"]))
        assert html_text.main_text(page(body)) == "\n".join(paragraphs)


@pytest.mark.parametrize("piece", ["<a ", "</a ", "<!--", "<!-- a <p>b ", "<![CDATA[>", "<p>x", "<div>", "</div>", "<a b='", "<textarea>", "<?", "<script>", "&#", "<"])
def test_time_is_linear(piece):
    started = time.perf_counter()
    html_text.main_text(piece * (360_000 // len(piece)))
    html_text.main_text(piece * (360_000 // len(piece)) + " >")
    assert time.perf_counter() - started < 10  # a second or two; the square of the length would take minutes


def test_nested_stacks():
    started = time.perf_counter()
    assert html_text.main_text("<div>" * 8000 + "x" + "</section>" * 8000 + "</div>" * 8000) == "x"
    assert time.perf_counter() - started < 5


def test_the_unfinished_end_is_dropped():
    assert html_text.main_text(f"<article><p>{LONG}</p><p>a < b and 1 <2 <a href='") == f"{LONG}\na < b and 1 <2"
    assert html_text.main_text(f"<article><p>{LONG}<!-- never closed <p>after</p></article>") == LONG


def test_threshold_lies_between_two_clusters():
    values = np.array([0.1, 0.2, 0.15, 4.0, 5.0, 4.5, 0.3])
    assert 0.3 < html_text.threshold(values) < 4.0
    assert html_text.threshold(np.array([2.0, 2.0])) == 2.0
    plain = [sum(html_text.smoothed(np.eye(9)[i])) for i in range(3, 6)]
    assert np.allclose(plain, 1)
    assert html_text.runs(np.array([1, 1, 0, 1, 1, 1], bool), 3) == [slice(3, 6)]


@pytest.mark.parametrize("token, expected", [("ad", True), ("with-sidebar", False), ("has-comments", False), ("related-work", False), ("cookie-banner", True), ("siteFooter", True),
                                             ("comment_list", True), ("main-content", False), ("notice-periods", False), ("", False)])
def test_names(token, expected):
    assert html_text.names_boilerplate(token, html_text.BOILERPLATE) is expected
