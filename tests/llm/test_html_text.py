import html
import re

import pytest

from flowmedallion.llm.html_text import DEFAULT, best_run, learn_weights, main_text, with_main_text
from flowmedallion.llm.queries import QUERIES

SHELL = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p><p>no no no</p>";</script></head><body>
<header><a href="/">Home</a> Site name of words</header><div class="cookie-notice">We use cookies to make this better for you and everyone else.</div>
<nav><ul><li><a href="/a">one thing</a></li><li><a>two</a></li></ul></nav>
<aside class="x"><p>Side text of many words that goes on and on beside the article.</p></aside>
{}
<form><label>Your name</label><input name=q><p>Fill in the form with many words please do it now.</p></form>
<section id="comments"><p>A reader said a thing that is quite long and has many words in it.</p></section>
<footer><p>&copy; us and them, all of the words of the footer are here</p></footer></body></html>"""
ARTICLE = """<h1>A title</h1><p>First paragraph with <b>several</b> words &amp; an &eacute; in&nbsp;it.</p><ul><li>one item</li><li>two items</li></ul>
<div class="ad-box">buy now all of it</div><p>Second one<br>breaks, <a href="x">linked words</a> go on.<!-- no <p>comment</p> --><p>Third, unclosed   and
spread out here."""
TEXT = "A title\nFirst paragraph with several words & an é in it.\none item\ntwo items\nSecond one breaks, linked words go on.\nThird, unclosed and spread out here."


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<div class='content'>{}</div>", "<main><header>{}</header></main>", "{}", "<div><div>{}</div></div>"])
def test_article_among_other_things(frame):
    assert main_text(SHELL.format(frame.format(ARTICLE)), DEFAULT) == TEXT


def test_query(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op3_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search("<article>(.*?)</article>", pages[r.page_id].html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_best_run_equals_brute_force():
    import random

    draw = random.Random(3)
    for _ in range(300):
        scores = [draw.choice((-3, -1, 0, 1, 2)) for _ in range(draw.randrange(14))]
        start, end = best_run(scores)
        best = max([0, *(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))])
        assert sum(scores[start:end]) == best


def test_weights_are_learned(spark):
    page = SHELL.format("<article>" + ARTICLE + "</article>")
    weights = learn_weights(spark.createDataFrame([(page,)] * 3, "html string"))
    assert weights["word"] >= 0.5 and weights["open body"] < -0.25 and weights["open article"] < weights["open p"] <= -0.25
    assert main_text(page, weights) == TEXT


@pytest.mark.parametrize(
    "page, text",
    [("", ""), ("plain words only", "plain words only"), ("<p>a &lt;b&gt; c", "a <b> c"), ("<", "<"), ("<p>x < y", "x < y"), ("<nav>never closed <p>still read here", "never closed\nstill read here"),
     ("<script>only code", ""), ("<div hidden>no</div><p>yes it is", "yes it is"), ("a" * 100_000, "a" * 100_000), ("<p>" * 3000 + "deep", "deep"),
     ("now see <a href=x'y>it's</a> a <b title='a>b' c=\"d'e>f\">bold</b> word", "now see it's a bold word"), ("<p \"x>open <i class=>quote</i>", "open quote"),
     ("<p>one<br/>two<p title=\"never closed>three</p>", "one two\nthree")],
)
def test_odd_pages(page, text):
    assert main_text(page, DEFAULT) == text


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None, 1), (None, "u", "", 2), (3, None, "<p>some words", 3), (3, None, "<p>some words", 3)], "page_id long, url string, html string, text int")
    for given in (pages, pages.limit(0)):
        rows = with_main_text(pages, learn_weights(given)).collect()
        assert sorted(r.text for r in rows) == ["", "", "some words", "some words"]
    assert with_main_text(pages.limit(0), DEFAULT).count() == 0


PROSE = "<h1>A title</h1><p>" + "several words of prose " * 20 + "</p>"
SAID = "A title\n" + ("several words of prose " * 20).strip()


@pytest.mark.parametrize(
    "frame",
    ["<div class='layout has-sidebar'><article>{}</article></div>", "<div class='layout has-sidebar'>{}</div>", "<div class='sidebar'><main>{}</main></div>",
     "<div id='social'>{}</div><p class='menu'>no</p>", "<form action=x><input type=hidden name=state>{}</form>", "<article><div class='share'>{}</div></article>",
     "<div style='display:none'>{}</div>", "<div class=discussion>{}</div>", "<nav><a>x</a></nav><dialog><article>{}</article></dialog>"],
)
def test_wrappers_with_barred_names_stay(frame):
    assert main_text(f"<html><body>{frame.format(PROSE)}</body></html>", DEFAULT) == SAID


def test_names_of_content_in_an_article_stay():
    page = f"<article>{PROSE}<section class='legal-text'><p>The law says so.</p></section><p class='share-of-voters'>Half of them.</p><div class='share-box'>Share it</div></article>"
    assert main_text(page, DEFAULT) == SAID + "\nThe law says so.\nHalf of them."


def test_long_comments_without_an_article_go():
    page = f"<div>{PROSE}</div><div id='comments'>" + "<p class=comment>words of a reader again and again</p>" * 60 + "</div>"
    assert main_text(page, DEFAULT) == SAID


@pytest.mark.parametrize("element", ["<svg class=a />", "<svg/>", "<iframe src='x'/>", "<object data=\"a/>b\" />", "<math/>", "<svg hidden/>"])
def test_closed_foreign_elements_swallow_nothing(element):
    assert main_text(f"<p>one two {element}three</p><p>four five six</p>", DEFAULT) == "one two three\nfour five six"
    assert main_text("<p>one <iframe src=http://a.b/>inner</iframe>two</p><svg><text>no</text></svg>", DEFAULT) == "one two"


@pytest.mark.parametrize("name", ["head", "select", "noscript", "iframe", "svg", "template"])
def test_elements_without_an_end_tag_swallow_nothing(name):
    before = "<html><head><title>no</title>" if name == "head" else f"<html><head></head><body><{name}>"
    assert main_text(f"{before}<body><article><h1>Title</h1><p>All of the words that there are.</article>", DEFAULT) == "Title\nAll of the words that there are."
    if name != "head":
        assert main_text(f"<p>one two</p><{name}>gone</{name}><p>three four", DEFAULT) == "one two\nthree four"
        assert main_text(f"<p>one two</p><{name}>gone</{name}><p>three four<{name}>five", DEFAULT).endswith("three fourfive")


@pytest.mark.parametrize("tag", ["form", "article", "div class='sidebar'", "p", "select", "b", "article><nav"])
def test_deep_nesting_takes_linear_time(tag):
    import time

    first = tag.split()[0].split(">")[0]
    page = f"<body>{f'<{tag}>' * 10_000}<p>these words are the content of it</p>{f'</{first}>' * 10_000}"
    start = time.process_time()
    text = main_text(page, DEFAULT)
    assert time.process_time() - start < 1.5 and text in ("these words are the content of it", "")


def brute_ends(tokens):
    from flowmedallion.llm.html_text import BLOCKS, VOID

    ends = []
    for i, (kind, name, _) in enumerate(tokens):
        depth, end = 1, None
        if kind == "open" and name in VOID:
            end = i + 1
        elif kind == "open":
            for j in range(i + 1, len(tokens)):
                other, called, _ = tokens[j]
                if other == "open" and name == "p" and called in BLOCKS:
                    end = j
                elif called == name:
                    depth += {"open": 1, "close": -1}.get(other, 0)
                    end = None if depth else j + 1
                if end is not None:
                    break
            if end is None and name == "p":
                end = len(tokens)
        ends.append(end)
    return ends


def test_element_ends_equal_brute_force():
    import random

    from flowmedallion.llm.html_text import element_ends

    draw = random.Random(5)
    for _ in range(400):
        tokens = [(draw.choice(("open", "open", "close", "word")), draw.choice(("p", "div", "b", "br", "li")), "") for _ in range(draw.randrange(25))]
        assert element_ends(tokens) == brute_ends(tokens)


def test_run_decides_but_for_what_lies_outside_the_article():
    page = "<body><div>some words before it</div><article><p>{}</p></article><div>and some words behind it</div>"
    long, short = "many words of an article " * 20, "two words"
    assert main_text(page.format(long), DEFAULT) == long.strip()
    assert "words before" in main_text(page.format(short), DEFAULT) or "words behind" in main_text(page.format(short), DEFAULT)
