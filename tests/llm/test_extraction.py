"""Main text where few or no pages mark it, and what stands inside of it."""

import random

import pytest

from vellumark.llm import dom, extraction

SCHEMA = "page_id bigint, url string, html string"
PAGE = '<html><head><title>t</title></head><body><nav><ul><li><a href="/a">x</a></li></ul></nav>{}<footer>&copy; y</footer></body></html>'


def said(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(4, 9))) for _ in range(n))


def shown(source):
    page = dom.parse(source)
    return extraction.main_text(page, [True] * len(page.elements))


def test_few_pages_mark_their_article(spark):
    bare = [(k, "u", PAGE.format(f'<div class="menu"><a href="/">{said(k, 3)}</a></div>')) for k in range(450)]
    marked = [(1000 + k, "u", PAGE.format(f"<main> </main><article>{''.join(f'<p>{said(7 * k + j, 40)}</p>' for j in range(4))}</article>")) for k in range(6)]
    made = {r["page_id"]: r["text"] for r in extraction.extract(spark.createDataFrame(bare + marked, SCHEMA), limit=20).collect()}
    for k in range(6):
        assert made[1000 + k] == "\n\n".join(said(7 * k + j, 40) for j in range(4))


def test_no_page_marks_its_article(spark):
    body = '<div class="content"><h1>{}</h1>{}</div>'
    pages = [(k, "u", PAGE.format(body.format(said(k, 3), "".join(f"<p>{said(9 * k + j, 40)}</p>" for j in range(5))))) for k in range(60)]
    made = {r["page_id"]: r["text"] for r in extraction.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert all(said(9 * k + j, 40) in made[k] for k in range(60) for j in range(5))


@pytest.mark.parametrize("tag", ["math", "object", "noscript", "svg", "canvas"])
def test_what_an_article_holds_stays(tag):
    assert shown(f"<article><p>one <{tag}>two</{tag}> three</p><p>four</p></article>") == "one two three\n\nfour"
    assert shown(f"<article><p>one <{tag}>two</p><p>three</p></article>") == "one two\n\nthree"


def test_formula_and_choices():
    assert shown("<p>so <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow></math> holds</p>") == "so x=2 holds"
    assert shown("<p>of <select><option>a<option>b</select> take</p>") == "of a b take"


@pytest.mark.parametrize("tag", ["script", "STYLE", "template", "textarea"])
def test_hidden_contents_end_at_their_tag(tag):
    assert shown(f"<p>\u0130\u0130\u0130\u0130 one</p><{tag}>hidden </{tag.lower()}x></{tag.upper()} ><p>two</p>") == "\u0130\u0130\u0130\u0130 one\n\ntwo"
