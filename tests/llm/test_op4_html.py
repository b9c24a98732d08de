import html as stdlib_html
import random
import re

import duckdb
import pytest

from riskweave.llm.html import classify, extract_main_text, extract_text

LONG = ("The river that runs through the town was for a long time the only way to get to the sea, and it is said "
        "that the people who lived on it had never seen a road before the war.")
TEXT = ("In the morning the boats would leave the quay and in the evening they would come back with fish and with "
        "news of the world that was far away from all of us.")


def test_article_without_furniture():
    page = f"""<!doctype html><html><head><title>T</title><script>if(a<b){{x("</p>")}}</script><style>p{{}}</style></head>
    <body class="has-sidebar"><header><h1>Site</h1><nav><a href=x>Home</a> <a href=y>News</a></nav></header>
    <div class="cookie-notice">We use cookies to give you the best experience that you can get on our site.</div>
    <div id="content"><div class="entry-header"><h2>How it was won &amp; lost</h2></div><p>{LONG}</p><p>Yes.</p>
    <div class="advert">Buy the new thing that you have always wanted in the shop of the town and save.</div>
    <p>{TEXT}<br>More   of\nit.</p><!-- {TEXT} --></div><aside>Other stories in the paper</aside>
    <div class="comments"><p>I was there and I can tell you that it was not at all like this, and never was.</p></div>
    <form><label>Name</label><p>Write to us if you have a question about the paper or the site.</p></form>
    <footer>(c) the paper</footer></body></html>"""
    assert extract_text(page).split("\n\n") == ["How it was won & lost", LONG, "Yes.", f"{TEXT} More of it."]


@pytest.mark.parametrize("box", [
    '<div class="sidebar">{}</div>', '<nav>{}</nav>', '<div id="comments">{}</div>', '<section class="reader-comments">{}</section>',
    '<div role="navigation">{}</div>', '<ul class="menu"><li>{}</li></ul>', '<div class="ad">{}</div>', '<form>{}</form>',
    '<div class="newsletter-signup">{}</div>', '<noscript>{}</noscript>', '<template>{}</template>', '<div hidden>{}</div>',
    '<div style="display: none">{}</div>', '<div class="site-footer">{}</div>', '<div class="siteHeader">{}</div>',
    '<script>{}</script>', '<style>{}</style>', '<!-- {} -->', '<div class="notice notice-warning">{}</div>'])
def test_furniture_is_left_out_wherever_it_stands(box):
    for inside in (True, False):
        one = box.format(TEXT)
        page = f"<body><article><p>{LONG}</p>{one if inside else ''}<p>{LONG} Again.</p></article>{'' if inside else one}</body>"
        assert extract_text(page) == f"{LONG}\n\n{LONG} Again."


def test_page_without_article_element():
    page = (f'<div><a href="/">Home</a> <a href="/n">News</a></div><div>{LONG}</div><div>Short.</div><div>{TEXT}</div>'
            f'<div><a href="/x">One more story of the town</a></div><div>Copyright 2020</div>')
    assert extract_text(page) == f"{LONG}\n\nShort.\n\n{TEXT}"


@pytest.mark.parametrize("name", ["legal", "content-form", "comment-on-art"])
def test_an_article_keeps_running_text_under_a_doubtful_name(name):
    page = f'<article><p>{LONG}</p><div class="{name}"><p>{LONG} 2</p><p>Short.</p><p>{TEXT}</p></div></article>'
    assert extract_text(page).split("\n\n") == [LONG, f"{LONG} 2", TEXT]
    assert extract_text(page.replace(name, "comment-form")) == LONG


def test_a_paragraph_that_is_one_link_stays_in_an_article():
    page = f'<article><p>{LONG}</p><p><a href="x">{TEXT}</a></p><ul><li><a href="y">More news</a></li></ul></article>'
    assert extract_text(page) == f"{LONG}\n\n{TEXT}"


def test_a_small_article_does_not_hide_the_story():
    page = f'<article class="teaserbox"><p>A teaser.</p></article><div>{LONG}</div><div>{TEXT}</div><div><a href="x">More</a></div>'
    got = extract_text(page).split("\n\n")
    assert LONG in got and TEXT in got and "More" not in got


@pytest.mark.parametrize("text", [
    "Il fiume che attraversa la città era per molto tempo l'unica strada verso il mare, e si dice che la gente che viveva "
    "sulle sue rive non avesse mai visto una strada prima della guerra.",
    "Rzeka, która płynie przez miasto, była przez długi czas jedyną drogą do morza i mówi się, że ludzie mieszkający nad nią "
    "nigdy przed wojną nie widzieli drogi."])
def test_languages_that_are_not_listed(text):
    page = f'<div><a href="/">Home</a> <a href="/n">News</a></div><div>{text}</div><div>{text} 2</div><div><a href="/x">{text[:90]}</a></div>'
    assert extract_text(page) == f"{text}\n\n{text} 2"


def test_short_blocks_inherit_from_the_nearest_decided_neighbour():
    link = ("Home News Sport and more of the links", 30, False, False, False)
    good = (LONG, 0, False, False, False)
    short = ("Yes.", 0, False, False, False)
    assert classify([link, short, good, short, short, link]) == [False, True, True, True, False, False]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a", "a"), ("<!-- x", ""), ("<script>x", ""), ("<p>5 < 6 &lt;b&gt;", "5 < 6 <b>"),
    ("<div>a<p>b</div>c", "a\n\nb\n\nc"), ("<p>&#233;&eacute;&nbsp;x", "éé x"), ("<" * 5000, "<" * 5000), ("<b>" * 20_000, ""),
    ("<p>a</p>" * 3, "a\n\na\n\na")])
def test_odd_pages(page, text):
    got = extract_text(page)
    assert got == text or set(page) == {"<"} and got in ("", text)


def test_very_long_page():
    page = f"<article>{f'<p>{LONG}</p>' * 5000}</article>"
    assert extract_text(page).count(LONG) == 5000


def test_against_the_marked_article_of_generated_pages():
    rows = duckdb.connect().sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (page,) in rows:
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        parts = [" ".join(stdlib_html.unescape(x).split()) for x in parts]
        assert extract_text(page) == "\n\n".join(x for x in parts if x)


def test_operator_keeps_every_row(llm):
    rng = random.Random(2)
    rows = [(i, rng.choice(["u", None]), rng.choice([None, "", f"<p>{LONG}</p>"]), "x", 1) for i in range(40)] + [(1, "u", "<p>z", "x", 1)] * 2
    df = llm.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = extract_main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    key = lambda r: repr(r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        ((i, u, extract_text(h), len(extract_text(h))) for i, u, h, _, _ in rows), key=key)
    assert extract_main_text(df.limit(0)).count() == 0
