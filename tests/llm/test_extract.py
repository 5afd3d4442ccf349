import html as H
import re

import pytest

from versus.llm import extract

PARA = "The house of the old man was on the hill and it was not far from the river that they had crossed with him in the morning. " * 2
SHORT = "It was late."


def clean(s):
    return " ".join(s.split())


def test_pages_against_a_plain_reading(spark):
    """The fixture's pages mark their article; cut it out with patterns and strip the tags."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        m = re.search(r"(?s)<article>(.*?)(?:</article>|$)", r.html)
        body = m.group(1) if m else ""
        parts = [H.unescape(re.sub(r"<[^>]*>", "", x)) for x in re.split(r"(?i)</?(?:p|h1|br|div)>", body)]
        want = " ".join(filter(None, map(clean, parts)))
        assert got[r.page_id].text == want
        assert got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_blocks_without_article_mark():
    page = f"""<html><head><title>T</title><script>var a = "<p>x</p>";</script></head><body>
    <div id=top-menu><a href=1>Home</a> <a href=2>News</a></div>
    <div class="cookie-notice">We use cookies on this site and you have to agree to it.</div>
    <div class=content><h2>A heading</h2><p>{PARA}</p><p>{SHORT}</p><p>{PARA}<div class="ad">Buy the new one of it</div><p>{PARA}</p></div>
    <ul><li><a href=3>More</a><li><a href=4>And more</a></ul>
    <div class="comments"><p>{PARA}</p></div><p>&copy; 2020 The house</p></body></html>"""
    assert extract.main_text(page) == clean(" ".join(["A heading", PARA, SHORT, PARA, PARA]))


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><meta charset=utf-8><body><p>{PARA}</p>",
    f"<html><head><title>T</title><p>{PARA}</p>",
    f"<head><title>T</title><link href=x><body><article><p>{PARA}</p></article></body>",
    f"<body><form action=x><input name=q><article><p>{PARA}</p></article></form></body>",
    f"<body><form action=x><div><p>{PARA}</p></div><input name=q></form></body>",
    f"<body><nav><a href=1>Home</a><article><p>{PARA}</p></article></body>",
    f"<body><div><nav><a href=1>Home</a></div><p>{PARA}</p></body>",
    f"<body><nav><ul><li><a href=1>Home</a></ul><p>{PARA}</p></body></html>",
    f"<body><article><aside><b>See</b></aside><p>{PARA}</p></article><footer>The end",
])
def test_articles_are_not_lost_with_what_surrounds_them(page):
    assert extract.main_text(page) == clean(PARA)


def test_excluded_parts_stay_excluded():
    assert extract.main_text(f"<body><p>{PARA}</p><form><p>Your name</p></form><p>{PARA}</p></body>") == clean(PARA + PARA)
    assert extract.main_text(f"<body><aside><article><p>{PARA}</p></article></aside></body>") == ""
    assert extract.main_text(f"<body><p>{PARA}</p><footer>The end") == clean(PARA)


def test_copyright_sign_in_a_long_block():
    assert extract.main_text(f"<body><p>{PARA} &copy; {PARA}</p><p>&copy; 2020 The house</p></body>") == clean(f"{PARA} © {PARA}")


def test_marked_article_keeps_its_short_and_foreign_blocks():
    page = f"""<body><header><h1>Site</h1></header><main><article><header><h1>Title</h1></header><p>One.<p>{'xq zz kk ' * 40}</p>
    <form>Name <input></form><aside>{PARA}</aside><table><tr><td>a<td>b &amp; c&nbsp;d</table><section class=comments><p>{PARA}</section></article></main>
    <p>{PARA}</p><footer>{PARA}</footer>"""
    assert extract.main_text(page) == clean(f"Title One. {'xq zz kk ' * 40} a b & c d")


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<html", "<p", "<!-- x", "<script>var", "</p></div>", "&am"])
def test_broken_pages(page):
    assert extract.main_text(page) in ("", "&am", "<")


def test_inline_tags_do_not_split_words():
    assert extract.main_text("<article><p>wo<b>r</b>d<br>next</p><p>&lt;b&gt; &#233;&#x41;</article>") == "word next <b> éA"


def test_very_long_page():
    page = "<article>" + "<p>the man of the house</p>" * 60_000 + "</article>"
    assert extract.main_text(page) == " ".join(["the man of the house"] * 60_000)


def test_tables(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", None, 1, "x"), (None, None, "<article>a</article>", 1, "x"), (2, "u", "<article>a</article>", 1, "x"), (2, "u", "<article>a</article>", 1, "x")]
    got = extract.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "a", 1), (1, "", 0), (2, "a", 1), (2, "a", 1)]
    assert extract.extract(spark.createDataFrame([], schema)).count() == 0
