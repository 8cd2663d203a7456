"""op7 on pages of several makes."""

import random

import pytest

from quayside.llm import pages

LONG = "A sentence of the article that is long enough to weigh something in the page."

CASES = {
    "marked article": (
        f"<html><head><title>T</title></head><body><header>Site</header><nav><a href=/>A</a></nav>"
        f"<article><h1>Head &amp; line</h1><p>{LONG}<p>Two&nbsp;  <b>words</b><br>more"
        f"<aside>no</aside><div class='ad-box'>Buy</div><p>Z.</article><footer>&copy; x</footer>",
        f"Head & line\n{LONG}\nTwo words more\nZ."),
    "no marks": (
        f"<body><div><a href=/a>Home</a> <a href=/b>News</a></div><div><p>{LONG}</p><p>Short.</p>"
        f"<p>{LONG}</p></div><div class='comments'><p>{LONG}</p></div><p>© 2020 Site</p></body>",
        f"{LONG}\nShort.\n{LONG}"),
    "comment heading": (
        f"<div><p>{LONG}</p><p>{LONG}</p></div><h3>3 Comments</h3><div><p>{LONG}</p></div>",
        f"{LONG}\n{LONG}"),
    "script and comment": (
        f"<main>{LONG}<script>if (a < b) '</p>';</script><!-- <p>no</p> --><style>p{{}}</style>"
        "<form><p>mail</p></form><div hidden>no</div><div style='display: none'>no</div></main>",
        LONG),
    "comments in the article": (
        f"<article><p>{LONG}</p><section id='comments'><article><p>{LONG} {LONG}</p></article>"
        "</section></article>", LONG),
    "cookie notice and side bar": (
        f"<div class='cookie-consent'>We use cookies</div><div id=sideBar>x</div>"
        f"<div class='post no-sidebar'><p>{LONG}</p></div><div role=navigation>y</div>", LONG),
    "named part": (
        f"<div class='top'>Welcome to the site, have a look around here</div>"
        f"<div id='main-content'><div class='post-header'><h1>T</h1></div><p>{LONG}</p><p>De.</p>"
        f"<h2>Reader comments (2)</h2><p>{LONG}</p></div><div class='box'>{LONG}</div>",
        f"T\n{LONG}\nDe."),
    "heading beside a nested article": (
        f"<main><h1>Head</h1><nav>menu</nav><article><p>{LONG}</p></article><p>After.</p></main>",
        f"Head\n{LONG}\nAfter."),
    "sibling parts": (
        f"<article><h1>Head</h1><p>{LONG}</p></article><div>Elsewhere on this site, much more</div>"
        f"<article><p>{LONG} {LONG}</p></article><article><h3><a href=/x>A teaser</a></h3></article>",
        f"Head\n{LONG}\n{LONG} {LONG}"),
    "equal sibling parts": (
        f"<article><p>{LONG}</p></article><article><p>{LONG}</p></article>", f"{LONG}\n{LONG}"),
    "comment articles beside the article": (
        f"<article><p>{LONG}</p></article><h2>Comments (2)</h2><article><p>{LONG} no</p></article>",
        LONG),
    "broken": (f"<p>a < b & c &lt; d {LONG}<div><p>{LONG}", f"a < b & c < d {LONG}\n{LONG}"),
    "plain": ("only text", "only text"),
    "empty": ("", ""),
    "no text": ("<html><nav>menu</nav></html>", ""),
    "unclosed comment": (f"<p>{LONG}</p><!-- to the end <p>{LONG}", LONG),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    html, expected = CASES[name]
    assert pages.main_text(html) == expected


def built(rng):
    """A page made around a known article, and the article: marked or not by tags or names."""
    def words(n):
        return " ".join(rng.choice(["alpha", "beta", "gamma &amp; delta", "é", "42", "end."])
                        for _ in range(n))

    blocks = [("h1", words(4))] + [(rng.choice(["p", "p", "h2", "li", "blockquote"]), words(
        rng.randint(6, 40))) for _ in range(rng.randint(3, 9))]
    junk = [f"<nav><ul>{''.join(f'<li><a href=/{k}>{words(2)}</a>' for k in range(6))}</ul></nav>",
            f"<div class='{rng.choice(['sidebar', 'ad-slot', 'cookie-notice', 'related'])}'><p>"
            f"{words(30)}</p></div>", f"<footer><p>{words(20)}</p></footer>",
            f"<script>if (a < b) {{ x = '<p>{words(9)}</p>' }}</script><!-- <p>{words(9)} -->",
            f"<form><label>{words(5)}</label></form>", f"<aside><p>{words(25)}</p></aside>"]
    inner = []
    for tag, text in blocks:
        if rng.random() < 0.3:
            inner.append(rng.choice(junk))
        cut = rng.randint(0, len(text))
        cut = cut if text[:cut].count("&") == text[:cut].count(";") else 0
        inner.append(f"<{tag}>\n  {text[:cut]}{rng.choice(['', '<b></b>', chr(10)]) if text[cut - 1:cut] == ' ' else ''}"
                     f"{text[cut:]}</{tag}>")
    body = "".join(inner)
    opened, closed = rng.choice([("<article>", "</article>"), ("<main>", "</main>"),
                                 ("<div class='post-content'>", "</div>"),
                                 ("<main><article>", "</article></main>")])
    page = (f"<html><head><title>{words(3)}</title><style>p {{}}</style></head><body>"
            f"<header>{words(8)}</header>{rng.choice(junk)}{opened}{body}{closed}{rng.choice(junk)}"
            f"<div class='comments'><p>{words(40)}</p></div></body></html>")
    return page, "\n".join(text.replace("&amp;", "&") for _, text in blocks)


def test_pages_built_around_a_known_article_give_it_whole():
    rng = random.Random(41)
    for _ in range(400):
        page, article = built(rng)
        assert pages.main_text(page) == article, page


def test_query(spark):
    rows = [(k, f"u{k}", html) for k, (html, _) in enumerate(CASES.values())]
    rows += [(None, None, None), (1, "again", "x"), (99, "long", "<p>" + "word " * 200_000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in pages.op7(table).collect()}
    assert len(got) == len(rows) and got[(None, None)] == ("", 0)
    for k, (_, text) in enumerate(CASES.values()):
        assert got[(k, f"u{k}")] == (text, len(text))
    assert got[(99, "long")][1] == 200_000 * 5 - 1
    assert pages.op7(table.where("false")).collect() == []
    assert pages.extract(table.withColumnRenamed("url", "main")).columns == [
        "page_id", "html", "main"]


def test_supplied_pages_give_their_articles(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in pages.op7(table).collect():
        assert "track(" not in r.text and "©" not in r.text and r.text == r.text.strip()
