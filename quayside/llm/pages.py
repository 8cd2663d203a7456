"""op7: main text of HTML pages by line-block distribution.

Markup is stripped into lines, one for each run of text between block borders.  A line weighs
its characters, blanks aside, outside of links; lines in parts that never hold the article (menus, headers,
footers, side bars, notices, adverts, forms, comments, hidden parts) weigh nothing.  Sums of
the weights over windows of ``WINDOW`` lines are then scanned: text begins where a sum surges
and ends where it dives, and the lines between are kept.

Where the page marks its article (``article``, ``main``, or a part named as such; the outermost
ones count), only lines in marked parts weigh.  Window sums choose among several: a part is kept
where a sum in it surges to a share of the largest in any.  Within a kept part any weight is a
surge, so nothing of it is dropped.  Elsewhere a surge needs that share of the page's largest sum,
and segments far smaller than the largest are left out.  What follows a heading of reader
comments is left out.

Character references are decoded, white space inside a line becomes one space, and lines are
joined by a newline.  A null or empty page, or one without text, gives an empty text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quayside.llm import batches as B

WINDOW = 3
SURGE = 0.2  # of the largest window sum
SEGMENT = 0.25  # of the largest segment's weight, on pages that mark no article

# HTML element names, and words that sites name such parts with.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre section select summary table tbody td tfoot th thead tr "
    "ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|canvas|object|math"
LEFT_OUT = frozenset("nav aside footer form menu dialog button select option head label".split())
ARTICLES = frozenset(["article", "main"])
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog "
                  "form menu menubar toolbar".split())
PART_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising adbox adslot sponsor sponsored "
    "promo promoted promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "masthead footer cookie cookies consent gdpr notice notices alert paywall disclaimer popup "
    "modal overlay newsletter subscribe subscription signup login social share sharing related "
    "recommended recommendations comment comments commentlist disqus replies respond reply "
    "toolbar pagination pager skip copyright announcement discussion advt taboola "
    "outbrain".split())
WEAK_WORDS = frozenset(["header", "widget", "aside", "side", "bottom", "top", "search", "form"])
GOOD_WORDS = frozenset("article content main post entry story text body".split())
ARTICLE_NAMES = frozenset("article content main post entry story maincontent articlebody".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
TURNED = frozenset(["no", "with", "has", "without"])
COMMENT_HEADING = re.compile(
    r"(?:\d+\s+)?(?:reader\s+)?(?:comments?|kommentare?|commentaires?|comentarios?|"
    r"leave a (?:reply|comment))\s*(?:\(\d+\))?:?", re.I)
COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b)", re.I)

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    rf"|<({RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    rf"|([^<]+|<)", re.S | re.I)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
NAME_BREAK = re.compile(r"[^a-z0-9]+")
SPACE = re.compile(r"\s+")


@dataclass
class Line:
    text: str
    weight: int
    article: int  # the marked article it lies in, 0 for none, -1 in a left-out part
    heading: bool


def names_article(attributes: str) -> bool:
    """Whether a part's class or id says that it holds the article."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    if found.get("role", "").lower() in ("main", "article") or \
            found.get("itemprop", "").lower() == "articlebody":
        return True
    words = NAME_BREAK.split(CAMEL.sub("-", f"{found.get('class', '')} {found.get('id', '')}").lower())
    return not ARTICLE_NAMES.isdisjoint(words)


def left_out(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element of this tag and these attributes can't hold the article."""
    if tag in LEFT_OUT or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    if found.get("role", "").lower() in ROLES or found.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in found.get("style", "").replace(" ", "").lower() or \
            re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", ATTRIBUTE.sub(" ", attributes)):
        return True
    for name in (found.get("class", "") + " " + found.get("id", "")).split():
        words = [w for w in NAME_BREAK.split(CAMEL.sub("-", name).lower()) if w]
        named = {w for k, w in enumerate(words) if not k or words[k - 1] not in TURNED}
        if named & PART_WORDS and not (tag in ARTICLES and named & GOOD_WORDS):
            return True
        if named & WEAK_WORDS and not named & GOOD_WORDS and not in_article:
            return True
    return False


def lines_of(html: str) -> list[Line]:
    """The page's lines of text in page order; lines of left-out parts weigh nothing."""
    stack: list[tuple[str, bool, int]] = []  # tag, left out, article
    out: list[Line] = []
    text: list[str] = []
    linked, articles = 0, 0

    def flush() -> None:
        nonlocal linked
        line = SPACE.sub(" ", unescape("".join(text))).strip()
        if line:
            gone, article = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
            solid = len(line) - line.count(" ")
            weight = 0 if gone or COPYRIGHT.match(line) else max(0, solid - linked)
            out.append(Line(line, weight, -1 if gone else article,
                            bool(stack) and stack[-1][0] in HEADINGS))
        text.clear()
        linked = 0

    links = 0
    for raw, closing, name, attributes, words in TOKEN.findall(html):
        if words:
            text.append(words)
            if links:
                linked += len(SPACE.sub("", words))
            continue
        if raw or not name:
            continue
        tag = name.lower()
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        if tag in BLOCKS:
            flush()
            links = 0
            while stack and stack[-1][0] == "p" and tag != "p" and not closing:
                stack.pop()  # a block ends an open paragraph
        if closing:
            if any(open_tag == tag for open_tag, _, _ in stack):
                flush()
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        if stack and stack[-1][0] == tag and tag in ("p", "li", "dt", "dd", "option", "tr", "td"):
            stack.pop()
        gone, article = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        if not gone and left_out(tag, attributes, bool(article)):
            flush()
            gone = True
        if not gone and not article and (tag in ARTICLES or attributes and tag in (
                "div", "section", "td") and names_article(attributes)):
            articles += 1
            article = articles
        if tag in BLOCKS or gone or tag == "button":
            stack.append((tag, gone, article))
    flush()
    return out


def segments(weights: np.ndarray, surge: float) -> list[tuple[int, int]]:
    """Line ranges between the points where window sums surge and where they dive."""
    if not len(weights):
        return []
    sums = np.convolve(weights, np.ones(WINDOW, np.int64))[WINDOW - 1:]  # of i .. i + WINDOW-1
    found, begun = [], None
    for i in range(len(weights)):
        if begun is None and sums[i] >= surge and weights[i] > 0:
            begun = i
        elif begun is not None and sums[i] == 0:
            found.append((begun, i))
            begun = None
    if begun is not None:
        found.append((begun, len(weights)))
    return found


def article_peaks(lines: list[Line], ended: dict[int, int]) -> dict[int, int]:
    """The largest window sum within each marked article."""
    own: dict[int, list[int]] = {}
    for i, x in enumerate(lines):
        if x.article > 0 and i < ended.get(x.article, len(lines)):
            own.setdefault(x.article, []).append(x.weight)
    return {k: max(sum(w[i:i + WINDOW]) for i in range(len(w))) for k, w in own.items()}


def main_text(html: str) -> str:
    """The main text of one page."""
    lines = lines_of(html)
    weights = np.array([x.weight for x in lines], np.int64)
    # A heading of reader comments ends its article, one beside the articles all after it.
    ended = {x.article: i for i, x in reversed([*enumerate(lines)])
             if x.heading and COMMENT_HEADING.fullmatch(x.text)}
    peaks = article_peaks(lines, ended)
    if any(peaks.values()):
        most = max(peaks.values())
        kept = [peaks.get(x.article, 0) >= max(1, SURGE * most) and i < ended.get(x.article, len(lines))
                for i, x in enumerate(lines)]
        first = kept.index(True)
        kept = [k and not first < ended.get(0, -1) < i for i, k in enumerate(kept)]
        parts = segments(np.where(kept, np.maximum(weights, 1), 0), 1)
    else:
        kept = [x.weight > 0 for x in lines]
        for i, x in enumerate(lines):
            if COMMENT_HEADING.fullmatch(x.text) and any(kept[:i]):
                weights[i:] = 0
                kept[i:] = [False] * (len(lines) - i)
                break
        top = max((weights[i:i + WINDOW].sum() for i in range(len(weights))), default=0)
        parts = segments(weights, max(1, SURGE * top))
        heavy = max((weights[a:b].sum() for a, b in parts), default=0)
        parts = [(a, b) for a, b in parts if weights[a:b].sum() >= SEGMENT * heavy]
    return "\n".join(lines[i].text for a, b in parts for i in range(a, b) if kept[i])


REPORT = StructType([StructField("text", StringType()), StructField("n_chars", LongType())])


def extract(pages: DataFrame, *, html: str = "html", out: str = "main") -> DataFrame:
    """``pages`` with a struct ``out``: text and n_chars (code points).

    An input column named like ``out`` is replaced; the others pass through.
    """
    def texts(piece: pa.RecordBatch) -> pa.Array:
        found = [main_text(h) for h in pc.fill_null(piece.column(html), "").to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
            ["text", "n_chars"])

    return B.annotate(pages, out, REPORT, html, texts)


def op7(pages: DataFrame) -> DataFrame:
    """The contract's columns of ``extract`` over pages."""
    return extract(pages.select("page_id", "url", "html")).select(
        "page_id", "url", F.col("main.text").alias("text"), F.col("main.n_chars").alias("n_chars"))
