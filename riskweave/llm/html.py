"""Main-text extraction by two-pass block rules.

Pass 1 labels each block of a page from its stop-word density, length and link
density as good, bad, or undecided (short or middling). Pass 2 lets short
blocks inherit the label of the nearest decided neighbour. Blocks inside
elements whose role is known from the markup (nav, footer, aside, form,
comments, ads and the like) are left out from the start and decide nothing.

An article or main element narrows the page to itself, unless twice as much running
text stands outside. Inside it, a class or id with a single word that articles use too
(WEAK_NAME: legal, form, comment ...) is a doubt: its blocks stay if they are running
text. Where a page has almost none of the listed stop words, as in another language,
length and link density decide alone.

Defined results: null or empty html gives an empty text; unclosed tags, comments
and scripts run to the end of the page; blocks are joined in page order and
repeated blocks stay. Very long pages are read whole, in time linear in their length.
Extra columns are not read.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, pick, slices

# Frequent function words of the four languages of the corpus.
STOP_WORDS = frozenset("""
a about all also an and are as at be been but by can for from had has have he her his i if in into is it its more
my no not of on one or our out she so that the their them there they this to was we were what when which who will
with would you your
aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat
ich ihr im in ist ja kann man mehr mit nach nicht noch nur oder ohne sein sich sie sind so und uns unter vom von vor
war wenn werden wie wir wird zu zum zur über
au aux avec ce ces cette comme dans de des du elle en est et eu il ils je la le les leur lui mais ne nous on ou où
par pas plus pour qu que qui sa se ses son sont sur un une vous à été être
al algo como con de del el ella en entre era es esta este está fue ha hay la las le lo los me mi muy más no nos
o para pero por que se si sin sobre son su sus también un una uno y ya
""".split())

BLOCK_TAGS = frozenset("""
address article aside blockquote body br button canvas caption center col colgroup dd details dialog div dl dt
fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html iframe label legend li
main menu nav noframes ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title
tr ul video
""".split())

# br parts a line of a paragraph, not a block
BLOCK_TAGS = BLOCK_TAGS - {"br"}

SKIP_TAGS = frozenset("script style noscript template svg math iframe object embed canvas head title select textarea "
                      "option button audio video map".split())
RAW_TAGS = frozenset("script style textarea title iframe noframes xmp".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog header".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that close an open element of their own kind, as browsers do.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())

# Parts of class and id names that mark page furniture.
FURNITURE_NAME = frozenset("""
ad ads advert adverts advertisement adbox banner sponsor sponsored promo promotion nav navbar navigation menu menubar
breadcrumb breadcrumbs footer foot masthead header topbar sidebar aside rail widget widgets related recommended
recommendations share sharing social cookie cookies consent gdpr notice notices alert popup modal overlay subscribe
subscription newsletter signup login search pagination pager toolbar toc comment comments commentlist disqus reply
replies respond discussion copyright legal disclaimer skip tags meta byline paywall teaser outbrain taboola form
""".split())
WEAK_NAME = frozenset("legal form comment discussion copyright promotion meta tags search rail skip foot social alert "
                      "reply respond related head".split())
LAYOUT_NAME = frozenset("with has no without is".split())
MAIN_NAME = frozenset("article post entry story main content".split())
FURNITURE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu "
                           "menubar toolbar".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTR = re.compile(r"""([A-Za-z_:][\w:.-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[^\W\d_]+")

STOP_HIGH, STOP_LOW = 0.25, 0.12
OUTSIDE = 2
LINK_MAX = 0.4
LENGTH_LOW, LENGTH_HIGH = 70, 120
RIGHTS = re.compile(r"©|\(c\)\s|copyright|all rights reserved|alle rechte|tous droits|todos los derechos", re.I)


class _Block:
    __slots__ = ("parts", "linked", "furniture", "main", "heading", "doubt")

    def __init__(self, furniture: bool, main: bool, heading: bool, doubt: bool):
        self.parts, self.linked, self.furniture, self.main, self.heading, self.doubt = [], 0, furniture, main, heading, doubt


def _furniture(tag: str, attrs: str, in_main: bool) -> bool | None:
    """Whether an element is furniture; None is a doubt."""
    if tag in FURNITURE_TAGS:
        # the header of an article holds its title
        return not (tag == "header" and in_main)
    if "=" not in attrs and "hidden" not in attrs:
        return False
    got = {k.lower(): (v or "").strip("\"'") for k, v in ATTR.findall(attrs)}
    if "hidden" in got or got.get("aria-hidden", "").lower() == "true" or got.get("role", "").lower() in FURNITURE_ROLE:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", got.get("style", ""), re.I):
        return True
    if tag in ("body", "html", "main", "article"):
        return False
    said = [_furniture_name(x, in_main) for x in f"{got.get('id', '')} {got.get('class', '')}".split()]
    return True if True in said else None if None in said else False


def _furniture_name(name: str, in_main: bool = False) -> bool | None:
    """Whether a class or id, such as site-footer or adBox, says furniture by its first or last part; None for a
    name that does so by one weak word, in an article."""
    parts = [x.rstrip("0123456789") for x in re.split(r"[-_]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())]
    if parts[0] in LAYOUT_NAME or parts[0] in MAIN_NAME and parts[-1] == "header":
        return False
    said = {i: parts[i] for i in (0, len(parts) - 1) if parts[i] in FURNITURE_NAME}
    if in_main and len(said) == 1 and set(said.values()) <= WEAK_NAME:
        return None
    return bool(said)


def blocks(page: str) -> list[tuple[str, int, bool, bool, bool, bool]]:
    """(text, linked characters, furniture, inside the article, heading, doubt) of each block with text, in page order."""
    out: list[_Block] = []
    stack: list[tuple[str, bool, bool, bool, bool]] = []  # tag, furniture, skipped, main, doubt
    links, at, block = 0, 0, None
    furniture = skipped = main = doubt = False
    heading = False
    n = len(page)

    def text(piece: str) -> None:
        nonlocal block
        if skipped or not piece:
            return
        if block is None:
            block = _Block(furniture, main, heading, doubt)
            out.append(block)
        block.parts.append(piece)
        if links:
            block.linked += len(_html.unescape(piece).strip())

    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if any(t[0] == tag for t in stack):
                while stack:
                    was = stack.pop()
                    if was[0] == "a":
                        links -= 1
                    if was[0] == tag:
                        break
            if tag in BLOCK_TAGS:
                block, heading = None, False
        else:
            if tag in SELF_CLOSING and stack and stack[-1][0] == tag:
                stack.pop()
            elif tag in BLOCK_TAGS and any(t[0] == "p" for t in stack[-4:]):
                # a block element ends an open paragraph and the inline elements in it
                k = max(i for i, t in enumerate(stack) if t[0] == "p")
                if not any(t[0] in BLOCK_TAGS for t in stack[k + 1:]):
                    links -= sum(t[0] == "a" for t in stack[k:])
                    del stack[k:]
            if tag in BLOCK_TAGS:
                block, heading = None, tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            furniture, skipped, main, doubt = stack[-1][1:] if stack else (False,) * 4
            if tag == "br":
                text(" ")
            if tag not in VOID_TAGS and not m[3].endswith("/"):
                if tag == "a":
                    links += 1
                said = _furniture(tag, m[3], main)
                stack.append((tag, furniture or bool(said), skipped or tag in SKIP_TAGS, main or tag in ("article", "main"),
                              doubt or said is None))
            if tag in RAW_TAGS and not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else n
                stack.pop()
        furniture, skipped, main, doubt = stack[-1][1:] if stack else (False,) * 4
    done = []
    for b in out:
        s = " ".join(_html.unescape("".join(b.parts)).split())
        if s:
            done.append((s, b.linked, b.furniture, b.main, b.heading, b.doubt))
    return done


def classify(found: list[tuple[str, int, bool, bool, bool]], stop_words: frozenset = STOP_WORDS) -> list[bool]:
    """True for each block (as ``blocks`` gives them, without a doubt if they have no sixth place) of the main text."""
    labels: list[str] = []
    hits, sizes = [], []
    for s, *_ in found:
        words = WORD.findall(s.lower())
        hits.append(sum(w in stop_words for w in words))
        sizes.append(len(words))
    densities = [h / n if n else 0.0 for h, n in zip(hits, sizes, strict=True)]
    running = [not b[2] and len(b[0]) >= LENGTH_LOW and b[1] <= LINK_MAX * len(b[0]) for b in found]
    # text in a language that is not listed has hardly any of the words
    told = sum(h for h, r in zip(hits, running, strict=True) if r) >= STOP_LOW * sum(n for n, r in zip(sizes, running, strict=True) if r)
    text_in = sum(len(b[0]) for b in found if b[3] and not b[2])
    text_out = sum(len(b[0]) for b, r, d in zip(found, running, densities, strict=True) if r and not b[3] and (d >= STOP_LOW or not told))
    # an element that holds little of the page's text is not the article
    has_main = text_in > 0 and text_out < OUTSIDE * text_in
    for (s, linked, furniture, main, _, *doubt), density, run in zip(found, densities, running, strict=True):
        main = main and has_main
        link = linked / len(s)
        prose = len(s) >= LENGTH_LOW and (density >= STOP_LOW or not told)
        if furniture or has_main and not main or doubt and doubt[0] and not (run and prose):
            label = "out"  # known from the markup: no evidence about the blocks beside it
        elif link > LINK_MAX and not (main and prose) or len(s) < LENGTH_LOW and not main and RIGHTS.search(s):
            label = "bad"
        elif len(s) < LENGTH_LOW:
            label = "short"
        elif (density >= STOP_HIGH or not told) and len(s) >= LENGTH_HIGH:
            label = "good"
        elif density >= STOP_LOW or main or not told:
            label = "near"
        else:
            label = "bad"
        labels.append(label)

    # pass 2: undecided blocks look at the nearest decided neighbour on either side
    n = len(labels)
    before, after = [-1] * n, [-1] * n
    for order, seen in ((range(n), before), (range(n - 1, -1, -1), after)):
        last = -1
        for i in order:
            seen[i] = last
            if labels[i] in ("good", "bad"):
                last = i
    keep = []
    for i, label in enumerate(labels):
        sides = [(abs(i - j), labels[j] != "good") for j in (before[i], after[i]) if j >= 0]
        if label in ("good", "bad", "out"):
            keep.append(label == "good")
        elif has_main and found[i][3] or label == "near" or not sides:
            keep.append(True)  # inside the article, running text, or nothing to go by
        else:
            keep.append(not min(sides)[1])  # the nearer side; a tie goes to the good one
    # a heading belongs to the kept block that it stands before
    for i in range(n - 2, -1, -1):
        if found[i][4] and labels[i] == "short" and keep[i + 1]:
            keep[i] = True
    return keep


def extract_text(page: str | None) -> str:
    """The main text of one page: kept blocks joined by two line feeds."""
    if not page:
        return ""
    found = blocks(page)
    return "\n\n".join(b[0] for b, k in zip(found, classify(found), strict=True) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [extract_text(h) for h in column(batch, "html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string()),
             pa.array(map(len, texts), pa.int64(), size=len(texts))], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (main text, empty if none), n_chars; no shuffle."""
    src = pick(pages, page_id="page_id", url="url", html="html")
    types = dict(src.dtypes)
    return src.withColumn("html", F.col("html").cast("string")).mapInArrow(
        _extract, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
