"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  First pass: each block is good,
bad or ambiguous by length, link density, stop-word density and by what it
stands in (a menu, a footer, a form, an advert, reader comments ...: bad).
Second pass: ambiguous blocks inherit from the nearest decided neighbours; where
these differ, from the nearer one, and at equal distance the side of the text
wins inside an article, the other side outside.

Inside ``article`` or ``main`` nothing is bad for its words alone: the markup
already says that it is content.  A name (class or id) makes its element bad only if
all its words are such names or tell where something stands (``sidebar-left``, not
``has-sidebar``), and no other name of the element speaks for content.  What the name
of a wrapper, or a form around it, says of an article holds where the page has an
article that nothing speaks against (of readers' comments, where it has any such
text); where it has none, the wrapper's word is not taken, and a form around the whole
page counts for nothing.  Character references are decoded, white space
in a block becomes one space, blocks are joined by a blank line in page order.

Null, empty or text-less pages give an empty text.  A tag cut off at the end of
a page is dropped with what follows it.  An element without text of the page that
closes itself or never ends hides nothing, but for scripts and other raw text.
Repeated rows get equal results, rows without page_id too; empty tables give no
rows.  Time is linear in the page, however its tags are nested or left open.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

LENGTH_LOW, LENGTH_HIGH = 70, 200
STOP_LOW, STOP_HIGH = 0.30, 0.32
MAX_LINK_DENSITY = 0.2

# HTML's block-level elements, and elements that hold no text of the page.
BLOCK = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
RAW = ("script", "style", "noscript", "iframe", "textarea", "title")
SILENT = (*RAW, "template", "svg", "canvas", "audio", "video", "select", "button", "map", "datalist", "annotation", "annotation-xml")
#: Elements whose whole content is no main text.
BAD_TAGS = frozenset("nav footer aside form menu dialog fieldset search label input legend".split())
#: Elements whose start and end are tracked to know what a block stands in.
TRACKED = frozenset(
    "article aside blockquote body center details dialog div dl fieldset figure footer form header main menu nav ol p search section span table td tr ul li "
    "h1 h2 h3 h4 h5 h6 label legend a".split())
_BAD_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# What boilerplate is called, words that say where or how something stands, and what content is called.
_BAD_NAME = re.compile(
    r"ads?|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|pagination|pager|sidebar\w*|side|widget\w*|rail|footer|foot|"
    r"masthead|topbar|toolbar|cookies?|consent|gdpr|notices?|notification\w*|alert\w*|popup|modal|overlay|newsletter|subscrib\w*|signup|login|share\w*|sharing|social\w*|"
    r"related|recommend\w*|trending|popular|comment\w*|disqus\w*|respond|repl(?:y|ies)|discussion|reactions?|search\w*|form|skip|tags?|copyright|disclaimer|paywall|outbrain|taboola")
_PLACE_NAME = re.compile(
    r"\d\w*|js|site|page|global|main|top|bottom|left|right|header|head|primary|secondary|upper|lower|inner|outer|fixed|sticky|mobile|desktop|list|area|section|box|block|container|wrap\w*|holder|bar|"
    r"items?|links?|buttons?|btn|icons?|group|panel|col|column|row|title|unit|slots?|zone|text|label|media|user|reader|article|articles|post|posts|stor(?:y|ies)|thread|body|content|to|module|component|region|in|up|us")
_TALK_NAME = re.compile(r"comment\w*|disqus\w*|respond|repl(?:y|ies)|discussion|reactions?")
_GOOD_NAME = re.compile(r"(?:article|content|main|post|entry|story|body|text)")

# About fifty frequent function words of each language.
STOP_WORDS = frozenset(" ".join((
    # English
    "a about all also an and are as at be been but by can for from had has have he her his in is it not of on or our she so that the their there they this to was we were "
    "what when which who will with you",
    # German
    "aber als am an auch auf aus bei dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im ist mit nach nicht noch nur oder sich sie sind "
    "über um und von vor war wie wird zu zum zur",
    # French
    "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais ne nous ont ou par pas plus pour qu que qui sa se ses son sont sur un "
    "une vous",
    # Spanish
    "al como con del desde el ella ese eso esta este esto fue ha hay hasta las lo los más muy ni no o para pero por porque ser si sin sobre su sus también te tiene todo una uno y ya",
)).split())

_TOKEN = re.compile(
    r"<!--|<!\[CDATA\[|"
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|"
    r"<[a-zA-Z/!?][^>]*+(?:>|\Z)", re.S)
_CLOSE = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in SILENT} | {"<!--": re.compile("-->"), "<![CDATA[": re.compile(r"\]\]>")}
#: One attribute after the other: what stands in a value is never taken for a name.
_ATTR = re.compile(r"(?P<name>[^\s\"'<>/=]+)\s*(?:=\s*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link: int
    article: bool
    #: It stands in boilerplate by its elements, roles or what is hidden, or by a name within its article.
    boilerplate: bool
    #: Only the name of a wrapper of its article, or of an element where there is no article, says so; or a form around it.
    named: bool
    talk: bool
    formed: bool
    heading: bool
    label: str = ""


def _bad_name(names: str) -> int:
    """Whether a class or id calls its element boilerplate (1), readers' comments (2), or neither (0): one name does, and
    none calls it content."""
    bad = 0
    for name in names.split():
        words = [w for w in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", name) if w]
        wrong = [bool(_BAD_NAME.fullmatch(w.lower())) for w in words]
        if any(wrong):
            if all(x or _PLACE_NAME.fullmatch(w.lower()) for x, w in zip(wrong, words, strict=True)):
                bad = max(bad, 1 + any(_TALK_NAME.fullmatch(w.lower()) for w in words))
        elif any(_GOOD_NAME.fullmatch(w.lower()) for w in words):
            return 0
    return bad


def _says(tag: str, attrs: str, in_article: bool) -> tuple[bool, int, bool]:
    """Whether a start tag opens boilerplate, what its name says of that, and whether it opens an article."""
    bad = tag in BAD_TAGS and tag != "form" or tag == "header" and not in_article
    named, good = 0, tag in ("article", "main")
    for m in _ATTR.finditer(attrs) if attrs else ():
        value, name = m["a"] or m["b"] or m["c"] or "", m["name"].lower()
        if name in ("class", "id"):
            named = max(named, _bad_name(value))
        elif name == "role":
            bad = bad or value.strip().lower() in _BAD_ROLE
            good = good or value.strip().lower() in ("main", "article")
        elif name == "style":
            bad = bad or bool(_HIDDEN.search(value))
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            bad = True
    if tag in ("body", "html"):
        bad, named = False, 0
    return bad, named, good


class _Open:
    """Open elements, with the places of each name, so that the nearest one is found at once."""

    def __init__(self) -> None:
        #: (tag, bad, what its name says, article), and how many names were bad, and of comments, around the articles that are open.
        self.stack: list[tuple[str, bool, int, bool]] = []
        self.at: dict[str, list[int]] = defaultdict(list)
        self.bad = self.named = self.talks = self.articles = self.links = self.forms = 0
        self.outside: list[tuple[int, int]] = []

    def nearest(self, *names: str) -> int:
        return max((self.at[n][-1] for n in names if self.at[n]), default=-1)

    def push(self, tag: str, bad: bool, named: int, article: bool) -> None:
        self.at[tag].append(len(self.stack))
        self.stack.append((tag, bad, named, article))
        if article:
            self.outside.append((self.named, self.talks))
        self._count(1, *self.stack[-1])

    def cut(self, k: int) -> None:
        """Close the element at place k and all that stand in it."""
        while len(self.stack) > k:
            own = self.stack.pop()
            self.at[own[0]].pop()
            if own[3]:
                self.outside.pop()
            self._count(-1, *own)

    def _count(self, n: int, tag: str, bad: bool, named: int, article: bool) -> None:
        self.bad, self.named, self.talks = self.bad + n * bad, self.named + n * (named > 0), self.talks + n * (named > 1)
        self.articles, self.links, self.forms = self.articles + n * article, self.links + n * (tag == "a"), self.forms + n * (tag == "form")

    def by_name(self) -> tuple[bool, bool, bool]:
        """Whether a name within the innermost article is bad (or any, without an article), one around it, and one of comments around it."""
        named, talks = self.outside[-1] if self.outside else (0, 0)
        return self.named > named, named > 0, talks > 0


def blocks(page: str | None) -> list[Block]:
    """Blocks that have text, in page order."""
    page, out, at = page or "", [], 0
    inside, unclosed = _Open(), set()
    parts: list[str] = []
    link_chars, heading = 0, False

    def flush() -> None:
        nonlocal link_chars, heading
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                within, around, talk = inside.by_name()
                out.append(Block(text, min(len(text), link_chars), inside.articles > 0, inside.bad > 0 or within, around, talk, inside.forms > 0, heading))
            parts.clear()
        link_chars, heading = 0, False

    def say(s: str) -> None:
        nonlocal link_chars
        if s:
            parts.append(s)
            if inside.links:
                link_chars += len(s.strip())

    def close(name: str, start: int) -> re.Match | None:
        """Where what has no tags of its own ends; that it doesn't is looked for only once."""
        found = None if name in unclosed else _CLOSE[name].search(page, start)
        if not found:
            unclosed.add(name)
        return found

    while m := _TOKEN.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        if m[0] in _CLOSE:
            end = close(m[0], at)
            if m[0] == "<![CDATA[":
                say(page[at : end.start()] if end else "")
                at = end.end() if end else at
            else:
                at = end.end() if end else len(page)
            continue
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        shut = m["attrs"].rstrip().endswith("/")
        if tag in SILENT and not m["end"]:
            if tag in RAW or not shut:
                end = close(tag, at)
                at = end.end() if end else len(page) if tag in RAW else at
            if tag == "title":
                flush()
            elif tag != "button":
                parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag not in TRACKED:
            continue
        if m["end"]:
            k = inside.nearest(tag)
            if k >= 0 and not (tag in ("p", "li", "a", "span") and inside.nearest("div", "section", "article", "td", "table") > k):
                inside.cut(k)
            continue
        if tag in ("p", "li", "tr", "td"):  # these end where the next one starts
            k = inside.nearest(tag)
            if k > inside.nearest(*{"div", "ul", "ol", "table", "section", "article", "menu"}):
                inside.cut(k)
        if shut:
            continue
        inside.push(tag, *_says(tag, m["attrs"], inside.articles > 0))
        heading = heading or tag[0] == "h" and tag[1:].isdigit()
    say(page[at:])
    flush()
    return out


def _first_pass(b: Block) -> str:
    n = len(b.text)
    density = b.link / n
    if b.boilerplate or "©" in b.text and n < LENGTH_HIGH and not b.article:
        return "bad"
    if density > MAX_LINK_DENSITY and not b.article:
        return "bad"
    if b.heading or density > 0.9 and n < LENGTH_HIGH:  # an article's link alone: as what stands beside it
        return "ambiguous"
    if n < LENGTH_LOW:
        return "ambiguous" if b.article or not b.link else "bad"
    ws = _WORDS.findall(b.text.lower())
    stops = sum(w in STOP_WORDS for w in ws) / len(ws) if ws else 0.0
    if stops >= STOP_HIGH:
        return "good" if n > LENGTH_HIGH or b.article else "near"
    if stops >= STOP_LOW:
        return "near"
    return "near" if b.article else "poor"


def classify(found: list[Block]) -> list[Block]:
    """Label every block good or bad."""
    clean = any(b.article and not (b.boilerplate or b.named or b.formed) for b in found)
    free = any(not (b.boilerplate or b.named or b.formed) and _first_pass(b) in ("good", "near") for b in found)
    for b in found:
        # an article's wrappers are believed where another article has none of their kind, a form where there is text outside
        b.boilerplate = b.boilerplate or b.named and (clean or b.talk and free) or b.formed and (clean or free and not b.article)
        b.label = _first_pass(b)
    any_good = any(b.label == "good" for b in found)
    any_article = any(b.article for b in found)
    for b in found:  # ambiguous blocks may lean on near ones where nothing is better
        if b.label == "near":
            b.label = "good" if b.article or not any_good or not any_article else "ambiguous"
        elif b.label == "poor":
            b.label = "bad" if any_good or any_article else "ambiguous"
    first = [b.label for b in found]
    # menus, footers and the like are no neighbours: what stands beside them isn't part of them
    speaks = [s != "ambiguous" and not b.boilerplate for s, b in zip(first, found, strict=True)]
    any_speaks = any(speaks)
    before, after, last = [None] * len(found), [None] * len(found), None
    for i in range(len(found)):
        before[i] = last
        last = i if speaks[i] else last
    last = None
    for i in range(len(found) - 1, -1, -1):
        after[i] = last
        last = i if speaks[i] else last
    for i, b in enumerate(found):
        if first[i] != "ambiguous":
            continue
        if not any_speaks:
            b.label = "good" if b.article or not any_article else "bad"
            continue
        x, y = before[i], after[i]
        # neighbours on the other side of an article's border say nothing about what is inside
        x = x if x is not None and found[x].article == b.article else None
        y = y if y is not None and found[y].article == b.article else None
        if x is None and y is None:
            b.label = "good" if b.article else "bad"
        elif x is None or y is None or first[x] == first[y]:
            b.label = first[x if x is not None else y]
        elif i - x != y - i:
            b.label = first[x if i - x < y - i else y]
        else:
            b.label = "good" if b.article else "bad"
    return found


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in classify(blocks(page)) if b.label == "good")


def extracted(pages: DataFrame, page: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def make() -> Callable[[dict], dict]:
        def run(x: dict) -> dict:
            texts = [main_text(p) for p in x["html"]]
            return {"page_id": x["page_id"], "url": x["url"], "text": texts, "n_chars": [len(t) for t in texts]}
        return run

    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("html"))
    return map_rows(rows, make, "page_id long, url string, text string, n_chars long", 64)
