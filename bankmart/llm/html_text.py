"""The main text of web pages, by rules on their blocks in two passes.

A page is cut into blocks at block-level tags. The first pass judges each for itself, by its share of
stop words, its length and the share of its characters inside links: good, bad, or undecided (short,
or nearly good). In the second pass an undecided block takes the label of the nearest decided blocks
before and after it; where they differ, a nearly good one is good and a short one bad, unless it stands in an article. Where a page
says itself what a part of it is, by its elements or their class, id or role names, that is evidence
of the first pass: such blocks are bad, and the edge of a region counts as a decided neighbour.
The edge of an article is good, also of what is only named like one; within an ``article`` or
``main`` element links alone can make a block bad.

Nothing is shuffled: a task reads the pages of its own scan split.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from bankmart.llm.columns import numbered
from bankmart.llm.memory import tidy
from bankmart.llm.shipping import ship

ROWS = 256

# Limits of the first pass: characters of a short and of a long block, shares of stop words, share of link characters.
SHORT, LONG = 70, 200
FEW_STOPS, MANY_STOPS = 0.30, 0.32
LINKS = 0.2
# Within an article: share of link characters of a menu.
MENU = 0.5
# Characters between a heading and the good block it belongs to.
HEADING_REACH = 200

# Frequent function words of English, French, German, Spanish, Italian, Portuguese and Dutch.
STOP_WORDS = frozenset("""
a about after all also an and any are as at be because been but by can could do even first for from had has have he her
him his how i if in into is it its just like many may me more most my new no not now of on one only or other our out over
she should so some such than that the their them then there these they this those through to two up us was we were what
when where which who will with would you your
ai au aux avec ce ces cette comme d dans de des du elle en est et eux il ils je l la le les leur lui mais même ne nous on
ou par pas plus pour qu que qui sa se ses si son sont sur un une vous été être
aber als am auch auf aus bei bin bis da dann das dass dem den der des die doch durch ein eine einem einen einer er es für
hat ich ihr im ist kann man mit nach nicht noch nur oder sein sich sie sind so um und von vor war wenn wie wir wird zu zum zur
al como con cuando del desde donde el ella en entre era es esta este está fue ha hasta hay la las le lo los me mi muy más
no nos o otro para pero por porque que se ser si sin sobre son su sus también te tiene todo un una uno y ya
anche che chi ci come con da dal degli dei del della di e gli ha i il io lei lo ma mi nel nella non per più questo si sono
ao as com da das do dos e ela ele em eu foi isso mas na nas no nos não o os ou pela pelo quando sem seu sua são tem uma à
aan bij dat de dit door een en er had het hij ik in is je maar met naar niet nog of om onder ook op te tot uit van voor
was wat wel wij zich zijn zo
""".split())

# Names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul""".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NO_TEXT = frozenset("""applet audio button canvas datalist dialog iframe label legend map math meter noscript object output
progress select svg template textarea video""".split())
_BAD = frozenset("aside footer form header menu nav search".split())
_BAD_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# What an opening tag of the first name closes, should it still be open.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol menu dl table".split())

# Words in class and id names that tell menus, notices, adverts and comments from articles.
HINTS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent
cookie cookies copyright disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice
notices notification overlay pager pagination paywall popup promo promoted promotion recommendations recommended related
replies reply share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget""".split())
COMMENTS = frozenset("comment comments disqus replies reply".split())
ARTICLES = frozenset("article content entry post story main body".split())
# Such a word beside a hint makes it speak of the layout of the whole: "no-sidebar", "with-header".
_LAYOUT = frozenset("no not without with has have is open closed enabled disabled left right layout".split())

_QUOTED = r"""(?:[^'"<>]|"[^"]*"|'[^']*')*+"""
_TOKENS = re.compile(
    rf"<(?:!--(?:>|->|.*?(?:--!?>|\Z))"
    rf"|(?:(script|style|title|textarea|xmp|iframe|noembed|noframes)(?=[\s/>]){_QUOTED}>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z))"
    rf"|(/?)([a-zA-Z][^\s/<>]*)({_QUOTED})(?:>|(?=<)|\Z|['\"])"
    rf"|[!?/][^>]*(?:>|\Z))",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"']|$)", re.I)
_EMPTY = re.compile(r"(?:^|[\s\"'])/\s*$")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")
# What a part of a page is said to be: an article, likely one, bad, or bad whatever stands within.
_GOOD, _LIKELY, _WEAK, _STRONG = 2, 1, -1, -2


class Block(NamedTuple):
    text: str
    heading: bool
    listed: bool
    linked: int
    region: int


def _said(names: str, whole: bool) -> set[str]:
    """Hints and words for articles among class or id names. ``whole``: only names that are nothing but a hint."""
    found: set[str] = set()
    for name in names.split():
        parts = [p.lower() for p in _NAME_PARTS.findall(name)]
        if parts and not (len(parts) > 1 and (whole or _LAYOUT & set(parts))):
            found |= (HINTS | ARTICLES) & {parts[0], parts[-1]}
    return found


def _region(tag: str, attributes: str, outer: int, article: bool) -> int:
    """What an element says of its content: 0 for nothing, else good, likely, bad, or bad whatever stands within."""
    said = _GOOD if tag in ("article", "main") else 0
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name in ("class", "id") and tag not in ("html", "body"):
            words = _said(value, tag in ("article", "main"))
            hints = words & HINTS - ({"header"} if article or tag in _HEADINGS else set())
            if hints:
                said = _STRONG if hints & COMMENTS or said == _STRONG else _WEAK
            elif words and said == 0 and tag in _BLOCK:
                said = _LIKELY
        elif name == "role" and value.lower() in _BAD_ROLES:
            said = min(said, _WEAK) if said < 0 else _WEAK
        elif (name == "role" and value.lower() == "main") or (name == "itemprop" and value.lower() == "articlebody"):
            said = _GOOD if said >= 0 else said
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            said = _STRONG
    if said == _STRONG or outer == _STRONG:
        return _STRONG
    if tag in _BAD and said != _GOOD and not (tag == "header" and article):
        return _STRONG if tag == "aside" else _WEAK
    # Part of an article is no less, and what is only likely one within a bad part stays bad.
    return outer if said == 0 or (said == _LIKELY and outer != 0) else said


class _Page:
    """The open elements of a page, and its blocks so far."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int, bool, bool]] = []
        self.text: list[str] = []
        self.linked = self.headings = self.links = self.lists = self.silent = self.region = 0
        self.article = False

    def add(self, piece: str) -> None:
        if piece and not self.silent:
            piece = html.unescape(piece)
            self.text.append(piece)
            if self.links:
                self.linked += len("".join(piece.split()))

    def flush(self) -> None:
        joined = " ".join("".join(self.text).split())
        if joined:
            self.blocks.append(Block(joined, self.headings > 0, self.lists > 0, self.linked, self.region))
        self.text, self.linked = [], 0

    def _count(self, tag: str, quiet: bool, step: int) -> None:
        self.headings += step * (tag in _HEADINGS)
        self.links += step * (tag == "a")
        self.lists += step * (tag == "li")
        self.silent += step * quiet

    def close(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, self.region, self.article, quiet = self.open.pop()
            self._count(tag, quiet, -1)

    def start(self, tag: str, attributes: str) -> None:
        block = tag in _BLOCK
        if block:
            self.flush()
        elif tag == "br":
            self.add("\n")
        if tag in _VOID or (attributes and _EMPTY.search(attributes)):
            return
        ends = _CLOSES.get(tag, ()) if block else (tag,) if tag == "a" else None
        for depth in range(len(self.open) - 1, -1, -1) if ends is not None else ():
            name = self.open[depth][0]
            if name in ends or (block and name == "p"):
                self.close(depth)
            elif name in _SCOPES or (name in _BLOCK and tag not in _CLOSES):
                break
        region = _region(tag, attributes, self.region, self.article)
        # An inline element that is said to be bad is left out of its block.
        quiet = tag in _NO_TEXT or (not block and region < 0 <= self.region)
        self.open.append((tag, self.region, self.article, quiet))
        self._count(tag, quiet, 1)
        if block or region >= 0:
            self.region = region
        self.article = self.article or region == _GOOD

    def end(self, tag: str) -> None:
        block = tag in _BLOCK
        if block:
            self.flush()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                return self.close(depth)
            if not block and self.open[depth][0] in _BLOCK:
                return None


def blocks(source: str) -> list[Block]:
    """The blocks of a page with text, in order."""
    page, at = _Page(), 0
    for token in _TOKENS.finditer(source):
        page.add(source[at : token.start()])
        at = token.end()
        if token[3]:
            tag = token[3].lower()
            page.end(tag) if token[2] else page.start(tag, token[4])
    page.add(source[at:])
    page.flush()
    return page.blocks


def first_pass(block: Block, stops: frozenset[str]) -> str:
    """good, near, short or bad, from the block alone."""
    size = len(block.text)
    share = block.linked / max(1, size - block.text.count(" "))
    if block.region < 0:
        return "bad"
    if block.region == _GOOD:
        return "good" if share <= LINKS else "short" if share < MENU or (size < SHORT and not block.listed) else "bad"
    if share > LINKS or "©" in block.text:
        return "bad"
    if size < SHORT:
        return "bad" if block.linked else "short"
    words = _WORD.findall(block.text.lower())
    found = sum(w in stops for w in words) / max(1, len(words))
    if found >= MANY_STOPS:
        return "good" if size > LONG else "near"
    return "near" if found >= FEW_STOPS else "bad"


def labels(found: list[Block], stops: frozenset[str] = STOP_WORDS) -> list[bool]:
    """Which blocks are main text."""
    if any(b.region == _GOOD for b in found):
        # The page says where its articles are: what stands beside them is none.
        found = [b if b.region == _GOOD else b._replace(region=min(b.region, _WEAK)) for b in found]
    first = [first_pass(b, stops) for b in found]
    for i, block in enumerate(found):
        if block.heading and first[i] == "short":
            distance = 0
            for j in range(i + 1, len(found)):
                if first[j] == "good" and distance <= HEADING_REACH:
                    first[i] = "near"
                if first[j] == "good" or distance > HEADING_REACH:
                    break
                distance += len(found[j].text)
    before, after = _nearest(found, first, 1), _nearest(found, first, -1)[::-1]
    out = []
    for block, own, left, right in zip(found, first, before, after):
        if own in ("good", "bad"):
            out.append(own == "good")
        elif left == right:
            out.append(left)
        else:
            out.append(own == "near" or block.region > 0)
    return out


def _nearest(found: list[Block], first: list[str], step: int) -> list[bool]:
    """For each block, from one end, whether the decided block before it is good. The edge of an article is good."""
    out, last, region = [], False, 0
    for block, own in zip(found[::step], first[::step]):
        if block.region != region:
            last, region = block.region > 0, block.region
        out.append(last)
        if own in ("good", "bad"):
            last = own == "good"
    return out


def main_text(page: str | None, stops: frozenset[str] = STOP_WORDS) -> tuple[str, int]:
    """The blocks of main text, one to a line, and how many blocks the page has."""
    found = blocks(page or "")
    return "\n".join(b.text for b, kept in zip(found, labels(found, stops)) if kept), len(found)


@tidy
def _extract(batches: Iterable[pa.RecordBatch], at: int, stops: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            batch = whole.slice(start, ROWS)
            found = [main_text(page.as_py(), stops) for page in batch.column(at)]
            texts, counts = zip(*found)
            columns = [*batch.columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])


def extract(pages: DataFrame, *, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    r"""``pages`` plus ``text``, ``n_chars`` (its code points) and ``n_blocks`` (of the page, also those that go).

    ``text`` joins the blocks of main text by one \n, white space within a block being one space and
    character references decoded; a page without any, or with null or empty html, has the empty text.
    Unclosed and stray tags, comments and quotes are read as far as they go; no page is cut off. Rows are
    judged each for itself, so repeated or null ids matter nothing. All other columns come back as they
    are, whatever their names. No rows: no rows.
    """
    ship(pages.sparkSession)
    plain, (page,) = numbered(pages, "html")
    more = [StructField("text", StringType()), StructField("n_chars", LongType()), StructField("n_blocks", LongType())]
    out = plain.mapInArrow(
        partial(_extract, at=plain.columns.index(page), stops=frozenset(stop_words)), StructType(list(plain.schema.fields) + more)
    )
    return out.toDF(*pages.columns, "text", "n_chars", "n_blocks")
