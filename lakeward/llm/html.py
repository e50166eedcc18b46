"""The main text of web pages, by two passes over their blocks.

The first pass judges each block alone, by its share of stop words, its length and its share of
link text, and by what its elements say of themselves. The second takes long blocks for text where
the stop words say nothing, and lets the others that are open follow their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A block of at least so many words with this share of stop words is text; one of more than
# LINK_SHARE link text is not; short blocks are open.
LONG_WORDS, STOP_SHARE, LINK_SHARE = 10, 0.2, 0.5

# Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    a about all also an and are as at be been but by can for from had has have he her his i if in into is it its more
    no not of on one or our she so that the their there they this to was we were what when which who will with would you
    als am auch auf aus bei bin bis das dass dem den der des die durch ein eine einen einer er es für hat ich ihr im ist
    kann mit nach nicht nur oder sein sich sie sind so über um und uns von vor war was wie wir zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus
    pour qu que qui sa se ses son sont sur un une vous y
    al como con cuando de del donde el ella en entre era es esta este ha hay la las lo los más me mi muy no o para pero
    por que se ser si sin sobre son su sus también un una y ya
    """.split()
)
# Elements that begin and end blocks.
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    summary table tbody td tfoot th thead tr ul
    """.split()
)
# Elements without end tags.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no text, those that hold raw text, and those beside the text.
SILENT = frozenset("head script style template noscript noframes svg math canvas object applet iframe audio video select datalist textarea button title".split())
RAW = frozenset("script style textarea title iframe noframes xmp".split())
BESIDE = frozenset("nav footer aside menu dialog search".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form note".split())
# Words in the class or id of elements beside the text.
BESIDE_NAMES = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments
    commentlist consent cookie cookies copyright disclaimer discussion discussions disqus footer form gdpr header login masthead menu menus
    modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion promoted
    recommended related replies reply responses search share sharing sidebar signup skip social sponsor sponsored
    subscribe subscription tags toolbar topbar widget widgets
    """.split()
)
# Of these, the words that also name the layout or the subject of an element that holds the text, as in `social-history`.
LAYOUT_NAMES = frozenset("banner byline form header notice notices related search share sidebar social sponsor sponsored tags widget widgets".split())
BESIDE_ARTICLES = frozenset("ad ads advert comment comments promo related reply replies sponsored teaser".split())
ROOTS = frozenset(["article", "main"])
# An element of these closes an open one of the second kind.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)|<(?P<odd>[A-Za-z])",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Characters of scripts that set no space between words (Thai to Khmer, Han, kana); two count as a word.
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# What follows these in a class or id is something that the element has or lacks, not what it is.
_STATE = re.compile(r"(?:^|(?<=[\s_-]))(?:has|have|with|without|no)[_-]\S*", re.IGNORECASE)
_COOKIE = re.compile(r"\bcookies?\b", re.IGNORECASE)
# Beginnings of words by which a notice asks for consent, in English, German, French and Spanish.
_CONSENT = re.compile(r"\b(?:accept|agree|consent|privacy|akzept|zustimm|einverstanden|datenschutz|accord|confidentialité|acept|consiento|consent|privacidad)", re.IGNORECASE)


@dataclass
class Block:
    """Text between two block edges, with what is known of the place where it stands.

    `named` is the innermost element around it whose name is on a list (see Name), 0 if there is none.
    """

    text: str
    linked: int
    root: int
    heading: bool
    named: int = 0

    @cached_property
    def own(self) -> int:
        """What the block is by itself."""
        return judged(self)

    @cached_property
    def words(self) -> int:
        return len(self.text.split()) + len(_UNSPACED.findall(self.text)) // 2


@dataclass
class Name:
    """An element whose class or id is on a list: the one around it, and whether it may be a wrapper of the text."""

    above: int
    layout: bool


@dataclass
class _Open:
    tag: str
    beside: bool
    silent: bool
    root: int
    named: int = 0


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(source):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        found.setdefault(m[1].lower(), html.unescape(value))
    return found


def _stands_beside(tag: str, attributes: dict[str, str], in_root: bool) -> bool:
    """Whether an element says itself that it is not part of the text."""
    if tag in ("html", "body"):
        return False
    if tag in ROOTS:
        return not {p.lower() for p in _NAME_PARTS.findall(attributes.get("class", ""))}.isdisjoint(BESIDE_ARTICLES)
    if tag in BESIDE or (tag == "header" and not in_root):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.IGNORECASE):
        return True
    if attributes.get("role", "").lower() in BESIDE_ROLES:
        return True
    return False


def _named(tag: str, attributes: dict[str, str], in_root: bool) -> bool | None:
    """Whether the name of an element is on the lists: True if only by a word that may also name a wrapper of the text, None if not."""
    if tag in ("html", "body") or tag in ROOTS:
        return None
    names = _STATE.sub("", f"{attributes.get('class', '')} {attributes.get('id', '')}")
    parts = {p.lower() for p in _NAME_PARTS.findall(names)}
    if in_root and tag in ("header", "h1", "h2", "h3", "h4", "h5", "h6", "div", "section"):
        parts -= {"header", "banner", "masthead"}
    found = parts & BESIDE_NAMES
    if not found:
        return True if tag == "form" else None
    # A name of one word says what the element is; of a longer one only the words that name nothing else are trusted.
    return found <= LAYOUT_NAMES and not any(n.lower() in BESIDE_NAMES for n in names.split())


def blocks(source: str) -> tuple[list[Block], list[Name]]:
    """The blocks of a page in its order, with character references decoded and white space as one space, and the named elements around them.

    Elements whose kind, role or style says that they stand beside the text give none. Names count from 1.
    """
    out: list[Block] = []
    names: list[Name] = [Name(0, False)]
    stack: list[_Open] = []
    # Where the open elements of each tag, and those that make blocks, stand: an end tag without a start costs nothing.
    places: dict[str, list[int]] = {}
    block_places: list[int] = []
    parts: list[str] = []
    linked: list[str] = []
    links = breaks = roots = 0
    heading = False

    def add(raw: str) -> None:
        nonlocal breaks
        if stack and (stack[-1].silent or stack[-1].beside):
            return
        text = html.unescape(raw) if "&" in raw else raw
        if breaks and text.strip():
            breaks = 0
        parts.append(text)
        if links:
            linked.append(text)

    def close_block() -> None:
        nonlocal heading, breaks
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                here = stack[-1] if stack else _Open("", False, False, 0)
                out.append(Block(text, len(" ".join("".join(linked).split())), here.root, heading, here.named))
            parts.clear()
            linked.clear()
        heading, breaks = False, 0

    def leave(at: int) -> None:
        nonlocal links
        for gone in stack[at:]:
            links -= gone.tag == "a"
            places[gone.tag].pop()
        del stack[at:]
        while block_places and block_places[-1] >= at:
            block_places.pop()

    def enter(element: _Open) -> None:
        places.setdefault(element.tag, []).append(len(stack))
        if element.tag in BLOCKS:
            block_places.append(len(stack))
        stack.append(element)

    at = 0
    while at < len(source):
        m = _TOKEN.search(source, at)
        add(source[at : m.start() if m else len(source)])
        if not m:
            break
        at = m.end()
        if m["cdata"] is not None:
            add(m["cdata"].replace("&", "&amp;"))
        if m["odd"]:
            # A tag whose quotes never close: what is left of it is markup.
            cut = source.find(">", at)
            at = len(source) if cut < 0 else cut + 1
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag in BLOCKS:
                close_block()
            if places.get(tag):
                leave(places[tag][-1])
            continue
        if tag == "br":
            breaks += 1
            if breaks > 1:
                close_block()
            add(" ")
            continue
        if tag in BLOCKS:
            close_block()
        if tag in VOID:
            add(" ")
            continue
        if tag == "p" or tag in CLOSES:
            if block_places and stack[block_places[-1]].tag in CLOSES.get(tag, {"p"}):
                leave(block_places[-1])
        if tag in ROOTS:
            # An article begins afresh, whatever was left open before it but an element beside the text.
            if not (stack and stack[-1].root) and not any(places.get(t) for t in BESIDE):
                keep = [s for s in stack if s.tag in ("html", "body")]
                leave(0)
                for s in keep:
                    enter(s)
                roots += 1
        above = stack[-1] if stack else _Open("", False, False, 0)
        root = above.root or (roots if tag in ROOTS else 0)
        attributes = _attributes(m["attributes"]) if m["attributes"].strip() else {}
        beside = above.beside or _stands_beside(tag, attributes, bool(above.root))
        named, layout = above.named, None if beside else _named(tag, attributes, bool(above.root))
        if layout is not None:
            named = len(names)
            names.append(Name(above.named, layout))
        enter(_Open(tag, beside, above.silent or tag in SILENT, root, named))
        links += tag == "a"
        heading = heading or (len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            leave(len(stack) - 1)
            at = end.end() if end else len(source)
    close_block()
    return out, names


GOOD, BAD, OPEN = 1, -1, 0


def judged(block: Block) -> int:
    """What a block is by itself."""
    if block.linked > LINK_SHARE * len(block.text):
        return BAD
    words = [w.strip(".,;:!?\"'()*%&$#").lower() for w in block.text.split()]
    stops = sum(w in STOP_WORDS for w in words)
    if len(words) >= LONG_WORDS and stops >= STOP_SHARE * len(words):
        return GOOD
    return OPEN


def verdicts(pool: list[Block]) -> list[int]:
    """What blocks are by themselves, long ones of little link text also without stop words.

    These are text in an article or main element, and on a page where they hold more words than the blocks
    that the stop words make text: then no list of stop words fits the page. Else they stay open.
    """
    own = [b.own for b in pool]
    words = [b.words if v != BAD else 0 for b, v in zip(pool, own, strict=True)]
    long_ = [v == OPEN and n >= LONG_WORDS for v, n in zip(own, words, strict=True)]
    fitting = sum(n for v, n in zip(own, words, strict=True) if v == GOOD)
    unfit = sum(n for v, n in zip(long_, words, strict=True) if v) > fitting
    return [GOOD if o and (b.root or unfit) else v for b, v, o in zip(pool, own, long_, strict=True)]


def _text_of(found: list[Block], names: list[Name]) -> list[Block]:
    """Blocks that may be text: without those in elements whose name says that they stand beside it, and without what is outside the article.

    An element that is named by its layout is a wrapper where it holds more than half of the words of the
    blocks that are text by themselves. An article or main element is the text's where it holds a third of them. A notice that asks
    for consent to cookies is left out on a page that otherwise does not speak of them.
    """
    verdict = verdicts(found)
    good = [b.words if v == GOOD else 0 for b, v in zip(found, verdict, strict=True)]
    inside = [0] * len(names)
    for block, n in zip(found, good, strict=True):
        inside[block.named] += n
    for i in range(len(names) - 1, 0, -1):
        inside[names[i].above] += inside[i]
    out = [False] * len(names)
    for i, name in enumerate(names[1:], 1):
        out[i] = out[name.above] or not (name.layout and 2 * inside[i] > inside[0])
    cookies = [bool(_COOKIE.search(b.text)) for b in found]
    speaks = sum(n for n, c in zip(good, cookies, strict=True) if c) * 4 >= sum(good)
    kept = [
        (b, n)
        for b, n, c in zip(found, good, cookies, strict=True)
        if not out[b.named] and not (c and not speaks and _CONSENT.search(b.text))
    ]
    rooted = [b for b, _ in kept if b.root]
    if rooted and 3 * sum(n for b, n in kept if b.root) >= sum(n for _, n in kept):
        return rooted
    # A short article beside the text is a teaser.
    return [b for b, n in kept if n or not b.root]


def chosen(found: list[Block], names: list[Name]) -> list[Block]:
    """The blocks of the main text.

    Of the blocks that may be text (`_text_of`), open ones (see verdicts) follow their nearest decided
    neighbours: between two of one kind they are of that kind too, between text and
    something else a heading goes with what follows it, any other block with the nearer side,
    text first. They stay where nothing is decided.
    """
    pool = _text_of(found, names)
    verdict = verdicts(pool)
    decided = [i for i, v in enumerate(verdict) if v != OPEN]
    keep, at = [], 0
    for i, block in enumerate(pool):
        own = verdict[i]
        if own == OPEN:
            left = decided[at - 1] if at else None
            right = decided[at] if at < len(decided) else None
            if left is None or right is None:
                sides = [verdict[j] for j in (left, right) if j is not None]
                own = sides[0] if sides else GOOD
            elif block.heading:
                own = verdict[right]
            elif i - left == right - i:
                own = max(verdict[left], verdict[right])
            else:
                own = verdict[left if i - left < right - i else right]
        else:
            at += 1
        if own == GOOD:
            keep.append(block)
    return keep


def main_text(source: str | None) -> str:
    """The main text of a page, one line a block; empty without any."""
    return "\n".join(b.text for b in chosen(*blocks(source or "")))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages` (page_id, url, html).

    Null, empty and textless pages have an empty text. Other columns are not read; repeated rows stay. No rows: an empty result.
    """
    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html")
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
