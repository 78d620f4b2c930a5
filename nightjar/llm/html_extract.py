"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags and line breaks. Marks veto:
blocks inside navigation, headers, footers, sidebars, forms, scripts, styles,
comments, adverts and notices (elements, roles, and class or id tokens) go.
A page with a main part (article or main) is read inside that part. The two
passes decide the other blocks, there too:

1. Stop-word density, length and link density class each block by itself as
   good, bad, near-good or short. Outside a main part a block with many links
   is bad; inside one it is short, and only a menu (at least ``MENU`` short
   blocks in a row that are links throughout) is bad.
2. Short and near-good blocks take after their nearest decided neighbours on
   both sides. Inside a main part a near-good block stays, and a short one goes
   only between bad neighbours on both sides.

Where pass one finds no good block, the words are of a language unknown here:
then length alone decides in place of stop words, and where no block is long
either, all short ones stay. A main part never loses all of its unmarked
blocks. ``decisions`` says which rule settled each block.

Defined cases: null or empty html gives the empty text; broken nesting is
closed at the next block that cannot be inside; a quote that is never closed
ends with its tag; text outside any element counts; repeated rows are
extracted alike; other columns are ignored. Work grows with the length of a
page, whatever its nesting.
"""

from __future__ import annotations

import html as html_module
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HTML element names by what they do to text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p "
    "pre section summary table tbody td tfoot th thead title tr ul".split())
DROPPED = frozenset("script style noscript template svg iframe canvas head title select textarea button".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARK, ELEMENT = 1, 2                 # what bars a block
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = BLOCK_TAGS - frozenset(["br", "body", "html", "head", "td", "th", "li", "dd", "dt"])
#: Words that mark boilerplate in a class, id or role token, and
#: words that may stand beside them in one. A token marks only if it has a word
#: of the first kind and all others are of the second.
MARKS = re.compile(
    r"ad|ads|adv|advert\w*|banners?|sponsor\w*|promo\w*|cookies?|consent|notice|newsletter|subscribe|popup|modal|"
    r"overlay|nav\w*|menu|breadcrumbs?|sidebar|side|widgets?|footer|foot|header|masthead|comments?|disqus|replies|reply|"
    r"respond|share|sharing|social|related|recommend\w*|pagination|pager|login|signup|search|copyright|disclaimer|"
    r"toolbar|skip|contentinfo|complementary|alert|gdpr")
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
BESIDE = re.compile(
    r"\d\w*|site|page|main|top|bottom|left|right|middle|upper|lower|primary|secondary|global|local|mobile|desktop|"
    r"box|bar|block|blocks|list|item|items|container|wrapper|wrap|section|area|panel|inner|outer|row|col|column|body|"
    r"text|message|content|form|field|input|button|buttons|btn|link|links|icon|icons|slot|unit|space|label|title|"
    r"heading|meta|author|post|posts|article|articles|story|stories|user|users|reader|readers|thread|google|dfp|gpt|"
    r"leaderboard|inline|sticky|fixed|media|tools|up|in|js|wp")
#: Frequent function words of the languages read here.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on be with as at this by are from or an not have but which you all they "
    "de la le les des et en un une que qui dans du est pour pas par sur il elle au ce avec son plus "
    "der die das und ist von zu den mit sich ein eine auf nicht im dem für es auch als an aus er wie "
    "el los las y del por con no su para una al lo como más o pero sus se".split())

MAX_LINK_DENSITY = 0.2
LENGTH_LOW, LENGTH_HIGH = 70, 200
STOP_LOW, STOP_HIGH = 0.30, 0.32
MENU, MENU_DENSITY = 3, 0.9

# A quoted value ends before white space, a slash or the tag's end; if none
# does, the quote was never closed and the tag ends at its first ">".
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"(?=[\s/>]|\Z)|'[^']*'(?=[\s/>]|\Z))*+(?=>|\Z)|[^>]*)"
                    r"(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RAW_END = {t: re.compile(rf"</{t}\b", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe",
                                                       "template", "svg", "canvas", "select")}
GOOD, BAD, NEAR, SHORT = "good", "bad", "near", "short"


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    barred: int = 0
    main: bool = False
    heading: bool = False
    text: str = ""


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    # Open elements as (tag, what bars a block there, in main, in heading).
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
    open_tags: Counter[str] = Counter()
    in_link = 0
    current = Block()

    def close() -> None:
        nonlocal current
        if current.parts:
            text = "".join(current.parts)
            text = " ".join((html_module.unescape(text) if "&" in text else text).split())
            if text:
                current.text = text
                out.append(current)
            current = Block()
        _, current.barred, current.main, current.heading = stack[-1]

    def push(tag: str, bars: int, opens_main: bool) -> None:
        _, barred, main, heading = stack[-1]
        if opens_main and not main and barred != ELEMENT:
            barred = 0      # class words around a main part (a page with a sidebar) don't count against it
        stack.append((tag, max(barred, bars), main or opens_main, heading or tag in HEADINGS))
        open_tags[tag] += 1

    def pop(tag: str) -> None:
        while open_tags[tag]:
            top = stack.pop()[0]
            open_tags[top] -= 1
            if top == tag:
                break

    def add(text: str) -> None:
        if text:
            current.parts.append(text)
            if in_link:
                current.linked += len(" ".join(text.split()))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        slash, tag, attributes = m.groups()
        if tag is None:
            continue
        tag, closing = tag.lower(), slash == "/"
        if tag in DROPPED and not closing:
            if tag in BLOCK_TAGS or tag in ("iframe", "noscript"):
                close()
            if tag in _RAW_END and not attributes.rstrip().endswith("/"):
                e = _RAW_END[tag].search(page, at)
                at = page.find(">", e.end()) + 1 if e and page.find(">", e.end()) >= 0 else end
                continue
        if tag == "a":
            in_link = 0 if closing else 1
            continue
        if tag not in BLOCK_TAGS and tag not in DROPPED:
            bars = 0 if closing else _bars(tag, attributes, stack[-1][2])
            if bars:
                close()
                push(tag, bars, False)
                close()
            elif closing and open_tags[tag]:
                pop(tag)
                close()
            continue
        in_link = 0
        if closing:
            pop(tag)
            close()
            continue
        if tag in CLOSES_P:
            pop("p")
        if tag in ("li", "dd", "dt", "td", "th", "tr", "option") and stack[-1][0] == tag:
            pop(tag)
        if tag not in VOID and not attributes.endswith("/"):
            push(tag, _bars(tag, attributes, stack[-1][2]), tag in ("article", "main"))
        close()
    close()
    return out


def _bars(tag: str, attributes: str, in_main: bool) -> int:
    if tag in DROPPED or tag in BOILERPLATE and not (tag == "header" and in_main):
        return ELEMENT
    if not attributes or tag in ("html", "body", "main"):
        return 0
    bars = 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for token in (a or b or c).split():
                found = _marks(token, in_main)
                if not COMMENTS.isdisjoint(found):
                    return ELEMENT              # a comment may be an article of its own
                if found and tag != "article":
                    bars = MARK
    return bars


def _marks(token: str, in_main: bool) -> list[str]:
    """Words of a token that mark boilerplate."""
    words = [w for w in re.split(r"[_-]+", _HUMP.sub("-", token).lower()) if w]
    found = [w for w in words if MARKS.fullmatch(w) and not (in_main and w == "header")]
    return found if all(MARKS.fullmatch(w) or BESIDE.fullmatch(w) for w in words) else []


def _stop_density(text: str) -> float:
    words = [w.strip(".,;:!?\"'()") for w in text.lower().split(" ")]
    return sum(map(STOP_WORDS.__contains__, words)) / len(words)


def first_pass(found: list[Block]) -> list[tuple[str, str]]:
    """(class, rule) of each block by itself."""
    menu = _menus(found)
    out = []
    for i, b in enumerate(found):
        n = len(b.text)
        if b.barred:
            out.append((BAD, "mark"))
        elif i in menu:
            out.append((BAD, "link density"))
        elif b.linked / n > MAX_LINK_DENSITY:
            out.append((SHORT, "") if b.main else (BAD, "link density"))
        elif n < LENGTH_LOW:
            out.append((SHORT, "") if b.main or not b.linked else (BAD, "link density"))
        else:
            stop = _stop_density(b.text)
            if stop >= STOP_HIGH and n > LENGTH_HIGH:
                out.append((GOOD, "stop words"))
            elif stop >= STOP_LOW or b.main:
                out.append((NEAR, ""))
            else:
                out.append((BAD, "stop words") if stop < STOP_LOW / 6 else (SHORT, ""))
    if all(kind != GOOD for kind, _ in out):
        out = _by_length(found, out)
    return out


def _menus(found: list[Block]) -> set[int]:
    """Blocks of a main part that lie in a menu."""
    out: set[int] = set()
    run: list[int] = []
    for i, b in enumerate(found):
        n = len(b.text)
        if b.main and not b.barred and n < LENGTH_LOW and b.linked >= MENU_DENSITY * n:
            run.append(i)
            continue
        out.update(run if len(run) >= MENU else ())
        run = []
    out.update(run if len(run) >= MENU else ())
    return out


def _by_length(found: list[Block], kinds: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Classes where no block has stop words enough: length in their place."""
    texts = [not b.barred and b.linked / len(b.text) <= MAX_LINK_DENSITY for b in found]
    if any(t and len(b.text) >= LENGTH_LOW for b, t in zip(found, texts)):
        return [(GOOD if len(b.text) > LENGTH_HIGH else NEAR, "length") if t and len(b.text) >= LENGTH_LOW else k
                for b, t, k in zip(found, texts, kinds)]
    return [(GOOD, "length") if t and kind == SHORT else (kind, rule) for t, (kind, rule) in zip(texts, kinds)]


def second_pass(kinds: list[str], found: list[Block], has_main: bool) -> list[tuple[bool, str]]:
    """(stays, rule) of each block. Undecided ones take after the nearest
    decided neighbours; in a page with a main part marked blocks are no
    neighbours, so that part is judged by itself."""
    decided = [k if k in (GOOD, BAD) and not (has_main and b.barred) else "" for k, b in zip(kinds, found)]
    n = len(kinds)
    before: list[tuple[str, int]] = [("", 0)] * n
    after: list[tuple[str, int]] = [("", 0)] * n
    for order, into in ((range(n), before), (range(n - 1, -1, -1), after)):
        last, where = "", 0
        for i in order:
            into[i] = (last, abs(i - where))
            if decided[i]:
                last, where = decided[i], i
    out = []
    for i, kind in enumerate(kinds):
        (a, da), (b, db) = before[i], after[i]
        if kind in (GOOD, BAD):
            out.append((kind == GOOD, "first pass"))
        elif not a and not b:
            out.append((has_main or kind == NEAR, "no neighbour"))
        elif has_main:
            out.append((kind == NEAR, "length") if a == b == BAD else (True, "neighbours"))
        elif a == b or not a or not b:
            out.append(((a or b) == GOOD, "neighbours"))
        elif kind == NEAR or found[i].heading and b == GOOD:
            out.append((True, "neighbours"))
        else:
            out.append(((a if da <= db else b) == GOOD, "neighbours"))
    return out


def decisions(page: str | None) -> list[tuple[str, bool, str]]:
    """(text, stays, rule that settled it) of every block of a page."""
    found = blocks_of(page or "")
    has_main = any(b.main and not b.barred for b in found)
    if has_main:
        for b in found:
            b.barred = b.barred or not b.main
    first = first_pass(found)
    second = second_pass([kind for kind, _ in first], found, has_main)
    out = [(b.text, keep, one if kind in (GOOD, BAD) else two)
           for b, (kind, one), (keep, two) in zip(found, first, second)]
    if has_main and not any(keep for _, keep, _ in out):
        return [(text, not b.barred, rule if b.barred else "only text") for b, (text, _, rule) in zip(found, out)]
    return out


def main_text(page: str | None) -> str:
    """Blocks that stay, joined by one line feed."""
    return "\n".join(text for text, keep, _ in decisions(page) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points of the text)."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [main_text(h.as_py()) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    cols = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
            F.col("html").cast("string").alias("html")]
    return pages.select(*cols).mapInArrow(run, "page_id long, url string, text string, n_chars long")
