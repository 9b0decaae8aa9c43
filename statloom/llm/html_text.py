"""Main text of web pages: flat text blocks, classified by a decision tree."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import query, read

# Elements whose content is never text of the page.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "noframes", "xmp")
# Raw elements that may close themselves, as in <svg/>.
SELF_CLOSING = frozenset(("svg", "iframe"))
RAW_ENDS = {name: re.compile(rf"</{name}(?:[\s/][^>]*)?(?:>|\Z)", re.I) for name in RAW}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S)
# Elements inside a line of text; every other tag ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEXT_ENDS = frozenset("li td th tr dt dd option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
ASIDE = frozenset("nav aside footer form menu dialog button select fieldset head".split())
# Words in class, id or role that mark what surrounds the main text; those of the first
# group are never the name of a page's layout.
FIRM_WORDS = (r"ads?|advert\w*|sponsor\w*|promo\w*|comments?|repl(?:y|ies)|disqus|respond|related|recommend\w*|"
              r"foot(?:er)?|contentinfo")
LOOSE_WORDS = (
    r"nav\w*|menu|breadcrumbs?|side-?bar|aside|complementary|cookies?|consent|gdpr|notices?|alert|pop-?up|modal|"
    r"overlay|newsletter|subscri\w+|signup|login|share|sharing|social|widget|pagination|pager|search|toolbar|skip")
FIRM = re.compile(rf"(?:^|[_-])(?:{FIRM_WORDS})(?=$|[_-])")
MARKED = re.compile(rf"(?:^|[_-])(?:{FIRM_WORDS}|{LOOSE_WORDS})(?=$|[_-])")
# Parts by which a name tells what a page has or lacks, or how it stands.
STATES = frozenset("has no not with without is open opened free".split())
# Nouns that may follow a mark; others make a name of its own: related-posts, but related-work.
GENERIC = frozenset(
    "area articles banner bar block bottom box btn button buttons container content cta footer form group header "
    "icon icons inner item items js label left link links list main media menu message panel popup posts right "
    "row section slot stories text title toggle top unit widget wrap wrapper".split())
# Marks that inside the main element belong to its own head.
HEADER = re.compile(r"(?:^|[\s_-])(?:header|masthead|banner)(?:$|[\s_-])", re.I)
MARKS = re.compile(r"(?:\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
# Blocks in a leaf of the tree.
MIN_LEAF = 3
# How far the mark of an element goes.
NO_MARK, LOOSE, FIRM_CLASS, FIRM_TAG = range(4)


class Block(NamedTuple):
    """A run of text between block tags. place: 1 inside the main element, -1 inside what
    surrounds it (navigation, adverts, forms and the like), 0 elsewhere."""

    text: str
    words: int
    link_words: int
    place: int
    heading: int


class Element:
    """An element of a page: the index of its parent, its mark, and what it holds outside firmly marked elements."""

    __slots__ = ("parent", "name", "mark", "words", "heads", "paragraphs", "holds")

    def __init__(self, parent: int, name: str, mark: int):
        self.parent, self.name, self.mark = parent, name, mark
        self.words = self.heads = self.paragraphs = 0
        self.holds = False  # a main element, itself not counted


def class_mark(marks: str, inside: bool) -> int:
    """The mark that class, id and role give; inside the main element names must be furniture to their end."""
    found = NO_MARK
    for token in marks.lower().split():
        hits = list(MARKED.finditer(token))
        if not hits or not STATES.isdisjoint(re.split("[_-]", token)):
            continue
        rest = re.split("[_-]+", token[hits[-1].end():].strip("_-"))
        if inside and not all(x in GENERIC or x.isdigit() or not x for x in rest):
            continue
        found = max(found, FIRM_CLASS if FIRM.search(token) else LOOSE)
    return found


def places(elements: list[Element], own: list[int]) -> list[int]:
    """Where the blocks of each element stand; ``own`` holds the words of each element's own blocks.

    A mark on what holds the text of the page is a name of its layout, and not believed:
    of elements that hold <main>; of forms that hold <article>; if that leaves no words in a
    main element, of the fewest elements around an <article>; and if there are still none, of
    those with most of the page's words and a first heading or three paragraphs.
    Furniture tags and hidden elements are always believed, adverts, reader comments and
    related links unless they hold <main>.
    """
    n = len(elements)
    whole = [False] * n  # holds <main>
    for i in range(n - 1, 0, -1):
        e, up = elements[i], elements[elements[i].parent]
        e.words += own[i]
        whole[e.parent] |= whole[i] or e.name == "main"
        if e.mark < FIRM_CLASS:
            up.words, up.heads, up.paragraphs = up.words + e.words, up.heads + e.heads, up.paragraphs + e.paragraphs
            up.holds |= e.holds or e.name in MAIN
    elements[0].words += own[0]
    believed = [e.mark == FIRM_TAG or e.mark != NO_MARK and not whole[i] and not (e.name == "form" and e.holds)
                for i, e in enumerate(elements)]

    def settle() -> tuple[list[int], list[int], int]:
        around, main = [0] * n, [0] * n
        for i, e in enumerate(elements):
            if i:
                # A firm mark outweighs any number of loose ones.
                around[i] = around[e.parent] + (believed[i] and (n if e.mark >= FIRM_CLASS else 1))
                main[i] = main[e.parent] or e.name in MAIN
        return around, main, sum(w for w, a, m in zip(own, around, main) if m and not a)

    around, main, clear = settle()
    if not clear:
        depths = [around[i] for i, e in enumerate(elements) if e.name in MAIN and e.words and around[i] < n]
        if depths and min(depths):
            least = min(depths)
            for i, e in enumerate(elements):
                if e.name in MAIN and e.words and around[i] == least:
                    j = i
                    while j and around[j]:
                        believed[j] = False
                        j = e.parent if j == i else elements[j].parent
            around, main, clear = settle()
    if not clear:
        for i, e in enumerate(elements):
            if e.mark == LOOSE and 2 * e.words > elements[0].words and (e.heads or e.paragraphs > 2):
                believed[i] = False
        around, main, clear = settle()
    return [-1 if a else 1 if m else 0 for a, m in zip(around, main)]


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in page order; markup, scripts and comments are gone.

    Takes time in proportion to the page, however its elements nest.
    """
    found: list[tuple[str, int, int, int]] = []  # text, linked words, element, heading
    parts: list[tuple[str, bool]] = []
    elements = [Element(0, "", NO_MARK)]
    own = [0]
    stack = [0]
    opened: dict[str, int] = {}  # open elements of each name
    endless: set[str] = set()  # raw elements that the rest of the page does not close
    main = 0
    links = heading = False

    def leave() -> None:
        nonlocal main
        name = elements[stack.pop()].name
        opened[name] -= 1
        main -= name in MAIN

    def close() -> None:
        text = " ".join(html.unescape("".join(t for t, _ in parts)).split(None)) if parts else ""
        if text:
            linked = sum(len(html.unescape(t).split()) for t, inside in parts if inside)
            found.append((text, linked, stack[-1], int(heading)))
            own[stack[-1]] += len(text.split())
        parts.clear()

    at = 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            parts.append((page[at:m.start()], links))
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        ends, closed = m[1] == "/", m[3].endswith("/")
        if name in RAW:
            if not (ends or closed and name in SELF_CLOSING or name in endless):
                end = RAW_ENDS[name].search(page, at)
                if end:
                    at = end.end()
                elif name in ("script", "style"):
                    at = len(page)
                else:
                    endless.add(name)
            continue
        if name == "a":
            links = not ends
        if name == "br":
            parts.append((" ", False))
        if name in INLINE:
            continue
        close()
        heading = name in HEADINGS and not ends
        if ends:
            if opened.get(name):
                while elements[stack[-1]].name != name:
                    leave()
                leave()
                links = False
            continue
        if name == "body":
            while len(stack) > 1:
                leave()
        # A paragraph ends where another block begins, a list item or cell where the next one does.
        if elements[stack[-1]].name == "p" or name in NEXT_ENDS and elements[stack[-1]].name == name:
            leave()
        if name not in VOID and not closed:
            marks = " ".join(x for g in MARKS.findall(m[3]) for x in g if x)
            mark = NO_MARK
            if name not in ("html", "body") and name not in MAIN:
                mark = class_mark(marks, main > 0)
                if not main and (name == "header" or HEADER.search(marks)) or name == "form":
                    mark = max(mark, LOOSE)
            if name in ASIDE and name != "form" or HIDDEN.search(m[3]):
                mark = FIRM_TAG
            e = Element(stack[-1], name, mark)
            e.heads, e.paragraphs = int(name == "h1"), int(name == "p")
            elements.append(e)
            own.append(0)
            stack.append(len(elements) - 1)
            opened[name] = opened.get(name, 0) + 1
            main += name in MAIN
    if at < len(page):
        parts.append((page[at:], links))
    close()
    where = places(elements, own)
    return [Block(text, len(text.split()), linked, where[e], head) for text, linked, e, head in found]


FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "words_two_before", "link_density_two_before", "words_two_after", "link_density_two_after", "place", "heading")


def neighbours(page: list[Block]) -> np.ndarray:
    """Words and link density of each block and of its two neighbours on both sides, place and heading."""
    n = len(page)
    own = np.array([[b.words, min(1.0, b.link_words / b.words)] for b in page], float).reshape(-1, 2)
    wide = np.vstack([np.zeros((2, 2)), own, np.zeros((2, 2))])
    rest = np.array([[b.place, b.heading] for b in page], float).reshape(-1, 2)
    return np.hstack([own, *(wide[2 + d:2 + d + n] for d in (-1, 1, -2, 2)), rest])


# A small labelled table: pages, and a label (1: main text) for each of their blocks.
LABELLED = (
    (
        "<nav><ul><li><a>Home</a><li><a>News today</a><li><a>Contact us</a></ul></nav><div class=ad>Buy two "
        "and get one free only this week</div><article><h1>Rain expected</h1><p>Heavy rain will reach the "
        "coast on Monday and stay for most of the week said the office.<p>Stay in.<p>Roads near the river may"
        " close at short notice so plan for a longer way home.<p>See <a>the map</a>for more about roads that "
        "may close.</article><footer>Copyright the daily paper all rights reserved by the owners of "
        "it</footer>",
        "0000111110",
    ),
    (
        "<header><a>The town paper</a>Voice of the town since nineteen hundred and "
        "four</header><main><h1>Go</h1><p>Yes.<p>The council met for two hours on the question of the new "
        "bridge.<p>No date was set.<ul><li><a>The full minutes of the meeting are "
        "here</a></ul></main><aside><h2>Most read</h2><p><a>Ten ways to cook rice that you did not know "
        "before today</a><p>Our editors choose the stories that our readers should not miss this week at "
        "all</aside>",
        "011111000",
    ),
    (
        "<article><h1>On bees</h1><p>Bees live in large groups and feed on flowers in the warm months.<div "
        "class=comments><h3>Comments</h3><p>I liked this text very much thank you for writing it up<p>Me "
        "too</div><form>Your name and your mail please</form></article><div class=cookie-notice>We use "
        "cookies to make this site work better for all of our visitors</div>",
        "1100000",
    ),
    (
        "<article><p>One.<p>Two words.<h2>And then</h2><p>Three more words.</article><nav><a>Next "
        "page</a></nav>",
        "11110",
    ),
    (
        "<article><h2>Links</h2><p><a>A study of rivers</a><p><a>Floods of the century in one long "
        "list</a><p>These links are part of the text and stay with it.</article>",
        "1111",
    ),
    (
        "<div><a>Home</a><a>Shop</a><a>Cart</a></div><div><p>The old mill by the lake has been turned into a "
        "museum that shows how flour was made in the last century and before.<p>It opens at nine each day and"
        " closes when the last guest has left the house in the evening "
        "hours.</div><div><a>Terms</a><a>Privacy</a><a>Imprint</a></div>",
        "0110",
    ),
    (
        "<div><a>Start</a></div><div><a>Log in</a></div><div>Menu</div><div><h1>How to plant a "
        "tree</h1><p>Dig a hole twice as wide as the roots and just as deep then set the tree upright in the "
        "middle.<p>Fill in the soil and press it down with your feet before you water the tree well for a "
        "month.</div><div><a>Older posts</a></div><div><a>Newer posts</a></div><div>All rights reserved</div>",
        "000111000",
    ),
    (
        "<table><td><a>Index</a><td><a>Up</a></table><p>This chapter tells of the long way over the hills to "
        "the sea and of those who went there first with nothing but a map.<p>They walked for days on end and "
        "slept in the open with <a>the stars</a>above them and cold stones below.<div><a>Chapter "
        "one</a><p><a>Chapter three</a></div>",
        "001100",
    ),
    (
        "<div>Search</div><div>Follow us</div><div><a>Sign up for free and read all we "
        "have</a></div><div><p>Prices rose by two parts in a hundred over the year which is less than most "
        "had feared they would.</div><div>Share this</div>",
        "00010",
    ),
    (
        "<div class=sidebar><p>This box tells you about our team of writers who have worked for many years in"
        " the field and know it well</div><div><p>A long line of cars stood at the gate when it opened in the"
        " early morning of the first day of the fair.</div><div class=related><p>Readers of this text have "
        "also read the long report about last year and its many surprises for all of us</div>",
        "010",
    ),
    (
        "<div class=ad>Our new shop opens in town today</div><p>The house at the end of the lane stood empty "
        "for years and the children of the village told each other stories about it in the dark.<p>Then it was "
        "sold to a painter from the north who opened all its windows and let the light in again.<div class=share>"
        "Tell your friends about this page now</div>",
        "0110",
    ),
    (
        "<nav>Where to go from here today</nav><article>A text without a heading starts right after the menu and "
        "goes on for more than twenty words so that it is long enough to be told.</article><footer>Made by hand "
        "in our old town</footer>",
        "010",
    ),
    (
        "<aside>Do not miss our summer fair</aside><aside>It will be held on the green behind the church with games "
        "for the young and cake for all who come by on foot or by bike.</aside><form>Leave us your mail and name"
        "</form><aside>Once a month we write to all who have asked for it and tell them what is going on in the "
        "house and in the garden.</aside><article>Short.</article>",
        "00001",
    ),
    (
        "<aside><h2>Ten things to know about cake today</h2><p>Cake is made of flour and eggs and sugar and it "
        "keeps for some days in a tin if you close it well.</aside><div class=popup><h3>Stay in touch with all "
        "of us</h3></div><article><h2>Tea and cake in the old days of the town</h2><p>Fine.</article>",
        "00011",
    ),
    (
        "<div><a>Home</a></div><div>Log in or sign up</div><p>When the ship came in the whole town ran down to the "
        "harbour to see what it had brought from the far side of the sea.<p>Nobody spoke.<p>Then the captain came "
        "down the plank with a small box under his arm and asked the way to the house of the mayor.<p>He was "
        "tired.<p>They led him through the narrow streets up to the market where the mayor lived in a house with "
        "green doors.<div>Page one of nine</div><div><a>Next</a></div>",
        "001111100",
    ),
    (
        "<article>All of the apples were picked by noon on the first day and carried down to the press in the old "
        "barn behind the church by the river.</article><footer>Contact</footer><article>The juice was put into "
        "barrels and kept in the cellar until the winter came and the snow lay high on all the roofs of the "
        "town.</article><nav><a>Next</a></nav><aside>Read on</aside>",
        "10100",
    ),
    (
        "<p>They say that the bell was cast from the guns of the last war and that it rang for three days without "
        "a pause when peace came.<footer>Press</footer><p>It still hangs there and you can see it if you climb the "
        "stairs of the tower on a day when the keeper is at home.<div class=ad>Buy now</div><p>Few do so.<div "
        "class=comments>I did</div>",
        "101010",
    ),
)


# More of the table as shapes, most for pages whose markup tells nothing: the blocks of a page, each with its
# label (+: main text), an a inside the main element or an n inside what surrounds it, an h for a heading,
# its words, and behind a stroke those that are linked.
SHAPES = (
    "-1/1 -1/1 -2/2 -1/1 -3 +h6 +42 +61/2 +38 +55/1 -4/4 -5/5 -6/6 -12/4",
    "-2/2 -2/2 -2/2 -2/2 +h9 +88/3 +15 +120/5 +9 +74 -3 -7/7 -8/8 -6/6 -9/3 -5",
    "-1/1 -1/1 -1/1 +h4 +23 +18 +31/1 +27 +12 +20 -2/2 -2/2 -14/2",
    "-3/3 -1/1 -6 -1/1 +h11 +140/6 +95/2 +3 +110 +64/4 -h2 -9/9 -11/11 -8/8 -10/10 -h3 -4/4 -18/5",
    "-1/1 -1/1 -1/1 -1/1 -1/1 -22/2 +h7 +51 +49/1 +60 -1/1 -1/1 -6",
    "-4/4 -2 -2/2 +h8 +35/1 +h3 +66 +58/2 +h4 +71 +44/1 -2/2 -5/5 -3/3 -16",
    "-1/1 -2/2 -3/3 +47 +52 +39/1 +28 -5/5 -5/5 -5/5",
    "+h5 +80/1 +76 +91/3 +12 +84 -1/1 -1/1 -1/1 -10/2",
    "-2/2 -1/1 +h6 +25 +4 +33 +6 +29/1 +5 +41 -3/3 -3/3 -8",
    "-1/1 -1/1 -1/1 -5 +h7 +150/8 +132/4 +127 -h2 -4/4 -4/4 -6/6 -5/5 -h2 -3/3 -2/2 -11/4",
    "-2/2 -2/2 -1 -1/1 +h10 +19/1 +h2 +36 +40 +h2 +55/2 +48 +h3 +37 -1/1 -7/7 -9",
    "-7/2 -1/1 -1/1 +h5 +64 +59 +70/2 +8 +62 -6/6 -7/7 -2 -3/3 -4",
    "-3 -2/2 -2/2 -2/2 -2/2 +h8 +30 +26/1 +34 -19/1 -2/2 -3/3 -2/2",
    "-1/1 -1/1 +h3 +200/9 +180/6 +170/3 +160 -1/1 -1/1 -15/3",
    "-5/5 -4/4 -6/6 -5/5 +h7 +45/1 +50 +10 +53/1 +11 +47 -4/4 -6/6 -5/5 -7/7 -6",
    "-2/2 -8 -2/2 -1/1 +h9 +72/1 +68/2 +75 -h4 -12/12 -10/10 -13/13 -9/9 -7/1",
    "-1/1 -1/1 -1/1 -1/1 -1/1 -1/1 +h6 +21 +24 +22/1 +26 +19 +23 -2 -2/2 -2/2 -9/3",
    "-4 -1/1 -2/2 +h12 +104/4 +98 +5 +112/2 -3/3 -h2 -8/8 -9/9 -h2 -1/1 -2/2 -1/1 -20/6",
    "-1/1 -3/3 -1/1 +h4 +33 +7 +7 +8 +40/1 +36 -2/2 -4/4 -13/1",
    "-2/2 -2/2 -3/3 -2/2 -26/1 +h7 +90/2 +85 +92/3 +14/1 +78 -5/5 -6/6 -3",
    "-1/1 -1/1 +h8 +57/1 +62/1 +h4 +49 +9 +54 +h5 +66/2 -1/1 -1/1 -1/1 -1/1 -8/8",
    "-6/6 -2/2 -1 +h6 +38 +43 +31 -2/2 -h3 -7/7 -6/6 -8/8 -9/9 -7/7 -17/2",
    "-1/1 -1/1 -2/2 -4/4 -1/1 +h10 +116/3 +122/5 +108 +101/2 -3/3 -2/2 -3/3 -7",
    "-3/3 -3/3 -3/3 +h5 +29/1 +32 +2 +35 +30/1 +27 -1/1 -5 -1/1 -12/5",
    "-2/2 -1/1 -5/5 -1/1 +h7 +82/2 +h2 +79 +6 +87/1 +h3 +94 -h2 -5/5 -5/5 -4/4 -6/6 -10/3",
    "-1/1 -2/2 -1/1 -9 +h6 +44 +39/1 +48 +52 -4/4 -4/4 -24/2 -1/1 -2/2",
    "-2/2 -2/2 +h11 +65/1 +70 +13 +61 +17 +69/2 -6/6 -8/8 -7/7 -5/1",
    "-1/1 -1/1 -1/1 -2/2 -3 -2 +h4 +145/5 +139/2 +151 -1/1 -3/3 -1/1 -14/4",
    "-8/3 -2/2 -2/2 +h8 +37 +28 +34/1 +31 +26 +39 -2/2 -6/6 -h2 -7/7 -9/9 -4",
    "-1/1 -4/4 -3/3 -2/2 +h5 +99/3 +11 +105 +10 +93/1 -5/5 -3/3 -21/3 -2/2",
    "-n1/1 -n2/2 -n3/3 +a3 +a2 +a4 +a1 -n2/2 -n3/3 -n4/4",
    "-n2/2 -n5/5 +a2 +a1/1 +a3 +a2/2 +a4 +a1/1 +a1 -n1/1",
    "-n40 -n30/1 -n3 +ah3 +a2 +a3/3 +a4/4 +a2 +a2/2 +a50 -n60 -n2 -n9",
    "-n1/1 -n6/6 +a1 +a3 -n20 -n4 +a4 +a2 -n3/3 -n8/8 +a1 -n12 -n2/2",
    "-n7/7 -n4/4 +a1 -n2/2 -n2/2 +a2 -n9/9 -n1/1 +a3 -n8/8 -n2/2 +a4 -n3/3 -n90",
    "+a4/4 +a9/9 +a3 +a2 +a12/12 +a1 +a20/10 +a3 +a4 +a2/1 -n35 -n22 -n64",
)


def shape_blocks(shape: str) -> tuple[list[Block], list[int]]:
    """Blocks and labels of a page that is given as a shape."""
    page, labels = [], []
    for told in shape.split():
        words, _, linked = told.lstrip("+-anh").partition("/")
        place = ("a" in told) - ("n" in told)
        page.append(Block("", int(words), int(linked or 0), place, int("h" in told)))
        labels.append(int(told[0] == "+"))
    return page, labels


class Node(NamedTuple):
    """feature < 0: a leaf with its label in ``value``; else left if the feature is <= value."""

    feature: int
    value: float
    left: Node | None = None
    right: Node | None = None


def labelled_pages() -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of the blocks of every labelled page."""
    known = [(blocks(page), list(map(int, labels))) for page, labels in LABELLED]
    known += map(shape_blocks, SHAPES)
    return [(neighbours(page), np.array(labels)) for page, labels in known]


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled table."""
    pages = labelled_pages()
    return np.vstack([x for x, _ in pages]), np.concatenate([y for _, y in pages])


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, leaf: int = MIN_LEAF) -> Node:
    """A decision tree that splits where the Gini impurity falls most, into parts of at least ``leaf`` blocks."""
    if depth == 0 or y.min() == y.max():
        return Node(-1, float(y.mean() >= 0.5))
    best = (0.0, -1, 0.0)
    whole = y.mean() * (1 - y.mean()) * len(y)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left, right = y[x[:, f] <= cut], y[x[:, f] > cut]
            if min(len(left), len(right)) < leaf:
                continue
            gain = whole - sum(p.mean() * (1 - p.mean()) * len(p) for p in (left, right))
            if gain > best[0] + 1e-9:
                best = (gain, f, float(cut))
    if best[1] < 0:
        return Node(-1, float(y.mean() >= 0.5))
    go = x[:, best[1]] <= best[2]
    return Node(best[1], best[2], grow(x[go], y[go], depth - 1, leaf), grow(x[~go], y[~go], depth - 1, leaf))


def is_main(tree: Node, x: np.ndarray) -> np.ndarray:
    """Labels of many blocks at once."""
    if tree.feature < 0:
        return np.full(len(x), tree.value > 0.5)
    go = x[:, tree.feature] <= tree.value
    return np.where(go, is_main(tree.left, x), is_main(tree.right, x))


def main_text(page: str | None, tree: Node) -> str:
    """The main blocks of a page in page order, joined by \\n."""
    found = blocks(page or "")
    if not found:
        return ""
    return "\n".join(b.text for b, yes in zip(found, is_main(tree, neighbours(found)), strict=True) if yes)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Add text (main text) and n_chars (its code points) to every row; equal names are replaced.

    The decision tree is grown on the labelled table of this module. Null and empty pages,
    and pages without main text, get an empty text. Nothing is capped: a page of any
    length is read to its end, and an unclosed element ends with the page.
    """
    tree = grow(*labelled_blocks())

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([main_text(p, tree) for p in part], dtype=object)

    text = F.pandas_udf(run, "string")(F.col(html_col))
    return pages.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))


# The given pages keep their text in one article element; SQL reads that directly.
SQL = r"""
WITH parts AS (
  SELECT page_id, url, [trim(regexp_replace(regexp_replace(replace(replace(replace(
      regexp_replace(b, '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'),
      '\s+', ' ', 'g')) FOR b IN regexp_split_to_array(
      regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1), '</?(?:p|h1)>')] AS l
  FROM pages)
SELECT page_id, url, array_to_string([x FOR x IN l IF x <> ''], chr(10)) AS text,
       length(array_to_string([x FOR x IN l IF x <> ''], chr(10))) AS n_chars
FROM parts"""


@query("op3_html_extraction", SQL)
def op3_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    return extract(read(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")
