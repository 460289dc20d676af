"""Main text of web pages by two passes of block rules: densities decide clear blocks, their neighbours the short ones."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from millrace.llm.quality import STOP_WORDS

#: Elements whose content is no text, that hold no article, that hold one, and that begin a block.
DROPPED = frozenset("script style noscript template svg math iframe object embed canvas audio video map head title select textarea button option datalist".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog".split())
ARTICLE = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html isindex legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words of class, id and role that mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promoted promotion banner banners "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars aside footer header masthead "
    "comment comments commentlist disqus respond reply replies discussion reactions "
    "share sharing social related recommended recommendations widget widgets toolbar complementary contentinfo search".split()
)
#: Words that name a piece of a page whatever it holds; in an article a name marks an aside only if it has no others besides.
PIECE_WORDS = frozenset(
    "post posts box block list section container wrapper wrap area content button buttons bar link links item items form inner outer unit "
    "slot news article articles story stories top bottom left right module panel region title heading group".split()
)
#: A tag as most are written. No part of it gives back what it took, so a failure costs no more than the tag.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)((?:\s++[^\s\"'<>/=]++(?:=(?:\"[^\"<>]*+\"|'[^'<>]*+'|[^\s\"'<>=`/]++))?+)*+)\s*+(/?)>")
TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
BETWEEN, NAME, EQUALS, PLAIN = re.compile(r"[\s/]*"), re.compile(r"=?[^\s/>=]*"), re.compile(r"\s*=\s*"), re.compile(r"[^\s>]*")
ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in DROPPED}
#: A reference to a character by so many digits that they may be too many to read.
LONG_REFERENCE = re.compile(r"&#(?:([0-9]{8,})|[xX]([0-9a-fA-F]{8,}));?")
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies discussion reactions hidden".split())
SPACE = re.compile(r"\s+")
NAME_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str = ""
    linked: int = 0
    inside: bool = False
    outside: bool = False
    aside: bool = False
    heading: bool = False
    good: bool | None = field(default=None)


def _marked(attributes: str, inside: bool) -> set[str]:
    """The words of class, id and role that mark an element as no part of the article, and 'hidden'.

    Inside an article a name counts as a whole: `search` or `related-posts` mark an aside, `search-results` or `related-work` do not.
    """
    if not attributes:
        return set()
    names = [name for _, a, b, c in ATTRIBUTE.findall(attributes) for name in (a or b or c).lower().split()]
    found = set()
    for name in names:
        own = set(NAME_WORD.findall(name))
        if not inside or own <= ASIDE_WORDS | PIECE_WORDS:
            found |= own & ASIDE_WORDS
    return found | ({"hidden"} if HIDDEN.search(attributes) else set())


class Scanner:
    """Tags, texts and other markup of a page, read once from its beginning to its end.

    Quotes count only where an attribute's value begins; one that is never closed is a part of a value that ends at white space. A tag,
    comment or section without an end takes the rest of the page. What was searched for in vain is not searched for again.
    """

    def __init__(self, page: str):
        self.page = page
        self.at = 0
        self.absent: set[str] = set()

    def find(self, text: str, start: int) -> int:
        """Where `text` is next, or -1; once absent it stays so, as the search only moves on."""
        if text in self.absent:
            return -1
        found = self.page.find(text, start)
        if found < 0:
            self.absent.add(text)
        return found

    def past(self, text: str, start: int) -> int:
        found = self.find(text, start)
        return len(self.page) if found < 0 else found + len(text)

    def skip_element(self, name: str, to_the_end: bool) -> None:
        """Goes behind the end of an element whose content is no text; without an end nothing of it is skipped, or all the rest."""
        end = None if name in self.absent else ENDS[name].search(self.page, self.at)
        if end:
            self.at = end.end()
        else:
            self.absent.add(name)
            self.at = len(self.page) if to_the_end else self.at

    def tags(self) -> Iterator[tuple[str, str, str, bool]]:
        """(text before, name, attributes, closing) of each tag, and at the end (text, '', '', False). A section of data is text."""
        page, begin = self.page, self.at
        text: list[str] = []
        while True:
            mark = self.find("<", self.at)
            if mark < 0:
                text.append(page[self.at :])
                self.at = len(page)
                yield "".join(text), "", "", False
                return
            begin = self.at
            follows = page[mark + 1 : mark + 2]
            if tag := TAG.match(page, mark):
                text.append(page[begin:mark])
                self.at = tag.end()
                yield "".join(text), tag[2].lower(), tag[3] + tag[4], bool(tag[1])
                text = []
            elif follows in ("!", "?"):
                text.append(page[begin:mark])
                if page.startswith("<!--", mark):
                    self.at = self.past("-->", mark + 4)
                elif page.startswith("<![CDATA[", mark):
                    self.at = self.past("]]>", mark + 9)
                    text.append(html.escape(page[mark + 9 : self.at].removesuffix("]]>"), quote=False))
                else:
                    self.at = self.past(">", mark)
            elif name := TAG_NAME.match(page, mark):
                text.append(page[begin:mark])
                self.at = self._end_of_tag(name.end())
                yield "".join(text), name[1].lower(), page[name.end() : self.at - 1], follows == "/"
                text = []
            else:
                text.append(page[begin : mark + 1])
                self.at = mark + 1

    def _end_of_tag(self, at: int) -> int:
        """The place behind the '>' that ends a tag, whose attributes begin at `at`."""
        page = self.page
        while True:
            at = BETWEEN.match(page, at).end()
            if at >= len(page):
                return at
            if page[at] == ">":
                return at + 1
            at = NAME.match(page, at).end()
            if equals := EQUALS.match(page, at):
                at = equals.end()
                quote = page[at : at + 1]
                end = self.find(quote, at + 1) if quote in ("'", '"') else -1
                at = end + 1 if end >= 0 else PLAIN.match(page, at).end()


@dataclass(frozen=True)
class Place:
    """An open element, and what holds within it: of the elements that contain it, and of itself."""

    name: str = ""
    kind: str = ""  # 'out', 'soft', 'in', 'drop', 'head', 'link' or ''
    out: bool = False
    inside: bool = False
    soft: bool = False
    soft_inside: bool = False
    link: bool = False
    heading: bool = False

    def child(self, name: str, kind: str) -> Place:
        article = kind == "in"
        return Place(
            name, kind, self.out or kind == "out", self.inside or article, self.soft or kind == "soft",
            not article and (self.soft_inside or kind == "soft"), self.link or kind == "link", self.heading or name in HEADING,
        )


class OpenElements:
    """The elements that are open, with where each name is open last, so that an end needs no search."""

    def __init__(self):
        self.places = [Place()]
        self.named: dict[str, list[int]] = {}
        self.sections: list[int] = []

    @property
    def top(self) -> Place:
        return self.places[-1]

    def open(self, name: str, kind: str) -> None:
        self.named.setdefault(name, []).append(len(self.places))
        if kind in ("in", "out"):
            self.sections.append(len(self.places))
        self.places.append(self.top.child(name, kind))

    def pop(self) -> None:
        self.named[self.places.pop().name].pop()
        if self.sections and self.sections[-1] == len(self.places):
            self.sections.pop()

    def close(self, name: str) -> None:
        """Ends the last element of the name and all within it. A stray end of a small element closes no section."""
        spots = self.named.get(name)
        if not spots or (name not in BLOCK and self.sections and self.sections[-1] > spots[-1]):
            return
        for _ in range(len(self.places) - spots[-1]):
            self.pop()


def _short_reference(reference: re.Match) -> str:
    digits = (reference[1] or reference[2]).lstrip("0") or "0"
    return "\ufffd" if len(digits) > 7 else f"&#{digits};" if reference[1] else f"&#x{digits};"


def _plain(text: str) -> str:
    """Character references decoded, white space turned into one space, trimmed."""
    if "&" in text:
        text = html.unescape(LONG_REFERENCE.sub(_short_reference, text))
    return SPACE.sub(" ", text).strip()


def _kind(name: str, attributes: str, within: Place) -> str:
    if name in DROPPED:
        return "drop"
    if name in ARTICLE and not within.out:
        return "in"
    if name == "header" and within.inside:
        return "head"
    if name in OUTSIDE:
        return "out"
    if name not in ("html", "body") and (marks := _marked(attributes, within.inside)):
        # A page may name its whole frame after a sidebar; an article in it counts. One among comments does not.
        return "out" if marks & COMMENT_WORDS else "soft"
    return "link" if name == "a" else ""


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, with what the markup says of each. Broken markup is read as it comes.

    The page is scanned once and every element opened and closed once, so time grows with its length.
    """
    found: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    elements, scanner = OpenElements(), Scanner(page)

    def end_block() -> None:
        text = _plain("".join(p for p, _ in pieces))
        if text:
            within = elements.top
            linked = len(_plain("".join(p for p, link in pieces if link)))
            found.append(Block(text, linked, within.inside, within.out or within.soft_inside, within.soft, within.heading))
        pieces.clear()

    for text, name, attributes, closing in scanner.tags():
        if text:
            pieces.append((text, elements.top.link))
        if not name:
            break
        alone = name in VOID or attributes.rstrip().endswith("/")
        if not closing and name in DROPPED and not alone:
            if name in BLOCK:
                end_block()
            if name != "head":
                scanner.skip_element(name, name in ("script", "style"))
            continue
        if name in BLOCK:
            end_block()
        if closing:
            elements.close(name)
        elif not alone:
            if name in ("p", "li") and elements.top.name == name:
                elements.pop()
            elements.open(name, _kind(name, attributes, elements.top))
    end_block()
    return found


def _settled(blocks: list[Block]) -> None:
    """Pass 2: a block without a label takes that of the nearest decided neighbours: of both if they agree, else of the nearer, the
    earlier of two equally near; a heading takes that of what follows it. What is
    settled here decides no other block; without decided neighbours a block is no text.
    """
    before: list[tuple[int, bool] | None] = []
    last = None
    for i, b in enumerate(blocks):
        before.append(last)
        last = last if b.good is None else (i, b.good)
    after = None
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        if b.good is not None:
            after = (i, b.good)
        elif b.heading and after:
            b.good = after[1]
        else:
            near = min((x for x in (before[i], after) if x), key=lambda x: abs(x[0] - i), default=(0, False))
            b.good = near[1]


def classify(blocks: list[Block], short: int = 80, dense: float = 0.2, linked: float = 0.4) -> list[Block]:
    """Sets `good` of each block.

    What the markup names as outside is no text. Pass 1 decides the rest by densities: many links, no; long with many
    stop-words, yes; long with few, no. Pass 2 gives short blocks the label of their neighbours. Without decided neighbours a short
    block is no text. If articles hold most of the text found so, the rest of the page is none, and both
    passes judge the articles' blocks again with the article as a feature: a long block needs no stop-words, a linked heading
    is judged by what follows, and a short block is text unless link lists stand on both sides. Else the articles are
    teasers or the like, and count as any other block.
    """
    open_blocks = [b for b in blocks if not b.outside]
    many_links = {id(b): b.linked > linked * len(b.text) for b in open_blocks}
    for b in blocks:
        b.good = False if b.outside else None

    def densities() -> None:
        for b in open_blocks:
            if many_links[id(b)]:
                b.good = False
            elif len(b.text) >= short:
                density = sum(w in STOP_WORDS for w in b.text.encode("utf-8", "replace").lower().split()) / max(len(b.text.split()), 1)
                b.good = density >= dense or len(b.text) >= 3 * short
            else:
                b.good = None

    densities()
    _settled(blocks)
    articles = [b for b in open_blocks if b.inside]
    if not articles:
        return blocks
    held = sum(len(b.text) for b in articles if b.good)
    if held >= sum(len(b.text) for b in open_blocks if b.good and not b.inside):
        for b in open_blocks:
            b.good = False
        for b in articles:
            listed = many_links[id(b)] and not b.heading
            b.good = False if listed else True if len(b.text) >= short else None
        # The edges of the articles count as text.
        decided = [b.good for b in articles]
        earlier, later = [True] * len(articles), [True] * len(articles)
        for i in range(1, len(articles)):
            earlier[i] = earlier[i - 1] if decided[i - 1] is None else decided[i - 1]
        for i in range(len(articles) - 2, -1, -1):
            later[i] = later[i + 1] if decided[i + 1] is None else decided[i + 1]
        for b, one, other in zip(articles, earlier, later):
            if b.good is None:
                b.good = one or other
    elif any(b.aside for b in articles):
        # An aside keeps its articles where they do not hold the text.
        open_blocks = [b for b in open_blocks if not b.aside]
        for b in blocks:
            b.good = False
        densities()
        _settled(blocks)
    return blocks


def main_text(page: str | None) -> str:
    return " ".join(b.text for b in classify(blocks_of(page)) if b.good) if page else ""


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row. Pages are read one by one, so nothing is moved.

    A null or empty page has an empty text. Ids and URLs may be null or repeat; other columns are not looked at.
    """

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(page) for page in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    plain = pages.selectExpr(f"cast(`{id_column}` as long) as page_id", f"`{url_column}` as url", f"`{html_column}` as html")
    return plain.mapInPandas(extract, "page_id long, url string, text string, n_chars long")
