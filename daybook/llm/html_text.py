"""Main text of web pages by block rules in two passes.

A page is cut into blocks at block-level tags. The first pass decides blocks by link density,
stop-word density, length and punctuation, and by where they stand. Blocks it leaves open, the
short ones above all, take the label of the nearest decided block.

Place is a vote, not a verdict. Menus, scripts and hidden elements are never text. A sidebar,
a form, or an element whose class or id says such a thing is not text either, unless it holds
most of what the other rules accept and hardly anything is accepted outside. Blocks outside an
article are rejected for their place only if the article holds most of the accepted text.

Reading takes time in proportion to the page, also where tags, quotes and comments are broken.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.quality import STOP_WORDS

STOPS = frozenset(w.decode() for w in STOP_WORDS)

#: A block with more of its characters in links is not text.
LINK_DENSITY = 0.5
#: A block of so many characters can be decided by its stop words.
LONG = 60
STOP_DENSITY = 0.12
#: In a language without known stop words: so many characters, and a sentence mark in each so many.
LONG_ANY = 120
SENTENCE = 200
SENTENCE_MARKS = ".!?\u2026\u3002\uff01\uff1f\u061f\u0964"
PUNCTUATION = ".,;:!?\"'()[]{}|#$%&*"

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav noscript ol option p pre section select summary table tbody td "
    "template textarea tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags whose contents are never main text.
NEVER_TEXT = frozenset(
    "nav aside footer noscript template button select svg iframe object audio video canvas map "
    "datalist".split()
)
#: Tags whose contents are seldom main text. A header counts only outside an article.
CHROME_TAGS = frozenset("form menu dialog".split())
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alert "
    "alertdialog".split()
)
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pager pagination popup promo promotion "
    "related replies reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
#: Words that no amount of text outvotes: what readers write, notices, adverts.
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising comment comments consent cookie cookies disqus "
    "gdpr login newsletter popup promo promotion replies reply respond share sharing signup sponsor "
    "sponsored subscribe subscription".split()
)
#: A container is text after all if it holds most of the accepted text, in so many blocks, and
#: so many times what is accepted outside all such containers.
OUTVOTING_BLOCKS, OUTVOTES = 2, 4
ARTICLE_TAGS = frozenset(("article", "main"))
#: An open paragraph ends where one of these begins.
ENDS_PARAGRAPH = BLOCK_TAGS - frozenset(("button", "html", "body", "head", "option"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

#: Elements whose contents are not markup.
RAW = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "title", "textarea")}
NAME = re.compile(r"(/?)([A-Za-z][A-Za-z0-9:-]*)")
TAG_STOP = re.compile(r"[<>\"']")
#: One attribute after another: a name and its value, which no other name is looked for in.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


#: What an element says about its contents.
FINE, SELDOM, NEVER = 0, 1, 2


@dataclass
class State:
    """An open element: its tag, whether its text can never count, its doubtful containers."""

    tag: str = ""
    never: bool = False
    doubts: tuple[int, ...] = ()
    article: bool = False


@dataclass
class Block:
    state: State
    text: str
    linked: int
    chrome: bool = False

    @property
    def article(self) -> bool:
        return self.state.article


@dataclass
class Page:
    """Open elements and finished blocks while a page is read."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[State] = field(default_factory=list)
    #: How many elements of a tag are open.
    opened: Counter = field(default_factory=Counter)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    #: Depth at which a link was opened, or none.
    link: int | None = None
    #: Doubtful containers so far.
    doubts: int = 0

    def state(self) -> State:
        return self.stack[-1] if self.stack else State()

    def add(self, text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        self.parts.append(text)
        if self.link is not None:
            self.linked += len("".join(text.split()))

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(self.state(), text, self.linked))
        self.parts.clear()
        self.linked = 0

    def cut_to(self, depth: int) -> None:
        for state in self.stack[depth:]:
            self.opened[state.tag] -= 1
        del self.stack[depth:]
        if self.link is not None and self.link > depth:
            self.link = None

    def open(self, tag: str, attributes: str) -> None:
        if tag in VOID_TAGS:
            if tag in BLOCK_TAGS:
                self.flush()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag == "a":
            self.link = len(self.stack)
            return
        if tag not in BLOCK_TAGS and tag not in CHROME_TAGS and tag not in NEVER_TEXT:
            if not attributes or _says(tag, attributes, self.state().article) == FINE:
                return
        self.flush()
        if tag in ENDS_PARAGRAPH:
            if self.stack and self.stack[-1].tag == "p":
                self.cut_to(len(self.stack) - 1)
            if self.stack and self.stack[-1].tag == tag in ("li", "dt", "dd", "tr", "td", "th"):
                self.cut_to(len(self.stack) - 1)
        outer = self.state()
        says = _says(tag, attributes, outer.article)
        doubts = outer.doubts
        if says == SELDOM:
            doubts += (self.doubts,)
            self.doubts += 1
        never = outer.never or says == NEVER
        article = outer.article or (tag in ARTICLE_TAGS and not never)
        self.stack.append(State(tag, never, doubts, article))
        self.opened[tag] += 1

    def close(self, tag: str) -> None:
        if tag == "a":
            self.link = None
            return
        if self.opened[tag] > 0:
            depth = len(self.stack) - 1
            while self.stack[depth].tag != tag:
                depth -= 1
            self.flush()
            self.cut_to(depth)
        elif tag in BLOCK_TAGS:
            self.flush()


def _says(tag: str, attributes: str, article: bool) -> int:
    if tag in NEVER_TEXT:
        return NEVER
    found = SELDOM if tag in CHROME_TAGS or (tag == "header" and not article) else FINE
    if not attributes or tag in ("html", "body"):
        return found
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role" and value in CHROME_ROLES:
            found = SELDOM
        if name in ("class", "id"):
            # The class of an article counts as a whole word only: "post no-sidebar".
            words = value.split() if tag in ARTICLE_TAGS else re.split(r"[^a-z0-9]+", value)
            if not NEVER_WORDS.isdisjoint(words):
                return NEVER
            if not CHROME_WORDS.isdisjoint(words) or ("header" in words and not article
                                                       and tag not in HEADINGS):
                found = SELDOM
        if (name == "hidden" or (name == "aria-hidden" and value == "true")
                or (name == "style" and re.search(r"display\s*:\s*none", value))):
            return NEVER
    return found


def _tag_end(page: str, at: int, last_quote: dict[str, int]) -> tuple[int, int]:
    """Where the attributes of a tag end and where reading goes on; -1 if the page ends before.

    A tag ends at the next ``>``, or before the next ``<``; either may stand in a quoted value.
    A quote that is never closed is a character like any other.
    """
    while stop := TAG_STOP.search(page, at):
        c, at = stop[0], stop.end()
        if c == ">":
            return at - 1, at
        if c == "<":
            return at - 1, at - 1
        if at <= last_quote[c]:
            at = page.index(c, at) + 1
    return -1, -1


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order; comments, scripts, styles and the title are no text."""
    read, at, size = Page(), 0, len(page)
    last_quote = {c: page.rfind(c) for c in "\"'"}
    last_end = page.rfind(">")
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            break
        if begin > at:
            read.add(page[at:begin])
        at = begin
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page[begin + 1:begin + 2] in ("!", "?") and begin < last_end:
            at = page.index(">", begin) + 1
            continue
        name = NAME.match(page, begin + 1)
        if not name:
            read.add("<")
            at = begin + 1
            continue
        end, on = _tag_end(page, name.end(), last_quote)
        if end < 0:
            break
        at, tag = on, name[2].lower()
        if name[1]:
            read.close(tag)
        elif tag in RAW:
            close = RAW[tag].search(page, on)
            at = close.end() if close else size
        else:
            read.open(tag, page[name.end():end])
    if at < size:
        read.add(page[at:])
    read.flush()
    return read.blocks


def stop_density(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(PUNCTUATION) in STOPS for w in words) / len(words) if words else 0.0


def decide(block: Block) -> bool | None:
    """First pass, apart from the place: main text, not main text, or left open."""
    text = block.text
    if block.linked > LINK_DENSITY * len("".join(text.split())):
        return False
    if block.article and block.state.tag in HEADINGS:
        return True
    if len(text) >= LONG and stop_density(text) >= STOP_DENSITY:
        return True
    if len(text) >= LONG_ANY and sum(map(text.count, SENTENCE_MARKS)) * SENTENCE >= len(text):
        return True
    return None


def judge_places(blocks: list[Block], labels: list[bool | None]) -> None:
    """Mark blocks in elements that are never text, and in doubtful ones that are not outvoted."""
    held, count = Counter(), Counter()
    total = clean = 0
    for block, label in zip(blocks, labels):
        if label and not block.state.never:
            size = len(block.text)
            total += size
            clean += 0 if block.state.doubts else size
            held.update({d: size for d in block.state.doubts})
            count.update(block.state.doubts)
    fine = {
        d for d, size in held.items()
        if 2 * size > total and count[d] >= OUTVOTING_BLOCKS and size >= OUTVOTES * clean
    }
    for block in blocks:
        block.chrome = block.state.never or not fine.issuperset(block.state.doubts)


def main_text(page: str | None) -> str:
    """The main text of a page: its blocks in order, joined by one space."""
    blocks = blocks_of(page or "")
    labels = [decide(b) for b in blocks]
    judge_places(blocks, labels)
    labels = [False if b.chrome else x for b, x in zip(blocks, labels)]
    inside = sum(len(b.text) for b, x in zip(blocks, labels) if x and b.article)
    outside = sum(len(b.text) for b, x in zip(blocks, labels) if x and not b.article)
    # Place outweighs the other rules only where the article holds most of what they accept.
    has_article = any(b.article and not b.chrome for b in blocks) and inside >= outside
    if has_article:
        labels = [x if b.article else False for b, x in zip(blocks, labels)]
    # Inside an article, chrome says nothing about the text next to it.
    votes = [None if has_article and (b.chrome or not b.article) else x for b, x in zip(blocks, labels)]
    size = len(blocks)
    before, after, last = [size + 1] * size, [size + 1] * size, None
    for i in range(size):
        last = i if votes[i] is not None else last
        before[i] = i - last if last is not None else size + 1
    last = None
    for i in range(size - 1, -1, -1):
        last = i if votes[i] is not None else last
        after[i] = last - i if last is not None else size + 1
    kept = []
    for i, (block, label) in enumerate(zip(blocks, labels)):
        if label is None:
            # Second pass: the nearest decided block; text if both are as near, or none is.
            near = min(before[i], after[i])
            around = [votes[j] for j, d in ((i - before[i], before[i]), (i + after[i], after[i]))
                      if d == near <= size]
            label = any(around) if around else True
        if label:
            kept.append(block.text)
    return " ".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array(map(len, texts), pa.int64())],
            ["id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars (code points).

    * A null or empty page, or one without main text, gives an empty text.
    * Ids and urls pass through, null or repeated as they are. Without pages there are no
      rows. Other columns are ignored.
    * Pages of any length are read whole; a broken or cut page is read as far as it goes.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    ).mapInArrow(_extract, f"id {kind}, url string, text string, n_chars long").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars"
    )
