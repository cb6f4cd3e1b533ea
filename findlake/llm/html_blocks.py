"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags. The first pass labels a block by its region, its link
density, its length and its share of stop words: long running text is good, link lists and blocks in
menus, footers, notices and the like are bad, short blocks stay open. A region is told by its tag or role,
or by a class or id; a class or id only counts as a whole (``side-bar``, ``comment-list``, not
``has-sidebar`` or ``comments-open``), never on the page's body, and not on an element that holds a ``main`` or,
where no ``article`` or ``main`` is marked, most of the page's text beside discussions. Running text in scripts without stop words here is told by its letters. The second pass gives an open
block the label of its nearest decided neighbours: first those in its own section, then, if the
section has none, that of the section itself (an article's blocks are text), then those on the page.
Between two different labels the nearer neighbour wins, and the good one if both are as near.

Defined results: null or empty HTML gives an empty text. Unclosed and stray tags, comments, broken
references and text outside any tag are read as browsers do. Repeated rows get equal results each; a
null id or URL stays null. No rows give no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# Blocks of this many characters are decided on their own.
LONG = 70
MIN_STOP_WORDS = 0.15
MAX_LINKS = 0.4

# Frequent function words of the languages the corpus holds.
STOP_WORDS = frozenset(
    """
    the of and to in is was that it for on as with at by be this are from or an not his her they have
    de la le les et des un une du que qui dans est pour pas sur au avec par il elle ne se ce plus en
    der die und das von zu den mit sich auf ist im dem nicht ein eine als auch es für wird aus
    el los las del y una por con para su lo como más al sus pero sin sobre este entre
    il di che è gli della nel sono una più ha si anche dei delle alla o os as do da em não uma com mais dos foi ao
    het een van op te dat niet zijn voor met aan er maar om och att det som på är av för inte den till
    и в не на что он с по это как из но за к у от так же для бы или когда nie się w z do jest że jak na to
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    head header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead title tr ul caption""".split()
)
# Their content is never text of the page.
SILENT = frozenset("script style noscript template title head svg math iframe object canvas audio video map datalist".split())
# What can stand in a head; it ends, closed or not, where anything else begins.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
# Elements that a closing slash ends, unlike those of HTML.
FOREIGN = frozenset(("svg", "math"))
# Regions that hold no part of an article.
REGIONS = frozenset("nav header footer aside form menu dialog button select textarea option label".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
NAMES = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice
    notices notification alert popup modal overlay sidebar aside widget widgets nav navbar navigation menu breadcrumb breadcrumbs
    pagination pager footer header masthead topbar toolbar share sharing social related recommended recommendations newsletter
    subscribe subscription signup login search comment comments reply replies respondents disqus discussion hidden tags""".split()
)
DISCUSSION = frozenset("comment comments reply replies disqus discussion".split())
# Words that make a class or id tell how an element looks or what it has, not what it is.
STATES = frozenset(
    """has have no not non without with is are open opened closed close count counts counter enabled disabled free on off allow allowed
    single first last image images visible active loaded type format status""".split()
)
SECTIONS = frozenset("article main section".split())
# An open element of the same kind ends where one of these begins.
ENDS_ITSELF = {"p": {"p"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_WORD = re.compile(r"[^\W\d_]+")
# Letters of scripts that do not put spaces between words, and of others that stop words here do not cover.
_OTHER_SCRIPTS = re.compile(r"[\u0370-\u03ff\u0530-\u1fff\u2e80-\ua4cf\ua960-\ud7ff\uf900-\ufaff]")
_SENTENCE = re.compile(r"[.!?。！？।؟։]")


def called(attrs: dict[str, str]) -> set[str]:
    """The words that an element's classes and id name it by: their first and last one, and all of them
    as one, unless any of them only tells a state."""
    found: set[str] = set()
    for name in [*attrs.get("class", "").split(), *attrs.get("id", "").split()]:
        parts = [p.lower() for p in _NAME_PARTS.findall(name)]
        words = [p for p in parts if not p.isdigit()]
        if words and not STATES & set(words):
            found |= {words[0], words[-1], "".join(words)}
    return found


@dataclass
class Block:
    text: str
    linked: int
    bad: bool
    section: int
    article: bool
    named: tuple[int, ...]  # elements around it whose names tell that it is no text


class _Blocks(HTMLParser):
    """Collects the blocks of one page, in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        # Open elements: name, in a bad region, elements with telling names, silent, number of section, in an article.
        self.open: list[tuple[str, bool, tuple[int, ...], bool, int, bool]] = [("", False, (), False, 0, False)]
        self.talks: list[bool] = []  # of each element with a telling name, whether it is a discussion
        self.holds_main: set[int] = set()
        self.sections = 0
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0

    def _end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, bad, named, _, section, article = self.open[-1]
            self.blocks.append(Block(text, min(self.linked, len(text)), bad, section, article, named))
        self.parts, self.linked = [], 0

    def _close(self, at: int) -> None:
        if any(name in BLOCKS for name, *_ in self.open[at:]):
            self._end_block()
        self.links -= sum(name == "a" for name, *_ in self.open[at:])
        del self.open[at:]

    def _end_head(self) -> None:
        if self.open[-1][0] == "head":
            self._close(len(self.open) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self._end_head()
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            if tag in BLOCKS:
                self._end_block()
            return
        if tag in BLOCKS:
            self._end_block()
        ends = ENDS_ITSELF.get(tag)
        if ends or tag in BLOCKS:
            for at in range(len(self.open) - 1, 0, -1):
                name = self.open[at][0]
                if ends and name in ends or tag in BLOCKS and name == "p":
                    self._close(at)
                    break
                if name in BLOCKS and name != "p":
                    break
        _, bad, named, silent, section, article = self.open[-1]
        given = {k: v or "" for k, v in attrs}
        root = tag in ("html", "body", "main")
        names = set() if root else called(given)
        talk = bool(names & DISCUSSION)
        if tag == "main":
            self.holds_main.update(named)
        if tag == "main" or tag == "article" and not talk and not any(self.talks[e] for e in named):
            bad, named = False, ()  # what was left open before it has ended
            article = True
        hides = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "")
        bad = bad or hides or not root and tag != "article" and (tag in REGIONS or given.get("role") in ROLES)
        if talk or tag != "article" and names & NAMES:
            named = (*named, len(self.talks))
            self.talks.append(talk)
        if tag in SECTIONS:
            self.sections += 1
            section = self.sections
        self.links += tag == "a"
        self.open.append((tag, bad, named, silent or tag in SILENT, section, article))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in FOREIGN:
            self._end_head()
        else:
            self.handle_starttag(tag, attrs)  # a closing slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return
        if tag in ("p", "br"):
            self.parts.append(" ")

    def handle_data(self, data: str) -> None:
        if data.strip(" \t\n\f\r"):
            self._end_head()
        if not self.open[-1][3]:
            self.parts.append(data)
            if self.links > 0:
                self.linked += len(data)

    def all(self, html: str) -> list[Block]:
        self.feed(html)
        self.close()
        self._end_block()
        inside: dict[int, int] = {}
        total = 0
        for block in self.blocks:
            if not block.bad and not any(self.talks[e] for e in block.named):
                size = len(block.text) - block.linked
                total += size
                for element in block.named:
                    inside[element] = inside.get(element, 0) + size
        # A discussion may be longer than what it is about.
        most = {} if any(block.article for block in self.blocks) else inside
        wrong = {e for e, size in most.items() if 2 * size > total} | self.holds_main
        for block in self.blocks:
            block.bad = block.bad or any(e not in wrong for e in block.named)
        return self.blocks


def stop_share(text: str) -> float:
    found = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in found) / len(found) if found else 0.0


def first_pass(block: Block) -> bool | None:
    """Good, bad, or None: open."""
    if block.bad or block.linked > MAX_LINKS * len(block.text):
        return False
    if block.text.startswith("©"):
        return False
    others = len(_OTHER_SCRIPTS.findall(block.text))
    if others * 2 > len(block.text.replace(" ", "")):  # few characters say much in some of them
        return True if others >= LONG // 2 and _SENTENCE.search(block.text) else None
    if len(block.text) < LONG:
        return None
    return True if block.article or stop_share(block.text) >= MIN_STOP_WORDS else None


def _nearest(labels: list[bool | None], where: list[int]) -> dict[int, bool]:
    """For each open place of ``where``, in order, the label of its nearest decided neighbours."""
    found: dict[int, tuple[int, bool]] = {}
    for order in (range(len(where)), range(len(where) - 1, -1, -1)):
        last: tuple[int, bool] | None = None
        for n in order:
            label = labels[where[n]]
            if label is not None:
                last = (n, label)
            elif last is not None:
                distance = abs(n - last[0])
                old = found.get(where[n])
                if old is None or distance < old[0] or distance == old[0] and last[1]:
                    found[where[n]] = (distance, last[1])
    return {i: label for i, (_, label) in found.items()}


def labelled(blocks: list[Block]) -> list[bool]:
    """Second pass: every block good or bad."""
    labels = [first_pass(b) for b in blocks]
    by_section: dict[int, list[int]] = {}
    for i, block in enumerate(blocks):
        if not block.bad:
            by_section.setdefault(block.section, []).append(i)
    inherited: dict[int, bool] = {}
    for section, where in by_section.items():
        if section:
            inherited.update(_nearest(labels, where))
            if blocks[where[0]].article:
                inherited.update((i, True) for i in where if labels[i] is None and i not in inherited)
    labels = [inherited.get(i, label) for i, label in enumerate(labels)]
    of_page = _nearest(labels, list(range(len(blocks))))
    return [bool(of_page.get(i, False)) if label is None else label for i, label in enumerate(labels)]


def main_text(html: str | None) -> str:
    blocks = _Blocks().all(html or "")
    return " ".join(b.text for b, good in zip(blocks, labelled(blocks)) if good)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and ``n_chars`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            columns = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *columns], ["page_id", "url", "text", "n_chars"])

    kind = dict(pages.select("page_id").dtypes)["page_id"]
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
