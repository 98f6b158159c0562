"""Main text of web pages: a conditional random field over the leaf blocks of the DOM.

A page is read as a sequence of blocks (text between block-level tags). Features of a block
are the tags and the class and id words of its ancestors, and counts of its text. The field
labels each block as text of the article or as anything else; Viterbi finds the best
labelling of the page, so a doubtful block follows its neighbours.

Training pages come from a bounded sample of the table (``TRAIN_PAGES``). Blocks below
``article`` or ``main`` and below no navigation, footer, form or advert are positive; a page
without such a block says nothing about its article and is left out. As sites mark the same
parts in other ways, each training page is also used with its parts wrapped in other tags and
classes, drawn from the lists below by the page's own hash. ``SYNTHETIC`` pages of drawn words
come on top, whatever the sample is like: their articles often have no mark, or one that
means nothing, so that the field learns to tell parts by length, links and ends of sentences.

Scripts, styles, templates and fields of forms are hidden, nothing else; what else is not the
article is left to the field.

Defined results: a missing or empty page has an empty text; unclosed tags, hidden ones too, end
with their parent or the page; a page cut inside a tag or comment ends there; of equally good
labellings the one with less article is taken; repeated rows give equal rows; an empty table gives an empty
one, and trains on synthetic pages alone; other columns are ignored. Pages of any length and depth are
read whole, in linear time: what the elements around a block say is kept once for all blocks
below them.
"""

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm.crf import Crf

#: Pages that the field is trained on, those with the lowest hash of their id; of each the first and the
#: last blocks, this many together, and of a block's text so many characters.
TRAIN_PAGES, TRAIN_BLOCKS, TRAIN_CHARS = 100, 50, 2000
#: Pages of drawn words that it is trained on besides.
SYNTHETIC = 150

LABELS = ("other", "article")

#: Elements whose text is never shown, and elements without an end tag.
HIDDEN = frozenset("script style noscript template iframe title textarea select".split())
#: Hidden elements whose start tag is not closed by a slash.
RAW = frozenset("script style iframe textarea".split())
#: Elements that run within a line whatever is in them, and the start tags that end an unclosed one.
FOREIGN = frozenset("svg math".split())
BREAKS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre article main section aside nav header footer body form".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
#: An end tag closes up to its start tag, but not beyond one of these.
SCOPES = frozenset("article main section aside nav header footer div td th table body form ul ol".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.S,
)
_CLASS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I | re.S)
_WORD = re.compile(r"[a-z]+")

#: How sites mark what is not the article, and the article itself.
OTHER_MARKS = (
    ("div", "sidebar"), ("div", "cookie notice"), ("div", "advert"), ("div", "ads sponsored"), ("section", "comments"),
    ("div", "comment list"), ("div", "menu"), ("div", "navigation breadcrumb"), ("div", "site header"), ("div", "site footer"),
    ("aside", ""), ("header", ""), ("nav", ""), ("footer", ""), ("form", ""), ("div", "newsletter subscribe"),
    ("div", "related promo"), ("div", "share social"), ("ul", "menu"), ("div", "banner popup"), ("div", "widget"),
    ("form", "search"), ("ol", "comments"), ("div", "ad"), ("div", "notice"), ("div", "consent privacy"), ("div", "login"),
)
ARTICLE_MARKS = (
    ("article", ""), ("main", ""), ("div", "content"), ("div", "post body"), ("div", "entry content"), ("div", "article body"),
    ("section", "story"), ("div", "main text"),
)
OWN_TAGS = ("", "", "p", "p", "p", "li", "h2", "h3", "div", "td", "blockquote")
OTHER_TAGS = frozenset("nav header footer aside form dialog menu".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement sponsored promo banner cookie notice consent popup sidebar menu nav navigation breadcrumb "
    "comment comments footer header related share social newsletter subscribe widget search login".split()
)


class Place:
    """An open element: its tag, its class and id words, and the element around it."""

    __slots__ = ("tag", "marks", "up", "said")

    def __init__(self, tag: str, marks: str, up: "Place | None"):
        self.tag, self.marks, self.up, self.said = tag, marks, up, None

    def __iter__(self) -> Iterator[tuple[str, str]]:
        """(tag, marks) from the innermost element outwards."""
        place = self
        while place:
            yield place.tag, place.marks
            place = place.up


def _said(tag: str, marks: str) -> list[str]:
    return [f"in:{tag}", *(f"mark:{word}" for word in _WORD.findall(marks))]


def around(place: "Place | None", known) -> frozenset[str]:
    """What the elements around a block say, as far as it is ``known``.

    Elements that add nothing share the set of the one around them.
    """
    way = []
    while place and place.said is None:
        way.append(place)
        place = place.up
    said = place.said if place else frozenset()
    for place in reversed(way):
        new = [name for name in _said(place.tag, place.marks) if name in known and name not in said]
        said = place.said = said.union(new) if new else said
    return said


def blocks(page: str) -> list[tuple[str, Place | None, int]]:
    """(text, innermost element around it, characters in links) of every block with text."""
    found, stack, pieces, linked, link_chars, at = [], [], [], 0, 0, 0
    opened: Counter[str] = Counter()
    foreign, unclosed = False, set()

    def close() -> None:
        nonlocal pieces, link_chars
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            found.append((text, stack[-1] if stack else None, link_chars))
        pieces, link_chars = [], 0

    while tag := _TAG.search(page, at):
        if tag.start() > at:
            pieces.append(page[at : tag.start()])
            link_chars += linked and tag.start() - at
        at = tag.end()
        if tag[2] is None:
            continue
        name, ends = tag[2].lower(), bool(tag[1])
        slash = bool(tag[3]) and tag[3].endswith("/")
        if name in HIDDEN and not ends:
            if slash and name not in RAW:
                continue
            end = None if name in unclosed else re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if end:
                at = end.end()
            else:
                unclosed.add(name)
                parent = stack and re.compile(rf"</{re.escape(stack[-1].tag)}(?=[\s/>])", re.I).search(page, at)
                at = parent.start() if parent else len(page)
            continue
        if name in FOREIGN:
            foreign = not ends and not slash
            continue
        if foreign:
            if not (opened[name] if ends else name in BREAKS):
                continue
            foreign = False
        if name == "a":
            linked = int(not ends)
        if name in INLINE:
            if name == "br":
                pieces.append(" ")
            continue
        close()
        if name in VOID:
            continue
        if not ends:
            if stack and stack[-1].tag in (("p", name) if name in ("li", "td", "th", "tr", "dt", "dd") else ("p",)):
                opened[stack.pop().tag] -= 1
            marks = " ".join(a or b or c for _, a, b, c in _CLASS.findall(tag[3])).lower() if tag[3] else ""
            stack.append(Place(name, marks, stack[-1] if stack else None))
            opened[name] += 1
            continue
        for depth in range(len(stack) - 1, -1, -1) if opened[name] else ():
            if stack[depth].tag == name:
                opened.subtract(place.tag for place in stack[depth:])
                del stack[depth:]
                break
            if stack[depth].tag in SCOPES and name not in SCOPES:
                break
    pieces.append(page[at:])
    close()
    return found


def _bucket(n: int) -> int:
    return min(n.bit_length(), 10)


def text_features(text: str, links: int, own: str) -> list[str]:
    """What a block says of itself; ``own`` is the tag right around it."""
    digits = sum(map(text.count, "0123456789"))
    names = ["bias", f"len{_bucket(len(text))}", f"link{int(4 * links / max(len(text), 1))}", f"own:{own}"]
    names.append("stop" if text[-1] in ".!?:;" else "nostop")
    if digits:
        names.append(f"digits{min(int(20 * digits / len(text)), 3)}")
    if text[0] in "|•·" or "©" in text:
        names.append("sign")
    return names


def features(page: list[tuple[str, Place | None, int]], known) -> list[list[str]]:
    """Names of the features of each block; of those around it only the ``known`` ones."""
    return [
        [*text_features(text, links, place.tag if place else ""), *around(place, known)] for text, place, links in page
    ]


def is_article(place: Place | None) -> bool:
    """Below article or main, and below nothing that marks another part."""
    ancestors = list(place or ())
    inside = any(tag in ("article", "main") for tag, _ in ancestors)
    return inside and not any(tag in OTHER_TAGS or OTHER_WORDS & set(_WORD.findall(marks)) for tag, marks in ancestors)


#: A block to train on: text, what is said of and around it, characters in links, label.
_BLOCK = "text string, names array<string>, links long, label long"


def training_blocks(page: str) -> list[tuple[str, list[str], int, int]]:
    """The first and last blocks of a page, as ``_BLOCK``; none of a page without an article."""
    whole = blocks(page)
    if len(whole) > TRAIN_BLOCKS:
        whole = whole[: TRAIN_BLOCKS // 2] + whole[-(TRAIN_BLOCKS // 2) :]
    made = []
    for text, place, links in whole:
        said = dict.fromkeys(name for tag, marks in place or () for name in _said(tag, marks))
        names = [*text_features(text, links, place.tag if place else ""), *list(said)[:TRAIN_CHARS]]
        made.append((text[:TRAIN_CHARS], names, min(links, TRAIN_CHARS), int(is_article(place))))
    return made if any(label for *_, label in made) else []


def _laid_out(text: str, outer: tuple, links: int, draw: random.Random) -> list[str]:
    """Features of a block in some element below the elements ``outer``."""
    own = draw.choice(OWN_TAGS)
    around_it = (("body", ""), *outer, *([(own, "")] if own else []))
    return [*text_features(text, links, around_it[-1][0]), *dict.fromkeys(x for place in around_it for x in _said(*place))]


def rewrapped(texts: list[str], links: list[int], labels: list[int], seed: int) -> tuple[list[list[str]], list[int]]:
    """The same blocks with parts marked as other sites do, and other parts put in between."""
    draw = random.Random(seed)
    article = draw.choice(ARTICLE_MARKS)
    by_label = [[text for text, label in zip(texts, labels, strict=True) if label == k] for k in (0, 1)]
    marks = draw.sample(OTHER_MARKS, 4)
    out, kinds = [], []
    for i, (text, linked, label) in enumerate(zip(texts, links, labels, strict=True)):
        if not label and by_label[1] and draw.random() < 0.5:
            text, linked = draw.choice(by_label[1]), 0
        out.append(_laid_out(text, (article,) if label else (marks[i % 2],), linked, draw))
        kinds.append(label)
        if label and draw.random() < 0.2:
            # A notice, reader comments or an advert between two paragraphs of the article.
            other = by_label[draw.randint(0, 1)] or [text]
            words = " ".join(draw.choice(other).split()[: draw.randint(1, 60)])
            out.append(_laid_out(words, (article, marks[2 + i % 2]), 0, draw))
            kinds.append(0)
    return out, kinds


def _drawn_text(draw: random.Random, words: int, end: str) -> str:
    return " ".join("x" * draw.randint(2, 9) for _ in range(words)).capitalize() + end


def synthetic(seed: int) -> tuple[list[list[str]], list[int]]:
    """A page of drawn words: other parts, an article in any element or none, other parts."""
    draw = random.Random(seed)
    plain = [(), (("div", ""),), (("section", ""),), (("div", ""), ("div", "")), (("table", ""), ("tr", ""), ("td", "")),
             (("div", "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=5))),)]
    wrapper = draw.choice([*plain, (draw.choice(ARTICLE_MARKS),)])
    out, kinds = [], []

    def other(within: tuple = ()) -> None:
        mark = draw.choice(OTHER_MARKS)
        for _ in range(draw.randint(1, 5)):
            linked = draw.random() < 0.6
            text = _drawn_text(draw, draw.randint(1, 4 if linked else 25), "" if linked else draw.choice(["", ".", "."]))
            if draw.random() < 0.15:
                text = f"© 20{draw.randint(10, 25)} {text}"
            out.append(_laid_out(text, (*within, mark), len(text) if linked else 0, draw))
            kinds.append(0)

    for _ in range(draw.randint(0, 3)):
        other()
    if draw.random() < 0.8:
        out.append([*text_features(_drawn_text(draw, draw.randint(3, 14), ""), 0, "h1"),
                    *dict.fromkeys(x for place in (("body", ""), *wrapper, ("h1", "")) for x in _said(*place))])
        kinds.append(1)
    for _ in range(draw.randint(1, 9)):
        out.append(_laid_out(_drawn_text(draw, draw.choice([6, 15, 40, 90, 200]), draw.choice(".....!?")), wrapper, 0, draw))
        kinds.append(1)
        if draw.random() < 0.1:
            other(wrapper)
    for _ in range(draw.randint(1, 3)):
        other()
    return out, kinds


def train(pages: list[list[tuple[str, list[str], int, int]]]) -> Crf:
    """The field, from what ``training_blocks`` gives of pages, and from synthetic ones."""
    examples = []
    for page in pages:
        texts, names, links, labels = map(list, zip(*page, strict=True))
        examples.append((names, labels))
        seed = crc32("\n".join(texts).encode("utf-8", "replace"))
        examples += [rewrapped(texts, links, labels, seed + k) for k in range(3)]
    # Every mark, whatever the sample holds.
    filler = "The words of a paragraph that stands for any other one."
    for k, mark in enumerate(OTHER_MARKS):
        article = ARTICLE_MARKS[k % len(ARTICLE_MARKS)]
        outers = [(mark,), (article, ("p", "")), (article, mark, ("p", "")), (article, ("p", "")), (mark, ("p", ""))]
        page = [[*text_features(filler, 0, outer[-1][0]),
                 *dict.fromkeys(x for place in (("body", ""), *outer) for x in _said(*place))] for outer in outers]
        examples += [(page, [0, 1, 0, 1, 0])] * 4
    return Crf(LABELS).fit(examples + [synthetic(seed) for seed in range(SYNTHETIC)])


def main_text(page: str | None, model: Crf) -> str:
    """The article's blocks, one per line."""
    found = blocks(page) if page else []
    labels = model.decode(model.scores(features(found, model.features)))
    return "\n".join(text for (text, _, _), label in zip(found, labels, strict=True) if label)


def fit_on(pages: DataFrame, n: int = TRAIN_PAGES) -> Crf:
    """Train on the ``n`` pages with the lowest hash of their id."""
    ids = pages.select("page_id").where("page_id is not null").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(n)
    sample = pages.join(F.broadcast(ids), "page_id").where("html is not null").orderBy(F.xxhash64("page_id"), "page_id").limit(n)


    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [[dict(zip(("text", "names", "links", "label"), x, strict=True)) for x in training_blocks(page)] for page in batch.html]
            yield pd.DataFrame({"blocks": made})

    # Pages are cut where they are read; the driver gets bounded blocks.
    rows = sample.select("html").mapInPandas(cut, f"blocks array<struct<{_BLOCK.replace(' ', ':').replace(',:', ',')}>>")
    return train([[tuple(x) for x in row.blocks] for row in rows.where("size(blocks) > 0").collect()])


def extract(pages: DataFrame, model: Crf) -> DataFrame:
    """(page_id, url, text) of every row of ``pages``."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "page_id": batch.page_id, "url": batch.url, "text": [main_text(page, model) for page in batch.html],
            })

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInPandas(
        texts, "page_id long, url string, text string"
    )
