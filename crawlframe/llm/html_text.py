"""Main text of web pages by tag-path ratios.

A page is read once into text nodes, each with its path of open tags from the
root and the block it stands in.  Per path, text length and punctuation are
summed and divided by the number of its nodes; the two ratios are fused,
smoothed over the paths that share a container, and paths below a share of
the page's spread are dropped, on every page.  An ``article`` or ``main``
element gives its paths more weight and is one container; a ``form`` in it is
none of the text, one outside gives its paths less weight, so that one around
the page does no harm.  Lists, tables, headings and
quotes belong to the container of the blocks beside them.  Elements that name
their role (menus, headers, footers, asides, adverts, notices, comments) count
as zero.

Null and empty pages, and pages without content, give an empty text.  Nothing
of a kept path is dropped, short blocks included.  Equal pages give equal
texts; rows that share a key are read each for itself.  Time grows with the
length of a page, however broken its markup: paths are numbered by their
parent, elements deeper than ``DEEPEST`` stay on the level above.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.batches import mapped, small

# Element roles of HTML.
RAW = "script|style|noscript|template|iframe|svg|math|textarea|select|object|canvas|noembed|noframes|xmp|title"
SKIPPED = frozenset("head nav header footer aside button menu dialog figure audio video map label fieldset datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5"
    " h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 dt dd".split())
CONTENT = frozenset(["article", "main"])
#: Raw elements that last to the end of the page if nothing closes them; others end with their parent.
TO_THE_END = frozenset(["script", "style", "xmp"])
#: Blocks that hold other blocks of the text, with no role in their name.
HOLDERS = frozenset("article body center details div main section".split())
IN_CONTENT, IN_FORM, DEEPEST = 16, 0.05, 512
ROLE = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|menu|nav\w*|sidebar|side|breadcrumbs?|footer|header|masthead|cookies?|consent"
    r"|notices?|notification|alert|popup|modal|newsletter|subscribe|share|sharing|social|comments?|replies|reply|disqus|related"
    r"|recommend\w*|widget|login|search|legal|copyright|toolbar|pagination|pager)(?:$|[-_\s])"
)
#: Such a class tells what stands beside an element ("has-sidebar"), not what the element is.
BESIDE = re.compile(r"(?<!\S)(?:has|with|without|no)[-_]\S+")
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",  # with a quote that nothing closes
    re.DOTALL,
)
RAW_CLOSE = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW.split("|")}
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
#: The id of a heading, or of a section inside content, is an anchor named after what the text is about.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A tag that the page's end cuts off.
CUT_TAG = re.compile(r"</?[a-zA-Z][^<>]*+\Z|<!.*+\Z", re.DOTALL)
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")


def boilerplate(tag: str, attributes: str, in_content: bool) -> bool:
    """Whether an element says by its name, class, id or role that it is not content."""
    if tag in SKIPPED:
        return not (tag in ("header", "figure") and in_content)
    if not attributes:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True
        if name == "id" and (tag in HEADINGS or (tag == "section" and in_content)):
            continue
        if name in ("class", "id") and tag not in ("html", "body") and ROLE.search(BESIDE.sub("", value)):
            return True
    return False


class Paths:
    """Tag paths from the root as numbers, each known by its parent and its last tag."""

    def __init__(self):
        self.numbers: dict[tuple[int, str], int] = {}
        self.holders = [0]

    def child(self, parent: int, tag: str) -> int:
        number = self.numbers.get((parent, tag))
        if number is None:
            number = self.numbers[parent, tag] = len(self.holders)
            self.holders.append(number if tag in HOLDERS else self.holders[parent])
        return number

    def holder(self, path: int) -> int:
        """The path of the nearest element that holds blocks."""
        return self.holders[path]


@dataclass
class Element:
    """An open element; ``content`` is the path of the article or main it is in, or -1."""

    tag: str
    path: int
    outside: bool
    content: int
    form: bool


Key = tuple[int, bool, int, bool]


def text_nodes(page: str) -> tuple[list[tuple[Key, int, str]], Paths]:
    """((path, boilerplate, content, in a form), block number, raw text) of every text node, in page order."""
    nodes: list[tuple[Key, int, str]] = []
    paths = Paths()
    stack = [Element("#root", 0, False, -1, False)]
    block = at = 0
    unclosed: set[str] = set()

    def text(raw: str) -> None:
        if raw:
            top = stack[-1]
            nodes.append(((top.path, top.outside, top.content, top.form), block, raw))

    end = page.rfind(">") + 1  # a tag that is cut off there is none
    while True:
        found = TOKEN.search(page, at, end)
        if found is None:
            break
        text(page[at : found.start()])
        at = found.end()
        close, name, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
        if name is None:
            continue
        tag = name.lower()
        if tag == "br" or (tag in VOID and not close):
            if tag in BLOCKS:
                block += 1
            elif tag == "br":
                text(" ")
            continue
        raw = tag in RAW_CLOSE
        itself = attributes.rstrip().endswith("/")
        if raw and not close:
            if itself and tag in ("svg", "math"):
                continue
            stop = None if tag in unclosed else RAW_CLOSE[tag].search(page, at)
            if stop is not None:
                at = stop.end()
                continue
            unclosed.add(tag)
            if tag in TO_THE_END:
                at = end = len(page)
                break
        if tag in BLOCKS:
            block += 1
        if close:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].tag in BLOCKS and tag not in BLOCKS:
                    break
            continue
        if tag in BLOCKS:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in CLOSED_BY_BLOCK or stack[depth].tag in RAW_CLOSE or (tag == "li" and stack[depth].tag == "li"):
                    del stack[depth:]
                    break
                if stack[depth].tag in BLOCKS:
                    break
        if len(stack) > DEEPEST or (itself and tag not in BLOCKS):
            continue
        top = stack[-1]
        path = paths.child(top.path, tag)
        outside = top.outside or raw or (tag == "form" and top.content >= 0) or boilerplate(tag, attributes, top.content >= 0)
        content = path if tag in CONTENT and top.content < 0 else top.content
        stack.append(Element(tag, path, outside, content, (top.form or tag == "form") and content < 0))
    text(CUT_TAG.sub("", page[at:]))
    return nodes, paths


def path_scores(nodes: list, paths: Paths) -> dict[Key, float]:
    """Smoothed, fused ratio of every path."""
    sums: dict[Key, list[int]] = {}
    for key, _, raw in nodes:
        letters = len(raw) - raw.count(" ") - raw.count("\n")
        if not letters:
            continue
        total = sums.setdefault(key, [0, 0, 0])
        total[0] += 1
        total[1] += letters
        total[2] += len(PUNCTUATION.findall(raw))
    fused, best = {}, {}
    for key, (count, letters, marks) in sums.items():
        path, outside, content, form = key
        weight = 0.0 if outside else (IN_CONTENT if content >= 0 else 1) * (IN_FORM if form else 1)
        fused[key] = (letters / count) * (1 + marks / count) * weight
        around = (content, content if content >= 0 else paths.holder(path))
        best[around] = max(best.get(around, 0.0), fused[key])
    return {
        key: 0.0 if key[1] else 0.5 * value + 0.5 * best[key[2], key[2] if key[2] >= 0 else paths.holder(key[0])]
        for key, value in fused.items()
    }


def main_text(page: str | None) -> str:
    """The main text: blocks in page order, one line each."""
    nodes, paths = text_nodes(page) if page else ([], Paths())
    scores = path_scores(nodes, paths)
    threshold = 0.25 * np.array(list(scores.values()) or [0.0]).std()
    blocks: dict[int, list[str]] = {}
    for key, block, raw in nodes:
        if not key[1] and (raw.isspace() or scores[key] > threshold):
            blocks.setdefault(block, []).append(raw)
    lines = (" ".join(unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract_text(pages: DataFrame, *keys: str) -> DataFrame:
    """``keys`` (columns of ``pages``) with ``text`` and its number of code points, from ``html``."""
    kinds = dict(pages.dtypes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "__html"):
            texts = [main_text(page) for page in batch.column("__html").to_pylist()]
            kept = batch.drop_columns(["__html"]).append_column("text", pa.array(texts, pa.string()))
            yield kept.append_column("n_chars", pa.array(list(map(len, texts)), pa.int64()))

    schema = ", ".join(f"`{key}` {kinds[key]}" for key in keys)
    rows = pages.select(*keys, F.col("html").cast("string").alias("__html"))
    return mapped(rows, read, f"{schema}, text string, n_chars long")
