"""Find the elements of one page that match a few CSS selectors.

Runs inside Python tasks.  A page is read once, tag by tag.  The open elements
form a stack that carries which parts of which selectors have been met so far,
so the work grows with the page's length alone, however deep or broken it is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

from crawlframe.sources.shipping import ship

# HTML elements without content.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Text in these is not text of the page; in the first two it is
# not markup either.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in ("script", "style")}
SILENT = "template"
# A start tag (left) ends an open element (right) of its kind.
ENDED_BY_START = {
    "a": {"a"},
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "option": {"option"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "tbody": {"tr", "td", "th", "thead", "p"},
    "tfoot": {"tr", "td", "th", "tbody", "p"},
    "body": {"head"},
    **{
        block: {"p"}
        for block in (
            "address blockquote center div dl fieldset form h1 h2 h3 h4 h5 h6 hr menu ol p"
            " pre table ul"
        ).split()
    },
}
# An end tag does not reach past an open element of higher rank.
END_RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
            "tfoot": 180, "table": 190}

_SIMPLE = re.compile(r"(?P<tag>[a-zA-Z][\w-]*)?(?P<rest>(?:[.#][\w-]+|\[[\w-]+\])*)\Z")
_PART = re.compile(r"([.#])([\w-]+)|\[([\w-]+)\]")

# The start of a tag, or of a comment or other markup (no group then).
_OPENING = re.compile(r"<(?:/?([a-zA-Z])|[!?/])")
# A whole tag; a quote after "=" hides ">" up to the next such quote.
_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^\"'>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>"
)
_ATTRIBUTE = re.compile(
    r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+"
)
_COMMENT_END = re.compile(r"--!?>")
_EMPTY_COMMENT = re.compile(r"<!---?>")


@dataclass(frozen=True)
class Step:
    """One compound of a selector.

    ``bit`` marks elements that meet it; ``needs`` is the bit of the compound
    to its left (0 without one), to be met by the parent if ``child``, else by
    any ancestor.  ``name`` is set on the last compound, whose elements count.
    """

    bit: int
    needs: int
    child: bool
    tests: tuple[tuple[str, str], ...]
    name: str | None


@dataclass
class Plan:
    """Steps by the tag they may meet; ``anywhere`` for all tags not listed."""

    by_tag: dict[str, list[Step]] = field(default_factory=dict)
    anywhere: list[Step] = field(default_factory=list)


def compile_selector(selector: str) -> list[tuple[str, str | None, list[tuple[str, str]]]]:
    """``(combinator, tag, tests)`` per compound, from left to right.

    Understands tags, ``.class``, ``#id``, ``[attribute]``, descendants and ``>``.
    """
    steps, combinator = [], " "
    for word in selector.replace(">", " > ").split():
        if word == ">":
            combinator = ">"
            continue
        found = _SIMPLE.match(word)
        if not found:
            raise ValueError(f"selector not understood: {selector}")
        tests = [(mark or "[", name or attr) for mark, name, attr in _PART.findall(found["rest"])]
        tag = found["tag"].lower() if found["tag"] else None
        steps.append((combinator, tag, tests))
        combinator = " "
    if not steps or combinator == ">" or steps[0][0] == ">":
        raise ValueError(f"selector not understood: {selector}")
    return steps


def plan_selectors(selectors: dict[str, str]) -> Plan:
    """All selectors as one plan; their names tell their matches apart."""
    plan, tagged, bit = Plan(), [], 1
    for name, selector in selectors.items():
        needs, compounds = 0, compile_selector(selector)
        for place, (combinator, tag, tests) in enumerate(compounds, 1):
            subject = name if place == len(compounds) else None
            step = Step(bit, needs, combinator == ">", tuple(tests), subject)
            if tag is None:
                plan.anywhere.append(step)
            else:
                tagged.append((tag, step))
            needs, bit = bit, bit << 1
    for tag, step in tagged:
        plan.by_tag.setdefault(tag, list(plan.anywhere)).append(step)
    return plan


def _attributes(text: str) -> dict[str, str]:
    """Attributes of a tag; the first of several equal names counts."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


def _passes(tests: tuple[tuple[str, str], ...], attrs: dict[str, str]) -> bool:
    for kind, value in tests:
        if kind == ".":
            if value not in attrs.get("class", "").split():
                return False
        elif kind == "#":
            if attrs.get("id") != value:
                return False
        elif value not in attrs:
            return False
    return True


class _Page:
    """The open elements of a page while it is read, and the matches so far."""

    def __init__(self, plan: Plan):
        self.plan = plan
        self.hits: list[dict] = []
        self.counts: dict[str, int] = {}
        self.tags: list[str] = []
        self.met: list[int] = []  # steps met by the element itself
        self.met_above: list[int] = []  # and by it or any element around it
        self.places: dict[str, list[int]] = {}  # depths of the open elements of a tag
        self.listening: list[tuple[int, list[str]]] = []

    def open(self, tag: str, attr_text: str) -> None:
        if tag in ("html", "head", "body") and self.places.get(tag):
            return
        ended = ENDED_BY_START.get(tag)
        while ended and self.tags and self.tags[-1] in ended:
            self.close_to(len(self.tags) - 1)
        parent, around = (self.met[-1], self.met_above[-1]) if self.met else (0, 0)
        met, attrs, text = 0, None, None
        for step in self.plan.by_tag.get(tag, self.plan.anywhere):
            if step.needs and not (parent if step.child else around) & step.needs:
                continue
            attrs = _attributes(attr_text) if attrs is None else attrs
            if not _passes(step.tests, attrs):
                continue
            met |= step.bit
            if step.name is not None:
                text = [] if text is None else text
                pos = self.counts.get(step.name, 0)
                self.counts[step.name] = pos + 1
                self.hits.append(
                    {"selector": step.name, "pos": pos, "tag": tag,
                     "attrs": list(attrs.items()), "text": text}
                )
        if tag in VOID:
            return
        self.places.setdefault(tag, []).append(len(self.tags))
        self.tags.append(tag)
        self.met.append(met)
        self.met_above.append(around | met)
        if text is not None:
            self.listening.append((len(self.tags), text))

    def deepest(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def close(self, tag: str) -> None:
        depth = self.deepest(tag)
        if depth < 0 or tag in ("html", "body"):
            return
        if depth < len(self.tags) - 1:
            rank = END_RANK.get(tag, 100)
            for other, other_rank in END_RANK.items():
                if other_rank > rank and self.deepest(other) > depth:
                    return
        self.close_to(depth)

    def close_to(self, depth: int) -> None:
        while len(self.tags) > depth:
            self.places[self.tags.pop()].pop()
            self.met.pop()
            self.met_above.pop()
        while self.listening and self.listening[-1][0] > depth:
            self.listening.pop()

    def hear(self, text: str) -> None:
        if text and self.listening and not self.places.get(SILENT):
            text = unescape(text) if "&" in text else text
            for _, parts in self.listening:
                parts.append(text)


def _skip_declaration(html: str, at: int) -> int:
    """Where the comment or unknown markup at ``at`` ends, at the latest with the page."""
    if html.startswith("<!--", at):
        found = _EMPTY_COMMENT.match(html, at) or _COMMENT_END.search(html, at + 4)
        return found.end() if found else len(html)
    return html.find(">", at) + 1 or len(html)


def find_elements(html: str, plan: Plan) -> list[dict]:
    """Matches of a plan in document order; ``pos`` counts per selector from 0."""
    page, at, end = _Page(plan), 0, len(html)
    while at < end:
        mark = html.find("<", at)
        if mark < 0:
            page.hear(html[at:])
            break
        page.hear(html[at:mark])
        opening = _OPENING.match(html, mark)
        if opening is None:
            page.hear("<")
            at = mark + 1
            continue
        if opening.group(1) is None:
            at = _skip_declaration(html, mark)
            continue
        found = _TAG.match(html, mark)
        if found is None:
            break  # a tag that never ends
        closing, tag, attr_text = found.groups()
        at, tag = found.end(), tag.lower()
        if closing:
            page.close(tag)
            continue
        page.open(tag, attr_text)
        if tag in RAW:
            raw_end = RAW[tag].search(html, at)
            at = raw_end.start() if raw_end else end
    for hit in page.hits:
        hit["text"] = "".join(hit["text"])
    return page.hits


ship(__name__)
