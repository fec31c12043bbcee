"""Randomised inputs against plain Python models of the same rules."""

from __future__ import annotations

import gzip
import random
import re
import time
from html.parser import HTMLParser
from xml.etree import ElementTree

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawlframe.functions import headers as H
from crawlframe.functions import urls as U
from crawlframe.functions.content import human_size
from crawlframe.functions.markup import find_elements, plan_selectors
from crawlframe.functions.text import strip
from crawlframe.profile import SiteProfile
from crawlframe.sources import archives as A
from crawlframe.sources.queue import parse_message_id
from crawlframe.sources.warc_format import iter_records

ALPHABET = "ab:. \t\r\n\x1c\x85\xa0    -_/]^é0"


def texts(seed: int, n: int, alphabet: str = ALPHABET, most: int = 30) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randrange(most))) for _ in range(n)]


def column(spark, values, kind="string"):
    """The values with their positions, spread over tasks."""
    rows = spark.createDataFrame(list(enumerate(values)), f"n long, v {kind}")
    return rows.repartition(4)


def evaluated(rows, expression):
    return [r[1] for r in sorted(rows.select("n", expression).collect(), key=lambda r: r[0])]


def test_strip_like_python(spark):
    values = texts(1, 2000)
    assert evaluated(column(spark, values), strip(F.col("v"))) == [v.strip() for v in values]


def test_usernames_like_python_patterns(spark):
    rng = random.Random(2)
    profile = SiteProfile()
    heads = ["/user/", "/user", "http://gallery.example/user/", "https://www.gallery.example/user/",
             "https://wwwxgallery.example/user/", "/view/", " /user/", ""]
    values = [rng.choice(heads) + t + rng.choice(["", "/", "\n", "/\n", "\r\n", "//"])
              for t in texts(3, 3000, "ab]^-_~.`é /\n[", 8)]
    pattern = re.compile(profile.user_pattern)
    expected = [m.group(2) if (m := pattern.search(v)) else None for v in values]
    assert evaluated(column(spark, values), U.username_from_url(F.col("v"))) == expected
    assert sum(e is not None for e in expected) > 100


def model_headers(text: str) -> dict[str, str]:
    """The header rules, one line at a time."""
    found: dict[str, str] = {}
    for line in (raw.strip() for raw in text.split("\n")):
        if not line:
            return found
        name, colon, value = line.partition(":")
        if colon:
            found[name] = value
    return found


def test_headers_like_the_model(spark):
    values = texts(4, 1500, "ab:: \t\r\n\n.", 40)
    got = evaluated(column(spark, values), H.warcinfo_map(F.col("v"), trim_values=False))
    assert got == [model_headers(v) for v in values]


def test_message_ids_like_python(spark):
    values = texts(5, 2000, "0123 +-x\t\xa0_", 6)
    rows = column(spark, values).withColumn("value", F.col("v").cast("binary"))
    expected = []
    for v in values:
        try:
            expected.append(None if "_" in v else int(v))
        except ValueError:
            expected.append(None)
    assert evaluated(parse_message_id(rows), F.col("submission_id")) == expected


def test_sizes_like_python(spark):
    rng = random.Random(6)
    values = [rng.randrange(1 << rng.randrange(1, 50)) for _ in range(2000)]
    values += [64 * k for k in range(500)] + [1024 * 64 * k for k in range(200)]
    units = ["Byte", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]

    def model(size):
        if size == 0:
            return "0.000 Bit"
        power = (size.bit_length() - 1) // 10
        return f"{size / 1024**power:.3f} {units[power]}"

    got = evaluated(column(spark, values, "long"), human_size(F.col("v")))
    assert got == [model(v) for v in values]


def random_tree(rng: random.Random, depth: int = 0) -> str:
    tag = rng.choice(["div", "span", "section", "strong"])
    marks = rng.choice(["", ' class="x"', ' class="x y"', ' id="q"', ' href="h"', ' class="y" id="q"'])
    inner = "".join(random_tree(rng, depth + 1) for _ in range(rng.randrange(4 if depth < 4 else 1)))
    return f"<{tag}{marks}>{rng.choice(['', 't', 'u '])}{inner}</{tag}>"


def brute_select(root, selector: str) -> list[str]:
    """All matches by testing every element's ancestors from the root down."""
    parts = selector.replace(">", " > ").split()

    def fits(element, simple):
        tag = re.match(r"[a-z]*", simple).group()
        if tag and element.tag != tag:
            return False
        classes = element.get("class", "").split()
        return (
            all(c in classes for c in re.findall(r"\.(\w+)", simple))
            and all(element.get("id") == i for i in re.findall(r"#(\w+)", simple))
            and all(a in element.attrib for a in re.findall(r"\[(\w+)\]", simple))
        )

    def reaches(path, wanted):
        if not fits(path[-1], wanted[-1]):
            return False
        if len(wanted) == 1:
            return True
        if wanted[-2] == ">":
            return len(path) > 1 and reaches(path[:-1], wanted[:-2])
        return any(reaches(path[:end], wanted[:-1]) for end in range(1, len(path)))

    found = []

    def walk(element, path):
        path = [*path, element]
        if reaches(path, parts):
            found.append("".join(element.itertext()))
        for child in element:
            walk(child, path)

    walk(root, [])
    return found


def test_selectors_like_brute_force():
    rng = random.Random(7)
    selectors = ["div.x > span", "div span", "#q", "section#q div.x.y", ".x .y > strong", "[href]",
                 "div > div > div", "section span[href]", "strong"]
    for _ in range(150):
        html = "<main>" + "".join(random_tree(rng) for _ in range(3)) + "</main>"
        hits = find_elements(html, plan_selectors({s: s for s in selectors}))
        root = ElementTree.fromstring(html)
        for selector in selectors:
            got = [h["text"] for h in hits if h["selector"] == selector]
            assert got == brute_select(root, selector)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["warcinfo", "request", "response"]), st.binary(max_size=60))))
def test_any_records_come_back(records):
    data = b""
    for kind, block in records:
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nContent-Length: {len(block)}\r\n\r\n"
        data += head.encode() + block + b"\r\n\r\n"
    got = [(h["warc-type"], data[s : s + n]) for _, h, s, n in iter_records(data)]
    assert got == records


class Listed(HTMLParser):
    """Start tags and their attributes as the standard library reads them."""

    def __init__(self, html):
        super().__init__()
        self.found = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.found.append((tag, {name: value or "" for name, value in reversed(attrs)}))


def test_given_pages_read_as_the_standard_library_reads_them(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    for (html,) in pages:
        expected = Listed(html).found
        plan = plan_selectors({tag: tag for tag, _ in expected})
        got = [(h["tag"], dict(h["attrs"])) for h in find_elements(html, plan)]
        assert got == expected


@pytest.mark.parametrize(
    "piece", ["<!--", "<a ", "<![", "</", "<", "<i>x</b>", "<b></i>", "<div><a>", "<a b='", "<p>",
              '<a b="', "<script>", "<div class=x>", "</div>", "<a =", "<!", "&#", "<td></b>"]
)
def test_broken_pages_take_linear_time(piece):
    plan = plan_selectors({"p": "p.x", "q": "div.x a", "r": ".x > b"})
    began = time.perf_counter()
    find_elements(piece * 40_000, plan)
    assert time.perf_counter() - began < 5


@settings(max_examples=3000, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("<>![]/-=\"' adivp&#;x\nCDATA?", max_size=80)))
def test_no_page_breaks_the_matcher(html):
    find_elements(html, plan_selectors({"a": "div > a", "b": "[x] b"}))


def test_archives_survive_packing(spark):
    rng = random.Random(8)
    blobs = []
    for _ in range(30):
        data = b""
        for _ in range(rng.randrange(5)):
            block = rng.randbytes(rng.randrange(200))
            data += b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(block)
            data += block + b"\r\n\r\n"
        blobs.append(data)
    plain = spark.createDataFrame([(str(i), bytearray(b)) for i, b in enumerate(blobs)],
                                  "path string, content binary")
    packed = spark.createDataFrame([(str(i), bytearray(gzip.compress(b))) for i, b in enumerate(blobs)],
                                   "path string, content binary")
    rows = [
        sorted((r.path, r.position, bytes(r.block))
               for r in A.warc_records(A.with_records(files, ("resource",))).collect())
        for files in (plain, packed)
    ]
    assert rows[0] == rows[1] and len(rows[0]) > 20
