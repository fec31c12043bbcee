from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crawlframe.functions.markup import compile_selector, find_elements, plan_selectors
from crawlframe.operators import pages as P
from crawlframe.plans.discovery import unread_pages
from crawlframe.profile import DELETED_TEXT, GDPR_BODY_ID


def found(html, selector, field="text"):
    return [hit[field] for hit in find_elements(html, plan_selectors({"s": selector}))]


@pytest.mark.parametrize(
    "html, selector, texts",
    [
        ("<p>a<p>b", "p", ["a", "b"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "ul > li", ["a", "bc", "c"]),
        ("<div class='x y'>1</div><div class=y>2</div>", "div.x", ["1"]),
        ("<div class='x y'>1</div>", ".x.y", ["1"]),
        ("<b id=q>1</b><i id=q>2</i>", "#q", ["1", "2"]),
        ("<b id=q>1</b><i id=q>2</i>", "i#q", ["2"]),
        ("<div><b><a>1</a></b><a>2</a></div>", "div > a", ["2"]),
        ("<div><b><a>1</a></b><a>2</a></div>", "div a", ["1", "2"]),
        ("<a>1</a><a href=''>2</a>", "a[href]", ["2"]),
        ("<a>1<a>2</a>", "a", ["1", "2"]),
        ("<p>x<br>y<img>z</p>w", "p", ["xyz"]),
        ("<p>a &amp; b&nbsp;&#45;</p>", "p", ["a & b\xa0-"]),
        ("<p>a<!-- no --><script>if (1 < 2) '</p>'</script>b</p>", "p", ["ab"]),
        ("<script>'<a>1</a>'</script><a>2</a>", "a", ["2"]),
        ("<div><span></div></span>t</div>", "div", [""]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "tr > td", ["1", "2", "3"]),
        ("<section><figure><em><a>1</a></em></figure></section>", "section figure a", ["1"]),
        ("<html><body id=a><html><body id=b><p>x</body></html><p>y", "body#a p", ["x", "y"]),
        ("<DIV CLASS=x>1</DIV>", "div.x", ["1"]),
        ("", "p", []),
        ("<![if !IE]><p>a<![endif]><p>b", "p", ["a", "b"]),
        ("<![foo[x]]><p>a", "p", ["a"]),
        ("<p>a<![CDATA[ x ]]><?php ?>b", "p", ["ab"]),
        ("<![foo[", "p", []),
    ],
)
def test_selectors(html, selector, texts):
    assert found(html, selector) == texts


@pytest.mark.parametrize("selector", ["", "a >", "a:first-child", "a + b", "*"])
def test_unknown_selectors_are_refused(selector):
    with pytest.raises(ValueError):
        compile_selector(selector)


def test_deep_pages_are_read_whole():
    html = "<div class=top>" + "<i>" * 3000 + "<b>x</b>"
    assert found(html, "div.top b") == ["x"] and found(html, "div.top > b") == []


def test_positions_and_first_of_repeated_attributes():
    plan = plan_selectors({"l": "a", "b": "b"})
    hits = find_elements("<a href=1 href=2></a><b></b><a></a>", plan)
    assert [(h["selector"], h["pos"]) for h in hits] == [("l", 0), ("b", 0), ("l", 1)]
    assert dict(hits[0]["attrs"]) == {"href": "1"}


ITEM = """<html><body><div class="submission-id-avatar"><a href="/user/Artist/"></a></div>
<p>thanks <a href="/user/Fern-42" class="iconusername"><img src="f.png" alt=""></a> and</p>
<ul><li><a href="/user/ovalreed" class="linkusername">Oval</a><li><a class="linkusername" href="/user/">?</a></ul>
<a href="https://www.gallery.example/user/tin.pail7/" class="auto_link">tin pail</a>
<a href="https://other.example/user/no/" class="auto_link">other</a>
<a class="iconusername">no link</a>
<strong class="comment_username"><h3>\x1c Some One </h3></strong>
<strong class="comment_username"><h3>Artist</h3></strong>
<strong class="comment_username"><i><h3>Nested</h3></i></strong></body></html>"""


def frame(spark, *pages):
    return spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")


def test_mentions(spark):
    rows = P.extract_mentions(frame(spark, ITEM, None)).collect()
    assert sorted((r.role, r.user_name) for r in rows) == [
        ("artist", "Artist"),
        ("autolink", "tin.pail7"),
        ("commenter", "artist"),
        ("commenter", "some one"),
        ("icon", "Fern-42"),
        ("link", "ovalreed"),
    ]


def test_broken_pages_are_set_aside(spark):
    nobody = ITEM.replace("/user/Artist/", "/user/")
    twice = ITEM.replace("<html><body>", '<div class="submission-id-avatar"><a href="/user/b"></a></div>')
    parsed = P.with_elements(
        frame(spark, ITEM, nobody, twice, "<p>"), P.extractor_selectors(P.EXTRACTORS)
    )
    assert {r.page_id for r in P.mentions_of(parsed).collect()} == {0}
    errors = {(r.page_id, r.role) for r in P.mention_errors(parsed).collect()}
    assert errors == {(1, "artist"), (2, "artist"), (3, "artist")}
    raw = frame(spark, ITEM, nobody).select("page_id", F.encode("html", "UTF-8").alias("content"))
    assert [tuple(r) for r in unread_pages(raw).collect()] == [(1, "artist")]
    fine, quarantine = P.expect_matches(parsed, "artist", 1)
    assert {r.page_id for r in fine.collect()} == {0, 1}
    assert {(r.page_id, r.n_found) for r in quarantine.collect()} == {(2, 2), (3, 0)}
    assert P.expect_matches(parsed, "artist", -1)[1].count() == 0
    missed = {(r.page_id, r.role): r.n_mismatches for r in P.link_mismatches(parsed).collect()}
    assert missed[(0, "link")] == 1 and missed[(0, "icon")] == 1
    assert not any(role == "autolink" for _, role in missed)


def test_status(spark):
    section = '<div class="section-body">{}</div>'
    pages = frame(
        spark,
        section.format(f" \n{DELETED_TEXT}\n"),
        section.format(DELETED_TEXT.replace("  ", " ")),
        section.format("first") + section.format(DELETED_TEXT),
        f'<body id="{GDPR_BODY_ID}">',
        f'<body id="{GDPR_BODY_ID}">' + section.format(DELETED_TEXT),
        f'<div id="{GDPR_BODY_ID}">',
    )
    assert [r.submission_status for r in P.page_status(pages).orderBy("page_id").collect()] == [
        "deleted", "exists", "exists", "gdpr_deleted", "deleted", "exists"
    ]


def test_frontpage(spark):
    gallery = '<section id="gallery-frontpage-submissions"><figure>{}</figure></section>'
    pages = frame(
        spark,
        "<a href=/view/1/></a>" + gallery.format("<b><a name=x></a><a href='/view/22/'></a></b>"),
        gallery.format("<a href='/user/x/'></a><a href='/view/3/'></a>"),
        "<figure><a href='/view/4/'></a></figure>",
    )
    assert [r.site_id for r in P.frontpage_latest_id(pages).orderBy("page_id").collect()] == [
        22, None, None
    ]


def test_extractors_can_be_added_once(spark):
    extra = P.Extractor("title", "title", lambda e, _: F.upper(e["text"]))
    extractors = P.register_extractor(extra)
    rows = P.extract_mentions(frame(spark, "<title>hi</title>" + ITEM), extractors)
    assert rows.filter("role = 'title'").first().user_name == "HI"
    with pytest.raises(ValueError):
        P.register_extractor(extra, extractors)
