"""The visit as one plan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from crawlframe.operators.attempts import finish_submissions
from crawlframe.plans.visit import visit_pages
from crawlframe.profile import DELETED_TEXT
from tests.conftest import explained

DAY = datetime(2024, 5, 1)
GOOD = (
    '<html><body id="pageid-item"><div class="section-body">x</div>'
    '<div class="submission-id-avatar"><a href="/user/ann/"><img></a></div>'
    '<a class="iconusername" href="/user/bob/"><img></a></body></html>'
)
NO_ARTIST = '<html><body><div class="section-body">x</div><a class="iconusername" href="/user/eve/"></a></body></html>'
DELETED = f'<html><body><div class="section-body"> {DELETED_TEXT} </div></body></html>'
ROW = "submission_id long, site_submission_id long, date_visited timestamp, submission_status string, processed_status string, claimed_by string"


def tables(spark, visits):
    pages = spark.createDataFrame([(k, when, None if html is None else html.encode()) for k, when, html in visits], "site_submission_id long, date_visited timestamp, content binary")
    known = spark.createDataFrame([(10 * k, k, DAY, "unknown", "finished" if k == 9 else "todo", "w") for k in (1, 2, 3, 4, 9)], ROW)
    users = spark.createDataFrame([(1, DAY, "bob")], "user_id long, date_added timestamp, user_name string")
    return pages, known, users


def test_a_visit(spark):
    later = datetime(2024, 5, 2)
    visits = [(1, DAY, GOOD), (1, DAY, GOOD), (2, DAY, NO_ARTIST), (3, DAY, GOOD), (3, later, DELETED), (9, DAY, DELETED), (77, DAY, GOOD), (4, DAY, None)]
    left = visit_pages(*tables(spark, visits), F.lit(later))
    rows = {r.site_submission_id: (r.submission_status, r.processed_status, r.date_visited) for r in left.submissions.collect()}
    assert rows[1] == ("exists", "finished", DAY) and rows[3] == ("deleted", "finished", DAY)
    assert rows[2] == ("unknown", "todo", DAY) and rows[9] == ("unknown", "finished", DAY)
    assert [r.user_name for r in left.users.collect()] == ["ann"]
    assert sorted(r.submission_id for r in left.webpages.collect()) == [10, 30]
    assert {(r.site_submission_id, r.role) for r in left.unread.collect()} >= {(2, "artist")}
    assert 1 not in {r.site_submission_id for r in left.unread.collect()}


def test_pages_are_parsed_once(spark):
    left = visit_pages(*tables(spark, [(1, DAY, GOOD)]), F.lit(DAY))
    for rows in (left.submissions, left.users, left.unread):
        plan = explained(rows)
        assert "MapInArrow" not in plan and "content" not in plan.split("ReadSchema")[1]


def test_no_pages(spark):
    left = visit_pages(*tables(spark, []), F.lit(DAY))
    assert left.submissions.count() == 5 and all(rows.isEmpty() for rows in (left.users, left.webpages, left.unread))


def test_newest_visit_finishes(spark):
    _, known, _ = tables(spark, [])
    seen = spark.createDataFrame([(1, 2, "deleted"), (1, 1, "exists"), (2, 1, None), (3, 1, "a"), (3, 1, "b")], "site_submission_id long, at long, submission_status string")
    rows = {r.site_submission_id: r.submission_status for r in finish_submissions(known, seen, "at").collect()}
    assert rows == {1: "deleted", 2: "unknown", 3: "b", 4: "unknown", 9: "unknown"}
    assert finish_submissions(known, seen).filter("site_submission_id = 1").first().submission_status == "exists"
