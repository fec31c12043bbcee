"""A visit of pages as one plan: classify, store pages and names, finish the ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.content import decode_page
from crawlframe.operators.attempts import finish_submissions
from crawlframe.operators.names import insert_ignore_users
from crawlframe.operators.pages import (
    EXTRACTORS,
    STATUS_SELECTORS,
    Extractor,
    broken_rule,
    extractor_selectors,
    named_users,
    page_status_of,
    with_elements,
)
from crawlframe.plans.discovery import webpage_rows
from crawlframe.profile import SiteProfile
from crawlframe.schemas import SITE_ID
from crawlframe.session import scratch_path


@dataclass(frozen=True)
class Visit:
    """What a visit leaves: the submission table after it, rows to append, and pages to look at."""

    submissions: DataFrame
    users: DataFrame
    webpages: DataFrame
    unread: DataFrame


def visited_pages(
    pages: DataFrame, extractors: tuple[Extractor, ...] = EXTRACTORS, profile: SiteProfile = SiteProfile()
) -> DataFrame:
    """``site_submission_id, date_visited, submission_status, broken, names, content`` of fetched pages.

    One scan and one parse.  ``names`` and ``content`` are kept for pages that
    exist and keep all rules; ``broken`` is the role whose rule a page breaks.
    """
    whole = F.struct(SITE_ID, "date_visited", "content").alias("page")
    selectors = {**STATUS_SELECTORS, **extractor_selectors(extractors)}
    parsed = with_elements(pages.select(whole, decode_page(F.col("content")).alias("html")), selectors, "page", "html")
    state = page_status_of()
    broken = F.when(state == "exists", broken_rule(extractors, profile))
    judged = parsed.select("page.*", state.alias("submission_status"), broken.alias("broken"), named_users(extractors, profile).alias("names"))
    usable = (F.col("submission_status") == "exists") & F.col("broken").isNull()
    return judged.withColumn("names", F.when(usable, F.col("names"))).withColumn("content", F.when(usable, F.col("content")))


def visit_pages(
    pages: DataFrame,
    submissions: DataFrame,
    users: DataFrame,
    date_added: Column,
    extractors: tuple[Extractor, ...] = EXTRACTORS,
    profile: SiteProfile = SiteProfile(),
) -> Visit:
    """The whole visit of ``pages`` (``site_submission_id, date_visited, content``).

    Classified pages are written once and all results read from there.  Pages
    of deleted items and removed accounts finish their ids and leave no other
    row.  A page that breaks a rule leaves its id unfinished, so it is claimed
    again, and is listed in ``unread`` (``site_submission_id, date_visited,
    role``).  Of several pages of an id the newest gives the state; all that
    are usable are stored, repeated ones once.
    """
    path = scratch_path(pages.sparkSession, "visited")
    made = visited_pages(pages, extractors, profile)
    made.write.parquet(path)
    seen = pages.sparkSession.read.schema(made.schema).parquet(path)

    state = F.when(F.col("broken").isNull(), F.col("submission_status")).alias("submission_status")
    after = finish_submissions(submissions, seen.select(SITE_ID, "date_visited", state), "date_visited")
    found = seen.filter("names IS NOT NULL").select(F.explode("names.user_name").alias("user_name"))
    kept = seen.filter("content IS NOT NULL").select(F.col(SITE_ID), "content", "date_visited")
    known = submissions.select(SITE_ID, "submission_id").dropDuplicates([SITE_ID])
    stored = kept.select(SITE_ID, "content", "date_visited").join(known, SITE_ID)
    unread = seen.filter("broken IS NOT NULL").select(SITE_ID, "date_visited", F.col("broken").alias("role"))
    return Visit(
        after,
        insert_ignore_users(found, users, date_added),
        webpage_rows(stored, F.col("date_visited")).dropDuplicates(["submission_webpage_id"]),
        unread,
    )
