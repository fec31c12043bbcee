"""Parsed pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlframe.functions.urls import username_from_url
from crawlframe.operators import pages as P
from crawlframe.plans.discovery import discover_users, unread_pages
from crawlframe.plans.visit import visit_pages
from workload import frames
from workload.frames import ROOT_USERS, with_tables
from workload.registry import query


def _mentions(role: str | None = None) -> str:
    where = f"WHERE role = '{role}'" if role else ""
    return with_tables(
        f"SELECT page_id, role, user_name FROM expected_mention {where}",
        "link", "expected_mention",
    )


@query(
    "select_elements",
    """
    WITH found AS (
      SELECT page_id, unnest(range(len(hs))) AS pos, hs, ts
      FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hs,
                   regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS ts
            FROM pages))
    SELECT page_id, pos, 'a' AS tag, hs[pos + 1] AS href, ts[pos + 1] AS text FROM found""",
)
def select_elements(spark, d):
    """Links in the navigation of the given pages."""
    found = P.select_elements(frames.wide_table(spark, d, "pages"), {"nav": "nav li > a[href]"})
    return found.select("page_id", "pos", "tag", F.col("attrs")["href"].alias("href"), "text")


@query(
    "expect_matches",
    """
    SELECT page_id, 'artist' AS selector, CAST(0 AS BIGINT) AS n_found,
           CAST(1 AS BIGINT) AS n_expected
    FROM pages WHERE page_id % 10 IN (1, 2)""",
)
def expect(spark, d):
    parsed = P.with_elements(frames.site_pages(spark, d), {"artist": P.SELECT_ARTIST})
    return P.expect_matches(parsed, "artist", 1)[1]


@query("artist_username", _mentions("artist"))
def artist(spark, d):
    return P.artist_username(frames.site_pages(spark, d))


@query("commenter_usernames", _mentions("commenter"))
def commenters(spark, d):
    return P.commenter_usernames(frames.site_pages(spark, d))



@query("icon_usernames", _mentions("icon"))
def icons(spark, d):
    return P.icon_usernames(frames.site_pages(spark, d))


@query("link_usernames", _mentions("link"))
def link_names(spark, d):
    return P.link_usernames(frames.site_pages(spark, d))


@query("autolink_usernames", _mentions("autolink"))
def autolinks(spark, d):
    return P.autolink_usernames(frames.site_pages(spark, d))


@query("extract_mentions", _mentions())
def mentions(spark, d):
    return P.extract_mentions(frames.site_pages(spark, d))


@query(
    "link_mismatches",
    with_tables(
        f"""
        SELECT page_id, 'link' AS role, CAST(1 AS BIGINT) AS n_mismatches
        FROM pages WHERE page_id % 10 NOT IN (1, 2)
        UNION ALL
        SELECT page_id, 'icon', count(*) FROM link
        WHERE page_id % 10 NOT IN (1, 2)
          AND NOT regexp_matches('/user' || href, '^/user/({frames._NAME})/?$')
        GROUP BY page_id""",
        "link",
    ),
)
def mismatches(spark, d):
    parsed = P.with_elements(frames.site_pages(spark, d), P.extractor_selectors(P.EXTRACTORS))
    return P.link_mismatches(parsed)


@query(
    "register_extractor",
    with_tables(
        """
        SELECT page_id, role, user_name FROM expected_mention
        UNION SELECT page_id, 'nav', user_name FROM nav WHERE page_id % 10 NOT IN (1, 2)""",
        "link", "nav", "expected_mention",
    ),
)
def registered(spark, d):
    """The five extractors and one more."""
    nav = P.Extractor(
        "nav", "nav a", lambda e, _: username_from_url(e["attrs"]["href"], ROOT_USERS)
    )
    return P.extract_mentions(frames.site_pages(spark, d), P.register_extractor(nav))


@query(
    "frontpage_latest_id",
    """
    SELECT page_id, CASE WHEN page_id % 10 NOT IN (1, 2) THEN page_id % 1000 END AS site_id
    FROM pages""",
)
def frontpage(spark, d):
    return P.frontpage_latest_id(frames.site_pages(spark, d))


@query(
    "page_status",
    """
    SELECT page_id, CASE page_id % 10 WHEN 1 THEN 'deleted' WHEN 2 THEN 'gdpr_deleted'
                    ELSE 'exists' END AS submission_status
    FROM pages""",
)
def status(spark, d):
    return P.page_status(frames.site_pages(spark, d))


@query(
    "page_user_discovery",
    with_tables(
        """
        SELECT DISTINCT user_name FROM expected_mention
        WHERE user_name NOT IN (SELECT user_name FROM known)""",
        "link", "nav", "known", "expected_mention",
    ),
)
def discovery(spark, d):
    """The whole flow from page bytes: decode, classify, extract, keep what is new."""
    pages = frames.site_pages(spark, d).select("page_id", F.encode("html", "UTF-8").alias("content"))
    added = discover_users(
        pages, frames.known_users(spark, d), F.lit("2025-01-01").cast("timestamp_ntz")
    )
    return added.select("user_name")


@query(
    "unread_pages",
    "SELECT page_id, 'tagline' AS role FROM pages WHERE page_id % 10 NOT IN (1, 2) AND page_id % 7 <> 0",
)
def unread(spark, d):
    """Pages that exist but break a registered rule: every page should name commenter page-0."""
    pages = frames.site_pages(spark, d).select("page_id", F.encode("html", "UTF-8").alias("content"))
    rule = P.Extractor("tagline", P.SELECT_COMMENTER, _only_zero, required=True)
    return unread_pages(pages, P.register_extractor(rule))


def _only_zero(element, profile):
    """The element's name, null for the numbered names that are not page-0."""
    name = P.name_from_text(element, profile)
    return F.when(name.rlike("^page-[1-6]$"), F.lit(None)).otherwise(name)


VISITED = """
    visited AS (SELECT page_id * 4 AS site_submission_id, page_id,
                       CASE page_id % 10 WHEN 1 THEN 'deleted' WHEN 2 THEN 'gdpr_deleted' ELSE 'exists' END AS state
                FROM pages)"""


def _visit(spark, d):
    """Every page fetched as that of the item of its number times four; names in the pages are new."""
    pages = frames.site_pages(spark, d).select(
        (F.col("page_id") * 4).alias("site_submission_id"),
        F.lit("2025-01-01").cast("timestamp").alias("date_visited"),
        F.encode("html", "UTF-8").alias("content"),
    )
    rule = P.Extractor("tagline", P.SELECT_COMMENTER, _only_zero, required=True)
    when = F.lit("2025-01-01").cast("timestamp_ntz")
    return visit_pages(pages, frames.all_submissions(spark, d), frames.known_users(spark, d), when, P.register_extractor(rule))


@query(
    "visit_submissions",
    with_tables(
        f"""
        , {VISITED}
        SELECT site_submission_id, CASE WHEN hit THEN state ELSE submission_status END AS submission_status,
               CASE WHEN hit THEN 'finished' ELSE processed_status END AS processed_status
        FROM (SELECT submission.*, state, processed_status <> 'finished' AND page_id IS NOT NULL
                     AND (state <> 'exists' OR page_id % 7 = 0) AS hit
              FROM submission LEFT JOIN visited USING (site_submission_id))""",
        "every_submission",
    ),
)
def visit_submissions(spark, d):
    """The submission table after the visit: unread pages leave their ids open."""
    return _visit(spark, d).submissions.select("site_submission_id", "submission_status", "processed_status")


@query(
    "visit_users",
    with_tables(
        """
        SELECT DISTINCT user_name FROM expected_mention
        WHERE page_id % 7 = 0 AND user_name IS NOT NULL AND user_name NOT IN (SELECT user_name FROM known)""",
        "link", "nav", "known", "expected_mention",
    ),
)
def visit_users(spark, d):
    return _visit(spark, d).users.select("user_name")


@query(
    "visit_webpages",
    with_tables(
        f"""
        , {VISITED}
        SELECT submission_id, 'decoded_ok' AS encoding_status
        FROM submission JOIN visited USING (site_submission_id) WHERE state = 'exists' AND page_id % 7 = 0""",
        "every_submission",
    ),
)
def visit_webpages(spark, d):
    """Page rows of usable pages alone."""
    return _visit(spark, d).webpages.select("submission_id", "encoding_status")
