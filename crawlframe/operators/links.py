"""Links taken from raw HTML by regular expression, without parsing the page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.urls import is_accepted, username_from_url
from crawlframe.profile import SiteProfile

# Double-quoted href of a plain anchor.
ANCHOR_HREF = r'<a\s[^>]*?href="([^"]*)"'


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(ANCHOR_HREF), F.lit(1))


def page_links(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """``page, pos, href`` of every plain anchor.

    For pages whose markup is regular; anchors inside scripts or comments are
    taken too.  Use :mod:`crawlframe.operators.pages` for anything else.
    """
    return pages.select(page, F.posexplode(hrefs(F.col(html))).alias("pos", "href"))


def accept_links(links: DataFrame, accept_regex: str, url: str = "url") -> DataFrame:
    return links.filter(is_accepted(F.col(url), accept_regex))


def link_users(
    links: DataFrame, profile: SiteProfile = SiteProfile(), role: str = "nav", page: str = "page_id"
) -> DataFrame:
    """``page, role, user_name`` of the links that name a user."""
    name = username_from_url(F.col("href"), profile)
    return links.select(page, F.lit(role).alias("role"), name.alias("user_name")).filter(
        F.col("user_name").isNotNull()
    )
