"""Pages to users: decode, classify, extract, keep what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.content import decode_page, encoding_status
from crawlframe.operators.content import compress_and_digest
from crawlframe.operators.links import link_users, page_links
from crawlframe.operators.names import insert_ignore_users, new_users
from crawlframe.operators.pages import (
    EXTRACTORS,
    STATUS_SELECTORS,
    Extractor,
    extractor_selectors,
    mention_errors,
    mentions_of,
    page_status_of,
    with_elements,
)
from crawlframe.profile import SiteProfile
from crawlframe.sources.tables import with_surrogate_key


def discover_link_users(
    pages: DataFrame, users: DataFrame, profile: SiteProfile = SiteProfile()
) -> DataFrame:
    """New names in the plain links of pages; built-in expressions only."""
    return new_users(link_users(page_links(pages), profile), users)


def classified_pages(
    pages: DataFrame,
    extractors: tuple[Extractor, ...] = EXTRACTORS,
    page: str = "page_id",
    content: str = "content",
) -> DataFrame:
    """``page, elements, submission_status`` of raw page bytes, parsed once."""
    decoded = pages.select(page, decode_page(F.col(content)).alias("html"))
    selectors = {**STATUS_SELECTORS, **extractor_selectors(extractors)}
    parsed = with_elements(decoded, selectors, page, "html")
    return parsed.withColumn("submission_status", page_status_of())


def discover_users(
    pages: DataFrame,
    users: DataFrame,
    date_added: Column,
    extractors: tuple[Extractor, ...] = EXTRACTORS,
    profile: SiteProfile = SiteProfile(),
) -> DataFrame:
    """User rows to append for the pages that exist.

    Pages that break a rule of an extractor give no rows;
    :func:`unread_pages` lists them.
    """
    existing = classified_pages(pages, extractors).filter(
        F.col("submission_status") == "exists"
    )
    found = mentions_of(existing, extractors, profile)
    return insert_ignore_users(found, users, date_added)


def unread_pages(
    pages: DataFrame,
    extractors: tuple[Extractor, ...] = EXTRACTORS,
    profile: SiteProfile = SiteProfile(),
) -> DataFrame:
    """``page_id, role``: pages that exist but break a rule, which :func:`discover_users` leaves out."""
    existing = classified_pages(pages, extractors).filter(
        F.col("submission_status") == "exists"
    )
    return mention_errors(existing, extractors, profile)


def webpage_rows(pages: DataFrame, visited_at: Column) -> DataFrame:
    """``submission_webpage`` rows for ``submission_id, content`` pages."""
    packed = compress_and_digest(
        pages.withColumn("encoding_status", encoding_status(F.col("content")))
    ).select(
        "submission_id",
        visited_at.alias("date_visited"),
        F.col("compressed_data").alias("raw_compressed_webpage_data"),
        "encoding_status",
        "original_data_sha512",
        "compressed_data_sha512",
    )
    return with_surrogate_key(
        packed, "submission_webpage_id", natural_key=["submission_id", "original_data_sha512"]
    )
