"""What a page holds: elements, state, mentioned users, the newest id."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.markup import find_elements, plan_selectors
from crawlframe.functions.pieces import pieces
from crawlframe.functions.text import strip
from crawlframe.functions.urls import username_from_url, view_id_from_href
from crawlframe.profile import (
    DELETED_TEXT,
    SELECT_ARTIST,
    SELECT_AUTOLINK,
    SELECT_COMMENTER,
    SELECT_FRONTPAGE,
    SELECT_GDPR,
    SELECT_ICON,
    SELECT_LINK,
    SELECT_SECTION,
    VIEW_ID_PATTERN,
    SiteProfile,
)

ELEMENT = pa.struct(
    [
        ("selector", pa.string()),
        ("pos", pa.int64()),
        ("tag", pa.string()),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("text", pa.string()),
    ]
)
ELEMENTS = (
    "array<struct<selector: string, pos: bigint, tag: string,"
    " attrs: map<string, string>, text: string>>"
)
STATUS_SELECTORS = {"section": SELECT_SECTION, "gdpr": SELECT_GDPR}


def with_elements(
    pages: DataFrame, selectors: dict[str, str], page: str = "page_id", html: str = "html"
) -> DataFrame:
    """``page, elements``: all matches of all (named) selectors, one row per page.

    The page is parsed once for all selectors and everything read from it
    later is a column expression on ``elements``, so nothing is shuffled.  The
    elements of about a megabyte of pages go back at a time: as Python objects
    they take many times the space of their pages.
    """
    plan = plan_selectors(selectors)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            found = [
                None if html is None else find_elements(html, plan)
                for html in (cell.as_py() for cell in batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(ELEMENT))], names=[page, "elements"]
            )

    kind = pages.schema[page].dataType.simpleString()
    return pages.select(page, html).mapInArrow(parse, f"`{page}` {kind}, elements {ELEMENTS}")


def matching(name: str) -> Column:
    """The elements one named selector found."""
    return F.filter("elements", lambda e: e["selector"] == name)


def select_elements(
    pages: DataFrame, selectors: dict[str, str], page: str = "page_id", html: str = "html"
) -> DataFrame:
    """``page, selector, pos, tag, attrs, text``: one row per match."""
    return with_elements(pages, selectors, page, html).select(page, F.inline("elements"))


def expect_matches(
    parsed: DataFrame, name: str, expected: int = -1, page: str = "page_id"
) -> tuple[DataFrame, DataFrame]:
    """``(pages as expected, quarantine)`` by the number of matches; -1 accepts any.

    The quarantine has ``page, selector, n_found, n_expected``.
    """
    found = F.size(matching(name)).cast("long")
    if expected == -1:
        wrong = F.lit(False)
    else:
        wrong = found != expected
    quarantine = parsed.filter(wrong).select(
        page,
        F.lit(name).alias("selector"),
        found.alias("n_found"),
        F.lit(expected).cast("long").alias("n_expected"),
    )
    return parsed.filter(~wrong), quarantine


def page_status_of() -> Column:
    """State from ``elements`` found with :data:`STATUS_SELECTORS`, tested in order."""
    first_section = F.try_element_at(matching("section"), F.lit(1))
    deleted = strip(first_section["text"]) == DELETED_TEXT
    return (
        F.when(deleted, "deleted")
        .when(F.size(matching("gdpr")) > 0, "gdpr_deleted")
        .otherwise("exists")
    )


def page_status(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """``page, submission_status``."""
    parsed = with_elements(pages, STATUS_SELECTORS, page, html)
    return parsed.select(page, page_status_of().alias("submission_status"))


@dataclass(frozen=True)
class Extractor:
    """One way in which a page names users.

    ``to_name`` turns the element (a struct column) into a name or null.
    ``expected`` matches must be there, -1 for any number; ``required``
    extractors must also give a name for each match.
    """

    role: str
    selector: str
    to_name: Callable[[Column, SiteProfile], Column]
    expected: int = -1
    required: bool = False
    report_mismatch: bool = True


def name_from_href(element: Column, profile: SiteProfile) -> Column:
    return username_from_url(F.try_element_at(element["attrs"], F.lit("href")), profile)


def name_from_text(element: Column, profile: SiteProfile) -> Column:
    return F.lower(strip(element["text"]))


EXTRACTORS: tuple[Extractor, ...] = (
    Extractor("artist", SELECT_ARTIST, name_from_href, expected=1, required=True),
    Extractor("commenter", SELECT_COMMENTER, name_from_text),
    Extractor("icon", SELECT_ICON, name_from_href),
    Extractor("link", SELECT_LINK, name_from_href),
    Extractor("autolink", SELECT_AUTOLINK, name_from_href, report_mismatch=False),
)


def register_extractor(
    extractor: Extractor, extractors: tuple[Extractor, ...] = EXTRACTORS
) -> tuple[Extractor, ...]:
    """The extractors with one more; roles must differ."""
    if any(extractor.role == known.role for known in extractors):
        raise ValueError(f"role already registered: {extractor.role}")
    return (*extractors, extractor)


def extractor_selectors(extractors: tuple[Extractor, ...]) -> dict[str, str]:
    return {extractor.role: extractor.selector for extractor in extractors}


def broken_rule(extractors: tuple[Extractor, ...], profile: SiteProfile) -> Column:
    """Role of the first extractor whose expectation a page breaks, else null."""
    rule = F.lit(None).cast("string")
    for extractor in reversed(extractors):
        found = matching(extractor.role)
        broken = F.lit(False)
        if extractor.expected != -1:
            broken = broken | (F.size(found) != extractor.expected)
        if extractor.required:
            broken = broken | F.exists(
                found, lambda e: extractor.to_name(e, profile).isNull()
            )
        rule = F.when(broken, extractor.role).otherwise(rule)
    return rule


def named_users(extractors: tuple[Extractor, ...], profile: SiteProfile) -> Column:
    """``array<struct<role,user_name>>`` of a parsed page, each once; names may be null."""
    names = F.concat(
        *[
            F.transform(
                matching(extractor.role),
                lambda e: F.struct(
                    F.lit(extractor.role).alias("role"),
                    extractor.to_name(e, profile).alias("user_name"),
                ),
            )
            for extractor in extractors
        ]
    )
    return F.array_distinct(names)


def mentions_of(
    parsed: DataFrame,
    extractors: tuple[Extractor, ...] = EXTRACTORS,
    profile: SiteProfile = SiteProfile(),
    page: str = "page_id",
) -> DataFrame:
    """``page, role, user_name``, each once per page, from parsed pages.

    Pages that break an extractor's expectation give no rows; see
    :func:`mention_errors`.
    """
    usable = parsed.filter(broken_rule(extractors, profile).isNull())
    return usable.select(page, F.inline(named_users(extractors, profile))).filter(
        F.col("user_name").isNotNull()
    )


def mention_errors(
    parsed: DataFrame,
    extractors: tuple[Extractor, ...] = EXTRACTORS,
    profile: SiteProfile = SiteProfile(),
    page: str = "page_id",
) -> DataFrame:
    """``page, role`` of the pages left out by :func:`mentions_of`."""
    return parsed.select(page, broken_rule(extractors, profile).alias("role")).filter(
        F.col("role").isNotNull()
    )


def link_mismatches(
    parsed: DataFrame,
    extractors: tuple[Extractor, ...] = EXTRACTORS,
    profile: SiteProfile = SiteProfile(),
    page: str = "page_id",
) -> DataFrame:
    """``page, role, n_mismatches``: matched elements that name no user.

    Roles for which mismatches are normal are not reported.
    """
    counted = F.array(
        *[
            F.struct(
                F.lit(x.role).alias("role"),
                F.size(
                    F.filter(matching(x.role), lambda e: x.to_name(e, profile).isNull())
                )
                .cast("long")
                .alias("n_mismatches"),
            )
            for x in extractors
            if x.report_mismatch
        ]
    )
    return parsed.select(page, F.inline(counted)).filter(F.col("n_mismatches") > 0)


def extract_mentions(
    pages: DataFrame,
    extractors: tuple[Extractor, ...] = EXTRACTORS,
    profile: SiteProfile = SiteProfile(),
    page: str = "page_id",
    html: str = "html",
) -> DataFrame:
    """All extractors over all pages in one pass: ``page, role, user_name``."""
    parsed = with_elements(pages, extractor_selectors(extractors), page, html)
    return mentions_of(parsed, extractors, profile, page)


def _one_role(role: str):
    chosen = tuple(x for x in EXTRACTORS if x.role == role)

    def extract(
        pages: DataFrame,
        profile: SiteProfile = SiteProfile(),
        page: str = "page_id",
        html: str = "html",
    ) -> DataFrame:
        return extract_mentions(pages, chosen, profile, page, html)

    extract.__name__ = f"{role}_usernames"
    extract.__doc__ = f"Mentions of role ``{role}`` only."
    return extract


artist_username = _one_role("artist")
commenter_usernames = _one_role("commenter")
icon_usernames = _one_role("icon")
link_usernames = _one_role("link")
autolink_usernames = _one_role("autolink")


def frontpage_latest_id(
    pages: DataFrame,
    page: str = "page_id",
    html: str = "html",
    selector: str = SELECT_FRONTPAGE,
    pattern: str = VIEW_ID_PATTERN,
) -> DataFrame:
    """``page, site_id``: the id in the first gallery link, null without one."""
    parsed = with_elements(pages, {"gallery": selector}, page, html)
    first = F.try_element_at(matching("gallery"), F.lit(1))
    href = F.try_element_at(first["attrs"], F.lit("href"))
    return parsed.select(page, view_id_from_href(href, pattern).alias("site_id"))
