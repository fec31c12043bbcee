"""``warcinfo`` header blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.functions.text import strip
from crawlframe.functions.urls import parse_worker_identity
from crawlframe.profile import SiteProfile


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def warcinfo_entries(text: Column, trim_values: bool = False) -> Column:
    """``array<struct<key,value>>`` of a header block, in order of first mention of a key.

    Lines end at ``\\n`` and are stripped; reading stops at the first blank
    line; lines without a colon are skipped; the value starts right after the
    first colon, its leading space included (``trim_values`` strips it); the last of
    several equal keys wins.
    """

    def before_blank(lines: Column) -> Column:
        blank = F.array_position(lines, "").cast("int")
        return F.when(blank > 0, F.slice(lines, F.lit(1), blank - 1)).otherwise(lines)

    def entry(line: Column) -> Column:
        value = F.regexp_replace(line, r"\A[^:]*:", "")
        return F.struct(
            F.substring_index(line, ":", 1).alias("key"),
            (strip(value) if trim_values else value).alias("value"),
        )

    def last_per_key(entries: Column) -> Column:
        return F.transform(
            F.array_distinct(F.transform(entries, lambda e: e["key"])),
            lambda key: F.element_at(F.filter(entries, lambda e: e["key"] == key), -1),
        )

    head = _let(F.transform(F.split(text, "\n"), strip), before_blank)
    usable = F.filter(head, lambda line: F.instr(line, ":") > 0)
    return _let(F.transform(usable, entry), last_per_key)


def warcinfo_map(text: Column, trim_values: bool = False) -> Column:
    return F.map_from_entries(warcinfo_entries(text, trim_values))


def warcinfo_fields(headers: Column, profile: SiteProfile = SiteProfile()) -> Column:
    """Typed ``struct<attempt_id,site_submission_id,visited_text,worker>`` of a header map."""

    def value(name: str) -> Column:
        return strip(F.try_element_at(headers, F.lit(name)))

    return F.struct(
        value(profile.attempt_id_header).try_cast("long").alias("attempt_id"),
        value(profile.submission_header).try_cast("long").alias("site_submission_id"),
        value("date").alias("visited_text"),
        parse_worker_identity(value("program_identity_string")).alias("worker"),
    )
