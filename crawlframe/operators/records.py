"""Choosing records of an archive and judging the archive by them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.content import decode_page
from crawlframe.functions.headers import warcinfo_entries, warcinfo_fields, warcinfo_map
from crawlframe.functions.markup import find_elements, plan_selectors
from crawlframe.operators.pages import ELEMENT, ELEMENTS, STATUS_SELECTORS, page_status_of
from crawlframe.profile import SiteProfile
from crawlframe.sources.archives import with_records
from crawlframe.sources.warc_format import DAMAGE, iter_records, payload_or_none, plain_bytes
from crawlframe.sources.warc_source import read_ranges

WARCINFO, RESPONSE = "warcinfo", "response"
# What was found goes back to Spark in batches of about this many characters of pages.
_OUTPUT_CHARS = 1 << 20


def is_warcinfo(record: Column) -> Column:
    return record["warc_type"] == WARCINFO


def is_main_response(record: Column, profile: SiteProfile = SiteProfile()) -> Column:
    """A response whose target starts with the address of an item page."""
    return (record["warc_type"] == RESPONSE) & record["warc_target_uri"].rlike(
        profile.main_page_pattern
    )


def first_record(predicate: Callable[[Column], Column]) -> Column:
    """First struct of ``records`` (file order) for which ``predicate`` holds, or null."""
    return F.try_element_at(F.filter("records", predicate), F.lit(1))


def first_record_where(
    records: DataFrame, predicate: Column, file: str = "path", position: str = "position"
) -> DataFrame:
    """First record per file, by position, with ``predicate``; nulls without one.

    For record tables with one row per record.  ``predicate`` is any boolean
    column of the table.  Every file keeps its row.
    """
    others = [name for name in records.columns if name != file]
    first = F.min_by(F.when(predicate, F.struct(*others)), F.when(predicate, F.col(position)))
    return records.groupBy(file).agg(first.alias("_first")).select(file, "_first.*")


def main_response(records: DataFrame, profile: SiteProfile = SiteProfile()) -> DataFrame:
    """All records that are the main response of their file."""
    return records.filter(
        (F.col("warc_type") == RESPONSE)
        & F.col("warc_target_uri").rlike(profile.main_page_pattern)
    )


def warcinfo_headers(blocks: DataFrame, key: str, text: str, trim_values: bool = False) -> DataFrame:
    """``key, header, value`` rows of ``warcinfo`` blocks."""
    entries = warcinfo_entries(F.col(text), trim_values)
    return blocks.select(key, F.inline(entries).alias("header", "value"))


def parse_archives(files: DataFrame, profile: SiteProfile = SiteProfile()) -> DataFrame:
    """One row per archive file: its headers and the bytes of its main page.

    ``path, error, sha512, attempt_id, site_submission_id, visited_text, worker,
    main_uri, page_bytes``.  Blocks of other records never leave the parser.
    """
    parsed = with_records(
        files, (WARCINFO, RESPONSE), block_uri=profile.main_page_pattern, http_payload=True
    )
    info = first_record(is_warcinfo)["block"]
    main = first_record(lambda r: is_main_response(r, profile))
    return (
        parsed.select("path", "error", "sha512", info.alias("_info"), main.alias("_main"))
        .withColumn("_info", decode_page(F.col("_info")))
        .withColumn("_fields", warcinfo_fields(warcinfo_map(F.col("_info")), profile))
        .select(
            "path",
            "error",
            "sha512",
            "_fields.*",
            F.col("_main.warc_target_uri").alias("main_uri"),
            F.col("_main.block").alias("page_bytes"),
        )
    )


PageOf = Callable[[pa.RecordBatch], Iterator[tuple[str, str | None, bytes | None, int]]]


def _judged(
    rows: DataFrame, pages: PageOf, cloudflare: str | None, maintenance: str | None
) -> DataFrame:
    """``path, sha512, submission_status, n_read`` of the main pages that ``pages`` finds in a batch.

    One Python pass: page bytes are found, unpacked and matched where they
    are; only matched elements, and the text where a pattern asks for it, come back.
    """
    plan, with_text = plan_selectors(STATUS_SELECTORS), bool(cloudflare or maintenance)
    kinds = pa.schema(
        [("path", pa.string()), ("sha512", pa.string()), ("n_read", pa.int64()), ("html", pa.string()), ("elements", pa.list_(ELEMENT))]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = [], 0
            for path, digest, page, size in pages(batch):
                html = None if page is None else page.decode("utf-8", "backslashreplace")
                elements = None if html is None else find_elements(html, plan)
                found.append({"path": path, "sha512": digest, "n_read": size, "html": html if with_text else None, "elements": elements})
                held += len(html or "")
                if held > _OUTPUT_CHARS:
                    yield pa.RecordBatch.from_pylist(found, schema=kinds)
                    found, held = [], 0
            yield pa.RecordBatch.from_pylist(found, schema=kinds)

    parsed = rows.mapInArrow(judge, f"path string, sha512 string, n_read long, html string, elements {ELEMENTS}")
    state, text = page_status_of(), F.col("html")
    verdict = F.when(F.col("elements").isNull(), "unknown")
    if cloudflare:
        verdict = verdict.when(text.rlike(cloudflare), "cloudflare")
    if maintenance:
        verdict = verdict.when(text.rlike(maintenance), "maintenance")
    verdict = verdict.when(state.isin("deleted", "gdpr_deleted"), "deleted").otherwise("present")
    return parsed.select("path", "sha512", verdict.alias("submission_status"), "n_read")


def hole_verdict(
    files: DataFrame,
    profile: SiteProfile = SiteProfile(),
    cloudflare: str | None = None,
    maintenance: str | None = None,
) -> DataFrame:
    """``path, sha512, submission_status``: what each archive holds of its item.

    ``unknown`` without a readable main page; ``deleted`` for both kinds of
    removed item; ``cloudflare`` and ``maintenance`` for pages that match the
    caller's patterns (tested first; there are no default ones); else
    ``present``.
    """
    address = re.compile(profile.main_page_pattern)

    def pages(batch: pa.RecordBatch) -> Iterator[tuple[str, str | None, bytes | None, int]]:
        for path, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            stored = blob.as_py() or b""
            page = None
            try:
                data = plain_bytes(stored)
                for _, headers, start, length in iter_records(data):
                    if headers.get("warc-type") == RESPONSE and address.match(headers.get("warc-target-uri", "")):
                        page = payload_or_none(data[start : start + length])
                        break
            except DAMAGE:
                pass
            yield path, hashlib.sha512(stored).hexdigest(), page, len(stored)

    return _judged(files.select("path", "content"), pages, cloudflare, maintenance).drop("n_read")


def indexed_verdict(
    index: DataFrame,
    profile: SiteProfile = SiteProfile(),
    cloudflare: str | None = None,
    maintenance: str | None = None,
) -> DataFrame:
    """:func:`hole_verdict` of the archives of an index, with ``n_read``.

    The main page is chosen in the index; of each archive nothing but that
    record's byte range is opened.
    """
    main = first_record(lambda record: is_main_response(record, profile))

    def pages(batch: pa.RecordBatch) -> Iterator[tuple[str, str | None, bytes | None, int]]:
        for path, digest, record in zip(*(column.to_pylist() for column in batch.columns)):
            (block,), size = read_ranges(path, [record])
            yield path, digest, None if block is None else payload_or_none(block), size

    return _judged(index.select("path", "sha512", main.alias("record")), pages, cloudflare, maintenance)
