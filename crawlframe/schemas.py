"""Schemas and closed value domains of the six crawl tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SITE_ID = "site_submission_id"

# The closed string domains of the status columns.
SUBMISSION_STATUS = ("unknown", "exists", "deleted", "gdpr_deleted")
PROCESSED_STATUS = ("todo", "finished", "error")
ENCODING_STATUS = ("decoded_ok", "unicode_decode_error")
ARCHIVE_STATUS = ("present", "deleted", "cloudflare", "maintenance", "unknown")
SUBMISSION_TYPE = ("art", "flash", "music", "story", "photos", "poetry")


def _schema(spec: str) -> T.StructType:
    """``name type`` pairs, one per comma; a trailing ``?`` makes it nullable."""
    struct = T.StructType()
    for field in spec.split(","):
        name, kind = field.split()
        struct.add(name, kind.rstrip("?"), nullable=kind.endswith("?"))
    return struct


TABLES: dict[str, T.StructType] = {
    "submission": _schema(
        "submission_id long, site_submission_id long, date_visited timestamp,"
        "submission_status string, processed_status string, claimed_by string"
    ),
    "submission_webpage": _schema(
        "submission_webpage_id long, submission_id long, date_visited timestamp,"
        "raw_compressed_webpage_data binary, encoding_status string,"
        "original_data_sha512 string, compressed_data_sha512 string"
    ),
    "user": _schema("user_id long, date_added timestamp, user_name string"),
    "scrape_attempt": _schema(
        "scrape_attempt_id long, site_submission_id long, date_visited timestamp,"
        "processed_status string, claimed_by string, error_string string?"
    ),
    "scrape_content": _schema(
        "content_id long, attempt_id long, content_length long,"
        "content_sha512 string, content_binary binary?"
    ),
    "hole_status": _schema(
        "item_id long, run_id long, processed_status string, file_path string,"
        "warc_sha512 string?, submission_status string"
    ),
}

# Which domain each status column is held to.
DOMAINS: dict[tuple[str, str], tuple[str, ...]] = {
    ("submission", "submission_status"): SUBMISSION_STATUS,
    ("submission", "processed_status"): PROCESSED_STATUS,
    ("submission_webpage", "encoding_status"): ENCODING_STATUS,
    ("scrape_attempt", "processed_status"): PROCESSED_STATUS,
    ("hole_status", "processed_status"): PROCESSED_STATUS,
    ("hole_status", "submission_status"): ARCHIVE_STATUS,
}


def assert_domain(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose ``column`` is null or outside ``values``; empty means valid."""
    value = F.col(column)
    return df.filter(value.isNull() | ~value.isin(*values))


def domain_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows of ``table`` breaking any status domain or not-null rule, in one scan."""
    bad = [
        F.col(field.name).isNull()
        for field in TABLES[table].fields
        if not field.nullable and field.name in df.columns
    ]
    bad += [
        ~F.col(column).isin(*values)
        for (owner, column), values in DOMAINS.items()
        if owner == table and column in df.columns
    ]
    broken = F.lit(False)
    for rule in bad:
        broken = broken | F.coalesce(rule, F.lit(False))
    return df.filter(broken)
