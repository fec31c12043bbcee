"""Names, ids and paths found in or rendered to strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.functions.text import first_group
from crawlframe.profile import ARCHIVE_STEM, VIEW_ID_PATTERN, SiteProfile


def username_from_url(url: Column, profile: SiteProfile = SiteProfile()) -> Column:
    """User name in a relative or absolute user link; null for any other link.

    The case of the name is kept.
    """
    return first_group(url, profile.user_pattern, 2)


def view_id_from_href(href: Column, pattern: str = VIEW_ID_PATTERN) -> Column:
    """Number in the first match of ``pattern`` anywhere in the link, or null.

    Digits that do not fit a long give null instead of failing the job.
    """
    return first_group(href, pattern).try_cast("long")


def is_accepted(url: Column, accept_regex: str) -> Column:
    """Unanchored allow-list test for outlinks and page requisites."""
    return url.rlike(accept_regex)


def submission_url(site_id: Column, profile: SiteProfile = SiteProfile()) -> Column:
    return F.format_string(profile.submission_url_format, site_id.cast("long"))


def worker_identity(host: Column, pid: Column, version: Column) -> Column:
    return F.format_string(
        "FQDN[%s]-PID[%s]-VER[%s]", host, pid.cast("string"), version
    )


def parse_worker_identity(identity: Column) -> Column:
    """``struct<host,pid,version>``; parts that are missing are null."""
    return F.struct(
        first_group(identity, r"FQDN\[([^\]]*)\]").alias("host"),
        first_group(identity, r"PID\[([0-9]+)\]").try_cast("long").alias("pid"),
        first_group(identity, r"VER\[([^\]]*)\]").alias("version"),
    )


def sha_prefix(sha: Column) -> Column:
    """The three hex digits that name a blob's folder (4,096 folders)."""
    return F.substring(sha, 1, 3)


def warc_name(site_id: Column, attempt_id: Column, stem: str = ARCHIVE_STEM) -> Column:
    return F.format_string(
        f"{stem}_sid-%d_aid-%d.warc", site_id.cast("long"), attempt_id.cast("long")
    )


def blob_name(content_id: Column, attempt_id: Column, stem: str = ARCHIVE_STEM) -> Column:
    return F.format_string(
        f"{stem}_cid-%d_aid-%d.tar.xz", content_id.cast("long"), attempt_id.cast("long")
    )


def blob_path(sha: Column, content_id: Column, attempt_id: Column, prefix: str = "") -> Column:
    """``[prefix/]<sha[0:3]>/<blob name>``."""
    parts = [sha_prefix(sha), blob_name(content_id, attempt_id)]
    if prefix:
        parts.insert(0, F.lit(prefix.rstrip("/")))
    return F.concat_ws("/", *parts)


def parse_archive_path(path: Column, stem: str = ARCHIVE_STEM) -> Column:
    """Inverse of the name builders: ``struct<sha_prefix,site_id,content_id,attempt_id>``."""

    def number(pattern: str) -> Column:
        return first_group(path, pattern).try_cast("long")

    return F.struct(
        first_group(path, rf"([0-9a-f]{{3}})/{stem}_[^/]*$").alias("sha_prefix"),
        number(rf"{stem}_sid-([0-9]+)_aid-[0-9]+\.warc$").alias("site_id"),
        number(rf"{stem}_cid-([0-9]+)_aid-[0-9]+\.tar\.xz$").alias("content_id"),
        number(rf"{stem}_[sc]id-[0-9]+_aid-([0-9]+)\.(?:warc|tar\.xz)$").alias("attempt_id"),
    )
