"""Crawl tables derived from the given tables by Spark expressions.

``SQL`` holds the same derivations as common table expressions.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.functions.urls import submission_url, worker_identity
from crawlframe.operators.links import hrefs, link_users, page_links
from crawlframe.profile import DELETED_TEXT, GDPR_BODY_ID, SiteProfile
from crawlframe.session import scratch_path, spread_scan
from crawlframe.sources.warc_format import iter_records

PROFILE = SiteProfile()
# The users linked by the given pages have no folder of their own.
ROOT_USERS = SiteProfile(user_path="/")
ID_IN_URL = "/(?:en|fr|de|es)/([0-9]+)"
ACCEPTED = r"example\.com/.*|/en/"
MOBILE = "https://m."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table for work in Python, over all cores even if it is one small file."""
    key = {"pages": "page_id", "documents": "doc_id"}[name]
    return spread_scan(table(spark, sf_dir, name), key)


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempt_columns(table(spark, sf_dir, "events"))


def attempt_columns(events: DataFrame) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    status = F.when(kind == "error", "error").when(kind == "signup", "todo").otherwise("finished")
    host = F.concat(F.lit("h"), (user % 5).cast("string"))
    return events.select(
        F.col("event_id").alias("scrape_attempt_id"),
        user.alias("site_submission_id"),
        F.col("ts").alias("date_visited"),
        status.alias("processed_status"),
        worker_identity(host, user % 7, F.lit("0.2.8")).alias("claimed_by"),
        F.when(kind == "error", F.col("props")).alias("error_string"),
    )


def day_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts at one id per user and day of the month; only purchases finish."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("scrape_attempt_id"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("site_submission_id"),
        F.col("ts").alias("date_visited"),
        F.when(F.col("event_type") == "purchase", "finished")
        .otherwise("todo")
        .alias("processed_status"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The submissions before some messages come in: every third id has no row yet."""
    return all_submissions(spark, sf_dir).filter(F.col("submission_id") % 3 != 0)


def all_submissions(spark: SparkSession, sf_dir: str, site_id: str = "o_orderkey") -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    digit = F.substring("o_orderpriority", 1, 1)
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").alias("submission_id"),
        F.col(site_id).alias("site_submission_id"),
        F.col("o_orderdate").alias("date_visited"),
        F.when(digit == "1", "unknown")
        .when(digit == "3", "deleted")
        .when(digit == "4", "gdpr_deleted")
        .otherwise("exists")
        .alias("submission_status"),
        F.when(status == "F", "finished")
        .when(status == "O", "todo")
        .otherwise("error")
        .alias("processed_status"),
        F.lit("worker").alias("claimed_by"),
    )


def contents(spark: SparkSession, sf_dir: str, bits: int = 256) -> DataFrame:
    text, doc = F.col("text"), F.col("doc_id")
    blob = F.when(doc % 5 == 0, F.lit(None).cast("binary")).when(
        doc % 5 == 1, F.lit(b"")
    ).otherwise(text.cast("binary"))
    return table(spark, sf_dir, "documents").select(
        doc.alias("content_id"),
        (doc * 11).alias("attempt_id"),
        F.octet_length(text).cast("long").alias("content_length"),
        F.sha2(text, bits).alias("content_sha512"),
        blob.alias("content_binary"),
        "source",
    )


def page_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts as bytes, every 50th with a byte that is not UTF-8."""
    text = F.col("text").cast("binary")
    broken = F.concat(text, F.lit(b"\xff"))
    return wide_table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 50 == 2, broken).otherwise(text).alias("content")
    )


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(table(spark, sf_dir, "pages"))


def nav_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_users(links(spark, sf_dir), ROOT_USERS)


def known_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names linked from the mobile pages: those already have a row."""
    mobile = table(spark, sf_dir, "pages").filter(F.col("url").startswith(MOBILE))
    return link_users(page_links(mobile), ROOT_USERS).select("user_name").distinct()


def message_columns(orders: DataFrame) -> DataFrame:
    """Queue messages: the order key as text, now and then with a stray letter."""
    key = F.col("o_orderkey")
    text = F.when(key % 97 == 0, F.concat(F.lit("x"), key.cast("string"))).otherwise(
        key.cast("string")
    )
    return orders.select(
        key.alias("delivery_tag"),
        text.cast("binary").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_columns(table(spark, sf_dir, "orders"))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("submission_webpage_id"),
        (F.col("doc_id") % 100).alias("submission_id"),
        F.timestamp_seconds("doc_id").alias("date_visited"),
        F.sha2("lang", 256).alias("original_data_sha512"),
    )


def _tags(items: Column, before: str, after: str) -> Column:
    """The items, each between two pieces of markup, as one string."""
    return F.array_join(F.transform(items, lambda i: F.concat(F.lit(before), i, F.lit(after))), "")


def _numbered(before: str, modulus: int, after: str) -> Column:
    return F.concat(
        F.lit(before), (F.col("page_id") % modulus).cast("string"), F.lit(after)
    )


def site_html() -> Column:
    """A page as the site would serve it, around the given page's own markup.

    By the last digit of ``page_id``: 1 a deleted item, 2 a removed account,
    else an item with an artist, user links and two comments.
    """
    domain = PROFILE.domain
    existing = F.concat(
        F.lit('<!DOCTYPE html><html><head><title>Item</title></head><body id="pageid-item">'),
        F.lit('<div class="section-body alt"><div class="wide submission-id-avatar">\n'),
        _numbered('<a href="/user/artist', 37, '/"><img src="a.gif"></a></div>'),
        F.lit('<div class="submission-description">'),
        F.col("html"),
        F.lit("</div>"),
        _tags(hrefs(F.col("html")), '<a class="iconusername" href="/user', '"><img></a>'),
        F.lit('<a href="/user/" class="linkusername">__</a>'),
        _numbered('<p>by <a class="x linkusername" href="/user/Link-', 19, '">L</a>'),
        _numbered(f'<a class=auto_link href="https://www.{domain}/user/auto', 29, '/">A</a>'),
        F.lit('<a class="auto_link" href="https://elsewhere.example/">B</a></p></div>'),
        _numbered('<strong class="comment_username"><h3> \tCommenter', 41, "&nbsp;</h3></strong>"),
        _numbered('<strong class="comment_username"><h3>PAGE&#45;', 7, "</h3></strong>"),
        _numbered('<section id="gallery-frontpage-submissions"><figure><a href="/view/', 1000, '/">'),
        F.lit('<img></a></figure><figure><a href="/view/7/"></a></figure></section></body></html>'),
    )
    deleted = F.concat(
        F.lit(f'<html><body><div class="section-body">\n {DELETED_TEXT}\n</div>'),
        F.col("html"),
        F.lit("</body></html>"),
    )
    removed = F.concat(F.lit(f'<html><body id="{GDPR_BODY_ID}">'), F.col("html"))
    return (
        F.when(F.col("page_id") % 10 == 1, deleted)
        .when(F.col("page_id") % 10 == 2, removed)
        .otherwise(existing)
    )


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_table(spark, sf_dir, "pages").select("page_id", site_html().alias("html"))


def _record(kind: str, uri: Column | None, content_type: str, block: Column) -> Column:
    head = [
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{kind}:"),
        F.col("page_id").cast("string"),
        F.lit(f">\r\nContent-Type: {content_type}\r\n"),
    ]
    if uri is not None:
        head += [F.lit("WARC-Target-URI: "), uri, F.lit("\r\n")]
    size = F.octet_length(block).cast("string")
    return F.concat(*head, F.lit("Content-Length: "), size, F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n"))


def warcinfo_text() -> Column:
    number = F.col("page_id").cast("string")
    return F.concat(
        F.lit("software: Crawler/1.0 (linux)\r\nnot a header\r\nwget-arguments: \"-e\" \"a:b\"\r\n"),
        F.lit(f"{PROFILE.attempt_id_header}: 1\r\n{PROFILE.attempt_id_header}: "),
        number,
        F.lit(f"\r\ndate: 2023-05-17T08:31:12+00:00\r\n{PROFILE.submission_header}: "),
        number,
        F.lit("\r\nprogram_identity_string: FQDN[host-"),
        (F.col("page_id") % 5).cast("string"),
        F.lit("]-PID[55]-VER[0.2.7]\r\n\r\nlate: value\r\n"),
    )


def warc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive per page: header record, request, response.

    Where ``page_id`` ends in 0 the response is an image, not the item page.
    """
    image = F.concat(F.lit("https://d.gallery.example/art/"), F.col("page_id").cast("string"))
    item = submission_url(F.col("page_id"), PROFILE)
    target = F.when(F.col("page_id") % 10 == 0, image).otherwise(item)
    body = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"), F.col("html")
    )
    request = F.lit("GET / HTTP/1.1\r\nHost: www.gallery.example\r\n\r\n")
    archive = F.concat(
        _record("warcinfo", None, "application/warc-fields", warcinfo_text()),
        _record("request", target, "application/http; msgtype=request", request),
        _record("response", target, "application/http; msgtype=response", body),
    )
    return site_pages(spark, sf_dir).select(
        F.format_string("/archive/%d.warc", "page_id").alias("path"),
        archive.cast("binary").alias("content"),
    )


PAGES_PER_ARCHIVE = 40


def archive_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of archives of :data:`PAGES_PER_ARCHIVE` pages each, written by the tasks.

    Every second one is stored with a gzip member per record.
    """
    root = scratch_path(spark, "archives")
    number = F.expr(f"page_id div {PAGES_PER_ARCHIVE}")
    pages = warc_files(spark, sf_dir).select(
        F.regexp_extract("path", "([0-9]+)", 1).cast("long").alias("page_id"), "content"
    )
    joined = pages.groupBy(number.alias("number")).agg(
        F.expr("listagg(content) WITHIN GROUP (ORDER BY page_id)").alias("content")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            system.create_dir(base, recursive=True)
            for one, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = f"{one}.warc"
                if one % 2:
                    begins = [at for at, _, _, _ in iter_records(content)] + [len(content)]
                    content = b"".join(gzip.compress(content[a:b], 1) for a, b in zip(begins, begins[1:]))
                    name += ".gz"
                with system.open_output_stream(f"{base}/{name}", compression=None) as out:
                    out.write(content)
            yield batch.select(["number"])

    joined.mapInArrow(write, "number long").write.format("noop").mode("overwrite").save()
    return root


_NAME = r"[a-zA-Z0-9_\-~.`\[\]^]+"

# The same tables for the oracle.
SQL: dict[str, str] = {
    "attempt": """
        attempt AS (
          SELECT event_id AS scrape_attempt_id, user_id AS site_submission_id,
                 ts AS date_visited,
                 CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'todo'
                      ELSE 'finished' END AS processed_status,
                 'FQDN[h' || (user_id % 5) || ']-PID[' || (user_id % 7) || ']-VER[0.2.8]'
                   AS claimed_by,
                 CASE WHEN event_type = 'error' THEN props END AS error_string
          FROM events)""",
    "submission": """
        submission AS (
          SELECT o_orderkey AS submission_id, o_orderkey AS site_submission_id, o_custkey,
                 o_orderdate AS date_visited,
                 CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'unknown' WHEN '3' THEN 'deleted'
                      WHEN '4' THEN 'gdpr_deleted' ELSE 'exists' END AS submission_status,
                 CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'todo'
                      ELSE 'error' END AS processed_status
          FROM orders WHERE o_orderkey % 3 <> 0)""",
    "content": """
        content AS (
          SELECT doc_id AS content_id, doc_id * 11 AS attempt_id,
                 strlen(text) AS content_length, sha256(text) AS content_sha512,
                 CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE text END
                   AS payload,
                 source
          FROM documents)""",
    "link": """
        link AS (
          SELECT page_id, pos, hs[pos + 1] AS href
          FROM (SELECT page_id, hs, unnest(range(len(hs))) AS pos
                FROM (SELECT page_id,
                             regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1) AS hs
                      FROM pages)))""",
    "nav": f"""
        nav AS (
          SELECT page_id, 'nav' AS role, user_name
          FROM (SELECT page_id,
                       coalesce(
                         nullif(regexp_extract(href, '^/({_NAME})/?$', 1), ''),
                         nullif(regexp_extract(
                           href, '^https?://(www.)?gallery.example/({_NAME})/?$', 2), '')
                       ) AS user_name
                FROM link)
          WHERE user_name IS NOT NULL)""",
    "known": f"""
        known AS (SELECT DISTINCT user_name FROM nav JOIN pages USING (page_id)
                  WHERE starts_with(url, '{MOBILE}'))""",
    "message": """
        message AS (
          SELECT o_orderkey AS delivery_tag,
                 CASE WHEN o_orderkey % 97 = 0 THEN 'x' ELSE '' END
                   || CAST(o_orderkey AS VARCHAR) AS body
          FROM orders)""",
    "expected_mention": f"""
        expected_mention AS (
          SELECT page_id, 'artist' AS role, 'artist' || (page_id % 37) AS user_name
          FROM pages WHERE page_id % 10 NOT IN (1, 2)
          UNION
          SELECT page_id, 'commenter', 'commenter' || (page_id % 41)
          FROM pages WHERE page_id % 10 NOT IN (1, 2)
          UNION
          SELECT page_id, 'commenter', 'page-' || (page_id % 7)
          FROM pages WHERE page_id % 10 NOT IN (1, 2)
          UNION
          SELECT page_id, 'link', 'Link-' || (page_id % 19)
          FROM pages WHERE page_id % 10 NOT IN (1, 2)
          UNION
          SELECT page_id, 'autolink', 'auto' || (page_id % 29)
          FROM pages WHERE page_id % 10 NOT IN (1, 2)
          UNION
          SELECT page_id, 'icon', nullif(regexp_extract('/user' || href, '^/user/({_NAME})/?$', 1), '')
          FROM link WHERE page_id % 10 NOT IN (1, 2)
            AND regexp_matches('/user' || href, '^/user/({_NAME})/?$'))""",
}

# The submissions with a row for every id, under the same name.
SQL["every_submission"] = SQL["submission"].replace("FROM orders WHERE o_orderkey % 3 <> 0", "FROM orders")


def with_tables(query: str, *names: str) -> str:
    """Oracle SQL: the named derived tables, then the query."""
    return "WITH " + ",".join(SQL[name] for name in names) + "\n" + query
