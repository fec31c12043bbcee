"""Ids, links and names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.urls import (
    parse_worker_identity,
    submission_url,
    username_from_url,
    view_id_from_href,
)
from crawlframe.operators import frontier, heavy, id_sets, links, names, sketches
from crawlframe.plans.catch_up import catch_up_messages
from crawlframe.plans.discovery import discover_link_users
from crawlframe.session import scratch_path
from crawlframe.sources.queue import publish_ids
from workload import frames
from workload.frames import ACCEPTED, ID_IN_URL, ROOT_USERS, with_tables
from workload.registry import query, time_text


@query(
    "user_discovery",
    with_tables(
        "SELECT DISTINCT user_name FROM nav WHERE user_name NOT IN (SELECT user_name FROM known)",
        "link", "nav", "known",
    ),
)
def user_discovery(spark, d):
    """The flagship flow: pages, links, names, names without a row."""
    return discover_link_users(
        frames.table(spark, d, "pages"), frames.known_users(spark, d), ROOT_USERS
    )


@query(
    "id_range",
    """
    WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem),
         back AS (SELECT unnest(range(hi, lo - 1, -1)) AS id FROM b),
         ahead AS (SELECT unnest(range(lo, hi + 1, 3)) AS id FROM b)
    SELECT id, CAST(-1 AS BIGINT) AS step FROM back
    UNION ALL SELECT id, CAST(3 AS BIGINT) FROM ahead
    """,
)
def id_range(spark, d):
    lo, hi = frontier.id_bounds(frames.ids(spark, d))
    backwards = frontier.id_range(spark, hi, lo, -1)
    forwards = frontier.id_range(spark, lo, hi, 3)
    return backwards.withColumn("step", F.lit(-1).cast("long")).unionByName(
        forwards.withColumn("step", F.lit(3).cast("long"))
    )


@query("latest_id", "SELECT max(user_id) AS latest_id FROM events")
def latest_id(spark, d):
    return frontier.latest_id(frames.attempts(spark, d))


@query(
    "catch_up_ids",
    """
    WITH b AS (SELECT (SELECT max(user_id) FROM events) AS lo,
                      (SELECT max(o_orderkey) FROM orders) AS hi)
    SELECT unnest(range(lo + 1, hi + 1)) AS id FROM b
    """,
)
def catch_up_ids(spark, d):
    on_site = frames.table(spark, d, "orders").agg(F.max("o_orderkey").alias("site_id"))
    latest = frontier.latest_id(frames.attempts(spark, d))
    return frontier.catch_up_ids(latest, on_site, ids_per_task=4096)


@query(
    "catch_up_batch",
    """
    WITH b AS (SELECT max(l_orderkey) AS hi FROM lineitem)
    SELECT CAST(unnest(range(hi + 1, hi + 51)) AS VARCHAR) AS body FROM b
    """,
)
def catch_up_batch(spark, d):
    ids = frames.ids(spark, d)
    on_site = ids.agg((F.max("id") + 50).alias("site_id"))
    return catch_up_messages(ids, on_site, "id").select(
        F.col("value").cast("string").alias("body")
    )


@query("publish_ids", "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS body FROM lineitem")
def publish(spark, d):
    messages = publish_ids(frames.ids(spark, d).distinct())
    return messages.select(F.col("value").cast("string").alias("body"))


@query(
    "missing_ids",
    """
    SELECT id FROM (SELECT unnest(range(0, (SELECT max(l_orderkey) + 1 FROM lineitem))) AS id)
    WHERE id NOT IN (SELECT l_orderkey FROM lineitem)
    """,
)
def missing_ids(spark, d):
    ids = frames.ids(spark, d)
    _, hi = frontier.id_bounds(ids)
    return frontier.missing_ids(ids, 0, hi)


@query(
    "missing_ranges",
    """
    WITH present AS (SELECT DISTINCT l_orderkey AS id FROM lineitem UNION SELECT -1),
         pairs AS (SELECT lag(id) OVER (ORDER BY id) AS before, id FROM present)
    SELECT before + 1 AS lo, id - 1 AS hi, id - before - 1 AS n FROM pairs WHERE id - before > 1
    """,
)
def missing_ranges(spark, d):
    return frontier.missing_ranges(frames.ids(spark, d), lo=0, bucket_width=4096)


@query(
    "username_from_url",
    with_tables(
        f"""
        SELECT page_id, pos, href,
               nullif(regexp_extract(href, '^/({frames._NAME})/?$', 1), '') AS user_name
        FROM link""",
        "link",
    ),
)
def g1(spark, d):
    name = username_from_url(F.col("href"), ROOT_USERS)
    return frames.links(spark, d).select(
        "page_id", F.col("pos").cast("long").alias("pos"), "href", name.alias("user_name")
    )


@query(
    "view_id_from_href",
    f"""
    SELECT page_id,
           TRY_CAST(nullif(regexp_extract(url, '{ID_IN_URL}', 1), '') AS BIGINT) AS view_id
    FROM pages""",
)
def g2(spark, d):
    view_id = view_id_from_href(F.col("url"), ID_IN_URL)
    return frames.table(spark, d, "pages").select("page_id", view_id.alias("view_id"))


@query(
    "submission_url",
    "SELECT o_orderkey, 'https://www.gallery.example/view/' || o_orderkey || '/' AS url FROM orders",
)
def g16(spark, d):
    orders = frames.table(spark, d, "orders")
    return orders.select("o_orderkey", submission_url(F.col("o_orderkey")).alias("url"))


@query(
    "worker_identity",
    """
    SELECT event_id AS scrape_attempt_id, 'h' || (user_id % 5) AS host, user_id % 7 AS pid,
           '0.2.8' AS version
    FROM events""",
)
def g17(spark, d):
    parts = parse_worker_identity(F.col("claimed_by"))
    return frames.attempts(spark, d).select("scrape_attempt_id", F.inline(F.array(parts)))


@query(
    "accept_links",
    f"SELECT page_id, url FROM pages WHERE regexp_matches(url, '{ACCEPTED}')",
)
def accept(spark, d):
    pages = frames.table(spark, d, "pages").select("page_id", "url")
    return links.accept_links(pages, ACCEPTED)


@query(
    "known_users",
    with_tables("SELECT user_name FROM known", "link", "nav", "known"),
)
def known(spark, d):
    return names.known_users(frames.nav_users(spark, d), frames.known_users(spark, d))


NEW_USERS = with_tables(
    "SELECT DISTINCT user_name FROM nav WHERE user_name NOT IN (SELECT user_name FROM known)",
    "link", "nav", "known",
)


@query("new_users", NEW_USERS)
def new(spark, d):
    return names.new_users(frames.nav_users(spark, d), frames.known_users(spark, d))


@query(
    "insert_ignore_users",
    with_tables(
        """
        SELECT user_name, CASE WHEN user_name IN (SELECT user_name FROM known) THEN
                 '2024-01-01 00:00:00.000000' ELSE '2025-01-01 00:00:00.000000' END AS date_added
        FROM (SELECT DISTINCT user_name FROM nav)""",
        "link", "nav", "known",
    ),
)
def insert_ignore(spark, d):
    users = frames.known_users(spark, d).select(
        F.xxhash64("user_name").alias("user_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("date_added"),
        "user_name",
    )
    now = F.lit("2025-01-01").cast("timestamp_ntz")
    merged = names.merge_users(frames.nav_users(spark, d), users, now)
    return merged.select("user_name", time_text(F.col("date_added")).alias("date_added"))


@query("set_difference", NEW_USERS)
def difference(spark, d):
    return names.set_difference(
        frames.nav_users(spark, d), frames.known_users(spark, d), "user_name"
    )


@query(
    "set_union",
    with_tables(
        """
        SELECT user_name FROM nav
        UNION SELECT 'Supplier#' || s_suppkey FROM supplier""",
        "link", "nav",
    ),
)
def union(spark, d):
    suppliers = frames.table(spark, d, "supplier").select(
        F.concat(F.lit("Supplier#"), F.col("s_suppkey").cast("string")).alias("user_name")
    )
    return names.set_union(frames.nav_users(spark, d), suppliers)


@query(
    "distinct_users",
    with_tables("SELECT DISTINCT page_id, user_name FROM nav", "link", "nav"),
)
def distinct(spark, d):
    return names.distinct_users(frames.nav_users(spark, d))


@query(
    "top_mentioned",
    with_tables(
        """
        , counted AS (SELECT role, user_name, count(DISTINCT page_id) AS n_pages
                      FROM nav GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY n_pages DESC, user_name)
                     AS rank FROM counted)
        SELECT role, user_name, n_pages, rank FROM ranked WHERE rank <= 20""",
        "link", "nav",
    ),
)
def top(spark, d):
    return names.top_mentioned(frames.nav_users(spark, d), 20)


@query(
    "approx_users",
    with_tables(
        "SELECT role, true AS within_bound FROM nav GROUP BY role",
        "link", "nav",
    ),
)
def approx(spark, d):
    """The sketch against the exact count, at three times its standard error."""
    mentions = frames.nav_users(spark, d)
    unknown = F.lit(None).cast("long")
    exact = mentions.groupBy("role").agg(F.count_distinct("user_name").alias("n_exact"))
    both = names.approx_users(mentions, 0.02).withColumn("n_exact", unknown).unionByName(
        exact.withColumn("n_users", unknown)
    )
    off = F.abs(F.max("n_users") - F.max("n_exact")) / F.max("n_exact")
    return both.groupBy("role").agg((off <= 0.06).alias("within_bound"))


@query(
    "lookup_unique",
    with_tables(
        """
        , counted AS (SELECT o_custkey AS id, count(*) AS n, min(submission_id) AS first_id
                      FROM submission GROUP BY 1)
        SELECT c_custkey AS site_submission_id,
               CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'one' ELSE 'many' END AS outcome,
               CASE WHEN n = 1 THEN first_id END AS submission_id
        FROM customer LEFT JOIN counted ON id = c_custkey""",
        "every_submission",
    ),
)
def lookup(spark, d):
    wanted = frames.table(spark, d, "customer").select(
        F.col("c_custkey").alias("site_submission_id")
    )
    rows = frames.all_submissions(spark, d, "o_custkey")
    found, violations = names.lookup_unique(wanted, rows, "site_submission_id")
    outcome = F.when(F.col("submission_id").isNull(), "none").otherwise("one")
    return found.select("site_submission_id", outcome.alias("outcome"), "submission_id").unionByName(
        violations.select(
            "site_submission_id",
            F.lit("many").alias("outcome"),
            F.lit(None).cast("long").alias("submission_id"),
        )
    )


DAYS = """
    seen AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R'),
    shipped AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_linestatus = 'F')"""


def _stored_sets(spark, d):
    """Two sets of ids kept as tables: of returned and of finished line items."""
    lines, root = frames.table(spark, d, "lineitem"), scratch_path(spark, "id-sets")
    for name, rows in (("seen", lines.filter("l_returnflag = 'R'")), ("shipped", lines.filter("l_linestatus = 'F'"))):
        id_sets.id_set(rows, "l_orderkey").write.parquet(f"{root}/{name}")
    return [spark.read.schema(id_sets.SET).parquet(f"{root}/{name}") for name in ("seen", "shipped")]


@query(
    "id_set_operations",
    f"""
    WITH {DAYS}
    SELECT 'union' AS kind, count(*) AS n_ids, CAST(sum(id) AS BIGINT) AS id_sum FROM (SELECT id FROM seen UNION SELECT id FROM shipped)
    UNION ALL SELECT 'both', count(*), CAST(sum(id) AS BIGINT) FROM (SELECT id FROM seen INTERSECT SELECT id FROM shipped)
    UNION ALL SELECT 'without', count(*), CAST(sum(id) AS BIGINT) FROM (SELECT id FROM shipped EXCEPT SELECT id FROM seen)""",
)
def set_operations(spark, d):
    """Stored id sets joined by OR, AND and AND NOT of their bitmaps."""
    seen, shipped = _stored_sets(spark, d)
    rows = [
        ("union", id_sets.list_ids(id_sets.merge_sets(seen, shipped))),
        ("both", id_sets.ids_in_both(seen, shipped)),
        ("without", id_sets.ids_without(shipped, seen)),
    ]
    parts = [found.agg(F.lit(kind).alias("kind"), F.count("*").alias("n_ids"), F.sum("id").alias("id_sum")) for kind, found in rows]
    return reduce(DataFrame.unionByName, parts)


@query(
    "id_coverage",
    f"""
    WITH {DAYS}, b AS (SELECT CAST(unnest(range(0, (SELECT max(l_orderkey) // {id_sets.WIDTH} + 1 FROM lineitem))) AS BIGINT) AS bucket),
    hi AS (SELECT max(l_orderkey) AS hi FROM lineitem)
    SELECT bucket, greatest(bucket * {id_sets.WIDTH}, 5) AS first_id, least(bucket * {id_sets.WIDTH} + {id_sets.WIDTH - 1}, hi) AS last_id,
           least(bucket * {id_sets.WIDTH} + {id_sets.WIDTH - 1}, hi) - greatest(bucket * {id_sets.WIDTH}, 5) + 1 AS n_expected,
           (SELECT count(*) FROM seen WHERE id >= 5 AND id // {id_sets.WIDTH} = bucket) AS n_present
    FROM b, hi""",
)
def coverage(spark, d):
    """How full each bucket of a stored set is, from its bitmaps."""
    seen, _ = _stored_sets(spark, d)
    _, hi = frontier.id_bounds(frames.ids(spark, d))
    return id_sets.bucket_coverage(seen, 5, hi)


@query(
    "heavy_hitters",
    """
    WITH counted AS (SELECT l_returnflag AS role, CAST(l_partkey AS VARCHAR) AS part, count(*) AS n_rows FROM lineitem GROUP BY ALL),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY n_rows DESC, part) AS rank FROM counted)
    SELECT role, part, n_rows, rank FROM ranked WHERE rank <= 15""",
)
def heavy_parts(spark, d):
    """The parts that most line items of a kind name; summaries find the candidates."""
    rows = frames.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("role"), F.col("l_partkey").alias("part"))
    return heavy.heavy_hitters(rows, "role", "part", 15)


def _day_sketches(spark, d):
    """Users per event type and day, kept as a table."""
    path = scratch_path(spark, "sketches")
    rows = frames.table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), "user_id")
    sketches.distinct_sketches(rows, ["event_type", "day"], "user_id").write.parquet(path)
    return spark.read.schema("event_type string, day date, sketch binary").parquet(path)


@query(
    "distinct_sketches",
    "SELECT event_type, month(ts) AS month, count(DISTINCT user_id) AS n_distinct FROM events GROUP BY ALL",
)
def monthly_users(spark, d):
    """Users per event type and month from the stored sketches of days; exact up to 32,768 of them."""
    by_month = _day_sketches(spark, d).withColumn("month", F.month("day").cast("long"))
    return sketches.merged_counts(by_month, ["event_type", "month"])


@query(
    "sketch_comparison",
    """
    WITH e AS (SELECT DISTINCT event_type, user_id, day(ts) % 2 AS odd FROM events),
         p AS (SELECT event_type, user_id, bool_or(odd = 0) AS a, bool_or(odd = 1) AS b FROM e GROUP BY ALL)
    SELECT event_type, count(*) FILTER (WHERE a) AS n_left, count(*) FILTER (WHERE b) AS n_right,
           count(*) FILTER (WHERE a AND b) AS n_both, count(*) AS n_either, count(*) FILTER (WHERE a AND NOT b) AS n_left_only
    FROM p GROUP BY event_type""",
)
def even_and_odd_days(spark, d):
    """Users seen on even days, odd days, both, either, even ones alone."""
    rows = _day_sketches(spark, d)
    even, odd = (sketches.merged_sketches(rows.filter(F.dayofmonth("day") % 2 == k), ["event_type"]) for k in (0, 1))
    return sketches.compared_counts(even, odd, ["event_type"])
