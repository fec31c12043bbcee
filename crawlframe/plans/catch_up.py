"""The gap between the attempt log and the site, as queue messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.operators.frontier import catch_up_ids, latest_id
from crawlframe.operators.pages import frontpage_latest_id
from crawlframe.schemas import SITE_ID
from crawlframe.sources.queue import publish_ids


def catch_up_messages(
    attempts: DataFrame, on_site: DataFrame, column: str = SITE_ID
) -> DataFrame:
    """One message per id that the site has and the log has not reached.

    A batch job; run it as often as needed, each run starts from the log.
    """
    return publish_ids(catch_up_ids(latest_id(attempts, column), on_site))


def newest_on_site(front_pages: DataFrame) -> DataFrame:
    """One row ``site_id``: the newest id over the given front pages."""
    return frontpage_latest_id(front_pages).agg(F.max("site_id").alias("site_id"))
