"""Typed scans and appends of the crawl tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.profile import SiteProfile
from crawlframe.schemas import SITE_ID, TABLES


def conform(df: DataFrame, table: str, profile: SiteProfile = SiteProfile()) -> DataFrame:
    """Select and cast ``df`` to the columns of ``table``.

    Tables written by the crawler call the site's own id
    ``<site>_submission_id``; that name is accepted too.
    """
    stored = {SITE_ID: profile.stored_submission_id}
    columns = []
    for field in TABLES[table].fields:
        source = field.name
        if source not in df.columns and stored.get(source) in df.columns:
            source = stored[source]
        columns.append(F.col(source).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def read_crawl_table(
    spark: SparkSession,
    path: str,
    table: str,
    format: str = "parquet",
    profile: SiteProfile = SiteProfile(),
) -> DataFrame:
    """Scan one crawl table; only the columns a query uses are read."""
    return conform(spark.read.format(format).load(path), table, profile)


def read_crawl_table_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    stored_table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    profile: SiteProfile = SiteProfile(),
    **options: str,
) -> DataFrame:
    """Scan one crawl table from its database in ``partitions`` id slices.

    ``lower`` and ``upper`` shape the slices only; no row is left out.
    """
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=stored_table,
        partitionColumn=partition_column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(partitions),
        **options,
    )
    return conform(reader.load(), table, profile)


def with_surrogate_key(
    df: DataFrame, name: str, after: int = 0, natural_key: list[str] | None = None
) -> DataFrame:
    """Add a generated key.

    With ``natural_key`` the key is a hash of those columns: the same row gets
    the same key when a task is run again.  Otherwise keys are unique, larger
    than ``after`` and not dense; write the result before using it twice.
    """
    if natural_key:
        return df.withColumn(name, F.xxhash64(*natural_key))
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(after + 1))


def append_rows(df: DataFrame, path: str, table: str, format: str = "parquet") -> None:
    """Append rows that already carry their key to the table at ``path``."""
    conform(df, table).write.format(format).mode("append").save(path)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Save as a catalog table whose rows are bucketed and sorted by ``key``.

    Tables with equally many buckets join on their keys without a shuffle.
    Meant for unique keys, such as attempt ids: a bucket is not split when a
    key in it has very many rows.
    """
    df.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name)
