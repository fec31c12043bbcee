"""Names found on pages: lookups, set operations, the insert-only dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NAME = "user_name"


def _names(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def only_keys(
    table: DataFrame, keys: DataFrame, column: str, n_keys: int, most: int = 1_000_000
) -> DataFrame:
    """``table`` without rows that a later join with ``keys`` cannot use.

    ``n_keys`` is the number of rows of ``keys``, counted by the caller.  Up to
    ``most`` of them are broadcast, so the table is filtered where it is read
    and only what is left is shuffled.  Beyond that the table stays whole.
    """
    if n_keys > most:
        return table
    return table.join(F.broadcast(keys.select(column)), column, "left_semi")


def lookup_unique(ids: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(found, violations)`` for lookups that may match one row at most.

    ``found`` has each requested id with its only row, or nulls without one;
    ``violations`` has ``key, n_rows`` of requested ids with several rows.
    The table's rows of other ids are left out before the rest is reduced to
    one row per id.
    """
    others = [name for name in table.columns if name != key]
    folded = table.join(_names(ids, key), key, "left_semi").groupBy(key).agg(
        F.count("*").alias("n_rows"), F.min(F.struct(*others)).alias("_row")
    )
    matched = _names(ids, key).join(folded, key, "left")
    several = F.coalesce(F.col("n_rows") > 1, F.lit(False))
    found = matched.filter(~several).select(key, "_row.*")
    return found, matched.filter(several).select(key, "n_rows")


def set_union(left: DataFrame, right: DataFrame, column: str = NAME) -> DataFrame:
    return _names(left.select(column).union(right.select(column)), column)


def set_difference(left: DataFrame, right: DataFrame, column: str = NAME) -> DataFrame:
    """Distinct values of ``left`` that are not in ``right``; case matters."""
    return _names(left, column).join(_names(right, column), column, "left_anti")


def known_users(found: DataFrame, users: DataFrame) -> DataFrame:
    """Found names that already have a row."""
    return _names(found, NAME).join(users.select(NAME), NAME, "left_semi")


def new_users(found: DataFrame, users: DataFrame) -> DataFrame:
    """Found names without a row."""
    return set_difference(found, users, NAME)


def insert_ignore_users(found: DataFrame, users: DataFrame, date_added: Column) -> DataFrame:
    """Rows to append to ``users``: one per new name, existing names untouched.

    The key is a hash of the name, so a repeated run makes the same rows.
    """
    return new_users(found, users).select(
        F.xxhash64(NAME).alias("user_id"), date_added.alias("date_added"), NAME
    )


def merge_users(found: DataFrame, users: DataFrame, date_added: Column) -> DataFrame:
    """The dimension after the insert."""
    added = insert_ignore_users(found, users, date_added)
    return users.select("user_id", "date_added", NAME).unionByName(added)


def distinct_users(mentions: DataFrame, page: str = "page_id") -> DataFrame:
    """Names per page, each once however many extractors saw it."""
    return mentions.select(page, NAME).filter(F.col(NAME).isNotNull()).distinct()


def top_mentioned(mentions: DataFrame, k: int, page: str = "page_id") -> DataFrame:
    """Per role the ``k`` names on most pages, names in order on equal counts.

    ``role, user_name, n_pages, rank``.  Tasks drop all but their own top ``k``
    before the last shuffle.
    """
    counted = (
        mentions.filter(F.col(NAME).isNotNull())
        .groupBy("role", NAME)
        .agg(F.count_distinct(page).alias("n_pages"))
    )
    ranking = Window.partitionBy("role").orderBy(F.col("n_pages").desc(), NAME)
    ranked = counted.withColumn("rank", F.row_number().over(ranking))
    return ranked.filter(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))


def approx_users(mentions: DataFrame, relative_error: float = 0.02) -> DataFrame:
    """Number of distinct names per role, from fixed-size sketches."""
    return mentions.groupBy("role").agg(
        F.approx_count_distinct(NAME, relative_error).alias("n_users")
    )
