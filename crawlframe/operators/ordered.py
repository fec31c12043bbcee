"""Neighbour lookups in long ordered histories without one task per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT = "_slot"
# The slot of rows without a time, which sort first.
_BEFORE_ALL = -(2**62)


def slot_of(moment: Column, slot_seconds: int) -> Column:
    """Number of the span of ``slot_seconds`` that a time lies in, the same for every key and size."""
    number = F.floor(F.unix_micros(moment.cast("timestamp")) / F.lit(slot_seconds * 1_000_000))
    return F.coalesce(number.cast("long"), F.lit(_BEFORE_ALL))


def previous_row(
    rows: DataFrame, keys: list[str], order: list[str], carry: list[str], out: str
) -> DataFrame:
    """Add ``out``: struct of ``carry`` of the row before, per ``keys`` in ``order``.

    ``rows`` has a ``_slot`` that grows with ``order`` (see :func:`slot_of`).
    They are shuffled once, by key and slot, and sorted within a slot only, so
    a key that holds a third of the table is spread over as many tasks as it
    has slots.  The last row of each slot is handed to the first row of the
    key's next slot through a table with one row per key and slot, made from
    the same shuffle.  ``out`` is null on the first row of a key; null
    counts as a key.  Rows of one key and slot stay together.
    """
    slots = ["_key", SLOT]
    carried = F.struct(*carry)
    # A struct is never null, so the join below puts no filter on one of its sides
    # and both go on from one and the same shuffle.
    dealt = rows.withColumn("_key", F.struct(*keys)).drop(*keys).repartition(*slots)
    ends = dealt.groupBy(*slots).agg(F.max_by(carried, F.struct(*order)).alias("_last"))
    across = Window.partitionBy("_key").orderBy(SLOT)
    edges = ends.select(*slots, F.lag("_last").over(across).alias("_before"))

    inside = Window.partitionBy(*slots).orderBy(*order)
    walked = dealt.withColumn(out, F.lag(carried).over(inside))
    joined = walked.join(edges, slots, "left").withColumn(out, F.coalesce(out, "_before"))
    return joined.select(*[F.col(f"_key.{key}") for key in keys], *[c for c in rows.columns if c not in keys], out)
