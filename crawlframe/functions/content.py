"""Digests, sizes, decoding and timestamps of stored blobs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.profile import FILE_SAFE_TIMESTAMP

# Binary size units, smallest first.
SIZE_UNITS = ("Byte", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")


def digest(data: Column, bits: int = 512) -> Column:
    """Lower-case hex SHA-2 of the bytes."""
    return F.sha2(data, bits)


def size_in_bytes(data: Column) -> Column:
    return F.octet_length(data).cast("long")


def payload_state(blob: Column) -> Column:
    """null: ``extracted``; zero bytes: ``emptied``; otherwise ``present``."""
    return (
        F.when(blob.isNull(), "extracted")
        .when(F.octet_length(blob) == 0, "emptied")
        .otherwise("present")
    )


def human_size(size: Column) -> Column:
    """Size in its largest fitting binary unit, three decimals, ties to even.

    Zero bytes read ``0.000 Bit``, the unit below a byte.
    """

    def scaled(power: int) -> Column:
        value = F.bround(size / F.lit(1024.0**power), 3)
        return F.format_string(f"%.3f {SIZE_UNITS[power]}", value)

    text = F.when(size == 0, F.lit("0.000 Bit"))
    top = len(SIZE_UNITS) - 1
    for power in range(top):
        text = text.when(size < 1024 ** (power + 1), scaled(power))
    return text.when(size.isNotNull(), scaled(top))


def file_safe_timestamp(moment: Column) -> Column:
    """ISO time without colons and with a numeric offset; times are UTC."""
    return F.concat(F.date_format(moment, FILE_SAFE_TIMESTAMP), F.lit("+0000"))


def is_utf8(data: Column) -> Column:
    return F.is_valid_utf8(data.cast("string"))


def encoding_status(data: Column) -> Column:
    return F.when(is_utf8(data), "decoded_ok").otherwise("unicode_decode_error")


def decode_page(data: Column) -> Column:
    """Text of the bytes; bytes that are not UTF-8 appear as ``\\xNN``.

    The Python worker is handed null for every valid page, so only broken
    pages cross over.
    """

    @F.pandas_udf("string")
    def escape_invalid(blobs: pd.Series) -> pd.Series:
        return blobs.map(
            lambda b: None if b is None else bytes(b).decode("utf-8", "backslashreplace")
        )

    valid = is_utf8(data)
    broken = F.when(~valid, data)
    return F.when(valid, data.cast("string")).otherwise(escape_invalid(broken))
