"""String helpers shared by the other functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that Unicode-aware stripping removes.  Java's
# own \s leaves out U+001C to U+001F, so the class is spelled out.
WHITESPACE = (
    r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)


def strip(text: Column) -> Column:
    """Drop leading and trailing Unicode whitespace (``trim`` drops spaces only)."""
    return F.regexp_replace(text, rf"^{WHITESPACE}+|{WHITESPACE}+\z", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one.

    ``(?d)`` makes ``$`` stop at ``\\n`` only, not at other line ends.
    """
    return blank_to_null(F.regexp_extract(text, "(?d)" + pattern, group))
