"""Numeric scalars: whole-number test, lenient parse, double as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_63 = 9223372036854775808.0


def in_long_range(c: Column) -> Column:
    """False for infinities, and for NaN, which Spark orders above everything."""
    return (c >= F.lit(-_TWO_63)) & (c < F.lit(_TWO_63))


def is_whole(c: Column) -> Column:
    """True where a double holds an integer that fits a bigint; null stays null."""
    return (F.rint(c) == c) & in_long_range(c)


def int_or_default(c: Column, default: int) -> Column:
    return F.coalesce(c.try_cast("int"), F.lit(default))


def double_to_text(c: Column) -> Column:
    """Shortest decimal text: plain from 1e-5 up to 1e16, exponent outside.

    Spark's own cast is plain only from 1e-3 to 1e7; it is kept there because it
    is the cheapest of the three.
    """
    size = F.abs(c)
    cast = c.cast("string")
    plain = F.call_function("format_number", c, F.lit("0.0" + "#" * 21))
    exponent = F.lower(F.regexp_replace(cast, r"\.0E", "E"))
    return (
        F.when(((size >= 1e-3) & (size < 1e7)) | (size == 0), cast)
        .when((size >= 1e-5) & (size < 1e16), plain)
        .otherwise(F.replace(exponent, F.lit("infinity"), F.lit("inf")))
    )
