"""Normalise a query result, then add audit and partition-key columns."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import MONTH, REFRESHED_AT, TENANT, TENANT_COPY, YEAR, put_columns, quoted
from ..functions.clock import refresh_text_at, time_of_day_from_interval, time_of_day_from_text
from ..functions.numbers import double_to_text

_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def _time_of_day(c: Column, dtype: T.DataType, timestamps_too: bool) -> Column:
    if isinstance(dtype, T.DayTimeIntervalType):
        return time_of_day_from_interval(c)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c
    if isinstance(dtype, _TIMESTAMPS) and not timestamps_too:
        return c
    return time_of_day_from_text(c)


def _plain_type(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = c.cast("double")
        return F.when(~F.isnan(c), c)
    if isinstance(dtype, T.DecimalType):
        return c.cast("double")
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    if isinstance(dtype, (T.NullType, T.TimeType)):  # Parquet holds neither
        return c.cast("string")
    return c


def normalize(
    df: DataFrame,
    time_cols: Sequence[str] = ("HoraVenda",),
    timestamps_too: bool = True,
    exact: Collection[str] = (),
) -> DataFrame:
    """Bring source types to the few the conformer works on.

    Decimals and floats become double, NaN becomes null, integers become bigint,
    and the ``time_cols`` become ``hh:mm:ss`` text. JDBC hands TIME columns over
    as timestamps; ``timestamps_too=False`` leaves those alone. Columns in ``exact``
    keep a decimal without fraction digits as it is, since a double would round
    keys above 2^53.
    """
    out = []
    for field in df.schema.fields:
        c = quoted(field.name)
        if field.name in time_cols:
            new = _time_of_day(c, field.dataType, timestamps_too)
            c = _plain_type(new, field.dataType) if new is c else new
        elif not (field.name in exact and isinstance(field.dataType, T.DecimalType) and field.dataType.scale == 0):
            c = _plain_type(c, field.dataType)
        out.append(c.alias(field.name))
    return df.select(*out)


def with_audit(df: DataFrame, tenant: str, as_of: datetime | None = None) -> DataFrame:
    """Refresh time and the tenant (twice); same-named source columns give way."""
    return put_columns(
        df,
        {
            REFRESHED_AT: F.lit(refresh_text_at(as_of)),
            TENANT: F.lit(tenant),
            TENANT_COPY: F.lit(tenant),
        },
    )


def _date_text_and_keys(
    c: Column, dtype: T.DataType, mode: str, date_format: str | None
) -> tuple[Column, Column, Column]:
    plain = _plain_type(c, dtype)
    is_double = isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType))
    text = double_to_text(plain) if is_double else plain.cast("string")
    if mode == "positional":
        return text, F.substring(text, 1, 4), F.substring(text, 6, 2)
    if mode != "parse":
        raise ValueError(f"unknown partition key mode {mode!r}")
    if date_format:
        day = F.try_to_timestamp(text, F.lit(date_format)).cast("date")
    else:
        day = text.try_cast("date")
    return text, F.date_format(day, "yyyy"), F.date_format(day, "MM")


def with_partition_keys(
    df: DataFrame,
    date_col: str | None,
    mode: str = "positional",
    date_format: str | None = None,
) -> DataFrame:
    """Year and month of ``date_col``, which itself becomes text.

    ``positional`` cuts characters 1-4 and 6-7 whatever they hold; ``parse``
    reads the text as a date (null keys when it is none). Without a date column,
    or when the data lacks it, nothing is added.
    """
    if date_col is None or date_col not in df.columns:
        return df
    text, year, month = _date_text_and_keys(quoted(date_col), df.schema[date_col].dataType, mode, date_format)
    return put_columns(df, {date_col: text, YEAR: year, MONTH: month})


def cluster_by_month(
    df: DataFrame,
    date_col: str | None,
    mode: str = "positional",
    date_format: str | None = None,
) -> DataFrame:
    """Rebalance a raw query result by the month its rows will be written to.

    Done before anything else, so the shuffle carries the source's own compact
    columns and the derived text and default columns are made after it. Adaptive
    execution splits months above the advisory size over several tasks.
    """
    if date_col is None or date_col not in df.columns:
        return df
    c, dtype = quoted(date_col), df.schema[date_col].dataType
    if isinstance(dtype, (T.DateType, *_TIMESTAMPS)) and not date_format:
        # Four bytes travel with a row instead of two texts.
        keys = {"cluster_month": F.year(c) * 12 + F.month(c)}
    else:
        _, year, month = _date_text_and_keys(c, dtype, mode, date_format)
        keys = {"cluster_year": year, "cluster_month": month}
    keyed = df.select("*", *[key.alias(name) for name, key in keys.items()])
    return keyed.hint("rebalance", *map(F.col, keys)).select(*[quoted(name) for name in df.columns])
