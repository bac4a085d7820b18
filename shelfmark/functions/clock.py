"""Time-of-day and refresh-time scalars."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone and format of the refresh time, default and form of a time of day.
REFRESH_ZONE = "America/Sao_Paulo"
REFRESH_STRFTIME = "%d/%m/%Y %H:%M:%S"
MIDNIGHT = "00:00:00"
_CLOCK = r"(\d{2}:\d{2}:\d{2})"


def time_of_day_from_text(c: Column) -> Column:
    """First ``hh:mm:ss`` in the text, midnight when there is none.

    Timestamps work too, through their text, which no daylight-saving gap shifts.
    """
    found = F.regexp_extract(c.cast("string"), _CLOCK, 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(MIDNIGHT))


def time_of_day_from_interval(c: Column) -> Column:
    """Clock part of a duration: days dropped, microseconds shown when not zero.

    A negative duration counts back from midnight and is marked with ``+``
    (minus one hour is ``+23:00:00``), as durations print in pandas.
    """
    shifted = (F.lit("1970-01-01").cast("timestamp_ntz") + c).cast("string")
    clock = F.regexp_extract(shifted, _CLOCK + r"(\.\d+)?$", 1)
    fraction = F.regexp_extract(shifted, r"(\.\d+)$", 1)
    micros = F.when(fraction == "", "").otherwise(F.rpad(fraction, 7, "0"))
    sign = F.when(c < F.make_dt_interval(), "+").otherwise("")
    return F.coalesce(F.concat(sign, clock, micros), F.lit(MIDNIGHT))


def refresh_text(utc: Column) -> Column:
    """A UTC wall-clock timestamp (without zone) as local refresh-time text."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(REFRESH_ZONE), utc).cast("string")
    return F.regexp_replace(local, r"^(\d+)-(\d+)-(\d+) (\S{8}).*$", "$3/$2/$1 $4")


def refresh_text_at(moment: datetime | None = None) -> str:
    """Refresh-time text of one driver-side moment (naive means UTC), or of now."""
    moment = moment or datetime.now(timezone.utc)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(ZoneInfo(REFRESH_ZONE)).strftime(REFRESH_STRFTIME)
