"""Period keys and text-to-time parsing.

Parsing never raises: the ``try_`` functions give NULL on bad text, also under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import ColumnOrName, as_column, padded_key

DATE_TIME_FORMAT = "dd/MM/yyyy HH:mm:ss"
EVENT_STAMP_FORMAT = "yyyyMMddHHmmss"
EVENT_STAMP_SENTINEL = "99991231235959"


def year_week_key(
    c: ColumnOrName, style: str = "yyyyww", year_mode: str = "iso", pad: bool = True
) -> Column:
    """Text key of the ISO week of a date or timestamp.

    ``style`` is ``"yyyyww"`` (sorts by time) or ``"ww/yyyy"``.  ``year_mode="iso"`` takes the
    year the ISO week belongs to; ``"calendar"`` takes the year of the date itself, so that
    2021-01-01 becomes 202153.  ``pad=False`` leaves weeks 1-9 with a single digit.
    """
    day = as_column(c)
    week = F.weekofyear(day).cast("string")
    if pad:
        week = padded_key(week, 2)
    if year_mode == "iso":
        year = F.extract(F.lit("yearofweek"), day.cast("date")).cast("string")
    elif year_mode == "calendar":
        year = F.year(day).cast("string")
    else:
        raise ValueError(f"year_mode must be 'iso' or 'calendar', not {year_mode!r}")
    if style == "yyyyww":
        return F.concat(year, week)
    if style == "ww/yyyy":
        return F.concat(week, F.lit("/"), year)
    raise ValueError(f"style must be 'yyyyww' or 'ww/yyyy', not {style!r}")


def _from_iso(text: Column, year: int, month: int, day: int, time: Column) -> Column:
    """Timestamp from a text whose year, month and day start at the given positions."""
    return F.concat(
        F.substring(text, year, 4),
        F.lit("-"),
        F.substring(text, month, 2),
        F.lit("-"),
        F.substring(text, day, 2),
        F.lit(" "),
        time,
    ).try_cast("timestamp")


def parse_date_time(
    date_c: ColumnOrName, time_c: ColumnOrName, fmt: str = DATE_TIME_FORMAT
) -> Column:
    """Timestamp from a date text and a time text; NULL if either is NULL or unreadable.

    The default format is reordered and cast, which costs a bad text nothing; a pattern parser
    raises and catches an exception for each.
    """
    date, time = as_column(date_c), as_column(time_c)
    if fmt != DATE_TIME_FORMAT:
        return F.try_to_timestamp(F.concat(date, F.lit(" "), time), F.lit(fmt))
    shaped = date.rlike(r"^\d\d/\d\d/\d{4}$") & time.rlike(r"^\d\d:\d\d:\d\d$")
    return F.when(shaped, _from_iso(date, 7, 4, 1, time))


def parse_dmy(c: ColumnOrName) -> Column:
    """Date from ``dd?MM?yyyy`` read by position, so any separator character passes."""
    text = as_column(c)
    ymd = F.concat(
        F.substring(text, 7, 4),
        F.lit("-"),
        F.substring(text, 4, 2),
        F.lit("-"),
        F.substring(text, 1, 2),
    )
    return ymd.try_cast("date")


def parse_event_stamp(c: ColumnOrName, sentinel: str = EVENT_STAMP_SENTINEL) -> Column:
    """Timestamp from a 14-digit stamp; the sentinel and bad text give NULL."""
    text = as_column(c)
    time = F.concat(
        F.substring(text, 9, 2), F.lit(":"), F.substring(text, 11, 2), F.lit(":"), F.substring(text, 13, 2)
    )
    shaped = (text != sentinel) & text.rlike(r"^\d{14}$")
    return F.when(shaped, _from_iso(text, 1, 5, 7, time))
