"""Time parsing and calendar functions on zone-less times, independent of the session's time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_TIME = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d*)?$"
UNIX_SECONDS = r"^\d{9,10}$"
UNIX_MILLIS = r"^\d{12,13}$"
DATE_MINUTE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2})?$"
DAY_FIRST = r"^(\d{2})[/.-](\d{2})[/.-](\d{4})(?: (\d{2}:\d{2}(?::\d{2})?))?$"
COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2}))?$"
SLASHED = r"^(\d{4})/(\d{2})/(\d{2})(?:[ T](\d{2}:\d{2}(?::\d{2})?))?$"
# English month names, as they begin.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
NAMED = r"^(\d{1,2}) (?i:(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec))[a-z]* (\d{4})(?: (\d{2}:\d{2}(?::\d{2})?))?$"
ZONED = r"^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2})(?:\.\d*)? ?(?:Z|([+-])(\d{2}):?(\d{2}))$"


def _time(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def best_effort_timestamp(c: Column | str) -> Column:
    """Text in any of several date-time spellings as a time with second precision; NULL where none fits.

    Accepted: ``yyyy-MM-dd`` with a space or ``T`` before ``HH:mm[:ss[.fraction]]`` and an optional zone offset (moved
    to UTC), ``yyyy/MM/dd``, ``dd/MM/yyyy`` and its dotted and dashed forms, ``yyyyMMdd[[T]HHmmss]``, a day with the month's
    English name, unix seconds and milliseconds. Each spelling is recognised by shape first, so a row costs one pattern
    test in the usual case and no exception in any.
    """
    text = F.col(c) if isinstance(c, str) else c
    sign = F.when(F.regexp_extract(text, ZONED, 2) == "-", -1).otherwise(1)
    offset = F.make_dt_interval(
        F.lit(0),
        sign * F.coalesce(F.regexp_extract(text, ZONED, 3).try_cast("int"), F.lit(0)),
        sign * F.coalesce(F.regexp_extract(text, ZONED, 4).try_cast("int"), F.lit(0)),
    )
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    year_first = F.regexp_replace(F.regexp_replace(text, DAY_FIRST, "$3-$2-$1 $4"), COMPACT, "$1-$2-$3 $4:$5:$6")
    return (
        F.when(text.rlike(DATE_TIME), _time(F.substring(text, 1, 19)))
        .when(text.rlike(UNIX_SECONDS), epoch + F.make_dt_interval(secs=text.try_cast("decimal(18,6)")))
        .when(text.rlike("|".join([DATE_MINUTE, DAY_FIRST, COMPACT])), _time(F.rtrim(year_first, F.lit(" :"))))
        .when(text.rlike(SLASHED), _time(F.rtrim(F.regexp_replace(text, SLASHED, "$1-$2-$3 $4"), F.lit(" "))))
        .when(
            text.rlike(UNIX_MILLIS),
            epoch + F.make_dt_interval(secs=F.floor(text.try_cast("bigint") / 1000).cast("decimal(18,6)")),
        )
        .when(text.rlike(NAMED), _time(F.rtrim(_numbered_month(text), F.lit(" "))))
        .when(text.rlike(ZONED), _time(F.regexp_extract(text, ZONED, 1)) - offset)
    )


def _numbered_month(text: Column) -> Column:
    """A day with its month's name, with numbers instead."""
    name = F.initcap(F.regexp_extract(text, NAMED, 2))
    month = F.array_position(F.array(*[F.lit(month) for month in MONTHS]), name)
    day = F.lpad(F.regexp_extract(text, NAMED, 1), 2, "0")
    return F.concat(
        F.regexp_extract(text, NAMED, 3),
        F.lit("-"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lit("-"),
        day,
        F.lit(" "),
        F.regexp_extract(text, NAMED, 4),
    )


def start_of_day(c: Column | str) -> Column:
    """Midnight of the time's day, still a zone-less time; NULL stays NULL."""
    return (F.col(c) if isinstance(c, str) else c).cast("date").cast("timestamp_ntz")


def year_month(c: Column | str) -> Column:
    """The month as the number ``yyyyMM``."""
    column = F.col(c) if isinstance(c, str) else c
    return F.year(column) * 100 + F.month(column)


def now(as_of: dt.datetime | None = None) -> Column:
    """One zone-less time for the whole result: ``as_of`` if given, else the query's start."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def since_days(c: Column | str, days: int, as_of: dt.date | None = None) -> Column:
    """True from midnight ``days`` days before ``as_of`` (default today) on.

    The bound folds to a literal, so it reaches the scan as a pushed filter.
    """
    today = F.current_date() if as_of is None else F.lit(as_of.isoformat()).cast("date")
    return (F.col(c) if isinstance(c, str) else c) >= F.date_sub(today, days).cast("timestamp_ntz")
