"""Strict and tolerant casts.

Strict casts (``CAST``) raise on a bad value under ANSI mode, so a bad
contract row fails the run.  Tolerant casts (``SAFE_CAST``) turn bad values
into NULL.  Spark's own ``try_cast`` to DATE/TIMESTAMP accepts partial
dates (``'2024'`` -> 2024-01-01) and ignores what follows a date; the tolerant
casts take only a whole ``y-m-d`` date with, at most, a time and a zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierwise.schemas import MONEY

# The texts that a tolerant cast takes.  A date is year-month-day
# and, at most, a well-formed time and zone; nothing may follow.  A zone is Z,
# an offset of hours and maybe minutes, or a name.
_DAY, _TIME, _SECONDS = r"\d{4}-\d{1,2}-\d{1,2}", r"\d{1,2}:\d{2}", r":\d{2}(?:\.\d+)?"
_OFFSET = r"[+-]\d{1,2}(?::?\d{1,2})?"
_ZONE = rf"Z|{_OFFSET}|[A-Za-z]+(?:[/_-][A-Za-z0-9_+-]+)*"
FULL_DATE = rf"^\s*{_DAY}(?:[T ]{_TIME}(?:{_SECONDS})?\s*(?:Z|UTC|{_OFFSET})?)?\s*$"
PLAIN_TIME = rf"^{_DAY}(?:[T ]{_TIME}(?:{_SECONDS})?)?$"
ZONED_TIME = rf"^{_DAY}(?:[T ]{_TIME}(?:{_SECONDS})?)?\s*(?:{_ZONE})$"
# A zone straight after the date, or after hours and minutes.
DATE_ZONE = rf"^({_DAY})\s*(?=(?:{_ZONE})$)"
MINUTE_ZONE = rf"^({_DAY}[T ]{_TIME})(?=\s*(?:{_ZONE})$)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_date(c: Column | str) -> Column:
    return _col(c).cast("date")


def strict_money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def safe_money(c: Column | str) -> Column:
    return _col(c).try_cast(MONEY)


def safe_date(c: Column | str) -> Column:
    """``SAFE_CAST(c AS DATE)``.  A text in the usual form ``yyyy-MM-dd``, which
    the date prints back as, needs no pattern."""
    c = _col(c)
    d = c.try_cast("date")
    return F.when(d.cast("string") == c, d).when(d.isNotNull() & c.rlike(FULL_DATE), d)


def safe_timestamp(c: Column | str, trim: bool = True) -> Column:
    """``SAFE_CAST(TRIM(c) AS TIMESTAMP)`` as a zone-free timestamp: the UTC wall
    clock, whatever the session's time zone.

    A text without a zone is taken as UTC; the usual form ``yyyy-MM-dd HH:mm:ss``
    (or with a T) needs no pattern.  A text with a zone (offset, Z or name) is
    completed by a time or seconds if it has none, read as an instant, and the
    instant's UTC wall clock is the result."""
    c = _col(c)
    if trim:
        c = F.trim(c)
    wall = c.try_cast("timestamp_ntz")
    whole = F.regexp_replace(F.regexp_replace(c, DATE_ZONE, "$1 00:00:00 "), MINUTE_ZONE, "$1:00")
    # No text has both forms, and one with a zone is dear enough to parse.
    return (F.when(_usual_time(c), wall)
            .when(c.rlike(ZONED_TIME), utc_wall(F.coalesce(c.try_cast("timestamp"), whole.try_cast("timestamp"))))
            .when(c.rlike(PLAIN_TIME), wall))


def _usual_time(c: Column) -> Column:
    """Whether a text, if the cast takes it, is ``yyyy-MM-dd HH:mm:ss``: its
    length, the separators and the seconds' digits leave no room for a zone."""
    def at(i: int) -> Column:
        return F.substring(c, i, 1)
    return ((F.length(c) == 19) & (at(5) == "-") & (at(8) == "-") & at(11).isin(" ", "T") & (at(14) == ":") & (at(17) == ":")
            & at(18).between("0", "9") & at(19).between("0", "9"))


def utc_wall(instant: Column) -> Column:
    """The UTC wall clock of a TIMESTAMP as TIMESTAMP_NTZ."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def utc_text(wall: Column) -> Column:
    """A zone-free UTC timestamp as ISO text (``2024-01-31T00:00:00Z``), the
    same in every session zone: a zone-free timestamp prints without one."""
    return F.concat(F.translate(wall.cast("string"), " ", "T"), F.lit("Z"))
