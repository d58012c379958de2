"""Metric expressions shared by the gold models and monitoring."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_now() -> Column:
    """The current instant as a zone-free UTC timestamp, whatever the
    session's time zone."""
    secs = (F.unix_micros(F.current_timestamp()) / F.lit(1000000).cast("decimal(8,0)"))
    return (F.lit("1970-01-01").cast("timestamp_ntz")
            + F.make_dt_interval(secs=secs.cast("decimal(18,6)")))


def stamp(run_ts: str | _dt.datetime | None = None) -> Column:
    """The run stamp (``CURRENT_TIMESTAMP()``), injectable for reproducible runs.

    A given ``run_ts`` is parsed as a zone-free timestamp, so the value does
    not depend on the session time zone.
    """
    if run_ts is None:
        return utc_now()
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def as_of_date(as_of: str | _dt.date | None = None) -> Column:
    """``CURRENT_DATE()`` in UTC, injectable."""
    if as_of is None:
        return utc_now().cast("date")
    return F.lit(str(as_of)).cast("date")


def days_between(end: Column | str, start: Column | str) -> Column:
    """``DATE_DIFF(end, start, DAY)`` as BIGINT."""
    return F.datediff(_col(end), _col(start)).cast("long")


def avg_exact(total: Column, n: Column) -> Column:
    """Average as double from an exact (decimal) total and a count.

    ``avg(decimal)`` keeps a decimal result whose rounding differs between
    engines; dividing the exact total as a double is what every engine
    agrees on.  No rows -> NULL, like AVG.
    """
    return F.when(n > 0, total.cast("double") / n.cast("double"))


def pct_ratio(num: Column, den: Column, zero_value: float = 0.0) -> Column:
    """``CASE WHEN den = 0 THEN 0 ELSE num / den * 100 END``.

    ``when`` is evaluated lazily, so an ANSI division never sees a zero; a
    NULL denominator falls to the ELSE branch and yields NULL, as in SQL.
    """
    return F.when(den == 0, F.lit(zero_value)).otherwise(
        num.cast("double") / den.cast("double") * F.lit(100.0))


def safe_div(num: Column, den: Column) -> Column:
    """``CASE WHEN den = 0 THEN 0 ELSE num / den END`` in double."""
    return F.when(den == 0, F.lit(0.0)).otherwise(
        num.cast("double") / den.cast("double"))


# ------------------------------------------------------- full-width amounts

MONEY_TYPE = "decimal(38,9)"


def _split(c: Column) -> tuple[Column, Column]:
    """Integer part (decimal(30,0)) and places (decimal(10,9)) of an amount."""
    c = c.cast(MONEY_TYPE)
    return F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)), c % F.lit(1).cast("decimal(1,0)")


def _joined(whole: Column, places: Column) -> Column:
    # decimal(28,0) + decimal(.., 9) is decimal(38,9): no place is dropped.
    return (whole.cast("decimal(28,0)") + places).cast(MONEY_TYPE)


def money_plus(a: Column, b: Column) -> Column:
    """a + b as decimal(38,9), exact (integer parts and places apart); a
    result of 1e28 or more is an overflow."""
    (wa, pa), (wb, pb) = _split(a), _split(b)
    return _joined(wa + wb, pa + pb)


def money_minus(a: Column, b: Column) -> Column:
    """a - b as decimal(38,9), exact."""
    (wa, pa), (wb, pb) = _split(a), _split(b)
    return _joined(wa - wb, pa - pb)


def money_sum(c: Column | str) -> Column:
    """SUM of an amount as decimal(38,9)."""
    return F.sum(_col(c).cast(MONEY_TYPE)).cast(MONEY_TYPE)


def money_times_sum(c: Column, n: Column) -> Column:
    """SUM(c * n) of an amount and a count (up to ten digits), exact."""
    whole, places = _split(c)
    n = n.cast("decimal(10,0)")
    return _joined(F.sum(whole * n), F.sum(places * n))
