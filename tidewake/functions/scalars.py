"""Scalar building blocks as column expressions; everything stays inside codegen, no Python UDF."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(ts: ColumnLike) -> Column:
    """Calendar date of a timestamp."""
    return F.to_date(_col(ts))


def age_on(dob: ColumnLike, ref: ColumnLike) -> Column:
    """Full years between two dates, truncated toward zero; a 29 February birthday is reached on 1 March."""
    return F.timestamp_diff("YEAR", as_date(dob), as_date(ref)).cast("int")


def voyage_length_days(departure: ColumnLike, arrival: ColumnLike) -> Column:
    """Calendar-day difference between arrival and departure."""
    return F.datediff(as_date(arrival), as_date(departure))


def hours_until(event: ColumnLike, departure: ColumnLike) -> Column:
    """Whole elapsed hours from ``event`` to ``departure``, truncated toward zero.

    Computed on the zone-less interval, so a daylight-saving session zone cannot shift it.
    """
    gap = _col(departure).cast("timestamp_ntz") - _col(event).cast("timestamp_ntz")
    return gap.cast("interval hour").cast("int")


def _midnight(day: dt.date | str) -> Column:
    return F.lit(str(day)).cast("timestamp_ntz")


def on_dates(ts: ColumnLike, start: dt.date | str, end: dt.date | str) -> Column:
    """Date of ``ts`` in [start, end], written as a range on the raw timestamp so that it reaches the scan."""
    after = dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)
    return (_col(ts) >= _midnight(start)) & (_col(ts) < _midnight(after))


def on_date(ts: ColumnLike, day: dt.date | str) -> Column:
    return on_dates(ts, day, day)


def money(c: ColumnLike, precision: int = 12, scale: int = 2) -> Column:
    """Stored money type; Spark widens decimals in arithmetic, results are brought back here."""
    return _col(c).cast(f"decimal({precision},{scale})")


def zero_if_null(c: ColumnLike, like: str = "decimal(38,2)") -> Column:
    return F.coalesce(_col(c).cast(like), F.lit(0).cast(like))


def ratio_pct(part: ColumnLike, whole: ColumnLike) -> Column:
    """``part / whole`` in percent with two decimals; NULL when the whole is zero."""
    share = _col(part) * F.lit(100) / F.nullif(_col(whole), F.lit(0))
    return F.round(share, 2).cast("decimal(38,2)")


def map_text(key: ColumnLike, texts: Mapping[str, str], otherwise: str | None = None) -> Column:
    """Simple CASE: literal lookup of ``key`` with a default."""
    out = None
    for value, text in texts.items():
        cond = _col(key) == F.lit(value)
        out = F.when(cond, F.lit(text)) if out is None else out.when(cond, F.lit(text))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def any_of(c: ColumnLike, values: Iterable[str]) -> Column:
    return _col(c).isin(*values)
