"""Epoch and calendar expressions, all independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def event_time(epoch_ms: Column | str, precision: str = "s") -> Column:
    """Epoch milliseconds as a zone-free timestamp.

    ``precision='s'`` drops the milliseconds (integer division), ``'ms'`` keeps them.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ms = _col(epoch_ms)
    if precision == "ms":
        return F.timestamp_add("MILLISECOND", ms, epoch)
    if precision == "s":
        return F.timestamp_add("SECOND", F.call_function("div", ms, F.lit(1000)), epoch)
    raise ValueError(f"precision must be 's' or 'ms', not {precision!r}")


def event_date(epoch_ms: Column | str) -> Column:
    """Calendar day (UTC) of an epoch in milliseconds."""
    return event_time(epoch_ms, "s").cast("date")


def weekday(ts: Column | str, style: str = "sun0") -> Column:
    """Day of the week: ``mon0`` counts from Monday=0, ``sun0`` Sunday=0, ``sun1`` Sunday=1."""
    ts = _col(ts)
    if style == "mon0":
        return F.weekday(ts)
    if style == "sun0":
        return F.dayofweek(ts) - F.lit(1)
    if style == "sun1":
        return F.dayofweek(ts)
    raise ValueError(f"style must be mon0, sun0 or sun1, not {style!r}")


def time_parts(ts: Column | str, style: str = "sun0") -> dict[str, Column]:
    """The columns of the time dimension derived from one timestamp; weeks are ISO weeks."""
    ts = _col(ts)
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": weekday(ts, style),
    }
