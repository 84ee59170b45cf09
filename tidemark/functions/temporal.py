"""Time helpers.  Inputs are wall-clock timestamps (``timestamp_ntz``) or ``timestamp``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: object) -> Column:
    """A wall-clock literal, whatever the session or process time zone is."""
    return F.lit(str(value)).cast("timestamp_ntz")


def trunc_ntz(unit: str, c: Column | str) -> Column:
    """``date_trunc`` that gives back wall-clock time."""
    return F.date_trunc(unit, _col(c)).cast("timestamp_ntz")


def quarter_hour(c: Column | str) -> Column:
    """Quarter of the hour a time falls in, as text: 00, 15, 30 or 45."""
    return F.lpad((F.floor(F.minute(_col(c)) / 15) * 15).cast("string"), 2, "0")


def hour_text(c: Column | str) -> Column:
    return F.lpad(F.hour(_col(c)).cast("string"), 2, "0")


def iso_weekday(c: Column | str) -> Column:
    """Monday is 1, Sunday is 7."""
    return (F.weekday(_col(c)) + 1).cast("long")


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since 1970 of a wall-clock time, without any zone conversion."""
    t = _col(c)
    return (
        F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400
        + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    )


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a wall-clock time, without any zone conversion."""
    t = _col(c)
    seconds = (F.date_part(F.lit("SECOND"), t) * 1000000).cast("long")
    return (
        F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400000000
        + (F.hour(t) * 3600 + F.minute(t) * 60).cast("long") * 1000000 + seconds
    )


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Complete days between two times, cut towards zero as an interval's day part."""
    return F.call_function("div", epoch_micros(later) - epoch_micros(earlier), F.lit(86400000000))


def epoch_ms_to_iso(c: Column | str) -> Column:
    """Epoch milliseconds to ``yyyy-MM-ddTHH:mm:ssZ`` in UTC."""
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=F.floor(_col(c) / 1000).cast("decimal(18,6)"))
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_s_to_text(c: Column | str) -> Column:
    """Epoch seconds to ``yyyy-MM-dd HH:mm:ss`` in UTC, for any session zone."""
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=_col(c).cast("decimal(18,6)"))
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
