"""Scalar expressions: time zone, time of day, session phase, keys, safe ratios.

Every function takes and returns ``Column`` so Catalyst sees one expression
tree and keeps it inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from sessionmart import params as P


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_utc_ntz(c: Column | str, dtype=None) -> Column:
    """Normalise a bar timestamp to a zone-less UTC wall clock (``timestamp_ntz``).

    ``timestamp`` (an instant) is cast under the session zone, which the
    pipeline pins to UTC, so the result is the UTC wall clock. ``timestamp_ntz``
    input is already a UTC wall clock and passes through.
    """
    c = _col(c)
    if dtype is None or isinstance(dtype, TimestampType):
        return c.cast(TimestampNTZType())
    return c


def to_et(ts_utc: Column | str) -> Column:
    """UTC wall clock -> New York wall clock (naive), by named zone.

    The one call site of the zone conversion. DST rules come from the JVM's
    zone database; there is never a fixed offset. Output is ``timestamp_ntz``.
    """
    return F.convert_timezone(F.lit(P.SOURCE_ZONE), F.lit(P.MARKET_ZONE),
                              _col(ts_utc).cast(TimestampNTZType()))


def time_of_day(ts: Column | str) -> Column:
    """Fixed-width ``HH:mm:ss.SSSSSS`` text; sorts exactly like a TIME value.

    Spark 4.1 cannot cast a timestamp to TIME, and truncating to seconds would
    wrongly admit 14:00:00.5 to a 14:00:00-inclusive gate, so microseconds stay.
    """
    return F.date_format(_col(ts), P.TIME_OF_DAY_FORMAT)


def is_regular_session(tod: Column | str) -> Column:
    """``tod`` in [09:30, 16:00) -- exactly ``session_phase(tod) = 'regular'``,
    written as a plain range test so a pushed-down filter stays cheap."""
    t = _col(tod)
    return (t >= F.lit(P.tod(P.REGULAR_START))) & (t < F.lit(P.tod(P.REGULAR_END)))


def is_regular_time(ts: Column | str) -> Column:
    """The same test on a New York wall clock, by minutes of the day (no text is formed)."""
    t = _col(ts)
    minute = F.hour(t) * 60 + F.minute(t)
    start, end = (60 * int(x[:2]) + int(x[3:5]) for x in (P.tod(P.REGULAR_START), P.tod(P.REGULAR_END)))
    return (minute >= F.lit(start)) & (minute < F.lit(end))


def session_phase(tod: Column | str) -> Column:
    """Searched CASE over the ET time of day.

    [09:30, 16:00) regular, [04:00, 09:30) premarket, everything else
    postmarket -- including 00:00-04:00 (a stated boundary of the definition).
    """
    t = _col(tod)
    reg0, pre0 = P.tod(P.REGULAR_START), P.tod(P.PREMARKET_START)
    return (F.when(is_regular_session(t), F.lit(P.PHASE_REGULAR))
            .when((t >= F.lit(pre0)) & (t < F.lit(reg0)), F.lit(P.PHASE_PREMARKET))
            .otherwise(F.lit(P.PHASE_POSTMARKET)))


def surrogate_key(*cols: Column | str, timestamp_cols: tuple[str, ...] = ()) -> Column:
    """md5 of the '-'-joined text of the columns, NULL -> fixed token.

    Timestamps are rendered with an explicit format so the key never depends
    on an engine's default text form of a timestamp.
    """
    parts = []
    for c in cols:
        name = c if isinstance(c, str) else None
        e = _col(c)
        if name is not None and name in timestamp_cols:
            e = F.date_format(e, P.TIMESTAMP_TEXT_FORMAT)
        else:
            e = e.cast("string")
        parts.append(F.coalesce(e, F.lit(P.SURROGATE_KEY_NULL)))
    joined = parts[0]
    for p in parts[1:]:
        joined = F.concat(joined, F.lit(P.SURROGATE_KEY_SEP), p)
    return F.md5(joined)


def safe_div(num: Column | str, den: Column | str) -> Column:
    """``num / nullif(den, 0)``: NULL instead of an error (ANSI) or infinity."""
    return _col(num) / F.nullif(_col(den), F.lit(0))


def bool_to_int(b: Column | str) -> Column:
    """``case when b then 1 else 0 end`` -- NULL counts as 0 (unlike a cast)."""
    return F.when(_col(b), F.lit(1)).otherwise(F.lit(0))


def int_flag(c: Column | str) -> Column:
    """0/1 integer column -> boolean, ``cast(c as int) = 1`` (NULL stays NULL)."""
    return _col(c).cast("int") == F.lit(1)


def fraction_from_percent(c: Column | str) -> Column:
    """Percent (66.5) -> fraction (0.665)."""
    return _col(c).cast("double") / F.lit(100.0)


def round_scaled(c: Column | str, digits: int = 6) -> Column:
    """Round a double to ``digits`` places as ``round(c * 10^d) / 10^d``.

    Rounds the binary value (half away from zero on the scaled product), so a
    value whose decimal text ends in 5 at digit d+1 but whose binary value lies
    just below it rounds down -- the same result other engines give for their
    ``round(x, d)`` on doubles.
    """
    scale = F.lit(float(10 ** digits))
    return F.round(_col(c) * scale) / scale
