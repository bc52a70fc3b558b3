"""Column -> Column building blocks (all built-in Spark expressions, no UDFs)."""

from sessionmart.functions.scalar import (
    bool_to_int,
    fraction_from_percent,
    int_flag,
    is_regular_session,
    is_regular_time,
    round_scaled,
    safe_div,
    session_phase,
    surrogate_key,
    time_of_day,
    to_et,
    to_utc_ntz,
)

__all__ = [
    "bool_to_int",
    "fraction_from_percent",
    "int_flag",
    "is_regular_session",
    "is_regular_time",
    "round_scaled",
    "safe_div",
    "session_phase",
    "surrogate_key",
    "time_of_day",
    "to_et",
    "to_utc_ntz",
]
