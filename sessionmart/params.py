"""Frozen strategy parameters and other fixed values.

One frozen dataclass holds the thresholds. Callers may pass another instance (tests
do); every query uses the default.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values (must stay exactly as written) ---------------------------------
# Named time zones: every source timestamp is UTC, every rule below is New York time.
SOURCE_ZONE = "UTC"
MARKET_ZONE = "America/New_York"
# Session phase boundaries (ET wall clock, half-open ranges).
PREMARKET_START = "04:00:00"
REGULAR_START = "09:30:00"
REGULAR_END = "16:00:00"
# Phase labels.
PHASE_PREMARKET = "premarket"
PHASE_REGULAR = "regular"
PHASE_POSTMARKET = "postmarket"
# Funnel stage labels.
STAGE_WON = "won"
STAGE_LOST = "lost"
STAGE_NEVER = "never_triggered"
# Surrogate key: md5 over the '-'-joined text of the key columns, NULL replaced by
# this token (the convention of the public dbt_utils package).
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEP = "-"
# Text forms of temporal values (fixed width, microsecond precision).
TIME_OF_DAY_FORMAT = "HH:mm:ss.SSSSSS"
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# Ingest report: estimated logical warehouse bytes per bar row.
EST_BYTES_PER_ROW = 62
# Grain guard: a modal gap of a day or more means daily bars, not minute bars.
DAILY_GAP_SECONDS = 86_400
# The frozen ten-symbol development sample (bars of these symbols only).
SAMPLE_SYMBOLS = ("GOVX", "INDO", "MI", "PDYN", "ERNA", "XTKG", "LGVN", "GFAI", "KALA", "WAFU")
# -----------------------------------------------------------------------------------


def tod(hms: str) -> str:
    """'09:45:00' -> '09:45:00.000000', the fixed-width form bar_time_et uses."""
    return f"{hms}.000000"


@dataclass(frozen=True)
class StrategyParams:
    """2-of-3 entry criteria and quality gates (frozen values)."""

    vwap_extension_min: float = 1.15      # close / session_vwap >= 1.15
    volume_ratio_max: float = 0.70        # volume / rolling peak <= 0.70
    proximity_min: float = 0.93           # close / day_high >= 0.93
    day_gain_min: float = 0.50            # (day_high - day_open) / day_open >= 0.50
    volume_peak_bars: int = 10            # rolling peak over the last 10 BARS incl. current
    min_criteria: int = 2                 # 2 of 3
    entry_start: str = "09:45:00"         # entry window, inclusive both ends
    entry_end: str = "14:00:00"


FROZEN = StrategyParams()
