"""Declared input schemas (no inference anywhere) and model output contracts."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Raw one-minute bars, as the vendor sends them. ``timestamp`` is the bar OPEN
# time, a UTC instant. Key (symbol, timestamp); sparse, no dense minute grid.
BARS = StructType([
    StructField("timestamp", TimestampType()),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("close", DoubleType()),
    StructField("volume", DoubleType()),
    StructField("vwap", DoubleType()),
    StructField("symbol", StringType()),
])

# Same columns with the UTC wall clock as ``timestamp_ntz``.
BARS_NTZ = StructType([
    StructField("timestamp", TimestampNTZType()) if f.name == "timestamp" else f
    for f in BARS.fields
])

# Candidate setups (CSV seed). gain_percent is a PERCENT (66.5).
SETUPS = StructType([
    StructField("symbol", StringType()),
    StructField("date", DateType()),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("close", DoubleType()),
    StructField("volume", LongType()),
    StructField("gain_percent", DoubleType()),
    StructField("days_up", IntegerType()),
    StructField("prior_gain", DoubleType()),
])

# Backtest outcome per setup (CSV seed). gain_pct is a PERCENT; win/loss 0/1.
RESULTS = StructType([
    StructField("symbol", StringType()),
    StructField("date", DateType()),
    StructField("gain_pct", DoubleType()),
    StructField("days_up", IntegerType()),
    StructField("volume", LongType()),
    StructField("trades", IntegerType()),
    StructField("pnl", DoubleType()),
    StructField("win", IntegerType()),
    StructField("loss", IntegerType()),
])

# Output column orders of the models (contracts).
STG_BARS_COLS = [
    "bar_key", "symbol", "bar_ts_utc", "bar_ts_et", "session_date", "bar_time_et",
    "open_price", "high_price", "low_price", "close_price", "volume", "bar_vwap",
    "session_phase",
]
STG_SETUPS_COLS = [
    "symbol", "setup_date", "open_price", "high_price", "low_price", "close_price",
    "setup_volume", "gain_pct", "days_up", "prior_gain",
]
STG_RESULTS_COLS = [
    "symbol", "setup_date", "gain_pct", "days_up", "setup_volume", "trades", "pnl",
    "is_win", "is_loss",
]
SESSION_VWAP_COLS = [
    "bar_key", "symbol", "bar_ts_utc", "bar_ts_et", "session_date", "bar_time_et",
    "open_price", "high_price", "low_price", "close_price", "volume", "typical_price",
    "day_open", "day_high", "session_vwap", "vwap_extension_ratio", "day_gain",
]
EXHAUSTION_COLS = SESSION_VWAP_COLS + [
    "vol_peak_10", "volume_ratio", "proximity_to_high", "meets_vwap_extension",
    "meets_volume_exhaustion", "meets_proximity", "criteria_met",
]
SESSION_FEATURES_COLS = [
    "symbol", "session_date", "bar_count", "session_volume", "max_vwap_extension_ratio",
    "max_day_gain", "day_high", "day_open", "first_bar_ts_et", "last_bar_ts_et",
    "peak_extension_ts_et", "max_criteria_met", "bars_meeting_2of3",
]
SETUP_OUTCOMES_COLS = [
    "symbol", "setup_date", "gain_pct", "days_up", "prior_gain", "setup_volume",
    "trades", "pnl", "is_win", "is_candidate", "is_traded", "is_winner",
]
SIGNAL_CANDIDATES_COLS = [
    "bar_key", "symbol", "session_date", "bar_ts_utc", "bar_ts_et", "bar_time_et",
    "close_price", "volume", "session_vwap", "vwap_extension_ratio", "volume_ratio",
    "proximity_to_high", "day_open", "day_high", "day_gain", "meets_vwap_extension",
    "meets_volume_exhaustion", "meets_proximity", "criteria_met", "setup_rank",
    "is_best_setup_of_day",
]
SETUP_FUNNEL_COLS = [
    "symbol", "setup_date", "gain_pct", "days_up", "prior_gain", "trades", "pnl",
    "is_candidate", "is_traded", "is_winner", "funnel_stage", "bar_count",
    "session_volume", "max_vwap_extension_ratio", "max_day_gain", "peak_extension_ts_et",
    "bars_meeting_2of3", "has_bar_data",
]

# Result of the data-quality suite: one row per check.
DQ_RESULT = StructType([
    StructField("check_name", StringType()),
    StructField("model", StringType()),
    StructField("severity", StringType()),
    StructField("violations", LongType()),
    StructField("status", StringType()),
])

