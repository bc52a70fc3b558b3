"""Staging: one model for each source, with typed and renamed columns and New York time.

Each source row gives one staged row; bad rows pass through and are found by the check suite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionmart import schemas
from sessionmart.functions import (
    fraction_from_percent,
    int_flag,
    session_phase,
    surrogate_key,
    time_of_day,
    to_et,
)
from sessionmart.sources.readers import conform


def _require_settings(df: DataFrame) -> None:
    tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if df.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("spark.sql.ansi.enabled must be true (bad casts must fail, not become NULL)")
    if tz not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"session time zone must be UTC, got {tz!r} "
                         "(bar timestamps are UTC instants)")


def stg_bars(raw: DataFrame) -> DataFrame:
    """Raw bars -> typed, renamed, with bar_key and ET session context.

    The UTC -> New York conversion happens exactly once, here.
    """
    _require_settings(raw)
    src = conform(raw, schemas.BARS_NTZ)
    with_et = src.withColumn("bar_ts_et", to_et("timestamp"))
    parts = with_et.withColumns({
        "session_date": F.to_date("bar_ts_et"),
        "bar_time_et": time_of_day("bar_ts_et"),
    })
    return parts.select(
        surrogate_key("symbol", "timestamp", timestamp_cols=("timestamp",)).alias("bar_key"),
        "symbol",
        F.col("timestamp").alias("bar_ts_utc"),
        "bar_ts_et",
        "session_date",
        "bar_time_et",
        F.col("open").alias("open_price"),
        F.col("high").alias("high_price"),
        F.col("low").alias("low_price"),
        F.col("close").alias("close_price"),
        "volume",
        F.col("vwap").alias("bar_vwap"),
        session_phase("bar_time_et").alias("session_phase"),
    )


def stg_setups(seed: DataFrame) -> DataFrame:
    """Setup seed -> typed; percent gain becomes a fraction."""
    return seed.select(
        "symbol",
        F.col("date").cast("date").alias("setup_date"),
        F.col("open").cast("double").alias("open_price"),
        F.col("high").cast("double").alias("high_price"),
        F.col("low").cast("double").alias("low_price"),
        F.col("close").cast("double").alias("close_price"),
        F.col("volume").cast("bigint").alias("setup_volume"),
        fraction_from_percent("gain_percent").alias("gain_pct"),
        F.col("days_up").cast("int").alias("days_up"),
        F.col("prior_gain").cast("double").alias("prior_gain"),
    )


def stg_results(seed: DataFrame) -> DataFrame:
    """Backtest-result seed -> typed; 0/1 win/loss become booleans."""
    return seed.select(
        "symbol",
        F.col("date").cast("date").alias("setup_date"),
        fraction_from_percent("gain_pct").alias("gain_pct"),
        F.col("days_up").cast("int").alias("days_up"),
        F.col("volume").cast("bigint").alias("setup_volume"),
        F.col("trades").cast("int").alias("trades"),
        F.col("pnl").cast("double").alias("pnl"),
        int_flag("win").alias("is_win"),
        int_flag("loss").alias("is_loss"),
    )
