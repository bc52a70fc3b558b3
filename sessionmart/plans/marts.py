"""Marts: signal candidates (bar grain) and the setup funnel (setup grain)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionmart import params as P
from sessionmart import schemas
from sessionmart.operators import windows as Wn
from sessionmart.operators.joins import preserving_left_join


def entry_gate(params: P.StrategyParams = P.FROZEN):
    """The quality gates; ALL must hold, a NULL comparison drops the bar."""
    return (F.col("bar_time_et").between(F.lit(P.tod(params.entry_start)),
                                         F.lit(P.tod(params.entry_end)))
            & (F.col("day_gain") >= F.lit(params.day_gain_min))
            & (F.col("close_price") >= F.col("session_vwap"))
            & (F.col("criteria_met") >= F.lit(params.min_criteria)))


def signal_candidates(exh: DataFrame, params: P.StrategyParams = P.FROZEN) -> DataFrame:
    """Every bar that passes the gates, ranked within its session.

    The gate is applied AFTER the windows (they see every regular bar). All
    qualifying bars are kept; the best one per session is flagged, so a
    consumer reproduces one-position-per-day with a filter.
    """
    eligible = exh.where(entry_gate(params))
    ranked = eligible.withColumn(
        "setup_rank", Wn.rank_desc_then_time("vwap_extension_ratio").cast("bigint"))
    return ranked.select(
        *schemas.SIGNAL_CANDIDATES_COLS[:-1],
        (F.col("setup_rank") == F.lit(1)).alias("is_best_setup_of_day"))


def stage(is_winner="is_winner", is_traded="is_traded"):
    """Mutually exclusive funnel stage; order matters (a winner is also traded)."""
    return (F.when(F.col(is_winner), F.lit(P.STAGE_WON))
            .when(F.col(is_traded), F.lit(P.STAGE_LOST))
            .otherwise(F.lit(P.STAGE_NEVER)))


def setup_funnel(outcomes: DataFrame, features: DataFrame) -> DataFrame:
    """One row per candidate setup, enriched with session features where bars exist.

    LEFT join on (symbol, setup_date = session_date): a setup without bars stays
    in the funnel with has_bar_data = false, so the denominator never shrinks.
    """
    f = features.select(
        F.col("symbol").alias("f_symbol"), F.col("session_date").alias("f_session_date"),
        "bar_count", "session_volume", "max_vwap_extension_ratio", "max_day_gain",
        "peak_extension_ts_et", "bars_meeting_2of3")
    j = preserving_left_join(
        outcomes, f,
        (F.col("symbol") == F.col("f_symbol")) & (F.col("setup_date") == F.col("f_session_date")))
    return j.select(
        "symbol", "setup_date", "gain_pct", "days_up", "prior_gain", "trades", "pnl",
        "is_candidate", "is_traded", "is_winner",
        stage().alias("funnel_stage"),
        "bar_count", "session_volume", "max_vwap_extension_ratio", "max_day_gain",
        "peak_extension_ts_et", "bars_meeting_2of3",
        F.col("f_symbol").isNotNull().alias("has_bar_data"),
    )
