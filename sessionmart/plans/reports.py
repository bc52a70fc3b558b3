"""Consumer reports over the marts (the dashboard's queries, as DataFrames).

All are small aggregations of mart rows: partial aggregation runs before the
shuffle, so only one row per group per task crosses the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionmart.operators.aggregates import count_if, ratio_pct
from sessionmart.operators.joins import set_overlap


def _funnel_counts():
    return [
        F.count(F.lit(1)).alias("candidates"),
        count_if(F.col("is_traded")).cast("bigint").alias("traded"),
        count_if(F.col("is_winner")).cast("bigint").alias("won"),
    ]


def kpi_summary(funnel: DataFrame) -> DataFrame:
    """Scorecards: win rate on EXECUTED trades, candidate count, net PnL."""
    return funnel.agg(*_funnel_counts(), F.sum("pnl").alias("net_pnl")).select(
        "candidates", "traded", "won",
        ratio_pct(F.col("won"), F.col("traded")).alias("win_rate_pct"),
        "net_pnl")


def funnel_by_stage(funnel: DataFrame) -> DataFrame:
    """Setups per mutually exclusive funnel stage."""
    return funnel.groupBy("funnel_stage").agg(F.count(F.lit(1)).alias("setups"))


def win_rate_by_days_up(funnel: DataFrame) -> DataFrame:
    """Win rate on executed trades by length of the prior run-up."""
    return (funnel.groupBy("days_up").agg(*_funnel_counts())
            .withColumn("win_rate_pct", ratio_pct(F.col("won"), F.col("traded"))))


def signals_over_time(signals: DataFrame) -> DataFrame:
    """Qualifying bars per session date."""
    return signals.groupBy("session_date").agg(F.count(F.lit(1)).alias("signals"))


def best_signal_per_session(signals: DataFrame) -> DataFrame:
    """One position per day: the flagged best candidate of each session."""
    return signals.where(F.col("is_best_setup_of_day"))


def signal_setup_overlap(signals: DataFrame, setups: DataFrame) -> DataFrame:
    """Backtest setups vs SQL signal-days, one full outer join of distinct keys.

    Signal-day = distinct (symbol, session_date) with at least one candidate.
    overlap_pct = in_both / backtest setups * 100.
    """
    sig_days = signals.select("symbol", "session_date")
    s = setups.select("symbol", F.col("setup_date").alias("session_date"))
    return set_overlap(s, sig_days, ["symbol", "session_date"], a_name="backtest", b_name="signal")


def executed_trade_funnel(funnel: DataFrame) -> DataFrame:
    """candidates -> traded -> won, with the stages in between and the rates."""
    c = funnel.agg(*_funnel_counts())
    return c.select(
        "candidates", "traded", "won",
        (F.col("candidates") - F.col("traded")).alias("never_triggered"),
        (F.col("traded") - F.col("won")).alias("lost"),
        ratio_pct(F.col("traded"), F.col("candidates")).alias("traded_pct"),
        ratio_pct(F.col("won"), F.col("traded")).alias("win_rate_pct"))
