"""Intermediate models: session VWAP, 2-of-3 criteria, session features, outcomes.

Plan shape: ``session_vwap`` and ``bars_exhaustion`` need one Exchange on
(symbol, session_date) and one Sort; all five running/rolling windows evaluate
in Window operators over that single ordering. ``session_features`` aggregates
on it without another Exchange or Sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionmart import params as P
from sessionmart import schemas
from sessionmart.functions import bool_to_int, is_regular_time, safe_div
from sessionmart.operators import windows as Wn
from sessionmart.operators.aggregates import count_if
from sessionmart.operators.joins import preserving_left_join
from sessionmart.operators.long_sessions import LongSessions


def regular_bars(stg: DataFrame) -> DataFrame:
    """Bars of the regular session.

    session_phase = 'regular', stated as the equivalent range test on the
    minutes of the day (cheaper once Catalyst pushes it below the source).
    """
    return stg.where(is_regular_time("bar_ts_et"))


def with_session_totals(stg: DataFrame) -> DataFrame:
    """Regular-session bars with typical price, running totals and session VWAP."""
    tp = regular_bars(stg).withColumn(
        "typical_price",
        (F.col("high_price") + F.col("low_price") + F.col("close_price")) / F.lit(3.0))
    cum = Wn.with_running_vwap(tp)
    return cum.withColumn("session_vwap", safe_div("cum_tp_volume", "cum_volume"))


def session_vwap(stg: DataFrame, long: LongSessions | None = None) -> DataFrame:
    """Regular-session bars with session-anchored cumulative VWAP.

    The regular-session filter comes BEFORE the windows, so the anchor is the
    first existing bar at or after 09:30 ET (not a literal 09:30 bar).
    day_high / day_gain are running values ("so far"), not session finals.
    With ``long`` its sessions are worked on in chunks; the rows are the same.
    """
    if long is None:
        vw = with_session_totals(stg).withColumns({
            "day_high": Wn.running_max("high_price"),
            "day_open": Wn.session_first("open_price"),
        })
    else:
        tp = regular_bars(stg).withColumn(
            "typical_price", (F.col("high_price") + F.col("low_price") + F.col("close_price")) / F.lit(3.0))
        vw = long.running(tp, {
            "cum_tp_volume": ("sum", F.col("typical_price") * F.col("volume")), "cum_volume": ("sum", "volume"),
            "day_high": ("max", "high_price"), "day_open": ("first", "open_price"),
        }).withColumn("session_vwap", safe_div("cum_tp_volume", "cum_volume"))
    return vw.select(
        *schemas.SESSION_VWAP_COLS[:-2],
        safe_div("close_price", "session_vwap").alias("vwap_extension_ratio"),
        safe_div(F.col("day_high") - F.col("day_open"), F.col("day_open")).alias("day_gain"),
    )


def bars_exhaustion(vwap: DataFrame, params: P.StrategyParams = P.FROZEN, long: LongSessions | None = None) -> DataFrame:
    """Per-bar 2-of-3 entry criteria over the session-VWAP bars.

    vol_peak_10 is the max volume over the last 10 BARS of the session,
    including the current one; it restarts each session. A NULL criterion
    counts as not met.
    """
    if long is None:
        peak = vwap.withColumn("vol_peak_10", Wn.trailing_max("volume", params.volume_peak_bars))
    else:
        peak = long.trailing_max(vwap, "vol_peak_10", "volume", params.volume_peak_bars)
    ratios = peak.withColumns({
        "volume_ratio": safe_div("volume", "vol_peak_10"),
        "proximity_to_high": safe_div("close_price", "day_high"),
    })
    crit = ratios.withColumns({
        "meets_vwap_extension": F.col("vwap_extension_ratio") >= F.lit(params.vwap_extension_min),
        "meets_volume_exhaustion": F.col("volume_ratio") <= F.lit(params.volume_ratio_max),
        "meets_proximity": F.col("proximity_to_high") >= F.lit(params.proximity_min),
    })
    return crit.withColumn(
        "criteria_met",
        bool_to_int("meets_vwap_extension") + bool_to_int("meets_volume_exhaustion")
        + bool_to_int("meets_proximity"))


def session_features(exh: DataFrame, params: P.StrategyParams = P.FROZEN) -> DataFrame:
    """Bar grain -> one row per (symbol, session_date).

    peak_extension_ts_et is the ET time of the most extended bar, ties to the
    earliest bar; a session whose ratios are all NULL still has a rank-1 bar
    (its earliest).
    """
    # ascending order of (minus the ratio, a missing ratio last; bar time)
    order = F.struct(F.col("vwap_extension_ratio").isNull(), -F.col("vwap_extension_ratio"), F.col("bar_ts_utc"))
    return exh.groupBy(*Wn.SESSION_KEYS).agg(
        F.count(F.lit(1)).alias("bar_count"),
        F.sum("volume").alias("session_volume"),
        F.max("vwap_extension_ratio").alias("max_vwap_extension_ratio"),
        F.max("day_gain").alias("max_day_gain"),
        F.max("day_high").alias("day_high"),
        F.min("day_open").alias("day_open"),
        F.min("bar_ts_et").alias("first_bar_ts_et"),
        F.max("bar_ts_et").alias("last_bar_ts_et"),
        F.min_by("bar_ts_et", order).alias("peak_extension_ts_et"),
        F.max("criteria_met").alias("max_criteria_met"),
        count_if(F.col("criteria_met") >= F.lit(params.min_criteria)).cast("bigint")
        .alias("bars_meeting_2of3"),
    )


def setup_outcomes(setups: DataFrame, results: DataFrame) -> DataFrame:
    """Every candidate setup with its backtest outcome (left join: a setup
    without a result row stays a candidate and reads as not traded)."""
    r = results.select(
        F.col("symbol").alias("r_symbol"), F.col("setup_date").alias("r_setup_date"),
        "trades", "pnl", "is_win")
    j = preserving_left_join(
        setups, r,
        (F.col("symbol") == F.col("r_symbol")) & (F.col("setup_date") == F.col("r_setup_date")))
    traded = F.col("trades") > F.lit(0)
    return j.select(
        "symbol", "setup_date", "gain_pct", "days_up", "prior_gain", "setup_volume",
        "trades", "pnl", "is_win",
        F.lit(True).alias("is_candidate"),
        F.coalesce(traded, F.lit(False)).alias("is_traded"),
        F.coalesce(traded & F.col("is_win"), F.lit(False)).alias("is_winner"),
    )
