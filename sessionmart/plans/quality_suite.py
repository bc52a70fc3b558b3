"""The declared data-quality suite: 40 generic checks + 2 domain checks.

Each entry is a ``Check``; ``run_suite`` evaluates all of them as Spark queries
and returns one row per check. Severity of the setup -> bars reference check
depends on the target: on a full load every setup symbol must have bars
(error); on a sampled dev load most do not by construction (warn).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionmart import params as P
from sessionmart import schemas
from sessionmart.operators import quality as Q
from sessionmart.sources.readers import conform

PHASES = (P.PHASE_PREMARKET, P.PHASE_REGULAR, P.PHASE_POSTMARKET)
STAGES = (P.STAGE_WON, P.STAGE_LOST, P.STAGE_NEVER)

# bars_exhaustion adds columns to session_vwap: same rows, same keys.
SAME_ROWS = {"bars_exhaustion": "session_vwap"}

MALFORMED_REPORT = ("bar_key", "symbol", "bar_ts_utc", "open_price", "high_price",
                    "low_price", "close_price", "volume")
OUTSIDE_HOURS_REPORT = ("bar_key", "symbol", "session_date", "bar_ts_utc", "bar_ts_et",
                        "bar_time_et")


def malformed_predicate(df: DataFrame):
    """Physically impossible bars: low > high, open/close outside [low, high],
    negative volume. (greatest/least skip NULLs.)"""
    o, h, l, c = (F.col(x) for x in ("open_price", "high_price", "low_price", "close_price"))
    return ((l > h) | (h < F.greatest(o, c)) | (l > F.least(o, c))
            | (F.col("volume") < F.lit(0)))


def outside_hours_predicate(params: P.StrategyParams = P.FROZEN):
    def pred(df: DataFrame):
        t = F.col("bar_time_et")
        return (t < F.lit(P.tod(params.entry_start))) | (t > F.lit(P.tod(params.entry_end)))
    return pred


def source_profile(bars: DataFrame) -> DataFrame:
    """One row about raw bars: rows, malformed bars, NULL cells, duplicate keys.

    One shuffle on the natural key with map-side partial aggregation, then a
    global aggregate of the per-key partials.
    """
    staged = {"open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price"}
    bars = conform(bars, schemas.BARS_NTZ)
    bad = bars.select("symbol", "timestamp", "volume", *[F.col(a).alias(b) for a, b in staged.items()],
                      sum((F.col(f.name).isNull().cast("int") for f in schemas.BARS_NTZ.fields), F.lit(0)).alias("nulls"))
    per_key = bad.groupBy("symbol", "timestamp").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(malformed_predicate(bad)).alias("bad"), F.sum("nulls").alias("nulls"))
    key_ok = F.col("symbol").isNotNull() & F.col("timestamp").isNotNull()
    return per_key.agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.sum("bad").cast("bigint").alias("malformed_bars"),
        F.sum("nulls").cast("bigint").alias("null_cells"),
        F.sum(F.when(key_ok & (F.col("n") > F.lit(1)), F.lit(1)).otherwise(F.lit(0)))
        .cast("bigint").alias("duplicate_keys"))


def suite(target: str = "dev", params: P.StrategyParams = P.FROZEN) -> list[Q.Check]:
    """The 42 checks."""
    rel_severity = "error" if target == "prod" else "warn"
    nn, un, av = Q.not_null, Q.unique, Q.accepted_values
    return [
        # stg_bars (7)
        un("stg_bars", "bar_key"), nn("stg_bars", "bar_key"), nn("stg_bars", "symbol"),
        nn("stg_bars", "bar_ts_utc"), nn("stg_bars", "bar_ts_et"),
        nn("stg_bars", "session_date"), av("stg_bars", "session_phase", PHASES),
        # stg_setups (3)
        nn("stg_setups", "symbol"),
        Q.relationships("stg_setups", "symbol", "stg_bars", "symbol", severity=rel_severity),
        nn("stg_setups", "setup_date"),
        # stg_results (2)
        nn("stg_results", "symbol"), nn("stg_results", "setup_date"),
        # session_vwap (4)
        un("session_vwap", "bar_key"), nn("session_vwap", "bar_key"),
        nn("session_vwap", "symbol"), nn("session_vwap", "session_date"),
        # bars_exhaustion (3)
        un("bars_exhaustion", "bar_key"), nn("bars_exhaustion", "bar_key"),
        av("bars_exhaustion", "criteria_met", (0, 1, 2, 3)),
        # session_features (3)
        Q.unique_combination("session_features", ("symbol", "session_date")),
        nn("session_features", "symbol"), nn("session_features", "session_date"),
        # setup_outcomes (5)
        Q.unique_combination("setup_outcomes", ("symbol", "setup_date")),
        nn("setup_outcomes", "symbol"), nn("setup_outcomes", "setup_date"),
        nn("setup_outcomes", "is_traded"), nn("setup_outcomes", "is_winner"),
        # signal_candidates (6)
        un("signal_candidates", "bar_key"), nn("signal_candidates", "bar_key"),
        nn("signal_candidates", "symbol"), nn("signal_candidates", "session_date"),
        av("signal_candidates", "criteria_met", (2, 3)),
        nn("signal_candidates", "is_best_setup_of_day"),
        # setup_funnel (7)
        Q.unique_combination("setup_funnel", ("symbol", "setup_date")),
        nn("setup_funnel", "symbol"), nn("setup_funnel", "setup_date"),
        nn("setup_funnel", "funnel_stage"), av("setup_funnel", "funnel_stage", STAGES),
        nn("setup_funnel", "is_candidate"), nn("setup_funnel", "has_bar_data"),
        # domain checks (2)
        Q.expression("assert_no_malformed_bars", "stg_bars", malformed_predicate,
                     MALFORMED_REPORT),
        Q.expression("assert_signals_within_market_hours", "signal_candidates",
                     outside_hours_predicate(params), OUTSIDE_HOURS_REPORT),
    ]


def run_suite(models: Mapping[str, DataFrame], target: str = "dev",
              params: P.StrategyParams = P.FROZEN) -> DataFrame:
    """All 42 checks -> (check_name, model, severity, violations, status)."""
    return Q.run_checks(suite(target, params), models, SAME_ROWS)
