"""Layers that outlive the session: permanent SQL functions, and permanent views for the models that are not tables.

The functions state the scalar expressions of ``functions.scalar`` once more as SQL (``CREATE FUNCTION ... RETURN``), so
that any session, notebook or BI tool can use them; the optimiser puts their bodies in place of the calls. The views stand on the
catalog tables of the raw, staging and intermediate namespaces and read them anew each time. ``tests`` hold them equal to
the DataFrame models.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from sessionmart import params as P

_PHASES = f"""CASE WHEN tod >= '{P.tod(P.REGULAR_START)}' AND tod < '{P.tod(P.REGULAR_END)}' THEN '{P.PHASE_REGULAR}'
     WHEN tod >= '{P.tod(P.PREMARKET_START)}' AND tod < '{P.tod(P.REGULAR_START)}' THEN '{P.PHASE_PREMARKET}'
     ELSE '{P.PHASE_POSTMARKET}' END"""

#: name, parameters, result type, body
FUNCTIONS = [
    ("to_et", "ts TIMESTAMP_NTZ", "TIMESTAMP_NTZ", f"convert_timezone('{P.SOURCE_ZONE}', '{P.MARKET_ZONE}', ts)"),
    ("time_of_day", "ts TIMESTAMP_NTZ", "STRING", f"date_format(ts, '{P.TIME_OF_DAY_FORMAT}')"),
    ("session_phase", "tod STRING", "STRING", _PHASES),
    ("safe_div", "num DOUBLE, den DOUBLE", "DOUBLE", "num / nullif(den, 0.0D)"),
    ("bar_key", "symbol STRING, ts TIMESTAMP_NTZ", "STRING",
     f"md5(concat(coalesce(symbol, '{P.SURROGATE_KEY_NULL}'), '{P.SURROGATE_KEY_SEP}', "
     f"coalesce(date_format(ts, '{P.TIMESTAMP_TEXT_FORMAT}'), '{P.SURROGATE_KEY_NULL}')))"),
    ("fraction_from_percent", "pct DOUBLE", "DOUBLE", "pct / 100.0D"),
]


def create_functions(spark: SparkSession, database: str) -> list[str]:
    """The functions in ``database``; returns their full names."""
    for name, given, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}({given}) RETURNS {result} RETURN {body}")
    return [f"{database}.{name}" for name, *_ in FUNCTIONS]


def _staged_bars(f: str, raw: str) -> str:
    et = f"{f}.to_et(CAST(timestamp AS TIMESTAMP_NTZ))"
    return f"""SELECT {f}.bar_key(symbol, bar_ts_utc) AS bar_key, symbol, bar_ts_utc, bar_ts_et, CAST(bar_ts_et AS DATE) AS session_date,
       {f}.time_of_day(bar_ts_et) AS bar_time_et, open_price, high_price, low_price, close_price, volume, bar_vwap,
       {f}.session_phase({f}.time_of_day(bar_ts_et)) AS session_phase
FROM (SELECT symbol, CAST(timestamp AS TIMESTAMP_NTZ) AS bar_ts_utc, {et} AS bar_ts_et, CAST(open AS DOUBLE) AS open_price,
             CAST(high AS DOUBLE) AS high_price, CAST(low AS DOUBLE) AS low_price, CAST(close AS DOUBLE) AS close_price,
             CAST(volume AS DOUBLE) AS volume, CAST(vwap AS DOUBLE) AS bar_vwap FROM {raw})"""


def _exhaustion(f: str, vwap: str, p: P.StrategyParams) -> str:
    met = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END"
    return f"""SELECT *, {" + ".join(met(c) for c in ("meets_vwap_extension", "meets_volume_exhaustion", "meets_proximity"))} AS criteria_met
FROM (SELECT *, vwap_extension_ratio >= {p.vwap_extension_min!r}D AS meets_vwap_extension, volume_ratio <= {p.volume_ratio_max!r}D AS meets_volume_exhaustion,
             proximity_to_high >= {p.proximity_min!r}D AS meets_proximity
      FROM (SELECT *, {f}.safe_div(volume, vol_peak_10) AS volume_ratio, {f}.safe_div(close_price, day_high) AS proximity_to_high
            FROM (SELECT *, max(volume) OVER (PARTITION BY symbol, session_date ORDER BY bar_ts_utc
                                              ROWS BETWEEN {p.volume_peak_bars - 1} PRECEDING AND CURRENT ROW) AS vol_peak_10 FROM {vwap})))"""


def _outcomes(setups: str, results: str) -> str:
    return f"""SELECT s.symbol, s.setup_date, s.gain_pct, s.days_up, s.prior_gain, s.setup_volume, r.trades, r.pnl, r.is_win, true AS is_candidate,
       coalesce(r.trades > 0, false) AS is_traded, coalesce(r.trades > 0 AND r.is_win, false) AS is_winner
FROM {setups} s LEFT JOIN {results} r ON s.symbol = r.symbol AND s.setup_date = r.setup_date"""


def create_views(spark: SparkSession, layers: dict[str, str], bars_table: str, params: P.StrategyParams = P.FROZEN) -> dict[str, str]:
    """Functions in the staging namespace and views over the written tables: model name -> full name."""
    f = layers["staging"]
    create_functions(spark, f)
    bodies = {
        f"{layers['staging']}.stg_bars": _staged_bars(f, bars_table),
        f"{layers['intermediate']}.bars_exhaustion": _exhaustion(f, f"{layers['intermediate']}.session_vwap", params),
        f"{layers['intermediate']}.setup_outcomes": _outcomes(f"{f}.stg_setups", f"{f}.stg_results"),
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")
    return {name.rpartition(".")[2]: name for name in bodies}
