"""The same queries in plain SQL (DuckDB dialect), as an independent oracle.

Each entry of ``ORACLE`` is a complete statement over the provided tables
(``events`` is the only one read). The shared WITH-chain restates the
test-data adapters and every model; each query adds its final SELECT.
Doubles are rounded to 6 places in the final SELECT, like the Spark side.
Integer sums are cast to BIGINT (DuckDB sums integers as HUGEINT).
"""

from __future__ import annotations

from sessionmart import params as P
from sessionmart import schemas

NULL_TOKEN = P.SURROGATE_KEY_NULL

# Double-typed output columns (rounded in the final projection).
DOUBLES = {
    "open", "high", "low", "close", "volume", "vwap", "open_price", "high_price",
    "low_price", "close_price", "bar_vwap", "typical_price", "day_open", "day_high",
    "session_vwap", "vwap_extension_ratio", "day_gain", "vol_peak_10", "volume_ratio",
    "proximity_to_high", "session_volume", "max_vwap_extension_ratio", "max_day_gain",
    "gain_pct", "prior_gain", "pnl", "net_pnl", "win_rate_pct", "traded_pct", "overlap_pct",
    "cum_tp_volume", "cum_volume", "total_volume", "day_volume",
}

_ET = "((({c}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"


def _et(c: str) -> str:
    return _ET.format(c=c)


_ADAPTERS = f"""
WITH ev AS (
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
    FROM events
),
clean_bars AS (
    SELECT date_trunc('minute', ts) AS "timestamp",
           arg_min(value, row(ts, event_id)) AS open,
           max(value) AS high,
           min(value) AS low,
           arg_max(value, row(ts, event_id)) AS close,
           sum(k) AS volume,
           sum(value * k) / nullif(sum(k), 0) AS vwap,
           'U' || CAST(user_id AS VARCHAR) AS symbol
    FROM ev
    GROUP BY user_id, date_trunc('minute', ts)
),
ev_et AS (
    SELECT *, CAST({_et('ts')} AS DATE) AS et_date FROM ev
),
clean_setups AS (
    SELECT symbol, date, open, high, low, close, volume,
           100.0 * (high / nullif(low, 0) - 1.0) AS gain_percent,
           days_up,
           close / nullif(open, 0) - 1.0 AS prior_gain
    FROM (
        SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, et_date AS date,
               arg_min(value, row(ts, event_id)) AS open, max(value) AS high,
               min(value) AS low, arg_max(value, row(ts, event_id)) AS close,
               CAST(sum(k) AS BIGINT) AS volume, CAST(count(*) AS INTEGER) AS days_up
        FROM ev_et WHERE event_type IN ('signup', 'view')
        GROUP BY user_id, et_date
    )
),
clean_results AS (
    SELECT symbol, date, 100.0 * (hi / nullif(lo, 0) - 1.0) AS gain_pct, days_up, volume,
           trades, pnl,
           CASE WHEN trades > 0 AND pnl > 0 THEN 1 ELSE 0 END AS win,
           CASE WHEN trades > 0 AND pnl <= 0 THEN 1 ELSE 0 END AS loss
    FROM (
        SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, et_date AS date,
               max(value) AS hi, min(value) AS lo, CAST(count(*) AS INTEGER) AS days_up,
               CAST(sum(k) AS BIGINT) AS volume,
               CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INTEGER) AS trades,
               round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE -value END), 6) AS pnl
        FROM ev_et WHERE event_type IN ('purchase', 'error')
        GROUP BY user_id, et_date
    )
)
"""

_STAGING = f"""
stg_et AS (
    SELECT *, {_et('"timestamp"')} AS et FROM raw_bars
),
stg_parts AS (
    SELECT *, CAST(et AS DATE) AS session_date, strftime(et, '%H:%M:%S.%f') AS tod FROM stg_et
),
stg_bars AS (
    SELECT md5(coalesce(symbol, '{NULL_TOKEN}') || '-' ||
               coalesce(strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f'), '{NULL_TOKEN}')) AS bar_key,
           symbol, "timestamp" AS bar_ts_utc, et AS bar_ts_et, session_date, tod AS bar_time_et,
           open AS open_price, high AS high_price, low AS low_price, close AS close_price,
           volume, vwap AS bar_vwap,
           CASE WHEN tod >= '09:30:00.000000' AND tod < '16:00:00.000000' THEN 'regular'
                WHEN tod >= '04:00:00.000000' AND tod < '09:30:00.000000' THEN 'premarket'
                ELSE 'postmarket' END AS session_phase
    FROM stg_parts
),
stg_setups AS (
    SELECT symbol, date AS setup_date,
           CAST(open AS DOUBLE) AS open_price, CAST(high AS DOUBLE) AS high_price,
           CAST(low AS DOUBLE) AS low_price, CAST(close AS DOUBLE) AS close_price,
           CAST(volume AS BIGINT) AS setup_volume,
           CAST(gain_percent AS DOUBLE) / 100.0 AS gain_pct,
           CAST(days_up AS INTEGER) AS days_up, CAST(prior_gain AS DOUBLE) AS prior_gain
    FROM setups
),
stg_results AS (
    SELECT symbol, date AS setup_date, CAST(gain_pct AS DOUBLE) / 100.0 AS gain_pct,
           CAST(days_up AS INTEGER) AS days_up, CAST(volume AS BIGINT) AS setup_volume,
           CAST(trades AS INTEGER) AS trades, CAST(pnl AS DOUBLE) AS pnl,
           CAST(win AS INTEGER) = 1 AS is_win, CAST(loss AS INTEGER) = 1 AS is_loss
    FROM results
),
"""

_AS_GIVEN = """
raw_bars AS (SELECT * FROM clean_bars),
setups AS (SELECT * FROM clean_setups),
results AS (SELECT * FROM clean_results),
"""

_PLANTED = """
faulty AS (
    SELECT "timestamp", open,
           CASE WHEN minute("timestamp") % 7 = 0 AND high > low THEN low ELSE high END AS high,
           CASE WHEN minute("timestamp") % 7 = 0 AND high > low THEN high ELSE low END AS low,
           close, volume, vwap, CASE WHEN minute("timestamp") <> 13 THEN symbol END AS symbol
    FROM clean_bars WHERE right(symbol, 1) <> '5'
),
raw_bars AS (SELECT * FROM faulty UNION ALL SELECT * FROM faulty WHERE minute("timestamp") % 11 = 0),
twice AS (SELECT * FROM clean_setups UNION ALL SELECT * FROM clean_setups WHERE day(date) % 5 = 0),
setups AS (SELECT * REPLACE (CASE WHEN day(date) <> 13 THEN symbol END AS symbol) FROM twice),
results AS (SELECT * REPLACE (CASE WHEN day(date) <> 13 THEN date END AS date) FROM clean_results),
"""

# The models stated by sets instead of running windows: each regular bar is joined
# to the bars of its session up to it; ranks count the bars that come before.
_MODELS = f"""
regular AS (
    SELECT *, (high_price + low_price + close_price) / 3.0 AS typical_price,
           row_number() OVER (PARTITION BY symbol, session_date ORDER BY bar_ts_utc) AS nth
    FROM stg_bars WHERE session_phase = 'regular'
),
up_to AS (
    SELECT b.symbol, b.session_date, b.nth,
           list(p.typical_price * p.volume ORDER BY p.nth) AS money, list(p.volume ORDER BY p.nth) AS volumes,
           max(p.high_price) AS day_high, list(p.open_price ORDER BY p.nth)[1] AS day_open
    FROM regular b JOIN regular p
      ON p.symbol IS NOT DISTINCT FROM b.symbol AND p.session_date = b.session_date AND p.nth <= b.nth
    GROUP BY b.symbol, b.session_date, b.nth
),
totals AS (
    SELECT r.*, u.day_high, u.day_open, list_sum(u.money) AS cum_tp_volume, list_sum(u.volumes) AS cum_volume,
           list_sum(u.money) / nullif(list_sum(u.volumes), 0) AS session_vwap,
           list_max(u.volumes[-{P.FROZEN.volume_peak_bars}:]) AS vol_peak_10
    FROM regular r JOIN up_to u
      ON u.symbol IS NOT DISTINCT FROM r.symbol AND u.session_date = r.session_date AND u.nth = r.nth
),
measured AS (
    SELECT *, close_price / nullif(session_vwap, 0) AS vwap_extension_ratio,
           (day_high - day_open) / nullif(day_open, 0) AS day_gain,
           volume / nullif(vol_peak_10, 0) AS volume_ratio, close_price / nullif(day_high, 0) AS proximity_to_high
    FROM totals
),
judged AS (
    SELECT *, [vwap_extension_ratio >= {P.FROZEN.vwap_extension_min}::DOUBLE, volume_ratio <= {P.FROZEN.volume_ratio_max}::DOUBLE,
               proximity_to_high >= {P.FROZEN.proximity_min}::DOUBLE] AS flags
    FROM measured
),
bars_exhaustion AS (
    SELECT *, flags[1] AS meets_vwap_extension, flags[2] AS meets_volume_exhaustion, flags[3] AS meets_proximity,
           CAST(len(list_filter(flags, lambda f: f)) AS INTEGER) AS criteria_met
    FROM judged
),
session_vwap AS (SELECT * FROM measured),
extension_ranks AS (
    SELECT b.bar_key, b.symbol, b.session_date, b.bar_ts_utc, b.vwap_extension_ratio,
           1 + count(*) FILTER (WHERE p.vwap_extension_ratio > b.vwap_extension_ratio
                                   OR (b.vwap_extension_ratio IS NULL AND p.vwap_extension_ratio IS NOT NULL)
                                   OR (p.vwap_extension_ratio IS NOT DISTINCT FROM b.vwap_extension_ratio AND p.nth < b.nth)) AS extension_rank
    FROM bars_exhaustion b JOIN bars_exhaustion p
      ON p.symbol IS NOT DISTINCT FROM b.symbol AND p.session_date = b.session_date
    GROUP BY ALL
),
session_features AS (
    SELECT symbol, session_date, max(nth) AS bar_count, sum(volume) AS session_volume,
           max(vwap_extension_ratio) AS max_vwap_extension_ratio, max(day_gain) AS max_day_gain,
           max(high_price) AS day_high, arg_min(open_price, nth) AS day_open,
           arg_min(bar_ts_et, nth) AS first_bar_ts_et, arg_max(bar_ts_et, nth) AS last_bar_ts_et,
           list(bar_ts_et ORDER BY vwap_extension_ratio DESC NULLS LAST, nth)[1] AS peak_extension_ts_et,
           max(criteria_met) AS max_criteria_met, count(*) FILTER (WHERE criteria_met >= {P.FROZEN.min_criteria}) AS bars_meeting_2of3
    FROM bars_exhaustion GROUP BY symbol, session_date
),
setup_outcomes AS (
    SELECT s.* EXCLUDE (open_price, high_price, low_price, close_price), r.trades, r.pnl, r.is_win, true AS is_candidate,
           EXISTS (SELECT 1 FROM stg_results t WHERE t.symbol = s.symbol AND t.setup_date = s.setup_date AND t.trades > 0) AS is_traded,
           EXISTS (SELECT 1 FROM stg_results t WHERE t.symbol = s.symbol AND t.setup_date = s.setup_date AND t.trades > 0 AND t.is_win) AS is_winner
    FROM stg_setups s LEFT JOIN stg_results r USING (symbol, setup_date)
),
passed AS (
    SELECT * FROM bars_exhaustion
    WHERE NOT (bar_time_et < '{P.tod(P.FROZEN.entry_start)}' OR bar_time_et > '{P.tod(P.FROZEN.entry_end)}')
      AND least(day_gain - {P.FROZEN.day_gain_min}::DOUBLE, close_price - session_vwap, criteria_met - {P.FROZEN.min_criteria}) >= 0
      AND day_gain IS NOT NULL AND session_vwap IS NOT NULL
),
ranked_signals AS (
    SELECT b.*, 1 + (SELECT count(*) FROM passed p
                     WHERE p.symbol IS NOT DISTINCT FROM b.symbol AND p.session_date = b.session_date
                       AND (p.vwap_extension_ratio > b.vwap_extension_ratio
                            OR (p.vwap_extension_ratio = b.vwap_extension_ratio AND p.nth < b.nth))) AS setup_rank
    FROM passed b
),
signal_candidates AS (SELECT *, setup_rank = 1 AS is_best_setup_of_day FROM ranked_signals),
setup_funnel AS (
    SELECT o.*, ['never_triggered', 'lost', 'won'][1 + o.is_traded::INT + o.is_winner::INT] AS funnel_stage,
           f.bar_count, f.session_volume, f.max_vwap_extension_ratio, f.max_day_gain, f.peak_extension_ts_et, f.bars_meeting_2of3,
           EXISTS (SELECT 1 FROM session_features x WHERE x.symbol = o.symbol AND x.session_date = o.setup_date) AS has_bar_data
    FROM setup_outcomes o LEFT JOIN session_features f ON f.symbol = o.symbol AND f.session_date = o.setup_date
),
universe AS (
    SELECT DISTINCT symbol FROM results WHERE symbol IS NOT NULL
)
"""

WITH = _ADAPTERS + "," + _AS_GIVEN + _STAGING + _MODELS
WITH_PLANTED = _ADAPTERS + "," + _PLANTED + _STAGING + _MODELS


def _proj(cols: list[str]) -> str:
    return ", ".join(f'round("{c}", 6) AS "{c}"' if c in DOUBLES else f'"{c}"' for c in cols)


def select(source: str, cols: list[str], where: str = "", chain: str = "") -> str:
    return f"{chain or WITH}SELECT {_proj(cols)} FROM {source}{(' WHERE ' + where) if where else ''}"


def over(inner: str, cols: list[str], chain: str = "") -> str:
    """Final rounding projection over an arbitrary inner SELECT (may use the CTEs)."""
    return f"{chain or WITH}SELECT {_proj(cols)} FROM ({inner}) q"


STG_BARS, STG_SETUPS, STG_RESULTS = schemas.STG_BARS_COLS, schemas.STG_SETUPS_COLS, schemas.STG_RESULTS_COLS
SESSION_VWAP, EXHAUSTION = schemas.SESSION_VWAP_COLS, schemas.EXHAUSTION_COLS
FEATURES, OUTCOMES = schemas.SESSION_FEATURES_COLS, schemas.SETUP_OUTCOMES_COLS
SIGNALS, FUNNEL = schemas.SIGNAL_CANDIDATES_COLS, schemas.SETUP_FUNNEL_COLS

_FUNNEL_COUNTS = """count(*) AS candidates,
       CAST(sum(CASE WHEN is_traded THEN 1 ELSE 0 END) AS BIGINT) AS traded,
       CAST(sum(CASE WHEN is_winner THEN 1 ELSE 0 END) AS BIGINT) AS won"""


def _pct(num: str, den: str) -> str:
    return f"100.0 * CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0.0)"


MALFORMED = """low_price > high_price
   OR high_price < greatest(open_price, close_price)
   OR low_price > least(open_price, close_price)
   OR volume < 0"""

# The 42 checks: (check_name, model, severity, violation-count SQL).
def _nn(model, col):
    return (f"not_null_{model}_{col}", model, "error",
            f"SELECT count(*) FROM {model} WHERE {col} IS NULL")


def _un(model, col):
    return (f"unique_{model}_{col}", model, "error",
            f"SELECT count(*) FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1)")


def _uc(model, cols):
    c = ", ".join(cols)
    return (f"unique_combination_{model}_{'__'.join(cols)}", model, "error",
            f"SELECT count(*) FROM (SELECT {c} FROM {model} GROUP BY {c} HAVING count(*) > 1)")


def _av(model, col, values):
    vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return (f"accepted_values_{model}_{col}", model, "error",
            f"SELECT count(DISTINCT {col}) FROM {model} WHERE {col} NOT IN ({vals})")


def _checks() -> list[tuple[str, str, str, str]]:
    phases = ("premarket", "regular", "postmarket")
    stages = ("won", "lost", "never_triggered")
    rel = ("relationships_stg_setups_symbol__stg_bars_symbol", "stg_setups", "warn",
           "SELECT count(*) FROM stg_setups s WHERE s.symbol IS NOT NULL AND NOT EXISTS "
           "(SELECT 1 FROM stg_bars b WHERE b.symbol = s.symbol)")
    return [
        _un("stg_bars", "bar_key"), _nn("stg_bars", "bar_key"), _nn("stg_bars", "symbol"),
        _nn("stg_bars", "bar_ts_utc"), _nn("stg_bars", "bar_ts_et"),
        _nn("stg_bars", "session_date"), _av("stg_bars", "session_phase", phases),
        _nn("stg_setups", "symbol"), rel, _nn("stg_setups", "setup_date"),
        _nn("stg_results", "symbol"), _nn("stg_results", "setup_date"),
        _un("session_vwap", "bar_key"), _nn("session_vwap", "bar_key"),
        _nn("session_vwap", "symbol"), _nn("session_vwap", "session_date"),
        _un("bars_exhaustion", "bar_key"), _nn("bars_exhaustion", "bar_key"),
        _av("bars_exhaustion", "criteria_met", (0, 1, 2, 3)),
        _uc("session_features", ("symbol", "session_date")),
        _nn("session_features", "symbol"), _nn("session_features", "session_date"),
        _uc("setup_outcomes", ("symbol", "setup_date")),
        _nn("setup_outcomes", "symbol"), _nn("setup_outcomes", "setup_date"),
        _nn("setup_outcomes", "is_traded"), _nn("setup_outcomes", "is_winner"),
        _un("signal_candidates", "bar_key"), _nn("signal_candidates", "bar_key"),
        _nn("signal_candidates", "symbol"), _nn("signal_candidates", "session_date"),
        _av("signal_candidates", "criteria_met", (2, 3)),
        _nn("signal_candidates", "is_best_setup_of_day"),
        _uc("setup_funnel", ("symbol", "setup_date")),
        _nn("setup_funnel", "symbol"), _nn("setup_funnel", "setup_date"),
        _nn("setup_funnel", "funnel_stage"), _av("setup_funnel", "funnel_stage", stages),
        _nn("setup_funnel", "is_candidate"), _nn("setup_funnel", "has_bar_data"),
        ("assert_no_malformed_bars", "stg_bars", "error",
         f"SELECT count(*) FROM stg_bars WHERE {MALFORMED}"),
        ("assert_signals_within_market_hours", "signal_candidates", "error",
         "SELECT count(*) FROM signal_candidates "
         "WHERE bar_time_et < '09:45:00.000000' OR bar_time_et > '14:00:00.000000'"),
    ]


def _dq_summary(chain: str = "") -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, '{m}' AS model, '{s}' AS severity, "
        f"CAST(({q}) AS BIGINT) AS violations"
        for n, m, s, q in _checks())
    inner = (f"SELECT *, CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' "
             f"THEN 'warn' ELSE 'fail' END AS status FROM ({rows})")
    return over(inner, ["check_name", "model", "severity", "violations", "status"], chain)


def _clock_changes() -> str:
    rows = " UNION ALL ".join(
        f"SELECT event_id, '{at}' AS change, TIMESTAMP '{at}' + to_seconds((epoch_us(ts) // 1000000) % 172800 - 86400) AS ts FROM events"
        for at in ("2024-03-10 07:00:00", "2024-11-03 06:00:00"))
    return f"""
        WITH shifted AS ({rows}),
        local AS (SELECT *, {_et('ts')} AS ts_et FROM shifted),
        minutes AS (SELECT *, 60 * hour(ts_et) + minute(ts_et) AS m FROM local)
        SELECT event_id, change, ts, ts_et, CAST(ts_et AS DATE) AS session_date, strftime(ts_et, '%H:%M:%S.%f') AS time_et,
               CASE WHEN m BETWEEN 570 AND 959 THEN 'regular' WHEN m BETWEEN 240 AND 569 THEN 'premarket' ELSE 'postmarket' END AS session_phase
        FROM minutes"""


def _rebuilt() -> str:
    per_day = """SELECT CAST("timestamp" AS DATE) AS utc_date, count(*) AS rows, sum(volume) AS volume, '{name}' AS target
                 FROM raw_bars WHERE {keep} GROUP BY 1"""
    odd = """day("timestamp") % 2 = 1"""
    outside = """CAST("timestamp" AS DATE) NOT BETWEEN DATE '2024-01-15' AND DATE '2024-01-17'"""
    return over(" UNION ALL ".join([per_day.format(name="rebuilt", keep=odd), per_day.format(name="range", keep=f"{odd} OR {outside}"),
                                    per_day.format(name="table", keep=f"{odd} OR {outside}")]),
                ["utc_date", "rows", "volume", "target"])


def _bar_grain() -> str:
    inner = """
    WITH b AS (
        SELECT symbol, "timestamp" AS ts, CAST("timestamp" AS DATE) AS utc_date
        FROM raw_bars WHERE symbol IS NOT NULL AND "timestamp" IS NOT NULL
    ),
    intra AS (
        SELECT symbol, date_diff('second', prev, ts) AS gap FROM (
            SELECT symbol, ts, lag(ts) OVER (PARTITION BY symbol, utc_date ORDER BY ts) AS prev
            FROM b) WHERE prev IS NOT NULL
    ),
    days AS (
        SELECT symbol, utc_date, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n
        FROM b GROUP BY symbol, utc_date
    ),
    inter AS (
        SELECT symbol, date_diff('second', prev_last, first_ts) AS gap FROM (
            SELECT symbol, first_ts,
                   lag(last_ts) OVER (PARTITION BY symbol ORDER BY utc_date) AS prev_last
            FROM days) WHERE prev_last IS NOT NULL
    ),
    counts AS (
        SELECT symbol, gap, count(*) AS c FROM (SELECT * FROM intra UNION ALL SELECT * FROM inter)
        GROUP BY symbol, gap
    ),
    modal AS (
        SELECT symbol, gap FROM (
            SELECT symbol, gap, row_number() OVER (PARTITION BY symbol ORDER BY c DESC, gap ASC) AS rn
            FROM counts) WHERE rn = 1
    ),
    nb AS (SELECT symbol, CAST(sum(n) AS BIGINT) AS bars FROM days GROUP BY symbol)
    SELECT nb.symbol, nb.bars, CAST(modal.gap AS BIGINT) AS modal_gap_seconds,
           coalesce(modal.gap >= 86400, false) AS is_daily_grain
    FROM nb LEFT JOIN modal ON nb.symbol = modal.symbol
    """
    return over(inner, ["symbol", "bars", "modal_gap_seconds", "is_daily_grain"])


ORACLE: dict[str, str] = {
    # models
    "stg_bars": select("stg_bars", STG_BARS),
    "stg_setups": select("stg_setups", STG_SETUPS),
    "stg_results": select("stg_results", STG_RESULTS),
    "session_vwap": select("session_vwap", SESSION_VWAP),
    "bars_exhaustion": select("bars_exhaustion", EXHAUSTION),
    "session_features": select("session_features", FEATURES),
    "setup_outcomes": select("setup_outcomes", OUTCOMES),
    "signal_candidates": select("signal_candidates", SIGNALS),
    "setup_funnel": select("setup_funnel", FUNNEL),
    # reports
    "kpi_summary": over(
        f"""SELECT candidates, traded, won, {_pct('won', 'traded')} AS win_rate_pct, net_pnl
            FROM (SELECT {_FUNNEL_COUNTS}, sum(pnl) AS net_pnl FROM setup_funnel)""",
        ["candidates", "traded", "won", "win_rate_pct", "net_pnl"]),
    "funnel_by_stage": over(
        "SELECT funnel_stage, count(*) AS setups FROM setup_funnel GROUP BY funnel_stage",
        ["funnel_stage", "setups"]),
    "win_rate_by_days_up": over(
        f"SELECT *, {_pct('won', 'traded')} AS win_rate_pct FROM "
        f"(SELECT days_up, {_FUNNEL_COUNTS} FROM setup_funnel GROUP BY days_up)",
        ["days_up", "candidates", "traded", "won", "win_rate_pct"]),
    "signals_over_time": over(
        "SELECT session_date, count(*) AS signals FROM signal_candidates GROUP BY session_date",
        ["session_date", "signals"]),
    "signal_setup_overlap": over(
        """SELECT *, 100.0 * in_both / nullif(CAST(backtest_total AS DOUBLE), 0.0) AS overlap_pct
           FROM (SELECT CAST(sum(CASE WHEN a IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS backtest_total,
                        CAST(sum(CASE WHEN b IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS signal_total,
                        CAST(sum(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS in_both,
                        CAST(sum(CASE WHEN a IS NOT NULL AND b IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS backtest_only,
                        CAST(sum(CASE WHEN a IS NULL AND b IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS signal_only
                 FROM (SELECT DISTINCT symbol, setup_date AS session_date, true AS a FROM stg_setups) x
                 FULL OUTER JOIN (SELECT DISTINCT symbol, session_date, true AS b FROM signal_candidates) y
                 USING (symbol, session_date))""",
        ["backtest_total", "signal_total", "in_both", "backtest_only", "signal_only", "overlap_pct"]),
    "executed_trade_funnel": over(
        f"""SELECT candidates, traded, won, candidates - traded AS never_triggered,
                   traded - won AS lost, {_pct('traded', 'candidates')} AS traded_pct,
                   {_pct('won', 'traded')} AS win_rate_pct
            FROM (SELECT {_FUNNEL_COUNTS} FROM setup_funnel)""",
        ["candidates", "traded", "won", "never_triggered", "lost", "traded_pct",
         "win_rate_pct"]),
    "best_signal_per_session": select("signal_candidates", SIGNALS, "is_best_setup_of_day"),
    # windows
    "running_vwap": over(
        """SELECT bar_key, symbol, session_date, bar_ts_utc, typical_price, volume,
                  cum_tp_volume, cum_volume, session_vwap FROM totals""",
        ["bar_key", "symbol", "session_date", "bar_ts_utc", "typical_price", "volume",
         "cum_tp_volume", "cum_volume", "session_vwap"]),
    "running_day_high": select("session_vwap", ["bar_key", "symbol", "session_date",
                                                "bar_ts_utc", "high_price", "day_high"]),
    "session_open": select("session_vwap", ["bar_key", "symbol", "session_date", "bar_ts_utc",
                                            "open_price", "day_open"]),
    "rolling10_volume_peak": select("bars_exhaustion", ["bar_key", "symbol", "session_date",
                                                        "bar_ts_utc", "volume", "vol_peak_10"]),
    "extension_rank": select("extension_ranks", ["bar_key", "symbol", "session_date", "bar_ts_utc",
                                           "vwap_extension_ratio", "extension_rank"]),
    # aggregates
    "session_argmax_extension": select("session_features", [
        "symbol", "session_date", "max_vwap_extension_ratio", "peak_extension_ts_et"]),
    "bars_meeting_2of3": select("session_features", [
        "symbol", "session_date", "bar_count", "max_criteria_met", "bars_meeting_2of3"]),
    "bars_symbol_counts": over(
        "SELECT count(*) AS rows, count(DISTINCT symbol) AS symbols FROM raw_bars",
        ["rows", "symbols"]),
    "single_day_volume": over(
        """SELECT sum(volume) AS total_volume,
                  sum(CASE WHEN CAST("timestamp" AS DATE) = DATE '2024-01-15' THEN volume END) AS day_volume,
                  count(CASE WHEN CAST("timestamp" AS DATE) = DATE '2024-01-15' THEN 1 END) AS day_rows,
                  DATE '2024-01-15' AS probe_day
           FROM raw_bars""",
        ["total_volume", "day_volume", "day_rows", "probe_day"]),
    # joins
    "setups_left_results": select("setup_outcomes", [
        "symbol", "setup_date", "trades", "pnl", "is_win", "is_traded", "is_winner"]),
    "funnel_left_features": select("setup_funnel", [
        "symbol", "setup_date", "funnel_stage", "bar_count", "session_volume",
        "bars_meeting_2of3", "has_bar_data"]),
    "universe_semi": over(
        'SELECT * FROM raw_bars WHERE symbol IN (SELECT symbol FROM universe)',
        ["timestamp", "open", "high", "low", "close", "volume", "vwap", "symbol"]),
    "missing_symbols_anti": over(
        "SELECT symbol FROM universe u WHERE NOT EXISTS "
        "(SELECT 1 FROM raw_bars b WHERE b.symbol = u.symbol)", ["symbol"]),
    # scalar
    "session_phase": select("stg_bars", ["bar_key", "bar_time_et", "session_phase"]),
    "et_parts": select("stg_bars", ["bar_key", "bar_ts_utc", "bar_ts_et", "session_date",
                                    "bar_time_et"]),
    "surrogate_key": select("stg_bars", ["symbol", "bar_ts_utc", "bar_key"]),
    "safe_ratios": select("bars_exhaustion", ["bar_key", "session_vwap", "vwap_extension_ratio",
                                              "day_gain", "volume_ratio", "proximity_to_high"]),
    # checks
    "source_profile": over(
        """SELECT CAST(count(*) AS BIGINT) AS rows,
                  CAST(sum(CASE WHEN coalesce(low > high OR high < greatest(open, close)
                       OR low > least(open, close) OR volume < 0, false) THEN 1 ELSE 0 END) AS BIGINT)
                       AS malformed_bars,
                  CAST(sum(("timestamp" IS NULL)::INT + (open IS NULL)::INT + (high IS NULL)::INT
                       + (low IS NULL)::INT + (close IS NULL)::INT + (volume IS NULL)::INT
                       + (vwap IS NULL)::INT + (symbol IS NULL)::INT) AS BIGINT) AS null_cells,
                  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT symbol, "timestamp" FROM raw_bars
                       WHERE symbol IS NOT NULL AND "timestamp" IS NOT NULL
                       GROUP BY symbol, "timestamp" HAVING count(*) > 1)) AS duplicate_keys
           FROM raw_bars""",
        ["rows", "malformed_bars", "null_cells", "duplicate_keys"]),
    "malformed_bars": select("stg_bars", ["bar_key", "symbol", "bar_ts_utc", "open_price",
                                          "high_price", "low_price", "close_price", "volume"],
                             MALFORMED),
    "signals_outside_hours": select(
        "signal_candidates",
        ["bar_key", "symbol", "session_date", "bar_ts_utc", "bar_ts_et", "bar_time_et"],
        "bar_time_et < '09:45:00.000000' OR bar_time_et > '14:00:00.000000'"),
    "signals_outside_planted": select(
        "bars_exhaustion",
        ["bar_key", "symbol", "session_date", "bar_ts_utc", "bar_ts_et", "bar_time_et"],
        "criteria_met >= 2 AND (bar_time_et < '09:45:00.000000' OR bar_time_et > '14:00:00.000000')"),
    "dq_summary": _dq_summary(),
    "bar_grain": _bar_grain(),
    # ingest
    "ingest_report": over(
        """SELECT count(*) AS symbols_total, count(n) AS symbols_resolved,
                  CAST(sum(CASE WHEN n IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS symbols_missing,
                  CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
                  CAST(coalesce(sum(n), 0) AS BIGINT) * 62 AS est_logical_bytes
           FROM universe u LEFT JOIN
                (SELECT symbol, count(*) AS n FROM raw_bars GROUP BY symbol) c USING (symbol)""",
        ["symbols_total", "symbols_resolved", "symbols_missing", "rows", "est_logical_bytes"]),
    "seed_csv_roundtrip": select("setup_outcomes", OUTCOMES),
    "partitioned_roundtrip": over(
        """SELECT CAST("timestamp" AS DATE) AS utc_date, count(*) AS rows,
                  count(DISTINCT symbol) AS symbols, sum(volume) AS volume
           FROM raw_bars WHERE symbol IN (SELECT symbol FROM universe)
           GROUP BY CAST("timestamp" AS DATE)""",
        ["utc_date", "rows", "symbols", "volume"]),
    "rebuild_roundtrip": _rebuilt(),
    "bucketed_sessions": select("setup_funnel", FUNNEL),
    "seed_reordered_csv": select("stg_results", STG_RESULTS),
    "seed_files_by_header": select("stg_results", STG_RESULTS),
    "failed_load_keeps_table": over(
        """SELECT CAST("timestamp" AS DATE) AS utc_date, count(*) AS rows,
                  count(DISTINCT symbol) AS symbols, sum(volume) AS volume
           FROM raw_bars GROUP BY CAST("timestamp" AS DATE)""",
        ["utc_date", "rows", "symbols", "volume"]),
    "first_file_per_symbol": over(
        """SELECT 'G' || CAST(user_id % 50 AS VARCHAR) AS symbol, count(DISTINCT date_trunc('minute', ts)) AS rows, sum(k) AS volume
           FROM ev WHERE user_id % 50 < 49 AND (user_id % 50 % 7 = 0 OR minute(ts) % 2 = 0) GROUP BY user_id % 50""",
        ["symbol", "rows", "volume"]),
    "sample_bars": over(
        """SELECT symbol, count(*) AS rows, sum(volume) AS volume FROM raw_bars
           WHERE symbol IN (SELECT 'U' || CAST(range AS VARCHAR) FROM range(1, 11)) GROUP BY symbol""",
        ["symbol", "rows", "volume"]),
    "universe_from_csv": select("universe", ["symbol"]),
    "sorted_universe": over("SELECT symbol FROM universe ORDER BY symbol", ["symbol"]),
    # planted faults and clock changes
    "dq_planted": _dq_summary(WITH_PLANTED),
    "missing_symbols_planted": over(
        "SELECT symbol FROM universe u WHERE NOT EXISTS "
        "(SELECT 1 FROM raw_bars b WHERE b.symbol = u.symbol)", ["symbol"], WITH_PLANTED),
    "malformed_bars_planted": select("stg_bars", ["bar_key", "symbol", "bar_ts_utc", "open_price",
                                                  "high_price", "low_price", "close_price", "volume"],
                                     MALFORMED, WITH_PLANTED),
    "et_parts_dst": _clock_changes(),
    "long_session_windows": """
WITH bars AS (
    SELECT event_id, 'L' || CAST(event_id % 7 % 3 AS VARCHAR) AS symbol, 10.0 + (event_id * 37 % 400) / 4.0 AS high_price,
           10.0 + (event_id * 37 % 400) / 4.0 - (event_id % 8) / 4.0 AS open_price,
           CASE WHEN event_id % 53 <> 0 THEN CAST(event_id * 7 % 977 AS DOUBLE) END AS volume
    FROM events
)
SELECT event_id, symbol, sum(high_price * volume) OVER so_far AS cum_tp_volume, sum(volume) OVER so_far AS cum_volume,
       max(high_price) OVER so_far AS day_high, first_value(open_price) OVER so_far AS day_open,
       max(volume) OVER (PARTITION BY symbol ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS vol_peak_10
FROM bars WINDOW so_far AS (PARTITION BY symbol ORDER BY event_id)
""",
}
