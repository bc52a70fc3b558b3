"""Adapters from the shared synthetic tables to the pipeline's three inputs.

This is the only module that knows the layout of the provided test tables. The
``events`` table (event_id, ts, user_id, event_type, value, props) is turned
into the raw inputs the pipeline expects:

* bars      one bar per (user, UTC minute): symbol ``'U' || user_id``, bar open
            time = minute start, open/close = first/last value by (ts, event_id),
            high/low = max/min value, volume = sum of ``props.k``, per-bar vwap =
            sum(value*k) / sum(k).
* setups    one row per (user, ET date) with a ``signup``/``view`` event.
* results   one row per (user, ET date) with a ``purchase``/``error`` event;
            trades = purchases, pnl = purchases - errors (rounded to 6 places),
            win/loss 0/1.

All three are plain aggregations with map-side partial aggregation; a hot user
only widens its own (user, minute) or (user, day) groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from sessionmart.functions import round_scaled, safe_div, to_et

SETUP_EVENTS = ("signup", "view")
RESULT_EVENTS = ("purchase", "error")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _with_k(ev: DataFrame) -> DataFrame:
    return ev.select("event_id", "ts", "user_id", "event_type", "value",
                     F.get_json_object("props", "$.k").cast("double").alias("k"))


def _ohlc():
    order = F.struct("ts", "event_id")
    return [
        F.min_by("value", order).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", order).alias("close"),
    ]


def _symbol(user_id: str = "user_id"):
    return F.concat(F.lit("U"), F.col(user_id).cast("string"))


def bars_from_events(ev: DataFrame) -> DataFrame:
    """Raw bar relation (schema of ``schemas.BARS_NTZ``)."""
    minute = F.date_trunc("minute", F.col("ts")).cast(TimestampNTZType())
    agg = (_with_k(ev)
           .groupBy(F.col("user_id"), minute.alias("timestamp"))
           .agg(*_ohlc(),
                F.sum("k").alias("volume"),
                safe_div(F.sum(F.col("value") * F.col("k")), F.sum("k")).alias("vwap")))
    return agg.select("timestamp", "open", "high", "low", "close", "volume", "vwap",
                      _symbol().alias("symbol"))


def _daily(ev: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    et_date = F.to_date(to_et(F.col("ts")))
    return (_with_k(ev).where(F.col("event_type").isin(*kinds))
            .withColumn("et_date", et_date))


def setups_from_events(ev: DataFrame) -> DataFrame:
    """Setup seed relation (schema of ``schemas.SETUPS``)."""
    agg = (_daily(ev, SETUP_EVENTS)
           .groupBy("user_id", "et_date")
           .agg(*_ohlc(),
                F.sum("k").cast("bigint").alias("volume"),
                F.count(F.lit(1)).cast("int").alias("days_up")))
    return agg.select(
        _symbol().alias("symbol"), F.col("et_date").alias("date"),
        "open", "high", "low", "close", "volume",
        (F.lit(100.0) * (safe_div(F.col("high"), F.col("low")) - F.lit(1.0))).alias("gain_percent"),
        "days_up",
        (safe_div(F.col("close"), F.col("open")) - F.lit(1.0)).alias("prior_gain"))


def results_from_events(ev: DataFrame) -> DataFrame:
    """Backtest-result seed relation (schema of ``schemas.RESULTS``)."""
    is_buy = F.col("event_type") == F.lit("purchase")
    agg = (_daily(ev, RESULT_EVENTS)
           .groupBy("user_id", "et_date")
           .agg(F.max("value").alias("hi"), F.min("value").alias("lo"),
                F.count(F.lit(1)).cast("int").alias("days_up"),
                F.sum("k").cast("bigint").alias("volume"),
                F.sum(F.when(is_buy, F.lit(1)).otherwise(F.lit(0))).cast("int").alias("trades"),
                round_scaled(F.sum(F.when(is_buy, F.col("value")).otherwise(-F.col("value"))), 6)
                .alias("pnl")))
    traded = F.col("trades") > F.lit(0)
    return agg.select(
        _symbol().alias("symbol"), F.col("et_date").alias("date"),
        (F.lit(100.0) * (safe_div(F.col("hi"), F.col("lo")) - F.lit(1.0))).alias("gain_pct"),
        "days_up", "volume", "trades", "pnl",
        F.when(traded & (F.col("pnl") > F.lit(0)), F.lit(1)).otherwise(F.lit(0)).alias("win"),
        F.when(traded & (F.col("pnl") <= F.lit(0)), F.lit(1)).otherwise(F.lit(0)).alias("loss"))


def load_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bars, setups, results) derived from one scan definition of ``events``."""
    ev = events(spark, sf_dir)
    return bars_from_events(ev), setups_from_events(ev), results_from_events(ev)


def planted_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three inputs with faults planted by fixed rules on symbol and time.

    Bars: high and low swapped where the minute is divisible by 7 and they differ; every bar of a minute
    divisible by 11 twice; no symbol where the minute is 13; no bar of symbols ending in 5.
    Setups: every one of a day divisible by 5 twice; no symbol on day 13. Results: no date on day 13.
    """
    bars, setups, results = load_inputs(spark, sf_dir)
    minute = F.minute("timestamp")
    swap = (minute % 7 == 0) & (F.col("high") > F.col("low"))
    bars = bars.where(~F.col("symbol").endswith("5")).select(
        "timestamp", "open", F.when(swap, F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(swap, F.col("high")).otherwise(F.col("low")).alias("low"), "close", "volume", "vwap",
        F.when(minute != 13, F.col("symbol")).alias("symbol"))
    bars = bars.unionByName(bars.where(minute % 11 == 0))
    day = F.dayofmonth("date")
    setups = setups.unionByName(setups.where(day % 5 == 0)).withColumn("symbol", F.when(day != 13, F.col("symbol")))
    results = results.withColumn("date", F.when(day != 13, F.col("date")))
    return bars, setups, results


def grouped_bars(ev: DataFrame) -> DataFrame:
    """Bars whose symbol is one of 50 groups of users, with the group's number and whether the minute is even."""
    g = F.col("user_id") % 50
    minute = F.date_trunc("minute", F.col("ts")).cast(TimestampNTZType())
    agg = (_with_k(ev).groupBy(g.alias("g"), minute.alias("timestamp"))
           .agg(*_ohlc(), F.sum("k").alias("volume"), safe_div(F.sum(F.col("value") * F.col("k")), F.sum("k")).alias("vwap")))
    return agg.select("timestamp", "open", "high", "low", "close", "volume", "vwap", F.concat(F.lit("G"), F.col("g").cast("string")).alias("symbol"),
                      "g", (F.minute("timestamp") % 2 == 0).alias("even"))


def long_session_bars(ev: DataFrame) -> DataFrame:
    """Every event as a bar of one of three sessions, a millisecond apart by its id.

    Prices are quarters and volumes whole numbers, so sums are the same in any order. A volume is
    missing where the id is divisible by 53.
    """
    i = F.col("event_id")
    start = F.lit("2024-03-05 14:30:00").cast(TimestampNTZType())
    high = F.lit(10.0) + (i * 37 % 400) / F.lit(4.0)
    return ev.select(
        "event_id", F.concat(F.lit("L"), (i % 7 % 3).cast("string")).alias("symbol"), F.lit("2024-03-05").cast("date").alias("session_date"),
        F.timestamp_add("MICROSECOND", (i * 1000).cast("bigint"), start).alias("bar_ts_utc"),
        high.alias("high_price"), (high - (i % 8) / F.lit(4.0)).alias("open_price"),
        F.when(i % 53 != 0, (i * 7 % 977).cast("double")).alias("volume"))


CLOCK_CHANGES = ("2024-03-10 07:00:00", "2024-11-03 06:00:00")


def clock_change_times(ev: DataFrame) -> DataFrame:
    """Each event's time laid around both 2024 clock changes of New York (UTC instants): event_id, change, ts.

    The event's seconds modulo two days, from one day before the change on.
    """
    offset = F.pmod(F.unix_timestamp(F.col("ts").cast("timestamp")), F.lit(2 * 86400)) - F.lit(86400)
    out = None
    for at in CLOCK_CHANGES:
        base = F.lit(at).cast(TimestampNTZType())
        rows = ev.select("event_id", F.lit(at).alias("change"), F.timestamp_add("SECOND", offset.cast("int"), base).alias("ts"))
        out = rows if out is None else out.unionByName(rows)
    return out
