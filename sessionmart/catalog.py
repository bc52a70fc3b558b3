"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the provided test tables through ``sources.testdata`` and
runs over them whole. Doubles are rounded to 6 places at the output only
(thresholds compare unrounded values), so results compare exactly with an
independent engine whose floating-point sums may differ in the last bits.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sessionmart.config import scratch_path
from sessionmart.functions import round_scaled, time_of_day, to_et
from sessionmart.functions import session_phase as phase_of
from sessionmart.operators import windows as Wn
from sessionmart.operators.long_sessions import LongSessions
from sessionmart.plans import intermediate, marts, pipeline, quality_suite, reports, staging
from sessionmart.sources import ingest, readers, sinks, testdata

ROUND_DIGITS = 6
# UTC day of the single-day scan probe (inside the test tables' date range).
PROBE_DAY = dt.date(2024, 1, 15)

Query = Callable[[SparkSession, str], DataFrame]


def round_doubles(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    return df.select(*[
        round_scaled(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def models(spark: SparkSession, sf_dir: str) -> pipeline.Models:
    return pipeline.build_models(*testdata.load_inputs(spark, sf_dir))


def _model(name: str) -> Query:
    def q(spark, d):
        return models(spark, d)[name]
    q.__name__ = name
    return q


def _on(name: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    def q(spark, d):
        return fn(models(spark, d)[name])
    return q


def signal_setup_overlap(spark, d):
    m = models(spark, d)
    return reports.signal_setup_overlap(m["signal_candidates"], m["stg_setups"])


# ---- window operators, exposed one by one ---------------------------------------

def running_vwap(spark, d):
    return intermediate.with_session_totals(models(spark, d)["stg_bars"]).select(
        "bar_key", "symbol", "session_date", "bar_ts_utc", "typical_price",
        "volume", "cum_tp_volume", "cum_volume", "session_vwap")


def running_day_high(spark, d):
    return models(spark, d)["session_vwap"].select(
        "bar_key", "symbol", "session_date", "bar_ts_utc", "high_price", "day_high")


def session_open(spark, d):
    return models(spark, d)["session_vwap"].select(
        "bar_key", "symbol", "session_date", "bar_ts_utc", "open_price", "day_open")


def rolling10_volume_peak(spark, d):
    return models(spark, d)["bars_exhaustion"].select(
        "bar_key", "symbol", "session_date", "bar_ts_utc", "volume", "vol_peak_10")


def extension_rank(spark, d):
    exh = models(spark, d)["bars_exhaustion"]
    return exh.select("bar_key", "symbol", "session_date", "bar_ts_utc", "vwap_extension_ratio",
                      Wn.rank_desc_then_time("vwap_extension_ratio").cast("bigint")
                      .alias("extension_rank"))


def long_session_windows(spark, d):
    """Running and rolling figures of planted long sessions, worked on in chunks of about 500 bars."""
    bars = testdata.long_session_bars(testdata.events(spark, d))
    long = LongSessions.find(bars, 500)
    out = long.running(bars, {"cum_tp_volume": ("sum", F.col("high_price") * F.col("volume")), "cum_volume": ("sum", "volume"),
                              "day_high": ("max", "high_price"), "day_open": ("first", "open_price")})
    return (long.trailing_max(out, "vol_peak_10", "volume", 10)
            .select("event_id", "symbol", "cum_tp_volume", "cum_volume", "day_high", "day_open", "vol_peak_10"))


# ---- aggregates -------------------------------------------------------------------

def session_argmax_extension(spark, d):
    return models(spark, d)["session_features"].select(
        "symbol", "session_date", "max_vwap_extension_ratio", "peak_extension_ts_et")


def bars_meeting_2of3(spark, d):
    return models(spark, d)["session_features"].select(
        "symbol", "session_date", "bar_count", "max_criteria_met", "bars_meeting_2of3")


def bars_symbol_counts(spark, d):
    bars, _, _ = testdata.load_inputs(spark, d)
    return bars.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_distinct("symbol").alias("symbols"))


def single_day_volume(spark, d):
    """Whole-table and one-UTC-day SUM(volume) over the raw bars loaded by UTC day.

    The one day is a partition filter: its read touches that day's files only.
    """
    bars, _, _ = testdata.load_inputs(spark, d)
    path = scratch_path(spark, "raw_bars")
    ingest.load_raw(bars, path)
    loaded = sinks.read_table(spark, path)
    whole = loaded.agg(F.sum("volume").alias("total_volume"))
    one = (loaded.where(F.col("utc_date") == F.lit(PROBE_DAY))
           .agg(F.sum("volume").alias("day_volume"), F.count(F.lit(1)).alias("day_rows")))
    both = whole.unionByName(one, allowMissingColumns=True)  # two rows
    return both.agg(F.max("total_volume").alias("total_volume"), F.max("day_volume").alias("day_volume"),
                    F.max("day_rows").alias("day_rows"), F.lit(PROBE_DAY).alias("probe_day"))


# ---- joins ------------------------------------------------------------------------

def setups_left_results(spark, d):
    return models(spark, d)["setup_outcomes"].select(
        "symbol", "setup_date", "trades", "pnl", "is_win", "is_traded", "is_winner")


def funnel_left_features(spark, d):
    return models(spark, d)["setup_funnel"].select(
        "symbol", "setup_date", "funnel_stage", "bar_count", "session_volume",
        "bars_meeting_2of3", "has_bar_data")


def _universe(spark, d):
    bars, _, results = testdata.load_inputs(spark, d)
    return bars, ingest.universe(results)


def universe_semi(spark, d):
    bars, u = _universe(spark, d)
    return ingest.restrict_to_universe(bars, u)


def missing_symbols_anti(spark, d):
    """Universe (result symbols) without a single bar."""
    bars, u = _universe(spark, d)
    return ingest.missing_symbols(u, bars)


# ---- scalar functions -------------------------------------------------------------

def et_parts_dst(spark, d):
    """New York time parts of events shifted over both clock changes of 2024."""
    return testdata.clock_change_times(testdata.events(spark, d)).select(
        "event_id", "change", "ts", to_et("ts").alias("ts_et"),
        F.to_date(to_et("ts")).alias("session_date"), time_of_day(to_et("ts")).alias("time_et"),
        phase_of(time_of_day(to_et("ts"))).alias("session_phase"))


def session_phase(spark, d):
    return models(spark, d)["stg_bars"].select("bar_key", "bar_time_et", "session_phase")


def et_parts(spark, d):
    return models(spark, d)["stg_bars"].select(
        "bar_key", "bar_ts_utc", "bar_ts_et", "session_date", "bar_time_et")


def surrogate_key(spark, d):
    return models(spark, d)["stg_bars"].select("symbol", "bar_ts_utc", "bar_key")


def safe_ratios(spark, d):
    return models(spark, d)["bars_exhaustion"].select(
        "bar_key", "session_vwap", "vwap_extension_ratio", "day_gain", "volume_ratio",
        "proximity_to_high")


# ---- checks -----------------------------------------------------------------------

def source_profile(spark, d):
    bars, _, _ = testdata.load_inputs(spark, d)
    return quality_suite.source_profile(bars)


def malformed_bars(spark, d):
    stg = models(spark, d)["stg_bars"]
    return stg.where(quality_suite.malformed_predicate(stg)).select(*quality_suite.MALFORMED_REPORT)


def signals_outside_hours(spark, d):
    sig = models(spark, d)["signal_candidates"]
    return (sig.where(quality_suite.outside_hours_predicate()(sig))
            .select(*quality_suite.OUTSIDE_HOURS_REPORT))


def signals_outside_planted(spark, d):
    """Signals formed without the entry gate: those that break the market-hours rule."""
    exh = models(spark, d)["bars_exhaustion"]
    sig = exh.where(F.col("criteria_met") >= 2)
    return (sig.where(quality_suite.outside_hours_predicate()(sig))
            .select(*quality_suite.OUTSIDE_HOURS_REPORT))


def dq_summary(spark, d):
    """All 42 checks; the window table and the features are written once and read by the rest."""
    return quality_suite.run_suite(pipeline.materialize(models(spark, d), scratch_path(spark, "checks")))


def dq_planted(spark, d):
    """All 42 checks over bars, setups and results with planted faults (``testdata.planted_inputs``)."""
    built = pipeline.build_models(*testdata.planted_inputs(spark, d))
    return quality_suite.run_suite(pipeline.materialize(built, scratch_path(spark, "planted")))


def missing_symbols_planted(spark, d):
    """Universe symbols without a bar, after the bars of some symbols were dropped."""
    bars, _, results = testdata.planted_inputs(spark, d)
    return ingest.missing_symbols(ingest.universe(results), bars).where(F.col("symbol").isNotNull())


def malformed_bars_planted(spark, d):
    """Staged bars that are physically impossible, over the planted bars."""
    stg = pipeline.build_models(*testdata.planted_inputs(spark, d))["stg_bars"]
    return stg.where(quality_suite.malformed_predicate(stg)).select(*quality_suite.MALFORMED_REPORT)


def bar_grain(spark, d):
    bars, _, _ = testdata.load_inputs(spark, d)
    return ingest.bar_grain(bars)


# ---- ingest -----------------------------------------------------------------------

def ingest_report(spark, d):
    bars, u = _universe(spark, d)
    return ingest.ingest_report(u, ingest.restrict_to_universe(bars, u))


def partitioned_roundtrip(spark, d):
    """Universe bars loaded partitioned by UTC day (clustered by symbol) into the
    shared folder, count-verified, read back; per-day rows, symbols and volume."""
    bars, u = _universe(spark, d)
    path = scratch_path(spark, "raw_bars")
    ingest.load_raw(ingest.restrict_to_universe(bars, u), path)
    back = readers.read_bars(spark, path).withColumn("utc_date", F.to_date("timestamp"))
    return back.groupBy("utc_date").agg(F.count(F.lit(1)).alias("rows"),
                                        F.count_distinct("symbol").alias("symbols"),
                                        F.sum("volume").alias("volume"))


def seed_csv_roundtrip(spark, d):
    """Setup and result seeds written as header CSV to the shared folder, read
    back with their declared types (FAILFAST), staged and joined to outcomes."""
    _, setups, results = testdata.load_inputs(spark, d)
    s_path, r_path = scratch_path(spark, "setups_csv"), scratch_path(spark, "results_csv")
    setups.write.option("header", True).csv(s_path)
    results.write.option("header", True).csv(r_path)
    m = pipeline.build_models(testdata.bars_from_events(testdata.events(spark, d)),
                              readers.read_setups(spark, s_path),
                              readers.read_results(spark, r_path))
    return m["setup_outcomes"]


def failed_load_keeps_table(spark, d):
    """Rows per day of a loaded table after a second load of fewer bars, refused by the count guard."""
    bars, _, _ = testdata.load_inputs(spark, d)
    path = scratch_path(spark, "guarded")
    rows, _ = ingest.load_raw(bars, path)
    try:
        ingest.load_raw(bars.where(F.dayofmonth("timestamp") % 2 == 1), path, expected_rows=rows)
    except ingest.IngestError:
        pass
    back = readers.read_bars(spark, path).withColumn("utc_date", F.to_date("timestamp"))
    return back.groupBy("utc_date").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol").alias("symbols"),
                                        F.sum("volume").alias("volume"))


def first_file_per_symbol(spark, d):
    """Bars of a cache with one or two files a symbol (here 50 groups of users), the first file of each only."""
    cache = scratch_path(spark, "bar_cache")
    bars = testdata.grouped_bars(testdata.events(spark, d))
    for mark, part in (("a", bars.where("even and g % 7 <> 0")), ("b", bars)):
        (part.withColumn("file", F.concat("symbol", F.lit(f"_1min_{mark}.parquet"))).drop("even", "g")
         .repartition("file").write.mode("append").partitionBy("file").parquet(cache))
    u = spark.range(49).select(F.concat(F.lit("G"), F.col("id")).alias("symbol"))  # all groups but one
    return (ingest.read_first_files(spark, cache, u).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume")))


def seed_files_by_header(spark, d):
    """Result seeds in several files of one folder whose headers differ in order, staged."""
    _, _, results = testdata.load_inputs(spark, d)
    path, odd = scratch_path(spark, "seed_folder"), F.dayofmonth("date") % 2 == 1
    results.where(odd).write.option("header", True).csv(path)
    (results.where(~odd).select(F.lit("x").alias("note"), *reversed(results.columns))
     .write.mode("append").option("header", True).csv(path))
    return staging.stg_results(readers.read_results(spark, path))


def sample_bars(spark, d):
    """Bars of a frozen list of ten symbols, per symbol."""
    bars, _, _ = testdata.load_inputs(spark, d)
    sample = ingest.sample_universe(spark, [f"U{k}" for k in range(1, 11)])
    return ingest.restrict_to_universe(bars, sample).groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume"))


def bucketed_sessions(spark, d):
    """Session features and the funnel from bars and outcomes written in buckets of their sessions: no further Exchange."""
    m = models(spark, d)
    names = {}
    for name, keys, order in (("session_vwap", ("symbol", "session_date"), ("symbol", "session_date", "bar_ts_utc")),
                              ("setup_outcomes", ("symbol", "setup_date"), ("symbol", "setup_date"))):
        path = scratch_path(spark, name)
        names[name] = f"default.{os.path.basename(path).replace('-', '_')}"
        sinks.write_bucketed(m[name], names[name], keys, order, 8, path)
    out = scratch_path(spark, "bucketed_funnel")
    bucketed_funnel(spark, names["session_vwap"], names["setup_outcomes"]).write.parquet(out)
    for table in names.values():  # external tables: their files stay, the names go
        spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(out)


def bucketed_funnel(spark, vwap_table: str, outcomes_table: str) -> DataFrame:
    """The funnel over two bucketed tables."""
    features = intermediate.session_features(intermediate.bars_exhaustion(spark.table(vwap_table)))
    return marts.setup_funnel(spark.table(outcomes_table), features)


def rebuild_roundtrip(spark, d):
    """A table written with all days and rebuilt with fewer holds the fewer; a rebuilt range leaves the other days.

    Rows per day and table: ``rebuilt`` (odd days of the month only), ``range`` (all days, of which
    the probe day and the two after it were rebuilt with the odd days only) and ``table`` (the same in a catalog table).
    """
    bars, _, _ = testdata.load_inputs(spark, d)
    dated = bars.withColumn("utc_date", F.to_date("timestamp"))
    odd = dated.where(F.dayofmonth("utc_date") % 2 == 1)
    out = None
    for name in ("rebuilt", "range", "table"):
        path = scratch_path(spark, name)
        sinks.write_partitioned(dated, path, "utc_date", ("symbol", "timestamp"))
        if name == "rebuilt":
            sinks.write_partitioned(odd, path, "utc_date", ("symbol", "timestamp"))
        else:
            target = path
            if name == "table":
                target = f"default.{os.path.basename(path).replace('-', '_')}"
                spark.sql(f"CREATE TABLE {target} USING parquet LOCATION '{path}'")
            sinks.rebuild_partitions(odd, target, PROBE_DAY, PROBE_DAY + dt.timedelta(days=2), "utc_date", ("symbol", "timestamp"))
        rows = (sinks.read_table(spark, path if name == "rebuilt" else target).groupBy("utc_date")
                .agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume")).withColumn("target", F.lit(name)))
        if name == "table":  # an external table: its files stay, the name goes
            rows.write.parquet(f"{path}_days")
            rows = spark.read.parquet(f"{path}_days")
            spark.sql(f"DROP TABLE {target}")
        out = rows if out is None else out.unionByName(rows)
    return out


def seed_reordered_csv(spark, d):
    """Result seeds written with their columns reversed and one more column, read by header name and staged."""
    _, _, results = testdata.load_inputs(spark, d)
    path = scratch_path(spark, "reordered_csv")
    (results.select(*reversed(results.columns), F.lit("x").alias("note"))
     .write.option("header", True).csv(path))
    return staging.stg_results(readers.read_results(spark, path))


def universe_from_csv(spark, d):
    """The universe of a CSV that has a ``symbol`` column among others."""
    _, _, results = testdata.load_inputs(spark, d)
    path = scratch_path(spark, "universe_csv")
    results.select("pnl", "symbol", "date").write.option("header", True).csv(path)
    return ingest.universe_from_csv(spark, path)


def sorted_universe(spark, d):
    """The universe in order."""
    _, _, results = testdata.load_inputs(spark, d)
    return ingest.sorted_universe(results)


REGISTRY: dict[str, Query] = {
    # models
    "stg_bars": _model("stg_bars"),
    "stg_setups": _model("stg_setups"),
    "stg_results": _model("stg_results"),
    "session_vwap": _model("session_vwap"),
    "bars_exhaustion": _model("bars_exhaustion"),
    "session_features": _model("session_features"),
    "setup_outcomes": _model("setup_outcomes"),
    "signal_candidates": _model("signal_candidates"),
    "setup_funnel": _model("setup_funnel"),
    # reports
    "kpi_summary": _on("setup_funnel", reports.kpi_summary),
    "funnel_by_stage": _on("setup_funnel", reports.funnel_by_stage),
    "win_rate_by_days_up": _on("setup_funnel", reports.win_rate_by_days_up),
    "signals_over_time": _on("signal_candidates", reports.signals_over_time),
    "signal_setup_overlap": signal_setup_overlap,
    "executed_trade_funnel": _on("setup_funnel", reports.executed_trade_funnel),
    "best_signal_per_session": _on("signal_candidates", reports.best_signal_per_session),
    # windows
    "running_vwap": running_vwap,
    "running_day_high": running_day_high,
    "session_open": session_open,
    "rolling10_volume_peak": rolling10_volume_peak,
    "extension_rank": extension_rank,
    "long_session_windows": long_session_windows,
    # aggregates
    "session_argmax_extension": session_argmax_extension,
    "bars_meeting_2of3": bars_meeting_2of3,
    "bars_symbol_counts": bars_symbol_counts,
    "single_day_volume": single_day_volume,
    # joins
    "setups_left_results": setups_left_results,
    "funnel_left_features": funnel_left_features,
    "universe_semi": universe_semi,
    "missing_symbols_anti": missing_symbols_anti,
    # scalar
    "session_phase": session_phase,
    "et_parts": et_parts,
    "surrogate_key": surrogate_key,
    "safe_ratios": safe_ratios,
    # checks
    "source_profile": source_profile,
    "malformed_bars": malformed_bars,
    "signals_outside_hours": signals_outside_hours,
    "signals_outside_planted": signals_outside_planted,
    "dq_summary": dq_summary,
    "bar_grain": bar_grain,
    # ingest
    "ingest_report": ingest_report,
    "partitioned_roundtrip": partitioned_roundtrip,
    "seed_csv_roundtrip": seed_csv_roundtrip,
    "rebuild_roundtrip": rebuild_roundtrip,
    "bucketed_sessions": bucketed_sessions,
    "failed_load_keeps_table": failed_load_keeps_table,
    "first_file_per_symbol": first_file_per_symbol,
    "seed_files_by_header": seed_files_by_header,
    "sample_bars": sample_bars,
    "seed_reordered_csv": seed_reordered_csv,
    "universe_from_csv": universe_from_csv,
    "sorted_universe": sorted_universe,
    # planted faults and clock changes
    "dq_planted": dq_planted,
    "missing_symbols_planted": missing_symbols_planted,
    "malformed_bars_planted": malformed_bars_planted,
    "et_parts_dst": et_parts_dst,
}


def queries() -> dict[str, Query]:
    def wrap(fn: Query) -> Query:
        def q(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        return q
    return {k: wrap(v) for k, v in REGISTRY.items()}
