"""Models on hand fixtures (values worked out by hand) and structural invariants."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, bars_df
from sessionmart import schemas
from sessionmart.plans import intermediate, marts, pipeline, staging
from sessionmart.sources import testdata

D = dt.date(2024, 1, 16)


def et(h, m):
    return dt.datetime(2024, 1, 16, h, m)


def u(h, m):  # ET (EST, UTC-5) -> UTC
    return dt.datetime(2024, 1, 16, h + 5, m)


# One symbol, one session, no 09:30 bar (late anchor), a zero-volume first bar.
SESSION = [
    (u(9, 20), 9, 9, 9, 9, 999, "X"),      # premarket: not part of the session
    (u(9, 33), 10, 12, 9, 12, 0, "X"),
    (u(9, 50), 12, 15, 12, 15, 100, "X"),
    (u(11, 0), 15, 21, 15, 21, 50, "X"),
    (u(12, 0), 21, 21, 20, 20, 70, "X"),
    (u(14, 1), 20, 22, 20, 22, 60, "X"),
]


@pytest.fixture()
def exh(spark):
    raw = bars_df(spark, SESSION)
    return intermediate.bars_exhaustion(intermediate.session_vwap(staging.stg_bars(raw)))


def test_session_vwap_fixture(exh):
    rows = {r["bar_ts_et"]: r for r in exh.collect()}
    assert sorted(rows) == [et(9, 33), et(9, 50), et(11, 0), et(12, 0), et(14, 1)]
    r = rows[et(9, 33)]
    assert r["typical_price"] == 11 and r["session_vwap"] is None
    assert r["day_high"] == 12 and r["day_open"] == 10 and r["day_gain"] == pytest.approx(0.2)
    assert r["vol_peak_10"] == 0 and r["volume_ratio"] is None
    assert r["vwap_extension_ratio"] is None and r["proximity_to_high"] == 1.0
    assert r["meets_vwap_extension"] is None and r["criteria_met"] == 1
    r = rows[et(9, 50)]
    assert r["session_vwap"] == pytest.approx(14.0)
    assert r["vwap_extension_ratio"] == pytest.approx(15 / 14)
    assert r["volume_ratio"] == 1.0 and r["criteria_met"] == 1
    r = rows[et(11, 0)]
    assert r["session_vwap"] == pytest.approx(2350 / 150)
    assert r["day_gain"] == pytest.approx(1.1) and r["volume_ratio"] == 0.5
    assert r["criteria_met"] == 3
    r = rows[et(12, 0)]
    assert r["session_vwap"] == pytest.approx((2350 + 70 * 61 / 3) / 220)
    assert r["volume_ratio"] == pytest.approx(0.7) and r["meets_volume_exhaustion"] is True
    assert r["proximity_to_high"] == pytest.approx(20 / 21) and r["criteria_met"] == 3
    r = rows[et(14, 1)]
    assert r["session_vwap"] == pytest.approx((2350 + 70 * 61 / 3 + 60 * 64 / 3) / 280)
    assert r["day_high"] == 22 and r["criteria_met"] == 3


def test_signal_candidates_fixture(exh):
    sig = marts.signal_candidates(exh).orderBy("bar_ts_utc").collect()
    assert [r["bar_ts_et"] for r in sig] == [et(11, 0), et(12, 0)]   # 14:01 outside the gate
    assert [r["is_best_setup_of_day"] for r in sig] == [True, False]
    assert [r["setup_rank"] for r in sig] == [1, 2]
    assert dict(marts.signal_candidates(exh).dtypes)["setup_rank"] == "bigint"
    assert marts.signal_candidates(exh).columns == schemas.SIGNAL_CANDIDATES_COLS


def test_session_features_fixture(exh):
    (r,) = intermediate.session_features(exh).collect()
    assert (r["symbol"], r["session_date"]) == ("X", D)
    assert r["bar_count"] == 5 and r["session_volume"] == 280
    assert r["peak_extension_ts_et"] == et(11, 0)
    assert r["bars_meeting_2of3"] == 3 and r["max_criteria_met"] == 3
    assert r["first_bar_ts_et"] == et(9, 33) and r["last_bar_ts_et"] == et(14, 1)
    assert r["day_open"] == 10 and r["day_high"] == 22


def test_rolling_ten_bars(spark):
    vols = [100] + list(range(1, 12))
    raw = bars_df(spark, [(u(10, i), 1, 1, 1, 1, v, "R") for i, v in enumerate(vols)])
    exh = intermediate.bars_exhaustion(intermediate.session_vwap(staging.stg_bars(raw)))
    peaks = [r["vol_peak_10"] for r in exh.orderBy("bar_ts_utc").collect()]
    assert peaks[9] == 100 and peaks[10] == 10 and peaks[11] == 11


def test_rolling_window_restarts_each_session(spark):
    day2 = dt.datetime(2024, 1, 17, 15, 0)
    raw = bars_df(spark, [(u(10, 0), 1, 1, 1, 1, 500, "R"), (day2, 1, 1, 1, 1, 5, "R")])
    exh = intermediate.bars_exhaustion(intermediate.session_vwap(staging.stg_bars(raw)))
    r = exh.where(F.col("session_date") == dt.date(2024, 1, 17)).first()
    assert r["vol_peak_10"] == 5 and r["volume_ratio"] == 1.0


def test_extension_tie_goes_to_earliest(spark):
    # equal bars -> equal extension ratios; the earlier bar is the peak
    raw = bars_df(spark, [(u(10, 0), 10, 10, 10, 10, 5, "T"), (u(10, 5), 10, 10, 10, 10, 5, "T")])
    exh = intermediate.bars_exhaustion(intermediate.session_vwap(staging.stg_bars(raw)))
    (r,) = intermediate.session_features(exh).collect()
    assert r["peak_extension_ts_et"] == et(10, 0)


def test_all_null_ratio_session_still_has_peak(spark):
    raw = bars_df(spark, [(u(10, 0), 10, 10, 10, 10, 0, "Z"), (u(10, 5), 10, 10, 10, 10, 0, "Z")])
    exh = intermediate.bars_exhaustion(intermediate.session_vwap(staging.stg_bars(raw)))
    (r,) = intermediate.session_features(exh).collect()
    assert r["max_vwap_extension_ratio"] is None
    assert r["peak_extension_ts_et"] == et(10, 0)


OUTCOMES = [  # (trades, win) of the result row, or None = no result row
    (None, "never_triggered", False, False),
    ((0, 0), "never_triggered", False, False),
    ((2, 1), "won", True, True),
    ((1, 0), "lost", True, False),
    ((1, None), "lost", True, False),
    ((None, 1), "never_triggered", False, False),
]


def test_outcomes_and_funnel_stages(spark):
    setups, results = [], []
    for i, (res, *_rest) in enumerate(OUTCOMES):
        setups.append((f"S{i}", D, 1.0, 2.0, 1.0, 2.0, 10, 50.0, 2, 0.1))
        if res is not None:
            results.append((f"S{i}", D, 50.0, 2, 10, res[0], 1.0, res[1], 0))
    s = staging.stg_setups(spark.createDataFrame(setups, schemas.SETUPS))
    r = staging.stg_results(spark.createDataFrame(results, schemas.RESULTS))
    out = intermediate.setup_outcomes(s, r)
    feats = spark.createDataFrame(
        [("S2", D, 3, 1.0, 1.2, 0.5, dt.datetime(2024, 1, 16, 10), 1)],
        "symbol string, session_date date, bar_count bigint, session_volume double, "
        "max_vwap_extension_ratio double, max_day_gain double, peak_extension_ts_et timestamp_ntz, "
        "bars_meeting_2of3 bigint")
    fun = {row["symbol"]: row for row in marts.setup_funnel(out, feats).collect()}
    assert len(fun) == len(OUTCOMES)
    for i, (_res, stage, traded, winner) in enumerate(OUTCOMES):
        row = fun[f"S{i}"]
        assert (row["funnel_stage"], row["is_traded"], row["is_winner"]) == (stage, traded, winner)
        assert row["is_candidate"] is True
        assert row["has_bar_data"] is (i == 2)


def test_invariants_on_test_tables(spark):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    m = pipeline.build_models(bars, setups, results)
    assert m["stg_bars"].count() == bars.count()                       # staging never filters
    assert m["setup_funnel"].count() == m["stg_setups"].count()        # left join never shrinks
    sig = m["signal_candidates"]
    assert sig.groupBy("symbol", "session_date").agg(
        F.sum(F.col("is_best_setup_of_day").cast("int")).alias("b")).where("b != 1").count() == 0
    # running day_high never decreases within a session
    from pyspark.sql import Window
    w = Window.partitionBy("symbol", "session_date").orderBy("bar_ts_utc")
    dec = m["session_vwap"].withColumn("prev", F.lag("day_high").over(w)).where(
        F.col("day_high") < F.col("prev"))
    assert dec.count() == 0
    # session VWAP lies between the running min(low) and running max(high)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (m["session_vwap"].withColumn("lo", F.min("low_price").over(run))
           .where(F.col("session_vwap").isNotNull()
                  & ((F.col("session_vwap") < F.col("lo") - F.lit(1e-9))
                     | (F.col("session_vwap") > F.col("day_high") + F.lit(1e-9)))))
    assert out.count() == 0


def test_permutation_invariance(spark):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    a = pipeline.build_models(bars, setups, results)["signal_candidates"]
    shuffled = bars.repartition(7).orderBy(F.rand(seed=3))
    b = pipeline.build_models(shuffled, setups, results)["signal_candidates"]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reduced_funnel_equals_unreduced(spark):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    a = pipeline.build_models(bars, setups, results)["setup_funnel"]
    whole = pipeline.build_models(bars, setups, results)
    whole.put("session_features", whole["session_features"])   # as after writing them
    b = whole["setup_funnel"]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_single_exchange_for_all_windows(spark):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    exh = pipeline.build_models(bars, setups, results)["bars_exhaustion"]
    plan = exh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(symbol") == 1


def test_known_counts_on_test_tables(spark):
    """Regression guard on the adapters + models (figures cross-checked with DuckDB)."""
    from conftest import SF01
    from sessionmart.plans import reports
    bars, setups, results = testdata.load_inputs(spark, SF01)
    m = pipeline.build_models(bars, setups, results)
    assert m["signal_candidates"].count() == 108
    k = reports.kpi_summary(m["setup_funnel"]).first()
    assert (k["candidates"], k["traded"], k["won"]) == (2651, 933, 765)
    assert m["setup_funnel"].where("has_bar_data").count() == 1500
