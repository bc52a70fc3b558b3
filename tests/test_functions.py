"""Scalar expressions: zone conversion (DST fixture), time of day, phase, keys, ratios."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from sessionmart import params as P
from sessionmart.functions import (
    bool_to_int,
    fraction_from_percent,
    int_flag,
    safe_div,
    session_phase,
    surrogate_key,
    time_of_day,
    to_et,
)
from sessionmart.plans.marts import entry_gate

# UTC -> New York, incl. both 2024 DST transitions (hand-checked values).
DST = [
    (dt.datetime(2024, 1, 16, 14, 30), dt.datetime(2024, 1, 16, 9, 30), dt.date(2024, 1, 16), "regular"),
    (dt.datetime(2024, 7, 16, 13, 30), dt.datetime(2024, 7, 16, 9, 30), dt.date(2024, 7, 16), "regular"),
    (dt.datetime(2024, 1, 17, 0, 30), dt.datetime(2024, 1, 16, 19, 30), dt.date(2024, 1, 16), "postmarket"),
    (dt.datetime(2024, 3, 10, 6, 59), dt.datetime(2024, 3, 10, 1, 59), dt.date(2024, 3, 10), "postmarket"),
    (dt.datetime(2024, 3, 10, 7, 0), dt.datetime(2024, 3, 10, 3, 0), dt.date(2024, 3, 10), "postmarket"),
    (dt.datetime(2024, 11, 3, 5, 59), dt.datetime(2024, 11, 3, 1, 59), dt.date(2024, 11, 3), "postmarket"),
    (dt.datetime(2024, 11, 3, 6, 0), dt.datetime(2024, 11, 3, 1, 0), dt.date(2024, 11, 3), "postmarket"),
]


def test_to_et_dst_boundaries(spark):
    df = spark.createDataFrame([(r[0],) for r in DST],
                               StructType([StructField("ts", TimestampNTZType())]))
    et = to_et("ts")
    out = df.select("ts", et.alias("et"), F.to_date(et).alias("d"),
                    session_phase(time_of_day(et)).alias("phase")).collect()
    got = {r["ts"]: (r["et"], r["d"], r["phase"]) for r in out}
    for ts, et_exp, d_exp, ph in DST:
        assert got[ts] == (et_exp, d_exp, ph), ts
    assert dict(df.select(et.alias("e")).dtypes)["e"] == "timestamp_ntz"


def test_to_et_accepts_zoned_timestamp(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-07-16 13:30:00' AS ts")  # UTC session
    assert df.select(to_et("ts")).first()[0] == dt.datetime(2024, 7, 16, 9, 30)


EDGES = [
    ("03:59:59", "postmarket", False), ("04:00:00", "premarket", False),
    ("09:29:59", "premarket", False), ("09:30:00", "regular", False),
    ("09:45:00", "regular", True), ("14:00:00", "regular", True),
    ("14:00:00.5", "regular", False), ("15:59:59", "regular", False),
    ("16:00:00", "postmarket", False),
]


@pytest.mark.parametrize("hms,phase,in_gate", EDGES)
def test_phase_and_gate_edges(spark, hms, phase, in_gate):
    ts = dt.datetime.fromisoformat(f"2024-01-16T{hms}")
    df = spark.createDataFrame([(ts,)], StructType([StructField("et", TimestampNTZType())]))
    tod = time_of_day("et")
    assert df.select(session_phase(tod)).first()[0] == phase
    gate = (df.select(tod.alias("bar_time_et"), F.lit(1.0).alias("day_gain"),
                      F.lit(1.0).alias("close_price"), F.lit(1.0).alias("session_vwap"),
                      F.lit(3).alias("criteria_met"))
            .select(entry_gate().alias("g")).first()["g"])
    assert gate is in_gate


def test_time_of_day_keeps_microseconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 14, 0, 0, 500000),)],
                               StructType([StructField("t", TimestampNTZType())]))
    assert df.select(time_of_day("t")).first()[0] == "14:00:00.500000"


def test_surrogate_key_matches_md5_of_text(spark):
    ts = dt.datetime(2024, 1, 16, 14, 30)
    schema = StructType([StructField("symbol", StringType()), StructField("ts", TimestampNTZType())])
    df = spark.createDataFrame([("ABC", ts), (None, ts), ("ABC", None)], schema)
    got = [r[0] for r in df.select(surrogate_key("symbol", "ts", timestamp_cols=("ts",))).collect()]
    tok = P.SURROGATE_KEY_NULL
    exp = [hashlib.md5(s.encode()).hexdigest() for s in (
        "ABC-2024-01-16 14:30:00.000000", f"{tok}-2024-01-16 14:30:00.000000", f"ABC-{tok}")]
    assert got == exp


def test_safe_div_and_flags(spark):
    df = spark.createDataFrame([(1.0, 0.0, None, 1), (3.0, 2.0, True, 0), (1.0, None, False, None)],
                               "a double, b double, f boolean, w int")
    rows = df.select(safe_div("a", "b").alias("q"), bool_to_int("f").alias("i"),
                     int_flag("w").alias("fw"), fraction_from_percent("a").alias("fr")).collect()
    assert [r["q"] for r in rows] == [None, 1.5, None]
    assert [r["i"] for r in rows] == [0, 1, 0]
    assert [r["fw"] for r in rows] == [True, False, None]
    assert [r["fr"] for r in rows] == [0.01, 0.03, 0.01]


def test_stg_bars_requires_utc_session(spark):
    from sessionmart.plans import staging
    from conftest import bars_df
    df = bars_df(spark, [(dt.datetime(2024, 1, 16, 14, 30), 1, 1, 1, 1, 1, "A")])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            staging.stg_bars(df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
