"""Chunked session windows equal the plain ones."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import bars_df
from parity import canonical
from sessionmart.operators import windows as Wn
from sessionmart.operators.long_sessions import CHUNK, LongSessions
from sessionmart.plans import pipeline

FIGURES = {"cum": ("sum", "volume"), "high": ("max", "price"), "first": ("first", "price")}


def plain(bars):
    return bars.withColumns({"cum": Wn.running_sum("volume"), "high": Wn.running_max("price"), "first": Wn.session_first("price"),
                             "peak": Wn.trailing_max("volume", 10)})


def chunked(long, bars):
    return long.trailing_max(long.running(bars, FIGURES), "peak", "volume", 10)


def same(a, b):
    cols = sorted(a.columns)
    return a.select(cols).exceptAll(b.select(cols)).isEmpty() and b.select(cols).exceptAll(a.select(cols)).isEmpty()


def digest(df):
    h = F.xxhash64(*sorted(df.columns))
    return tuple(df.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())


def test_a_session_of_a_million_bars_runs_in_many_tasks(spark):
    i = F.col("id")
    bars = spark.range(1_000_000).select(
        F.when(i % 1000 == 0, F.lit("B")).otherwise("A").alias("symbol"), F.lit(dt.date(2024, 3, 5)).alias("session_date"),
        F.timestamp_add("MICROSECOND", i * 20_000, F.lit("2024-03-05 14:30:00").cast("timestamp_ntz")).alias("bar_ts_utc"),
        (F.xxhash64("id") % 1000 / 4).alias("price"), F.when(i % 7 != 3, (i * 31 % 911).cast("double")).alias("volume"))
    long = LongSessions.find(bars, 20_000)
    sizes = long.tag(bars).groupBy("symbol", CHUNK).count().collect()
    assert [r["count"] for r in sizes if r.symbol == "B"] == [1000] and all(r[CHUNK] is None for r in sizes if r.symbol == "B")
    assert 45 <= sum(r.symbol == "A" for r in sizes) <= 70 and max(r["count"] for r in sizes) < 45_000
    out = chunked(long, bars)
    assert out.columns == [*bars.columns, "cum", "high", "first", "peak"]
    assert digest(out) == digest(plain(bars))


def test_short_chunks_missing_values_and_ties(spark):
    r = random.Random(1)
    rows = []
    for s in ("A", "B", None):
        for d in (1, 2):
            t = 0
            for _ in range(r.choice([1, 30, 200])):
                t += r.choice([1, 1, 50, 3000])
                rows.append((s, dt.date(2024, 1, d), dt.datetime(2024, 1, d, 10) + dt.timedelta(milliseconds=t),
                             r.choice([None, r.randrange(80) / 4]), r.choice([None, float(r.randrange(50))])))
    bars = spark.createDataFrame(rows, "symbol string, session_date date, bar_ts_utc timestamp_ntz, price double, volume double").repartition(3)
    for chunk_bars in (1, 3, 25, 1000):  # chunks of fewer bars than the rolling window, too
        assert same(chunked(LongSessions.find(bars, chunk_bars), bars), plain(bars))
    empty = bars.where("false")
    assert chunked(LongSessions.find(empty, 3), empty).count() == 0
    # bars of one time are never parted
    tied = bars.withColumn("bar_ts_utc", F.date_trunc("second", "bar_ts_utc").cast("timestamp_ntz"))
    parted = LongSessions.find(tied, 3).tag(tied).groupBy("symbol", "session_date", "bar_ts_utc").agg(F.count_distinct(CHUNK).alias("n"))
    assert parted.where("n > 1").isEmpty()


def test_the_models_are_the_same_in_chunks(spark):
    start = dt.datetime(2024, 1, 16, 14, 0)  # 09:00 in New York: some bars are before the session
    rows = [(start + dt.timedelta(seconds=4 * k), 10 + k % 8, 20 + k % 11, 8 + k % 5, 10 + k % 9, (k * 7) % 31, "X") for k in range(3000)]
    rows += [(start + dt.timedelta(minutes=k), 10, 12, 9, 11, k % 4, "Y") for k in range(200)]
    setups = spark.createDataFrame([("X", dt.date(2024, 1, 16), 1.0, 1.0, 1.0, 1.0, 1, 1.0, 1, 1.0)],
                                   "symbol string, date date, open double, high double, low double, close double, volume long, "
                                   "gain_percent double, days_up int, prior_gain double")
    results = spark.createDataFrame([], "symbol string, date date, gain_pct double, days_up int, volume long, trades int, pnl double, win int, loss int")
    bars = bars_df(spark, rows)
    a, b = pipeline.build_models(bars, setups, results), pipeline.build_models(bars, setups, results, chunk_bars=300)
    for name in ("session_vwap", "bars_exhaustion", "session_features", "setup_funnel"):
        assert a[name].columns == b[name].columns
        x, y = (canonical(m[name].columns, [tuple(r) for r in m[name].collect()]) for m in (a, b))
        assert x == y and x[1]


def test_a_bar_finds_its_chunk_by_binary_search(spark):
    day, noon = dt.date(2024, 3, 5), dt.datetime(2024, 3, 5, 12)
    marks = [10 * k for k in range(1, 256)]
    cuts = spark.createDataFrame([("A", day, [int(noon.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) + m for m in marks])],
                                 "symbol string, session_date date, cuts array<long>")
    bars = spark.createDataFrame([("A", day, noon + dt.timedelta(microseconds=k)) for k in range(0, 2600, 5)] + [("A", day, None), ("B", day, noon)],
                                 "symbol string, session_date date, bar_ts_utc timestamp_ntz")
    tagged = LongSessions(cuts, 256).tag(bars)
    got = {(r.symbol, r.bar_ts_utc): r[CHUNK] for r in tagged.collect()}
    assert got.pop(("B", noon)) is None and got.pop(("A", None)) == 0
    assert got == {("A", noon + dt.timedelta(microseconds=k)): sum(m <= k for m in marks) for k in range(0, 2600, 5)}
    assert "filter(cuts" not in tagged._jdf.queryExecution().optimizedPlan().toString()  # no bar is compared with every cut
