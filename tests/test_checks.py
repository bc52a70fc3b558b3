"""Every check kind passes on clean input and fires on a planted violation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001, bars_df
from sessionmart.operators import quality as Q
from sessionmart.plans import pipeline, quality_suite, staging
from sessionmart.sources import testdata


def _count(check, models):
    row = Q.run_checks([check], models).first()
    return row["violations"], row["status"]


def test_not_null(spark):
    clean = spark.createDataFrame([(1,), (2,)], "a int")
    dirty = spark.createDataFrame([(1,), (None,), (None,)], "a int")
    ch = Q.not_null("m", "a")
    assert _count(ch, {"m": clean}) == (0, "pass")
    assert _count(ch, {"m": dirty}) == (2, "fail")
    assert Q.violations(ch, {"m": dirty}).count() == 2


def test_unique_ignores_nulls_and_counts_values(spark):
    ch = Q.unique("m", "a")
    assert _count(ch, {"m": spark.createDataFrame([(1,), (None,), (None,)], "a int")})[0] == 0
    dirty = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (3,)], "a int")
    assert _count(ch, {"m": dirty}) == (2, "fail")


def test_unique_combination(spark):
    ch = Q.unique_combination("m", ("a", "b"))
    assert _count(ch, {"m": spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")})[0] == 0
    assert _count(ch, {"m": spark.createDataFrame([(1, 1), (1, 1)], "a int, b int")})[0] == 1


def test_accepted_values_null_passes(spark):
    ch = Q.accepted_values("m", "s", ("x", "y"))
    assert _count(ch, {"m": spark.createDataFrame([("x",), (None,)], "s string")})[0] == 0
    dirty = spark.createDataFrame([("x",), ("z",), ("z",), ("w",)], "s string")
    assert _count(ch, {"m": dirty}) == (2, "fail")       # distinct bad values


def test_relationships_null_child_passes(spark):
    parent = spark.createDataFrame([("A",)], "symbol string")
    ch = Q.relationships("c", "symbol", "p", "symbol", severity="warn")
    ok = spark.createDataFrame([("A",), (None,)], "symbol string")
    bad = spark.createDataFrame([("A",), ("B",), ("B",)], "symbol string")
    assert _count(ch, {"c": ok, "p": parent}) == (0, "pass")
    assert _count(ch, {"c": bad, "p": parent}) == (2, "warn")


def test_malformed_bars(spark):
    t = dt.datetime(2024, 1, 16, 15, 0)
    rows = [
        (t, 5, 4, 6, 5, 1, "LOW_GT_HIGH"),
        (t, 5, 6, 4, 7, 1, "HIGH_LT_CLOSE"),
        (t, 3, 6, 4, 5, 1, "LOW_GT_OPEN"),
        (t, 5, 6, 4, 5, -1, "NEG_VOLUME"),
        (t, 5, 5, 5, 5, 0, "FLAT"),
    ]
    stg = staging.stg_bars(bars_df(spark, rows))
    bad = {r["symbol"] for r in stg.where(quality_suite.malformed_predicate(stg)).collect()}
    assert bad == {"LOW_GT_HIGH", "HIGH_LT_CLOSE", "LOW_GT_OPEN", "NEG_VOLUME"}


def test_signals_outside_hours(spark):
    df = spark.createDataFrame([("09:44:59.999999",), ("09:45:00.000000",), ("14:00:00.000000",),
                                ("14:00:00.500000",)], "bar_time_et string")
    pred = quality_suite.outside_hours_predicate()(df)
    assert df.where(pred).count() == 2


def test_suite_has_42_checks_and_passes_on_test_tables(spark):
    assert len(quality_suite.suite()) == 42
    bars, setups, results = testdata.load_inputs(spark, SF001)
    res = quality_suite.run_suite(pipeline.build_models(bars, setups, results))
    rows = res.collect()
    assert len(rows) == 42 and len({r["check_name"] for r in rows}) == 42
    assert all(r["status"] == "pass" for r in rows), [r for r in rows if r["status"] != "pass"]


def test_suite_fires_on_duplicated_bars(spark):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    doubled = bars.unionByName(bars.orderBy("symbol", "timestamp").limit(3))  # the same rows in every pass
    res = quality_suite.run_suite(pipeline.build_models(doubled, setups, results))
    fails = {r["check_name"]: r["violations"] for r in res.where("status = 'fail'").collect()}
    assert fails.get("unique_stg_bars_bar_key") == 3


def test_relationship_severity_depends_on_target(spark):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    some = bars.where(F.col("symbol") != F.lit("U1"))
    for target, status in (("dev", "warn"), ("prod", "fail")):
        res = quality_suite.run_suite(pipeline.build_models(some, setups, results), target=target)
        row = res.where(F.col("check_name").startswith("relationships")).first()
        if row["violations"]:
            assert row["status"] == status


def test_key_checks_are_exact(spark):
    rows = [(i % 50, i % 7) for i in range(500)] + [(1000, 1), (1000, 1), (None, 2), (None, 2)]
    df = spark.createDataFrame(rows, "a int, b int")
    direct = df.groupBy("a", "b").count().where("count > 1").count()
    ch = Q.unique_combination("m", ("a", "b"))
    assert _count(ch, {"m": df})[0] == Q.violations(ch, {"m": df}).count() == direct
    # keys whose texts run into each other, and NULL against the text of a mark
    odd = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "N"), ("N", None), ("1:", "a"), ("1", ":a")], "a string, b string")
    assert _count(ch, {"m": odd})[0] == 0


def test_key_text_is_counted_only_where_hashes_repeat(spark):
    # a missing value is skipped by the hash, so these keys share theirs and differ all the same
    odd = spark.createDataFrame([(None, "x"), ("x", None), ("a", "b"), ("a", "b"), ("c", None), ("c", None)], "a string, b string")
    ch = Q.unique_combination("m", ("a", "b"))
    entries = Q._entries([ch], {"m": odd})
    assert entries.where("key is not null").isEmpty() and entries.select("hash").distinct().count() == 3
    assert _count(ch, {"m": odd})[0] == 2
    clean = spark.range(1000).selectExpr("cast(id as string) as a")
    plan = Q.run_checks([Q.unique("m", "a")], {"m": clean})._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan  # all hashes differ: no second pass over the model
    assert _count(Q.unique("m", "a"), {"m": clean.union(clean.limit(3))})[0] == 3


def test_key_checks_on_a_view_take_the_base_result(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    checks = [Q.unique("base", "a"), Q.unique("view", "a"), Q.not_null("view", "a")]
    rows = {r["check_name"]: r["violations"] for r in Q.run_checks(checks, {"base": df, "view": df}, {"view": "base"}).collect()}
    assert rows == {"unique_base_a": 1, "unique_view_a": 1, "not_null_view_a": 0}


def test_planted_faults_are_counted(spark):
    res = quality_suite.run_suite(pipeline.build_models(*testdata.planted_inputs(spark, SF001)))
    found = {r["check_name"]: r["violations"] for r in res.collect()}
    for name in ("unique_stg_bars_bar_key", "not_null_stg_bars_symbol", "assert_no_malformed_bars", "not_null_stg_setups_symbol",
                 "not_null_stg_results_setup_date", "unique_combination_setup_funnel_symbol__setup_date",
                 "relationships_stg_setups_symbol__stg_bars_symbol"):
        assert found[name] > 0, name
    assert found["unique_bars_exhaustion_bar_key"] == found["unique_session_vwap_bar_key"] > 0


def test_source_profile_of_a_users_bars(spark):
    t = dt.datetime(2024, 1, 16, 15, 0)
    bars = bars_df(spark, [(t, 5, 4, 6, 5, 1, "A"), (t, 5, 6, 4, 5, 1, "A"), (t, 5, 6, 4, 5, 1, None)])
    r = quality_suite.source_profile(bars).first()
    assert (r["rows"], r["malformed_bars"], r["null_cells"], r["duplicate_keys"]) == (3, 1, 4, 1)
