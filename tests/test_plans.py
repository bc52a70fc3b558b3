"""Plan guards over every registered query: no cross joins, no Python in the
plan, windows only over bounded partitions."""

from __future__ import annotations

import re

import pytest

from conftest import SF001
from sessionmart import catalog
from sessionmart.sources import sinks

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
# Window partition keys allowed: a session or a UTC day of one symbol; the
# grain check also windows one symbol's day-level table (one row per day).
WINDOW_KEYS = ({"symbol", "session_date"}, {"symbol", "utc_date"}, {"symbol", "session_date", "session_chunk"})


def _plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = catalog.queries()[name](spark, SF001)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_guards(spark, name):
    plan = _plan(spark, name)
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
    for spec in re.findall(r"windowspecdefinition\(([^)]*?)(?:,\s*\w+#\d+\s+(?:ASC|DESC)|,\s*specifiedwindowframe)", plan):
        keys = {re.sub(r"#\d+L?$", "", k.strip()) for k in spec.split(",")}
        allowed = WINDOW_KEYS + {"bar_grain": ({"symbol"},), "long_session_windows": ({"symbol", "session_chunk"},)}.get(name, ())  # one planted date
        assert keys in allowed, f"{name}: window partitioned by {keys}"
    specs = re.findall(r"windowspecdefinition", plan)
    if name in ("signal_candidates", "session_features", "bars_exhaustion"):
        assert specs, f"{name}: expected session windows in the plan"


# Queries that write a table and read it back; all others only plan.
WRITERS = {"dq_summary", "dq_planted", "single_day_volume", "partitioned_roundtrip", "rebuild_roundtrip", "seed_csv_roundtrip",
           "seed_reordered_csv", "universe_from_csv", "seed_files_by_header", "failed_load_keeps_table", "first_file_per_symbol",
           "long_session_windows", "bucketed_sessions"}


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - WRITERS))
def test_building_a_query_runs_no_job(spark, name):
    spark.read.parquet(f"{SF001}/events.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        catalog.queries()[name](spark, SF001)
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        stages = [i for j in jobs for i in tracker.getJobInfo(j).stageIds]
        assert len(jobs) <= 1 and all(tracker.getStageInfo(i).numTasks == 1 for i in stages)  # the Parquet footer
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_probe_day_reads_its_partition_only(spark):
    df = catalog.queries()["single_day_volume"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*utc_date", plan)


def test_pipeline_plans_with_adaptive_execution(spark):
    """The plan that runs: one hash exchange for the session windows and the features on top."""
    df = catalog.queries()["session_features"](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, session_date#\d+", plan)) == 1


def test_grain_window_by_symbol_runs_on_day_table(spark):
    plan = _plan(spark, "bar_grain")
    # the symbol-only window sits above an aggregate to (symbol, utc_date)
    assert re.search(r"HashAggregate\(keys=\[symbol#\d+, utc_date#\d+", plan)


def test_funnel_key_reduction_sits_below_the_window_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = catalog.queries()["setup_funnel"](spark, SF001)
        lines = df._jdf.queryExecution().executedPlan().treeString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchange = next(i for i, ln in enumerate(lines)
                    if "Exchange hashpartitioning(symbol" in ln and "session_date" in ln)
    semi = next(i for i, ln in enumerate(lines) if "LeftSemi" in ln)
    assert semi > exchange        # deeper in the tree = runs before the window shuffle


def test_bucketed_sessions_need_no_exchange(spark, tmp_dir):
    sinks.create_layers(spark, prefix="smbucket")
    m = catalog.models(spark, SF001)
    tables = {"session_vwap": ("session_date", "bar_ts_utc"), "setup_outcomes": ("setup_date",)}
    for name, rest in tables.items():
        sinks.write_bucketed(m[name], f"smbucket_raw.{name}", ("symbol", rest[0]), ("symbol", *rest), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        funnel = catalog.bucketed_funnel(spark, "smbucket_raw.session_vwap", "smbucket_raw.setup_outcomes")
        rows = funnel.collect()
        plan = funnel._jdf.queryExecution().executedPlan().toString()  # after it ran, adaptive execution on
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "isFinalPlan=true" in plan and "Exchange" not in plan and "Window" in plan and "SortMergeJoin" in plan
    assert sorted(map(str, rows)) == sorted(map(str, m["setup_funnel"].select(funnel.columns).collect()))
    with pytest.raises(ValueError):
        sinks.write_bucketed(m["session_vwap"], "/a/path", ("symbol",), ("symbol",), 4)
