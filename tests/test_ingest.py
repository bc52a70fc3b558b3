"""Ingest, sources and sinks: universe, semi/anti joins, guards, grain, round trips."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, bars_df
from parity import canonical
from sessionmart import schemas
from sessionmart.plans import pipeline
from sessionmart.sources import ingest, readers, sinks, testdata
from sessionmart.sources.files import Store


def test_universe_semi_and_missing(spark):
    t = dt.datetime(2024, 1, 16, 15, 0)
    bars = bars_df(spark, [(t, 1, 1, 1, 1, 1, "A"), (t, 1, 1, 1, 1, 1, "B")])
    u = spark.createDataFrame([("A",), ("C",), (None,)], "symbol string")
    uni = ingest.universe(u)
    assert sorted(r[0] for r in uni.collect()) == ["A", "C"]
    assert [r["symbol"] for r in ingest.restrict_to_universe(bars, uni).collect()] == ["A"]
    assert [r[0] for r in ingest.missing_symbols(uni, bars).collect()] == ["C"]
    rep = ingest.ingest_report(uni, ingest.restrict_to_universe(bars, uni)).first()
    assert (rep["symbols_total"], rep["symbols_resolved"], rep["symbols_missing"], rep["rows"],
            rep["est_logical_bytes"]) == (2, 1, 1, 1, 62)


def test_count_guard(spark):
    bars, _, _ = testdata.load_inputs(spark, SF001)
    rows, syms = ingest.count_guard(bars)
    assert ingest.count_guard(bars, rows, syms) == (rows, syms)
    with pytest.raises(ingest.IngestError):
        ingest.count_guard(bars, expected_rows=rows + 1)


def test_grain_guard_detects_daily_bars(spark):
    minute = [(dt.datetime(2024, 1, 16, 15, m), 1, 1, 1, 1, 1, "M") for m in range(5)]
    daily = [(dt.datetime(2024, 1, d, 5, 0), 1, 1, 1, 1, 1, "D") for d in range(2, 9)]
    g = {r["symbol"]: r for r in ingest.bar_grain(bars_df(spark, minute + daily)).collect()}
    assert g["M"]["modal_gap_seconds"] == 60 and not g["M"]["is_daily_grain"]
    assert g["D"]["modal_gap_seconds"] == 86400 and g["D"]["is_daily_grain"]
    ingest.grain_guard(bars_df(spark, minute))
    with pytest.raises(ingest.IngestError):
        ingest.grain_guard(bars_df(spark, minute + daily))


def test_dedup_of_overlapping_files(spark, tmp_dir):
    t = dt.datetime(2024, 1, 16, 15, 0)
    bars_df(spark, [(t, 1, 2, 1, 2, 5, "A")]).write.parquet(os.path.join(tmp_dir, "A_1min_b.parquet"))
    bars_df(spark, [(t, 1, 3, 1, 3, 7, "A")]).write.parquet(os.path.join(tmp_dir, "A_1min_a.parquet"))
    out = ingest.read_bar_files(spark, os.path.join(tmp_dir, "A_1min_*.parquet"))
    assert out.schema == schemas.BARS_NTZ
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["volume"] == 7.0       # the copy from the first file by path


def test_preconditions(spark, tmp_dir):
    with pytest.raises(ingest.IngestError):
        ingest.check_preconditions(spark, source_path=os.path.join(tmp_dir, "nope.parquet"))
    with pytest.raises(ingest.IngestError):
        ingest.check_preconditions(spark, database="no_such_namespace_xyz")
    ingest.check_preconditions(spark, source_path=f"{SF001}/events.parquet")


def test_seed_csv_roundtrip_and_failfast(spark, tmp_dir):
    _, setups, results = testdata.load_inputs(spark, SF001)
    p = os.path.join(tmp_dir, "setups_csv")
    setups.write.option("header", True).csv(p)
    back = readers.read_setups(spark, p)
    assert back.schema == schemas.SETUPS
    assert back.exceptAll(setups).count() == 0 and setups.exceptAll(back).count() == 0
    bad = os.path.join(tmp_dir, "bad_csv")
    os.makedirs(bad)
    with open(os.path.join(bad, "x.csv"), "w") as fh:
        fh.write("symbol,date,gain_pct,days_up,volume,trades,pnl,win,loss\n")
        fh.write("A,not-a-date,1,1,1,1,1,1,0\n")
    with pytest.raises(Exception):
        readers.read_results(spark, bad).collect()


def test_partitioned_write_prunes(spark, tmp_dir):
    bars, _, _ = testdata.load_inputs(spark, SF001)
    p = os.path.join(tmp_dir, "raw")
    sinks.write_partitioned(bars.withColumn("utc_date", F.to_date("timestamp")), p,
                            partition_col="utc_date", cluster_by=("symbol", "timestamp"))
    assert any(n.startswith("utc_date=") for n in os.listdir(p))
    day = dt.date(2024, 1, 15)
    one = readers.read_bars(spark, p, sessions=(day, day))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "utc_date" in plan
    # the pruned read still holds every bar of the ET session
    from sessionmart.plans import staging
    full = staging.stg_bars(readers.read_bars(spark, p)).where(F.col("session_date") == day)
    pruned = staging.stg_bars(one).where(F.col("session_date") == day)
    assert full.count() == pruned.count() > 0


def test_a_rebuild_leaves_no_stale_partition(spark, tmp_dir):
    bars, _, _ = testdata.load_inputs(spark, SF001)
    dated = bars.withColumn("utc_date", F.to_date("timestamp"))
    days = sorted(r[0] for r in dated.select("utc_date").distinct().collect())
    sinks.create_layers(spark, prefix="smstale")
    for target in (os.path.join(tmp_dir, "t"), "smstale_raw.bars"):
        sinks.write_partitioned(dated, target, "utc_date")
        sinks.write_partitioned(dated.where(F.col("utc_date") == days[0]), target, "utc_date")
        assert [r[0] for r in sinks.read_table(spark, target).select("utc_date").distinct().collect()] == [days[0]]
    p = os.path.join(tmp_dir, "range")
    sinks.write_partitioned(dated, p, "utc_date")
    sinks.rebuild_partitions(dated.where(F.col("utc_date") == days[1]), p, days[0], days[2], "utc_date")
    left = sorted(r[0] for r in sinks.read_table(spark, p).select("utc_date").distinct().collect())
    assert left == [days[1], *days[3:]]
    for target in (p, "smstale_raw.ranged"):  # in a catalog table too, from rows of the table itself
        sinks.write_partitioned(dated, target, "utc_date")
        own = sinks.read_table(spark, target).where(F.col("utc_date") != days[0])
        sinks.rebuild_partitions(own, target, days[0], days[1], "utc_date")
        assert sorted(r[0] for r in sinks.read_table(spark, target).select("utc_date").distinct().collect()) == days[1:]
        assert sinks.read_table(spark, target).count() == dated.where(F.col("utc_date") != days[0]).count()
    root = sinks.location(spark, "smstale_raw.ranged").removeprefix("file:")
    assert not [x for x in os.listdir(root) if x.startswith(("_staged", "_replaced"))]


def test_moves_happen_all_or_not_at_all(spark, tmp_dir):
    for name in ("a", "b", "taken"):
        os.makedirs(os.path.join(tmp_dir, name))
    at = lambda name: os.path.join(tmp_dir, name)
    with pytest.raises(OSError):
        Store(spark, tmp_dir).exchange([(at("a"), at("x/a")), (at("b"), at("taken"))])
    assert sorted(os.listdir(tmp_dir)) == ["a", "b", "taken", "x"] and os.listdir(at("x")) == []


@pytest.mark.parametrize("target", ["path", "smguard_raw.bars"])
def test_a_refused_load_leaves_the_old_table(spark, tmp_dir, target):
    bars, _, _ = testdata.load_inputs(spark, SF001)
    sinks.create_layers(spark, prefix="smguard")
    target = target if "." in target else os.path.join(tmp_dir, target)
    half = bars.where(F.dayofmonth("timestamp") % 2 == 1)
    with pytest.raises(ingest.IngestError):
        ingest.load_raw(bars, target, expected_rows=1)  # nothing there yet, and nothing after it
    assert not (spark.catalog.tableExists(target) if sinks.is_table(target) else os.path.exists(target))
    n, _ = ingest.load_raw(bars, target)
    with pytest.raises(ingest.IngestError):
        ingest.load_raw(half, target, expected_rows=n)
    with pytest.raises(Exception):  # a write that fails
        ingest.load_raw(half.withColumn("open", F.raise_error(F.lit("broken")).cast("double")), target)
    back = readers.read_bars(spark, target)
    assert back.count() == n and back.exceptAll(bars).count() == 0
    assert ingest.load_raw(half, target) == ingest.count_guard(half)
    assert readers.read_bars(spark, target).count() == half.count()
    left = [t.name for t in spark.catalog.listTables("smguard_raw")] if sinks.is_table(target) else os.listdir(tmp_dir)
    assert left == [target.rpartition(".")[2] if sinks.is_table(target) else "path"]


def test_one_rule_tells_tables_from_paths(spark, tmp_dir, monkeypatch):
    assert sinks.is_table("db.t") and sinks.is_table("c.db.t")
    for path in ("outdir", "out.parquet", "/a/b.c", "a/b.c", "s3://x/y.z", "./x", "x-y.z"):
        assert not sinks.is_table(path)
    monkeypatch.chdir(tmp_dir)
    bars, _, _ = testdata.load_inputs(spark, SF001)
    target = os.path.join(os.getcwd(), "outdir")
    sinks.write_table(bars, target)
    assert readers.read_bars(spark, target).count() == bars.count()


def test_seed_columns_go_by_header_name(spark, tmp_dir):
    p = os.path.join(tmp_dir, "s.csv")
    with open(p, "w") as fh:
        fh.write("note,prior_gain,days_up,gain_percent,volume,close,high,low,open,date,symbol\n")
        fh.write("x,0.5,3,66.5,100,9,11,8,10,2024-01-16,A\n")
    r = readers.read_setups(spark, p).first()
    assert (r["open"], r["close"], r["high"], r["low"], r["symbol"], r["days_up"]) == (10.0, 9.0, 11.0, 8.0, "A", 3)
    with open(p, "a") as fh:
        fh.write("x,0.5,three,66.5,100,9,11,8,10,2024-01-16,A\n")
    with pytest.raises(Exception):
        readers.read_setups(spark, p).collect()
    u = ingest.universe_from_csv(spark, p)
    assert [x[0] for x in u.collect()] == ["A"]


def test_each_file_goes_by_its_own_header(spark, tmp_dir):
    _, _, results = testdata.load_inputs(spark, SF001)
    p = os.path.join(tmp_dir, "res ults")
    results.limit(30).write.option("header", True).csv(p)
    results.limit(30).select(*reversed(results.columns), F.lit("x").alias("more")).write.mode("append").option("header", True).csv(p)
    back = readers.read_results(spark, p).collect()
    assert sorted(back, key=str) == sorted(2 * results.limit(30).collect(), key=str)
    assert {r[0] for r in ingest.universe_from_csv(spark, p).collect()} == {r.symbol for r in back}
    results.drop("win").limit(3).write.mode("append").option("header", True).csv(p)
    with pytest.raises(ValueError, match="win"):
        readers.read_results(spark, p)
    assert {r[0] for r in ingest.universe_from_csv(spark, p).collect()} == {r.symbol for r in back} | {r.symbol for r in results.limit(3).collect()}
    empty = os.path.join(tmp_dir, "empty.csv")
    open(empty, "w").close()
    assert readers.read_results(spark, empty).collect() == []


def test_first_file_of_each_symbol(spark, tmp_dir):
    t = dt.datetime(2024, 1, 16, 15, 0)
    for name, v in (("A_1min_b", 1), ("A_1min_a", 2), ("B_1min_x", 3), ("C_1min_x", 4)):
        bars_df(spark, [(t, 1, 2, 1, 2, v, name[0])]).write.parquet(os.path.join(tmp_dir, f"{name}.parquet"))
    cache = os.path.join(tmp_dir, "*_1min_*.parquet")
    with open(os.path.join(tmp_dir, "C_1min_zz.parquet"), "w") as fh:
        fh.write("not parquet, and never opened")
    symbols = spark.createDataFrame([("A",), ("C",), ("Z",)], "symbol string")
    assert sorted((r.symbol, r.volume) for r in ingest.read_first_files(spark, cache, symbols).collect()) == [("A", 2.0), ("C", 4.0)]
    assert ingest.read_first_files(spark, cache).count() == 3
    assert ingest.read_first_files(spark, cache, symbols.where("false")).collect() == []


def test_cli_refuses_a_missing_namespace_and_lists_missing_symbols_beside_the_table(spark, tmp_dir):
    from sessionmart.__main__ import main
    bars, _, results = testdata.load_inputs(spark, SF001)
    cache, r_csv = os.path.join(tmp_dir, "P_1min_all.parquet"), os.path.join(tmp_dir, "results")
    bars.write.parquet(cache)
    results.write.option("header", True).csv(r_csv)
    with pytest.raises(ingest.IngestError, match="smmissing"):
        main(["ingest", "--cache", cache, "--results", r_csv, "--out", "smmissing.bars"])
    sinks.create_layers(spark, prefix="smcli")
    assert main(["ingest", "--cache", cache, "--results", r_csv, "--out", "smcli_raw.bars"]) == 0
    missing = ingest.missing_symbols(ingest.universe(results), bars)
    assert spark.table("smcli_raw.bars_missing_symbols").count() == missing.count()


def test_layers_are_read_by_name_in_a_second_session(spark):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    res = pipeline.run_pipeline(spark, bars, setups, results, namespace_prefix="smviews")
    models = pipeline.build_models(bars, setups, results)
    later = spark.newSession()
    for name in ("stg_bars", "stg_setups", "bars_exhaustion", "setup_outcomes", "session_vwap"):
        got = later.table(res.tables[name])
        assert sorted(got.columns) == sorted(models[name].columns)
        cols = sorted(got.columns)
        a, b = ([tuple(r) for r in df.select(cols).collect()] for df in (got, models[name]))
        assert canonical(cols, a) == canonical(cols, b) and a
    (r,) = later.sql("SELECT smviews_staging.session_phase(smviews_staging.time_of_day(smviews_staging.to_et(TIMESTAMP_NTZ'2024-07-01 13:30:00'))) AS p, "
                     "smviews_staging.safe_div(1, 0) AS d, smviews_staging.bar_key(NULL, NULL) AS k").collect()
    assert r.p == "regular" and r.d is None and len(r.k) == 32


def test_destination_namespaces_must_exist(spark):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    with pytest.raises(ingest.IngestError):
        pipeline.run_pipeline(spark, bars, setups, results, namespace_prefix="smnone", create_namespaces=False)


def test_session_settings_are_the_submitters(spark):
    from sessionmart.config import get_session
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert get_session().conf.get("spark.sql.shuffle.partitions") == before
    from sessionmart.plans import staging
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError):
            staging.stg_bars(testdata.load_inputs(spark, SF001)[0])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_restriction_comes_before_the_file_dedup(spark, tmp_dir):
    bars, _, results = testdata.load_inputs(spark, SF001)
    bars.write.parquet(os.path.join(tmp_dir, "A_1min_a.parquet"))
    u = ingest.universe(results)
    got = ingest.read_bar_files(spark, os.path.join(tmp_dir, "*_1min_*.parquet"), u)
    assert got.exceptAll(ingest.restrict_to_universe(bars, u).select(got.columns)).count() == 0 and got.count() > 0


def test_pipeline_writes_layers_and_checks(spark, tmp_dir):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    res = pipeline.run_pipeline(spark, bars, setups, results, out_dir=tmp_dir)
    rows = res.checks.collect()
    assert len(rows) == 42 and all(r["status"] == "pass" for r in rows)
    for name in ("session_vwap", "signal_candidates"):
        assert any(n.startswith("session_date=") for n in os.listdir(res.tables[name]))
    fun = sinks.read_table(spark, res.tables["setup_funnel"])
    assert fun.count() == setups.count()


def test_layers_namespaces(spark):
    names = sinks.create_layers(spark, prefix="smtest")
    for db in names.values():
        assert spark.catalog.databaseExists(db)


def test_catalog_tables_per_layer(spark):
    bars, setups, results = testdata.load_inputs(spark, SF001)
    res = pipeline.run_pipeline(spark, bars, setups, results, namespace_prefix="smlayer")
    assert res.tables["session_vwap"] == "smlayer_intermediate.session_vwap"
    assert res.tables["setup_funnel"] == "smlayer_marts.setup_funnel"
    assert spark.table("smlayer_marts.setup_funnel").count() == setups.count()
    assert spark.table("smlayer_raw.setups").count() == spark.table("smlayer_staging.stg_setups").count() == setups.count()
    assert all(r["status"] == "pass" for r in res.checks.collect())


def test_read_bars_from_table_name(spark):
    bars, _, _ = testdata.load_inputs(spark, SF001)
    sinks.create_layers(spark, prefix="smraw")
    bars.write.mode("overwrite").saveAsTable("smraw_raw.bars_1min")
    back = readers.read_bars(spark, "smraw_raw.bars_1min")
    assert back.schema == schemas.BARS_NTZ
    assert back.exceptAll(bars).count() == 0


def test_load_raw_and_sample_universe(spark, tmp_dir):
    bars, _, _ = testdata.load_inputs(spark, SF001)
    n = bars.count()
    p = os.path.join(tmp_dir, "raw")
    assert ingest.load_raw(bars, p, expected_rows=n)[0] == n
    with pytest.raises(ingest.IngestError):
        ingest.load_raw(bars, os.path.join(tmp_dir, "raw2"), expected_rows=n + 1)
    sample = ingest.sample_universe(spark)
    assert sample.count() == 10
    assert ingest.restrict_to_universe(bars, sample).count() == 0   # synthetic symbols differ


def test_sizing_for_100tb():
    from sessionmart.config import sizing
    conf = sizing(100 << 40, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert int(sizing(1 << 20, total_cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_cli_ingest_then_build(spark, tmp_dir, capsys):
    from sessionmart.__main__ import main
    bars, setups, results = testdata.load_inputs(spark, SF001)
    cache = os.path.join(tmp_dir, "cache")
    for i, part in enumerate(bars.randomSplit([0.5, 0.5], seed=1)):
        part.write.parquet(os.path.join(cache, f"P{i}_1min_all.parquet"))
    s_csv, r_csv = os.path.join(tmp_dir, "setups"), os.path.join(tmp_dir, "results")
    setups.write.option("header", True).csv(s_csv)
    results.write.option("header", True).csv(r_csv)
    raw = os.path.join(tmp_dir, "raw")
    assert main(["ingest", "--cache", os.path.join(cache, "*_1min_*.parquet"),
                 "--results", r_csv, "--out", raw]) == 0
    universe_rows = ingest.restrict_to_universe(bars, ingest.universe(results)).count()
    assert spark.read.parquet(raw).count() == universe_rows
    assert main(["build", "--bars", raw, "--setups", s_csv, "--results", r_csv,
                 "--out", os.path.join(tmp_dir, "wh")]) == 0
    assert '"failed": 0' in capsys.readouterr().out
    missing = spark.read.option("header", True).csv(raw + "_missing_symbols")
    assert missing.columns == ["symbol"] and missing.count() == ingest.missing_symbols(ingest.universe(results), bars).count()
