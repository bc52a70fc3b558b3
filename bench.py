"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's plan is executed completely through the ``noop`` sink (every
row produced, nothing collected to the driver), twice: ``queries`` holds the
better of the two runs (the first run also pays class loading and code
generation for its plan shape; it is reported under ``cold``). Prints ONE
JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Also reported:
* ``pipeline`` -- the full production-style build (window table written once,
  partitioned table writes, 42 checks over the written tables), one run;
* ``pruning`` -- bytes / files scanned by SUM(volume) over the raw bars loaded
  partitioned by UTC day: whole table vs one day.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sessionmart import catalog  # noqa: E402
from sessionmart.config import get_session  # noqa: E402
from sessionmart.plans import pipeline  # noqa: E402
from sessionmart.sources import ingest, readers, testdata  # noqa: E402

HEADLINE = ("stg_bars", "session_vwap", "bars_exhaustion", "session_features",
            "signal_candidates", "setup_funnel", "kpi_summary", "dq_summary")
RUNS = 2


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def scanned(df) -> tuple[int, int]:
    """(bytes, files) read by the file scans of an executed query."""
    df.collect()
    stack, total, files = [df._jdf.queryExecution().executedPlan()], 0, 0
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.finalPhysicalPlan())
            continue
        if "QueryStage" in name:
            stack.append(node.plan())
            continue
        m = node.metrics()
        if m.contains("filesSize"):
            total += m.get("filesSize").get().value()
            files += m.get("numFiles").get().value()
        ch = node.children()
        stack.extend(ch.apply(i) for i in range(ch.size()))
    return total, files


def pruning(spark, sf_dir: str, scratch: str) -> dict:
    bars, _, _ = testdata.load_inputs(spark, sf_dir)
    path = os.path.join(scratch, "raw_bars")
    ingest.load_raw(bars, path)
    day = catalog.PROBE_DAY
    full_b, full_f = scanned(readers.read_bars(spark, path).agg(F.sum("volume")))
    one = spark.read.parquet(path).where(F.col("utc_date") == F.lit(day)).agg(F.sum("volume"))
    day_b, day_f = scanned(one)
    # one ET session through the reader's session predicate (UTC days d, d+1)
    ses_b, ses_f = scanned(readers.read_bars(spark, path, sessions=(day, day)).agg(F.sum("volume")))
    return {"full_bytes": full_b, "full_files": full_f, "day_bytes": day_b, "day_files": day_f,
            "factor": round(full_b / day_b, 1) if day_b else None, "day": day.isoformat(),
            "session_bytes": ses_b, "session_files": ses_f}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(sys.argv[1:])
    scratch = tempfile.mkdtemp(prefix="sessionmart-bench-")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": "8g",
                               "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()
    run(qs["bars_symbol_counts"](spark, sf_dir))   # JVM start-up is not query cost
    best: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        for i in range(RUNS):
            t = time.perf_counter()
            run(fn(spark, sf_dir))
            sec = round(time.perf_counter() - t, 3)
            if i == 0:
                cold[name] = sec
            best[name] = min(best.get(name, sec), sec)
    extra = {}
    if not only or "pipeline" in only:
        t = time.perf_counter()
        bars, setups, results = testdata.load_inputs(spark, sf_dir)
        res = pipeline.run_pipeline(spark, bars, setups, results,
                                    out_dir=os.path.join(scratch, "warehouse"))
        res.checks.collect()
        extra["pipeline_sec"] = round(time.perf_counter() - t, 3)
    if not only or "pruning" in only:
        extra["pruning"] = pruning(spark, sf_dir, scratch)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec", "value": round(sum(best.values()), 3), "unit": "sec",
        "headline_sec": round(sum(best.get(k, 0.0) for k in HEADLINE), 3),
        "queries": best, "cold_total_sec": round(sum(cold.values()), 3), "cold": cold,
        **extra, "runs_per_query": RUNS,
        "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
        "generated": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
