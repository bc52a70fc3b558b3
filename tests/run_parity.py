"""Run every registered query against its DuckDB oracle; print one line per key.

    python tests/run_parity.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from parity import compare, duck  # noqa: E402
from sessionmart.config import get_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_session("local[*]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name not in oracle:
                print(f"{name:28s} rows={df.count()} (no oracle)")
                continue
            r = compare(df, con, oracle[name])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r["cols_match"] and r["values_match"] and r["rows_spark"] == r["rows_oracle"]
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={r['rows_spark']}/{r['rows_oracle']} "
              f"{time.time() - t:5.1f}s" + ("" if ok else f" {r}"))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
