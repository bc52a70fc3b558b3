"""Command line: build the layers, or ingest a bar cache.

    python -m sessionmart build  --bars PATH|db.table --setups CSV --results CSV
                                 [--out DIR | --namespace PREFIX] [--target dev|prod] [--chunk-bars N]
    python -m sessionmart ingest --cache 'DIR/*_1min_*.parquet' --results CSV --out DIR
                                 [--sample] [--first-file] [--expect-rows N] [--expect-symbols M]

``build`` writes every model and runs the 42 checks over what was written;
it exits 1 if any error-severity check fails. ``ingest`` reads the cache in
parallel, restricts it to the universe (every result symbol, or the frozen
sample; ``--results`` is any CSV with a ``symbol`` column), refuses daily-grain files,
loads the raw bars partitioned by UTC day (``OUT`` changes only if the count guard accepts the new rows), and
writes the list of symbols without bars to ``OUT_missing_symbols``. With ``--out db.table`` the namespace must exist.
"""

from __future__ import annotations

import argparse
import json
import sys

from sessionmart import schemas
from sessionmart.config import get_session, sizing
from sessionmart.plans import pipeline
from sessionmart.sources import ingest, readers, sinks


def _session(args):
    conf = sizing(args.input_bytes, args.cores) if args.input_bytes and args.cores else {}
    return get_session(master=args.master, extra=conf)


def _build(args) -> int:
    spark = _session(args)
    res = pipeline.run_pipeline(
        spark, readers.read_bars(spark, args.bars), readers.read_setups(spark, args.setups),
        readers.read_results(spark, args.results), out_dir=args.out, target=args.target,
        namespace_prefix=args.namespace, create_namespaces=args.create_namespaces, chunk_bars=args.chunk_bars, bars_table=args.bars if sinks.is_table(args.bars) else None)
    rows = res.checks.orderBy("model", "check_name").collect()
    for r in rows:
        print(f"{r['status']:5s} {r['violations']:>8d}  {r['model']:18s} {r['check_name']}")
    failed = sum(r["status"] == "fail" for r in rows)
    print(json.dumps({"tables": res.tables, "checks": len(rows), "failed": failed,
                      "warned": sum(r["status"] == "warn" for r in rows)}))
    return 1 if failed else 0


def _ingest(args) -> int:
    spark = _session(args)
    ingest.check_preconditions(spark, source_path=args.cache,
                               database=args.out.rpartition(".")[0] if sinks.is_table(args.out) else None)
    if args.sample:
        symbols = ingest.sample_universe(spark)
    else:
        symbols = ingest.universe_from_csv(spark, args.results)
    # Grain guard first (refuse before writing), on the narrow key pairs only.
    if args.first_file:
        chosen = ingest.restrict_to_universe(ingest.read_first_files(spark, args.cache, symbols), symbols)
        keys = chosen.select("symbol", "timestamp").distinct()
    else:
        chosen = ingest.read_bar_files(spark, args.cache, symbols)
        keys = ingest.restrict_to_universe(
            readers.conform(spark.read.parquet(args.cache), schemas.BARS_NTZ)
            .select("symbol", "timestamp").distinct(), symbols)
    ingest.grain_guard(keys)
    # One full pass: de-duplicate, restrict, write a partitioned staging copy, count-guard, publish.
    rows, n_symbols = ingest.load_raw(chosen, args.out, args.expect_rows, args.expect_symbols)
    # Report from what was written (column-pruned reads of the output).
    written = readers.read_bars(spark, args.out)
    report = ingest.ingest_report(symbols, written).first().asDict()
    # The whole list of symbols without a bar goes next to the output: a table beside a table, else CSV.
    missing = args.out.rstrip("/") + "_missing_symbols"
    absent = ingest.missing_symbols(symbols, written).orderBy("symbol")
    if sinks.is_table(args.out):
        sinks.write_table(absent, missing)
    else:
        absent.write.mode("overwrite").option("header", True).csv(missing)
    report["missing_list"] = missing
    report.update({"written_rows": rows, "written_symbols": n_symbols, "output": args.out})
    print(json.dumps(report))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sessionmart", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", help="default: the submitter's")
    p.add_argument("--input-bytes", type=int, help="with --cores: partition settings for this input size")
    p.add_argument("--cores", type=int)
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--bars", required=True)
    b.add_argument("--setups", required=True)
    b.add_argument("--results", required=True)
    b.add_argument("--out")
    b.add_argument("--namespace")
    b.add_argument("--create-namespaces", action="store_true", help="else they must exist")
    b.add_argument("--target", choices=("dev", "prod"), default="dev")
    b.add_argument("--chunk-bars", type=int, help="sessions of more bars are worked on in chunks")
    i = sub.add_parser("ingest")
    i.add_argument("--cache", required=True)
    i.add_argument("--results")
    i.add_argument("--out", required=True)
    i.add_argument("--sample", action="store_true")
    i.add_argument("--first-file", action="store_true", help="of several files of a symbol read the first by path only")
    i.add_argument("--expect-rows", type=int)
    i.add_argument("--expect-symbols", type=int)
    args = p.parse_args(argv)
    if args.cmd == "ingest" and not args.sample and not args.results:
        p.error("ingest needs --results (the universe) unless --sample is given")
    return _build(args) if args.cmd == "build" else _ingest(args)


if __name__ == "__main__":
    sys.exit(main())

