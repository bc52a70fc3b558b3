"""Ingest: symbol universe, universe restriction, conformance, reports and guards.

The per-symbol file loop of a single-process loader becomes one distributed
job: read every bar file (glob) in parallel, semi-join to the universe,
conform to the fixed schema, report/guard, then write partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from sessionmart import params as P
from sessionmart import schemas
from sessionmart.operators.joins import semi_join
from sessionmart.sources import sinks
from sessionmart.sources.files import Store
from sessionmart.sources.readers import conform, conform_columns, csv_by_header


class IngestError(RuntimeError):
    """A precondition or guard failed. The message says what, if anything, was written."""


def universe(results: DataFrame) -> DataFrame:
    """Every symbol that produced a result row (kept distributed, not collected)."""
    return results.select("symbol").where(F.col("symbol").isNotNull()).distinct()


def sorted_universe(results: DataFrame) -> DataFrame:
    """The universe as a sorted list (ordering applied only for presentation)."""
    return universe(results).orderBy("symbol")


def sample_universe(spark: SparkSession, symbols=P.SAMPLE_SYMBOLS) -> DataFrame:
    """A frozen, reviewable symbol list (the development sample) as a relation."""
    return spark.createDataFrame([(s,) for s in symbols], "symbol string")


def read_bar_files(spark: SparkSession, pattern: str, symbols: DataFrame | None = None) -> DataFrame:
    """Read a bar cache written as many files (e.g. one per symbol) in parallel.

    Several files may hold the same bar. One copy per natural key
    (symbol, timestamp) is kept: the one from the first file by path, so the
    result never depends on listing order or on which task attempt ran. It is
    an aggregate, so even a huge group of copies collapses map-side. With
    ``symbols`` the bars are restricted to that universe before they are shuffled.
    """
    raw = spark.read.parquet(pattern)
    if symbols is not None:
        raw = restrict_to_universe(raw.withColumn("_file", F.input_file_name()), symbols)
    else:
        raw = raw.withColumn("_file", F.input_file_name())
    df = raw.select(*conform_columns(raw, schemas.BARS_NTZ), "_file")
    values = [c for c in schemas.BARS_NTZ.names if c not in ("symbol", "timestamp")]
    one = df.groupBy("symbol", "timestamp").agg(
        F.min_by(F.struct(*values), F.col("_file")).alias("b"))
    return one.select("timestamp", *[F.col(f"b.{c}").alias(c) for c in values], "symbol")


#: Name of a bar file (or folder of part files): the symbol stands before the mark.
BAR_FILE = r"^(.*/(?:[^/=]+=)?([^/=]+)_1min_[^/]*\.parquet)(?:/|$)"


def first_files(spark: SparkSession, pattern: str, symbols: DataFrame | None = None) -> DataFrame:
    """The first bar file by path of each symbol (symbol, path), by file names alone: no bar is read."""
    listed = spark.read.format("binaryFile").load(pattern).select("path")  # without their content
    files = listed.select(F.regexp_extract("path", BAR_FILE, 2).alias("symbol"), F.regexp_extract("path", BAR_FILE, 1).alias("path"))
    first = files.where(F.col("symbol") != "").groupBy("symbol").agg(F.min("path").alias("path"))
    return first if symbols is None else semi_join(first, symbols, "symbol")


def read_first_files(spark: SparkSession, pattern: str, symbols: DataFrame | None = None) -> DataFrame:
    """Bars of one file a symbol, the first by path; the other files of the cache are not opened.

    The chosen paths pass through the driver, as any list of files to read does.
    """
    paths = [r["path"] for r in first_files(spark, pattern, symbols).collect()]
    if not paths:
        return spark.createDataFrame([], schemas.BARS_NTZ)
    return conform(spark.read.parquet(*sorted(paths)), schemas.BARS_NTZ)


def restrict_to_universe(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """Bars of universe symbols only (semi join)."""
    return semi_join(bars, symbols, "symbol")


def universe_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """The universe of any CSV with a header that has a ``symbol`` column."""
    return universe(csv_by_header(spark, path, ["symbol"]))


def missing_symbols(symbols: DataFrame, bars: DataFrame) -> DataFrame:
    """Universe symbols without a single bar."""
    present = bars.select("symbol").distinct()
    return symbols.select("symbol").join(present, "symbol", "left_anti")


def ingest_report(symbols: DataFrame, bars: DataFrame) -> DataFrame:
    """One row: universe size, resolved / missing symbols, rows, est. logical bytes.

    ``bars`` is the universe-restricted relation. Computed as two aggregates
    combined through a one-key join, no driver-side arithmetic.
    """
    per_symbol = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    u = symbols.select("symbol").join(per_symbol, "symbol", "left")
    return u.agg(
        F.count(F.lit(1)).alias("symbols_total"),
        F.count("n").alias("symbols_resolved"),
        F.sum(F.when(F.col("n").isNull(), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
        .alias("symbols_missing"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
    ).withColumn("est_logical_bytes", F.col("rows") * F.lit(P.EST_BYTES_PER_ROW))


def count_guard(bars: DataFrame, expected_rows: int | None = None,
                expected_symbols: int | None = None) -> tuple[int, int]:
    """Row/symbol count after a load; raise on mismatch with the expectation."""
    r = bars.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_distinct("symbol").alias("symbols")).first()
    if expected_rows is not None and r["rows"] != expected_rows:
        raise IngestError(f"expected {expected_rows:,} rows, got {r['rows']:,}; nothing was published")
    if expected_symbols is not None and r["symbols"] != expected_symbols:
        raise IngestError(f"expected {expected_symbols} symbols, got {r['symbols']}; nothing was published")
    return r["rows"], r["symbols"]


def _gap_seconds(a, b):
    return F.timestamp_diff("SECOND", a, b)


def bar_grain(bars: DataFrame) -> DataFrame:
    """Per symbol: bar count and modal gap (seconds) between consecutive bars.

    Files labelled as minute bars may hold daily bars; the modal gap tells
    them apart (>= 86,400 s means daily). Computed without a per-symbol
    window over all of a symbol's rows:

    * gaps inside a UTC day: lag over (symbol, utc_date) -- bounded partitions;
    * gaps across days: one row per (symbol, day) with first/last bar, lag over
      symbol on that day-level table (at most one row per calendar day).

    The modal gap is the most frequent gap, ties to the smaller gap.
    """
    b = bars.select("symbol", F.col("timestamp").cast(TimestampNTZType()).alias("ts")) \
        .where(F.col("symbol").isNotNull() & F.col("ts").isNotNull()) \
        .withColumn("utc_date", F.to_date("ts"))
    w_day = Window.partitionBy("symbol", "utc_date").orderBy("ts")
    intra = (b.withColumn("prev", F.lag("ts").over(w_day))
             .where(F.col("prev").isNotNull())
             .select("symbol", _gap_seconds(F.col("prev"), F.col("ts")).alias("gap")))
    days = b.groupBy("symbol", "utc_date").agg(F.min("ts").alias("first_ts"),
                                               F.max("ts").alias("last_ts"),
                                               F.count(F.lit(1)).alias("n"))
    w_sym = Window.partitionBy("symbol").orderBy("utc_date")
    inter = (days.withColumn("prev_last", F.lag("last_ts").over(w_sym))
             .where(F.col("prev_last").isNotNull())
             .select("symbol", _gap_seconds(F.col("prev_last"), F.col("first_ts")).alias("gap")))
    counts = (intra.unionByName(inter).groupBy("symbol", "gap")
              .agg(F.count(F.lit(1)).alias("c")).withColumn("n", F.lit(None).cast("bigint")))
    sizes = days.select("symbol", F.lit(None).cast("bigint").alias("gap"),
                        F.lit(None).cast("bigint").alias("c"), "n")
    # one per-symbol aggregate gives both the modal gap and the bar count
    per_symbol = counts.unionByName(sizes).groupBy("symbol").agg(
        F.sum("n").cast("bigint").alias("bars"),
        F.max(F.when(F.col("c").isNotNull(),
                     F.struct(F.col("c"), (-F.col("gap")).alias("neg_gap")))).alias("m"))
    out = per_symbol.select("symbol", "bars",
                            (-F.col("m.neg_gap")).cast("bigint").alias("modal_gap_seconds"))
    return out.withColumn(
        "is_daily_grain",
        F.coalesce(F.col("modal_gap_seconds") >= F.lit(P.DAILY_GAP_SECONDS), F.lit(False)))


def grain_guard(bars: DataFrame) -> None:
    """Refuse to continue when any symbol's bars look daily."""
    bad = bar_grain(bars).where(F.col("is_daily_grain")).orderBy("symbol")
    n = bad.count()
    if n:
        shown = [r["symbol"] for r in bad.select("symbol").take(20)]
        more = f" and {n - len(shown)} more" if n > len(shown) else ""
        raise IngestError(f"daily-grain bars in a minute-bar source, {n} symbols: {', '.join(shown)}{more}; nothing was written")


def check_preconditions(spark: SparkSession, source_path: str | None = None,
                        database: str | None = None) -> None:
    """Fail before writing: the source must exist, the target namespace too."""
    if source_path is not None:
        store = Store(spark, source_path)
        if not store.exists(source_path) and not store.matches(source_path):
            raise IngestError(f"source not found: {source_path}")
    if database is not None and not spark.catalog.databaseExists(database):
        raise IngestError(f"namespace {database!r} does not exist; create it first")


def load_raw(bars: DataFrame, target: str, expected_rows: int | None = None,
             expected_symbols: int | None = None) -> tuple[int, int]:
    """Load raw bars as the vendor sent them: partitioned by UTC day, clustered
    by symbol, snappy Parquet (a full rebuild: days not in ``bars`` go). The rows go to a
    staging copy, whose row/symbol counts are verified, and then replace ``target`` in one
    switch. A mismatch raises, and ``target`` stays as it was."""
    dated = conform(bars, schemas.BARS_NTZ).withColumn("utc_date", F.to_date("timestamp"))
    return sinks.publish(
        bars.sparkSession, target,
        write=lambda t: sinks.write_partitioned(dated, t, partition_col="utc_date", cluster_by=("symbol", "timestamp")),
        verify=lambda df: count_guard(df, expected_rows, expected_symbols))


