"""Readers: bar source (Parquet path or catalog table) and typed CSV seeds."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from sessionmart import schemas
from sessionmart.functions import to_utc_ntz
from sessionmart.sources.sinks import read_table


def conform_columns(df: DataFrame, target: StructType) -> list:
    """The projection that fixes names, order and types of ``df`` to ``target``."""
    cols = []
    for f in target.fields:
        src_type = df.schema[f.name].dataType
        if f.dataType.typeName().startswith("timestamp"):
            cols.append(to_utc_ntz(F.col(f.name), src_type).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return cols


def conform(df: DataFrame, target: StructType) -> DataFrame:
    """Fix names, order and types (ANSI casts: bad values fail loudly).

    Timestamps become the zone-less UTC wall clock; extra columns are dropped.
    """
    return df.select(*conform_columns(df, target))


def read_bars(spark: SparkSession, source: str | DataFrame,
              sessions: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """One bar relation, three spellings: a Parquet path/glob, a catalog table
    name (``db.table``), or an existing DataFrame.

    ``sessions=(first, last)`` restricts to ET sessions in that closed range.
    ``session_date`` is derived from the timestamp, so its predicate cannot reach
    the files; this adds the equivalent UTC predicate (an ET day d lies inside
    UTC days d and d+1) on the raw column -- and on ``utc_date`` when the source
    is partitioned by it -- so partition pruning and Parquet min/max skipping
    apply. The exact session filter is applied again after staging.
    """
    if isinstance(source, DataFrame):
        df = source
    else:
        df = read_table(spark, source)
    if sessions is not None:
        first, last = sessions
        lo = dt.datetime.combine(first, dt.time())
        hi = dt.datetime.combine(last + dt.timedelta(days=2), dt.time())
        ts = to_utc_ntz(F.col("timestamp"), df.schema["timestamp"].dataType)
        cond = (ts >= F.lit(lo).cast(TimestampNTZType())) & (ts < F.lit(hi).cast(TimestampNTZType()))
        if "utc_date" in df.columns:
            cond = cond & F.col("utc_date").between(F.lit(first), F.lit(last + dt.timedelta(days=1)))
        df = df.where(cond)
    return conform(df, schemas.BARS_NTZ)


def csv_by_header(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Text columns by name from a CSV file or all files of a folder, each by its own header.

    A reader of several files takes the first file's header for all; here files are grouped by their header line (the
    first of the file) and each group is read with it. A file without one of the columns fails; empty files count for nothing.
    """
    lines = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
             .where("at = 0").withColumn("line", F.monotonically_increasing_id()))
    groups = (lines.groupBy("file").agg(F.min_by("value", "line").alias("header"))
              .groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect())
    out = None
    for g in groups:
        one = spark.read.option("header", True).option("mode", "FAILFAST").csv([unquote(f) for f in g["files"]])
        absent = [c for c in columns if c.lower() not in (x.lower() for x in one.columns)]
        if absent:
            raise ValueError(f"no column {', '.join(absent)} in {g['files'][0]} (header: {g['header']})")
        one = one.select(*[F.col(f"`{c}`") for c in columns])
        out = one if out is None else out.union(one)
    return out if out is not None else spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))


def read_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Version-controlled CSV: columns by each file's header, cast to their declared types.

    The order of the columns is free and further columns are ignored; a missing column,
    a malformed row or a value that does not cast (ANSI) fails.
    """
    text = csv_by_header(spark, path, schema.names)
    return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def read_setups(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, schemas.SETUPS)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, schemas.RESULTS)
