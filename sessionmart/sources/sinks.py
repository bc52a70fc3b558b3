"""Sinks: views, full-rebuild tables, partitioned + clustered tables, layers.

Tables are written as snappy Parquet. A write is a full rebuild for paths and
catalog tables alike: partitions that the new rows do not hold are gone. Only
``rebuild_partitions`` replaces a stated range and leaves the rest. ``publish`` lets a check
of the written rows decide whether they replace the live ones.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionmart.sources.files import Store

T = TypeVar("T")

LAYERS = ("raw", "staging", "intermediate", "marts")


def layer_names(prefix: str = "sessionmart") -> dict[str, str]:
    """One namespace per layer: ``<prefix>_raw`` ... ``<prefix>_marts``."""
    return {layer: f"{prefix}_{layer}" for layer in LAYERS}


def create_layers(spark: SparkSession, prefix: str = "sessionmart") -> dict[str, str]:
    names = layer_names(prefix)
    for db in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    return names


def write_view(df: DataFrame, name: str) -> DataFrame:
    """A lazy model: recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df


_TABLE_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*){1,2}")


def is_table(target: str) -> bool:
    """Whether ``target`` names a catalog table (``db.table``); else it is a path.

    The one rule for readers and sinks. A name without a dot is a path, and so is a file name ending in ``.parquet``.
    """
    return bool(_TABLE_NAME.fullmatch(target)) and not target.endswith(".parquet")


def write_table(df: DataFrame, target: str, mode: str = "overwrite") -> None:
    """A materialised model (full rebuild)."""
    w = df.write.mode(mode).format("parquet").option("compression", "snappy")
    if is_table(target):
        w.saveAsTable(target)
    else:
        w.save(target)


def write_partitioned(df: DataFrame, target: str, partition_col: str = "session_date",
                      cluster_by: Sequence[str] = ("symbol",), mode: str = "overwrite") -> None:
    """Partitioned by ``partition_col``, clustered (sorted) by ``cluster_by``.

    Rows are dealt by hash of the partition value and one of ``BUCKETS`` buckets of
    the first cluster column, then sorted: a partition value is spread over at most
    that many tasks and files (no hot day), each with its own symbols, and the input
    is not sampled first.
    """
    _partitioned(df, partition_col, cluster_by, mode, "static", target)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], sort_by: Sequence[str], buckets: int, path: str | None = None) -> None:
    """A catalog table whose files are dealt by hash of ``keys``, sorted inside by ``sort_by`` (full rebuild).

    Windows, aggregates and joins on these keys read it without an Exchange, again and again: the one shuffle is paid when it is
    written. Two tables with the same number of buckets join that way. ``keys`` should be as fine as the work on the table allows
    (a session, not a symbol), so that no bucket grows with one hot value. With ``path`` the table is external.
    """
    if not is_table(table):
        raise ValueError(f"only a catalog table keeps its buckets, got {table!r}")
    w = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("compression", "snappy")
         .bucketBy(buckets, *keys).sortBy(*sort_by))
    (w.option("path", path) if path else w).saveAsTable(table)


def publish(spark: SparkSession, target: str, write: Callable[[str], None], verify: Callable[[DataFrame], T]) -> T:
    """Write, verify, publish: ``target`` changes only if ``verify`` accepts the new rows.

    ``write`` gets the name of a staging table (or folder) beside ``target``, ``verify`` the rows read back from it. If either
    raises, the staging copy is dropped and ``target`` is as it was. Otherwise the copies are exchanged by renames,
    which are undone if one fails, and the old copy is dropped.
    """
    tag = uuid.uuid4().hex[:12]
    staged, old = f"{target.rstrip('/')}__staged_{tag}", f"{target.rstrip('/')}__replaced_{tag}"
    try:
        write(staged)
        result = verify(read_table(spark, staged))
    except Exception:
        _drop(spark, staged)
        raise
    if is_table(target):
        there = spark.catalog.tableExists(target)
        if there:
            _rename_table(spark, target, old)
        try:
            _rename_table(spark, staged, target)
        except Exception:
            if there:
                _rename_table(spark, old, target)
            raise
    else:
        store = Store(spark, target)
        there = store.exists(target)
        store.exchange(([(target, old)] if there else []) + [(staged, target)])
        spark.catalog.refreshByPath(target)
    if there:
        _drop(spark, old)
    return result


def _drop(spark: SparkSession, target: str) -> None:
    if is_table(target):
        spark.sql(f"DROP TABLE IF EXISTS {target}")
    else:
        Store(spark, target).delete(target)


def _rename_table(spark: SparkSession, table: str, new: str) -> None:
    """Rename; the places of the partitions are brought up to date at once, before another table takes the old name's folder."""
    spark.sql(f"ALTER TABLE {table} RENAME TO {new}")
    _list_partitions(spark, new)


def _list_partitions(spark: SparkSession, table: str) -> None:
    """Bring the catalog's list of a table's partitions in line with its folders, whose places or number have changed."""
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def location(spark: SparkSession, target: str) -> str:
    """The folder that holds the files of a path or catalog table."""
    if not is_table(target):
        return target
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").where(F.col("col_name") == "Location").select("data_type").take(1)
    return rows[0][0]


def rebuild_partitions(df: DataFrame, target: str, first: dt.date, last: dt.date, partition_col: str = "session_date",
                       cluster_by: Sequence[str] = ("symbol",)) -> None:
    """Replace the partitions from ``first`` to ``last`` (dates) by the rows of ``df`` in that range, in a path or catalog table.

    Partitions of the range that ``df`` no longer holds are emptied too, and no other day is touched. The new days are written beside
    the table first (``df`` may read the table itself); then the days change places by renames, all of them or none.
    """
    spark = df.sparkSession
    root, tag = location(spark, target).rstrip("/"), uuid.uuid4().hex[:12]
    staged, old = f"{root}/_staged_{tag}", f"{root}/_replaced_{tag}"  # such folders are no partitions to Spark
    store = Store(spark, root)
    try:
        _partitioned(df.where(F.col(partition_col).between(F.lit(first), F.lit(last))), partition_col, cluster_by, "overwrite", "static", staged)
        moves = []
        for k in range((last - first).days + 1):
            day = f"{partition_col}={first + dt.timedelta(days=k)}"
            if store.exists(f"{root}/{day}"):
                moves.append((f"{root}/{day}", f"{old}/{day}"))
            if store.exists(f"{staged}/{day}"):
                moves.append((f"{staged}/{day}", f"{root}/{day}"))
        store.exchange(moves)
    finally:
        store.delete(staged)
    store.delete(old)
    if is_table(target):
        _list_partitions(spark, target)
    else:
        spark.catalog.refreshByPath(root)


# Tasks and files that one partition value is spread over at most.
BUCKETS = 16


def _partitioned(df: DataFrame, partition_col: str, cluster_by: Sequence[str], mode: str, overwrite: str, target: str) -> None:
    bucket = F.pmod(F.xxhash64(cluster_by[0]), F.lit(BUCKETS))
    laid_out = df.repartition(F.col(partition_col), bucket).sortWithinPartitions(partition_col, *cluster_by)
    w = (laid_out.write.mode(mode).format("parquet").option("compression", "snappy")
         .option("partitionOverwriteMode", overwrite).partitionBy(partition_col))
    if is_table(target):
        w.saveAsTable(target)
    else:
        w.save(target)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    return spark.table(target) if is_table(target) else spark.read.parquet(target)
