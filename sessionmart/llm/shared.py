"""Written intermediate tables in the cluster's shared folder, and connected components over edges."""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import shared_dir


def parts_of(spark: SparkSession, factor: int = 2) -> int:
    """Number of key ranges for an exchange: a few for each shuffle partition, so it follows the input's size."""
    return factor * int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names are compared without case)."""
    taken, name = {c.lower() for c in df.columns}, f"{base}_"
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors.

    The collection before it lets Spark's cleaner drop the shuffle files of earlier steps
    that no live plan needs any more.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    df.write.parquet(path)
    return spark.read.parquet(path)


def _digest(e: DataFrame) -> tuple:
    """Count and two order-free sums of hashes of the edges: equal for equal edge sets."""
    h = F.xxhash64("a", "b")
    return tuple(e.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (a, b): columns node, root.

    Alternates two contractions until nothing changes: every node hands its larger
    neighbours, and then its smaller ones, to its smallest neighbour. The number of rounds
    grows with the logarithm of the component size. A hub's neighbours are never
    gathered: the minimum is a partial aggregate, the rest a join on the node.
    """
    e = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .where("a <> b").distinct(), "edges")
    now = _digest(e)
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("v", "w")
        low = both.groupBy("v").agg(F.least(F.min("w"), F.first("v")).alias("m"))
        large = (both.where("w > v").join(low, "v").where("w <> m")
                 .select(F.col("m").alias("a"), F.col("w").alias("b")).distinct())
        low = large.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("m"))
        small = large.select(F.col("b").alias("v"), F.col("a").alias("w")).join(low, "v")
        step = written(small.select(F.col("m").alias("a"), F.col("w").alias("b")).where("a <> b")
                       .union(low.select(F.col("m").alias("a"), F.col("v").alias("b")))
                       .distinct(), "edges")
        before, now, e = now, _digest(step), step
        if before == now:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
            .union(e.select("a", "a").distinct().toDF("node", "root")))
