"""Sharding: documents into shards of near equal bytes by a minimax contiguous partition.

Documents with equal texts form one atomic group; groups are ordered by the
64-bit hash of their text. The smallest capacity for which the ordered groups
fit into the shards is found by binary search, with a greedy check of each capacity, and the
groups are cut there.

The groups themselves never come to the driver. It gets the sums of ranges of
the hash ("cells", 65,536 at first). With each range taken as atomic the search
gives a capacity that is surely enough; with ranges of several groups taken as
divisible, one that is surely needed. While the two differ, the ranges in
which a cut can fall are split 256-fold by one more aggregate, so the
driver holds a bounded number of sums whatever the number of documents.

Null text: no bytes, grouped with the empty text. Null ``doc_id``: kept as null. Repeated rows each get a slot.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import parts_of, written

_TOP = 16
_STEP = 8


class Cells:
    """Ordered ranges of the hash: (lowest hash, bits, sum, whether one group alone)."""

    def __init__(self, rows: list[tuple[int, int, int, bool]]) -> None:
        self.rows = sorted(rows)
        self.sums = [0, *accumulate(r[2] for r in self.rows)]
        self.total = self.sums[-1]

    def whole(self, cap: int, at: int = 0) -> list[int] | None:
        """Greedy cuts (cell indices) with cells atomic; None if a cell exceeds ``cap``."""
        cuts = []
        while at < len(self.rows):
            nxt = bisect_right(self.sums, self.sums[at] + cap) - 1
            if nxt == at:
                return None
            cuts.append(at := nxt)
        return cuts

    def loose(self, cap: int) -> list[int] | None:
        """Greedy cuts (amounts) with cells of several groups divisible; None if one group exceeds ``cap``."""
        cuts, amount = [], 0
        while amount < self.total:
            end = amount + cap
            if end < self.total:
                i = bisect_right(self.sums, end) - 1
                if self.sums[i] < end and self.rows[i][3]:
                    end = self.sums[i]
            end = min(end, self.total)
            if end <= amount:
                return None
            cuts.append(amount := end)
        return cuts

    def least(self, check, shards: int) -> int:
        """Smallest capacity that ``check`` fits into the shards."""
        lo, hi = max(1, -(-self.total // shards)), max(1, self.total)
        while lo < hi:
            mid = (lo + hi) // 2
            cuts = check(mid)
            if cuts is not None and len(cuts) <= shards:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def open_cells(self, low: int, high: int, shards: int) -> list[int]:
        """Cells of several groups in which a cut can fall for a capacity from ``low`` to ``high``."""
        early, amount = [], 0  # the earliest places: cuts before a cell that would be divided
        for _ in range(shards):
            i = bisect_right(self.sums, amount + low) - 1
            early.append(min(i, len(self.rows)))
            amount = self.sums[early[-1]]
        late = self.loose(high) or [self.total]
        found = set()
        for j in range(shards):
            end = late[min(j, len(late) - 1)]
            stop = bisect_left(self.sums, end)
            found.update(i for i in range(early[j], min(stop + 1, len(self.rows))) if not self.rows[i][3])
        if not found:  # then the largest one keeps the bounds apart
            found = {max((i for i, r in enumerate(self.rows) if not r[3]), key=lambda i: self.rows[i][2])}
        return sorted(found)


def _even_cuts(cells: Cells, cap: int, shards: int) -> list[int]:
    """Cell indices where shards 1, 2, ... start: near the even share, none over ``cap``."""
    at, cuts = 0, []
    for left in range(shards, 1, -1):
        most = bisect_right(cells.sums, cells.sums[at] + cap) - 1
        aim = cells.sums[at] + (cells.total - cells.sums[at]) / left
        nxt = min(bisect_left(cells.sums, aim), most)
        if nxt > at and abs(cells.sums[nxt - 1] - aim) < abs(cells.sums[nxt] - aim):
            nxt -= 1
        while nxt < most and len(cells.whole(cap, nxt) or [0] * (shards + 1)) > left - 1:
            nxt += 1
        cuts.append(at := nxt)
    return cuts


def _cells(rows: DataFrame, bits: int) -> list[tuple[int, int, int, bool]]:
    """Sums by the leading ``bits`` of the group hash."""
    cell = F.shiftright("key", 64 - bits)
    got = rows.groupBy(cell.alias("cell")).agg(F.sum("size").alias("size"), (F.min("key") == F.max("key")).alias("one"))
    return [(r["cell"] << (64 - bits), bits, r["size"], r["one"]) for r in got.collect()]


def boundaries(rows: DataFrame, shards: int) -> tuple[list[int], int]:
    """Lowest hash of shards 1, 2, ... and the capacity found. ``rows``: key, size."""
    cells = Cells(_cells(rows, _TOP))
    while True:
        low, high = cells.least(cells.loose, shards), cells.least(cells.whole, shards)
        if low == high or all(r[3] for r in cells.rows):
            break
        split = cells.open_cells(low, high, shards)
        chosen = {i: cells.rows[i] for i in split}
        keep = [r for i, r in enumerate(cells.rows) if i not in chosen]
        for bits in {r[1] for r in chosen.values()}:
            lows = [r[0] >> (64 - bits) for r in chosen.values() if r[1] == bits]
            keep += _cells(rows.where(F.shiftright("key", 64 - bits).isin(lows)), bits + _STEP)
        cells = Cells(keep)
    cuts = _even_cuts(cells, high, shards)
    top = (1 << 63) - 1
    return [cells.rows[i][0] if i < len(cells.rows) else top for i in cuts], high


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, shard, slot, capacity.

    ``size``: UTF-8 bytes of the text plus 1. ``slot`` counts from 0 without gaps in each shard.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                               (F.octet_length(text) + 1).cast("long").alias("size"),
                               F.crc32(text.cast("binary")).alias("text_crc32"),
                               F.xxhash64(text).alias("key")), "sizes")
    lows, capacity = boundaries(rows, shards)
    place = F.lit(0)
    for low in lows:
        place = place + F.when((F.col("key") >= F.lit(low)) & F.lit(low < (1 << 63) - 1), 1).otherwise(0)
    salt = F.pmod(F.xxhash64("doc_id", "key"), F.lit(parts_of(spark))).cast("int")
    placed = rows.select("*", place.cast("int").alias("shard"), salt.alias("salt"))
    counts = placed.groupBy("shard", "salt").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("shard", "salt", F.coalesce(before, F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("doc_id", "key"))
    return (placed.withColumn("rank", rank).join(base, ["shard", "salt"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - 1).alias("slot"),
                    F.lit(capacity).cast("long").alias("capacity")))


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> DataFrame:
    """Write ``docs`` to ``path``, one folder a shard (``shard=N``); returns the placement.

    Rows go to their folders by the text's hash; the files of a folder follow Spark's partitions.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn("_key", F.xxhash64(text))
    lows, _ = boundaries(keyed.select(F.col("_key").alias("key"), (F.octet_length(text) + 1).cast("long").alias("size")), shards)
    place = F.lit(0)
    for low in lows:
        place = place + F.when((F.col("_key") >= F.lit(low)) & F.lit(low < (1 << 63) - 1), 1).otherwise(0)
    keyed.withColumn("shard", place).drop("_key").write.partitionBy("shard").parquet(path)
    return shard(docs, shards)
