"""Running and rolling windows over sessions of any length, by chunks.

The plain windows (``operators.windows``) hold one session in one task, which is right for minute bars (1,440 rows at
most). A source with many more bars a session (ticks, second bars) would make one task carry each of them. Here sessions
of more than ``chunk_bars`` bars are cut by time into at most ``PIECES`` chunks:

* ``LongSessions.find`` counts the bars of every session (partial aggregates) and takes the cuts of the long ones
  from a quantile sketch. Cuts are written once, so every later pass sees the same chunks.
* Running figures are a prefix scan: totals of each chunk, a scan over the totals of a session (at most ``PIECES`` rows), and
  local running values that start from the scan's value. The windows run by (session, chunk).
* A rolling figure over the last n bars needs the n - 1 bars before a chunk: these are handed over as a halo, however
  many chunks they come from, and dropped again behind the window.

Sessions that are not long are one chunk, so all bars take the same single Exchange. The tables of cuts and totals hold
rows of long sessions only, each standing for ``chunk_bars`` bars or more; they are read back from files, so Spark broadcasts them
only while their measured size allows. Bars of equal time stay in one chunk.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionmart.config import scratch_path
from sessionmart.operators.windows import BAR_ORDER, SESSION_KEYS

PIECES = 256
CHUNK = "session_chunk"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _with(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str) -> DataFrame:
    """Join on ``keys``, missing values equal to each other; the keys of ``left`` stay."""
    renamed = right.withColumnsRenamed({k: f"{k}__r" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"{k}__r"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"{k}__r" for k in keys])


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


@dataclass(frozen=True)
class LongSessions:
    """Cuts of the long sessions: symbol, session_date, cuts (ascending times in microseconds, fewer than ``pieces``)."""

    cuts: DataFrame
    pieces: int = PIECES

    @classmethod
    def find(cls, bars: DataFrame, chunk_bars: int, pieces: int = PIECES) -> LongSessions:
        """Sessions of ``bars`` with more than ``chunk_bars`` rows, cut into chunks of about that size (``pieces`` at most)."""
        size = _written(bars.groupBy(*SESSION_KEYS).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk_bars), "long-sessions")
        shares = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
        marks = (_with(bars.select(*SESSION_KEYS, _micros(BAR_ORDER).alias("at")), size, SESSION_KEYS, "inner")
                 .groupBy(*SESSION_KEYS, "n").agg(F.percentile_approx("at", shares, F.lit(100 * pieces)).alias("marks")))
        # of all marks, every k-th: as many as give chunks of about chunk_bars bars
        every = F.greatest(F.lit(1), F.floor(F.lit(pieces) * chunk_bars / F.col("n"))).cast("int")
        cuts = F.array_distinct(F.filter("marks", lambda m, i: (i + 1) % every == 0))
        return cls(_written(marks.select(*SESSION_KEYS, cuts.alias("cuts")), "session-cuts"), pieces)

    def tag(self, bars: DataFrame) -> DataFrame:
        """``bars`` with their chunk (from 0 on; null: not a long session)."""
        # the number of cuts up to the bar's time, by binary search: comparisons grow with the logarithm of the cuts
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(self.pieces.bit_length()))])
        chunk = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get("cuts", n + step - 1) <= _micros(BAR_ORDER), n + step).otherwise(n))
        return _with(bars, self.cuts, SESSION_KEYS, "left").withColumn(CHUNK, F.when(F.col("cuts").isNotNull(), chunk)).drop("cuts")

    def running(self, bars: DataFrame, figures: Mapping[str, tuple[str, Column | str]]) -> DataFrame:
        """``bars`` with running figures of their sessions; ``figures``: name -> (``sum``, ``max`` or ``first``, value)."""
        keys = (*SESSION_KEYS, CHUNK)
        values = {name: F.col(v) if isinstance(v, str) else v for name, (_, v) in figures.items()}
        total = {"sum": F.sum, "max": F.max, "first": lambda v: F.min_by(v, F.col(BAR_ORDER))}
        tagged = self.tag(bars)
        per_chunk = (tagged.where(F.col(CHUNK).isNotNull()).groupBy(*keys)
                     .agg(*[total[kind](values[name]).alias(name) for name, (kind, _) in figures.items()]))
        before = Window.partitionBy(*SESSION_KEYS).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        scan = {"sum": F.sum, "max": F.max, "first": F.first}
        offset = _written(per_chunk.select(*keys, *[scan[kind](name).over(before).alias(f"{name}__before")
                                                    for name, (kind, _) in figures.items()]).where(F.col(CHUNK) > 0), "chunk-offsets")
        own = Window.partitionBy(*keys).orderBy(BAR_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = _with(tagged, offset, keys, "left")
        later = F.coalesce(F.col(CHUNK), F.lit(0)) > 0
        for name, (kind, _) in figures.items():
            here, past = scan[kind](values[name]).over(own), F.col(f"{name}__before")
            out = out.withColumn(name, {
                "sum": F.when(past.isNull(), here).otherwise(past + F.coalesce(here, F.lit(0))),
                "max": F.greatest(here, past), "first": F.when(later, past).otherwise(here)}[kind])
        return out.drop(CHUNK, *[f"{name}__before" for name in figures])

    def trailing_max(self, bars: DataFrame, name: str, value: str, n: int) -> DataFrame:
        """``bars`` with the largest ``value`` of the last ``n`` bars of the session, the current one included."""
        keys = (*SESSION_KEYS, CHUNK)
        tagged = self.tag(bars)
        last = Window.partitionBy(*keys).orderBy(F.col(BAR_ORDER).desc())
        tails = (tagged.where(F.col(CHUNK).isNotNull()).select(*keys, BAR_ORDER, value)
                 .withColumn("back", F.row_number().over(last)).where(F.col("back") < n)
                 .groupBy(*SESSION_KEYS).agg(F.sort_array(F.collect_list(F.struct(CHUNK, (-F.col("back")).alias("at"), BAR_ORDER, value))).alias("tails"),
                                             F.max(CHUNK).alias("most")))  # at most PIECES * (n - 1) entries
        halo = (_written(tails, "chunk-tails").withColumn("to", F.explode(F.sequence(F.lit(1), F.greatest("most", F.lit(1)))))
                .withColumn("tails", F.filter("tails", lambda t: t[CHUNK] < F.col("to")))
                .withColumn("b", F.explode(F.slice("tails", F.greatest(F.lit(1), F.size("tails") - (n - 2)), n - 1)))
                .select(*SESSION_KEYS, F.col("to").cast("int").alias(CHUNK), F.col(f"b.{BAR_ORDER}").alias(BAR_ORDER),
                        F.col(f"b.{value}").alias(value), F.lit(True).alias("is_halo")))
        own = Window.partitionBy(*keys).orderBy(BAR_ORDER).rowsBetween(-(n - 1), Window.currentRow)
        both = tagged.withColumn("is_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
        return (both.withColumn(name, F.max(value).over(own)).where(~F.col("is_halo")).drop(CHUNK, "is_halo"))
