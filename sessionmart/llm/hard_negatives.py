"""Hard-negative mining: exact integer scores by a residue number system, then windowed selection.

Components become integers ``floor(scale * x)``. A block of anchors is scored against all rows by
matrix products of the components' residues modulo several small primes: centred residues
are at most 125 in size, so float32 sums of 128 products are exact integers, whatever order the
library adds them in. The residues of a score give its digits in the mixed radix of the primes (Chinese
remaindering), with signs, as the digits are centred too. The primes are as many as the largest possible score
needs (squared length of the longest vector, by Cauchy-Schwarz), so every score is exact.

An anchor's positives are its first other rows of the same label: highest score, then smallest id. A
positive's negatives are the first rows of other labels whose score lies between ``low`` and ``high``
percent of the positive's.

Anchors are the stated query side. They are read in blocks of about ``block_values`` components, so what a task
holds of them is bounded whatever their number; each block reads the rows twice (positives, then negatives).
A task keeps the best few rows of each anchor or window, so it sends on a number of rows that
does not depend on how many it read: no group of copies or label is gathered anywhere.

Null labels, null vectors and vectors with a null or non-finite component take no part. Vectors of different lengths:
missing components count as 0; an empty vector scores 0 with all. A null id counts as the largest. Repeated rows are rows of
their own: each anchor row gives its own results, and copies of an anchor can be its positives. Scores beyond 61 bits
raise an error before any work.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import shared_dir

PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
BLOCK_VALUES = 1 << 20
_INNER = 128  # products summed in float32 at once: 128 * 125**2 is far below 2**24
_TILE, _CHUNK = 256, 2048  # anchors and rows of one score table
_LAST = (1 << 63) - 1
_NONE = -(1 << 62) - 1  # below every score


def primes_for(bound: float) -> tuple[int, ...]:
    """The first primes whose product exceeds all signed scores of at most ``bound`` in size."""
    product = 1
    for k, p in enumerate(PRIMES):
        product *= p
        if product > 2 * bound + 1:
            return PRIMES[:k + 1]
    raise ValueError(f"scores up to {bound:.3g} do not fit 61 bits; use a smaller scale")


def _centre(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo ``p``, from -(p - 1) / 2 to (p - 1) / 2, in place; exact for float32 integers below 2**21."""
    q = np.rint(x * x.dtype.type(1 / p))
    q *= x.dtype.type(p)
    x -= q
    return x


class Vectors:
    """Residues of integer vectors for each prime; vectors of one length stand together."""

    def __init__(self, vectors: list[np.ndarray], primes: tuple[int, ...], scale: float) -> None:
        self.n, self.groups = len(vectors), []
        size = np.array([len(v) for v in vectors], np.int64)
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            q = np.floor(np.stack([vectors[i] for i in at]).astype(np.float64) * scale)
            self.groups.append((at, [(q - p * np.rint(q / p)).astype(np.float32) for p in primes]))

    def take(self, rows: np.ndarray) -> Vectors:
        """Those of ``rows`` (ascending)."""
        out = object.__new__(Vectors)
        out.n, out.groups = len(rows), []
        for at, res in self.groups:
            new = np.flatnonzero(np.isin(rows, at))
            if len(new):
                old = np.searchsorted(at, rows[new])
                out.groups.append((new, [r[old] for r in res]))
        return out


def _products(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...], kind) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``, given by their residues."""
    width, digits = min(a[0].shape[1], b[0].shape[1]), []
    for i, p in enumerate(primes):
        r = np.zeros((len(a[0]), len(b[0])), np.float32)
        for k in range(0, width, _INNER):
            r += a[i][:, k:min(k + _INNER, width)] @ b[i][:, k:min(k + _INNER, width)].T
            _centre(r, p)
        for d, before in zip(digits, primes):
            inverse = pow(before, -1, p)
            r -= d
            r *= np.float32(inverse if 2 * inverse < p else inverse - p)
            _centre(r, p)
        digits.append(r)
    out = digits[-1].astype(kind)
    for d, p in zip(digits[-2::-1], primes[-2::-1]):
        out *= kind(p)
        out += d.astype(kind)
    return out


def scores(a: Vectors, b: Vectors, primes: tuple[int, ...]) -> np.ndarray:
    """Exact inner products of all of ``a`` (rows) with all of ``b`` (columns)."""
    kind = np.int32 if np.prod([float(p) for p in primes]) < 2**31 else np.int64
    if len(a.groups) == len(b.groups) == 1:
        return _products(a.groups[0][1], b.groups[0][1], primes, kind)
    out = np.zeros((a.n, b.n), kind)
    for i, x in a.groups:
        for j, y in b.groups:
            out[np.ix_(i, j)] = _products(x, y, primes, kind)
    return out


class Best:
    """The best ``width`` candidates of each line: highest score, then smallest id."""

    def __init__(self, lines: int, width: int) -> None:
        self.width = width
        self.score = np.full((lines, width), _NONE, np.int64)
        self.id, self.hash = np.full((lines, width), _LAST, np.int64), np.zeros((lines, width), np.int64)

    def least(self, lines: np.ndarray) -> np.ndarray:
        """Scores below this can no longer enter."""
        return self.score[lines, -1]

    def thinned(self, table: np.ndarray, may: np.ndarray) -> np.ndarray:
        """``may`` without entries that ``width`` others of the same line surpass."""
        n = table.shape[1]
        if n > self.width and np.count_nonzero(may) > 16 * self.width * len(table):
            shown = np.where(may, table, np.iinfo(table.dtype).min)
            may &= table >= np.partition(shown, n - self.width, axis=1)[:, n - self.width, None]
        return may

    def add(self, line, score, id_, hash_) -> None:
        if not len(line):
            return
        some, w = np.unique(line), self.width
        at = np.concatenate((np.repeat(some, w), line))
        score, id_, hash_ = (np.concatenate((old[some].ravel(), new))
                             for old, new in ((self.score, score), (self.id, id_), (self.hash, hash_)))
        order = np.lexsort((hash_, id_, -score, at))
        at = at[order]
        first = np.searchsorted(at, some)
        keep = (first[:, None] + np.arange(w)).ravel()
        for mine, new in ((self.score, score), (self.id, id_), (self.hash, hash_)):
            mine[some] = new[order][keep].reshape(-1, w)

    def found(self) -> tuple[np.ndarray, ...]:
        """Line, score, id and hash of all that is held."""
        line, k = np.nonzero(self.score > _NONE)
        return line, self.score[line, k], self.id[line, k], self.hash[line, k]


class Anchors:
    """A block of anchor rows in order of their labels."""

    def __init__(self, rows: pd.DataFrame, primes: tuple[int, ...], scale: float) -> None:
        rows = rows.sort_values(["label", "id", "hash"], kind="stable")
        self.id, self.hash, self.label = (rows[c].to_numpy(np.int64) for c in ("id", "hash", "label"))
        self.vectors = Vectors([np.asarray(v) for v in rows["vector"]], primes, scale)
        self.primes, self.scale = primes, scale

    def tiles(self, lo: int = 0, hi: int | None = None) -> Iterator[tuple[np.ndarray, Vectors]]:
        for k in range(lo, len(self.id) if hi is None else hi, _TILE):
            rows = np.arange(k, min(k + _TILE, len(self.id) if hi is None else hi))
            yield rows, self.vectors.take(rows)

    def chunks(self, batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """Rows to score: ids (ascending), hashes, labels, vectors."""
        for pdf in batches:
            for k in range(0, len(pdf), _CHUNK):
                part = pdf.iloc[k:k + _CHUNK].sort_values(["id", "hash"], kind="stable")
                yield (*(part[c].to_numpy(np.int64) for c in ("id", "hash", "label")),
                       Vectors([np.asarray(v) for v in part["vector"]], self.primes, self.scale))


def _frame(line, score, id_, hash_) -> pd.DataFrame:
    return pd.DataFrame({"line": line.astype(np.int64), "score": score, "id": id_, "hash": hash_})


def _same_label(anchors: Anchors, width: int):
    """Per task: the best ``width`` rows of each anchor's own label."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(len(anchors.id), width)
        for id_, hash_, label, vectors in anchors.chunks(batches):
            for x in np.unique(label):
                lo, hi = np.searchsorted(anchors.label, x), np.searchsorted(anchors.label, x, "right")
                if lo == hi:
                    continue
                rows = np.flatnonzero(label == x)
                own = vectors.take(rows)
                for at, tile in anchors.tiles(lo, hi):
                    table = scores(tile, own, anchors.primes)
                    i, j = np.nonzero(best.thinned(table, table >= best.least(at)[:, None]))
                    best.add(at[i], table[i, j].astype(np.int64), id_[rows[j]], hash_[rows[j]])
        yield _frame(*best.found())
    return run


def _windows(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest negative score of each positive score; none where there is no positive."""
    lo = np.array([-(-low * int(s) // 100) if s > _NONE else 1 for s in positive.ravel()], np.int64)
    hi = np.array([high * int(s) // 100 if s > _NONE else 0 for s in positive.ravel()], np.int64)
    return lo.reshape(positive.shape), hi.reshape(positive.shape)


def _other_labels(anchors: Anchors, positive: Best, low: int, high: int, width: int):
    """Per task: the best ``width`` rows of other labels in the window of each positive."""
    each = positive.width
    lo, hi = _windows(positive.score, low, high)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(len(anchors.id) * each, width)
        for id_, hash_, label, vectors in anchors.chunks(batches):
            for at, tile in anchors.tiles():
                table = scores(tile, vectors, anchors.primes)
                other = anchors.label[at][:, None] != label[None, :]
                edge = np.iinfo(table.dtype)
                for k in range(each):
                    line = at * each + k
                    least = np.clip(np.maximum(lo[at, k], best.least(line)), edge.min + 1, edge.max)
                    most = np.clip(hi[at, k], edge.min + 1, edge.max)
                    if not (least <= most).any():
                        continue
                    may = (table >= least.astype(table.dtype)[:, None]) & (table <= most.astype(table.dtype)[:, None]) & other
                    i, j = np.nonzero(best.thinned(table, may))
                    best.add(line[i], table[i, j].astype(np.int64), id_[j], hash_[j])
        yield _frame(*best.found())
    return run


_FOUND = "line long, score long, id long, hash long"


def _first(found: DataFrame, width: int) -> DataFrame:
    """The best ``width`` rows of each line over all tasks, with their rank."""
    order = Window.partitionBy("line").orderBy(F.desc("score"), "id", "hash")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= width)


def _positives(rows: DataFrame, anchors: Anchors, width: int) -> Best:
    """The positives of a block: the best rows of the same label but the anchor row itself."""
    got = _first(rows.mapInPandas(_same_label(anchors, width + 1), _FOUND), width + 1).drop("rank").toPandas()
    more = Best(len(anchors.id), width + 1)
    more.add(*(got[c].to_numpy(np.int64) for c in ("line", "score", "id", "hash")))
    itself = (more.id == anchors.id[:, None]) & (more.hash == anchors.hash[:, None]) & (more.score > _NONE)
    itself &= np.cumsum(itself, axis=1) == 1  # of equal rows, one is the anchor
    itself[~itself.any(axis=1), -1] = True  # otherwise the last one is over the number
    out = Best(len(anchors.id), width)
    for c in ("score", "id", "hash"):
        setattr(out, c, getattr(more, c)[~itself].reshape(-1, width))
    return out


_RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0,
         block_values: int = BLOCK_VALUES) -> DataFrame:
    """For each anchor row and each of its positives the negatives in the positive's window, ranked from 1."""
    spark = rows.sparkSession
    used = (rows.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"),
                        F.xxhash64(id_col, label_col, vector_col).alias("hash"),
                        F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"),
                        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
            .where(F.col("label").isNotNull() & F.col("vector").isNotNull()
                   & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))))
    parts = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    norm = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x * x)
    total = used.agg(F.max(norm).alias("norm"), F.sum(F.when(F.col("is_anchor"), F.size("vector") + 1)).alias("values")).first()
    path = os.path.join(shared_dir(spark), f"negatives-{uuid.uuid4().hex}")
    if not total["values"]:
        return spark.createDataFrame([], _RESULT)
    primes = primes_for(1.001 * total["norm"])
    # each anchor row gets a number of its own, written once, so that copies spread over the blocks
    used.where("is_anchor").withColumn("slot", F.monotonically_increasing_id()).write.parquet(f"{path}/anchors")
    slots = spark.read.parquet(f"{path}/anchors")
    blocks = -(-total["values"] // block_values)
    plain = used.drop("is_anchor")
    for b in range(blocks):
        mine_ = slots.where(F.pmod(F.xxhash64("slot"), F.lit(blocks)) == b).select("id", "hash", "label", "vector").toPandas()
        if not len(mine_):
            continue
        anchors = Anchors(mine_, primes, scale)
        best = _positives(plain, anchors, positives)
        found = _first(plain.mapInPandas(_other_labels(anchors, best, low, high, negatives), _FOUND), negatives)
        found.mapInPandas(_named(anchors.id, best), _RESULT).write.mode("append").parquet(f"{path}/found")
    out = spark.read.schema(_RESULT).parquet(f"{path}/found")
    return out.select(*(F.nullif(c, F.lit(_LAST)).alias(c) if c.endswith("_id") else F.col(c) for c in out.columns))


def _named(anchor_id: np.ndarray, best: Best):
    """Result rows of the lines (anchor and positive)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, k = np.divmod(pdf["line"].to_numpy(np.int64), best.width)
            yield pd.DataFrame({"anchor_id": anchor_id[a], "positive_id": best.id[a, k], "rank": pdf["rank"].astype(np.int32),
                                "negative_id": pdf["id"], "positive_score": best.score[a, k], "negative_score": pdf["score"]})
    return run
