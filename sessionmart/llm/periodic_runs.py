"""Periodic run detection: seed and extend on diagonals.

A run is a stretch of words with smallest period q (words q apart are equal) and at least ``max(MIN_LENGTH, MIN_PERIODS * q)`` words
that no neighbouring word extends. Seen as a diagonal of lag q, its words equal those q later over its length less q.

Lags are taken in classes [2**j, 2**(j + 1)). The least overlap of a class is k words (5, 6, 12, 24, ...), and k is never
below a lag of the class. So every run of the class holds k-grams that occur
again a lag later, and by the theorem of Fine and Wilf no k-gram of a run occurs in between (the run would have a
smaller period). Hence the index of the k-grams need only give each occurrence its next one in the same document: a number of pairs
linear in the words, however often a gram occurs. A pair whose distance lies in the class is a seed on that diagonal.

Seeds of a diagonal are taken in order; a table of how far the diagonal has been covered drops those inside a stretch that
an earlier one covers, and the rest are extended both ways word by word. Stretches long enough are the runs.
A gram of one class begins with the gram of the class before, so each class looks only at places whose shorter gram occurs again.

Words are compared by 64-bit hashes. A document is one row and is read whole by one task; nothing is shuffled.

Null text: no words and no runs. Null ``doc_id``: stays null. Repeated rows are each judged; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import U64, WordHasher, chunks, mix

MIN_LENGTH, MIN_PERIODS = 6, 4


def _next_places(key: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places (ascending ``at``) of one document with equal keys, each with its next one."""
    some = np.sort(key)
    again = some[1:][some[1:] == some[:-1]]
    if not len(again):
        return at[:0], at[:0]
    bits = (1 << (8 * len(again)).bit_length()) - 1  # most keys occur once; a bit table leaves few of them to sort with their places
    seen = np.zeros(bits + 1, bool)
    seen[again.view(np.int64) & bits] = True
    few = np.flatnonzero(seen[key.view(np.int64) & bits])
    key, at = key[few], at[few]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    i, j = at[order[:-1][same]], at[order[1:][same]]
    own = doc[i] == doc[j]  # grams of different documents are told apart by their keys already
    return i[own], j[own]


def _extended(hash_: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches [lo, hi) of places that equal the place a lag later, made as long as they go both ways."""
    n = len(hash_)
    lo, hi = lo.copy(), hi.copy()
    on = np.arange(len(lo))
    while len(on):
        x, y = hi[on], hi[on] + lag[on]
        ok = y < n
        ok[ok] = (hash_[x[ok]] == hash_[y[ok]]) & (doc[x[ok]] == doc[y[ok]])
        on = on[ok]
        hi[on] += 1
    on = np.arange(len(lo))
    while len(on):
        x = lo[on] - 1
        ok = x >= 0
        ok[ok] = (hash_[x[ok]] == hash_[x[ok] + lag[on][ok]]) & (doc[x[ok]] == doc[x[ok] + lag[on][ok]])
        on = on[ok]
        lo[on] -= 1
    return lo, hi


def runs_of(hash_: np.ndarray, at: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS):
    """All runs of the documents of a batch: document, first word, length, period, by document, start and period.

    ``hash_``: one value a word; ``at``: first word of each document, one more at the end.
    """
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    n, longest = len(hash_), int(np.diff(at).max()) if len(at) > 1 else 0
    salted = mix(hash_ ^ mix(doc.astype(U64) + U64(1)))  # equal words of different documents differ
    up = np.full(n + 1, U64(0x9E3779B97F4A7C15), U64)
    up[:1] = 1
    up = np.cumprod(up, dtype=U64)
    run = np.zeros(n + 1, U64)
    np.cumsum(salted[::-1] * up[:n], out=run[1:], dtype=U64)
    run = run[::-1]  # sums from each word to the end, by powers that fall from word to word
    places, found, lag, before = np.arange(n), [], 1, 0
    while len(places) > 1 and lag * min_periods <= longest:
        turn = min(max(min_length // min_periods, lag), 2 * lag - 1)  # the overlap falls up to this lag, then it rises
        k = min(max(min_length, min_periods * q) - q for q in (lag, turn, min(turn + 1, 2 * lag - 1)))
        if k < before:
            places = np.arange(n)
        before = k
        places = places[places + k <= at[doc[places] + 1]]
        key = mix((run[places] - run[places + k]) * up[places])
        i, j = _next_places(key, doc, places)
        seed = (j - i >= lag) & (j - i < 2 * lag)
        d, s = (j - i)[seed], i[seed]
        order = np.lexsort((s, d))
        d, s = d[order], s[order]
        # the table of what each diagonal has covered: a seed that starts inside or at the end of it adds to it
        fresh = np.ones(len(s), bool)
        fresh[1:] = (d[1:] != d[:-1]) | (s[1:] > s[:-1] + k) | (doc[s[1:]] != doc[s[:-1]])
        head = np.flatnonzero(fresh)
        last = np.append(head[1:], len(s))[:len(head)] - 1
        lo, hi = _extended(hash_, doc, s[head], s[last] + k, d[head])
        found.append(np.column_stack((lo, hi - lo + d[head], d[head])))
        places = np.union1d(i, j)  # only these can hold longer grams that occur again
        lag *= 2
    rows = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)
    rows = rows[rows[:, 1] >= np.maximum(min_length, min_periods * rows[:, 2])]
    order = np.lexsort((rows[:, 2], rows[:, 0]))
    start, length, period = rows[order].T
    return doc[start] if len(start) else start, start - at[doc[start]] if len(start) else start, length, period


def _collapsed(text: str | None, n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> str:
    """The words of a text that no run holds behind its first period, joined by one space."""
    words = (text or "").encode("utf-8", "surrogatepass").split()  # of bytes: at the six ASCII white-space characters
    if len(start):
        gone = np.zeros(n + 1, np.int64)
        np.add.at(gone, start + period, 1)
        np.add.at(gone, start + length, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:n]) == 0)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


_FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _run_rows(min_length: int, min_periods: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for pdf in batches:
            texts, n_words = pdf["text"].tolist(), np.zeros(len(pdf), np.int64)
            runs, collapsed = [], []
            for s in chunks(texts):
                w = hasher(texts[s], lower=False)
                n_words[s] = size = np.diff(w.at)
                doc, start, length, period = runs_of(w.hash, w.at, min_length, min_periods)
                cut = np.searchsorted(doc, np.arange(len(size) + 1))
                for i, t in enumerate(texts[s]):
                    own = slice(cut[i], cut[i + 1])
                    runs.append([{"start": a, "length": b, "period": c} for a, b, c in
                                 zip(start[own].tolist(), length[own].tolist(), period[own].tolist())])
                    collapsed.append(_collapsed(t, int(size[i]), start[own], length[own], period[own]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_words": n_words,
                                "runs": pd.Series(runs, dtype=object, index=pdf.index),
                                "collapsed": pd.Series(collapsed, dtype=object, index=pdf.index)})
    return run


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, ``runs`` (start, length, period; by start, then period) and
    ``collapsed``, the text with each run cut to its first period. ``min_length`` is more than 1 and ``min_periods`` at least 3,
    so that the overlap of a run with itself is no shorter than twice its period."""
    if min_length < 2 or min_periods < 3:
        raise ValueError("min_length must be 2 or more and min_periods 3 or more")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(_run_rows(min_length, min_periods), _FOUND)


def digests(found: DataFrame) -> DataFrame:
    """Per row of ``find_runs``: number of runs, the longest (first of equals), and digests of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    listed = F.concat_ws("\n", F.concat(lines, F.array(F.lit(""))))  # each line ends with a line feed
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    (-F.col("best.short")).alias("length"), F.col("best.period").alias("period"),
                    F.floor(F.lit(-1000) * F.col("best.short") / F.col("best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(F.when(F.size("runs") > 0, listed).otherwise(""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
