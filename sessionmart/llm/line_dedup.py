"""Line dedup: runs of lines that occurred before are deleted, found by winnowing.

A line here ends at a line feed, behind a sentence's end (``.``, ``!`` or ``?`` before white space), and, so that no line
is long, before each word whose hash is the least of ``line_words`` neighbouring ones. All three depend on nearby words
only, so a passage is cut into the same lines wherever it stands, but for ``2 * line_words`` words at its ends.
Lines are compared by hashes of their words; white space does not count.

Each line starts a gram: the shortest run of lines from it with ``gram_words`` words or more. Of the grams that start
within ``window_words`` words the one with the smallest hash is selected. A run of words that two places share, with
``5 * line_words + gram_words + window_words`` words (48) or more, holds a whole window of the same grams, so both places select
the same one: a guaranteed fingerprint. Equal fingerprints are matched with an earlier place (smaller ``doc_id``, then position).

Matched grams that overlap or touch form a chain. A chain is extended both ways word by word, into partial lines, as far as the place
that its first or last gram was matched with agrees; what lies farther away than ``REACH`` words would hold a
matched fingerprint of its own. Runs of ``run_words`` words or more are deleted. Every deleted word stands in a run equal to an
earlier place, so one copy of everything stays.

Fingerprints are exchanged by ranges of their hash. Within a batch of texts only the first place of
a fingerprint is sent (later ones are matched there and then, with that place), so a passage that a third of
all documents hold costs one row a batch, not one a document, and no place is asked for its surroundings by all of them.

Null text: unchanged. Rows with the same ``doc_id`` and text count as one document, and get the same result
(neither is deleted in favour of the other). A null ``doc_id`` comes last in the order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_name, parts_of, written
from .textops import U64, WordHasher, Words, chunks, mix

LINE_WORDS, GRAM_WORDS, WINDOW_WORDS, RUN_WORDS = 4, 16, 12, 40
REACH = 32  # words on either side of a chain that the extension asks for
_LAST = (1 << 63) - 1


def window_minima(hash_: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the least (the last of equals) of some ``width`` neighbouring ones of one text."""
    n = len(hash_) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = hash_[:n].copy()
    for k in range(1, width):
        np.minimum(least, hash_[k:k + n], out=least)
    open_, pick = doc[:n] == doc[width - 1:], np.zeros(len(hash_), bool)  # windows inside a text, not settled yet
    for k in range(width - 1, -1, -1):
        here = hash_[k:k + n] == least
        here &= open_
        pick[k:k + n] |= here
        open_ &= ~here
    return np.flatnonzero(pick)


class Lines:
    """Lines of a batch: hash, text index, first word and one past the last (as word indices)."""

    def __init__(self, hasher: WordHasher, texts: list[str | None], line_words: int = LINE_WORDS) -> None:
        w = self.words = hasher(texts, lower=False)
        n = len(w.hash)
        feeds = np.concatenate(([0], np.cumsum(w.buf == 10)))
        ends = np.isin(w.buf[w.end - 1], np.frombuffer(b".!?", np.uint8)) if n else np.zeros(0, bool)
        new = np.ones(n, bool)
        new[1:] = ends[:-1] | (feeds[w.start[1:]] > feeds[w.end[:-1]]) | (w.doc[1:] != w.doc[:-1])
        new[window_minima(w.hash, w.doc, line_words)] = True
        self.start = np.flatnonzero(new)
        self.end = np.append(self.start[1:], n)
        self.doc = w.doc[self.start]
        run = np.zeros(n + 1, U64)
        np.cumsum(w.hash * hasher.up[:n], out=run[1:], dtype=U64)
        self.hash = mix((run[self.end] - run[self.start]) * hasher.down[self.start] + (self.end - self.start).astype(U64)) \
            if n else np.zeros(0, U64)
        self.at = np.searchsorted(self.doc, np.arange(len(texts) + 1))  # first line of each text


def fingerprints(lines: Lines, hasher: WordHasher, gram_words: int, window_words: int):
    """Selected grams: hash, first line, last line."""
    n = len(lines.hash)
    last = np.searchsorted(lines.end, lines.start + gram_words)
    inside = last < n
    inside[inside] = lines.doc[last[inside]] == lines.doc[inside]
    first = np.flatnonzero(inside)
    last = last[first]
    run = np.zeros(n + 1, U64)
    np.cumsum(lines.hash * hasher.up[:n], out=run[1:], dtype=U64)
    gram = mix((run[last + 1] - run[first]) * hasher.down[first] + (last - first).astype(U64))
    word, doc = lines.start[first], lines.doc[first]
    best, arg = gram.copy(), np.arange(len(first))
    for k in range(1, min(window_words, len(first))):
        less = word[k:] - word[:-k] < window_words
        less &= doc[k:] == doc[:-k]
        if not less.any():
            break
        less &= gram[k:] <= best[:-k]
        np.copyto(best[:-k], gram[k:], where=less)
        np.copyto(arg[:-k], np.arange(k, len(first)), where=less)
    pick = np.unique(arg)
    return gram[pick], first[pick], last[pick]


def _match(gram, doc, hash_, first):
    """Entries sorted by (gram, doc, text hash, place) against the first of their gram: later ones, their firsts; and all firsts."""
    order = np.lexsort((first, hash_, doc, gram))
    g = gram[order]
    head = np.concatenate(([True], g[1:] != g[:-1])) if len(g) else np.zeros(0, bool)
    lead = order[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(g) else order
    later = ~head & ~((doc[order] == doc[lead]) & (hash_[order] == hash_[lead]) & (first[order] == first[lead]))
    return order[later], lead[later], order[head]


_PACKED = "part int, docs binary, hashes binary, gram binary, idx binary, first binary, last binary, lead binary"


def _fingerprint_rows(parts: int, line_words: int, gram_words: int, window_words: int):
    """Per batch of texts and range of hashes the first places of fingerprints; and matches within the batch (no ``gram``)."""
    columns = [c.split()[0] for c in _PACKED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, turn = WordHasher(), 0
        for pdf in batches:
            texts = pdf["text"].tolist()
            doc_id, hash_ = pdf["doc"].to_numpy(np.int64), pdf["hash"].to_numpy(np.int64)
            for s in chunks(texts, 4_000_000):
                lines = Lines(hasher, texts[s], line_words)
                gram, first, last = fingerprints(lines, hasher, gram_words, window_words)
                if not len(gram):
                    continue
                of = lines.doc[first]
                d, h = doc_id[s], hash_[s]
                f, e = (x - lines.words.at[of] for x in (lines.start[first], lines.end[last]))
                i, a, lead = _match(gram, d[of], h[of], f)
                turn += 1
                own, idx = np.unique(np.concatenate((of[i], of[a])), return_inverse=True)
                u32 = lambda x: x.astype(np.uint32).tobytes()
                rows = [(turn % parts, d[own].tobytes(), h[own].tobytes(), b"", u32(idx[:len(i)]), u32(f[i]), u32(e[i]),
                         u32(np.concatenate((idx[len(i):], f[a]))))]
                key = gram[lead]  # sorted: the match orders by gram
                part = ((key >> U64(32)) * U64(parts)) >> U64(32)
                cut = np.searchsorted(part, np.arange(parts + 1, dtype=U64))
                for p in np.flatnonzero(np.diff(cut)):
                    x = lead[cut[p]:cut[p + 1]]
                    own, idx = np.unique(of[x], return_inverse=True)
                    rows.append((int(p), d[own].tobytes(), h[own].tobytes(), gram[x].tobytes(), u32(idx), u32(f[x]), u32(e[x]), b""))
                yield pd.DataFrame(rows, columns=columns)
    return run


def _later_places(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """For one hash range: per document its matches, as rows (first word, one past the last, matched document, hash, first word)."""
    docs, hashes, found, many = [], [], [], []

    def keep(doc, hash_, lo, hi, lead_doc, lead_hash, lead_lo):
        order = np.lexsort((hash_, doc))
        rows = np.column_stack((lo, hi, lead_doc, lead_hash, lead_lo))[order]
        doc, hash_ = doc[order], hash_[order]
        at = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (hash_[1:] != hash_[:-1])))) if len(doc) else []
        for a, b in zip(at, np.append(at[1:], len(doc))):
            docs.append(doc[a])
            hashes.append(hash_[a])
            found.append(rows[a:b].tobytes())
    for row in pdf.itertuples():
        d, h = np.frombuffer(row.docs, np.int64), np.frombuffer(row.hashes, np.int64)
        i, f, e = (np.frombuffer(x, np.uint32).astype(np.int64) for x in (row.idx, row.first, row.last))
        if len(row.gram):
            many.append((np.frombuffer(row.gram, U64), d[i], h[i], f, e))
        else:
            a, g = np.frombuffer(row.lead, np.uint32).astype(np.int64).reshape(2, -1)
            keep(d[i], h[i], f, e, d[a], h[a], g)
    if many:
        gram, doc, hash_, first, last = (np.concatenate(x) for x in zip(*many))
        i, a, _ = _match(gram, doc, hash_, first)
        keep(doc[i], hash_[i], first[i], last[i], doc[a], hash_[a], first[a])
    return pd.DataFrame({"doc": np.array(docs, np.int64), "hash": np.array(hashes, np.int64), "found": pd.Series(found, dtype=object)})


def joined(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges ordered by ``lo``, overlapping and touching ones as one: where each starts in the order, and its end."""
    if not len(lo):
        return np.zeros(0, np.int64), hi
    end = np.maximum.accumulate(hi)
    head = np.flatnonzero(np.concatenate(([True], lo[1:] > end[:-1])))
    return head, end[np.append(head[1:], len(lo)) - 1]


_CHAINS = ("doc long, hash long, lo long, hi long, before_doc long, before_hash long, before_at long, "
           "behind_doc long, behind_hash long, behind_at long")


def _chain_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chains of a document's matches, each with the places that its first and last gram were matched with."""
    for pdf in batches:
        out = []
        for doc, hash_, found in zip(pdf["doc"], pdf["hash"], pdf["found"]):
            m = np.concatenate([np.frombuffer(x, np.int64) for x in found]).reshape(-1, 5)
            m = m[np.lexsort((m[:, 1], m[:, 0]))]
            head, end = joined(m[:, 0], m[:, 1])
            last = np.array([a + np.argmax(m[a:b, 1]) for a, b in zip(head, np.append(head[1:], len(m)))], np.int64)
            for a, b, hi in zip(head, last, end):
                out.append((doc, hash_, m[a, 0], hi, *m[a, 2:], m[b, 2], m[b, 3], m[b, 4] + m[b, 1] - m[b, 0]))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _CHAINS.split(", ")])


def _context_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Word hashes around the places asked for: those before it, or those from it on."""
    hasher = WordHasher()
    for pdf in batches:
        texts, out = pdf["text"].tolist(), []
        for s in chunks(texts):
            w = hasher(texts[s], lower=False)
            for k in range(s.start, s.start + len(texts[s])):
                lo, hi = w.at[k - s.start], w.at[k - s.start + 1]
                for x in pdf["places"].iloc[k]:
                    at = lo + x["at"]
                    ctx = w.hash[max(lo, at - REACH):at] if x["before"] else w.hash[at:min(hi, at + REACH)]
                    out.append((pdf["doc"].iloc[k], pdf["hash"].iloc[k], x["at"], x["before"], ctx.tobytes()))
        yield pd.DataFrame(out, columns=["doc", "hash", "at", "before", "words"])


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many values agree from the start on."""
    n = min(len(a), len(b))
    return int(np.cumprod(a[:n] == b[:n]).sum())


def later_runs(own: np.ndarray, chains, run_words: int) -> np.ndarray:
    """Ranges of words to delete: the chains (lo, hi, words before and behind at the matched places) extended and joined."""
    spans = []
    for c in chains:
        before, behind = (np.frombuffer(x or b"", U64) for x in (c["before"], c["behind"]))
        spans.append((c["lo"] - _agree(own[:c["lo"]][::-1], before[::-1]), c["hi"] + _agree(own[c["hi"]:], behind)))
    lo, hi = np.array(sorted(spans), np.int64).reshape(-1, 2).T
    head, end = joined(lo, hi)
    runs = np.column_stack((lo[head], end))
    return runs[runs[:, 1] - runs[:, 0] >= run_words]


def cut_words(w: Words, i: int, runs: np.ndarray) -> tuple[bytes, list[tuple[int, int]], int]:
    """Text ``i`` of a batch without the given runs of words: bytes, deleted code-point ranges, deleted words."""
    base, n = w.at[i], w.at[i + 1] - w.at[i]
    text_at, stop = w.first[i], w.first[i + 1] - 1
    wide = np.concatenate(([0], np.cumsum((w.buf[text_at:stop] & 0xC0) != 0x80)))
    keep, spans, pos = [], [], text_at
    for a, b in runs:
        lo, hi = w.start[base + a], stop if b == n else w.start[base + b]
        keep.append(w.buf[pos:lo].tobytes())
        spans.append((int(wide[lo - text_at]), int(wide[hi - text_at])))
        pos = hi
    keep.append(w.buf[pos:stop].tobytes())
    out = b"".join(keep)
    return (out.rstrip(b" \t\n\x0b\f\r") if pos == stop else out), spans, int((runs[:, 1] - runs[:, 0]).sum())


def _rewrite_rows(columns: list[str], chains: str, run_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for pdf in batches:
            out = pdf[columns].copy()
            text, removed, spans = pdf["text"].tolist(), np.zeros(len(pdf), np.int64), [None] * len(pdf)
            hit = [i for i, r in enumerate(pdf[chains]) if r is not None]
            for s in chunks([text[i] for i in hit]):
                w = hasher([text[i] for i in hit[s]], lower=False)
                for k, i in enumerate(hit[s]):
                    runs = later_runs(w.hash[w.at[k]:w.at[k + 1]], pdf[chains].iloc[i], run_words)
                    if len(runs):
                        b, spans[i], removed[i] = cut_words(w, k, runs)
                        text[i] = b.decode("utf-8", "surrogatepass")
            out["text"] = pd.Series(text, index=out.index, dtype=object)
            out["removed_words"] = removed
            out["removed"] = pd.Series([None if x is None else [{"from": a, "to": b} for a, b in x] for x in spans],
                                       index=out.index, dtype=object)
            yield out
    return run


def dedup_lines(docs: DataFrame, line_words: int = LINE_WORDS, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS,
                run_words: int = RUN_WORDS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) with later repeated runs deleted from ``text``.

    Adds ``removed_words`` and ``removed``, the deleted ranges in code points of the text before
    (null: none). Further columns pass through; columns of these two names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("removed_words", "removed")
    parts = parts_of(spark)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("hash"), "text")
    found = (keyed.where("text is not null")
             .mapInPandas(_fingerprint_rows(parts, line_words, gram_words, window_words), _PACKED)
             .groupBy("part").applyInPandas(_later_places, "doc long, hash long, found binary")
             .groupBy("doc", "hash").agg(F.collect_list("found").alias("found")))
    chains = written(found.mapInPandas(_chain_rows, _CHAINS), "chains")
    asked = [chains.select(F.col(f"{side}_doc").alias("doc"), F.col(f"{side}_hash").alias("hash"), F.col(f"{side}_at").alias("at"),
                           F.lit(side == "before").alias("before")) for side in ("before", "behind")]
    places = (asked[0].union(asked[1]).distinct()  # a place that many documents ask for is looked up once
              .groupBy("doc", "hash").agg(F.collect_list(F.struct("at", "before")).alias("places")))
    context = written(keyed.join(places, ["doc", "hash"])
                      .mapInPandas(_context_rows, "doc long, hash long, at long, before boolean, words binary")
                      .dropDuplicates(["doc", "hash", "at", "before"]), "context")  # of repeated rows
    for side in ("before", "behind"):
        words = context.where(F.col("before") == (side == "before")).select(
            F.col("doc").alias(f"{side}_doc"), F.col("hash").alias(f"{side}_hash"), F.col("at").alias(f"{side}_at"), F.col("words").alias(side))
        chains = chains.join(words, [f"{side}_doc", f"{side}_hash", f"{side}_at"], "left")
    per_doc = chains.groupBy("doc", "hash").agg(F.collect_list(F.struct("lo", "hi", "before", "behind")).alias("chains"))
    names = [free_name(docs, c) for c in ("doc", "hash", "chains")]
    per_doc = per_doc.toDF(*names)
    marked = docs.withColumns({names[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), names[1]: F.xxhash64("text")})
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return (marked.join(per_doc, names[:2], "left").select(*docs.columns, names[2])
            .mapInPandas(_rewrite_rows(docs.columns, names[2], run_words),
                         shape + ", removed_words long, removed array<struct<`from`: long, `to`: long>>"))
