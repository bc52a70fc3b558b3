"""Benchmark decontamination: word-pair seeds, then Smith-Waterman alignment of words.

Words are case-folded runs of letters, digits and non-ASCII characters. A document is contaminated by an item if
their local alignment (match 2, mismatch -1, gap -1) reaches ``min_score`` of a full match, which leaves room for
about one changed word in three, however the changes are spread; and in any case the score of ``LEAST_MATCHED`` matched words, or
of all words of a shorter item, so that a few common words of ordinary text are no copy of a short item.

The seeds lose no such alignment. One of a item words that scores ``t`` or more has a - 1 steps from one matched
word to the next. A step that skips k words in the item or the text costs k, so with p steps that skip none and
q that skip at most one, 2a - q - 2(a - 1 - p - q) >= t, and as a is at most the item's m words, 2p + q >= t - 2 (see
``needed``). Both kinds are word pairs, adjacent or with one word between, that item and text share. Each place of an
item starts at most one step, so the most frequent places whose steps together stay below t - 2 need no seeds;
all pairs of all other places are seeds. A seed found in a document proposes the
passage around it that an alignment can reach; overlapping proposals are joined. Passages whose shared pairs
cannot add up to t - 2 are left out, the others are aligned with the item.

The test items are the query side: they are read in blocks of at most ``block_words`` words, so what
each task holds of them is bounded whatever their number. Documents are only scanned, whole, in
place: no document is shuffled, and a passage that very many documents hold costs each of them its own alignment.

Null text, in either table: no words. Items with fewer than three words match nothing. Null
``doc_id``: the row keeps its null. Repeated rows are each judged; repeated items are each reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .textops import U64, WordHasher, Words, chunks, mix

LEAST_WORDS, LEAST_MATCHED = 3, 7
MIN_SCORE = 0.5
BLOCK_WORDS = 1_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
_CELLS = 2_000_000  # of a row of the score tables of one batch of alignments


def word_gaps() -> np.ndarray:
    """Bytes that separate words: ASCII other than letters and digits."""
    t = np.zeros(256, bool)
    t[:128] = True
    for a, b in (("0", "9"), ("A", "Z"), ("a", "z")):
        t[ord(a):ord(b) + 1] = False
    return t


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each pair of word sequences: score, and where it ends in item and passage (inclusive).

    One row of the score table at a time for all pairs; gaps along the row by a running maximum.
    """
    n, m, w = len(items), max(map(len, items)), max(map(len, passages))
    x, y = np.zeros((n, m), U64), np.zeros((n, w), U64)
    real = np.zeros((n, w), bool)
    for k, (a, b) in enumerate(zip(items, passages)):
        x[k, :len(a)], y[k, :len(b)] = a, b
        real[k, :len(b)] = True
    inside = np.arange(m)[None, :] < np.array([len(a) for a in items])[:, None]
    ramp = -GAP * np.arange(w, dtype=np.int32)
    prev = np.zeros((n, w + 1), np.int32)
    best, ei, ej = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(m):
        same = (y == x[:, i:i + 1]) & real & inside[:, i:i + 1]
        row = np.maximum(prev[:, :-1] + np.where(same, MATCH, MISMATCH), prev[:, 1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + ramp, axis=1) - ramp
        j = row.argmax(axis=1)
        top = row[np.arange(n), j]
        more = (top > best) & inside[:, i]
        best[more], ei[more], ej[more] = top[more], i, j[more]
        prev[:, 1:] = row
    return best, ei, ej


def fold(texts: list[str | None]) -> list[str | None]:
    """Texts without case beyond A-Z (the hasher folds A-Z)."""
    return [t if t is None or t.isascii() else t.casefold() for t in texts]


def pair_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word its pair with the next word and with the one behind that; 0 where the text has ended."""
    out = []
    for k in (1, 2):
        h = np.zeros(len(words.hash), U64)
        if len(h) > k:
            h[:-k] = np.where(words.doc[k:] == words.doc[:-k], mix(words.hash[:-k] * U64(3) + words.hash[k:]) | U64(1), U64(0))
        out.append(h)
    return out[0], out[1]


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` in ``sorted_keys`` (not empty), and whether they are there."""
    k = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return k, sorted_keys[k] == keys


class Items:
    """A block of test items: word hashes, seeds in sorted order, and the places of each seed."""

    def __init__(self, ids: list, texts: list, min_score: float = MIN_SCORE) -> None:
        words = WordHasher(word_gaps())(fold(texts))
        self.ids = ids
        self.words = [words.hash[words.at[i]:words.at[i + 1]] for i in range(len(ids))]
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.least = np.maximum(np.ceil(min_score * MATCH * self.size - 1e-9).astype(np.int64),  # score that counts
                                MATCH * np.minimum(LEAST_MATCHED, self.size))
        self.needed = self.least - 2  # sum of shared pairs (adjacent 2, else 1) below which no alignment scores that
        near, far = pair_hashes(words)
        place = np.arange(len(near)) - words.at[words.doc] if len(near) else np.zeros(0, np.int64)
        self.gram, self.item = np.concatenate((near, far)), np.concatenate((words.doc, words.doc))
        self.place, weight = np.concatenate((place, place)), np.repeat([2, 1], len(near))
        ok = (self.gram > 0) & (self.size[self.item] >= LEAST_WORDS) if len(self.gram) else np.zeros(0, bool)
        self.gram, self.item, self.place, weight = self.gram[ok], self.item[ok], self.place[ok], weight[ok]
        key = self._key(self.gram, self.item)
        order = np.lexsort((-weight, key))
        self.pairs, at = np.unique(key[order], return_index=True)
        self.weight = weight[order][at]
        self._index(np.arange(len(self.gram)))

    @staticmethod
    def _key(gram: np.ndarray, item: np.ndarray) -> np.ndarray:
        return mix(gram ^ mix(item.astype(U64) + U64(1)))

    def _index(self, keep: np.ndarray) -> None:
        order = keep[np.argsort(self.gram[keep], kind="stable")]
        self.seeds, self.first = np.unique(self.gram[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.seed_item, self.seed_place = self.item[order], self.place[order]
        self.some = np.zeros(1 << (16 * len(self.seeds) + 1).bit_length(), bool)  # most words' pairs end here
        self.some[self._low(self.seeds)] = True

    def _low(self, gram: np.ndarray) -> np.ndarray:
        return (gram >> U64(1)).view(np.int64) & (len(self.some) - 1)

    def found(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs are seeds (index), and which seeds."""
        got = np.flatnonzero(self.some[self._low(gram)])
        k, same = _find(self.seeds, gram[got]) if len(self.seeds) else (got, np.zeros(len(got), bool))
        return got[same], k[same]

    def drop_frequent(self, gram: np.ndarray, n: np.ndarray) -> None:
        """Leave out each item's most frequent places, as many as cannot hold all steps of an alignment that counts.

        ``gram`` (sorted) and ``n``: occurrences of the pairs in the corpus.
        """
        k, known = _find(gram, self.gram) if len(gram) else (self.place, np.zeros(len(self.gram), bool))
        often = np.zeros(len(self.gram), np.int64)
        often[known] = n[k[known]]
        start = np.concatenate(([0], np.cumsum(self.size)))
        at = start[self.item] + self.place
        total = np.bincount(at, weights=often, minlength=start[-1])
        item = np.repeat(np.arange(len(self.size)), self.size)
        order = np.lexsort((-total, item))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - start[item[order]]
        spare = np.maximum((self.needed - 1) // 2, 0)  # a place's step adds at most 2
        self._index(np.flatnonzero(rank[at] >= spare[self.item]))

    def hits(self, words: Words, pairs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and word offset (place in the text less place in the item) of each seed found; not repeated."""
        out = []
        for gram in pairs:
            at, k = self.found(gram)
            n = self.first[k + 1] - self.first[k]
            to = np.concatenate(([0], np.cumsum(n)))
            posting = np.repeat(self.first[k] - to[:-1], n) + np.arange(to[-1])
            at = np.repeat(at, n)
            doc = words.doc[at]
            out.append((doc, self.seed_item[posting], at - words.at[doc] - self.seed_place[posting]))
        return tuple(np.concatenate(x) for x in zip(*out))


def _gram_counts(items: Items):
    """Per task: pairs of the items and how often its documents hold them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, total = WordHasher(word_gaps()), np.zeros(len(items.seeds), np.int64)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for s in chunks(texts):
                for gram in pair_hashes(hasher(fold(texts[s]))):
                    total += np.bincount(items.found(gram)[1], minlength=len(total))
        some = total > 0
        yield pd.DataFrame({"gram": items.seeds[some].view(np.int64), "n": total[some]})
    return run


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, end to end, and where each range starts (one more at the end)."""
    to = np.concatenate(([0], np.cumsum(hi - lo)))
    return np.repeat(lo - to[:-1], hi - lo) + np.arange(to[-1]), to


def _joined(doc, item, lo, hi) -> tuple[np.ndarray, ...]:
    """Overlapping or touching ranges of the same text and item as one, in order."""
    order = np.lexsort((lo, item, doc))
    doc, item, lo, hi = doc[order], item[order], lo[order], hi[order]
    group = np.cumsum(np.concatenate(([0], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]))))
    width = int(hi.max()) + 1
    reach = np.maximum.accumulate(hi + group * width) - group * width
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (lo[1:] > reach[:-1])))
    at = np.flatnonzero(new)
    return doc[at], item[at], lo[at], reach[np.append(at[1:], len(new)) - 1]


def passages(items: Items, words: Words) -> list[tuple[int, int, int, int]]:
    """Passages that an alignment that counts may lie in: text, item, first word, one past the last (words of the batch)."""
    pairs = pair_hashes(words)
    doc, item, diag = items.hits(words, pairs)
    if not len(doc):
        return []
    slack = MATCH * items.size - items.least  # words that an alignment that counts can skip
    lo = np.maximum(diag - slack[item], 0) + words.at[doc]
    hi = np.minimum(diag + items.size[item] + slack[item] + words.at[doc], words.at[doc + 1])
    doc, item, lo, hi = _joined(doc, item, lo, hi)
    out = []
    for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(np.cumsum(hi - lo) // _CELLS)) + 1):
        d, i, a, b = doc[part], item[part], lo[part], hi[part]
        at, to = _ranges(a, b)
        of = np.repeat(np.arange(len(a)), b - a)
        weight = np.zeros(len(at), np.int64)
        for gram, most in ((pairs[0], 2), (pairs[1], 1)):
            k, same = _find(items.pairs, items._key(gram[at], i[of]))
            np.maximum(weight, np.where(same, np.minimum(items.weight[k], most), 0), out=weight)
        total = np.concatenate(([0], np.cumsum(weight)))
        stop = np.minimum(np.arange(len(at)) + (items.size + slack)[i[of]], to[of + 1])
        good = np.flatnonzero(total[stop] - total[:-1] >= items.needed[i[of]])
        if len(good):
            out.append((d[of[good]], i[of[good]], at[good], at[good] + stop[good] - good))
    if not out:
        return []
    return list(zip(*(x.tolist() for x in _joined(*(np.concatenate(x) for x in zip(*out))))))


def batch_matches(items: Items, words: Words) -> list[tuple]:
    """Alignments that reach the score: text, item, score share, first word and one past the last, in the text."""
    cand = sorted(passages(items, words), key=lambda c: (c[3] - c[2], len(items.words[c[1]])))
    out, k = [], 0
    while k < len(cand):
        some = cand[k:k + 256]
        some = some[:max(1, sum((c[3] - c[2]) * len(some) <= _CELLS for c in some))]  # the longest last
        k += len(some)
        score, ei, ej = align([items.words[i] for _, i, _, _ in some], [words.hash[a:b] for _, _, a, b in some])
        hit = [j for j, (_, i, _, _) in enumerate(some) if score[j] >= items.least[i]]
        if not hit:
            continue
        # the same alignment read backwards from its end gives its start
        back_item = [items.words[some[j][1]][:ei[j] + 1][::-1] for j in hit]
        back_text = [words.hash[some[j][2]:some[j][2] + ej[j] + 1][::-1] for j in hit]
        _, _, bj = align(back_item, back_text)
        for j, b in zip(hit, bj):
            d, i, a, _ = some[j]
            end = a + int(ej[j]) + 1
            out.append((d, i, float(score[j]) / (MATCH * len(items.words[i])),
                        end - int(b) - 1 - int(words.at[d]), end - int(words.at[d])))
    return out


_SHAPE = "doc_id long, item_id long, score double, word_from long, word_to long"


def _match_rows(items: Items):
    columns = [c.split()[0] for c in _SHAPE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher(word_gaps())
        for pdf in batches:
            texts, ids, rows = pdf["text"].tolist(), pdf["doc_id"].tolist(), []
            for s in chunks(texts):
                best: dict[tuple, tuple] = {}
                for d, i, score, a, b in batch_matches(items, hasher(fold(texts[s]))):
                    if (d, i) not in best or (-score, a) < (-best[d, i][0], best[d, i][1]):
                        best[d, i] = (score, a, b)
                rows += [(ids[s.start + d], items.ids[i], *x) for (d, i), x in best.items()]
            out = pd.DataFrame(rows, columns=columns)
            for c in ("doc_id", "item_id"):
                out[c] = pd.array([None if pd.isna(x) else int(x) for x in out[c]], "Int64")
            yield out
    return run


def _clean_rows(items: Items):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher(word_gaps())
        for pdf in batches:
            texts, clean = pdf["text"].tolist(), np.ones(len(pdf), bool)
            for s in chunks(texts):
                clean[[s.start + m[0] for m in batch_matches(items, hasher(fold(texts[s])))]] = False
            yield pdf[clean]
    return run


def item_blocks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, min_score: float = MIN_SCORE):
    """The test items in blocks of bounded size, each with its seeds chosen by corpus frequency."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (4 * block_words)))  # a word and its gap take four characters or more, on average
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        items = Items([r["item_id"] for r in part], [r["text"] for r in part], min_score)
        counts = (docs.select(F.col("text").cast("string").alias("text")).mapInPandas(_gram_counts(items), "gram long, n long")
                  .groupBy("gram").agg(F.sum("n").alias("n")))
        counts = counts.toArrow()  # at most one row a pair of the block
        gram, n = counts["gram"].to_numpy().view(U64), counts["n"].to_numpy()
        order = np.argsort(gram)
        items.drop_frequent(gram[order], n[order])
        yield items


def matches(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each contaminated document and item: doc_id, item_id, score (share of a full match),
    word_from, word_to (words of the document). Of several passages the best one is given, the first among equals."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in item_blocks(docs, benchmark, block_words, min_score):
        found = rows.mapInPandas(_match_rows(items), _SHAPE)
        out = found if out is None else out.union(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that no test item contaminates; all columns as they are."""
    for k, items in enumerate(item_blocks(docs, benchmark, block_words, min_score)):
        if k:
            docs = written(docs, "clean")
        docs = docs.mapInPandas(_clean_rows(items), docs.schema)
    return docs
