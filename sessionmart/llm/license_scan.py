"""License scan: an exact set-similarity join of text blocks with license notices, by containment.

Words are lower-cased runs of letters, digits and non-ASCII characters. A template of n words belongs to the
reach s, the smallest power of two from 16 on that is n or more. The blocks of a reach are the runs of 2s words that
start at every multiple of s, so each passage of up to s + 1 words lies in a block whole. A block matches a
template when it holds at least ``threshold`` of the template's distinct words, all words that the template ``needs`` and none of
those it must be ``without``.

The join is exact. One scan counts how many documents hold each word of the templates; words are ordered by that count,
rarest first, the same way everywhere. With m distinct words of which ``need`` must be found, the first m - need + 1 words
in that order (prefix) cannot all be missing, so only blocks with a word of a prefix are looked at, by an index of
prefixes. A block with fewer than ``need`` words of any template is out (length). Where the first word that a block
shares with a template's prefix is the template's word i and the block's word j in the order, at most 1 + min(m - i, b - j) words can be
shared (i, j from 1; b words of the block); below ``need`` the pair is out (position). The rest are counted word by word.

Templates and phrases are the caller's list, at most ``MAX_TEMPLATE_WORDS`` words, held by each task; documents are scanned whole, in place,
twice, and never shuffled.

Null text: no words. Null ``doc_id``: stays null. Repeated rows are each scanned; other columns are not read. Repeated or
empty templates and phrases: empty ones match nothing, repeated ones are each reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decontaminate import word_gaps
from .licenses import Template
from .textops import U64, WordHasher, Words, chunks

THRESHOLD = 0.8
MIN_REACH = 16
MAX_TEMPLATE_WORDS = 1_000_000


def spread(lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers lo, lo + 1, ... of each range of n, end to end, and the range each belongs to."""
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + lo[of], of


class Vocabulary:
    """Distinct word hashes, found in texts by a bit table and then a search."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.unique(hashes)
        self.some = np.zeros(1 << (64 * len(self.hashes) + 1).bit_length(), bool)
        self.some[self._low(self.hashes)] = True

    def _low(self, h: np.ndarray) -> np.ndarray:
        return h.view(np.int64) & (len(self.some) - 1)

    def index(self, h: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.hashes, h)

    def found(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of vocabulary words in ``h``, and their numbers."""
        at = np.flatnonzero(self.some[self._low(h)])
        if not len(self.hashes):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        same = self.hashes[k] == h[at]
        return at[same], k[same]


class Reach:
    """Templates of one reach: their words by rank, and the index of their prefixes."""

    def __init__(self, s: int, numbers: list[int], sets: list[np.ndarray], threshold: float, n_ranks: int) -> None:
        self.s, self.numbers, self.n_ranks = s, np.array(numbers), n_ranks
        self.size = np.array([len(x) for x in sets])
        self.need = np.maximum(np.ceil(threshold * self.size - 1e-9).astype(np.int64), 1)
        self.keys = np.concatenate([t * n_ranks + x for t, x in enumerate(sets)])  # ascending
        length = self.size - self.need + 1
        place, of = spread(np.zeros(len(sets), np.int64), length)
        rank = np.concatenate([x[:k] for x, k in zip(sets, length)])
        order = np.argsort(rank, kind="stable")
        self.template, self.place = of[order], place[order]
        self.posting = np.searchsorted(rank[order], np.arange(n_ranks + 1))
        self.in_prefix = np.diff(self.posting) > 0

    def matches(self, doc: np.ndarray, word: np.ndarray, rank: np.ndarray):
        """Text, block, template and shared words of all pairs over the threshold, and each block's ranks.

        ``doc``, ``word``, ``rank``: text, place and rank of the vocabulary words.
        """
        k = word // self.s
        width = int(k.max()) + 1 if len(k) else 1
        block = doc * width + k  # and the one before, which overlaps it
        hit = self.in_prefix[rank]
        near = np.unique(np.concatenate((block[hit], block[hit & (k > 0)] - 1)))
        if not len(near):
            return None
        blocks, ranks = [], []
        for b, ok in ((block, np.ones(len(k), bool)), (block - 1, k > 0)):
            i = np.minimum(np.searchsorted(near, b), len(near) - 1)
            ok &= near[i] == b
            blocks.append(i[ok])
            ranks.append(rank[ok])
        held = np.unique(np.concatenate(blocks) * self.n_ranks + np.concatenate(ranks))
        of, rank = np.divmod(held, self.n_ranks)
        start = np.searchsorted(of, np.arange(len(near) + 1))
        b = np.diff(start)
        # pairs by the index; of each pair the first shared word
        at, token = spread(self.posting[rank], self.posting[rank + 1] - self.posting[rank])
        pair = of[token] * len(self.numbers) + self.template[at]
        pair, first = np.unique(pair, return_index=True)  # tokens are in order, so the first is the rarest
        own, t = np.divmod(pair, len(self.numbers))
        i, j = self.place[at[first]], token[first] - start[own]
        keep = (b[own] >= self.need[t]) & (1 + np.minimum(self.size[t] - i - 1, b[own] - j - 1) >= self.need[t])
        own, t = own[keep], t[keep]
        # the rest word by word
        at, pair = spread(start[own], b[own])
        key = t[pair] * self.n_ranks + rank[at]
        there = self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key
        shared = np.bincount(pair[there], minlength=len(own))
        keep = shared >= self.need[t]
        own, t, shared = own[keep], t[keep], shared[keep]
        text, k = np.divmod(near[own], width)
        return text, k, t, shared, [rank[start[x]:start[x + 1]] for x in own]


class Notices:
    """Templates and phrases, hashed; ranks are set by the corpus counts of ``order``."""

    def __init__(self, templates: list[Template], phrases: list[tuple[str, str]], threshold: float) -> None:
        hasher = WordHasher(word_gaps())

        def hashes(texts: list[str]) -> list[np.ndarray]:
            w = hasher(texts)
            return [w.hash[w.at[i]:w.at[i + 1]] for i in range(len(texts))]
        self.templates, self.threshold = templates, threshold
        self.texts = hashes([t.text for t in templates])
        if sum(map(len, self.texts)) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words; scan with parts of the list")
        self.needs = hashes([" ".join(t.needs) for t in templates])
        self.without = hashes([" ".join(t.without) for t in templates])
        self.phrases = [(label, h) for (label, _), h in zip(phrases, hashes([p for _, p in phrases])) if len(h)]
        self.vocabulary = Vocabulary(np.concatenate([np.zeros(0, U64), *self.texts, *self.needs, *self.without, *(h for _, h in self.phrases)]))

    def order(self, counts: np.ndarray) -> None:
        """Rank all words, rarest first; ``counts`` by word number."""
        n = len(counts)
        self.rank = np.empty(n, np.int64)
        self.rank[np.lexsort((np.arange(n), counts))] = np.arange(n)
        ranks = lambda h: np.unique(self.rank[self.vocabulary.index(h)])
        by_reach: dict[int, list[int]] = {}
        for i, h in enumerate(self.texts):
            if len(h):
                by_reach.setdefault(max(MIN_REACH, 1 << (len(h) - 1).bit_length()), []).append(i)
        self.reaches = [Reach(s, at, [ranks(self.texts[i]) for i in at], self.threshold, n) for s, at in sorted(by_reach.items())]
        self.need_ranks, self.without_ranks = [ranks(h) for h in self.needs], [ranks(h) for h in self.without]

    def places(self, w: Words, at: np.ndarray) -> list[tuple[int, str, int, int]]:
        """Text, label, first word and number of words of each place of a phrase; ``at``: vocabulary words."""
        out = []
        for label, phrase in self.phrases:
            i = at[w.hash[at] == phrase[0]]
            i = i[i + len(phrase) <= len(w.hash)]
            i = i[w.doc[i + len(phrase) - 1] == w.doc[i]] if len(i) else i
            for j in range(1, len(phrase)):
                i = i[w.hash[i + j] == phrase[j]]
            out += [(int(d), label, int(x), len(phrase)) for d, x in zip(w.doc[i], i - w.at[w.doc[i]])]
        return out

    def blocks(self, w: Words, at: np.ndarray, number: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """Text, template, first word, one past the last and share of each matching block."""
        out, rank, doc = [], self.rank[number], w.doc[at]
        word, size = at - w.at[doc], np.diff(w.at)
        for r in self.reaches:
            found = r.matches(doc, word, rank)
            for d, k, t, n, held in zip(*found) if found else ():
                i = r.numbers[t]
                if np.isin(self.need_ranks[i], held).all() and not np.isin(self.without_ranks[i], held).any():
                    out.append((int(d), int(i), int(k * r.s), int(min((k + 2) * r.s, size[d])), float(n / r.size[t])))
        return out


def _count_rows(notices: Notices):
    """Per task: how many texts hold each word of the notices."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, vocabulary = WordHasher(word_gaps()), notices.vocabulary
        n = max(len(vocabulary.hashes), 1)
        total = np.zeros(n, np.int64)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for s in chunks(texts):
                w = hasher(texts[s])
                at, number = vocabulary.found(w.hash)
                total += np.bincount(np.unique(w.doc[at] * n + number) % n, minlength=n)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"word": some, "n": total[some]})
    return run


_FOUND = ("doc_id long, n_words long, places array<struct<label: string, start: long, words: long>>, "
          "blocks array<struct<label: string, template: long, `from`: long, `to`: long, share: double>>")


def _scan_rows(notices: Notices):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher(word_gaps())
        for pdf in batches:
            texts, n_words = pdf["text"].tolist(), np.zeros(len(pdf), np.int64)
            places, blocks = ([[] for _ in texts] for _ in range(2))
            for s in chunks(texts):
                w = hasher(texts[s])
                n_words[s] = np.diff(w.at)
                at, number = notices.vocabulary.found(w.hash)
                for d, label, start, n in notices.places(w, at):
                    places[s.start + d].append({"label": label, "start": start, "words": n})
                for d, i, lo, hi, share in notices.blocks(w, at, number):
                    blocks[s.start + d].append({"label": notices.templates[i].label, "template": i, "from": lo, "to": hi, "share": share})
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_words": n_words,
                                "places": pd.Series(places, dtype=object, index=pdf.index),
                                "blocks": pd.Series(blocks, dtype=object, index=pdf.index)})
    return run


def scan(docs: DataFrame, templates: list[Template], phrases: list[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, ``places`` of the phrases (label, start, words) and
    matching ``blocks`` (label, template number, from, to in words, share of the template's words)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    notices = Notices(templates, phrases, threshold)
    counts = (rows.select("text").mapInPandas(_count_rows(notices), "word long, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).toPandas())  # at most one row a word of the templates
    total = np.zeros(len(notices.vocabulary.hashes), np.int64)
    total[counts["word"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    notices.order(total)
    return rows.mapInPandas(_scan_rows(notices), _FOUND)


def labelled(found: DataFrame) -> DataFrame:
    """Per row of ``scan``: the number and range of the phrases' places, labels, and the best share (1 with a phrase)."""
    base, more = F.array_distinct("places.label"), F.array_distinct("blocks.label")
    any_place = F.size("places") > 0
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(any_place, 1.0).otherwise(F.coalesce(F.array_max("blocks.share"), F.lit(0.0))).alias("score"))
