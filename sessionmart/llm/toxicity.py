"""Toxicity: a bidirectional gated recurrent network with attention pooling, over word and character inputs.

A word's inputs are its evidence (log-odds of toxic against other documents that hold it) as a whole word,
the strongest and the mean evidence of its character 3- to 5-grams (with its ends marked), and its
length; a word never seen still has character inputs. Two gated recurrent units read the words of a window in both
directions, attention pools their states, a logistic unit scores the window. All
overlapping windows of a text are scored; the text's score is its highest window's.

Evidence and network are fitted in numpy on a sample of labelled documents, bounded by
``max_train`` a class and ``max_train_chars`` a text. Labels say only that a document is toxic, so
training alternates: score the training windows, take each toxic document's best
window and the other documents' worst ones, and fit on them. Evidence used in training comes from the
other half of the sample, so the network learns how far to trust it.

Null text or text without words: 0. Null label or ``doc_id``: not trained on; a
null ``doc_id`` is still scored. Several labels for one id: toxic if any is. Without labelled
documents of both classes every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decontaminate import word_gaps
from .textops import U64, WordHasher, byte_values, chunks, mix, shingle_sets

WINDOW, STRIDE, HIDDEN, INPUTS = 64, 48, 8, 5
MAX_TRAIN, MAX_TRAIN_CHARS = 1500, 40_000
GRAM_BITS = 20
PRIOR = 4
_KNOWN = 500_000


class Evidence:
    """Log-odds of words (by hash) and of character n-grams (by bucket)."""

    def __init__(self) -> None:
        self.values = byte_values()
        self.word_hash = np.zeros(0, U64)
        self.word_odds = np.zeros(0, np.float32)
        self.gram_odds = np.zeros(1 << GRAM_BITS, np.float32)

    def grams(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the character 3- to 5-grams of words given by byte ranges, and the words they are of."""
        size = end - start + 2  # with a mark at each end
        first = np.concatenate(([0], np.cumsum(size)))
        code = np.full(first[-1], U64(0x51ED270B27C0FFEE), U64)
        own = np.repeat(np.arange(len(start)), size)
        place = np.arange(first[-1]) - first[own]
        inner = (place > 0) & (place < size[own] - 1)
        code[inner] = self.values[buf[start[own[inner]] + place[inner] - 1]]
        buckets, owners = [], []
        for n in (3, 4, 5):
            m = len(code) - n + 1
            if m <= 0:
                continue
            ok = np.flatnonzero(own[:m] == own[n - 1:])
            h = np.zeros(m, U64)
            for j in range(n):
                h = h * U64(0x9E3779B97F4A7C15) + code[j:j + m]
            buckets.append((mix(h[ok] + U64(n)) >> U64(64 - GRAM_BITS)).astype(np.int64))
            owners.append(own[ok])
        if not buckets:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(buckets), np.concatenate(owners)

    def fit(self, hasher: WordHasher, texts: list[str], toxic: np.ndarray) -> None:
        """Document frequencies in both classes, as smoothed log-odds."""
        pairs, gram_n = [], np.zeros((2, 1 << GRAM_BITS), np.int32)
        for s in chunks(texts, 500_000):
            w = hasher(texts[s])
            y = toxic[s][w.doc]
            order = np.lexsort((w.hash, w.doc))
            d, h = w.doc[order], w.hash[order]
            new = np.ones(len(h), bool)
            new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
            keep = order[new]
            pairs.append((w.hash[keep], y[keep]))
            g, own = self.grams(w.buf, w.start[keep], w.end[keep])
            both = np.unique(w.doc[keep][own] << GRAM_BITS | g)
            of = toxic[s][both >> GRAM_BITS]
            g = both & ((1 << GRAM_BITS) - 1)
            for c in (0, 1):
                gram_n[c] += np.bincount(g[of == c], minlength=1 << GRAM_BITS).astype(np.int32)
        h, y = (np.concatenate(x) for x in zip(*pairs))
        self.word_hash, code = np.unique(h, return_inverse=True)
        n1 = np.bincount(code, weights=y, minlength=len(self.word_hash))
        n0 = np.bincount(code, minlength=len(self.word_hash)) - n1
        share = (toxic.sum() + 1) / (len(toxic) + 2)

        def odds(a, b):  # few documents say little: PRIOR documents of the usual mix are added to each count
            p = (a + PRIOR * share) / (a + b + PRIOR)
            return np.clip(np.log(p / (1 - p)) - np.log(share / (1 - share)), -4, 6).astype(np.float32)
        seen = n1 + n0 > 1
        self.word_hash, self.word_odds = self.word_hash[seen], odds(n1, n0)[seen]
        self.gram_odds = np.where(gram_n.sum(axis=0) > 1, odds(gram_n[1], gram_n[0]), 0).astype(np.float32)

    def inputs(self, hash_: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Network inputs of words: one row each."""
        out = np.zeros((len(hash_), INPUTS), np.float32)
        if len(self.word_hash) and len(hash_):
            k = np.minimum(np.searchsorted(self.word_hash, hash_), len(self.word_hash) - 1)
            out[:, 0] = np.where(self.word_hash[k] == hash_, self.word_odds[k], 0)
        g, own = self.grams(buf, start, end)
        if len(g):
            odds = self.gram_odds[g]
            np.maximum.at(out[:, 1], own, odds)
            n = np.bincount(own, minlength=len(hash_))
            out[:, 2] = np.bincount(own, weights=odds, minlength=len(hash_)) / np.maximum(n, 1)
        out[:, 3] = np.minimum(end - start, 20) / 20
        out[:, 4] = 1
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Network:
    """Weights ``p`` of the two recurrent units (f, b), the attention and the output."""

    def __init__(self, seed: int = 11) -> None:
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {}
        for d in "fb":
            self.p["w" + d] = r.normal(0, 0.3, (INPUTS, 3 * h)).astype(np.float32)
            self.p["u" + d] = r.normal(0, 0.3, (h, 3 * h)).astype(np.float32)
        self.p["v"] = r.normal(0, 0.3, 2 * h).astype(np.float32)
        self.p["o"] = r.normal(0, 0.3, 2 * h).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    def scores(self, table: np.ndarray, idx: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logits of windows; ``table``: inputs of distinct words, the last row none; ``idx``: (window, place)."""
        p, h, (n, t) = self.p, HIDDEN, idx.shape
        real = idx < len(table) - 1
        steps = np.ascontiguousarray(idx.T)
        live = np.ascontiguousarray(real.T)[:, :, None].astype(np.float32)
        states = np.zeros((t, n, 2 * h), np.float32)
        kept = {}
        for d, at in (("f", 0), ("b", h)):
            gates, u = table @ p["w" + d], p["u" + d]
            uzr, un = np.ascontiguousarray(u[:, :2 * h]), np.ascontiguousarray(u[:, 2 * h:])
            s = np.zeros((n, h), np.float32)
            for i in (range(t) if d == "f" else range(t - 1, -1, -1)):
                x = gates[steps[i]]
                zr = sigmoid(x[:, :2 * h] + s @ uzr)
                z, r = zr[:, :h], zr[:, h:]
                q = s @ un
                c = np.tanh(x[:, 2 * h:] + r * q)
                new = (c + z * (s - c)) * live[i]
                if trace is not None:
                    kept[d, i] = (s, z, r, q, c)
                s = new
                states[i, :, at:at + h] = s
        a = np.where(live[:, :, 0] > 0, states @ p["v"], np.float32(-1e9))
        a = np.exp(a - a.max(axis=0)) * live[:, :, 0]
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = (states * a[:, :, None]).sum(axis=0)
        if trace is not None:
            trace.update(kept=kept, states=states, a=a, pooled=pooled, steps=steps, live=live)
        return pooled @ p["o"] + p["c"][0]

    def gradient(self, table: np.ndarray, idx: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted logistic loss (back-propagation through time)."""
        p, h, tr = self.p, HIDDEN, {}
        logit = self.scores(table, idx, tr)
        e = ((sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g = {k: np.zeros_like(x) for k, x in p.items()}
        g["o"], g["c"][0] = tr["pooled"].T @ e, e.sum()
        dp = e[:, None] * p["o"]
        da = (tr["states"] * dp).sum(axis=2)
        ds = tr["a"] * (da - (tr["a"] * da).sum(axis=0))
        g["v"] = np.einsum("tn,tnk->k", ds, tr["states"])
        dstates = tr["a"][:, :, None] * dp + ds[:, :, None] * p["v"]
        t = idx.shape[1]
        for d, at in (("f", 0), ("b", h)):
            w, u = p["w" + d], p["u" + d]
            back = np.zeros((idx.shape[0], h), np.float32)
            for i in (range(t - 1, -1, -1) if d == "f" else range(t)):
                s, z, r, q, c = tr["kept"][d, i]
                dn = (dstates[i, :, at:at + h] + back) * tr["live"][i]
                dc = dn * (1 - z) * (1 - c * c)
                dz = dn * (s - c) * z * (1 - z)
                dr = dc * q * r * (1 - r)
                dx = np.concatenate((dz, dr, dc), axis=1)
                x = table[tr["steps"][i]]
                g["w" + d] += x.T @ dx
                du = np.concatenate((dz, dr, dc * r), axis=1)
                g["u" + d] += s.T @ du
                back = dn * z + du @ u.T
        return g


def windows(at: np.ndarray, code: np.ndarray, none: int, size: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows of the texts: word codes (window, place) and the text of each; an empty text has one."""
    n = np.diff(at)
    many = np.maximum(1, -(-(n - size) // stride) + 1)
    doc = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    place = at[doc] + nth * stride
    idx = place[:, None] + np.arange(size)
    return np.where(idx < at[doc + 1][:, None], np.append(code, none)[np.minimum(idx, len(code))], none), doc


class Scorer:
    """Scores batches of texts; keeps the inputs of words seen."""

    def __init__(self, evidence: Evidence, network: Network) -> None:
        self.evidence, self.network = evidence, network
        self.hasher = WordHasher(word_gaps())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.rows = np.zeros((1 << 14, INPUTS), np.float32)

    def prepare(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs of the distinct words (and of none), windows, and their texts."""
        w = self.hasher(texts)
        uniq, where, code = np.unique(w.hash, return_index=True, return_inverse=True)
        if len(self.known) + len(uniq) > _KNOWN:
            self._forget()
        keys = uniq.tolist()
        new = np.array([i for i, x in enumerate(keys) if x not in self.known], np.int64)
        at = len(self.known)
        while at + len(new) > len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        if len(new):
            first = where[new]
            self.rows[at:at + len(new)] = self.evidence.inputs(uniq[new], w.buf, w.start[first], w.end[first])
            self.known.update(zip((keys[i] for i in new), range(at, at + len(new))))
        rows = self.rows[np.fromiter((self.known[x] for x in keys), np.int64, len(keys))]
        table = np.concatenate((rows, np.zeros((1, INPUTS), np.float32)))
        idx, doc = windows(w.at, code, len(uniq))
        return table, idx, doc

    def window_scores(self, texts: list[str | None], block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        table, idx, doc = self.prepare(texts)
        got = [self.network.scores(table, idx[i:i + block]) for i in range(0, len(idx), block)]
        return np.where(idx[:, 0] < len(table) - 1, np.concatenate(got), -np.inf), doc

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        logit, doc = self.window_scores(texts)  # -inf for an empty window
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, doc, logit)
        return 1 / (1 + np.exp(-np.clip(best, -700, 700)))


def distinct(texts: list[str], toxic: list[int]) -> tuple[list[str], list[int]]:
    """Labelled texts without copies and most near copies (told by their smallest 5-word hash), which would count as evidence again."""
    hasher, seen, keep = WordHasher(word_gaps()), set(), []
    for s in chunks(texts, 500_000):
        for i, x in enumerate(shingle_sets(hasher(texts[s])), s.start):
            if not len(x) or (x[0], toxic[i]) not in seen:
                seen.add((x[0], toxic[i]) if len(x) else None)
                keep.append(i)
    return [texts[i] for i in keep], [toxic[i] for i in keep]


def _midpoint(logit: np.ndarray, y: np.ndarray) -> np.float32:
    """The logit that parts the classes with the fewest errors, halfway to the next score."""
    order = np.argsort(-logit, kind="stable")
    gain = np.cumsum(np.where(y[order] == 1, 1, -1))
    k = int(gain.argmax())
    return np.float32((logit[order[k]] + logit[order[min(k + 1, len(order) - 1)]]) / 2)


def train(texts: list[str], toxic: list[int], rounds: int = 5, steps: int = 60, batch: int = 192, rate: float = 0.02,
          seed: int = 11) -> Scorer:
    """Fit evidence and network on labelled texts."""
    texts, toxic = distinct(texts, toxic)
    y = np.array(toxic, np.int64)
    r = np.random.default_rng(seed)
    half = r.permutation(len(y)) % 2
    hasher, network = WordHasher(word_gaps()), Network(seed)
    tables, idxs, docs, base = [], [], [], 0
    for k in (0, 1):  # inputs of each half by evidence from the other
        other, own = np.flatnonzero(half != k), np.flatnonzero(half == k)
        ev = Evidence()
        ev.fit(hasher, [texts[i] for i in other], y[other])
        scorer = Scorer(ev, network)
        for s in chunks([texts[i] for i in own], 500_000):
            table, idx, doc = scorer.prepare([texts[i] for i in own[s]])
            none = idx == len(table) - 1
            tables.append(table[:-1])
            idxs.append(np.where(none, -1, idx + base))
            docs.append(own[s][doc])
            base += len(table) - 1
            scorer._forget()
    table = np.concatenate(tables + [np.zeros((1, INPUTS), np.float32)])
    idx, doc = np.concatenate(idxs), np.concatenate(docs)
    idx[idx < 0] = base
    strength = table[:, :2].max(axis=1)
    logit = strength[idx].max(axis=1)  # the first choice of windows: by the strongest evidence
    m = {k: np.zeros_like(x) for k, x in network.p.items()}
    v = {k: np.zeros_like(x) for k, x in network.p.items()}
    done = 0
    for turn in range(rounds):
        if turn:
            logit = np.concatenate([network.scores(table, idx[i:i + 2048]) for i in range(0, len(idx), 2048)])
        order = np.lexsort((-logit, doc))
        rank = np.arange(len(order)) - np.searchsorted(doc[order], doc[order])
        best = order[rank == 0]
        pos = best[y[doc[best]] == 1]
        neg = order[(rank < 3) & (y[doc[order]] == 0)]
        for _ in range(steps):
            some = np.concatenate((r.choice(pos, batch // 3), r.choice(neg, batch - batch // 3)))
            g = network.gradient(table, idx[some], y[doc[some]].astype(np.float32), np.ones(len(some), np.float32))
            done += 1
            step = rate * 0.5 ** turn
            for k in network.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                network.p[k] -= (step * (m[k] / (1 - 0.9 ** done)) / (np.sqrt(v[k] / (1 - 0.99 ** done)) + 1e-7)).astype(np.float32)
    logit = np.concatenate([network.scores(table, idx[i:i + 2048]) for i in range(0, len(idx), 2048)])
    top = np.full(len(y), -np.inf, np.float32)
    np.maximum.at(top, doc, logit)
    network.p["c"] -= _midpoint(top, y)
    whole = Evidence()
    whole.fit(hasher, texts, y)
    return Scorer(whole, network)


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_chars: int = MAX_TRAIN_CHARS):
    """A bounded, deterministic sample of labelled texts: at most ``max_train`` a class, by hash of the id."""
    known = (labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = [known.where(F.col("toxic") == c).orderBy(*order).limit(max_train) for c in (0, 1)]
    some = F.broadcast(ids[0].union(ids[1]))  # at most 2 * max_train rows
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
            .where(F.length("text") <= max_chars).join(some, "doc_id").orderBy("doc_id", "text").limit(3 * max_train).collect())
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


def _score_rows(model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*model.value) if model else None
        for pdf in batches:
            texts, score = pdf["text"].tolist(), np.zeros(len(pdf))
            for s in chunks(texts) if scorer else ():
                score[s] = scorer(texts[s])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": score})
    return run


def score(docs: DataFrame, labels: DataFrame, train_on=None, max_train: int = MAX_TRAIN,
          max_chars: int = MAX_TRAIN_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, score from 0 to 1.

    ``train_on``: a condition on ``doc_id`` that labels must meet to be learnt from.
    """
    spark = docs.sparkSession
    texts, toxic = training_rows(docs, labels.where(train_on) if train_on is not None else labels, max_train, max_chars)
    sent = None
    if 0 < sum(toxic) < len(toxic):
        model = train(texts, toxic)
        sent = spark.sparkContext.broadcast((model.evidence, model.network))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(_score_rows(sent), "doc_id long, score double")
