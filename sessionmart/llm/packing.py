"""Packing: documents as token ids into fixed-length sequences, by vector bin packing.

Each task packs the documents it reads; nothing is shuffled. A sequence is a
bin with three limits: tokens, segments (pieces) and loss-bearing tokens. The open
sequence takes, among the pieces that wait and fit, the one whose demand has
the largest dot product with the capacity left (both as shares of the limits).
When none fits whole, the best one is cut to fill the sequence. A sequence
that must close early (segments or loss used up) keeps a power-of-two number of
tokens, which needs no padding, and the rest waits again; so do a task's last
tokens. So sequences are full or a power of two long.

Token ids come from a file of the ``tokenizers`` library, with its defaults: strings of added tokens in a
text are those tokens. The byte-level pre-tokeniser never joins white space or words across the places where white
space meets a word, or where letters end at punctuation, so each such unit is encoded once a task and looked up by
its 64-bit hash afterwards. Texts with white space outside ASCII or with an added token are encoded whole,
and so are all texts if the file has another pre-tokeniser or a normaliser.

A document's ids end with ``end_id``. Null text: empty (one id). Null
``doc_id``: kept as null. Repeated rows are packed each for itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import U64, byte_values, chunks, is_space, mix, powers

#: White space beyond ASCII (Unicode White_Space).
WIDE_SPACE = "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: A word of Latin letters, with its space: one pre-token.
LETTERS = " ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
_KNOWN, _TOGETHER, _CHARS = 600_000, 200, 1_000_000


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(others)}


class UnitEncoder:
    """Token ids of texts, with the ids of each unit (word with its space, or white space) kept."""

    def __init__(self, path: str) -> None:
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        shape = json.loads(self.tok.to_str())
        before = shape["pre_tokenizer"] or {}
        self.by_units = (shape["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                         and not before.get("add_prefix_space"))
        vocab = self.tok.get_vocab()
        self.byte_letters = _byte_letters()
        self.model = Tokenizer(self.tok.model) if self.by_units and all(c in vocab for c in self.byte_letters.values()) else None
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each token
        self.size[list(vocab.values())] = [len(t) for t in vocab]
        self.letters = re.compile(LETTERS)
        self.space, self.values = is_space(), byte_values()
        self.up, self.down = powers(1 << 16)
        self.wide, self.added = re.compile(WIDE_SPACE), [x["content"] for x in shape["added_tokens"]]
        self.feed = int(self.whole("\n")[0]) if self.by_units else -1
        ascii_ = np.arange(256)
        self.letter = ((ascii_ | 32) >= ord("a")) & ((ascii_ | 32) <= ord("z")) & (ascii_ < 128)
        digit = (ascii_ >= ord("0")) & (ascii_ <= ord("9"))
        self.mark = (ascii_ > 32) & (ascii_ < 127) & ~self.letter & ~digit & (ascii_ != ord("'"))
        self._forget()

    def _forget(self) -> None:
        self.known, self.slot = np.zeros(0, U64), np.zeros(0, np.int64)  # hashes of units in ascending order, and their places in ``off``
        self.flat = np.zeros(1 << 16, np.uint32)
        self.off = np.zeros(1 << 16, np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _units(self, buf: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Start of each unit; ``first``: where texts start (the byte before is a separator), with the end."""
        gap = self.space[buf]
        edge = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=np.int8(1)))
        start, end = edge[0::2], edge[1::2]
        text_at = first[np.searchsorted(first, start, side="right") - 1]
        before = np.maximum(np.concatenate(([0], end[:-1])), text_at)  # where the white space before a word starts
        spaced = (start > text_at) & (buf[np.maximum(start - 1, 0)] == 32)
        unit = start - spaced
        left = unit - before
        tails = np.concatenate((end, first[:-1]))  # white space that ends a text, or is all of it
        stop = first[np.searchsorted(first, tails, side="right")] - 1
        nxt = np.searchsorted(start, tails)
        following = np.where(nxt < len(start), start[np.minimum(nxt, max(len(start) - 1, 0))] if len(start) else 0, len(buf))
        last = (tails < stop) & (following >= stop) & gap[np.minimum(tails, len(buf) - 1)]
        mark = np.zeros(len(buf) + 1, bool)
        for at in (unit, before[left > 0], (unit - 1)[(left > 1) & ~spaced], tails[last]):
            mark[at] = True
        mark[1:-1] |= self.letter[buf[:-1]] & self.mark[buf[1:]]  # letters end where ASCII punctuation starts
        return np.flatnonzero(mark)

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are one pre-token each, end to end, and their number for each word: the model alone, without the pre-tokeniser."""
        spelt = b"\n".join(words).decode("latin-1").translate(self.byte_letters).split(self.byte_letters[10])
        ids = np.array(self.model.encode_batch_fast([spelt], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        ends, to = np.cumsum([len(w) for w in words]), np.cumsum(self.size[ids])
        assert ends[-1] == to[-1]
        return ids, np.diff(np.searchsorted(to, ends, side="right"), prepend=0)

    def _lines(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any units but white space, as lines of one text: each line feed is a token of its own."""
        ids = self.whole((b"\n" + b"\n".join(units)).decode("utf-8", "surrogatepass"))
        feed = np.flatnonzero(ids == self.feed)
        assert len(feed) == len(units)
        return np.delete(ids, feed), np.diff(np.append(feed, len(ids))) - 1

    def _learn(self, hashes: np.ndarray, units: list[bytes]) -> None:
        """Encode new units; ``hashes`` ascend."""
        kinds: tuple[list[int], ...] = ([], [], [])
        for i, u in enumerate(units):
            kinds[2 if u.isspace() else 0 if self.model and self.letters.fullmatch(u.decode("utf-8", "surrogatepass")) else 1].append(i)
        some = [self._words([units[i] for i in kinds[0][k:k + _TOGETHER]]) for k in range(0, len(kinds[0]), _TOGETHER)]
        some += [self._lines([units[i] for i in kinds[1][k:k + _TOGETHER]]) for k in range(0, len(kinds[1]), _TOGETHER)]
        some += [(ids, [len(ids)]) for ids in (self.whole(units[i].decode()) for i in kinds[2])]
        at = len(self.known)
        while at + len(units) + 1 > len(self.off):
            self.off = np.concatenate((self.off, np.zeros_like(self.off)))
        self.off[at + 1:at + 1 + len(units)] = self.off[at] + np.cumsum(np.concatenate([n for _, n in some]))
        total = int(self.off[at + len(units)])
        while total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.off[at]:total] = np.concatenate([ids for ids, _ in some])
        slot = np.empty(len(units), np.int64)
        slot[[i for kind in kinds for i in kind]] = np.arange(at, at + len(units))
        to = np.searchsorted(self.known, hashes)
        self.known, self.slot = np.insert(self.known, to, hashes), np.insert(self.slot, to, slot)

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each hash among the known ones, and whether it is there."""
        at = np.searchsorted(self.known, hashes)
        return at, self.known[np.minimum(at, len(self.known) - 1)] == hashes if len(self.known) else np.zeros(len(hashes), bool)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_units:
            return [self.whole(t) for t in texts]
        return [ids for s in chunks(texts, _CHARS) for ids in self._encode(texts[s])]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [None if any(a in t for a in self.added) or not t.isascii() and self.wide.search(t) else t for t in texts]
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in plain]
        first = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(b) + 1 for b in raw], out=first[1:])
        data = b"\n".join(raw) + b"\n"
        buf = np.frombuffer(data, np.uint8)
        if len(buf) > len(self.up):
            self.up, self.down = powers(len(buf) + len(buf) // 8)
        start = self._units(buf, first)
        of = np.searchsorted(first, start, side="right") - 1
        nxt = np.append(start[1:], len(buf))
        end = np.minimum(nxt, first[of + 1] - 1)
        run = np.zeros(len(buf) + 1, U64)
        np.cumsum(self.values[buf] * self.up[:len(buf)], out=run[1:], dtype=U64)
        h = mix((run[end] - run[start]) * self.down[start] + (end - start).astype(U64))
        uniq, where, code = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(uniq) > _KNOWN:
            self._forget()
        new = np.flatnonzero(~self._place(uniq)[1])
        if len(new):
            self._learn(uniq[new], [data[i:j] for i, j in zip(start[where[new]].tolist(), end[where[new]].tolist())])
        slot = self.slot[self._place(uniq)[0]][code]
        a, n = self.off[slot], self.off[slot + 1] - self.off[slot]
        to = np.concatenate(([0], np.cumsum(n)))
        flat = self.flat[np.repeat(a - to[:-1], n) + np.arange(to[-1])]
        cut = to[np.searchsorted(of, np.arange(len(raw) + 1))]
        return [self.whole(t) if p is None else flat[cut[i]:cut[i + 1]] for i, (t, p) in enumerate(zip(texts, plain))]


class Packer:
    """Open sequence and waiting pieces of one task."""

    def __init__(self, limits: tuple[int, int, int], sequence: int) -> None:
        self.limits = np.array(limits, float)
        self.sequence = sequence
        self.docs: list[tuple] = []     # (doc_id, ids, prompt)
        self.wait: list[tuple] = []     # (doc, start, end)
        self.out: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray, prompt: int) -> None:
        self.docs.append((doc_id, ids, prompt))
        size, d = int(self.limits[0]), len(self.docs) - 1
        self.wait.append((d, 0, len(ids)))
        assert size > 0

    def _loss(self, d: int, a: int, b: int) -> int:
        """Ids of a piece that bear loss: past the prompt, and not the piece's first."""
        return max(0, b - max(a + 1, self.docs[d][2]))

    def _fits(self, d: int, a: int, room: np.ndarray) -> int:
        """The longest piece from ``a`` on that the room takes."""
        if room[1] < 1:
            return 0
        free = max(a + 1, self.docs[d][2]) - a
        return int(min(room[0], free + room[2]))

    def fill(self, last: bool) -> None:
        """Close sequences while the waiting pieces can fill them; ``last``: until nothing waits."""
        ids = self.wait
        need = np.array([(b - a, 1, self._loss(d, a, b)) for d, a, b in ids], float).reshape(-1, 3)
        alive = np.ones(len(ids), bool)
        total = need[:, 0].sum()
        while total and (last or total >= 4 * self.limits[0]):
            room, seq = self.limits.copy(), []
            while room[0] > 0 and room[1] > 0 and total:
                score = np.where(alive, (need / self.limits) @ (room / self.limits), -1.0)
                fit = score * (need <= room).all(axis=1)
                i = int(fit.argmax())
                if fit[i] <= 0:  # none fits whole: cut the best one
                    i = int(score.argmax())
                    d, a, b = ids[i]
                    n = min(b - a, self._fits(d, a, room))
                    if n <= 0:
                        break
                    seq.append((d, a, a + n))
                    room -= (n, 1, self._loss(d, a, a + n))
                    total -= n
                    ids[i] = (d, a + n, b)
                    need[i] = (b - a - n, 1, self._loss(d, a + n, b))
                    alive[i] = b > a + n
                    continue
                d, a, b = ids[i]
                seq.append((d, a, b))
                room -= need[i]
                total -= need[i, 0]
                alive[i] = False
            back = self._close(seq)
            if back:
                total += sum(b - a for _, a, b in back)
                ids = ids + back
                need = np.vstack((need, [(b - a, 1, self._loss(d, a, b)) for d, a, b in back]))
                alive = np.append(alive, np.ones(len(back), bool))
            if alive.sum() * 2 < len(alive):
                ids = [x for x, k in zip(ids, alive) if k]
                need, alive = need[alive], np.ones(len(ids), bool)
        left = [x for x, k in zip(ids, alive) if k]
        used = sorted({d for d, _, _ in left})
        self.docs = [self.docs[d] for d in used]
        at = {d: i for i, d in enumerate(used)}
        self.wait = [(at[d], a, b) for d, a, b in left]

    def _close(self, seq: list[tuple]) -> list[tuple]:
        """Write a sequence, cut to a power of two unless full; returns what was cut off."""
        n = sum(b - a for _, a, b in seq)
        size = int(self.limits[0])
        keep = n if n == size else 1 << (n.bit_length() - 1)
        back, offset = [], 0
        for d, a, b in seq:
            c = min(b, a + keep - offset)
            if c > a:
                doc_id, ids, _ = self.docs[d]
                self.out.append((doc_id, a, c - a, len(ids), self.sequence, offset, keep, self._loss(d, a, c),
                                 ids[a:c].astype("<u4").tobytes()))
                offset += c - a
            if c < b:
                back.append((d, max(a, c), b))
        self.sequence += 1
        return back


_SHAPE = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, loss_tokens long, ids binary")


def _pack_rows(tokenizer: str, limits: tuple[int, int, int], end_id: int):
    columns = [c.split()[0] for c in _SHAPE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        packer = Packer(limits, TaskContext.get().partitionId() << 32)
        end = np.array([end_id], np.uint32)

        def done() -> pd.DataFrame:
            out = pd.DataFrame(packer.out, columns=columns)
            out["doc_id"] = pd.array([None if pd.isna(x) else int(x) for x in out["doc_id"]], "Int64")
            packer.out = []
            return out
        for pdf in batches:
            encoder = encoder or UnitEncoder(tokenizer)
            texts = ["" if t is None else t for t in pdf["text"]]
            doc_ids, prompts = pdf["doc_id"].tolist(), pdf["prompt"].tolist()
            for s in chunks(texts):
                for i, p, ids in zip(doc_ids[s], prompts[s], encoder(texts[s])):
                    packer.add(i, np.concatenate((ids, end)), p)
                packer.fill(last=False)
                yield done()
        packer.fill(last=True)
        yield done()
    return run


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, max_segments: int = 256,
         max_loss_tokens: int = 2048, end_id: int = 1, prompt: str | None = None) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in their sequences, one row each.

    ``ids``: the piece's token ids as little-endian unsigned 32-bit values; ``start``,
    ``length``: its place in the document; ``sequence_id``, ``offset``: its
    place in a sequence of ``sequence_tokens``; ``loss_tokens``: ids that bear loss.
    ``prompt`` names a column with the number of leading ids of a document that
    bear none (null: 0). ``max_tokens`` must be a power of two.
    """
    lead = F.coalesce(F.col(prompt).cast("long"), F.lit(0)) if prompt else F.lit(0).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       lead.alias("prompt"))
    return rows.mapInPandas(_pack_rows(tokenizer, (max_tokens, max_segments, max_loss_tokens), end_id), _SHAPE)
