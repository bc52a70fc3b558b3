import random
import re

import numpy as np
from sessionmart.llm.textops import WordHasher, chunks, gram_hashes, shingle_sets

TEXTS = [None, "", "  ", "one", "a b c d", "a b c d e", "A B c d e", "x\ty\nz  w\x0bv\x0cu\rt", "é É ß ß", "a b a b a b a b a b a b",
         "nbsp stays one", "zwei wörter"]


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sets_of(text, n=5):
    w = words_of(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def test_words_and_sets_agree_with_plain_python():
    r = random.Random(3)
    texts = TEXTS + [" ".join(r.choices("ab cd E é f gh".split(), k=r.randint(0, 40))) for _ in range(200)]
    w = WordHasher()(texts)
    assert [int(x) for x in np.diff(w.at)] == [len(words_of(t)) for t in texts]
    named = {}
    for t, a, b in zip(texts, w.at[:-1], w.at[1:]):
        for word, h in zip(words_of(t), w.hash[a:b].tolist()):
            assert named.setdefault(word, h) == h
    assert len(set(named.values())) == len(named)
    sets, plain = shingle_sets(w), [sets_of(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(0, len(texts), 7):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_order_of_words_matters():
    g, _ = gram_hashes(WordHasher()(["a b c", "c b a", "a b c"]), 3)
    assert g[0] == g[2] != g[1]


def test_chunks_cover_every_text():
    texts = ["x" * n for n in (0, 5, 100, 1, 1, 0, 50)] + [None]
    got = [i for s in chunks(texts, 60) for i in range(len(texts))[s]]
    assert got == list(range(len(texts)))
    assert list(chunks([], 10)) == []


def test_hash_tables_are_little_longer_than_the_texts():
    hasher = WordHasher()
    for n in (70_000, 1_100_000):
        words = hasher(["ab " * (n // 3), "ab"])
        assert len(words.buf) <= len(hasher.up) == len(hasher.down) <= 1.2 * len(words.buf)
        assert (words.hash == words.hash[0]).all()
