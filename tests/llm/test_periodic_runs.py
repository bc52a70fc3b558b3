import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF001
from sessionmart.llm.periodic_runs import digests, find_runs, runs_of
from sessionmart.llm.registry import QUERIES, with_periods

WORD = re.compile("[^\x20\x09-\x0d]+")
SHAPE = "doc_id long, text string"


def brute(w, min_length=6, min_periods=4):
    """Runs by every lag: maximal stretches that agree with the place a lag later, with no smaller period."""
    out, n = [], len(w)
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_periods * q):
                part = w[i:i + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def sequences(r):
    """Sequences over few symbols with nested and neighbouring repeats of many periods."""
    out = [[], [1], [1] * 5, [1] * 6, [1] * 400, [1, 2] * 4, [1, 2] * 3 + [1], [1, 2, 3] * 4 + [1] * 9, list(range(50)) * 4 + [7]]
    for _ in range(250):
        w = []
        while len(w) < r.randint(5, 300):
            unit = [r.randrange(r.choice([2, 3, 9])) for _ in range(r.choice([1, 2, 3, 5, 8, 13, 30]))]
            unit = unit * r.randint(1, 5) + [r.randrange(9)] * r.randint(0, 2)
            w += (unit * r.randint(1, 7))[:r.randint(1, 200)]
        out.append(w)
    return out


@pytest.mark.parametrize("rule", [(6, 4), (2, 3), (30, 4), (6, 9)])
def test_all_runs_are_found_and_no_others(rule):
    r = random.Random(2)
    docs = sequences(r)
    flat = np.array([x for w in docs for x in w], np.uint64)
    at = np.cumsum([0] + [len(w) for w in docs])
    got = list(zip(*(x.tolist() for x in runs_of(flat, at, *rule))))
    want = [(d, *run) for d, w in enumerate(docs) for run in brute(w, *rule)]
    assert got == want and len(want) > 100


def test_columns_of_runs_and_collapsed_text(spark):
    r = random.Random(3)
    texts = [None, "", " \n", "x", "a " * 7, "a\x0bb\x0c" * 9, "é ü\t" * 30 + "ende", "nbsp nbsp " * 8, "A a " * 3, "A a " * 4]
    texts += [" ".join(map(str, w)) for w in sequences(r)[:80]] + ["very long " * 40_000, " ".join(map(str, range(30_000))) + " end" * 9]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a " * 9), (3, texts[20])]
    docs = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as runs", "2 as n_words", "'x' as collapsed").repartition(3)
    got = sorted((str(x.doc_id), x.n_words, [tuple(y) for y in x.runs], x.collapsed) for x in find_runs(docs).collect())
    want = []
    for d, t in rows:
        w = WORD.findall(t or "")
        runs = brute(w) if len(w) < 1000 else [(0, 80_000, 2)] if w[0] == "very" else [(30_000, 9, 1)]
        want.append((str(d), len(w), runs, collapsed(w, runs)))
    assert got == sorted(want)
    assert find_runs(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        find_runs(docs, min_periods=2)


def test_query_equals_brute_force(spark):
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF001}/documents.parquet").collect() if len(x.text or "") < 6000]
    rows += [(None, rows[0][1]), (7, None), (8, ""), rows[1]] + [(r, "one two three four five six seven " * 3) for r in range(9000, 9060)]
    docs = spark.createDataFrame(rows, SHAPE)
    got = digests(find_runs(with_periods(docs.selectExpr("*", "1 as h", "2 as n", "3 as words", "4 as best")))).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for d, t in rows:
        w = planted(d, t)
        runs = brute(w)
        s, n, q = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        want.append((d, len(runs), s, n, q, n and 1000 * n // q, sha("".join("%d,%d,%d\n" % x for x in runs)), sha(collapsed(w, runs))))
    order = lambda x: (str(x[0]), x[1:2], x[7])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert sum(x[1] > 0 for x in want) > 20
    assert QUERIES["op13_periodic_runs"](spark, SF001).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                                                  "runs_sha256", "collapsed_sha256"]
